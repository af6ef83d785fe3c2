"""All queries of the core, each with its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from testimonia.functions import text as T
from testimonia.operators import corpus as C, graph as G
from testimonia.operators.evaluation import PROCEDURAL
from testimonia.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# SQL of relations that several queries use.
_TURNS = "t as (select distinct doc_id, turn_no, upper(trim(coalesce(speaker, ''))) as speaker, text, page_start, page_end from turns where text is not null)"
_WC = r"len(regexp_extract_all(text, '[\p{L}\p{N}_''-]*[\p{L}\p{N}_][\p{L}\p{N}_''-]*'))"
_BENCH = "(speaker like 'CHAIRPERSON%' or speaker like 'COMMISSIONER%' or speaker like 'THE CHAIRPERSON%' or speaker like 'THE COMMISSIONER%')"
_COUNSEL = r"co as (select speaker, count(distinct doc_id) as docs from t where speaker <> '' group by speaker having regexp_matches(speaker, '\bSC\b') or count(distinct doc_id) >= 10)"
_NORM = r"trim(regexp_replace(regexp_replace(upper({0}), '[^A-Z0-9\- ]+', ' ', 'g'), '\s+', ' ', 'g'))"
_TITLES = "[" + ", ".join(f"'{t}'" for t in T.TITLE_TOKENS) + "]"
_STRIP = "array_to_string(list_filter(string_split({0}, ' '), lambda x: x <> '' and not list_contains(" + _TITLES + ", x)), ' ')"
_FORMS = f"""
f as (select distinct tg as type_group, form, entity_id from (select case when entity_type = 'acronym' then 'org' else entity_type end as tg, entity_id, {_NORM.format("f")} as form
  from (select entity_type, entity_id, unnest(list_concat([name], coalesce(aliases, []))) as f from entities)) where form <> '')"""
_INDEX = f"""
a as (select type_group, form, min(entity_id) as entity_id from f group by type_group, form having count(*) = 1),
b0 as (select distinct type_group, form, entity_id from (select type_group, {_STRIP.format("form")} as form, entity_id from f) where form <> ''),
b1 as (select type_group, form, min(entity_id) as entity_id from b0 group by type_group, form having count(*) = 1),
ow as (select type_group, form from (select distinct type_group, entity_id, unnest(string_split(form, ' ')) as form from b0) group by type_group, form having count(*) > 1),
b as (select * from b1 where not exists (select 1 from f where f.type_group = b1.type_group and f.form = b1.form) and not exists (select 1 from ow where ow.type_group = b1.type_group and ow.form = b1.form))"""
_NAMES = r"""
n as (select distinct chunk_id, kind, name from (select chunk_id, kind, trim(regexp_replace(name, '\s+', ' ', 'g')) as name from (
  select chunk_id, 'person' as kind, unnest(person) as name from mentions union all select chunk_id, 'org', unnest(org) from mentions union all select chunk_id, 'place', unnest(place) from mentions)) where name <> '')"""
_CLAIMNAMES = r"""
cl as (select distinct claim_id, chunk_id, speaker, text, quote, day_no, attribution, certainty, mentions from claims),
cn as (select claim_id, chunk_id, trim(regexp_replace(m.name, '\s+', ' ', 'g')) as name, m.role as role from (select claim_id, chunk_id, unnest(mentions) as m from cl) where trim(regexp_replace(m.name, '\s+', ' ', 'g')) <> '')"""
_PROCEDURAL_SQL = "(" + ", ".join(f"'{x}'" for x in PROCEDURAL) + ")"
_DAYS = "d as (select distinct chunk_id, commission_slug, day_no, hearing_date, doc_sha256, page_start from chunks)"
_LATEST_SHA = "rl as (select sha256, unnest(r) from (select sha256, arg_min({'url': url, 'source_type': source_type, 'document_type': document_type, 'authoritative': authoritative, 'filename': filename, 'transcription_method': transcription_method}, {'u': url, 'd': discovered_at}) as r from registry where sha256 is not null group by sha256))"
_SPEAKERS = "sp as (select distinct chunk_id, speaker from (select chunk_id, unnest(speakers) as speaker from chunks))"


def _t(spark: SparkSession, d: str, *names: str):
    out = [table(spark, d, n) for n in names]
    return out[0] if len(out) == 1 else out


# --- registry ---------------------------------------------------------------------------------------------------


@query("s1_registry_latest", "select url, discovered_at, downloaded, sha256 from (select *, row_number() over (partition by url order by discovered_at desc nulls last, coalesce(cast(downloaded as int), 0) desc, coalesce(sha256, '') desc, coalesce(title, '') desc) as rn from registry) where rn = 1")
def _(spark, d):
    return C.latest_per_url(_t(spark, d, "registry")).select("url", "discovered_at", "downloaded", "sha256")


@query("f1_registry_filter_counts", "select commission_slug, source_type, document_type, count(distinct url) as urls, count(distinct sha256) as files from registry group by all")
def _(spark, d):
    return _t(spark, d, "registry").groupBy("commission_slug", "source_type", "document_type").agg(F.countDistinct("url").alias("urls"), F.countDistinct("sha256").alias("files"))


@query("a13_status_histogram", "select case when downloaded and coalesce(local_path, '') <> '' then case when coalesce(superseded_by, '') <> '' then 'superseded' else 'active' end else 'pending' end as status, count(distinct url) as urls from registry group by 1")
def _(spark, d):
    r = _t(spark, d, "registry")
    has = F.col("downloaded") & (F.coalesce("local_path", F.lit("")) != "")
    return r.groupBy(F.when(has, F.when(F.coalesce("superseded_by", F.lit("")) != "", "superseded").otherwise("active")).otherwise("pending").alias("status")).agg(F.countDistinct("url").alias("urls"))


@query("a12_duplicate_hashes", "select sha256, count(distinct url) as urls, min(url) as first_url from registry where sha256 is not null group by sha256 having count(distinct url) > 1")
def _(spark, d):
    return _t(spark, d, "registry").where("sha256 is not null").groupBy("sha256").agg(F.countDistinct("url").alias("urls"), F.min("url").alias("first_url")).where("urls > 1")


# --- pages --------------------------------------------------------------------------------------------------------


@query("scanned_documents", "select doc_id, coalesce(avg(char_count), 0) as mean_chars, coalesce(avg(char_count), 0) < 100 as scanned from (select distinct doc_id, page_no, text, char_count from pages) group by doc_id")
def _(spark, d):
    m = F.coalesce(F.avg("char_count"), F.lit(0.0))
    return _t(spark, d, "pages").distinct().groupBy("doc_id").agg(m.alias("mean_chars"), (m < 100).alias("scanned"))


@query("furniture_lines", r"""with l as (select doc_id, page_no, unnest(string_split(text, chr(10))) as line from (select distinct * from pages))
select doc_id, page_no, count(*) as lines, sum(case when trim(line) = '' or regexp_matches(trim(line), '^\s*\d{1,3}\s*$') or regexp_matches(trim(line), '^\s*\d{1,2}\s+[A-Z]+\s+\d{4}\s*[–-]\s*DAY\s+\d+\s*$') or regexp_matches(trim(line), '(?i)^\s*Page\s+\d+\s+of\s+\d+\s*$') then 1 else 0 end) as furniture from l group by doc_id, page_no""")
def _(spark, d):
    return C.page_lines(_t(spark, d, "pages")).groupBy("doc_id", "page_no").agg(F.count("*").alias("lines"), F.sum(T.is_furniture(F.col("line")).cast("long")).alias("furniture"))


@query("t2_reflow", r"""with l as (select doc_id, page_no, unnest(list_transform(string_split(text, chr(10)), lambda x: trim(x))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from (select distinct doc_id, page_no, text, char_count from pages)),
k as (select * from l where not (line = '' or regexp_matches(line, '^\s*\d{1,3}\s*$') or regexp_matches(line, '^\s*\d{1,2}\s+[A-Z]+\s+\d{4}\s*[–-]\s*DAY\s+\d+\s*$') or regexp_matches(line, '(?i)^\s*Page\s+\d+\s+of\s+\d+\s*$')))
select doc_id, page_no, trim(regexp_replace(string_agg(line, ' ' order by i), '\s+', ' ', 'g')) as text from k group by doc_id, page_no""")
def _(spark, d):
    return C.reflowed(_t(spark, d, "pages"))


@query("j5_candidate_documents", """with r as (select distinct commission_slug as s, sha256 as h, day_no as d, hearing_date as t from registry where sha256 is not null)
select distinct least(a.h, b.h) as doc_a, greatest(a.h, b.h) as doc_b from r a join r b on a.s = b.s and a.h <> b.h and (a.d = b.d or (a.t = b.t and a.t <> '') or abs(a.d - b.d) = 1)""")
def _(spark, d):
    return C.candidate_documents(_t(spark, d, "registry"))


# --- turns --------------------------------------------------------------------------------------------------------


@query("a1_speaker_words", f"with {_TURNS} select doc_id, speaker, cast(sum({_WC}) as bigint) as words, count(*) as turns from t group by doc_id, speaker")
def _(spark, d):
    return C.speaker_words(_t(spark, d, "turns"))


@query("a2_a3_turn_lengths", f"with {_TURNS}, w as (select doc_id, {_WC} as n from t) select doc_id, median(n) as median_words, avg(case when n < 15 then 1 else 0 end) as short_share, count(*) as turns from w group by doc_id")
def _(spark, d):
    w = C.turn_words(_t(spark, d, "turns")).select("doc_id", F.col("words").alias("n"))
    return w.groupBy("doc_id").agg(F.median("n").alias("median_words"), F.avg(F.when(F.col("n") < 15, 1).otherwise(0)).alias("short_share"), F.count("*").alias("turns"))


@query("a7_counsel", f"with {_TURNS}, {_COUNSEL} select * from co")
def _(spark, d):
    return C.counsel(_t(spark, d, "turns"))


_WITNESS = f"""l as (select *, lag(speaker) over w as ps, rtrim(lag(text) over w) as pt from t where speaker <> '' window w as (partition by doc_id order by turn_no, text, speaker)),
an as (select doc_id, speaker, count(*) as answers, min(turn_no) as ft from l where pt like '%?' and ps <> speaker and not {_BENCH} and speaker not in (select speaker from co) group by doc_id, speaker),
wi as (select doc_id, speaker, answers from (select *, row_number() over (partition by doc_id order by answers desc, ft, speaker) as rn from an) where rn = 1 and answers >= 5)"""


@query("a8_witness", f"with {_TURNS}, {_COUNSEL}, {_WITNESS} select * from wi")
def _(spark, d):
    return C.witnesses(_t(spark, d, "turns"))


@query("a4_role_shares", f"""with {_TURNS}, {_COUNSEL}, {_WITNESS}, s as (select doc_id, speaker, sum({_WC}) as words from t where speaker <> '' group by doc_id, speaker),
r as (select case when {_BENCH.replace("speaker", "s.speaker")} then 'bench' when s.speaker = wi.speaker then 'witness' else 'counsel' end as role, sum(words) as words from s left join wi on s.doc_id = wi.doc_id group by 1)
select role, cast(words as bigint) as words, 100.0 * words / (select sum(words) from r) as share from r""")
def _(spark, d):
    return C.roles(_t(spark, d, "turns"))


@query("a6_speaker_days", f"with {_TURNS} select speaker, count(distinct doc_id) as docs, cast(sum({_WC}) as bigint) as words from t where speaker <> '' group by speaker")
def _(spark, d):
    return C.turn_words(_t(spark, d, "turns")).where("speaker <> ''").groupBy("speaker").agg(F.countDistinct("doc_id").alias("docs"), F.sum(F.col("words").cast("long")).alias("words"))


@query("l3_top_speakers", f"with {_TURNS} select speaker, count(*) as turns from t where speaker <> '' group by speaker order by turns desc, speaker limit 20")
def _(spark, d):
    return C.turn_words(_t(spark, d, "turns")).where("speaker <> ''").groupBy("speaker").agg(F.count("*").alias("turns")).orderBy(F.desc("turns"), "speaker").limit(20)


@query("w4_label_carried", f"with {_TURNS} select doc_id, turn_no, last_value(nullif(speaker, '') ignore nulls) over (partition by doc_id order by turn_no, text, speaker rows unbounded preceding) as label from t")
def _(spark, d):
    return C.labels_carried(_t(spark, d, "turns"))


# --- days ---------------------------------------------------------------------------------------------------------

_SERIES = "s as (select try_strptime(hearing_date, '%Y-%m-%d')::date as d, count(distinct chunk_id) as chunks, sum(length(text)) as chars from (select distinct chunk_id, day_no, hearing_date, text from chunks where regexp_full_match(hearing_date, '\\d{4}-\\d{2}-\\d{2}')) where day_no is not null group by 1 having d is not null)"


def _series(spark, d) -> DataFrame:
    c = _t(spark, d, "chunks").select("chunk_id", "day_no", "hearing_date", "text").where(r"hearing_date rlike '^\\d{4}-\\d{2}-\\d{2}$'")
    return C.day_series(c)


@query("w2_w5_day_series", f"with {_SERIES} select d, chunks, cast(chars as bigint) as chars, cast(sum(chunks) over (order by d rows unbounded preceding) as bigint) as running, avg(chunks) over (order by d rows between 4 preceding and current row) as mean5 from s")
def _(spark, d):
    w = Window.orderBy("d")  # one row per hearing day
    return _series(spark, d).select("d", "chunks", "chars", F.sum("chunks").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"), F.avg("chunks").over(w.rowsBetween(-4, 0)).alias("mean5"))


@query("w3_series_gaps", f"with {_SERIES}, g as (select d, case when d - lag(d) over (order by d) > 7 then 1 else 0 end as brk from s) select d, cast(sum(brk) over (order by d rows unbounded preceding) as bigint) as segment from g")
def _(spark, d):
    w = Window.orderBy("d")
    g = _series(spark, d).withColumn("brk", F.when(F.datediff("d", F.lag("d").over(w)) > 7, 1).otherwise(0))
    return g.select("d", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("segment"))


# --- entities -----------------------------------------------------------------------------------------------------


@query("t12_alias_index", f"with {_FORMS}, {_INDEX} select type_group, form, entity_id, 'full' as tier from a union all select type_group, form, entity_id, 'bare' from b")
def _(spark, d):
    e = _t(spark, d, "entities")
    return G.alias_index(e).withColumn("tier", F.lit("full")).unionByName(G.bare_index(e).withColumn("tier", F.lit("bare")))


@query("j3_resolution", f"""with {_FORMS}, {_INDEX}, s as (select distinct surface_id, lower(entity_type) as type_group, surface, {_NORM.format("surface")} as form from surfaces where surface is not null)
select s.surface_id, s.form, coalesce(a.entity_id, b.entity_id) as entity_id from s left join a on a.type_group = s.type_group and a.form = s.form left join b on b.type_group = s.type_group and b.form = {_STRIP.format("s.form")}""")
def _(spark, d):
    s = _t(spark, d, "surfaces").where("surface is not null").select("surface_id", F.lower("entity_type").alias("type_group"), "surface").distinct()
    return G.resolved(s, _t(spark, d, "entities")).select("surface_id", "form", "entity_id")


@query("t13_shared_surnames", f"with {_FORMS}, k as (select distinct entity_id, list_last(string_split({_STRIP.format(_NORM.format('name'))}, ' ')) as surname from entities where entity_type = 'person') select surname, count(*) as owners from k group by surname having count(*) > 1")
def _(spark, d):
    k = _t(spark, d, "entities").where("entity_type = 'person'").withColumn("f", T.normalise(F.col("name"))).withColumn("f", T.strip_titles(F.col("f")))
    return k.select("entity_id", F.element_at(F.split("f", " "), -1).alias("surname")).distinct().groupBy("surname").agg(F.count("*").alias("owners")).where("owners > 1")


# --- mentions and claims -----------------------------------------------------------------------------------------


@query("a22_entity_frequency", f"with {_NAMES}, {_DAYS} select n.kind, n.name, count(distinct n.chunk_id) as chunks, count(distinct (d.commission_slug, d.day_no)) filter (where d.day_no is not null) as days from n join d on d.chunk_id = n.chunk_id where kind <> 'place' group by all")
def _(spark, d):
    n = G.chunk_names(_t(spark, d, "mentions"), ("person", "org")).join(G.chunk_days(_t(spark, d, "chunks")), "chunk_id")
    return n.groupBy("kind", "name").agg(F.countDistinct("chunk_id").alias("chunks"), F.countDistinct(F.when(F.col("day_no").isNotNull(), F.struct("commission_slug", "day_no"))).alias("days"))


@query("a23_lift", f"""with {_NAMES}, m as (select distinct chunk_id, name from n where kind <> 'place'), c as (select name, count(*) as k from m group by name), t as (select count(distinct chunk_id) as k from m),
x as (select name from c order by k desc, name limit 1), e as (select m.name, count(*) as shared from m where chunk_id in (select chunk_id from m where name = (select name from x)) and name <> (select name from x) group by m.name)
select e.name, e.shared, e.shared * t.k / (c.k * (select k from c where name = (select name from x)))::double as lift from e join c on c.name = e.name cross join t where e.shared >= 2 order by lift desc, e.name limit 18""")
def _(spark, d):
    m = G.chunk_names(_t(spark, d, "mentions"), ("person", "org")).select("chunk_id", "name").distinct()
    c = m.groupBy("name").agg(F.count("*").alias("k"))
    t = m.agg(F.countDistinct("chunk_id").alias("t"))
    x = c.orderBy(F.desc("k"), "name").limit(1).select(F.col("name").alias("centre"), F.col("k").alias("kx"))
    ego = m.join(F.broadcast(x), m["name"] == x["centre"]).select("chunk_id", "centre", "kx")
    e = m.join(ego, "chunk_id").where("name <> centre").groupBy("name", "kx").agg(F.count("*").alias("shared")).where("shared >= 2")
    out = e.join(c, "name").crossJoin(F.broadcast(t))  # one row
    return out.select("name", "shared", (F.col("shared") * F.col("t") / (F.col("k") * F.col("kx"))).alias("lift")).orderBy(F.desc("lift"), "name").limit(18)


_MODALITY = "case " + " ".join(f"when {' or '.join(f'contains(lower(coalesce(text, {chr(39)*2})), {chr(39)}{k}{chr(39)})' for k in keys)} then '{name}'" for name, keys in T.STANCES.items()) + " else 'other' end"


@query("a25_stances", f"with {_CLAIMNAMES}, m as (select distinct cn.claim_id, cn.name, {_MODALITY} as stance from cn join cl on cl.claim_id = cn.claim_id) select name, count(*) filter (where stance = 'assert') as asserts, count(*) filter (where stance = 'deny') as denials, count(*) filter (where stance = 'question') as questions, count(*) filter (where stance = 'other') as others from m group by name")
def _(spark, d):
    c = G.distinct_claims(_t(spark, d, "claims"))
    m = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct().join(c.select("claim_id", T.modality(F.col("text")).alias("stance")).distinct(), "claim_id")
    return m.groupBy("name").agg(*[F.count(F.when(F.col("stance") == s, 1)).alias(n) for s, n in (("assert", "asserts"), ("deny", "denials"), ("question", "questions"), ("other", "others"))])


_VERBS = "[" + ", ".join(f"'{v}'" for v in T.REPORTED_VERBS) + "]"


@query("a18_structural_flags", rf"with {_CLAIMNAMES} select claim_id, trim(coalesce(speaker, '')) = '' or not list_has_any(string_split_regex(lower(trim(text)), '\s+')[1:4], {_VERBS}) as flagged from cl where text is not null")
def _(spark, d):
    return G.distinct_claims(_t(spark, d, "claims")).where("text is not null").select("claim_id", T.structurally_asserted(F.col("speaker"), F.col("text")).alias("flagged"))


@query("f7_claim_keys", rf"with {_CLAIMNAMES} select claim_id, sha256(chunk_id || '|' || upper(speaker) || '|' || regexp_replace(lower(trim(text)), '\s+', ' ', 'g') || '|0:' || cast(length(quote) as varchar)) as key from cl where speaker is not null and text is not null and quote is not null")
def _(spark, d):
    c = G.distinct_claims(_t(spark, d, "claims")).where("speaker is not null and text is not null and quote is not null")
    return c.select("claim_id", T.claim_key(F.col("chunk_id"), F.upper("speaker"), F.col("text"), F.lit(0), F.length("quote")).alias("key"))


@query("f6_f8_f9_keys", "select distinct chunk_id, sha256(doc_sha256 || ':' || cast(chunk_index as varchar) || ':' || text) as id, case when day_no is not null and coalesce(hearing_date, '') <> '' then commission_slug || '-day-' || cast(day_no as varchar) || '-' || hearing_date else commission_slug || '-unknown' end as hearing, doc_sha256 || ':' || cast(page_start as varchar) as page from chunks")
def _(spark, d):
    c = _t(spark, d, "chunks")
    return c.select("chunk_id", F.sha2(F.concat("doc_sha256", F.lit(":"), F.col("chunk_index").cast("string"), F.lit(":"), "text"), 256).alias("id"), T.hearing_key(F.col("commission_slug"), F.col("day_no"), F.col("hearing_date")).alias("hearing"), F.concat("doc_sha256", F.lit(":"), F.col("page_start").cast("string")).alias("page")).distinct()


@query("a21_cost_estimate", "select cast(sum(greatest(1, round_even(length(text) / 3.6, 0)) + 40) as bigint) as input_tokens, count(*) as chunks from (select distinct chunk_id, text from chunks where text is not null)")
def _(spark, d):
    c = _t(spark, d, "chunks").where("text is not null").select("chunk_id", "text").distinct()
    return c.agg(F.sum(T.tokens_estimate(F.col("text")) + 40).alias("input_tokens"), F.count("*").alias("chunks"))


# --- graph queries ------------------------------------------------------------------------------------------------


@query("g3_chunks_by_document", f"with {_DAYS} select doc_sha256, count(distinct chunk_id) as chunks from d group by doc_sha256")
def _(spark, d):
    return _t(spark, d, "chunks").groupBy("doc_sha256").agg(F.countDistinct("chunk_id").alias("chunks"))


@query("g8_provenance", "select distinct c.chunk_id, c.commission_slug, c.day_no, c.doc_sha256, r.url, c.page_start from chunks c left join (select sha256, min(url) as url from registry where sha256 is not null group by sha256) r on r.sha256 = c.doc_sha256")
def _(spark, d):
    r = _t(spark, d, "registry").where("sha256 is not null").groupBy(F.col("sha256").alias("doc_sha256")).agg(F.min("url").alias("url"))
    return G.chunk_days(_t(spark, d, "chunks")).join(r, "doc_sha256", "left").select("chunk_id", "commission_slug", "day_no", "doc_sha256", "url", "page_start").distinct()


@query("g9_recurrence", f"with {_NAMES}, {_DAYS} select n.kind, n.name, count(distinct d.commission_slug) as commissions from n join d on d.chunk_id = n.chunk_id group by all having count(distinct d.commission_slug) > 1")
def _(spark, d):
    n = G.chunk_names(_t(spark, d, "mentions")).join(G.chunk_days(_t(spark, d, "chunks")), "chunk_id")
    return n.groupBy("kind", "name").agg(F.countDistinct("commission_slug").alias("commissions")).where("commissions > 1")


@query("g10_densest_days", f"with {_NAMES}, {_DAYS} select d.commission_slug, d.day_no, count(distinct n.name) as entities, count(*) as mentions from n join d on d.chunk_id = n.chunk_id where d.day_no is not null group by all order by entities desc, commission_slug, day_no limit 15")
def _(spark, d):
    n = G.chunk_names(_t(spark, d, "mentions")).join(G.chunk_days(_t(spark, d, "chunks")), "chunk_id").where("day_no is not null")
    return n.groupBy("commission_slug", "day_no").agg(F.countDistinct("name").alias("entities"), F.count("*").alias("mentions")).orderBy(F.desc("entities"), "commission_slug", "day_no").limit(15)


@query("g11_degrees", f"with {_CLAIMNAMES}, x as (select distinct claim_id, name from cn) select name, count(*) as claims from x group by name order by claims desc, name limit 50")
def _(spark, d):
    return G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct().groupBy("name").agg(F.count("*").alias("claims")).orderBy(F.desc("claims"), "name").limit(50)


@query("g12_dossier", f"with {_CLAIMNAMES}, x as (select name from cn group by name order by count(distinct claim_id) desc, name limit 1) select distinct cl.claim_id, cl.day_no, cl.speaker, coalesce(cl.quote, cl.text) as said from cl join cn on cn.claim_id = cl.claim_id where cn.name = (select name from x) and {_NORM.format('coalesce(cl.speaker, ' + chr(39) * 2 + ')')} <> {_NORM.format('cn.name')}")
def _(spark, d):
    n = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name")
    x = n.groupBy("name").agg(F.countDistinct("claim_id").alias("k")).orderBy(F.desc("k"), "name").limit(1).select("name")
    c = G.distinct_claims(_t(spark, d, "claims")).join(n.join(F.broadcast(x), "name"), "claim_id")
    return c.where(T.normalise(F.coalesce("speaker", F.lit(""))) != T.normalise(F.col("name"))).select("claim_id", "day_no", "speaker", F.coalesce("quote", "text").alias("said")).distinct()


@query("g13_hearing_days", f"with {_DAYS} select commission_slug, day_no, min(hearing_date) as hearing_date from d where day_no is not null and hearing_date <> '' group by all")
def _(spark, d):
    return G.chunk_days(_t(spark, d, "chunks")).where("day_no is not null and hearing_date <> ''").groupBy("commission_slug", "day_no").agg(F.min("hearing_date").alias("hearing_date"))


@query("g16_denials", f"with {_CLAIMNAMES} select cn.name, count(distinct cl.day_no) as days, count(distinct cl.claim_id) as claims, count(distinct cl.claim_id) filter (where {_MODALITY.replace('text', 'cl.text')} = 'deny') as denials from cl join cn on cn.claim_id = cl.claim_id group by cn.name")
def _(spark, d):
    c = G.distinct_claims(_t(spark, d, "claims")).select("claim_id", "day_no", T.modality(F.col("text")).alias("s")).join(G.claim_names(_t(spark, d, "claims")).select("claim_id", "name"), "claim_id")
    return c.groupBy("name").agg(F.countDistinct("day_no").alias("days"), F.countDistinct("claim_id").alias("claims"), F.countDistinct(F.when(F.col("s") == "deny", F.col("claim_id"))).alias("denials"))
