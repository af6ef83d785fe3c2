"""Queries over loads that can be run again, registries, days and totals."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from testimonia.plans.base import _CLAIMNAMES, _DAYS, _MODALITY, _NAMES, _TURNS, _WC, _t, query
from testimonia.plans.parsing import _PAGES
from testimonia.plans.sources import _LATEST
from testimonia.functions import text as T
from testimonia.operators import corpus as C, graph as G, loading as LD, parsing as P
from testimonia.sources import files as S

_ORD = "{'a': discovered_at, 'b': coalesce(sha256, ''), 'c': coalesce(title, ''), 'd': coalesce(notes, '')}"


def _last(c: str, ok: str) -> str:
    return f"(arg_max({{'v': {c}}}, {_ORD}) filter (where {ok})).v as {c}"


_FULL = [_last(c, f"coalesce({c}, '') <> ''") for c in ("title", "hearing_date", "source_page_url")]
_GOT = [_last(c, "coalesce(downloaded, false)") for c in ("sha256", "size_bytes", "filename", "local_path", "content_type", "transcription_method")]
_FIRST = [f"(arg_min({{'v': {c}}}, {_ORD})).v as {c}" for c in ("authoritative", "superseded_by", "discovered_at")]


@query("r3_registry_upsert", f"""select url, {', '.join(_FULL)}, {_last('day_no', 'day_no is not null')}, {_last('source_type', 'true')}, {_last('document_type', 'true')}, {', '.join(_GOT)}, max(cast(coalesce(downloaded, false) as int)) as downloaded, {', '.join(_FIRST)},
 case when max(cast(coalesce(downloaded, false) as int)) = 1 then (arg_max({{'v': notes}}, {_ORD}) filter (where coalesce(downloaded, false))).v else (arg_max({{'v': notes}}, {_ORD}) filter (where coalesce(notes, '') <> '')).v end as notes from registry group by url""")
def _(spark, d):
    return LD.upserted_registry(_t(spark, d, "registry"))


_S = "s as (select surface_id, min(surface) as surface from surfaces where surface is not null group by surface_id)"


def _halves(spark, d):
    """A table that holds every second key, and rows of all keys that come in."""
    s = _t(spark, d, "surfaces").where("surface is not null").select("surface_id", "surface")
    old = s.where("surface_id % 2 = 0").groupBy("surface_id").agg(F.min("surface").alias("surface"))
    return old, s.withColumn("surface", F.concat("surface", F.lit("*")))


@query("r1_first_write", f"with {_S} select surface_id, case when surface_id % 2 = 0 then surface else surface || '*' end as surface from s")
def _(spark, d):
    return G.first_write_wins(*_halves(spark, d), ["surface_id"], "surface")


@query("r2_k3_last_write", "select surface_id, max(surface || '*') as surface from surfaces where surface is not null group by surface_id")
def _(spark, d):
    return G.last_write_wins(*_halves(spark, d), ["surface_id"], "surface")


_STORED = "sd as (select doc_sha256, count(distinct chunk_id) as stored from chunks where commission_slug = 'harrow' or chunk_index % 2 = 0 group by doc_sha256)"
_ACTIONS = f"""{_STORED}, ke as (select doc_sha256, count(distinct chunk_id) as chunks from chunks group by doc_sha256), rs as (select sha256, max(coalesce(superseded_by, '')) as s from registry where sha256 is not null group by sha256),
ac as (select ke.doc_sha256, ke.chunks, coalesce(sd.stored, 0) as stored, case when rs.sha256 is null then 'no_source' when rs.s <> '' then 'superseded' when coalesce(sd.stored, 0) = ke.chunks then 'skip' else 'load' end as action from ke left join sd on sd.doc_sha256 = ke.doc_sha256 left join rs on rs.sha256 = ke.doc_sha256)"""


def _actions(spark, d):
    c, r = _t(spark, d, "chunks"), _t(spark, d, "registry")
    return LD.load_actions(c, c.where("commission_slug = 'harrow' or chunk_index % 2 = 0"), r.select(F.col("sha256").alias("doc_sha256"), "superseded_by"))


@query("r4_load_actions", f"with {_ACTIONS} select * from ac")
def _(spark, d):
    return _actions(spark, d)


@query("a14_load_counters", f"with {_ACTIONS} select {', '.join(f'''count(*) filter (where action = '{a}') as docs_{a}''' for a in ('load', 'skip', 'superseded', 'no_source'))}, cast(coalesce(sum(chunks) filter (where action = 'load'), 0) as bigint) as chunks_loaded, cast(coalesce(sum(stored) filter (where action = 'superseded'), 0) as bigint) as points_purged from ac")
def _(spark, d):
    return LD.load_counters(_actions(spark, d))


@query("k5_purged_points", "select distinct chunk_id from chunks where doc_sha256 not in (select sha256 from registry where sha256 is not null and coalesce(superseded_by, '') <> '')")
def _(spark, d):
    gone = _t(spark, d, "registry").where("sha256 is not null and coalesce(superseded_by, '') <> ''").select(F.col("sha256").alias("doc_sha256"))
    return LD.purged(_t(spark, d, "chunks").select("chunk_id", "doc_sha256").distinct(), gone, "doc_sha256").select("chunk_id")


@query("r8_new_or_known", "select url, not bool_or(coalesce(downloaded, false)) as is_new from registry group by url")
def _(spark, d):
    r = _t(spark, d, "registry")
    return LD.with_known(r.select("url"), r.where("downloaded"))


@query("r7_budget", "with c as (select chunk_id, min(length(text)) as n from chunks where text is not null group by chunk_id), r as (select chunk_id, n, sum(n) over (order by chunk_id rows between unbounded preceding and 1 preceding) as spent from c) select chunk_id, cast(coalesce(spent, 0) as bigint) as spent from r where coalesce(spent, 0) < 100000")
def _(spark, d):
    c = _t(spark, d, "chunks").where("text is not null").groupBy("chunk_id").agg(F.min(F.length("text").cast("long")).alias("n"))
    return LD.within_budget(c, "chunk_id", "n", 100000, 64).select("chunk_id", F.col("spent").cast("long").alias("spent"))


@query("r9_first_days", f"with {_NAMES}, {_DAYS} select n.kind, n.name, min(d.day_no) as first_day from n join d on d.chunk_id = n.chunk_id group by all")
def _(spark, d):
    n = G.chunk_names(_t(spark, d, "mentions")).join(G.chunk_days(_t(spark, d, "chunks")), "chunk_id")
    return LD.first_seen(n, ["kind", "name"], "day_no")


@query("r9_new_ties", f"with {_CLAIMNAMES}, x as (select distinct claim_id, name from cn), p as (select a.name as name_a, b.name as name_b, min(cl.day_no) as first_day, count(distinct cl.claim_id) as claims from x a join x b on a.claim_id = b.claim_id and a.name < b.name join cl on cl.claim_id = a.claim_id group by all) select * from p where first_day >= 100")
def _(spark, d):
    """Pairs of names in one claim that no claim before the day had."""
    c = _t(spark, d, "claims").select("claim_id", "day_no").distinct()
    n = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct()
    pairs = n.groupBy("claim_id").agg(F.sort_array(F.collect_set("name")).alias("ns")).select("claim_id", F.posexplode("ns").alias("i", "name_a"), "ns").select("claim_id", "name_a", F.explode(F.expr("slice(ns, i + 2, size(ns))")).alias("name_b"))
    return pairs.join(c, "claim_id").groupBy("name_a", "name_b").agg(F.min("day_no").alias("first_day"), F.countDistinct("claim_id").alias("claims")).where("first_day >= 100")


@query("r9_new_denials", f"with {_CLAIMNAMES} select cn.name, count(distinct cl.claim_id) as denials from cl join cn on cn.claim_id = cl.claim_id where cl.day_no >= 100 and {_MODALITY.replace('text', 'cl.text')} = 'deny' group by cn.name")
def _(spark, d):
    c = _t(spark, d, "claims").where("day_no >= 100").select("claim_id", T.modality(F.col("text")).alias("s")).distinct().where("s = 'deny'")
    return G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct().join(c, "claim_id").groupBy("name").agg(F.countDistinct("claim_id").alias("denials"))


@query("a11_reconciliation", f"""with {_PAGES}, rg as (select distinct sha256, day_no from registry where downloaded and coalesce(local_path, '') <> '' and coalesce(superseded_by, '') = '' and sha256 is not null and document_type = 'Transcript'),
q as (select (select count(distinct p.doc_id) from p where doc_id in (select sha256 from rg)) as documents, (select count(distinct (doc_id, page_no)) from pages where doc_id in (select sha256 from rg)) as pages),
e as (select (select count(distinct sha256) from rg) as documents, (select count(distinct (doc_id, page_no)) from pages where doc_id in (select sha256 from rg) and char_count > 0) as pages)
select 'documents' as what, q.documents as parsed, e.documents as expected from q, e where q.documents is distinct from e.documents union all select 'pages', q.pages, e.pages from q, e where q.pages is distinct from e.pages""")
def _(spark, d):
    """Documents with running text against the active transcripts, and their pages against those that say they have characters."""
    pages, r = _t(spark, d, "pages"), C.active(_t(spark, d, "registry")).where("document_type = 'Transcript'").select(F.col("sha256").alias("doc_id")).distinct()
    mine = pages.join(r, "doc_id", "left_semi")
    key = F.countDistinct("doc_id", "page_no")
    parsed = P.surviving_lines(mine).agg(F.countDistinct("doc_id").alias("documents")).crossJoin(mine.agg(key.alias("pages")))  # one row each
    expected = r.agg(F.count("*").alias("documents")).crossJoin(mine.where("char_count > 0").agg(key.alias("pages")))
    return LD.reconciled(parsed, expected)


@query("x11_recovered", "with c as (select distinct chunk_id, chunk_index from chunks) select case when chunk_index % 4 = 0 then 'already' when chunk_index % 3 = 1 then 'not_succeeded' when chunk_index % 5 = 0 then 'unparseable' else 'recovered' end as outcome, count(*) as results from c group by 1")
def _(spark, d):
    c = _t(spark, d, "chunks").select("chunk_id", "chunk_index").distinct()
    results = c.select("chunk_id", F.when(F.col("chunk_index") % 3 == 1, "errored").otherwise("succeeded").alias("kind"), (F.col("chunk_index") % 5 != 0).alias("ok"))
    return LD.recovered(results, c.where("chunk_index % 4 = 0")).groupBy("outcome").agg(F.count("*").alias("results"))


# --- registry and discovery --------------------------------------------------------------------------------------------------


@query("p1_registry_filter", f"with {_LATEST} select url, source_type from lt where commission_slug = 'tolwane' and source_type = 'transcript'")
def _(spark, d):
    return C.registry_filter(C.latest_per_url(_t(spark, d, "registry")), commission_slug="tolwane", source_type="transcript").select("url", "source_type")


@query("p16_download_pending", f"with {_LATEST} select url, case when source_type = 'video' then 'video' when downloaded then 'downloaded' when coalesce(starts_with(notes, 'Missing at source:'), false) then 'missing' else 'pending' end as state from lt where commission_slug in ('harrow', 'tolwane')")
def _(spark, d):
    return C.download_states(C.latest_per_url(_t(spark, d, "registry")).where("commission_slug in ('harrow', 'tolwane')")).select("url", "state")


@query("a29_discovery_stats", f"with {_LATEST} select commission_slug, count(*) as found, count(*) filter (where downloaded) as downloaded, count(*) filter (where source_type = 'video') as videos, count(*) filter (where not coalesce(downloaded, false) and source_type <> 'video') as pending from lt group by 1")
def _(spark, d):
    r = C.latest_per_url(_t(spark, d, "registry"))
    one = lambda x: F.count(F.when(x, 1))
    return r.groupBy("commission_slug").agg(F.count("*").alias("found"), one(F.col("downloaded")).alias("downloaded"), one(F.col("source_type") == "video").alias("videos"), one(~F.coalesce("downloaded", F.lit(False)) & (F.col("source_type") != "video")).alias("pending"))


@query("o4_w9_union_first_seen", "with u as (select url, 1 as o, filename from registry where commission_slug = 'tolwane' union all select url, 2, filename from registry) select url, min(o) as source_no from u group by url")
def _(spark, d):
    """Two sources united, the first to bring an url keeps it."""
    r = _t(spark, d, "registry")
    u = r.where("commission_slug = 'tolwane'").select("url", F.lit(1).alias("source_no")).unionByName(r.select("url", F.lit(2).alias("source_no")))
    return S.first_per_key(u, ["url"], ["source_no"])


@query("x4_video_registration", "select url, coalesce(nullif((arg_max({'v': title}, {'a': discovered_at, 't': coalesce(title, '')})).v, ''), 'Hearing video') as title, 'Video' as document_type, false as authoritative from registry where source_type = 'video' group by url")
def _(spark, d):
    v = _t(spark, d, "registry").where("source_type = 'video'").groupBy("url").agg(F.max_by(F.struct("title"), F.struct("discovered_at", F.coalesce("title", F.lit("")).alias("t"))).alias("t"))
    return v.select("url", F.coalesce(F.nullif(F.col("t.title"), F.lit("")), F.lit("Hearing video")).alias("title"), F.lit("Video").alias("document_type"), F.lit(False).alias("authoritative"))


@query("x5_pending_captions", f"with {_LATEST}, v as (select url, day_no, sha256 from lt where source_type = 'video' order by day_no asc nulls last, url limit 25) select url, case when sha256 is null then 'fetch' when sha256 in (select doc_id from cues) then 'skip' else 'failed' end as action from v")
def _(spark, d):
    """The first 25 videos by day, days that are not known last; the limit comes before what is skipped."""
    v = C.latest_per_url(_t(spark, d, "registry")).where("source_type = 'video'").orderBy(F.col("day_no").asc_nulls_last(), "url").limit(25).select("url", "sha256")
    has = _t(spark, d, "cues").select(F.col("doc_id").alias("sha256")).distinct().withColumn("_c", F.lit(True))
    return v.join(has, "sha256", "left").select("url", F.when(F.col("sha256").isNull(), "fetch").when(F.col("_c"), "skip").otherwise("failed").alias("action"))


@query("l1_l8_documents_by_day", f"with {_LATEST} select url, row_number() over (order by day_no asc nulls last, url) as place from lt where source_type = 'transcript' qualify place <= 50")
def _(spark, d):
    r = C.latest_per_url(_t(spark, d, "registry")).where("source_type = 'transcript'").orderBy(F.col("day_no").asc_nulls_last(), "url").limit(50)
    return r.select("url", F.row_number().over(Window.orderBy(F.col("day_no").asc_nulls_last(), "url")).alias("place"))


@query("x12_o7_day_list", "select distinct c.chunk_id, c.day_no from chunks c where c.day_no in (36, 43, 66, 100, 227)")
def _(spark, d):
    days = F.array_union(T.day_list(F.lit("36, 43,,66 ,")), F.array(F.lit(100), F.lit(227)))
    return _t(spark, d, "chunks").where(F.array_contains(days, F.col("day_no"))).select("chunk_id", "day_no").distinct()


@query("x13_new_records", f"with {_LATEST} select url, sha256, row_number() over (order by url desc) as place from lt where downloaded and url in (select url from registry where commission_slug = 'harrow')")
def _(spark, d):
    """New urls in their order, with what the registry knows of them after the download; unknown ones go."""
    new = _t(spark, d, "registry").where("commission_slug = 'harrow'").select("url").distinct()
    r = C.latest_per_url(_t(spark, d, "registry")).where("downloaded").select("url", "sha256")
    return new.join(r, "url").withColumn("place", F.row_number().over(Window.orderBy(F.desc("url"))))


@query("x16_processed_days", "select distinct chunk_id, cast(day_no as varchar) as hearing_day from chunks where day_no is not null and regexp_matches('day' || lpad(cast(day_no as varchar), cast(greatest(3, length(cast(day_no as varchar))) as int), '0') || '_' || substr(doc_sha256, 1, 16), 'day0*\\d+_')")
def _(spark, d):
    name = F.format_string("day%03d_%s.jsonl", "day_no", F.substring("doc_sha256", 1, 16))
    return _t(spark, d, "chunks").where("day_no is not null").where(name.rlike(r"day0*\d+_")).select("chunk_id", F.col("day_no").cast("string").alias("hearing_day")).distinct()


# --- days and totals ------------------------------------------------------------------------------------------------------------

_DAYPAGES = """dg as (select sha256, min(day_no) as day_no, min(hearing_date) as hearing_date, min(commission_slug) as slug from registry where sha256 is not null group by sha256),
dp as (select p.doc_id, count(distinct page_no) as pages from pages p group by p.doc_id),
ds as (select dg.slug, dg.day_no, min(dg.hearing_date) as hearing_date, cast(sum(dp.pages) as bigint) as pages, count(*) as docs from dp join dg on dg.sha256 = dp.doc_id where dg.day_no is not null group by all)"""


def _day_pages(spark, d):
    g = _t(spark, d, "registry").where("sha256 is not null").groupBy(F.col("sha256").alias("doc_id")).agg(F.min("day_no").alias("day_no"), F.min("hearing_date").alias("hearing_date"), F.min("commission_slug").alias("slug"))
    p = _t(spark, d, "pages").groupBy("doc_id").agg(F.countDistinct("page_no").alias("pages"))
    return p.join(g, "doc_id").where("day_no is not null").groupBy("slug", "day_no").agg(F.min("hearing_date").alias("hearing_date"), F.sum("pages").alias("pages"), F.count("*").alias("docs"))


@query("a9_a10_outlier_days", f"with {_DAYPAGES}, m as (select median(pages) as m from ds) select slug, day_no, pages, docs, docs > 1 as several, pages > 1.5 * m.m as outlier from ds cross join m")
def _(spark, d):
    s = _day_pages(spark, d)
    m = s.agg(F.median("pages").alias("m"))
    return s.crossJoin(F.broadcast(m)).select("slug", "day_no", "pages", "docs", (F.col("docs") > 1).alias("several"), (F.col("pages") > 1.5 * F.col("m")).alias("outlier"))  # one row


@query("l2_marathon_days", f"with {_DAYPAGES}, {_TURNS}, w as (select dg.slug, dg.day_no, t.speaker, count(*) as n from t join dg on dg.sha256 = t.doc_id where t.speaker like '%WITNESS%' group by all), x as (select slug, day_no, arg_max(speaker, {{'n': n, 's': speaker}}) as who from w group by all) select ds.slug, ds.day_no, ds.pages, coalesce(x.who, 'legal argument') as label from ds left join x on x.slug = ds.slug and x.day_no = ds.day_no order by pages desc, slug, ds.day_no limit 10")
def _(spark, d):
    g = _t(spark, d, "registry").where("sha256 is not null").groupBy(F.col("sha256").alias("doc_id")).agg(F.min("day_no").alias("day_no"), F.min("commission_slug").alias("slug"))
    top = _day_pages(spark, d).orderBy(F.desc("pages"), "slug", "day_no").limit(10)
    w = C.clean_turns(_t(spark, d, "turns")).where("speaker like '%WITNESS%'").join(g, "doc_id").groupBy("slug", "day_no", "speaker").agg(F.count("*").alias("n"))
    who = w.groupBy("slug", "day_no").agg(F.max_by("speaker", F.struct("n", "speaker")).alias("who"))
    return top.join(who, ["slug", "day_no"], "left").select("slug", "day_no", "pages", F.coalesce("who", F.lit("legal argument")).alias("label"))


@query("w2_cumulative_pages", rf"with {_DAYPAGES}, v as (select try_strptime(hearing_date, '%Y-%m-%d')::date as d, slug, day_no, pages from ds where regexp_full_match(hearing_date, '\d{{4}}-\d{{2}}-\d{{2}}')) select d, slug, day_no, cast(sum(pages) over (order by d, day_no, slug rows unbounded preceding) as bigint) as running from v where d is not null")
def _(spark, d):
    s = _day_pages(spark, d).where(r"hearing_date rlike '^\\d{4}-\\d{2}-\\d{2}$'").withColumn("d", F.expr("try_to_date(hearing_date, 'yyyy-MM-dd')")).where("d is not null")
    w = Window.orderBy("d", "day_no", "slug").rowsBetween(Window.unboundedPreceding, 0)  # one row per hearing day
    return s.select("d", "slug", "day_no", F.sum("pages").over(w).alias("running"))


@query("a5_corpus_totals", f"with {_TURNS} select (select count(distinct doc_id) from t) as documents, (select count(distinct day_no) from registry where sha256 in (select doc_id from t)) as days, (select count(distinct speaker) from t where speaker <> '') as labels, (select count(distinct (doc_id, page_no)) from pages where doc_id in (select doc_id from t)) as pages, (select count(*) from t) as turns, (select cast(sum({_WC}) as bigint) from t) as words")
def _(spark, d):
    t = C.clean_turns(_t(spark, d, "turns")).select("doc_id", "speaker", T.word_count(F.col("text")).alias("n"))
    docs = t.select("doc_id").distinct()
    a = t.agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct(F.when(F.col("speaker") != "", F.col("speaker"))).alias("labels"), F.count("*").alias("turns"), F.sum(F.col("n").cast("long")).alias("words"))
    b = _t(spark, d, "registry").join(docs.withColumnRenamed("doc_id", "sha256"), "sha256", "left_semi").agg(F.countDistinct("day_no").alias("days"))
    c = _t(spark, d, "pages").join(docs, "doc_id", "left_semi").agg(F.countDistinct("doc_id", "page_no").alias("pages"))
    return a.crossJoin(b).crossJoin(c)  # one row each


@query("p18_w5_tempo", f"with {_TURNS}, w as (select doc_id, median({_WC}) as m, count(*) as n from t group by doc_id having count(*) >= 50), v as (select w.*, min(g.hearing_date) as hd from w join registry g on g.sha256 = w.doc_id where regexp_full_match(g.hearing_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') group by all) select doc_id, hd as hearing_date, m as median_words, avg(m) over (order by hd, doc_id rows between 4 preceding and current row) as mean5 from v")
def _(spark, d):
    """The median length of a turn by hearing, for hearings of 50 turns or more, and its mean over five hearings in a row."""
    t = C.clean_turns(_t(spark, d, "turns")).groupBy("doc_id").agg(F.median(T.word_count(F.col("text"))).alias("median_words"), F.count("*").alias("n")).where("n >= 50")
    g = _t(spark, d, "registry").where(r"hearing_date rlike '^\\d{4}-\\d{2}-\\d{2}$'").groupBy(F.col("sha256").alias("doc_id")).agg(F.min("hearing_date").alias("hearing_date"))
    w = Window.orderBy("hearing_date", "doc_id").rowsBetween(-4, 0)  # one row per hearing
    return t.join(g, "doc_id").select("doc_id", "hearing_date", "median_words", F.avg("median_words").over(w).alias("mean5"))


@query("a13_note_prefixes", f"with {_LATEST} select commission_slug, coalesce(nullif(split_part(notes, ':', 1), ''), 'none') as status, count(*) as records from lt group by all")
def _(spark, d):
    """Records by what their notes say before the colon."""
    r = C.latest_per_url(_t(spark, d, "registry"))
    return r.groupBy("commission_slug", F.coalesce(F.nullif(F.substring_index("notes", ":", 1), F.lit("")), F.lit("none")).alias("status")).agg(F.count("*").alias("records"))
