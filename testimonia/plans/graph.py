"""Queries of the graph and of the vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from testimonia.plans.base import _CLAIMNAMES, _DAYS, _FORMS, _INDEX, _LATEST_SHA, _MODALITY, _NAMES, _NORM, _STRIP, _t, query
from testimonia.functions import text as T
from testimonia.operators import graph as G

def _joined(c: str, sep: str = " | "):
    return F.coalesce(F.array_join(F.sort_array(c), sep), F.lit("")).alias(c)


def _list(kind: str) -> str:
    return f"coalesce(string_agg(name, ' | ' order by name) filter (where kind = '{kind}'), '') as {kind}s"


# --- served rows --------------------------------------------------------------------------------------------------------------


@query("g1_neighbourhood", f"""with {_NAMES}, ck as (select chunk_id, any_value(doc_sha256) as sha, any_value(day_no) as day_no, any_value(hearing_date) as hearing_date, any_value(page_start) as page_start, any_value(speakers) as sps from chunks group by chunk_id), {_LATEST_SHA},
p as (select chunk_id, {_list('person')}, {_list('org')}, {_list('place')} from n group by chunk_id), c as (select chunk_id, string_agg(distinct claim_id || '/' || coalesce(speaker, '?'), ' | ' order by claim_id || '/' || coalesce(speaker, '?')) as claims from claims group by chunk_id)
select ck.chunk_id, ck.day_no, ck.hearing_date, ck.page_start, rl.url, rl.document_type, coalesce(p.persons, '') as persons, coalesce(p.orgs, '') as orgs, coalesce(p.places, '') as places, coalesce(array_to_string(list_sort(list_distinct(ck.sps)), ' | '), '') as speakers, coalesce(c.claims, '') as claims
from ck left join rl on rl.sha256 = ck.sha left join p on p.chunk_id = ck.chunk_id left join c on c.chunk_id = ck.chunk_id""")
def _(spark, d):
    n = G.neighbourhoods(*_t(spark, d, "chunks", "mentions", "claims", "registry"))
    said = F.transform("claims", lambda x: F.concat(x["claim_id"], F.lit("/"), F.coalesce(x["speaker"], F.lit("?"))))
    return n.withColumn("claims", said).select("chunk_id", "day_no", "hearing_date", "page_start", "url", "document_type", *[_joined(c) for c in ("persons", "orgs", "places", "speakers", "claims")])


@query("g2_claim_detail", f"""with {_CLAIMNAMES}, c as (select distinct claim_id, status, speaker, speaker_unresolved, certainty, attribution, coalesce(quote, text) as said, chunk_id, source_url from claims), m as (select claim_id, string_agg(distinct name || ' (' || coalesce(role, '?') || ')', ' | ' order by name || ' (' || coalesce(role, '?') || ')') as mentions from cn group by claim_id),
k as (select chunk_id, any_value(day_no) as day_no, any_value(page_start) as page_start, any_value(commission_slug) as slug from chunks group by chunk_id) select c.*, k.day_no, k.page_start, k.slug, coalesce(m.mentions, '') as mentions from c left join k on k.chunk_id = c.chunk_id left join m on m.claim_id = c.claim_id""")
def _(spark, d):
    c = G.claim_details(*_t(spark, d, "claims", "chunks"))
    return c.withColumn("mentions", F.transform("mentions", lambda x: F.concat(x["name"], F.lit(" ("), F.coalesce(x["role"], F.lit("?")), F.lit(")")))).select("claim_id", "status", "speaker", "speaker_unresolved", "certainty", "attribution", "said", "chunk_id", "source_url", "day_no", "page_start", F.col("commission_slug").alias("slug"), _joined("mentions"))


@query("g17_ping", "select 1 as ok")
def _(spark, d):
    return spark.range(1).select(F.lit(1).alias("ok"))


@query("s16_points_by_document", "select doc_sha256, chunk_id, row_number() over (partition by doc_sha256 order by chunk_id) as place from (select distinct doc_sha256, chunk_id from chunks where doc_sha256 in (select sha256 from registry where commission_slug = 'tolwane')) ")
def _(spark, d):
    """Points of the documents of one commission, in the order in which they are paged through."""
    from pyspark.sql import Window

    r = _t(spark, d, "registry").where("commission_slug = 'tolwane'").select(F.col("sha256").alias("doc_sha256")).distinct()
    c = _t(spark, d, "chunks").select("doc_sha256", "chunk_id").distinct().join(r, "doc_sha256", "left_semi")
    return c.withColumn("place", F.row_number().over(Window.partitionBy("doc_sha256").orderBy("chunk_id")))


# --- pairs and hops -----------------------------------------------------------------------------------------------------------

_PAIRS = "select a.name as name_a, b.name as name_b, count(*) as chunks from m a join m b on a.chunk_id = b.chunk_id and a.name < b.name group by all"


@query("j11_comentions", f"with {_NAMES}, m as (select distinct chunk_id, name from n where kind = 'person') {_PAIRS} having count(*) >= 2")
def _(spark, d):
    return G.pair_counts(G.chunk_names(_t(spark, d, "mentions"), ("person",)), "chunk_id", "name").withColumnRenamed("n", "chunks").where("chunks >= 2")


@query("g7_top_pairs", f"with {_NAMES}, m as (select distinct chunk_id, name from n) {_PAIRS} order by chunks desc, name_a, name_b limit 20")
def _(spark, d):
    return G.pair_counts(G.chunk_names(_t(spark, d, "mentions")), "chunk_id", "name").withColumnRenamed("n", "chunks").orderBy(F.desc("chunks"), "name_a", "name_b").limit(20)


@query("g4_people_with_body", f"with {_NAMES} select a.name, count(*) as co_mentions from n a join n b on a.chunk_id = b.chunk_id where a.kind = 'person' and b.kind = 'org' and contains(lower(b.name), 'housing') group by a.name")
def _(spark, d):
    return G.people_with(G.chunk_names(_t(spark, d, "mentions")), "Housing")


@query("g5_speaker_labels", f"with {_FORMS}, {_INDEX}, sp as (select distinct chunk_id, speaker, {_NORM.format('speaker')} as fm, {_STRIP.format(_NORM.format('speaker'))} as st from (select chunk_id, unnest(speakers) as speaker from chunks) where speaker is not null) select coalesce(e.name, sp.speaker) as name, sp.speaker as label, count(distinct chunk_id) as chunks from sp left join a on a.type_group = 'person' and a.form = sp.fm left join b on b.type_group = 'person' and b.form = sp.st left join entities e on e.entity_id = coalesce(a.entity_id, b.entity_id) group by all")
def _(spark, d):
    return G.speaker_labels(*_t(spark, d, "chunks", "entities"))


@query("g6_places_by_day", f"with {_NAMES}, {_DAYS}, h as (select n.name, d.* from n join d on d.chunk_id = n.chunk_id where kind = 'place') select commission_slug, day_no, name as place, 'page' as path, count(*) as chunks from h where day_no is not null and page_start is not null group by all union all select commission_slug, day_no, name, 'document', count(*) from h where day_no is not null and page_start is null group by all")
def _(spark, d):
    """Places of a hearing's passages, over their pages, and over the document where a passage has no page."""
    n = G.chunk_names(_t(spark, d, "mentions"), ("place",)).join(G.chunk_days(_t(spark, d, "chunks")), "chunk_id").where("day_no is not null")
    path = lambda x, p: n.where(x).groupBy("commission_slug", "day_no", F.col("name").alias("place")).agg(F.count("*").alias("chunks")).withColumn("path", F.lit(p))
    return path("page_start is not null", "page").unionByName(path("page_start is null", "document"))


_TIES = "ti as (select a.name as name_a, b.name as name_b, count(*) as n from x a join x b on a.claim_id = b.claim_id and a.name < b.name group by all)"


@query("g11_f28_ties", f"with {_CLAIMNAMES}, x as (select distinct claim_id, name from cn), dg as (select name, count(*) as deg from x group by name order by deg desc, name limit 50), {_TIES} select name_a, name_b, n as claims, ln(1 + n) as weight from ti where name_a in (select name from dg) and name_b in (select name from dg) order by n desc, name_a, name_b limit 1400")
def _(spark, d):
    """Ties among the fifty names with the most claims, the strongest 1,400, with their weights."""
    x = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct()
    top = x.groupBy("name").agg(F.count("*").alias("deg")).orderBy(F.desc("deg"), "name").limit(50).select("name")
    t = G.pair_counts(x.join(F.broadcast(top), "name"), "claim_id", "name").withColumnRenamed("n", "claims")  # fifty names
    return t.withColumn("weight", F.log1p("claims")).orderBy(F.desc("claims"), "name_a", "name_b").limit(1400)


@query("g11_f29_sizes", f"with {_CLAIMNAMES}, x as (select distinct claim_id, name from cn), dg as (select name, count(*) as deg from x group by name order by deg desc, name limit 50) select name, deg, 0.30::double + 0.95 * pow(1 - deg / max(deg) over ()::double, 1.4) as scale from dg")
def _(spark, d):
    x = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct()
    top = x.groupBy("name").agg(F.count("*").alias("deg")).orderBy(F.desc("deg"), "name").limit(50)
    return top.crossJoin(top.agg(F.max("deg").alias("m"))).select("name", "deg", (F.lit(0.30) + 0.95 * F.pow(1 - F.col("deg") / F.col("m"), F.lit(1.4))).alias("scale"))  # one row


_CENTRE = "ce as (select name from cn group by name order by count(distinct claim_id) desc, name limit 1)"


def _centre(spark, d):
    n = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct()
    return n, n.groupBy("name").agg(F.countDistinct("claim_id").alias("k")).orderBy(F.desc("k"), "name").limit(1).select("name")


@query("g12_statements", f"with {_CLAIMNAMES}, {_CENTRE} select distinct cl.claim_id, cl.day_no, coalesce(cl.quote, cl.text) as said from cl where {_NORM.format('cl.speaker')} = (select {_NORM.format('name')} from ce)")
def _(spark, d):
    _, c = _centre(spark, d)
    cl = _t(spark, d, "claims").select("claim_id", "day_no", "speaker", F.coalesce("quote", "text").alias("said")).distinct()
    return cl.join(F.broadcast(c), T.normalise(F.col("speaker")) == T.normalise(F.col("name"))).select("claim_id", "day_no", "said")  # one row


@query("g12_links", f"with {_CLAIMNAMES}, {_CENTRE} select b.name, count(distinct b.claim_id) as claims from cn a join cn b on a.claim_id = b.claim_id where a.name = (select name from ce) and b.name <> (select name from ce) group by b.name order by claims desc, b.name limit 30")
def _(spark, d):
    n, c = _centre(spark, d)
    mine = n.join(F.broadcast(c), "name", "left_semi").select("claim_id").distinct()  # one row
    other = n.join(mine, "claim_id", "left_semi").join(F.broadcast(c), "name", "left_anti")
    return other.groupBy("name").agg(F.countDistinct("claim_id").alias("claims")).orderBy(F.desc("claims"), "name").limit(30)


@query("g14_communities")
def _(spark, d):
    x = G.claim_names(_t(spark, d, "claims")).select("claim_id", "name").distinct()
    return G.communities(G.pair_counts(x, "claim_id", "name"))


_EGO = f"""ce as (select name from m group by name order by count(*) desc, name limit 1), eg as (select chunk_id from m where name = (select name from ce)),
nb as (select name, count(*) as shared from m where chunk_id in (from eg) and name <> (select name from ce) group by name having count(*) >= 2)"""


@query("g15_l4_ego_network", f"with {_NAMES}, m as (select distinct chunk_id, name from n where kind <> 'place'), {_EGO}, tp as (select name from nb order by shared desc, name limit 40), fr as (select m.name, count(*) as k from m where name in (from tp) group by m.name), kp as (select name from fr where k >= 3) select a.name as name_a, b.name as name_b, count(*) as chunks from m a join m b on a.chunk_id = b.chunk_id and a.name < b.name where a.name in (from kp) and b.name in (from kp) group by all")
def _(spark, d):
    """Neighbours of the most frequent name: the first forty by shared passages, of these the ones in three passages or more, and the pairs among them."""
    m = G.chunk_names(_t(spark, d, "mentions"), ("person", "org")).select("chunk_id", "name").distinct()
    return G.ego_pairs(m, least_shared=2, top=40, least_chunks=3).withColumnRenamed("n", "chunks")


@query("g16_day_proportion", "select commission_slug, day_no, count(distinct chunk_id) filter (where contains(lower(text), 'invoice')) / count(distinct chunk_id)::double as proportion from chunks where day_no is not null group by all")
def _(spark, d):
    return G.daily_hits(_t(spark, d, "chunks"), "invoice").select("commission_slug", "day_no", (F.col("hits") / F.col("total")).alias("proportion"))


@query("a24_surge_by_day", f"with {_DAYS}, h as (select distinct chunk_id from chunks where lower(text) like '%payment%') select d.commission_slug, d.day_no, count(distinct d.chunk_id) as total, count(distinct h.chunk_id) as hits from d left join h on h.chunk_id = d.chunk_id where d.day_no is not null group by all")
def _(spark, d):
    return G.daily_hits(_t(spark, d, "chunks"), "payment")


# --- names and stances --------------------------------------------------------------------------------------------------------

_STANCE = f"m as (select distinct cn.claim_id, cn.name, {_MODALITY.replace('text', 'cl.text')} as stance from cn join cl on cl.claim_id = cn.claim_id)"


@query("a25_stance_labels", f"with {_CLAIMNAMES}, {_STANCE}, s as (select name, count(*) filter (where stance = 'assert') as asserts, count(*) filter (where stance = 'deny') as denials, count(*) filter (where stance = 'question') as questions from m group by name), e as (select distinct {_NORM.format('name')} as fm from entities where entity_type = 'org') select s.*, case when {_NORM.format('s.name')} in (select fm from e) then 'ownership' when denials >= 5 then 'contested' when questions > asserts then 'questioned' else 'asserted' end as label from s")
def _(spark, d):
    return G.stance_labels(*_t(spark, d, "claims", "entities"))


@query("a26_unresolved_surfaces", f"""with {_FORMS}, {_INDEX}, {_DAYS}, s as (select distinct surface_id, chunk_id, lower(entity_type) as type_group, {_NORM.format("surface")} as form from surfaces where surface is not null)
select s.type_group, s.form, count(distinct s.surface_id) as n, count(distinct d.day_no) as days from s left join a on a.type_group = s.type_group and a.form = s.form left join b on b.type_group = s.type_group and b.form = {_STRIP.format("s.form")} left join d on d.chunk_id = s.chunk_id where a.entity_id is null and b.entity_id is null and s.form <> '' group by all having count(distinct s.surface_id) >= 2""")
def _(spark, d):
    return G.unresolved_surfaces(*_t(spark, d, "surfaces", "entities", "chunks"))


@query("j17_t15_alias_proposals", f"""with {_FORMS}, {_INDEX}, {_DAYS}, s as (select distinct surface_id, chunk_id, lower(entity_type) as type_group, {_NORM.format("surface")} as form from surfaces where surface is not null),
u as (select s.type_group, s.form, count(distinct s.surface_id) as n from s left join a on a.type_group = s.type_group and a.form = s.form left join b on b.type_group = s.type_group and b.form = {_STRIP.format("s.form")} left join d on d.chunk_id = s.chunk_id where a.entity_id is null and b.entity_id is null and s.form <> '' group by all having count(distinct s.surface_id) >= 2),
ot as (select type_group, tok, count(distinct entity_id) as owners, min(entity_id) as one from (select type_group, entity_id, unnest(string_split(form, ' ')) as tok from b0) group by all),
p as (select *, {_STRIP.format('form')} as bare from u where type_group = 'person'), q as (select *, list_last(string_split(bare, ' ')) as tok from p where bare <> '')
select q.type_group, q.form, q.n, q.tok as anchor, case when ot.owners = 1 then ot.one when ot.owners > 1 then 'AMBIGUOUS:' || q.tok else 'NEW:' || q.tok end as proposal, not contains(bare, ' ') as bare_only from q left join ot on ot.type_group = 'person' and ot.tok = q.tok
union all select type_group, form, n, coalesce(list_filter(string_split(form, ' '), lambda x: length(x) > 2 and x not in {tuple(sorted(G.ORG_STOP))})[1], form), 'NEW:' || coalesce(list_filter(string_split(form, ' '), lambda x: length(x) > 2 and x not in {tuple(sorted(G.ORG_STOP))})[1], form), false from u where type_group = 'org'""")
def _(spark, d):
    return G.alias_proposals(*_t(spark, d, "surfaces", "entities", "chunks"))


@query("a27_claims_about", f"with {_CLAIMNAMES}, {_CENTRE} select {_NORM.format('cl.speaker')} as speaker, count(distinct cl.claim_id) as claims from cl join cn on cn.claim_id = cl.claim_id where cn.name = (select name from ce) and cl.speaker is not null and trim(cl.speaker) <> '' group by 1")
def _(spark, d):
    """Who makes claims about the name that most claims are about."""
    n, c = _centre(spark, d)
    mine = n.join(F.broadcast(c), "name", "left_semi").select("claim_id").distinct()  # one row
    return _t(spark, d, "claims").where("speaker is not null and trim(speaker) <> ''").join(mine, "claim_id", "left_semi").groupBy(T.normalise(F.col("speaker")).alias("speaker")).agg(F.countDistinct("claim_id").alias("claims"))


@query("f2_loose_resolution", r"with lf as (select trim(regexp_replace(upper(f), '[^A-Z0-9]+', ' ', 'g')) as form, max(entity_id) as entity_id from (select entity_id, unnest(list_concat([name], coalesce(aliases, []))) as f from entities) where trim(regexp_replace(upper(f), '[^A-Z0-9]+', ' ', 'g')) <> '' group by 1), s as (select distinct surface_id, trim(regexp_replace(upper(coalesce(surface, '')), '[^A-Z0-9]+', ' ', 'g')) as form from surfaces) select s.surface_id, s.form, lf.entity_id from s left join lf on lf.form = s.form")
def _(spark, d):
    """The loose lookup: no types, no hyphens, no ambiguity; of several owners of a form the last one is taken."""
    s, e = _t(spark, d, "surfaces", "entities")
    return G.loosely_resolved(s.select("surface_id", "surface").distinct(), e).select("surface_id", "form", "entity_id")


@query("f30_roles_from_notes", "select distinct entity_id, case when entity_type = 'org' then 'org' when contains(lower(coalesce(note, '')), 'chairperson') or contains(lower(coalesce(note, '')), 'bench') or contains(lower(coalesce(note, '')), 'presides') then 'bench' when contains(lower(coalesce(note, '')), 'evidence leader') or contains(lower(coalesce(note, '')), 'counsel') then 'counsel' else 'witness' end as role from entities")
def _(spark, d):
    return _t(spark, d, "entities").select("entity_id", G.role_of_note(F.col("entity_type"), F.col("note")).alias("role")).distinct()


@query("t12_alias_collisions", f"with {_FORMS} select type_group, form, count(distinct entity_id) as owners from f group by all having count(distinct entity_id) > 1")
def _(spark, d):
    from testimonia.sources.files import alias_collisions

    return alias_collisions(G.alias_forms(_t(spark, d, "entities")))


@query("s18_gazetteer", f"with {_FORMS}, {_INDEX}, k as (select chunk_id, ' ' || {_NORM.format('any_value(text)')} || ' ' as t from chunks where text is not null group by chunk_id) select k.chunk_id, a.type_group, a.form as surface, a.entity_id from k join a on contains(k.t, ' ' || a.form || ' ')")
def _(spark, d):
    return G.gazetteer(*_t(spark, d, "chunks", "entities"))


@query("f20_roles_mapped", "with t as (select distinct upper(trim(coalesce(speaker, ''))) as speaker from turns where text is not null) select speaker, case when speaker = 'CHAIRPERSON' then 'chair' when speaker like '%INTERPRETER%' then 'interpreter' when speaker like 'CHAIRPERSON%' or speaker like 'COMMISSIONER%' or speaker like 'THE CHAIRPERSON%' or speaker like 'THE COMMISSIONER%' then 'bench' else 'counsel' end as role from t where speaker <> ''")
def _(spark, d):
    """A reviewed map of labels goes before the rules."""
    from testimonia.operators.corpus import clean_turns
    from testimonia.sources.files import role_map

    t = clean_turns(_t(spark, d, "turns")).where("speaker <> ''").select("speaker").distinct()
    m = role_map(spark, {"CHAIRPERSON": "chair"}).unionByName(t.where("speaker like '%INTERPRETER%'").select("speaker", F.lit("interpreter").alias("role"))).distinct()
    rule = F.when(T.is_bench(F.col("speaker")), "bench").otherwise("counsel")
    return t.join(m, "speaker", "left").select("speaker", F.coalesce("role", rule).alias("role"))


@query("f23_f24_snippets", r"with k as (select chunk_id, trim(regexp_replace(any_value(text), '[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as t from chunks where text is not null group by chunk_id) select chunk_id, case when length(t) <= 320 then t else trim(regexp_extract(substr(t, 1, 319), '^(.*)\s', 1) || ' …') end as snippet, case when length(t) > 300 then substr(t, 1, 300) || '…' else t end as clipped from k")
def _(spark, d):
    c = _t(spark, d, "chunks").select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"])
    return c.select("chunk_id", T.snippet(F.col("text"), 320).alias("snippet"), T.clipped(F.col("text"), 300).alias("clipped"))


@query("f32_json_access", "select chunk_id, any_value(text) as text, max(cast(len(speakers) as bigint)) as speakers, coalesce(max(speakers[1]), '-') as first from chunks where text is not null and speakers is not null group by chunk_id")
def _(spark, d):
    c = _t(spark, d, "chunks").where("text is not null and speakers is not null").dropDuplicates(["chunk_id"]).select("chunk_id", F.to_json(F.struct(F.struct("text", "speakers").alias("body"))).alias("j"))
    got = F.from_json("j", "body struct<text:string,speakers:array<string>,lost:array<string>>")
    return c.select("chunk_id", got["body"]["text"].alias("text"), F.size(got["body"]["speakers"]).cast("long").alias("speakers"), F.coalesce(F.get(got["body"]["speakers"], F.lit(0)), F.get(F.coalesce(got["body"]["lost"], F.array().cast("array<string>")), F.lit(0)), F.lit("-")).alias("first"))


@query("x7_strict_parse", "select distinct chunk_id, case when chunk_index % 5 = 0 then 'unknown field' when chunk_index % 5 = 1 then 'no JSON' else 'ok' end as outcome from chunks")
def _(spark, d):
    """Answers must have the schema's fields and no others; those that have not are told apart."""
    c = _t(spark, d, "chunks").select("chunk_id", "chunk_index").distinct()
    ok = F.lit('{"entities": [], "mentions": [], "claims": []}')
    j = F.when(F.col("chunk_index") % 5 == 0, F.replace(ok, F.lit("}"), F.lit(', "notes": 1}'))).when(F.col("chunk_index") % 5 == 1, F.lit('{"entities": [')).otherwise(ok)
    return c.select("chunk_id", T.strict_fault(j, ["entities", "mentions", "claims"]).alias("outcome"))


@query("x8_prompts", "select distinct chunk_id, 'Hearing day ' || coalesce(cast(day_no as varchar), 'None') || ' (' || coalesce(hearing_date, 'None') || '), pages ' || coalesce(cast(page_start as varchar), 'None') || '-' || coalesce(cast(page_end as varchar), 'None') || '. Speakers: ' || coalesce(array_to_string(speakers, ', '), '') || '.' as head from chunks where text is not null")
def _(spark, d):
    return _t(spark, d, "chunks").where("text is not null").select("chunk_id", T.prompt_head(F.col("day_no"), F.col("hearing_date"), F.col("page_start"), F.col("page_end"), F.col("speakers")).alias("head")).distinct()


# --- vectors -----------------------------------------------------------------------------------------------------------------


@query("v1_cosine_neighbours", "with q as (select vec_id as query_id, embedding::double[] as a from embeddings where vec_id % 100 = 0), s as (select q.query_id, e.vec_id, list_cosine_similarity(q.a, e.embedding::double[]) as score from q cross join embeddings e where e.label <> 3 or e.label is null) select query_id, vec_id, round(score, 6) as score, rn from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rn from s) where rn <= 10")
def _(spark, d):
    """For every vector whose id is divisible by 100 the ten most similar ones without one label."""
    e = _t(spark, d, "embeddings")
    n = G.cosine_neighbours(e.where("label <> 3 or label is null"), e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10)
    return n.withColumn("score", F.round("score", 6))


@query("v2_hashed_embeddings")
def _(spark, d):
    c = _t(spark, d, "chunks").select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"])
    e = c.select("chunk_id", G.hashed_embedding(F.col("text"), 384).alias("v"))
    return e.select("chunk_id", F.size("v").alias("dimension"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 4).alias("norm"))


@query("v4_payload", f"""with {_LATEST_SHA}, k as (select chunk_id, any_value(columns(* exclude (chunk_id, speakers))) , any_value(array_to_string(speakers, ' | ')) as speakers from chunks group by chunk_id)
select k.chunk_id, k.commission_slug, k.commission_name, rl.source_type, rl.document_type, k.day_no, k.hearing_date as date, k.source_url, rl.authoritative, rl.filename, k.doc_sha256 as sha256, k.page_start, k.page_end, k.time_start, k.time_end, rl.transcription_method, k.speakers, k.chunk_index, k.text from k left join rl on rl.sha256 = k.doc_sha256""")
def _(spark, d):
    return G.payload(*_t(spark, d, "chunks", "registry")).drop("point_id").withColumn("speakers", F.array_join("speakers", " | "))


@query("f9_point_ids")
def _(spark, d):
    return G.payload(*_t(spark, d, "chunks", "registry")).select("chunk_id", "point_id")


@query("p3_f33_payload_filter", "select distinct chunk_id from chunks where commission_slug = 'harrow' and list_contains(speakers, 'CHAIRPERSON') and day_no between 1 and 1000 and day_no = (select min(day_no) from chunks where commission_slug = 'harrow' and list_contains(speakers, 'CHAIRPERSON'))")
def _(spark, d):
    p = G.payload_filter(_t(spark, d, "chunks").withColumnRenamed("doc_sha256", "sha256"), commission="harrow", speaker="Chairperson")
    first = p.agg(F.min("day_no").alias("_m"))
    return p.crossJoin(F.broadcast(first)).where(F.col("day_no") == F.col("_m")).select("chunk_id").distinct()  # one row


@query("v3_point_parity", f"""with {_DAYS}, r as (select sha256, max(coalesce(superseded_by, '')) as s from registry where sha256 is not null group by sha256),
k as (select d.chunk_id, r.sha256 is null as no_source, coalesce(r.s, '') = '' as active from d left join r on r.sha256 = d.doc_sha256),
c as (select count(distinct chunk_id) filter (where active) as points, count(distinct chunk_id) filter (where active) as active_chunks, count(distinct chunk_id) filter (where no_source) as no_source from k)
select points, active_chunks, no_source, points = active_chunks and no_source = 0 as ok from c""")
def _(spark, d):
    """Points of a load, superseded documents purged, against the passages that should be there."""
    from testimonia.operators import loading as LD

    c, r = _t(spark, d, "chunks"), _t(spark, d, "registry")
    gone = r.where("sha256 is not null and coalesce(superseded_by, '') <> ''").select(F.col("sha256").alias("doc_sha256"))
    return G.point_parity(G.payload(LD.purged(c, gone, "doc_sha256"), r), c, r)

