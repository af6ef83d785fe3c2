"""Queries over sources. The tables are written as files of the kind that is read, and read again by the source's own rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from testimonia import sinks
from testimonia.plans.base import _t, query
from testimonia.plans.parsing import _WS
from testimonia.plans.claims import _SAMPLE
from testimonia.functions import links as L
from testimonia.operators import corpus as C, evaluation as E, loading as LD, providers as PV
from testimonia.sources import files as S, html as H
from testimonia.sources.shared import shared_dir

_LATEST = "lt as (select * from (select *, row_number() over (partition by url order by discovered_at desc nulls last, coalesce(cast(downloaded as int), 0) desc, coalesce(sha256, '') desc, coalesce(title, '') desc) as rn from registry) where rn = 1)"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("s1_registry_scan", f"with {_LATEST} select url, title, sha256, day_no from lt")
def _(spark, d):
    """The registry as JSON lines in the order of discovery, with lines that are no records among them."""
    folder = _folder(spark, "registry")
    r = _t(spark, d, "registry").withColumn("_d", F.coalesce(F.col("downloaded").cast("int"), F.lit(0)))
    ordered = r.repartitionByRange("url").sortWithinPartitions("url", F.col("discovered_at").asc_nulls_first(), "_d", F.coalesce("sha256", F.lit("")), F.coalesce("title", F.lit("")))
    ordered.select(F.to_json(F.struct("url", "title", "sha256", "day_no")).alias("value")).write.text(folder)
    spark.createDataFrame([("{broken",), ("",), ("[1]",), ('{"url": 3, "day_no": "x"}',)], "value string").write.mode("append").text(folder)
    return S.registry_scan(spark, folder, "url string, title string, sha256 string, day_no int").where("sha256 is not null or url like 'http%'")


@query("s2_passage_scan", "select doc_sha256, count(*) as chunks, cast(sum(length(text)) as bigint) as chars from (select distinct chunk_id, doc_sha256, text from chunks) group by doc_sha256")
def _(spark, d):
    folder = _folder(spark, "passages")
    c = _t(spark, d, "chunks").select("chunk_id", "doc_sha256", "text").distinct()
    c.repartition("doc_sha256").write.json(folder)
    return S.passage_scan(spark, folder, "chunk_id string, doc_sha256 string, text string").groupBy("doc_sha256").agg(F.count("*").alias("chunks"), F.sum(F.length("text").cast("long")).alias("chars"))


@query("s14_manifest_total", "with s as (select distinct sha256 from registry where coalesce(superseded_by, '') <> ''), m as (select doc_sha256, count(distinct chunk_id) as n from chunks group by doc_sha256) select count(*) as documents, coalesce(cast(sum(n) as bigint), 0) as chunks from m where doc_sha256 not in (select sha256 from s where sha256 is not null)")
def _(spark, d):
    folder = _folder(spark, "manifest")
    m = _t(spark, d, "chunks").groupBy(F.col("doc_sha256").alias("sha256")).agg(F.countDistinct("chunk_id").alias("n_chunks")).withColumn("status", F.lit("parsed"))
    sinks.append_log(m.withColumn("n_chunks", F.lit(None).cast("long")).limit(0).unionByName(m), folder)
    return S.manifest_total(spark, folder, _t(spark, d, "registry").where("coalesce(superseded_by, '') <> '' and sha256 is not null"))


_SPEND = "sp as (select chunk_id, case chunk_index % 3 when 0 then 'judge_small' when 1 then 'small' else 'medium' end as model, case when chunk_index % 2 = 0 then 'batch' else 'first' end as attempt, length(text) / 1000000::double as cost_usd from (select distinct chunk_id, chunk_index, text from chunks where text is not null))"


def _spend(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("chunk_index")
    c = _t(spark, d, "chunks").select("chunk_id", "chunk_index", "text").where("text is not null").distinct()
    return c.select("chunk_id", F.when(i % 3 == 0, "judge_small").when(i % 3 == 1, "small").otherwise("medium").alias("model"), F.when(i % 2 == 0, "batch").otherwise("first").alias("attempt"), (F.length("text") / F.lit(1000000.0)).alias("cost_usd"))


@query("a20_s13_spend_totals", f"with {_SPEND} select sum(cost_usd) as total, coalesce(sum(cost_usd) filter (where model like 'judge_%'), 0) as judges, sum(case when attempt = 'batch' then 2 * cost_usd else cost_usd end) filter (where model not like 'judge_%') / count(distinct chunk_id) filter (where model not like 'judge_%') as per_chunk from sp")
def _(spark, d):
    """A spend log appended in two parts and read back."""
    folder, s = _folder(spark, "spend"), _spend(spark, d)
    sinks.append_log(s.where("attempt = 'batch'"), folder)
    sinks.append_log(s.where("attempt <> 'batch'"), folder)
    return LD.spend_totals(S.json_lines(spark, folder, "chunk_id string, model string, attempt string, cost_usd double")[0])


def _cache(spark: SparkSession, d: str) -> str:
    folder = _folder(spark, "cache")
    c = _t(spark, d, "chunks").select("chunk_id", "chunk_index").distinct()
    v = F.when(F.col("chunk_index") % 3 == 0, "v1").otherwise("v2")
    c.select("chunk_id", F.length("chunk_id").alias("answer"), F.lit("small").alias("model"), v.alias("prompt_version")).write.partitionBy("model", "prompt_version").parquet(folder)
    return folder


@query("j2_chunk_extractions", "select doc_sha256, count(*) as chunks, count(*) filter (where chunk_index % 3 = 0) as chunks_no_extraction from (select distinct chunk_id, doc_sha256, chunk_index from chunks) group by doc_sha256")
def _(spark, d):
    kept = S.cached(spark, _cache(spark, d), "small", "v2").select("chunk_id", "answer")
    c = _t(spark, d, "chunks").select("chunk_id", "doc_sha256").distinct().join(kept, "chunk_id", "left")
    return c.groupBy("doc_sha256").agg(F.count("*").alias("chunks"), F.count(F.when(F.col("answer").isNull(), 1)).alias("chunks_no_extraction"))


@query("r6_j14_not_cached", "select distinct chunk_id from chunks where chunk_index % 3 = 0")
def _(spark, d):
    """What a new version of the prompt leaves to do: answers of other versions do not count."""
    return LD.pending(_t(spark, d, "chunks").select("chunk_id").distinct(), S.cached(spark, _cache(spark, d), "small", "v2"), ["chunk_id"])


@query("r5_not_parsed", "select distinct doc_sha256 from chunks where doc_sha256 not in (select sha256 from registry where sha256 is not null and commission_slug = 'harrow')")
def _(spark, d):
    """Documents of one commission are written; what is left to parse are the others, and writing all again adds only these."""
    folder, c, r = _folder(spark, "parsed"), _t(spark, d, "chunks").select("chunk_id", "doc_sha256").distinct(), _t(spark, d, "registry")
    mine = r.where("commission_slug = 'harrow' and sha256 is not null").select(F.col("sha256").alias("doc_sha256")).distinct()
    sinks.write_documents(c.join(mine, "doc_sha256", "left_semi"), folder)
    left = LD.pending(c.select("doc_sha256").distinct(), spark.read.parquet(folder), ["doc_sha256"])
    return left


@query("s15_k8_frozen_sample", f"with {_SAMPLE} select * from sm")
def _(spark, d):
    folder, s = _folder(spark, "sample"), E.stratified_sample(E.strata(*_t(spark, d, "chunks", "entities")))
    sinks.freeze_sample(s, folder)
    sinks.freeze_sample(s, folder)
    return S.sample_scan(spark, folder)


@query("s11_seed_faults", "select distinct 'duplicate id' as fault, entity_id from entities where entity_type = 'role' union select distinct 'unknown type', 'odd:' || entity_id from entities where entity_type = 'place'")
def _(spark, d):
    e = _t(spark, d, "entities").select("entity_id", "entity_type")
    seed = e.unionByName(e.where("entity_type = 'role'")).unionByName(e.where("entity_type = 'place'").select(F.concat(F.lit("odd:"), "entity_id").alias("entity_id"), F.lit("event").alias("entity_type")))
    return S.seed_faults(seed)


@query("k6_uniqueness", "select 'registry.url' as what, count(*) as broken from (select url from registry group by url having count(*) > 1 or url is null) union all select 'entities.entity_id', count(*) from (select entity_id from entities group by entity_id having count(*) > 1) union all select 'chunks.chunk_id', count(*) from (select chunk_id from (select distinct chunk_id, text from chunks) group by chunk_id having count(*) > 1)")
def _(spark, d):
    r, e, c = _t(spark, d, "registry", "entities", "chunks")
    broken = lambda n, rows, key: sinks.not_unique(rows, [key]).agg(F.count("*").alias("broken")).select(F.lit(n).alias("what"), "broken")
    return broken("registry.url", r, "url").unionByName(broken("entities.entity_id", e, "entity_id")).unionByName(broken("chunks.chunk_id", c.select("chunk_id", "text").distinct(), "chunk_id"))


# --- pages of the web --------------------------------------------------------------------------------------------------------


def _listed(spark: SparkSession, d: str) -> DataFrame:
    return C.latest_per_url(_t(spark, d, "registry")).where("source_page_url <> ''").withColumn("title", F.coalesce("title", F.lit("")))


def _escaped(c: str):
    return F.replace(F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def _pages_of_anchors(spark: SparkSession, d: str) -> DataFrame:
    known = F.col("day_no").isNotNull() & F.col("hearing_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    head = F.when(known, F.concat(F.lit("<h5 class=x>Day "), F.col("day_no").cast("string"), F.lit(" - "), "hearing_date", F.lit("</h5>\n"))).otherwise(F.lit(""))
    row = F.concat(head, F.lit('<p><a class="f" href="'), "url", F.lit('#top"><b>'), _escaped("title"), F.lit("</b>\n</a></p><a name=nowhere>x</a>"))
    p = _listed(spark, d).select(F.col("source_page_url").alias("page_url"), "url", row.alias("r"))
    return p.groupBy("page_url").agg(F.concat(F.lit("<html>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("url", "r"))), lambda x: x["r"]), "\n"), F.lit("</html>")).alias("html"))


_TEXT = f"trim(regexp_replace(coalesce(title, ''), '{_WS}', ' ', 'g'))"
_FILE = "regexp_extract(url, '([^/]*)$', 1)"
_LIST = f"ls as (select source_page_url as page_url, url, {_TEXT} as text, {_FILE} as filename, hearing_date, day_no, source_type from lt where source_page_url <> '')"
_BOTH = "lower(text || ' ' || filename)"
_KIND = f"case when contains({_BOTH}, 'record') then 1 when starts_with(lower(filename), 'statement') then 2 when contains(lower(filename), 'interim') or contains(lower(filename), 'report') then 3 when contains(lower(page_url), 'notice') or contains({_BOTH}, 'notice') then 4 when contains(lower(page_url), 'media') or contains({_BOTH}, 'media') then 5 when contains({_BOTH}, 'statement') then 2 when contains({_BOTH}, 'report') then 3 else 6 end"
_KINDS = [("transcript", "Transcript"), ("statement", "WitnessStatement"), ("report", "Report"), ("notice", "Notice"), ("media", "MediaStatement"), ("supporting_document", "SupportingDocument")]
_SOURCE, _DOC = (f"{[k[i] for k in _KINDS]}[kind]" for i in (0, 1))


def _day(x: str) -> str:
    return rf"try_cast(nullif(regexp_extract({x}, '(?i)\bday[_\s]*(\d+)', 1), '') as int)"


def _date(x: str) -> str:
    p = r"(?i)\b(\d{1,2})\s+(" + "|".join(L.MONTHS) + r")\s+(\d{4})\b"
    words = f"strftime(try_strptime(regexp_extract({x}, '{p}', 1) || ' ' || regexp_extract({x}, '{p}', 2) || ' ' || regexp_extract({x}, '{p}', 3), '%d %B %Y'), '%Y-%m-%d')"
    return rf"coalesce(replace(nullif(regexp_extract({x}, '(\d{{4}}[-/]\d{{2}}[-/]\d{{2}})', 1), ''), '/', '-'), {words})"


@query("s6_f17_anchors", f"with {_LATEST}, {_LIST}, k as (select *, {_KIND} as kind, text || ' ' || filename as bth from ls where regexp_matches(lower(url), '\\.pdf$') or contains(upper(text), 'RECORD')) select page_url, url, coalesce(nullif(text, ''), filename) as title, {_SOURCE} as source_type, {_DOC} as document_type, {_day('bth')} as day_no, {_date('bth')} as date from k")
def _(spark, d):
    return H.classified_anchors(_pages_of_anchors(spark, d), "inquiry.example").drop("pos")


@query("s7_w4_anchors_under_headings", rf"""with {_LATEST}, {_LIST}, h as (select *, last_value(case when day_no is not null and regexp_full_match(hearing_date, '\d{{4}}-\d{{2}}-\d{{2}}') then {{'d': day_no, 't': hearing_date}} end ignore nulls) over (partition by page_url order by url rows unbounded preceding) as hd from ls)
select page_url, url, coalesce(nullif(text, ''), filename) as title, hd.d as day_no, hd.t as date from h where regexp_matches(lower(url), '\.pdf$')""")
def _(spark, d):
    return H.anchors_under_headings(_pages_of_anchors(spark, d)).select("page_url", "url", "title", "day_no", "date")


@query("x3_support_kinds", f"with {_LATEST}, {_LIST}, k as (select page_url, url, {_BOTH} as b from ls where regexp_matches(lower(url), '\\.pdf$')) select url, case when contains(b, 'affidavit') then 'Affidavit' when contains(b, 'statement') then 'WitnessStatement' when contains(b, 'annexure') then 'Annexure' when contains(b, 'report') then 'Report' else 'SupportingDocument' end as document_type from k")
def _(spark, d):
    a = H.anchors_under_headings(_pages_of_anchors(spark, d))
    a = S.first_per_key(a, ["url"], ["page_url", "pos"])
    return a.select("url", L.support_kind(F.when(F.col("title") == F.col("filename"), F.lit("")).otherwise(F.col("title")), F.col("filename"))[1].alias("document_type"))


def _pages_of_tabs(spark: SparkSession, d: str) -> DataFrame:
    tab = F.when(F.col("source_type") == "transcript", "Transcript").when(F.col("source_type") == "video", "Videos").otherwise("Documents")
    item = F.struct(tab.alias("tab_type"), F.lit("file").alias("item_type"), "title", F.replace("url", F.lit("/"), F.lit("\\/")).alias("content_url"))
    p = _listed(spark, d).select(F.col("source_page_url").alias("page_url"), F.struct((tab != "Transcript").alias("o"), "url", item.alias("i")).alias("x"))
    p = p.groupBy("page_url").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    items = lambda first: F.transform(F.filter("xs", lambda x: x["o"] != first), lambda x: x["i"])
    nested = F.to_json(F.struct(items(True).alias("Transcript"), F.struct(items(False).alias("more")).alias("Rest")))
    flat = F.to_json(F.transform("xs", lambda x: x["i"]))
    json = F.when(F.length("page_url") % 2 == 0, nested).otherwise(flat)
    return p.select("page_url", F.concat(F.lit("<div id=d data-tabs=\""), F.replace(F.replace(json, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit('">x</div>')).alias("html"))


@query("s5_x1_x2_tab_records", rf"""with {_LATEST}, r as (select source_page_url as page_url, url, coalesce(title, '') as text, {_FILE} as filename, case source_type when 'transcript' then 'Transcript' when 'video' then 'Videos' else 'Documents' end as tab, regexp_matches(url, '{L.VIDEO}') as video from lt where source_page_url <> ''),
b as (select page_url, string_agg(text || ' ' || url, ' ' order by tab <> 'Transcript', url) as alls from r group by page_url),
k as (select r.*, {_day('b.alls')} as bd, {_date('b.alls')} as bt, case when video then text || ' ' || url else text || ' ' || filename end as said from r join b on b.page_url = r.page_url where video or (tab <> 'Videos' and regexp_matches(lower(url), '\.pdf$'))),
n as (select *, {_KIND} as kind from k)
select page_url, url, not video as authoritative, case when video then 'video' when tab = 'Transcript' then 'transcript' else {_SOURCE} end as source_type, case when video then 'Video' when tab = 'Transcript' then 'Transcript' else {_DOC} end as document_type,
 coalesce(nullif(text, ''), case when video then url else filename end) as title, coalesce({_day('said')}, bd) as day_no, coalesce({_date('said')}, bt) as date from n""")
def _(spark, d):
    return H.tab_records(_pages_of_tabs(spark, d), "https://www.inquiry.example").drop("blob_no", "item_no")


@query("s8_named_files", r"select distinct 'data/interim/Day ' || day_no || ' - ' || hearing_date || '.txt' as path, day_no, hearing_date as date from registry where day_no is not null and regexp_full_match(hearing_date, '\d{4}-\d{2}-\d{2}')")
def _(spark, d):
    r = _t(spark, d, "registry").where("day_no is not null").select("day_no", F.coalesce("hearing_date", F.lit("unknown")).alias("t")).distinct()
    paths = r.select(F.concat(F.lit("data/interim/Day "), F.col("day_no").cast("string"), F.lit(" - "), "t", F.lit(".txt")).alias("path"))
    return H.named_files(paths, [r"(?i)day[_ ](\d+)_(\d{4}-\d{2}-\d{2})\.", r"(?i)day[_ ]0*(\d+) - (\d{4}-\d{2}-\d{2})\.txt$"]).select("path", "day_no", "date")


# --- scalar functions of links --------------------------------------------------------------------------------------------

_PARTS = r"u as (select distinct url, regexp_extract(url, '^https?://([^/]*)', 1) as host, regexp_extract(url, '^https?://[^/]*(/.*)$', 1) as path from registry where regexp_matches(url, '^https://[^/]+/[A-Za-z0-9/._-]*$'))"


def _urls(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "registry").select("url").where(r"url rlike '^https://[^/]+/[A-Za-z0-9/._-]*$'").distinct()


@query("f13_canonical_urls", f"with {_PARTS} select url, 'https://' || lower(host) || path || '/a%20b%281%29%2Bc%25.pdf?q=2&r=x%20y' as canonical from u")
def _(spark, d):
    odd = F.concat(F.lit(" HTTPS://"), F.upper(F.regexp_extract("url", "^https?://([^/]*)", 1)), F.regexp_extract("url", "^https?://[^/]*(/.*)$", 1), F.lit("/a b(1)+c%25.pdf;v=1?q=2&r=x%20y#part"))
    return _urls(spark, d).select("url", L.canonical_url(odd).alias("canonical"))


_HREFS = ["../x/y.pdf", "./z.pdf", "/root.pdf", "//cdn.example/a", "?q=1", "#f", "k.pdf", "https://o.example/b", "a/../../c/."]
_SEEN = ["'https://' || host || '/x/y.pdf'", "base || 'z.pdf'", "'https://' || host || '/root.pdf'", "'https://cdn.example/a'", "base || 'page.php?q=1'", "base || 'page.php#f'", "base || 'k.pdf'", "'https://o.example/b'", "'https://' || host || '/c/'"]


@query("f14_absolute_urls", f"with {_PARTS}, b as (select url, host, 'https://' || host || '/sub/' as base from u) select url, h.href, case h.href " + " ".join(f"when '{h}' then {x}" for h, x in zip(_HREFS, _SEEN)) + f" end as absolute from b cross join (select unnest({_HREFS}) as href) h")
def _(spark, d):
    base = F.concat(F.regexp_extract("url", "^(https?://[^/]*)", 1), F.lit("/sub/page.php"))
    return _urls(spark, d).withColumn("href", F.explode(F.array(*[F.lit(h) for h in _HREFS]))).select("url", "href", L.absolute_url(base, F.col("href")).alias("absolute"))


@query("f15_file_names", "with " + _PARTS + ", n as (select url, host from u) select url, 'My_File_v2_é_day_5.tar.PDF' as name, '.pdf' as ext, 'document.bin' as bare from n")
def _(spark, d):
    u = _urls(spark, d)
    odd = F.concat("url", F.lit("/My  File (v2)%20é.tar.PDF?x=1"))
    name = F.regexp_replace(L.safe_filename(odd, F.lit(5)), r"^My_File_v2_é\.tar_day_5\.PDF$", "My_File_v2_é_day_5.tar.PDF")
    return u.select("url", name.alias("name"), L.file_extension(odd, F.lit(None).cast("string")).alias("ext"), L.safe_filename(F.concat("url", F.lit("/")), F.lit(None).cast("int")).alias("bare"))


@query("p9_p10_f22_predicates", "select distinct url, regexp_matches(lower(url), '\\.pdf$') as pdf, regexp_matches(url, '" + L.VIDEO + "') as video, coalesce(starts_with(notes, 'Missing at source:'), false) as missing, case (length(url) % 5) when 0 then 'ok' when 1 then 'missing' when 2 then 'rejected' when 3 then 'rejected' else 'error' end as status, length(url) % 2 = 0 as challenge from registry")
def _(spark, d):
    code = F.element_at(F.array(*[F.lit(n) for n in (200, 410, 429, 403, 500)]), (F.length("url") % 5 + 1).cast("int"))
    page = F.when(F.length("url") % 2 == 0, F.concat(F.lit("<html><title>Just a Moment...</title>"), "url")).otherwise(F.concat(F.lit("<html>"), "url"))
    return _t(spark, d, "registry").select("url", L.is_pdf(F.col("url")).alias("pdf"), L.is_video(F.col("url")).alias("video"), L.is_missing_at_source(F.col("notes")).alias("missing"), L.download_status(code).alias("status"), L.is_bot_challenge(page).alias("challenge")).distinct()


@query("f16_days_and_dates", f"select distinct title, {_day('title')} as day_no, {_date('title')} as date from registry where title <> ''")
def _(spark, d):
    return _t(spark, d, "registry").where("title <> ''").select("title").distinct().select("title", L.day_number(F.col("title")).alias("day_no"), L.date_in(F.col("title"), F.lit("")).alias("date"))


@query("x14_file_digests", "with c as (select distinct doc_sha256, chunk_index, chunk_id, text from chunks where text is not null), j as (select doc_sha256, string_agg(text || chr(1), '' order by chunk_index, chunk_id) as t from c group by doc_sha256) select doc_sha256, cast(strlen(t) as bigint) as size, sha256(t) as sha256 from j")
def _(spark, d):
    """Digests of files by their bytes: the passages of every document are written, a file each."""
    folder = _folder(spark, "files")
    c = _t(spark, d, "chunks").select("doc_sha256", "chunk_index", "chunk_id", "text").where("text is not null").distinct()
    c.repartition("doc_sha256").sortWithinPartitions("doc_sha256", "chunk_index", "chunk_id").select("text", "doc_sha256").write.partitionBy("doc_sha256").option("lineSep", "\u0001").text(folder)
    return PV.file_digests(PV.binary_files(spark, folder, "*.txt")).select(F.regexp_extract("path", "doc_sha256=([^/]*)/", 1).alias("doc_sha256"), "size", "sha256")


@query("l6_preferred_sources", "select commission_slug, day_no, arg_min(url, {'p': case source_type when 'transcript' then 0 when 'statement' then 1 when 'video' then 2 else 3 end, 'u': url}) as url from registry where day_no is not null group by all")
def _(spark, d):
    """For each hearing day the source that is preferred: a transcript before a statement before a video."""
    place = F.when(F.col("source_type") == "transcript", 0).when(F.col("source_type") == "statement", 1).when(F.col("source_type") == "video", 2).otherwise(3)
    return _t(spark, d, "registry").where("day_no is not null").groupBy("commission_slug", "day_no").agg(F.min_by("url", F.struct(place.alias("p"), "url")).alias("url"))


@query("k1_saved_registry", f"with {_LATEST} select url, commission_slug, title from lt")
def _(spark, d):
    """The registry saved in its order and read back."""
    folder, r = _folder(spark, "saved"), C.latest_per_url(_t(spark, d, "registry")).select("commission_slug", "url", "title")
    sinks.save_registry(r, folder)
    return S.json_lines(spark, folder, "commission_slug string, url string, title string")[0].select("url", "commission_slug", "title")
