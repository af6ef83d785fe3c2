"""Queries from pages to turns and passages, and from captions to segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from testimonia.plans.base import _TURNS, _t, query
from testimonia.functions import text as T
from testimonia.operators import corpus as C, ordered as O, parsing as P
from testimonia.sources.shared import written

_WS = r"[\s\v\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_FURN = "(x = '' or " + " or ".join(f"regexp_matches(x, '{p}')" for p in T.FURNITURE) + ")"
_PAGES = rf"""l as (select doc_id, page_no, unnest(list_transform(string_split(text, chr(10)), lambda y: trim(regexp_replace(y, '{_WS}', ' ', 'g')))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from (select distinct doc_id, page_no, text from pages)),
p as (select doc_id, page_no, string_agg(x, ' ' order by i) as text from l where not {_FURN} group by doc_id, page_no)"""
_DOCS = _PAGES + ", d as (select doc_id, string_agg(text, ' ' order by page_no) as text from p group by doc_id)"


@query("t2_document_text", f"with {_DOCS} select doc_id, text from d")
def _(spark, d):
    return P.document_text(_t(spark, d, "pages")).select("doc_id", "text")


@query("j8_page_of_offset", f"""with {_PAGES}, s as (select doc_id, page_no, text, coalesce(sum(length(text) + 1) over (partition by doc_id order by page_no rows between unbounded preceding and 1 preceding), 0) as a from p),
o as (select doc_id, unnest([0, 777, 4000, 1000000000]) as at from (select distinct doc_id from p))
select o.doc_id, o.at, max(s.page_no) as page_no from o join s on s.doc_id = o.doc_id and greatest(0, s.a - 1) <= o.at group by all""")
def _(spark, d):
    t = P.document_text(_t(spark, d, "pages")).select("doc_id", "starts", F.explode(F.array(*[F.lit(n) for n in (0, 777, 4000, 1_000_000_000)])).alias("at"))
    return t.select("doc_id", "at", P.page_of(F.col("starts"), F.col("at")).alias("page_no"))


_HEAD = r"^(?:CROSS[- ]?|RE[- ]?)?EXAMINATION(?:\s+IN\s+CHIEF)?\s+BY\s+(.*?)(?:\s*\(CONTINUES?\))?$"


def _label_sql(x: str) -> str:
    one = rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
    named = f"case when regexp_matches({one}, '{_HEAD}') then trim(regexp_extract({one}, '{_HEAD}', 1)) else {one} end"
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({named}, '\s*-\s*', '-', 'g'), '\bLT GEN\b', 'LT-GEN', 'g'), '\bMAJ GEN\b', 'MAJ-GEN', 'g'))"


_LABEL = T.LABEL.replace("'", "''")


@query("t3_turns", rf"""with {_DOCS}, m as (select doc_id, string_split(regexp_replace(replace(text, ' ', '  ') || ' ', '(?:^|\s)({_LABEL})\s*:\s', chr(1) || '\1' || chr(2), 'g'), chr(1)) as parts from d),
x as (select doc_id, unnest(parts[2:]) as s, generate_subscripts(parts[2:], 1) as i from m),
y as (select doc_id, i, split_part(s, chr(2), 1) as label, trim(regexp_replace(substr(s, strpos(s, chr(2)) + 1), '\s+', ' ', 'g')) as body from x)
select doc_id, row_number() over (partition by doc_id order by i) as turn_no, {_label_sql("label")} as speaker, body as text from y where body <> ''""")
def _(spark, d):
    return P.detected_turns(_t(spark, d, "pages")).select("doc_id", "turn_no", "speaker", "text")


@query("t3_turn_pages")
def _(spark, d):
    return P.detected_turns(_t(spark, d, "pages")).select("doc_id", "turn_no", "page_start", "page_end")


@query("f4_labels", f"with {_TURNS} select speaker, {_label_sql('speaker')} as label, count(*) as turns from t where speaker <> '' group by all")
def _(spark, d):
    t = C.clean_turns(_t(spark, d, "turns")).where("speaker <> ''")
    return t.groupBy("speaker").agg(F.count("*").alias("turns")).withColumn("label", T.normalise_label(F.col("speaker")))


_PACK = rf"""with recursive {_TURNS}, r0 as (select *, row_number() over (partition by doc_id order by turn_no) as rn, length(speaker) + 2 + length(text) as n from t where text <> ''),
r as (select *, case when n > 1800 then string_split(list_reduce(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(2), 'g'), chr(2)),
    lambda a, s: case when length(string_split(a, chr(1))[-1]) + 1 + length(s) <= 1800 - length(speaker) - 2 then a || ' ' || s else a || chr(1) || s end), chr(1)) end as pieces from r0),
s as (select distinct doc_id, cast(0 as bigint) as rn, cast(0 as bigint) as held, cast(-1 as bigint) as last from r union all
  select r.doc_id, r.rn, case when r.n > 1800 then 0 when s.held > 0 and s.held + 1 + r.n <= 1800 then s.held + 1 + r.n else r.n end,
    case when r.n > 1800 then s.last + len(r.pieces) when s.held > 0 and s.held + 1 + r.n <= 1800 then s.last else s.last + 1 end from s join r on r.doc_id = s.doc_id and r.rn = s.rn + 1),
j as (select r.*, s.last from s join r on r.doc_id = s.doc_id and r.rn = s.rn),
long as (select doc_id, last - len(pieces) + generate_subscripts(pieces, 1) as chunk_index, speaker || ': ' || unnest(pieces) as text, 1 as n_speakers, speaker as first_speaker, 1 as n_turns, page_start, page_end from j where n > 1800)
select doc_id, last as chunk_index, string_agg(speaker || ': ' || text, chr(10) order by rn) as text, count(distinct speaker) as n_speakers, arg_min(speaker, rn) as first_speaker, count(*) as n_turns, (arg_min({{'v': page_start}}, rn)).v as page_start, (arg_max({{'v': page_end}}, rn)).v as page_end from j where n <= 1800 group by doc_id, last
union all select * from long"""


def _packed(spark, d):
    return P.packed_turns(C.clean_turns(_t(spark, d, "turns")))


@query("t5_packed_turns", _PACK)
def _(spark, d):
    p = _packed(spark, d)
    return p.select("doc_id", "chunk_index", "text", F.size("speakers").cast("long").alias("n_speakers"), F.col("speakers")[0].alias("first_speaker"), "n_turns", "page_start", "page_end")


@query("t4_split_turns")
def _(spark, d):
    """Turns longer than 400 characters in pieces of at most that, sentence by sentence."""
    s = P.split_turns(C.clean_turns(_t(spark, d, "turns")).where("text <> ''"), 400)
    return s.select("doc_id", "turn_no", F.posexplode("pieces").alias("piece_no", "piece"))


@query("p4_select_chunks", "with a as (select distinct sha256 from registry where downloaded and coalesce(local_path, '') <> '' and coalesce(superseded_by, '') = '' and sha256 is not null) select distinct c.chunk_id, c.doc_sha256, c.day_no from chunks c where c.doc_sha256 in (select sha256 from a) and c.day_no between 36 and 66")
def _(spark, d):
    a = C.active(_t(spark, d, "registry")).select(F.col("sha256").alias("doc_sha256"))
    return _t(spark, d, "chunks").where("day_no between 36 and 66").select("chunk_id", "doc_sha256", "day_no").distinct().join(a.distinct(), "doc_sha256", "left_semi")


# --- captions -----------------------------------------------------------------------------------------------------

_ROLL = r"""c as (select distinct doc_id, pos, start_s, end_s, lines from cues),
k as (select doc_id, pos, start_s, end_s, list_filter(list_transform(coalesce(lines, []), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '\s+', ' ', 'g'))), lambda x: x is not null and x <> '') as l from c),
p as (select *, coalesce(lag(l) over (partition by doc_id order by pos, start_s nulls first, end_s nulls first, l), []) as p from k), f as (select *, list_filter(l, lambda x: not list_contains(p, x)) as kept from p),
q as (select doc_id, pos, start_s, end_s, array_to_string(kept, ' ') as text from f where len(kept) > 0)"""


@query("w7_caption_lines", f"with {_ROLL} select doc_id, pos, text from q")
def _(spark, d):
    return P.rolling_lines(_t(spark, d, "cues")).select("doc_id", "pos", "text")


_SEG = f"""with recursive {_ROLL}, r as (select *, row_number() over (partition by doc_id order by pos, start_s nulls first, end_s nulls first, text) as rn, length(text) as n from q),
s as (select doc_id, rn, n as held, 0 as c from r where rn = 1 union all
  select r.doc_id, r.rn, case when s.held + 1 + r.n <= 1800 then s.held + 1 + r.n else r.n end, case when s.held + 1 + r.n <= 1800 then s.c else s.c + 1 end from s join r on r.doc_id = s.doc_id and r.rn = s.rn + 1),
g as (select s.doc_id, s.c as segment_index, string_agg(r.text, ' ' order by r.rn) as text, (arg_min({{'v': r.start_s}}, r.rn)).v as time_start, (arg_max({{'v': r.end_s}}, r.rn)).v as time_end, count(*) as n_cues from s join r on r.doc_id = s.doc_id and r.rn = s.rn group by all)"""


@query("t6_caption_segments", _SEG + " select * from g")
def _(spark, d):
    return P.caption_segments(P.rolling_lines(_t(spark, d, "cues")))


@query("x6_caption_chunks", _SEG + ", v as (select sha256, min(commission_slug) as slug, min(day_no) as day_no from registry where sha256 is not null group by sha256) select sha256(g.doc_id || ':' || cast(g.segment_index as varchar) || ':' || g.text) as chunk_id, g.doc_id as doc_sha256, g.segment_index as chunk_index, v.slug as commission_slug, v.day_no, g.time_start, g.time_end, g.n_cues as n_turns, length(g.text) as char_count from g left join v on v.sha256 = g.doc_id")
def _(spark, d):
    s = P.caption_segments(P.rolling_lines(_t(spark, d, "cues")))
    v = _t(spark, d, "registry").where("sha256 is not null").groupBy(F.col("sha256").alias("doc_id")).agg(F.min("commission_slug").alias("commission_slug"), F.min("day_no").alias("day_no"))
    return s.join(v, "doc_id", "left").select(T.chunk_id(F.col("doc_id"), F.col("segment_index"), F.col("text")).alias("chunk_id"), F.col("doc_id").alias("doc_sha256"), F.col("segment_index").alias("chunk_index"), "commission_slug", "day_no", "time_start", "time_end", F.col("n_cues").alias("n_turns"), F.length("text").alias("char_count"))


@query("s4_vtt_scan", r"""with c as (select distinct doc_id, pos, start_s, end_s, lines from cues), k as (select doc_id, pos, start_s, end_s, list_filter(list_transform(coalesce(lines, []), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '\s+', ' ', 'g'))), lambda x: x is not null and x <> '') as l from c)
select doc_id, pos, round(start_s, 3) as start_s, round(end_s, 3) as end_s, array_to_string(l, ' | ') as shown from k where len(l) > 0 and start_s between 0 and 359999 and end_s between 0 and 359999""")
def _(spark, d):
    """Cues written as WebVTT files of 500 cues and read again."""
    c = _t(spark, d, "cues").distinct().where("start_s between 0 and 359999 and end_s between 0 and 359999")
    ms = lambda x: F.round(F.col(x) * 1000).cast("long")
    two = lambda x, n=2: F.lpad(x.cast("string"), n, "0")
    part = lambda x, unit, mod: F.floor(ms(x) / unit) % mod
    stamp = lambda x: F.concat(two(part(x, 3600000, 1000)), F.lit(":"), two(part(x, 60000, 60)), F.lit(":"), two(part(x, 1000, 60)), F.lit("."), two(ms(x) % 1000, 3))
    block = F.concat(F.col("pos").cast("string"), F.lit("\n"), stamp("start_s"), F.lit(" --> "), stamp("end_s"), F.lit(" align:start\n"), F.array_join(F.filter(F.coalesce("lines", F.array().cast("array<string>")), lambda x: x != ""), "\n"), F.lit("\n\n"))
    rows = c.select(F.concat("doc_id", F.lit("/"), F.floor(F.col("pos") / 500).cast("string")).alias("path"), "pos", block.alias("b"))
    files = rows.groupBy("path").agg(F.concat(F.lit("WEBVTT\n\nNOTE made here\n\n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "b"))), lambda x: x["b"]), "")).alias("text"))
    read = P.vtt_cues(written(files, "vtt"))
    # cues without lines give none, so places are told by time
    t = read.select(F.substring_index("path", "/", 1).alias("doc_id"), F.substring_index("path", "/", -1).cast("int").alias("_f"), F.col("pos").alias("_n"), "start_s", "end_s", F.array_join("lines", " | ").alias("shown"))
    has = c.withColumn("_l", F.filter(F.transform(F.coalesce("lines", F.array().cast("array<string>")), T.cue_line), lambda x: x != "")).where(F.size("_l") > 0).withColumn("_f", F.floor(F.col("pos") / 500).cast("int"))
    has = O.running_sum(has.select("doc_id", "pos", "_f"), ["doc_id", "_f"], "pos", [], F.lit(1), "_k").select("doc_id", "_f", "pos", (F.col("_k") - 1).alias("_n"))
    return t.join(has, ["doc_id", "_f", "_n"]).select("doc_id", "pos", "start_s", "end_s", "shown")


@query("f18_timestamps", "select doc_id, pos, start_s, round(start_s, 3) as seconds from (select distinct doc_id, pos, start_s from cues) where start_s between 0 and 3599")
def _(spark, d):
    c = _t(spark, d, "cues").select("doc_id", "pos", "start_s").distinct().where("start_s between 0 and 3599")
    ms = F.round(F.col("start_s") * 1000).cast("long")
    two = lambda x, n=2: F.lpad(x.cast("string"), n, "0")
    stamp = F.concat(two(F.floor(ms / 60000)), F.lit(":"), two(F.floor(ms / 1000) % 60), F.lit("."), two(ms % 1000, 3))
    return c.select("doc_id", "pos", "start_s", T.timestamp_seconds(stamp).alias("seconds"))


@query("j6_t7_containment", rf"""with l as (select doc_id, page_no, unnest(list_transform(string_split(text, chr(10)), lambda y: trim(regexp_replace(y, '{_WS}', ' ', 'g')))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from (select distinct doc_id, page_no, text from pages)),
w as (select doc_id, string_split(string_agg(x, ' ' order by page_no, i), ' ') as w from l where x <> '' and not regexp_matches(x, '{T.LAYOUT}') group by doc_id),
s as (select distinct doc_id, unnest(case when len(w) < 10 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) end) as s from w),
c as (select doc_id, count(*) as n from s group by doc_id),
r as (select distinct commission_slug as s, sha256 as h, day_no as d, hearing_date as t from registry where sha256 in (select doc_id from pages)),
p as (select distinct least(a.h, b.h) as doc_a, greatest(a.h, b.h) as doc_b from r a join r b on a.s = b.s and a.h <> b.h and (a.d = b.d or (a.t = b.t and a.t <> '') or abs(a.d - b.d) = 1)),
k as (select p.doc_a, p.doc_b, count(*) as k from p join s x on x.doc_id = p.doc_a join s y on y.doc_id = p.doc_b and y.s = x.s group by all)
select p.doc_a, p.doc_b, coalesce(k.k / ca.n::double, 0) as a_in_b, coalesce(k.k / cb.n::double, 0) as b_in_a, greatest(coalesce(k.k / ca.n::double, 0), coalesce(k.k / cb.n::double, 0)) >= 0.6 as is_duplicate
from p left join c ca on ca.doc_id = p.doc_a left join c cb on cb.doc_id = p.doc_b left join k on k.doc_a = p.doc_a and k.doc_b = p.doc_b""")
def _(spark, d):
    return C.containment(*_t(spark, d, "registry", "pages"))
