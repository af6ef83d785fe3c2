"""Queries of this package and, where SQL can say the same in reasonable time, the SQL that they are checked with."""

from __future__ import annotations

from testimonia.llm import cooccurrence, mixture, names, near_duplicates, pieces, repeats, scans, spam, speakers, tokens

QUERIES = {
    "p1_found": repeats.p1_found,
    "p1_runs": repeats.p1_runs,
    "p2_found": scans.p2_found,
    "p2_paragraphs": scans.p2_paragraphs,
    "p3_found": pieces.p3_found,
    "p3_pieces": pieces.p3_pieces,
    "p3_file_pieces": pieces.p3_file_pieces,
    "p4_found": speakers.p4_found,
    "p4_turns": speakers.p4_turns,
    "p4_caption_turns": speakers.p4_caption_turns,
    "p5_found": cooccurrence.p5_found,
    "p5_surprise": cooccurrence.p5_surprise,
    "p6_found": names.p6_found,
    "p7_found": near_duplicates.p7_found,
    "p7_classes": near_duplicates.p7_classes,
    "p8_ids": tokens.p8_ids,
    "p9_mix": mixture.p9_mix,
    "p9_shares": mixture.p9_shares,
    "p10_found": spam.p10_found,
    "p10_scores": spam.p10_scores,
}

_EVENTS = r"""
with e as (
  select distinct doc_id, pos, start_s, end_s,
    trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(array_to_string(lines, ' '), '<[^>]*>', '', 'g')), '\s+', ' ', 'g'), '[^\p{L}\p{N} ]', '', 'g'), ' +', ' ', 'g')) as t
  from cues),
l as (select *, lag(t) over w as p from e where t <> '' window w as (partition by doc_id order by pos)),
f as (select *, case when p is not null and 1 - levenshtein(t, p) / greatest(length(t), length(p)) >= 0.8 then 0 else 1 end as b from l),
g as (select *, sum(b) over (partition by doc_id order by pos) as run from f)
"""

SQL = {
    "p1_found": _EVENTS + "select doc_id, cast(min(pos) as bigint) as first_pos, cast(max(pos) as bigint) as last_pos from g group by doc_id, run having count(*) > 1",
    "p3_found": "select distinct chunk_id from chunks where length(text) > 1800",
    "p1_runs": _EVENTS.replace("select distinct doc_id, pos, start_s, end_s,", "select distinct doc_id, pos, start_s, end_s, lines,").replace("order by pos)", "order by pos, start_s, end_s, t, lines)") + r"""
select doc_id, cast(min(pos) as bigint) as first_pos, cast(max(pos) as bigint) as last_pos, count(*) as n_events, min(start_s) as start_s, max(end_s) as end_s,
  trim(regexp_replace(regexp_replace(array_to_string(arg_min(lines, pos), ' '), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) as text, max(end_s) - min(start_s) as duration_s from g group by doc_id, run""",
    "p5_found": r"""
with m as (
  select chunk_id, unnest(list_concat(coalesce(person, []), coalesce(org, []))) as n from mentions
  union all select chunk_id, unnest(list_transform(mentions, lambda x: x.name)) from claims),
i as (select distinct chunk_id, trim(regexp_replace(lower(n), '\s+', ' ', 'g')) as n from m where n is not null),
j as (select * from i where n <> ''),
c as (select n, count(*) as k from j group by n),
t as (select count(distinct chunk_id) as k from j),
p as (select a.n as name_a, b.n as name_b, count(*) as k from j a join j b on a.chunk_id = b.chunk_id and a.n < b.n group by a.n, b.n)
select name_a, name_b from p join c ca on ca.n = name_a join c cb on cb.n = name_b cross join t
where p.k >= 4 and p.k * t.k >= 5 * ca.k * cb.k""",
}

_B = [b.replace("'", "''") for b in pieces.BOUNDARIES]
_B[1] = _B[1].replace("(?=", "(?:")  # what follows the cut is no part of the group
_CUT = "coalesce(" + ", ".join(f"nullif(length(regexp_extract(w, '^{b.replace('(?s)', '(?s:', 1) + ')'}', 1)), 0)" for b in _B) + ", length(w))"

SQL["p3_pieces"] = rf"""
with c as (select distinct chunk_id, text, page_start, page_end, n_turns, coalesce(length(text), 0) as n from chunks),
d as (select *, row_number() over () as id, case when n > 1800 then cast(ceil(n / 1200.0) as bigint) - 1 else 0 end as nc from c),
k as (select *, unnest(range(1, nc + 1)) as k from d), w as (select *, substr(text, k * 1200 - 450 + 1, 450) as w from k),
u as (select id, k, k * 1200 - 450 + {_CUT} as cut from w),
a as (select id, cast(0 as bigint) as k, cast(0 as bigint) as cut from d union all select id, k, cut from u),
e as (select a.*, coalesce(lead(cut) over (partition by id order by k), d.n) as stop, d.* exclude (id) from a join d using (id)),
p as (select *, case when k > 0 then cut - 150 else 0 end as pa from e), q as (select *, substr(text, pa + 1, stop - pa) as piece from p)
select chunk_id, k as piece_no, nc + 1 as n_pieces, pa as piece_start, page_start, page_end, n_turns, len(regexp_extract_all(case when k > 0 then substr(piece, 151) else piece end, '(?m)^\p{{Lu}}[\p{{Lu}} .''-]{{2,60}}:')) as turns_begun, length(piece) as n_chars, piece as text from q"""
