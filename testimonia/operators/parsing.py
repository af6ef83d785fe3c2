"""Pages to running text, turns and passages; caption cues to segments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from testimonia.functions import text as T
from testimonia.operators import ordered as O
from testimonia.sources.shared import written

MAX_CHARS = 1800


def surviving_lines(pages: DataFrame) -> DataFrame:
    """doc_id, page_no, text: each page's lines that are no furniture, trimmed, joined by one blank, single blanks; empty pages go."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: ~T.is_furniture(x))
    p = pages.select("doc_id", "page_no", F.array_join(lines, " ").alias("text")).where("text <> ''")
    # a page delivered twice counts once: keys and a hash are compared, not the text
    return p.groupBy("doc_id", "page_no", F.xxhash64("text").alias("_h")).agg(F.first("text").alias("text")).select("doc_id", "page_no", "text")


def document_text(pages: DataFrame) -> DataFrame:
    """One row per document: text, and starts, the offset in it at which each page's part begins (the joint belongs to the page that follows)."""
    p = surviving_lines(pages).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    text = F.array_join("p.text", " ")
    starts = F.expr("""aggregate(p, named_struct('at', 0, 's', cast(array() as array<struct<offset:int,page_no:int>>)),
      (a, x) -> named_struct('at', a.at + length(x.text) + 1, 's', concat(a.s, array(named_struct('offset', greatest(0, a.at - 1), 'page_no', x.page_no)))))""")
    return p.select("doc_id", text.alias("text"), starts["s"].alias("starts"))


def page_of(starts: Column, offset: Column) -> Column:
    """The page of the character at ``offset`` (from 0, clamped to the text); 0 for a document without text."""
    before = F.filter(starts, lambda s: s["offset"] <= F.greatest(offset, F.lit(0)))
    return F.when(F.size(starts) > 0, F.element_at(before, -1)["page_no"]).otherwise(F.lit(0))


def turn_rows(pages: DataFrame) -> DataFrame:
    """doc_id, label_no, page_no, kind (0 the rest of an earlier turn, 1 a label), label, body: the pages cut at speakers' labels.

    A label can go on over the end of a page. The last capitals of a page, which could be the head of a label, are
    therefore read with the next page; no page sees more than its neighbour's end.
    """
    p = surviving_lines(pages).withColumn("_tail", F.regexp_extract("text", r"(?:^|(?<=\s))([A-Z.'/()\s-]+)$", 1))
    p = O.preceding(p, ["doc_id"], "page_no", ["text"], F.struct("_tail", "page_no"), "_prev")
    lead = F.coalesce(F.col("_prev")["_tail"], F.lit(""))
    own = F.expr("substr(text, 1, length(text) - length(_tail))")
    p = O.following(p.withColumn("_lead", lead), ["doc_id"], "page_no", F.lit(True), "_after")
    body = F.when(F.size("_after") > 0, own).otherwise(F.col("text"))
    p = p.withColumn("_all", F.trim(F.regexp_replace(F.concat(F.col("_lead"), F.lit(" "), body), r"\s+", " ")))
    # the label's page is the one before while it stands in the part that was taken over from there
    p = p.withColumn("_marked", F.regexp_replace(F.concat(F.col("_all"), F.lit(" ")), T.LABEL_PATTERN, "\u0001$1\u0002"))
    parts = F.split("_marked", "\u0001", -1)
    p = p.select("doc_id", "page_no", F.col("_prev")["page_no"].alias("_before"), F.length(F.trim(F.col("_lead"))).alias("_n"), F.posexplode(parts).alias("i", "s"), parts.alias("_parts"))
    label = F.substring_index("s", "\u0002", 1)
    # the offset of a label on its page, counted in what stood before it: only whether it is inside the part taken over matters
    at = F.aggregate(F.slice("_parts", 1, F.col("i")), F.lit(0), lambda a, x: a + F.length(x))
    p = p.withColumn("_page", F.when((F.col("i") > 0) & (at < F.col("_n")) & F.col("_before").isNotNull(), F.col("_before")).otherwise(F.col("page_no")))
    rows = p.select("doc_id", "page_no", "i", F.col("_page").alias("label_page"), F.when(F.col("i") > 0, T.normalise_label(label)).alias("label"), F.trim(F.when(F.col("i") > 0, F.expr("substr(s, instr(s, '\u0002') + 1)")).otherwise(F.col("s"))).alias("body"))
    return O.running_sum(rows, ["doc_id"], "page_no", ["i"], (F.col("i") > 0).cast("int"), "label_no")


def detected_turns(pages: DataFrame) -> DataFrame:
    """doc_id, turn_no (from 1), speaker, text, page_start, page_end: the turns of each document's running text.

    Text before the first label and labels without words give no turn. A turn ends on the page where the next label
    stands. Null and blank pages have no text; a page delivered twice counts once.
    """
    rows = turn_rows(pages)
    heads = rows.where("i > 0").select("doc_id", "label_no", F.col("label").alias("speaker"), F.col("label_page").alias("page_start"))
    nexts = heads.select("doc_id", (F.col("label_no") - 1).alias("label_no"), F.col("page_start").alias("_next"))
    last = rows.groupBy("doc_id").agg(F.max("page_no").alias("_last"))
    body = rows.where("label_no > 0 and body <> ''").groupBy("doc_id", "label_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_no", "i", "body"))), lambda x: x["body"]), " ").alias("text"))
    t = heads.join(body, ["doc_id", "label_no"]).join(nexts, ["doc_id", "label_no"], "left").join(last, "doc_id")
    t = O.running_sum(t, ["doc_id"], "label_no", [], F.lit(1), "turn_no")
    return t.select("doc_id", "turn_no", "speaker", "text", "page_start", F.coalesce("_next", "_last").alias("page_end"))


def _split_sentences(text: str, budget: int) -> list[str]:
    import re

    out, now = [], ""
    for s in re.split(r"(?<=[.?!])\s+", text):
        if len(s) > budget:
            out += [now] if now else []
            out += [s[i : i + budget] for i in range(0, len(s), budget)]
            now = ""
        elif now and len(now) + 1 + len(s) > budget:
            out.append(now)
            now = s
        else:
            now = f"{now} {s}".strip()
    return out + ([now] if now else [])


def split_turns(turns: DataFrame, limit: int = MAX_CHARS) -> DataFrame:
    """Rows whose "speaker: text" exceeds ``limit``, with ``pieces``: filled sentence by sentence, each with the speaker before it."""

    @F.pandas_udf("array<string>")
    def pieces(speaker: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([[f"{s}: {p}" for p in _split_sentences(t, max(1, limit - len(s) - 2))] for s, t in zip(speaker, text)])

    return turns.where(F.length("speaker") + 2 + F.length("text") > limit).withColumn("pieces", pieces("speaker", "text"))


def packed_turns(turns: DataFrame, limit: int = MAX_CHARS) -> DataFrame:
    """doc_id, chunk_index (from 0), text, speakers, n_turns, page_start, page_end: turns packed in order, "speaker: text" by lines.

    ``turns``: doc_id, turn_no, speaker, text, page_start, page_end; turn_no is unique in a document. A turn longer than
    ``limit`` ends the passage before it and is split into passages of its own. Turns without a text are left out; a null
    speaker is written as an empty one.
    """
    t = turns.where("text <> ''").select("doc_id", F.col("turn_no").cast("long").alias("turn_no"), F.coalesce("speaker", F.lit("")).alias("speaker"), "text", "page_start", "page_end")
    t = t.withColumn("n", F.length("speaker") + 2 + F.length("text")).withColumn("solo", F.col("n") > limit)
    t = O.greedy_starts(written(t, "turns"), "doc_id", "turn_no", "n", "solo", limit)
    long = split_turns(t.where("solo"), limit).select("doc_id", "turn_no", "pieces")
    t = t.join(long, ["doc_id", "turn_no"], "left")
    weight = F.when(F.col("solo"), F.size("pieces")).when(F.col("begins"), 1).otherwise(0)
    # two branches read what is packed: it is written once
    t = written(O.running_sum(t.withColumn("_w", weight), ["doc_id"], "turn_no", [], F.col("_w"), "_to"), "packed")
    alone = t.where("solo").select("doc_id", (F.col("_to") - F.col("_w")).alias("_at"), F.posexplode("pieces").alias("_i", "text"), "speaker", "page_start", "page_end")
    alone = alone.select("doc_id", (F.col("_at") + F.col("_i")).alias("chunk_index"), "text", F.array("speaker").alias("speakers"), F.lit(1).cast("long").alias("n_turns"), "page_start", "page_end")
    g = t.where("not solo").groupBy("doc_id", (F.col("_to") - 1).alias("chunk_index")).agg(F.sort_array(F.collect_list(F.struct("turn_no", "speaker", "text", "page_start", "page_end"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: F.concat(x["speaker"], F.lit(": "), x["text"])), "\n")
    packed = g.select("doc_id", "chunk_index", joined.alias("text"), F.array_distinct("p.speaker").alias("speakers"), F.size("p").cast("long").alias("n_turns"), F.col("p")[0]["page_start"].alias("page_start"), F.element_at("p", -1)["page_end"].alias("page_end"))
    return packed.unionByName(alone)


def rolling_lines(cues: DataFrame) -> DataFrame:
    """Cues with the lines that the cue before does not show; cues left without lines go: doc_id, pos, start_s, end_s, text.

    Lines are cleaned of tags and runs of blanks first. The cue before counts with all of its lines, those left out too.
    """
    clean = F.filter(F.transform(F.coalesce("lines", F.array().cast("array<string>")), T.cue_line), lambda x: x.isNotNull() & (x != ""))
    c = cues.distinct().select("doc_id", "pos", "start_s", "end_s", clean.alias("lines"))
    c = O.preceding(c, ["doc_id"], "pos", ["start_s", "end_s", "lines"], F.col("lines"), "_prev")
    c = c.withColumn("_prev", F.coalesce("_prev", F.array().cast("array<string>")))
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("_prev"), x))
    return c.withColumn("kept", kept).where(F.size("kept") > 0).select("doc_id", "pos", "start_s", "end_s", F.array_join("kept", " ").alias("text"))


def caption_segments(cues: DataFrame, limit: int = MAX_CHARS) -> DataFrame:
    """doc_id, segment_index (from 0), text, time_start, time_end, n_cues: cues (doc_id, pos, start_s, end_s, text) packed in order.

    A cue is never split: one longer than ``limit`` is a segment of its own. Cues without a text are left out. Cues of one
    position are put in order by their times and text.
    """
    c = cues.where("text <> ''").select("doc_id", F.col("pos").cast("long").alias("_p"), "start_s", "end_s", "text")
    c = O.running_sum(c, ["doc_id"], "_p", ["start_s", "end_s", "text"], F.lit(1), "pos")
    c = c.withColumn("n", F.length("text")).withColumn("solo", F.lit(False))
    c = O.greedy_starts(c, "doc_id", "pos", "n", "solo", limit)
    c = O.running_sum(c, ["doc_id"], "pos", [], F.col("begins").cast("int"), "_to")
    g = c.groupBy("doc_id", (F.col("_to") - 1).alias("segment_index")).agg(F.sort_array(F.collect_list(F.struct("pos", "text", "start_s", "end_s"))).alias("p"))
    return g.select("doc_id", "segment_index", F.array_join("p.text", " ").alias("text"), F.col("p")[0]["start_s"].alias("time_start"), F.element_at("p", -1)["end_s"].alias("time_end"), F.size("p").cast("long").alias("n_cues"))


def vtt_cues(files: DataFrame) -> DataFrame:
    """path, pos (from 0), start_s, end_s, lines of WebVTT texts (path, text).

    Headers, notes, identifiers and settings are passed over; only an empty line ends a cue, a blank one does not; cues
    without lines or with an impossible time give none. A null text is an empty one.
    """
    lines = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "^﻿", ""), "\r\n|\n|\r", -1)
    l = files.select("path", F.posexplode(lines).alias("no", "line"))
    cue = r"^\s*([\d:.]+)\s+-->\s+([\d:.]+)(?:\s.*)?$"
    is_cue = F.col("line").rlike(cue)
    start, end = T.timestamp_seconds(F.regexp_extract("line", cue, 1)), T.timestamp_seconds(F.regexp_extract("line", cue, 2))
    # what the line changes: a cue begins, or an empty line (or a cue with an impossible time) closes the one before
    change = F.when(is_cue & start.isNotNull() & end.isNotNull(), F.struct(F.lit(True).alias("open"), F.col("no").alias("at"), start.alias("s"), end.alias("e")))
    change = change.when(is_cue | (F.col("line") == ""), F.struct(F.lit(False).alias("open"), F.col("no").alias("at"), F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e")))
    l = O.last_seen(l, ["path"], "no", [], change, "_c")
    text = T.cue_line(F.col("line"))
    l = l.where(F.col("_c")["open"] & ~is_cue).withColumn("t", text).where("t <> ''")
    c = l.groupBy("path", F.col("_c")["at"].alias("at"), F.col("_c")["s"].alias("start_s"), F.col("_c")["e"].alias("end_s")).agg(F.transform(F.sort_array(F.collect_list(F.struct("no", "t"))), lambda x: x["t"]).alias("lines"))
    return O.running_sum(c, ["path"], "at", [], F.lit(1), "_n").select("path", (F.col("_n") - 1).alias("pos"), "start_s", "end_s", "lines")
