"""Runs of near-identical consecutive events, collapsed to one event each.

Plan: the events are written once, then one range exchange by (entity, order), one sort inside partitions, one pass of a
state machine over each sorted partition. An entity can span many partitions; the first and the last run of each
partition are fragments, and a table of two rows per partition, exchanged to one task, joins those that belong together.
No task ever holds a whole entity.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from testimonia.sources.shared import written
from testimonia.sources.tables import table

SIMILARITY = 0.8
RUN = "entity string, first_pos long, last_pos long, n_events long, start_s double, end_s double, text string"
FRAGMENT = RUN + ", first_text string, last_text string, last_end double, edge int, part int, seq long"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel over the characters of ``a``."""
    if not a or not b:
        return len(a) + len(b)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    pv, mv, score = full, 0, len(a)
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        score += 1 if ph & top else -1 if mh & top else 0
        ph = ph << 1 | 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv
    return score


def near_identical(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    """1 - distance / longer length >= similarity, with cheap bounds first."""
    if a == b:
        return True
    longer = max(len(a), len(b))
    # the same arithmetic as the definition, so that a tie falls the same way
    ok = lambda d: 1 - d / longer >= similarity
    if not ok(abs(len(a) - len(b))):
        return False
    return ok(edit_distance(a, b))


def _joins(prev_text, prev_end, text, start, similarity: float, max_gap: float | None) -> bool:
    if max_gap is not None and prev_end is not None and start is not None and start - prev_end > max_gap:
        return False
    return near_identical(prev_text, text, similarity)


def event_text(lines: Column) -> Column:
    """Lines joined by a blank, without markup, lower case, letters, digits and single blanks only."""
    joined = F.regexp_replace(F.array_join(lines, " "), "<[^>]*>", "")
    kept = F.regexp_replace(F.lower(F.regexp_replace(joined, r"(?U)\s+", " ")), r"[^\p{L}\p{N} ]", "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def _fragments(batches: Iterator[pa.RecordBatch], similarity: float, max_gap: float | None) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    names = ["entity", "first_pos", "last_pos", "n_events", "start_s", "end_s", "text", "first_text", "last_text", "last_end", "edge", "part", "seq"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64()]
    run: list | None = None
    row = None
    out: list[list] = []
    seq = 0

    def flush(last: bool) -> None:
        nonlocal seq
        edge = (1 if seq == 0 else 0) | (2 if last else 0)
        inner = edge == 0
        out.append([*run[:7], None if inner else run[7], None if inner else run[8], None if inner else run[9], edge, part, seq])
        seq += 1

    for batch in batches:
        for now in zip(*[batch.column(k).to_pylist() for k in ("entity", "pos", "start_s", "end_s", "text", "shown")]):
            if now == row:  # delivered twice
                continue
            row = now
            entity, pos, start, end, text, shown = now
            if run is not None and run[0] == entity and _joins(run[8], run[9], text, start, similarity, max_gap):
                run[2] = pos
                run[3] += 1
                run[4] = start if run[4] is None else run[4] if start is None else min(run[4], start)
                run[5] = end if run[5] is None else run[5] if end is None else max(run[5], end)
                run[8], run[9] = text, end
            else:
                if run is not None:
                    flush(False)
                run = [entity, pos, pos, 1, start, end, shown, text, text, end]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []
    if run is not None:
        flush(True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _stitch(batches: Iterator[pa.RecordBatch], similarity: float, max_gap: float | None) -> Iterator[pa.RecordBatch]:
    """Joins the edge fragments, at most two per partition of the first pass, in their order."""
    rows = sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=lambda r: (r[11], r[12]))
    done: list[list] = []
    for r in map(list, rows):
        p = done[-1] if done else None
        # consecutive in the whole order: p ends its partition, r begins a later one
        if p is not None and p[10] & 2 and r[10] & 1 and p[11] < r[11] and p[0] == r[0]:
            if _joins(p[8], p[9], r[7], r[4], similarity, max_gap):
                p[2], p[3] = r[2], p[3] + r[3]
                p[4] = min((x for x in (p[4], r[4]) if x is not None), default=None)
                p[5] = max((x for x in (p[5], r[5]) if x is not None), default=None)
                p[8], p[9], p[10], p[11], p[12] = r[8], r[9], r[10], r[11], r[12]
                continue
        done.append(r)
    names = ["entity", "first_pos", "last_pos", "n_events", "start_s", "end_s", "text"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)


def collapse_runs(events: DataFrame, similarity: float = SIMILARITY, max_gap: float | None = None) -> DataFrame:
    """One row per maximal run of events, each near-identical to the one before it.

    ``events``: entity string, pos long, start_s double, end_s double, text string (what is compared) and, if it is
    there, shown string, of which a run has its first event's as its text; else it has that event's text. Other columns
    are not read. The anchor with which an event is compared moves along: it is the run's latest event. ``max_gap``:
    seconds between the anchor's end and the event's start beyond which a run ends; None or a null time: no limit.
    Events with a null or empty text are no events. A row delivered twice counts once. Equal positions are ordered by
    times and text. A null entity is an entity of its own; a null position comes first. An empty table gives no rows.
    """
    shown = F.col("shown") if "shown" in events.columns else F.col("text")
    events = events.select("entity", "pos", "start_s", "end_s", "text", shown.alias("shown")).where("text <> ''")
    order = ["entity", "pos", "start_s", "end_s", "text", "shown"]
    # a range exchange reads its input twice, once for the bounds: what is cleaned is written first
    ranged = written(events, "events").repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(lambda it: _fragments(it, similarity, max_gap), FRAGMENT)
    # the pass over the sorted rows is Python work: it is written once and both branches read it
    pieces = written(pieces, "runs")
    inner = pieces.where("edge = 0").select("entity", "first_pos", "last_pos", "n_events", "start_s", "end_s", "text")
    edges = pieces.where("edge <> 0").repartition(1)  # two rows a partition; the scan and the filter stay parallel
    runs = inner.unionByName(edges.mapInArrow(lambda it: _stitch(it, similarity, max_gap), RUN))
    return runs.withColumn("duration_s", F.col("end_s") - F.col("start_s"))


def caption(lines: Column) -> Column:
    """Lines joined by a blank as they are shown: without markup, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.array_join(lines, " "), "<[^>]*>", ""), r"(?U)\s+", " "))


def cue_events(spark: SparkSession, directory: str) -> DataFrame:
    c = table(spark, directory, "cues")
    return c.select(F.col("doc_id").alias("entity"), F.col("pos").cast("long").alias("pos"), "start_s", "end_s", event_text(F.col("lines")).alias("text"), caption(F.col("lines")).alias("shown"))


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    return collapse_runs(cue_events(spark, directory).drop("shown")).where("n_events > 1").select(F.col("entity").alias("doc_id"), "first_pos", "last_pos").distinct()


def p1_runs(spark: SparkSession, directory: str) -> DataFrame:
    """Every caption once, as shown, with its number of cues and its time."""
    return collapse_runs(cue_events(spark, directory)).withColumnRenamed("entity", "doc_id")
