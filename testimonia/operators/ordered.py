"""Neighbours, carried values, running sums and greedy packing in ordered rows, without one task per group.

A group (a document, a video) can hold a third of all rows, so no window here spans a group. Rows are cut into blocks
of ``size`` order values; windows run inside a block, and a table with one row per block carries values across.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SIZE = 2048


def with_block(df: DataFrame, order: str, size: int = SIZE) -> DataFrame:
    """Adds ``_blk``; a null order value falls into a block of its own, before all others."""
    return df.withColumn("_blk", F.coalesce(F.floor(F.col(order) / F.lit(size)), F.lit(-(2**62))).cast("long"))


def _joined(df: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of its block, null keys being equal."""
    other = blocks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in blocks.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(other, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def following(df: DataFrame, part: list[str], order: str, value: Column, out: str, n: int = 1, size: int = SIZE) -> DataFrame:
    """Adds ``out``, an array of ``value`` of up to ``n`` rows that follow in the same ``part`` by ``order``.

    Rows with equal order values follow each other by the value. An empty table gives an empty table; null parts are
    a group of their own.
    """
    df = with_block(df, order, size).withColumn("_v", F.struct(F.col(order).alias("o"), value.alias("v")))
    keys = [*part, "_blk"]
    w = Window.partitionBy(*keys).orderBy("_v")
    first = df.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("_v")), 1, n).alias("_first"))
    across = Window.partitionBy(*part).orderBy("_blk")
    after = F.flatten(F.filter(F.array(*[F.lead("_first", i).over(across) for i in range(1, n + 1)]), lambda x: x.isNotNull()))
    first = first.select(*keys, F.slice(after, 1, n).alias("_next"))
    df = df.withColumn("_in", F.filter(F.array(*[F.lead("_v", i).over(w) for i in range(1, n + 1)]), lambda x: x.isNotNull()))
    df = _joined(df, first, keys)
    both = F.slice(F.concat("_in", F.coalesce("_next", F.slice("_in", 1, 0))), 1, n)
    return df.withColumn(out, F.transform(both, lambda x: x["v"])).drop("_blk", "_v", "_in", "_next")


def preceding(df: DataFrame, part: list[str], order: str, tie: list[str], value: Column, out: str, size: int = SIZE) -> DataFrame:
    """Adds ``out``, ``value`` of the row before by (order, tie) in the same part; null for the first row."""
    df = with_block(df, order, size).withColumn("_v", F.struct(value.alias("v")))
    keys, by = [*part, "_blk"], [F.col(order).asc_nulls_first(), *tie]
    w = Window.partitionBy(*keys).orderBy(*by)
    df = df.withColumn("_before", F.lag("_v").over(w)).withColumn("_rn", F.row_number().over(w))
    across = Window.partitionBy(*part).orderBy("_blk")
    last = df.groupBy(*keys).agg(F.max_by("_v", "_rn").alias("_last")).select(*keys, F.lag("_last").over(across).alias("_carry"))
    return _joined(df, last, keys).withColumn(out, F.coalesce("_before", "_carry")["v"]).drop("_blk", "_v", "_before", "_rn", "_carry")


def last_seen(df: DataFrame, part: list[str], order: str, tie: list[str], value: Column, out: str, size: int = SIZE) -> DataFrame:
    """Adds ``out``: the last ``value`` that is not null up to and including the row, by (order, tie) in the same part."""
    df = with_block(df, order, size).withColumn("_v", value)
    keys, by = [*part, "_blk"], [F.col(order).asc_nulls_first(), *tie]
    w = Window.partitionBy(*keys).orderBy(*by)
    df = df.withColumn("_in", F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_rn", F.row_number().over(w))
    across = Window.partitionBy(*part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    last = df.groupBy(*keys).agg(F.max_by("_in", "_rn").alias("_last")).select(*keys, F.last("_last", ignorenulls=True).over(across).alias("_carry"))
    return _joined(df, last, keys).withColumn(out, F.coalesce("_in", "_carry")).drop("_blk", "_v", "_in", "_rn", "_carry")


def running_sum(df: DataFrame, part: list[str], order: str, tie: list[str], value: Column, out: str, size: int = SIZE) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and including the row, by (order, tie) in the same part."""
    df = with_block(df, order, size).withColumn("_v", F.coalesce(value.cast("long"), F.lit(0).cast("long")))
    keys, by = [*part, "_blk"], [F.col(order).asc_nulls_first(), *tie]
    inside = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys).agg(F.sum("_v").alias("_s")).select(*keys, F.coalesce(F.sum("_s").over(across), F.lit(0).cast("long")).alias("_had"))
    return _joined(df.withColumn("_in", F.sum("_v").over(inside)), sums, keys).withColumn(out, F.col("_in") + F.col("_had")).drop("_blk", "_v", "_in", "_had")


def greedy_starts(df: DataFrame, part: str, order: str, n: str, solo: str, limit: int, gap: int = 1, size: int = SIZE) -> DataFrame:
    """Adds ``begins``: whether the row begins a parcel when rows are packed in order into parcels of at most ``limit`` characters.

    ``n``: a row's length; ``gap``: the length of a joint; ``solo`` rows stand alone. ``order`` is unique in a part. The
    packing is sequential, but a block needs only the length held open at its start. For each block a table says, for each
    of its first rows that a parcel from before could end at, what is held at its end; these tables, a few numbers a
    block, are followed block by block, and then all blocks are packed at once.
    """
    kind, order_kind = (df.schema[c].dataType.simpleString() for c in (part, order))
    rows = with_block(df.select(part, order, n, solo), order, size)
    # a part of one block begins with nothing held; only the others need tables
    blocks = rows.select(part, "_blk").distinct()
    several = blocks.groupBy(part).agg(F.count("*").alias("_c")).where("_c > 1").select(part)

    def table(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        sizes, own = pdf[n].to_numpy(np.int64), pdf[solo].to_numpy(bool)
        # at the end, after a parcel that begins at row i; filled from the last row to the first
        end, here = np.zeros(len(sizes) + 1, np.int64), np.cumsum(sizes + gap)
        for i in range(len(sizes) - 1, -1, -1):
            if own[i]:
                end[i] = end[i + 1] if i + 1 < len(sizes) else 0
                continue
            j, held = i + 1, max(int(sizes[i]), 1)
            while j < len(sizes) and not own[j] and held + gap + sizes[j] <= limit:
                held += gap + int(sizes[j])
                j += 1
            end[i] = held if j == len(sizes) else end[j]
        reach = int(np.searchsorted(here, limit, "right")) + 1
        solos = np.flatnonzero(own)
        reach = min(reach, int(solos[0]) + 1 if len(solos) else reach, len(sizes))
        return pd.DataFrame({part: [key[0]], "_blk": [key[1]], "grow": [here[:reach].tolist()], "exits": [end[:reach].tolist()], "solo_at": [int(solos[0]) if len(solos) else -1], "total": [int(here[-1])]})

    tables = rows.join(several, part, "left_semi").groupBy(part, "_blk").applyInPandas(table, f"{part} {kind}, _blk long, grow array<long>, exits array<long>, solo_at long, total long")

    def follow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held, out = 0, []
        for r in pdf.sort_values("_blk").itertuples(index=False):
            out.append((key[0], r[1], held))
            grow, exits = r.grow, r.exits
            if held == 0:
                held = int(exits[0])
            else:
                # the first row that no longer fits begins a parcel of its own
                j = next((i for i, g in enumerate(grow) if i == r.solo_at or held + g > limit), None)
                held = held + int(r.total) if j is None else int(exits[j])
        return pd.DataFrame(out, columns=[part, "_blk", "held"])

    held = tables.groupBy(part).applyInPandas(follow, f"{part} {kind}, _blk long, held long")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_ = None, 0
        for b in batches:
            parts, orders = b.column(0), b.column(2)
            begins = []
            for p, k, size_, own, before in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5))):
                if (p, k) != now:
                    now, open_ = (p, k), before or 0
                if own:
                    begins.append(True)
                    open_ = 0
                elif open_ and open_ + gap + size_ <= limit:
                    begins.append(False)
                    open_ += gap + size_
                else:
                    begins.append(True)
                    open_ = max(size_, 1)
            yield pa.RecordBatch.from_arrays([parts, orders, pa.array(begins, pa.bool_())], [part, order, "begins"])

    rows = rows.join(held, [part, "_blk"], "left").repartition(part, "_blk").sortWithinPartitions(part, "_blk", order)
    marked = rows.select(part, "_blk", order, F.col(n).cast("long"), solo, "held").mapInArrow(mark, f"{part} {kind}, {order} {order_kind}, begins boolean")
    return df.join(marked, [part, order])
