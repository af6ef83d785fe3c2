"""Loads that can be run again: merges, upserts, what is new, what to skip, and whether the numbers agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def upserted_registry(discoveries: DataFrame) -> DataFrame:
    """One row per url from its discoveries in the order of discovered_at, field by field.

    title, hearing_date, source_page_url: the last that is not empty; day_no: the last that is not null; source_type and
    document_type: the last; file data (sha256, size_bytes, filename, local_path, content_type, transcription_method): of
    the last download; notes: of the last download, else the last that is not empty; authoritative, superseded_by and
    discovered_at: the first. Equal times are put in order by sha256, title and notes.
    """
    full = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    order = F.struct(F.col("discovered_at"), F.coalesce("sha256", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("notes", F.lit("")))
    last = lambda c, ok: F.max_by(F.when(ok, F.struct(F.col(c))), F.when(ok, order))[c].alias(c)
    first = lambda c: F.min_by(F.struct(F.col(c)), order)[c].alias(c)
    got, always = F.coalesce("downloaded", F.lit(False)), F.lit(True)
    files = ["sha256", "size_bytes", "filename", "local_path", "content_type", "transcription_method"]
    out = discoveries.groupBy("url").agg(
        *[last(c, full(c)) for c in ("title", "hearing_date", "source_page_url")], last("day_no", F.col("day_no").isNotNull()), *[last(c, always) for c in ("source_type", "document_type")], *[last(c, got) for c in files],
        F.max(got.cast("int")).alias("downloaded"), F.max_by(F.when(got, F.struct("notes")), F.when(got, order)).alias("_n"), F.max_by(F.when(full("notes"), F.struct("notes")), F.when(full("notes"), order)).alias("_m"), *[first(c) for c in ("authoritative", "superseded_by", "discovered_at")],
    )
    return out.withColumn("notes", F.when(F.col("downloaded") == 1, F.col("_n")["notes"]).otherwise(F.col("_m")["notes"])).drop("_n", "_m")


def with_known(found: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """``found``, once per key, with is_new: whether ``known`` lacks it."""
    k = known.select(F.col(key).alias("_k")).distinct()
    one = found.dropDuplicates([key])
    return one.join(k, F.col(key) == F.col("_k"), "left").withColumn("is_new", F.col("_k").isNull()).drop("_k")


def pending(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key is not among what is done."""
    return rows.join(done.select(*key).distinct(), key, "left_anti")


def purged(points: DataFrame, superseded: DataFrame, key: str) -> DataFrame:
    """The points but for those of superseded documents."""
    return points.join(superseded.select(key).distinct(), key, "left_anti")


def load_actions(expected: DataFrame, stored: DataFrame, sources: DataFrame, key: str = "doc_sha256", force: bool = False) -> DataFrame:
    """key, chunks, stored and action of every document with passages: no_source, superseded (then with what to purge), skip, or load.

    ``expected`` and ``stored``: key and one row per passage or point; ``sources``: key and superseded_by.
    """
    e = expected.groupBy(key).agg(F.countDistinct("chunk_id").alias("chunks"))
    s = stored.groupBy(key).agg(F.countDistinct("chunk_id").alias("stored"))
    r = sources.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.coalesce("superseded_by", F.lit(""))).alias("_s"))
    j = e.join(s, key, "left").join(r, key, "left").withColumn("stored", F.coalesce("stored", F.lit(0).cast("long")))
    skip = (F.col("stored") == F.col("chunks")) & F.lit(not force)
    return j.select(key, "chunks", "stored", F.when(F.col("_s").isNull(), "no_source").when(F.col("_s") != "", "superseded").when(skip, "skip").otherwise("load").alias("action"))


def load_counters(actions: DataFrame) -> DataFrame:
    """One row: documents by action, passages loaded, points purged."""
    one = lambda a: F.count(F.when(F.col("action") == a, 1))
    some = lambda a, c: F.coalesce(F.sum(F.when(F.col("action") == a, F.col(c))), F.lit(0).cast("long"))
    return actions.agg(*[one(a).alias(f"docs_{a}") for a in ("load", "skip", "superseded", "no_source")], some("load", "chunks").alias("chunks_loaded"), some("superseded", "stored").alias("points_purged"))


def edge_counters(edges: DataFrame, key: list[str]) -> DataFrame:
    """One row: edges attempted, and edges that a merge by ``key`` keeps."""
    return edges.agg(F.count("*").alias("attempted"), F.countDistinct(F.struct(*key)).alias("stored"))


def within_budget(items: DataFrame, order: str, cost: str, budget: float, blocks: int = 256) -> DataFrame:
    """The items (``order`` unique) before which less than ``budget`` has been spent, with ``spent``.

    One range exchange puts the items in order; sums of whole partitions, one row each, tell where the budget ends, and
    running sums are made inside partitions alone.
    """
    ranged = items.repartitionByRange(blocks, order).withColumn("_p", F.spark_partition_id())
    sums = ranged.groupBy("_p").agg(F.sum(cost).alias("_s"))
    before = sums.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_had"))
    near = before.where(F.col("_had") < budget)
    inside = Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(near), "_p").withColumn("spent", F.col("_had") + F.coalesce(F.sum(cost).over(inside), F.lit(0)))  # one row a partition
    return out.where(F.col("spent") < budget).drop("_p", "_had")


def reconciled(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """(what, parsed, expected) of the numbers that differ: both are one row with the same columns. Empty where all agree."""
    names = [c for c in expected.columns if c in parsed.columns]
    both = parsed.select(*[F.col(c).cast("long").alias(f"p_{c}") for c in names]).crossJoin(expected.select(*[F.col(c).cast("long").alias(f"e_{c}") for c in names]))  # one row each
    rows = F.array(*[F.struct(F.lit(c).alias("what"), F.col(f"p_{c}").alias("parsed"), F.col(f"e_{c}").alias("expected")) for c in names])
    return both.select(F.explode(rows).alias("r")).select("r.*").where(~F.col("parsed").eqNullSafe(F.col("expected")))


def first_seen(rows: DataFrame, key: list[str], day: str) -> DataFrame:
    """The first day of each key; null where no day is known."""
    return rows.groupBy(*key).agg(F.min(day).alias("first_day"))


def spend_totals(spend: DataFrame) -> DataFrame:
    """One row: all cost, that of judges, and the mean per distinct passage at full price, a batch being half of it."""
    cost = F.coalesce("cost_usd", F.lit(0.0))
    full = F.when(F.col("attempt") == "batch", 2 * cost).otherwise(cost)
    judge = F.coalesce("model", F.lit("")).startswith("judge_")
    return spend.agg(F.sum(cost).alias("total"), F.coalesce(F.sum(F.when(judge, cost)), F.lit(0.0)).alias("judges"), F.coalesce(F.try_divide(F.sum(F.when(~judge, full)), F.countDistinct(F.when(~judge, F.col("chunk_id")))), F.lit(0.0)).alias("per_chunk"))


def recovered(results: DataFrame, cached: DataFrame) -> DataFrame:
    """chunk_id and outcome of a batch's results (chunk_id, kind, ok): already kept, not succeeded, unparseable, or recovered."""
    k = cached.select("chunk_id").distinct().withColumn("_k", F.lit(True))
    r = results.join(k, "chunk_id", "left")
    return r.select("chunk_id", F.when(F.col("_k"), "already").when(F.col("kind") != "succeeded", "not_succeeded").when(~F.coalesce("ok", F.lit(False)), "unparseable").otherwise("recovered").alias("outcome"))

