"""Incremental loads: a stream of rows merged into a table, first write wins; counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Parts of a merged table by the hash of its key; a batch reads the parts that its keys fall in.
PARTS = 64


def first_writes(stream: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """Of each key the first row that the stream brings; a key is remembered for ``late`` of event time, so the state is bounded."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, by: str) -> DataFrame:
    """Rows per window of event time; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def merged_table(spark: SparkSession, target: str, schema) -> DataFrame:  # noqa: ANN001
    """The table that :func:`merge_stream` has written so far; empty before its first batch."""
    try:
        return spark.read.parquet(target).select(*schema.fieldNames())
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def merge_stream(spark: SparkSession, source: DataFrame, target: str, key: list[str], checkpoint: str, order: str | None = None):
    """Appends to the Parquet table ``target`` the rows whose key is not there yet, batch by batch.

    Each batch has a folder of its own, which a repeated batch overwrites and does not read, so a batch that failed half
    way leaves nothing twice. Of a key's rows in one batch the first by ``order`` counts. Of the table a batch reads the
    key columns of the parts that its own keys fall in.
    """
    part = F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")

    def merge(batch: DataFrame, number: int) -> None:
        new = batch.withColumn("_part", part)
        by = F.struct(*([order] if order else []), *batch.columns)
        new = new.groupBy("_part", *key).agg(F.min_by(F.struct(*[c for c in batch.columns if c not in key]), by).alias("_r") if set(batch.columns) - set(key) else F.lit(1).alias("_r"))
        new = new.select("_part", *key, *(["_r.*"] if set(batch.columns) - set(key) else []))
        try:
            old = spark.read.parquet(target).where((F.col("batch_no") != number) & F.col("part_no").isin([r[0] for r in new.select("_part").distinct().collect()]))  # PARTS numbers at most
            new = new.join(old.select(*key), key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e) and "UNRESOLVED_COLUMN" not in str(e):
                raise
        new.select(*batch.columns, F.col("_part").alias("part_no")).write.mode("overwrite").partitionBy("part_no").parquet(f"{target}/batch_no={number}")

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
