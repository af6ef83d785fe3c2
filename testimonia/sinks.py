"""Tables written: registries, passages by document, logs, frozen samples, and the assertions that stand for constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from testimonia.sources.files import sample_scan


def save_registry(registry: DataFrame, path: str) -> None:
    """Sorted by commission and url, as JSON lines; the commit of the write replaces the old state at once."""
    registry.repartitionByRange("commission_slug", "url").sortWithinPartitions("commission_slug", "url").write.mode("overwrite").json(path)


def write_documents(rows: DataFrame, path: str, key: str = "doc_sha256", force: bool = False) -> None:
    """Appends the rows of documents that ``path`` does not hold yet, a folder for each; with ``force`` theirs replace what is there."""
    spark, new = rows.sparkSession, rows
    if not force:
        try:
            new = rows.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
    new.repartition(key).write.partitionBy(key).option("partitionOverwriteMode", "dynamic").mode("overwrite" if force else "append").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def freeze_sample(sample: DataFrame, path: str) -> None:
    """Writes a sample once; the same sample may be written again, another one is refused."""
    try:
        old = sample_scan(sample.sparkSession, path)
        other = old.exceptAll(sample.select("chunk_id", "stratum")).unionByName(sample.select("chunk_id", "stratum").exceptAll(old))
        if not other.isEmpty():
            raise ValueError("the sample is frozen and differs")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        sample.select("chunk_id", "stratum").coalesce(1).write.option("sep", "\t").csv(path)


def not_unique(rows: DataFrame, key: list[str]) -> DataFrame:
    """The keys that stand for several rows, or are null: a uniqueness constraint holds if there are none."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing)
