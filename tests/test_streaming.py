"""Incremental loads come out as a batch would, however often they run."""

import datetime as dt

from testimonia.streaming import merge


def test_merge_is_idempotent(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "target")
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    assert merge.merged_table(spark, target, schema).count() == 0
    spark.createDataFrame([(1, "a"), (2, "c"), (2, "b")], schema).write.parquet(src)
    for run in range(3):
        if run == 2:  # a later batch of a known and a new key
            spark.createDataFrame([(1, "z"), (3, "d"), (None, "n")], schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        merge.merge_stream(spark, stream, target, ["k"], str(tmp_path / "check")).awaitTermination(120)
    assert sorted(map(tuple, merge.merged_table(spark, target, schema).collect()), key=str) == [(1, "a"), (2, "b"), (3, "d"), (None, "n")]


def _ran(spark, frame, name, mode):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_windowed_counts_and_first_writes(spark, tmp_path):
    at = lambda m: dt.datetime(2031, 5, 3, 10, m)
    rows = [(1, at(1), "x"), (1, at(2), "x"), (2, at(4), "y"), (3, at(31), "x")]
    spark.createDataFrame(rows, "k int, t timestamp, kind string").coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = lambda: spark.readStream.schema("k int, t timestamp, kind string").parquet(str(tmp_path / "e"))
    counts = _ran(spark, merge.windowed_counts(stream(), "t", "30 minutes", "1 hour", "kind"), "counts", "complete")
    assert sorted((r["window"]["start"].minute, r["kind"], r["n"]) for r in counts) == [(0, "x", 2), (0, "y", 1), (30, "x", 1)]
    assert sorted(r["k"] for r in _ran(spark, merge.first_writes(stream(), ["k"], "t", "1 hour"), "firsts", "append")) == [1, 2, 3]
