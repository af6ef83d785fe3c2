"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, set as the checkpoint folder; only where it is unset (a local test), a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", "")
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is not set")
            named = tempfile.mkdtemp(prefix="testimonia-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: lineage ends here, and a reader takes only the columns it needs."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
