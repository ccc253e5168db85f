"""Tables between the stages of a job: written once, read as often as needed.

They go to the folder in ``spark.checkpoint.dir``, which all executors share,
so they outlive a lost executor.  Only a local session without that setting
gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _local[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-stages/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
