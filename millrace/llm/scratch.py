"""Tables that cut lineage, and broadcasts behind a check of size.

A scratch table is Parquet in the folder that the cluster shares
(``spark.checkpoint.dir``), so it outlives a lost executor.  Only a local
session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes that an operator broadcasts.
BROADCAST_BYTES = 24 << 20

_local: dict[str, str] = {}
_made: dict[tuple[str, str], list[str]] = {}
_scope = [""]
_paths: dict[int, tuple[weakref.ref, str]] = {}


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


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, noted under the scope of the moment."""
    path = f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault((spark.sparkContext.applicationId, _scope[-1]), []).append(path)
    return path


#: Bytes of a batch that workers get where rows may hold whole texts, long ones too; Spark's own bound is 64 MB.
TEXT_BYTES = 4 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Whether small results are spread over all cores: a scratch table of some rows would be a file per core.
_SPREAD = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def stored(df: DataFrame, name: str, by: str | None = None, texts: bool = False) -> DataFrame:
    """Write ``df`` as a scratch table and return the table.

    ``texts``: rows hold texts or parts of them, so the batches of the Python
    workers are bounded by ``TEXT_BYTES`` while it is written.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.partitionBy(by) if by else df.write
    before = {key: spark.conf.get(key) for key in (_BYTES, _SPREAD)}
    if texts:
        spark.conf.set(_BYTES, str(TEXT_BYTES))
    spark.conf.set(_SPREAD, "false")
    try:
        writer.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[id(table)] = (weakref.ref(table), path)
    return table


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more, and let Spark delete the shuffle files behind them.

    Spark deletes these when the driver collects its garbage, which may be
    long after.
    """
    for table in tables:
        held, path = _paths.pop(id(table), (None, ""))
        if held is not None and held() is table:
            _delete(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scope(name: str) -> Iterator[None]:
    """Note the scratch tables made inside under ``name``."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def sweep(spark: SparkSession, name: str) -> None:
    """Delete the scratch tables of a scope; results that still read them must be written before."""
    for path in _made.pop((spark.sparkContext.applicationId, name), []):
        _delete(spark, path)


def _fixed(kind: T.DataType) -> int | None:
    """Bytes of a value of a type without variable parts."""
    if isinstance(kind, T.StructType):
        parts = [_fixed(f.dataType) for f in kind.fields]
        return None if None in parts else 16 + sum(parts)
    return None if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8


def _width(col: Column, kind: T.DataType) -> Column:
    """Bytes of a value in memory, or somewhat more."""
    if (fixed := _fixed(kind)) is not None:
        return F.lit(fixed)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 24
    if isinstance(kind, T.StructType):
        return sum((_width(col[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.ArrayType) and (fixed := _fixed(kind.elementType)) is not None:
        return F.coalesce(F.size(col), F.lit(0)) * fixed + 24
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(F.transform(col, lambda x: _width(x, kind.elementType).cast("long")), F.lit(24).cast("long"), lambda a, b: a + b), F.lit(24))
    return F.coalesce(F.length(F.to_json(col)), F.lit(0)) * 2 + 48


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in memory, summed over all rows."""
    row = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a scratch table takes ``limit`` bytes at most (``BROADCAST_BYTES`` by default)."""
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark a scratch table for broadcast if it :func:`fits`.

    Beyond that the join is left to the planner, which shuffles both sides and
    splits skewed partitions.
    """
    return F.broadcast(df) if fits(df, limit) else df
