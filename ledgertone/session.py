"""Session helpers: shared scratch storage, lineage cuts, size-checked broadcasts."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
_SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="ledgertone-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged table; never reused, so reruns cannot collide.

    The innermost open ``scratch_scope`` owns it; without one it is left to who empties the shared folder.
    """
    folder = f"{shared_dir(spark)}/ledgertone/{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return f"{folder}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, also after an error. Write or collect results before it ends."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for folder in _SCOPES.pop():
            remove_path(spark, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor cannot force a different recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to shared storage and read back: one evaluation, whatever reads it later."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds costly columns through a generator of exactly one row.

    The optimizer copies an ordinary column's expression into every filter on it and pushes that below joins
    and shuffles, where it runs again. Filters on generated columns stay above the generator, so the
    expressions run once per row.
    """
    value = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(value)))


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a lookup that proves to be small, otherwise the plain frame.

    The rows are kept first so the size check does not run the lookup twice. Larger lookups fall through
    to a shuffled join, where AQE splits skewed partitions of the other side.
    """
    kept = cut_lineage(df)
    width = F.octet_length(F.to_json(F.struct(*kept.columns)))
    rows, size = kept.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(kept) if rows <= max_rows and size <= max_bytes else kept
