"""Session settings and the shared scratch space."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every entry point relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Settings that only a new session can take.
STARTUP = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}

#: Input bytes per shuffle partition.
SHUFFLE_BYTES = 128 * 1024 * 1024

#: More partitions than this cost more in bookkeeping than they save.
SHUFFLE_LIMIT = 200_000


def build_session(app: str = "swellmark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; `conf` keys use '__' for '.'."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STARTUP, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(df: DataFrame) -> int:
    """Raise the number of shuffle partitions to what `df`, a plain scan, asks for.

    Adaptive execution merges partitions that turn out small, but does not split
    those of an aggregation. The session's own setting is the lower limit.
    """
    conf = df.sparkSession.conf
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = max(int(conf.get("spark.sql.shuffle.partitions")), min(math.ceil(size / SHUFFLE_BYTES), SHUFFLE_LIMIT))
    conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """`size_shuffles` for what runs inside; the session's own setting is back afterwards."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(df)
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a folder of this machine; on a cluster
    other machines would not see it, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="swellmark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint `df` to the shared folder, so later steps see fixed rows.

    The written partitions keep their order, and a lost executor re-reads them
    instead of recomputing (which could reorder rows).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back, for what later jobs scan several times.

    Unlike `cut` it keeps no order, and scans of the copy read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
