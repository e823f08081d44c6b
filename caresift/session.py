"""Session defaults, shared scratch folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and characters a side may have before it is joined by shuffle instead of broadcast.
BROADCAST_ROW_LIMIT = 10_000
BROADCAST_CHAR_LIMIT = 8 << 20


def local_session(app: str = "caresift", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a fresh folder of its own.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    root = spark.conf.get("caresift.local.scratch", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("caresift.local.scratch", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when their files give fewer splits than there are cores.

    A small file with one row group is read by one task however many cores are
    idle. Large inputs have more splits than cores and stay as they are.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, cutting its lineage.

    A filter on ``partition_by`` then reads the folders it asks for only.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` when it holds at most ``limit`` rows of a bounded size; else leave it to a shuffle join.

    At most ``limit + 1`` rows reach the driver, and they are reused, so a small
    side is computed once.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit or sum(len(str(v)) for r in rows for v in r) > BROADCAST_CHAR_LIMIT:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
