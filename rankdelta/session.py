"""Session and table helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rankdelta") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small shuffles keep their parallelism: the default merges up to 1 MB into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    share_code(spark, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


def share_code(spark: SparkSession, root: str) -> None:
    """Let Python workers import this package from ``root`` (a path that executors see too)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


_scratch: list[tuple[SparkSession, str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since executors would each write
    to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rankdelta-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rankdelta-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(drop_scratch)
    _scratch.append((spark, path))
    return path


def drop_scratch(keep: int = 0) -> None:
    while len(_scratch) > keep:
        spark, path = _scratch.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may have ended before
            continue


@contextlib.contextmanager
def staging():
    """Tables staged inside the block are deleted at its end, when the caller has taken its results."""
    before = len(_scratch)
    try:
        yield
    finally:
        drop_scratch(before)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables and files that ``df`` reads, as the optimizer knows them (data without files: 0)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)  # an unknown size is given as the largest number


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: made once, then scanned
    with pruned columns and pushed filters by every branch, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Declared schemas of the driver tables this package reads: no inference job,
# and a changed file fails at read time instead of deep inside a plan.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
