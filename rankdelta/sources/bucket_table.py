"""Clean snapshot rows as a bucketed catalogue table (SRC-7, J1).

The table is defined once in Spark's catalogue, bucketed and sorted by the
columns that comparisons join on.  A comparison with stored rows then moves the
new rows only: the stored side is read bucket by bucket, without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdelta.functions.status import movement_status, plus_days
from rankdelta.operators.changes import ROW_KEY
from rankdelta.operators.clean import preprocess
from rankdelta.schema import DAY_OFFSET_DAYS

COLUMNS = ("id BIGINT, rank INT, brand STRING, product STRING, old_price STRING, price STRING, captured_at TIMESTAMP_NTZ, "
           "channel STRING, created_at TIMESTAMP_NTZ, brand_key STRING, product_key STRING")
BUCKETS = 64


def define(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Create the table at ``path`` unless the catalogue has it; the definition says how it is bucketed."""
    keys = ", ".join(ROW_KEY)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")


def definition(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalogue holds: bucket number, bucket columns and sort columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Num Buckets", "Bucket Columns", "Sort Columns")}


def store(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append cleaned rows; one shuffle by bucket, so that every task writes its own buckets' files."""
    info = definition(spark, name)
    buckets = int(info["Num Buckets"])
    clean = preprocess(rows).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    clean.repartition(buckets, *ROW_KEY).write.mode("append").format("parquet").bucketBy(buckets, *ROW_KEY).sortBy(*ROW_KEY).saveAsTable(name)


def against_stored(spark: SparkSession, name: str, rows: DataFrame, days: int = DAY_OFFSET_DAYS) -> DataFrame:
    """J1 of new rows against the stored snapshots ``days`` earlier: ``prev_rank``, ``delta``, ``status``.

    Equal keys multiply rows, as in a join; without a stored match a row is new.
    """
    new = preprocess(rows)
    base = spark.table(name).select(*[F.col(k).alias(f"_{k}") for k in ROW_KEY], F.col("rank").alias("prev_rank"))
    at = new.withColumn("_base_at", plus_days(F.col("captured_at"), -days))
    same = [(F.col("channel") == F.col("_channel")), (F.col("_base_at") == F.col("_captured_at")),
            (F.col("brand_key") == F.col("_brand_key")), (F.col("product_key") == F.col("_product_key"))]
    out = at.hint("merge").join(base, same, "left").drop("_base_at", *[f"_{k}" for k in ROW_KEY])
    out = out.withColumn("delta", F.col("prev_rank") - F.col("rank"))
    return out.withColumn("status", movement_status("delta"))
