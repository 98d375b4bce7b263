"""Consecutive row numbers across a whole DataFrame without a one-task sort.

Rows are range-partitioned and sorted by the order wanted, so that partitions
follow each other; a row's number is the count of all earlier partitions plus
its place in its own.  The sorted rows are staged first, which fixes the
layout: recomputed tasks cannot number differently.  The driver sees one count
per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.session import input_bytes, staged

PART_BYTES = 128 << 20  # input of a part, about
_PLACE = (1 << 33) - 1  # monotonically_increasing_id: partition above, place below


def numbered(df: DataFrame, order: list[str], name: str = "row_no", start: int = 1) -> DataFrame:
    """``name`` = start, start+1, ... in ``order``, which must be total."""
    spark = df.sparkSession
    # as many parts as the input's bytes ask for: an explicit count is not merged or split later
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // PART_BYTES))
    laid = staged(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = {r["p"]: r["n"] for r in laid.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = start, []
    for p in sorted(counts):
        offsets.append((p, before))
        before += counts[p]
    table = F.broadcast(spark.createDataFrame(offsets, "_p long, _before long"))  # a row per partition
    rows = laid.withColumn("_p", part).join(table, "_p")
    return rows.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit(_PLACE))).drop("_p", "_before", "_at")
