"""Dense numbers in a global order, without sorting everything in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.session import cut


def numbered(df: DataFrame, *order: str, name: str = "n") -> DataFrame:
    """``df`` with numbers 1, 2, ... in ascending ``order``, which must be total.

    Rows are range-partitioned and written once, so the ranges are fixed; only one count per range goes to the
    driver. Ties in ``order`` are numbered in no particular order; an empty table stays empty.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = sorted((r._range, r["count"]) for r in ranged.groupBy("_range").count().collect())
    starts = [0, *accumulate(c for _, c in counts)]
    offsets = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(counts, starts, strict=False)], "_range int, _start bigint")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_k", within).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_start") + F.col("_k")).drop("_range", "_start", "_k")
