"""RNK-1: distributed global ROW_NUMBER over a total order.

``Window.orderBy`` without a partition plans ``Exchange SinglePartition``:
every row goes through one task. Here the rows are range-partitioned on the
sort key (sampled bounds, the same machinery as ``orderBy``), sorted inside
each partition and numbered locally. That numbering is materialised once with
``checkpoint()`` in the shared checkpoint folder, so the per-partition counts
and the final rows read the same ids even after an executor loss. The count
table has one row per partition (bounded by the partition count we pass), is
prefix-summed and broadcast back as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID, _ID, _OFF, _FIRST, _N = "__rnk_pid", "__rnk_id", "__rnk_off", "__rnk_first", "__rnk_n"


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """Append ``out`` = 1..N following ``order``. ``order`` must be a total
    order (end it with a unique key) so the numbering is deterministic."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The input is stored first: range sampling and partitioning then read
    # files instead of re-running the (possibly expensive) upstream twice.
    stored = df.checkpoint(eager=True)
    numbered = (stored.repartitionByRange(n, *order)
                  .sortWithinPartitions(*order)
                  .withColumn(_PID, F.spark_partition_id())
                  .withColumn(_ID, F.monotonically_increasing_id())
                  .checkpoint(eager=True))
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N), F.min(_ID).alias(_FIRST))
    prior = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, _FIRST, F.coalesce(F.sum(_N).over(prior), F.lit(0)).alias(_OFF))
    ranked = numbered.join(F.broadcast(offsets), _PID)
    return (ranked.withColumn(out, (F.col(_OFF) + F.col(_ID) - F.col(_FIRST) + 1).cast("bigint"))
                  .drop(_PID, _ID, _OFF, _FIRST))
