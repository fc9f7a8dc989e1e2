"""Global positions, shard keys and batch numbers without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediacurate.functions.layout import key_of_index, shard_of_index
from mediacurate.schemas import ROWS_PER_SHARD
from mediacurate.session import settle

# monotonically_increasing_id keeps the row position in its low 33 bits.
_POSITION_BITS = 2**33 - 1


def global_index(df: DataFrame, *order_by: str, name: str = "gidx") -> DataFrame:
    """Add the zero-based position of each row in the order of ``order_by``.

    A range-partitioned sort is fixed in the checkpoint folder; each partition
    is then counted and shifted by the rows before it. What is broadcast has one
    row per partition, whatever the data. Range bounds are drawn from the data,
    so one large directory is split like any other rows; ``order_by`` should
    end in a unique column so that ties have an order.
    """
    placed = (
        settle(df.orderBy(*order_by))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


def assign_keys(df: DataFrame, *order_by: str, per_shard: int = ROWS_PER_SHARD, start: int = 0) -> DataFrame:
    """Number the rows, counting on from ``start``, and give each its key and the shard of its number."""
    if per_shard > ROWS_PER_SHARD:
        raise ValueError(f"four digits of a key hold the place in a shard: {ROWS_PER_SHARD} rows at most")
    numbered = global_index(df, *order_by).withColumn("gidx", F.col("gidx") + F.lit(int(start)))
    return numbered.withColumns(
        {"key": key_of_index("gidx", per_shard), "shard": shard_of_index("gidx", per_shard)}
    )


def assign_batches(df: DataFrame, rows_per_batch: int, *order_by: str, start: int = 0) -> DataFrame:
    """Number every ``rows_per_batch`` rows as one batch, counting on from ``start``."""
    return global_index(df, *order_by).withColumn(
        "batch_id", F.expr(f"gidx div {int(rows_per_batch)}") + F.lit(int(start))
    )


def batch_counts(batched: DataFrame) -> DataFrame:
    return batched.groupBy("batch_id").agg(F.count("*").alias("rows"))


def batch_names(counts: DataFrame, rows_per_batch: int, *carried: str) -> DataFrame:
    """Checkpoint and publish names of each batch.

    A full batch is named after the index of its last row and published under
    its number; a short last batch is named after the total and not published.
    """
    full = F.col("rows") == F.lit(rows_per_batch)
    end = F.col("batch_id") * F.lit(rows_per_batch) + F.col("rows")
    last_index = F.when(full, end - 1).otherwise(end)
    return counts.select(
        "batch_id",
        "rows",
        F.format_string("intermediate_%08d", last_index).alias("checkpoint_name"),
        F.when(full, F.format_string("batch_%05d", F.col("batch_id") + 1)).alias("publish_name"),
        *carried,
    )


def progress(df: DataFrame, flag: str, every: int = 50_000, index: str = "gidx") -> DataFrame:
    """Valid and corrupt rows per ``every`` rows, with running totals."""
    per_bucket = df.groupBy(F.expr(f"{index} div {int(every)}").alias("bucket")).agg(
        F.count_if(F.col(flag)).alias("valid"), F.count_if(~F.col(flag)).alias("corrupt")
    )
    # One row per bucket from here on.
    so_far = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per_bucket.select(
        "bucket",
        "valid",
        "corrupt",
        F.sum("valid").over(so_far).alias("valid_so_far"),
        F.sum("corrupt").over(so_far).alias("corrupt_so_far"),
    )
