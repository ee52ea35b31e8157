"""Positions 1..n and batches over a whole table, without sorting it in one task."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

BLOCK = 65_536


def _block(value: str, size: int) -> Column:
    """Which run of ``size`` consecutive whole numbers a value lies in."""
    return F.expr(f"({value} - pmod({value}, {size}L)) div {size}L")


def _before(sizes: DataFrame, key: str, parent: str | None) -> DataFrame:
    """Rows before each block inside its parent: a window that never holds more than a block's worth of rows."""
    window = Window.partitionBy(parent) if parent else Window
    before = F.sum("_size").over(window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("*", F.coalesce(before, F.lit(0)).alias("_before"))


def with_position(df: DataFrame, name="position", seq="seq", block=BLOCK) -> DataFrame:
    """Number the rows 1..n by the unique integer ``seq``, dense or sparse.

    Blocks of ``block`` consecutive values are numbered inside blocks of blocks, and those inside
    blocks of these. Each level sums the sizes of at most ``block`` parts, partitioned by its
    parent; three levels over blocks of 65,536 cover every 64-bit ``seq``. A row's position is its
    rank within its block plus the rows before the block on every level.
    """
    ranked = df.withColumn("_b1", _block(seq, block)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_b1").orderBy(seq)))
    first = df.groupBy(_block(seq, block).alias("_b1")).agg(F.count(F.lit(1)).alias("_size")).withColumn("_b2", _block("_b1", block))
    second = first.groupBy("_b2").agg(F.sum("_size").alias("_size")).withColumn("_b3", _block("_b2", block))
    third = _before(second.groupBy("_b3").agg(F.sum("_size").alias("_size")), "_b3", None)
    upper = _before(second, "_b2", "_b3").join(
        third.select("_b3", F.col("_before").alias("_more")), "_b3").select("_b2", (F.col("_before") + F.col("_more")).alias("_more"))
    offsets = _before(first, "_b1", "_b2").join(upper, "_b2").select("_b1", (F.col("_before") + F.col("_more")).alias("_offset"))
    return ranked.join(offsets, "_b1").select(*df.columns, (F.col("_offset") + F.col("_rank")).alias(name))


def with_batch(df: DataFrame, size=5, name="batch_no", seq="seq", block=BLOCK) -> DataFrame:
    """Batches of ``size`` rows in order, numbered from 0, with ``batch_pos`` from 0 inside each."""
    at = F.col("_position") - 1
    return with_position(df, "_position", seq, block).select(
        *df.columns,
        F.floor(at / size).cast("bigint").alias(name),
        (at % size).cast("int").alias("batch_pos"),
    )


def batch_count(df: DataFrame, size=5) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / size).cast("bigint").alias("batches"))
