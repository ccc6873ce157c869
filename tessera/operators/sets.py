"""Set operations on tables of rows, identities and tokens, and stable output order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import written


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows, columns by name; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def only_left(a: DataFrame, b: DataFrame, keep_repeats: bool = False) -> DataFrame:
    return a.exceptAll(b) if keep_repeats else a.subtract(b)


def all_tokens(*tables: DataFrame) -> DataFrame:
    return union_all(*tables).distinct()


def ordered_output(df: DataFrame, *keys, partitions: int | None = None) -> DataFrame:
    """Rows in the order of the keys across partitions, for stable exports."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def first_ordered(ordered: DataFrame) -> DataFrame:
    """The first row of ordered_output(). A limit would take a row of whichever task's result comes first; this takes the one whose
    task and place in it come first, of a single row per task."""
    placed = ordered.withColumn("_at", F.monotonically_increasing_id())
    first = placed.agg(F.min_by(F.struct(*ordered.columns), "_at").alias("_row"), F.count("*").alias("_n"))
    return first.where("_n > 0").select("_row.*")


def ordered_positions(df: DataFrame, *keys: str, out: str = "position") -> DataFrame:
    """df with each row's place, from 1, in the order of the keys: places in a range, behind the rows of the ranges before, which are counted."""
    ranged = written(df.repartitionByRange(*keys).withColumn("_r", F.spark_partition_id()), "ordered")
    sizes = ranged.groupBy("_r").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = sizes.select("_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_b"))
    own = F.row_number().over(Window.partitionBy("_r").orderBy(*keys))
    return ranged.withColumn("_o", own).join(sizes, "_r").withColumn(out, F.col("_b") + F.col("_o")).drop("_r", "_b", "_o")
