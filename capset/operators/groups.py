"""Places of rows inside their group, and lists of bounded length, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capset.session import scratch_path

#: Rows of a list.
LIST_ROWS = 10_000


def positions_in_group(df: DataFrame, key: str, order: list[str | Column], name: str = "position") -> DataFrame:
    """0-based place of every row in its group.  No task gets a whole group: the rows are sorted in ranges that cut
    through large groups (written to the scratch folder), and a row's place is its place in the range and what its group has in
    the ranges before: a table with one row for each group and range that meet.  Ties go by their place in the input."""
    spark = df.sparkSession
    by = [F.col(key), *[F.col(o) if isinstance(o, str) else o for o in order], F.col("_g_tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "groups")
    df.withColumn("_g_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by) \
        .withColumn("_g_pos", F.monotonically_increasing_id()).drop("_g_tie").write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_g_part", F.shiftright("_g_pos", 33))
    met = rows.groupBy(F.col(key).alias("_g_key"), F.col("_g_part").alias("_g_in")).agg(F.min("_g_pos").alias("_g_low"), F.count(F.lit(1)).alias("_g_n"))
    met = met.withColumn("_g_before", F.sum("_g_n").over(Window.partitionBy("_g_key").orderBy("_g_in")) - F.col("_g_n"))
    on = rows[key].eqNullSafe(met["_g_key"]) & (rows["_g_part"] == met["_g_in"])
    return rows.join(met, on).withColumn(name, F.col("_g_pos") - F.col("_g_low") + F.col("_g_before")).select(*df.columns, name)


def chunked_lists(df: DataFrame, key: str, value: str, order: list[str | Column], size: int = LIST_ROWS) -> DataFrame:
    """``key, part, n, list``: the group's values in order, ``size`` in each list but the last.  Null values count as values."""
    placed = positions_in_group(df.select(key, F.col(value).alias("_value"), *[F.col(o).alias(f"_o{i}") if isinstance(o, str) else o.alias(f"_o{i}")
                                                                             for i, o in enumerate(order)]),
                                key, [f"_o{i}" for i in range(len(order))], "_at")
    entry = F.struct(F.col("_at"), F.col("_value"))
    lists = placed.groupBy(key, F.floor(F.col("_at") / size).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(entry)).alias("_l"))
    return lists.select(key, "part", "n", F.col("_l._value").alias("list"))
