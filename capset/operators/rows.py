"""Row identity, batches, near-equal parts, running sums and shard numbers.

Spark has no implicit row order, so the reference's "row position = id" is rebuilt from the
file scan itself:

* Parquet: ``_metadata.row_index`` plus the row offset of its file (files in name order).
* CSV / JSON / text (no row index): ``monotonically_increasing_id`` is dense *inside* one
  input split and one task reads a split in order, so the rank inside a split is
  ``mid - min(mid)`` of that split; the splits are then offset by a running sum over the small
  per-split count table.

In both cases the only ordered computation runs over a table with one row per file or split,
never over the rows themselves; that table is joined back, by whatever join the planner takes for its size.

Running sums over row-scale data (shard packing) use the same idea with fixed-size blocks of
row ids: per-block totals (one row per block), a prefix over the block table, and a window
*partitioned by block*, so no task ever holds more than one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capset.functions.ids import batch_of, pad_id

ROW_ID = "row_id"
DEFAULT_BLOCK_ROWS = 1 << 20


def _found(offset: str, what: str):
    """An offset that must be there: rows never vanish because two scans were cut differently."""
    return F.coalesce(F.col(offset), F.raise_error(F.lit(f"a {what} of the second scan was not in the first")).cast("long"))


def with_row_id(df: DataFrame, name: str = ROW_ID, source: str = "auto") -> DataFrame:
    """Add a dense 0-based id in file order (files sorted by path).

    ``df`` must be a file scan (``spark.read...``) with no shuffle in between.  ``source`` is
    ``'parquet'`` (uses ``_metadata.row_index``), ``'split'`` (any file format), or ``'auto'``.
    Put ids in at ingestion, before filters, and materialise (``materialize``) when the
    result feeds several jobs.
    """
    if source == "auto":
        try:
            df.select(F.col("_metadata.row_index")).schema
            source = "parquet"
        except Exception:  # noqa: BLE001 - format without a row index
            source = "split"
    if source == "parquet":
        rows = df.withColumn("_rid_file", F.col("_metadata.file_path")) \
                 .withColumn("_rid_pos", F.col("_metadata.row_index"))
        per_file = rows.groupBy("_rid_file").agg(F.count(F.lit(1)).alias("_rid_n"))
        offsets = per_file.select(
            "_rid_file",
            (F.sum("_rid_n").over(Window.orderBy("_rid_file")) - F.col("_rid_n")).alias("_rid_off"))
        out = rows.join(offsets, "_rid_file", "left")
        return out.withColumn(name, _found("_rid_off", "file") + F.col("_rid_pos")) \
                  .drop("_rid_file", "_rid_pos", "_rid_off")
    rows = (df.withColumn("_rid_file", F.col("_metadata.file_path"))
              .withColumn("_rid_blk", F.col("_metadata.file_block_start"))
              .withColumn("_rid_mid", F.monotonically_increasing_id()))
    per_split = rows.groupBy("_rid_file", "_rid_blk").agg(
        F.count(F.lit(1)).alias("_rid_n"), F.min("_rid_mid").alias("_rid_min"))
    w = Window.orderBy("_rid_file", "_rid_blk")
    offsets = per_split.select(
        "_rid_file", "_rid_blk", "_rid_min",
        (F.sum("_rid_n").over(w) - F.col("_rid_n")).alias("_rid_off"))
    out = rows.join(offsets, ["_rid_file", "_rid_blk"], "left")
    return out.withColumn(name, _found("_rid_off", "split") + F.col("_rid_mid") - F.col("_rid_min")) \
              .drop("_rid_file", "_rid_blk", "_rid_mid", "_rid_min", "_rid_off")


def with_row_id_from(df: DataFrame, file_col: str, index_col: str, name: str = ROW_ID) -> DataFrame:
    """Row ids in file order for sources that report ``(file, position in file)`` themselves
    (e.g. the ``tfrecord`` source's ``_file``/``_index``): per-file counts (one row per file),
    offsets by file name, joined back."""
    per_file = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("_rid_n"))
    offsets = per_file.select(file_col, (F.sum("_rid_n").over(Window.orderBy(file_col)) - F.col("_rid_n"))
                              .alias("_rid_off"))
    out = df.join(offsets, file_col, "left")
    return out.withColumn(name, _found("_rid_off", "file") + F.col(index_col)).drop("_rid_off")


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's shared checkpoint folder."""
    from capset.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def batch(df: DataFrame, size: int, row_id: str = ROW_ID, name: str = "batch") -> DataFrame:
    """Batch number ``floor(row_id / size)`` (10k, 50k, 100k, 500k in the reference)."""
    return df.withColumn(name, batch_of(row_id, size))


def row_range(df: DataFrame, start: int, n: int, row_id: str = ROW_ID) -> DataFrame:
    """Rows ``start <= row_id < start + n`` (a pushed-down range filter, not a limit)."""
    return df.where((F.col(row_id) >= start) & (F.col(row_id) < start + n))


def sample_keys(df: DataFrame, row_id: str = ROW_ID, width: int = 9, name: str = "key") -> DataFrame:
    """Sample key = zero-padded running number, given before any filter (gaps stay)."""
    return df.withColumn(name, pad_id(row_id, width))


def near_equal_parts(df: DataFrame, size: int, row_id: str = ROW_ID, name: str = "part",
                     n: int | None = None) -> DataFrame:
    """Split dense ids 0..n-1 in ``k = max(1, n div size)`` parts, larger parts first (1-based).

    Same result as ``ntile(k)`` / ``numpy.array_split`` but by arithmetic on the id: one count
    (a metadata-only job on Parquet) gives ``n``, then ``k``, ``b = n div k`` and ``r = n mod k``
    are literals, so no global window sorts the rows.
    """
    if n is None:
        n = df.count()
    k = max(1, n // size)
    b, r = n // k, n % k
    i = F.col(row_id)
    part = F.when(i < F.lit(r * (b + 1)), F.floor(i / F.lit(b + 1))) \
            .otherwise(F.lit(r) + F.floor((i - F.lit(r * (b + 1))) / F.lit(b)))
    return df.withColumn(name, (part + 1).cast("long"))


def running_sum_before(df: DataFrame, value: str, row_id: str = ROW_ID, name: str = "before",
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller dense ``row_id`` (exclusive prefix sum).

    Blocked: totals per block of ``block_rows`` ids, prefix over the block table, then a
    window partitioned by block.  No task holds more than one block.
    """
    blk = F.floor(F.col(row_id) / F.lit(block_rows))
    with_blk = df.withColumn("_rs_blk", blk)
    totals = with_blk.groupBy("_rs_blk").agg(F.sum(value).alias("_rs_tot"))
    prefix = totals.select(
        "_rs_blk",
        F.coalesce(F.sum("_rs_tot").over(
            Window.orderBy("_rs_blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_rs_off"))
    joined = with_blk.join(prefix, "_rs_blk")
    inner = Window.partitionBy("_rs_blk").orderBy(row_id).rowsBetween(Window.unboundedPreceding, -1)
    return (joined.withColumn(name, F.col("_rs_off") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
                  .drop("_rs_blk", "_rs_off"))


def shard_numbers(df: DataFrame, size_col: str, maxsize: float = 1e9, maxcount: int = 100000,
                  row_id: str = ROW_ID, name: str = "shard", block_rows: int = DEFAULT_BLOCK_ROWS
                  ) -> DataFrame:
    """Prefix packing: shard = dense number of ``(bytes_before div maxsize, rows_before div maxcount)``.

    A shard never holds more than ``maxcount`` rows, and starts a new one when the bytes before
    a row cross a multiple of ``maxsize``.  ``row_id`` must be dense 0..n-1 in packing order.

    The layout is computed on the narrow ``(row_id, size)`` projection only: blocked running
    sums, then the first row of every shard (one row per shard), which is checkpointed.  Shards are
    contiguous id ranges; a table ``block -> [(start, shard), ...]`` with blocks as long as an average
    shard gives every payload row its shard through an equi-join on its block.
    """
    narrow = df.select(F.col(row_id).alias("_sh_id"), F.col(size_col).alias("_sh_size"))
    last_id = narrow.select(F.max("_sh_id")).first()[0]
    if last_id is None:
        return df.withColumn(name, F.lit(None).cast("long"))
    before = running_sum_before(narrow, "_sh_size", "_sh_id", "_sh_bytes", block_rows)
    keyed = before.select("_sh_id", F.floor(F.col("_sh_bytes") / F.lit(float(maxsize))).alias("_sh_b"),
                          F.floor(F.col("_sh_id") / F.lit(int(maxcount))).alias("_sh_c"))
    starts = keyed.groupBy("_sh_b", "_sh_c").agg(F.min("_sh_id").alias("_sh_start"))
    # window over the shard table (one row per shard), not over the rows
    w = Window.orderBy("_sh_start")
    shards = starts.select(
        "_sh_start", (F.row_number().over(w) - 1).cast("long").alias("_sh_no"),
        (F.coalesce(F.lead("_sh_start").over(w), F.lit(int(last_id) + 1)) - 1).alias("_sh_end"))
    shards = materialize(shards)
    # lookup blocks as long as a shard is on average: a block meets two shards or so, whatever the bounds
    look = max(1, (int(last_id) + 1) // max(1, shards.count()))
    blk = lambda c: F.floor(F.col(c) / F.lit(look))
    cover = shards.select(F.explode(F.sequence(blk("_sh_start"), blk("_sh_end"))).alias("_sh_blk"),
                          "_sh_start", "_sh_no")
    per_block = cover.groupBy("_sh_blk").agg(
        F.sort_array(F.collect_list(F.struct("_sh_start", "_sh_no"))).alias("_sh_arr"))
    joined = df.withColumn("_sh_blk", blk(row_id)).join(per_block, "_sh_blk")
    pick = F.aggregate("_sh_arr", F.lit(-1).cast("long"),
                       lambda acc, x: F.when(x["_sh_start"] <= F.col(row_id), x["_sh_no"]).otherwise(acc))
    return joined.withColumn(name, pick).drop("_sh_blk", "_sh_arr")


def dense_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """0-based position of every row in the current partition order (``zipWithIndex``).

    Call it on a sorted (range-partitioned) DataFrame.  The input is first checkpointed to the
    shared checkpoint folder so that both passes see the same partitions; the per-partition
    counts (one row per partition) are then offset and broadcast back.
    """
    spark = df.sparkSession
    from capset.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    fixed = df.checkpoint(eager=True)
    tagged = fixed.withColumn("_dp_part", F.spark_partition_id()) \
                  .withColumn("_dp_mid", F.monotonically_increasing_id())
    per_part = tagged.groupBy("_dp_part").agg(F.count(F.lit(1)).alias("_dp_n"),
                                              F.min("_dp_mid").alias("_dp_min"))
    offsets = per_part.select("_dp_part", "_dp_min",
                              (F.sum("_dp_n").over(Window.orderBy("_dp_part")) - F.col("_dp_n")).alias("_dp_off"))
    out = tagged.join(offsets, "_dp_part")
    return out.withColumn(name, F.col("_dp_off") + F.col("_dp_mid") - F.col("_dp_min")) \
              .drop("_dp_part", "_dp_mid", "_dp_min", "_dp_off")
