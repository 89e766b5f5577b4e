"""Writers.  Every sink is a DataFrame write, parallel over tasks; nothing is collected.

The reference writes one small file per caption / image in numbered folders.  Millions of tiny
files are not re-created here: captions and image bytes go to Parquet partitioned by the
folder number, which keeps the folder layout as partition directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.operators.rows import shard_numbers


def write_captions(df: DataFrame, path: str, folder: str = "folder", fmt: str = "parquet",
                   mode: str = "append") -> None:
    """``(key, caption, folder)`` partitioned by folder (SNK-01, SNK-10).  The rows are rebalanced by folder:
    small folders share a task, a large one is split over several."""
    df.hint("rebalance", folder).write.mode(mode).partitionBy(folder).format(fmt).save(path)


def write_images(df: DataFrame, path: str, folder: str = "folder", mode: str = "append") -> None:
    """``(key, content binary, width, height, folder)`` to Parquet by folder (SNK-02), with more columns if there
    are any: ``(path, content, caption)`` makes it a captioned image set."""
    df.hint("rebalance", folder).write.mode(mode).partitionBy(folder).parquet(path)


def append_ledger(ledger_rows: DataFrame, path: str) -> None:
    """Append ``(row_id, stage, status, error, attempts)`` rows (SNK-03)."""
    ledger_rows.select("row_id", "stage", "status", "error", "attempts").write.mode("append").parquet(path)


def check_bounds(maxsize: float, maxcount: float) -> None:
    """The reference's parameter checks (FLT-12), as driver-side errors."""
    if not maxsize > 1e7:
        raise ValueError("maxsize must be greater than 1e7 bytes")
    if not maxcount < 1e6:
        raise ValueError("maxcount must be less than 1e6")


def write_tar_shards(df: DataFrame, path: str, maxcount: int = 100000, maxsize: float = 1e9,
                     prefix: str = "ds_", compression: str | None = None, packing: str = "greedy",
                     size_col: str | None = None, mode: str = "overwrite", check: bool = True,
                     keep_size_col: bool = False, path_fields=(), commit: str = "rename") -> None:
    """Write samples ``(key, <field>...)`` as tar shards (SNK-04).

    ``packing='greedy'``: every task rolls its own shards by count and bytes (names carry the
    task number).  ``packing='prefix'``: global shard numbers from ``shard_numbers`` (needs a
    dense ``row_id`` and ``size_col``), rows clustered by shard, one file ``<prefix>%06d`` per
    shard.  ``path_fields`` hold file paths whose bytes the write task reads.  ``commit='list'`` renames nothing (for
    object stores): shards bear the attempt's mark behind their number, and a published list says which are visible.
    """
    from capset.sources import tarshard

    if check:
        check_bounds(maxsize, maxcount)
    tarshard.register(df.sparkSession)
    w = None
    if packing == "prefix":
        numbered = shard_numbers(df, size_col, maxsize, maxcount)
        data = numbered.repartition("shard").sortWithinPartitions("shard", "row_id").drop("row_id")
        if not keep_size_col:
            data = data.drop(size_col)
        w = data.write.format("tarshard").option("shardColumn", "shard")
    else:
        w = df.write.format("tarshard")
    w = w.option("maxcount", int(maxcount)).option("maxsize", int(maxsize)).option("prefix", prefix)
    if compression:
        w = w.option("compression", compression)
    if path_fields:
        w = w.option("pathFields", ",".join(path_fields))
    w.option("commit", commit).mode(mode).save(path)


def write_fault_report(report: DataFrame, path: str) -> None:
    """``|``-separated report, lists as JSON arrays (SNK-06)."""
    cols = [F.to_json(F.col(c)).alias(c) if dict(report.dtypes)[c].startswith("array") else F.col(c)
            for c in report.columns]
    report.select(*cols).write.mode("overwrite").option("sep", "|").option("header", True) \
        .option("escape", '"').csv(path)


def write_captions_json(df: DataFrame, path: str) -> None:
    """JSON lines ``{key, path, caption}`` (SNK-07)."""
    df.write.mode("overwrite").json(path)


def write_similarities(wide: DataFrame, path: str, key: str = "image_id") -> None:
    """Tab-separated score table sorted by image id within each output file (SNK-08)."""
    wide.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite") \
        .option("sep", "\t").option("header", True).csv(path)


def write_embeddings(df: DataFrame, path: str, per_file: int = 5000) -> None:
    """``(row_id, embedding array<float>)`` to Parquet, at most ``per_file`` rows a file (SNK-09)."""
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)


def write_corpus(df: DataFrame, path: str, text: str = "text") -> None:
    """One text per line (SNK-11); rows stay separate, words do not fuse."""
    df.select(F.regexp_replace(text, "\n", " ").alias("value")).write.mode("overwrite").text(path)


def write_vocabulary(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """Tables ``vocab(token, id)`` and ``merges(rank, left, right, freq)`` (SNK-12)."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")
