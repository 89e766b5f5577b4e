"""Resume and progress: skip what is done, resolve content, count what is left.

The reference keeps its progress as files on disk (``id.txt``/``id.jpg`` present, or an empty
marker for a failed id).  Here the progress is a ledger table ``(row_id, stage, status, ...)``
or ids read off file names, and skipping is an anti join.  Id tables are made distinct first
(a map-side partial aggregate), so a hot id cannot skew the join; the planner (AQE) picks a
broadcast when the measured id table is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.functions.ids import file_number

LEDGER_SCHEMA = "row_id bigint, stage string, status string, error string, attempts int"


def skip_ids(*id_tables: DataFrame, on: str = "row_id") -> DataFrame:
    """Union of id tables (failed ∪ done), distinct."""
    out = None
    for t in id_tables:
        t = t.select(F.col(on).cast("long").alias(on))
        out = t if out is None else out.unionByName(t)
    return out.distinct()


def pending(df: DataFrame, done: DataFrame, on: str = "row_id", done_on: str | None = None) -> DataFrame:
    """Rows of ``df`` whose id is not in ``done`` (left anti join on a distinct id table)."""
    ids = done.select(F.col(done_on or on).cast("long").alias(on)).distinct()
    return df.join(ids, on, "left_anti")


def ids_from_files(files: DataFrame, path_col: str = "path", name: str = "row_id") -> DataFrame:
    """Distinct numeric ids read off file names (``00000042.txt`` -> 42)."""
    return files.select(file_number(path_col).alias(name)).where(F.col(name).isNotNull()).distinct()


def ledger_from(ids: DataFrame, stage: str, status: str, on: str = "row_id") -> DataFrame:
    """Ledger rows for a set of ids (e.g. ``status='failed'`` markers)."""
    return ids.select(F.col(on).cast("long").alias("row_id"), F.lit(stage).alias("stage"),
                      F.lit(status).alias("status"), F.lit(None).cast("string").alias("error"),
                      F.lit(1).alias("attempts"))


def done_and_failed(ledger: DataFrame, stage: str | None = None, retry_failed: bool = False,
                    max_attempts: int | None = None) -> DataFrame:
    """Ids to skip from a ledger: done ones, plus failed ones unless they may be retried."""
    lg = ledger if stage is None else ledger.where(F.col("stage") == stage)
    cond = F.col("status") == "done"
    if not retry_failed:
        cond = cond | (F.col("status") == "failed")
    elif max_attempts is not None:
        cond = cond | ((F.col("status") == "failed") & (F.col("attempts") >= max_attempts))
    return lg.where(cond).select("row_id").distinct()


def progress(df: DataFrame, done: DataFrame, on: str = "row_id") -> DataFrame:
    """One row: total, done (ids of ``df`` present in ``done``), remaining, percent done."""
    ids = done.select(F.col(on).cast("long").alias(on)).distinct()
    flagged = df.select(on).join(ids.withColumn("_done", F.lit(1)), on, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_done").alias("done"),
    ).select(
        "total", "done",
        (F.col("total") - F.col("done")).alias("remaining"),
        F.round(F.when(F.col("total") > 0, F.col("done") * 100.0 / F.col("total")), 4).alias("percent_done"))


def resolve_content(manifest: DataFrame, content: DataFrame, on: str = "url",
                    content_col: str = "content") -> DataFrame:
    """Left join of the manifest with a content table; ``status`` = ok / empty / missing / no_url.

    The content table is made unique per key first (last one by key order wins is not
    defined by the reference; we keep the longest content, ties by value), so the join cannot
    fan out.
    """
    asked = manifest.select(on).where(F.col(on).isNotNull()).distinct()
    # contents that nobody asks for leave before any bytes are compared
    uniq = (content.join(asked, on, "left_semi")
            .groupBy(on)
            .agg(F.max_by(F.col(content_col), F.struct(F.length(content_col), F.col(content_col)))
                 .alias(content_col)))
    joined = manifest.join(uniq, on, "left")
    status = (F.when(F.col(on).isNull(), F.lit("no_url"))
              .when(F.col(content_col).isNull(), F.lit("missing"))
              .when(F.length(content_col) == 0, F.lit("empty"))
              .otherwise(F.lit("ok")))
    return joined.withColumn("status", status)


def missing_inputs(expected: DataFrame, present: DataFrame, on: str = "file") -> DataFrame:
    """Expected input files that are not present (left anti on the file name)."""
    return expected.join(present.select(on).distinct(), on, "left_anti")


def expected_counts(processed: DataFrame, expected: DataFrame, file: str = "file", lang: str = "lang",
                    en: str = "en") -> DataFrame:
    """Rows expected vs processed per input file, all and of one language.

    ``expected`` is either a raw table (one row per expected row, with ``file``/``lang``) or an
    already counted table ``(file, expected_rows, expected_en)``.
    """
    if "expected_rows" not in expected.columns:
        expected = expected.groupBy(file).agg(
            F.count(F.lit(1)).alias("expected_rows"),
            F.count_if(F.col(lang) == en).cast("long").alias("expected_en"))
    got = processed.groupBy(file).agg(F.count(F.lit(1)).alias("rows"),
                                      F.count_if(F.col(lang) == en).cast("long").alias("rows_en"))
    j = expected.join(got, file, "left")
    return j.select(file, "expected_rows", "expected_en",
                    F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
                    F.coalesce("rows_en", F.lit(0).cast("long")).alias("rows_en"),
                    (F.col("expected_rows") - F.coalesce("rows", F.lit(0))).alias("missing_rows"))
