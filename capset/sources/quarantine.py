"""Damaged input as a result: one scan gives the good rows and a table of the bad ones.

The rows of a reader carry where they come from, what is wrong with them (``_reason``, null if nothing) and, if bad, their raw
form.  ``split_quarantined`` writes them once, good and bad apart, so the input is read once, however often either part is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POSITION = ["_file", "_block", "_place"]
_CORRUPT = "_corrupt"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", quote: str = '"', header: bool = False) -> DataFrame:
    """Lines of delimited text: the columns of ``schema`` (DDL), and ``_reason, _raw, _file, _block, _place``.

    Bad are lines with too few or too many fields, with an odd number of quotes (``quote=''``: quotes are letters), and with a
    value that its type can't hold; their columns are null.  A record is a line.  An empty field is null; an empty line has one field.
    ``_block`` is the first byte of the input split, ``_place`` rises from line to line inside it.
    """
    fields = StructType.fromDDL(schema).fieldNames()
    lines = spark.read.text(path).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"))
    if header:  # the first line of each file: of the split that begins with it
        names = sep.join(fields)
        lines = lines.where((F.col("_block") > 0) | (F.col("_line") != names))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": quote or "\0", "quote": quote or "\0",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss", "maxCharsPerColumn": "-1"}
    parsed = F.from_csv(F.col("_line"), f"{schema}, {_CORRUPT} string", options)
    bare, quotes = F.col("_line"), F.lit(0)
    if quote:
        q = "\\Q" + quote + "\\E"
        bare = F.regexp_replace("_line", f"{q}[^{'' if quote.isalnum() else chr(92)}{quote}]*{q}", "")
        quotes = F.length("_line") - F.length(F.replace("_line", F.lit(quote), F.lit("")))
    n = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    reason = F.when(quotes % 2 == 1, "unclosed quote").when(n < len(fields), F.format_string("%d of %d fields", n, F.lit(len(fields)))) \
        .when(n > len(fields), F.format_string("%d fields, %d expected", n, F.lit(len(fields)))) \
        .when(F.col(f"_row.{_CORRUPT}").isNotNull(), "wrong type")
    rows = lines.withColumn("_row", parsed).withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    return rows.select(*[F.when(good, F.col(f"_row.`{c}`")).alias(c) for c in fields], "_reason",
                       F.when(~good, F.col("_line")).alias("_raw"), *POSITION)


def read_tfrecord(spark: SparkSession, path: str, schema: str, index: str | None = None) -> DataFrame:
    """Records of TFRecord files: the columns of ``schema``, and ``_reason, _raw, _file, _block, _place`` (the record's first byte).

    A record is bad if its checksum or its form is wrong; a damaged length takes the rest of the file (with an index, which
    ends at that place, too) and is one bad row.
    """
    from capset.sources import tfrecord

    fields = f"{schema}, _corrupt string, _raw binary, _file string, _offset bigint"
    if index:
        rows = tfrecord.read_indexed(spark, path, index, fields, mode="PERMISSIVE")
    else:
        tfrecord.register(spark)
        rows = spark.read.format("tfrecord").schema(fields).option("mode", "PERMISSIVE").load(path)
    return rows.withColumnsRenamed({"_corrupt": "_reason", "_offset": "_place"}).withColumn("_block", F.lit(0).cast("long"))


def split_quarantined(rows: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """Write ``rows`` once below ``out``; good rows (their own columns) and bad ones: ``file, position, raw, reason``.

    ``position`` is the line in the file (from 0; lines of earlier splits are counted from what was written) or, of sources that know
    it, the first byte."""
    spark = rows.sparkSession
    rows.withColumn("_bad", F.col("_reason").isNotNull()).write.partitionBy("_bad").parquet(out)
    back = spark.read.schema(StructType([*rows.schema.fields, *StructType.fromDDL("_bad boolean").fields])).parquet(out)
    own = [c for c in rows.columns if c not in (*POSITION, "_reason", "_raw")]
    good, bad = back.where("not _bad").select(own), back.where("_bad")
    if dict(rows.dtypes)["_raw"] == "string":
        # one row for each input split
        splits = back.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy("_file").orderBy("_block")
        splits = splits.select("_file", "_block", "_first", (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
        bad = bad.join(splits, ["_file", "_block"]).withColumn("_place", F.col("_place") - F.col("_first") + F.col("_before"))
    return good, bad.select(F.col("_file").alias("file"), F.col("_place").alias("position"), F.col("_raw").alias("raw"), F.col("_reason").alias("reason"))
