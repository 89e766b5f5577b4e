"""Manifest, annotation and narrative readers (CSV / TSV / JSON / text).

All readers take an explicit schema (no inference pass over the data) and return plain
DataFrames, so Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.operators.rows import with_row_id

# --- fixed values: the wide article manifest (17 typed columns, in file order) ---------------
WIDE_MANIFEST_DDL = (
    "language string, page_url string, image_url string, page_title string, section_title string, "
    "hierarchical_section_title string, caption_reference_description string, "
    "caption_attribution_description string, caption_alt_text_description string, mime_type string, "
    "original_height int, original_width int, is_main_image boolean, attribution_passes_lang_id boolean, "
    "page_changed_recently string, context_page_description string, context_section_description string"
)
# ------------------------------------------------------------------------------------------------
OVERFLOW = "_overflow"


def _csv(spark: SparkSession, schema, sep: str, header: bool, **opts):
    r = (spark.read.schema(schema).option("sep", sep).option("header", header)
         .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    for k, v in opts.items():
        r = r.option(k, v)
    return r


def read_manifest(spark: SparkSession, path, columns=("url", "caption"), sep: str = "\t",
                  header: bool = False, keep=None, row_ids: bool = True) -> DataFrame:
    """Two-column URL–caption manifest (any column order), or a header file keeping ``keep``.

    ``row_ids`` adds ``row_id`` = position in file order (files sorted by path), taken before any
    filter, like the reference's row index.  Doubled quotes inside fields are unescaped.
    """
    if header:
        df = spark.read.option("sep", sep).option("header", True).option("quote", '"') \
                  .option("escape", '"').csv(path)
        if keep:
            df = df.select(*keep)
    else:
        schema = ", ".join(f"`{c}` string" for c in columns)
        df = _csv(spark, schema, sep, False).csv(path)
    return with_row_id(df, source="split") if row_ids else df


def read_wide_manifest(spark: SparkSession, path, schema: str = WIDE_MANIFEST_DDL, sep: str = "\t",
                       overflow: str = "drop", row_ids: bool = True) -> DataFrame:
    """Typed, quoted, header TSV (gzip by suffix).  Short rows are kept with nulls; rows with
    extra fields are dropped (``overflow='drop'``), kept (``'keep'``) or fail (``'error'``).

    Only ``''`` is a null value (pandas would also turn ``None``/``null``/``NA`` into nulls).
    """
    full = f"{schema}, {OVERFLOW} string"
    df = _csv(spark, full, sep, True, nullValue="", emptyValue="").csv(path)
    if row_ids:
        df = with_row_id(df, source="split")
    if overflow == "drop":
        df = df.where(F.col(OVERFLOW).isNull())
    elif overflow == "error":
        bad = df.where(F.col(OVERFLOW).isNotNull()).limit(1).count()
        if bad:
            raise ValueError("manifest has rows with more fields than the schema")
    return df.drop(OVERFLOW)


def list_inputs(spark: SparkSession, path, glob: str = "*.tsv.gz", exclude_substring: str | None = None
                ) -> DataFrame:
    """Sorted listing of input files (hidden files and non-matching names left out)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    files = files.withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1)) \
                 .where(~F.col("file").startswith("."))
    if exclude_substring:
        files = files.where(F.instr("file", exclude_substring) == 0)
    return files.orderBy("file")


def read_annotations(spark: SparkSession, paths: dict, schema: str = "ImageID string, LabelName string, "
                     "Confidence double") -> DataFrame:
    """Label annotation CSVs, one per split: ``{split: path}`` -> rows with ``split`` and
    ``order`` (position in its file)."""
    parts = []
    for split, p in paths.items():
        df = spark.read.schema(schema).option("header", True).csv(p)
        df = with_row_id(df, "order", source="split").withColumn("split", F.lit(split))
        parts.append(df)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_dictionary(spark: SparkSession, path, code: str = "code", name: str = "name") -> DataFrame:
    """``code,name`` CSV without header (quoted names may hold commas); blank lines skipped."""
    df = spark.read.schema(f"`{code}` string, `{name}` string").option("quote", '"').csv(path)
    return df.where(F.col(code).isNotNull() & (F.length(code) > 0))


def read_narratives(spark: SparkSession, paths, schema: str = "image_id string, caption string",
                    rename=("caption", "narrative"), order: str | None = None) -> DataFrame:
    """JSON-lines narrative files appended; ``caption`` columns renamed to ``narrative``.

    ``order`` names a column that sorts rows by file, in the order given, and by place in the file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    old, new = rename
    parts = []
    for rank, path in enumerate(paths):
        df = spark.read.schema(schema).json(path)
        names = [c.replace(old, new) for c in df.columns]
        if order:
            # inside a split rows are numbered as they are read; splits of a file by where they begin
            df = df.withColumn(order, F.struct(F.lit(rank).alias("rank"), F.col("_metadata.file_path").alias("file"),
                                               F.col("_metadata.file_block_start").alias("block"),
                                               F.monotonically_increasing_id().alias("row")))
            names.append(order)
        parts.append(df.toDF(*names))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_caption_map(spark: SparkSession, path, key_sep: str = "_") -> DataFrame:
    """One JSON object ``{key: {path, caption}}`` -> rows ``(key, image_id, path, caption)``;
    ``image_id`` is the part of the key after its last ``key_sep``."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, struct<path: string, caption: string>>")
    rows = raw.select(F.explode(m).alias("key", "v"))
    return rows.select("key", F.substring_index("key", key_sep, -1).alias("image_id"),
                       F.col("v.path").alias("path"), F.col("v.caption").alias("caption"))


def read_corpus(spark: SparkSession, path) -> DataFrame:
    """A text corpus: one file, or every ``.txt`` below a folder; one row per file (whole text)."""
    r = spark.read
    if not str(path).lower().endswith(".txt"):
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    return r.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_corpus_lines(spark: SparkSession, path) -> DataFrame:
    """The lines of a text corpus (one file, or every ``.txt`` below a folder): ``path, block, place, text``.

    Files are cut at line ends into input splits, so no row is longer than a line and a large file is read by many tasks.
    ``block`` is the first byte of the split, ``place`` rises from line to line inside it.
    """
    r = spark.read
    if not str(path).lower().endswith(".txt"):
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    return r.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                               F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"))
