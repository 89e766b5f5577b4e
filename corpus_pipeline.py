"""The corpus pipeline: documents through five operators of ``capset.llm``, each stage written and reread.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows that its predecessor kept.  All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.llm.common import prepare
from capset.session import scratch_path

#: Words of a shingle and least similarity in percent of the near-duplicate stage.
SHINGLE_WORDS, SIMILARITY = 5, 80
#: Segmentations drawn of each text.
SAMPLES = 2

#: The models and the sampled segmentations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells, with ``lang`` as predicted; those of unknown language go.

    The classifier rejects texts without any letter (null and empty ones among them).  ``lang`` becomes
    the prediction; where that is ambiguous, a label that is there stays.
    """
    from capset.llm.lang_id import UNKNOWN, predicted, train

    prepare(spark)
    told = docs.withColumn("_capset_lang", predicted(docs["text"], train(docs)))
    lang = F.col("_capset_lang.lang_pred")
    return told.where(lang != UNKNOWN).select(
        *[F.coalesce(F.when(F.col("_capset_lang.ambiguous"), docs[c]), lang).alias(c) if c == "lang" else docs[c] for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (after white space is evened out) stays: that of the smallest id."""
    from capset.llm.exact_dedup import drop_exact_copies

    prepare(spark)
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id."""
    from capset.llm.near_dedup import near_duplicates

    prepare(spark)
    kept = near_duplicates(docs, SHINGLE_WORDS, SIMILARITY).where("kept").select(F.col("doc_id").alias("_keep"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_keep"]), "left_semi")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: each document as often as its words are taken, in whole documents.

    A document whose words are taken at least half goes in once, one taken one and a half times twice, and so
    on; documents of which less than half is taken don't.
    """
    from capset.llm.mixing import mix

    prepare(spark)
    times = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    taken = mix(docs).select(F.col("doc_id").alias("_id"), times.alias("_times")) \
        .groupBy("_id").agg(F.max("_times").alias("_times")).where("_times > 0")  # rows that repeat an id go as often
    mixed = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]))
    copies = F.explode(F.sequence(F.lit(1), taken["_times"])).alias("_copy")
    return mixed.select(*[docs[c] for c in docs.columns], copies).drop("_copy")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training rows: ``doc_id, lang, source, sample, pieces, log_prob, log_inclusion`` of sampled segmentations."""
    from capset.llm.segmentation import sample_segmentations
    from capset.llm.vocabulary import load

    prepare(spark)
    return sample_segmentations(docs, load(), SAMPLES, more=["lang", "source"]).select(
        "doc_id", "lang", "source", "sample", "pieces", "log_prob", "log_inclusion")


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("source mixing", source_mix),
    ("SentencePiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"corpus-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
