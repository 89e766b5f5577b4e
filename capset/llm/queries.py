"""The operators over the driver's tables, in the columns of their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.llm.conversation_sql import repair_sql, trie_sql
from capset.llm.registry import ORACLES, QUERIES, register, table  # noqa: F401


@register("op1_exact_dedup", oracle=r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


@register("op4_source_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "shard", "quota")


#: The contract's rules: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@register("op6_url_filter", oracle=r"""
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
best AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (page_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.url_filter import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.lang_id import identify, train

    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.toxicity import score_toxicity, train

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


@register("op5_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@register("op8_embedding_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.embedding_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.token_counts import token_counts
    from capset.llm.vocabulary import load

    return token_counts(table(spark, sf_dir, "documents"), load())


@register("op9_segmentation")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every text: lengths, scores, a hash of the pieces, and of what they decode to."""
    from capset.llm.segmentation import sample_segmentations
    from capset.llm.vocabulary import load

    return sample_segmentations(table(spark, sf_dir, "documents"), load(), k=2, decoded=True).select(
        "doc_id", "sample", F.size("pieces").cast("long").alias("n_pieces"), "log_prob", "key", "log_inclusion",
        F.xxhash64("pieces").alias("pieces_hash"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


@register("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.html_extract import extract, train

    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


@register("op12_bpe_codec")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.bpe import encode_decode, load

    return encode_decode(table(spark, sf_dir, "documents"), load()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@register("op11_conversation_repair", oracle=repair_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.conversation_repair import damage, repair
    from capset.llm.ordered_hash import EMPTY, ordered_sha256

    rows = table(spark, sf_dir, "conversations")
    report, edits = repair(damage(rows))
    hashes = ordered_sha256(edits.where("edit != 'D'"), F.col("conv_id"), ["place", "step"], F.concat_ws(":", "role", "text"), "\n")
    named = rows.select("conv_id").distinct()
    found = report.withColumnRenamed("conv_id", "_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return named.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(
        hashes, F.col("conv_id").cast("string").eqNullSafe(F.col("_key")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256"))


@register("op13_conversation_trie", oracle=trie_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capset.llm.conversation_trie import prefix_trie

    conv = F.col("conv")
    trie = prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    return trie.drop("first", "last")
