"""Image files made from table columns, read back: sizes, validity, pixels, resampling.

``embeddings`` stand for images: vector ``i`` has ``1 + i % 13`` by ``1 + i % 7`` pixels, their bytes the md5 of its id again and again;
odd ones are PNG, even ones BMP files; of every fifth the file's beginning is cut off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.functions.ids import shard_dir
from capset.operators.pixels import resize_to_cover
from capset.plans import sqltext as S
from capset.plans.registry import load, register
from capset.session import scratch_path
from capset.sources import files as FS
from capset.sources import images as IM

_BOX = (4, 3)
_SIZES_SQL = "SELECT vec_id, 1 + vec_id % 13 AS w, 1 + vec_id % 7 AS h, vec_id % 5 <> 0 AS valid, md5(CAST(vec_id AS VARCHAR)) AS m FROM embeddings"


def _written(spark: SparkSession, sf: str, name: str) -> str:
    path = scratch_path(spark, name)
    i = F.col("vec_id")
    w, h = (1 + i % 13).cast("int"), (1 + i % 7).cast("int")
    ext = F.when(i % 2 == 1, "png").otherwise("bmp")
    pixels = F.substring(F.unhex(F.repeat(F.md5(i.cast("string")), 3 * 13 * 7 // 16 + 1)), 1, 3 * w * h)
    d = load(spark, sf, "embeddings").select(F.concat_ws("/", shard_dir("vec_id", 100), F.concat_ws(".", i.cast("string"), ext)).alias("name"),
                                            IM.encoded(ext, w, h, pixels).alias("content"), (i % 5 == 0).alias("cut"))
    IM.write_files(d.withColumn("content", F.when(F.col("cut"), F.substring("content", 9, 1 << 20)).otherwise(F.col("content"))), path)
    return path


def _vector(path: str) -> F.Column:
    return F.regexp_extract(path, r"(\d+)\.(?:png|bmp)$", 1).cast("long").alias("vec_id")


@register("image_profiles", oracle=f"""
SELECT vec_id, CASE WHEN valid THEN w ELSE -1 END AS width, CASE WHEN valid THEN h ELSE -1 END AS height, valid,
  CASE WHEN vec_id % 2 = 1 THEN 'png' ELSE 'bmp' END AS ext, {S.shard_dir('vec_id', 100)} AS folder FROM ({_SIZES_SQL})
""")
def image_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Width, height and validity of every file of the tree, beside its listing."""
    path = _written(spark, sf, "image_profiles")
    files = FS.scan_files(spark, path, exts=["png", "bmp"]).select("path", "ext", "folder")
    profiles = FS.image_profiles(spark, path)
    return files.join(profiles, "path").select(_vector("path"), F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"), "valid", "ext", "folder")


@register("image_resample", oracle=f"""
WITH s AS (SELECT vec_id, w, h, m, greatest(CAST({_BOX[0]} AS DOUBLE) / w, CAST({_BOX[1]} AS DOUBLE) / h) AS a FROM ({_SIZES_SQL}) WHERE valid),
n AS (SELECT *, CAST(floor(w * a) AS BIGINT) AS nw, CAST(floor(h * a) AS BIGINT) AS nh FROM s),
o AS (SELECT *, unnest(range(nh)) AS y FROM n),
p AS (SELECT *, unnest(range(nw)) AS x FROM o),
q AS (SELECT *, unnest(range(CAST(floor(y * h / CAST(nh AS DOUBLE)) AS BIGINT), least(h, CAST(ceil((y + 1) * h / CAST(nh AS DOUBLE)) AS BIGINT)))) AS py FROM p),
r AS (SELECT *, unnest(range(CAST(floor(x * w / CAST(nw AS DOUBLE)) AS BIGINT), least(w, CAST(ceil((x + 1) * w / CAST(nw AS DOUBLE)) AS BIGINT)))) AS px FROM q),
c AS (SELECT *, unnest(range(3)) AS ch FROM r),
v AS (SELECT vec_id, nw, nh, y, x, ch, sum(
  greatest(0, least((y + 1) * h / CAST(nh AS DOUBLE), py + 1) - greatest(y * h / CAST(nh AS DOUBLE), py)) *
  greatest(0, least((x + 1) * w / CAST(nw AS DOUBLE), px + 1) - greatest(x * w / CAST(nw AS DOUBLE), px)) *
  CAST('0x' || substr(m, 1 + 2 * CAST(((py * w + px) * 3 + ch) % 16 AS INTEGER), 2) AS BIGINT)) * nh * nw / (CAST(h AS DOUBLE) * w) AS mean
  FROM c GROUP BY vec_id, nw, nh, w, h, y, x, ch)
SELECT vec_id, nw AS width, nh AS height, md5(string_agg(printf('%02x', CAST(round_even(round(mean, 6), 0) AS BIGINT)), '' ORDER BY y, x, ch)) AS md5 FROM v GROUP BY vec_id, nw, nh
""")
def image_resample(spark: SparkSession, sf: str) -> DataFrame:
    """Every image that opens, scaled to cover a box: exact area weights, against sums over all pixels."""
    path = _written(spark, sf, "image_resample")
    images = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", FS.ext_glob(["png", "bmp"])).load(path)
    small = resize_to_cover(images, *_BOX)
    return small.select(_vector("origin"), F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"), F.md5(F.lower(F.hex("data"))).alias("md5"))
