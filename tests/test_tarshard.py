"""tarshard data source: write -> read round trip, bounds, gzip, checked with Python's tarfile."""

import glob
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from capset.sinks import write_tar_shards
from capset.sources import tarshard


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(f"{i:09d}", bytes([i % 256]) * (i % 50 + 1), f"caption {i}".encode(), None if i % 3 else f'{{"i": {i}}}')
            for i in range(1000)]
    return spark.createDataFrame(rows, "key string, img binary, cap binary, json string").repartition(4)


def test_round_trip_greedy(spark, samples, tmp_dir):
    out = os.path.join(tmp_dir, "shards")
    write_tar_shards(samples, out, maxcount=100, maxsize=1e9, prefix="ds_", check=False)
    files = sorted(glob.glob(os.path.join(out, "ds_*.tar")))
    assert files and not glob.glob(os.path.join(out, ".*tmp"))
    for f in files:
        with tarfile.open(f) as t:
            keys = {m.name.split(".")[0] for m in t.getmembers()}
            assert len(keys) <= 100
    tarshard.register(spark)
    back = spark.read.format("tarshard").load(out)
    a = sorted((r.key, bytes(r.img), bytes(r.cap), r.json) for r in back.collect())
    b = sorted((r.key, bytes(r.img), bytes(r.cap), r.json) for r in samples.collect())
    assert a == b


def test_maxsize_roll(spark, samples, tmp_dir):
    out = os.path.join(tmp_dir, "shards")
    write_tar_shards(samples.coalesce(1), out, maxcount=100000, maxsize=2000, check=False)
    sizes = []
    for f in sorted(glob.glob(os.path.join(out, "*.tar"))):
        with tarfile.open(f) as t:
            sizes.append(sum(m.size for m in t.getmembers()))
    biggest = max(50 + len("caption 999") + len('{"i": 999}'), 0)
    assert all(s < 2000 + biggest for s in sizes)
    assert len(sizes) > 5


def test_gzip_prefix_packing(spark, tmp_dir):
    df = spark.range(0, 300).select(F.col("id").alias("row_id"),
                                    F.format_string("%09d", "id").alias("key"),
                                    F.encode(F.concat(F.lit("text "), F.col("id").cast("string")), "UTF-8").alias("cap"),
                                    F.lit(10).alias("nbytes"))
    out = os.path.join(tmp_dir, "gz")
    write_tar_shards(df, out, maxcount=64, maxsize=1e9, prefix="wds_", compression="gzip",
                     packing="prefix", size_col="nbytes", check=False)
    files = sorted(os.path.basename(f) for f in glob.glob(os.path.join(out, "*.tar.gz")))
    assert files == [f"wds_{i:06d}.tar.gz" for i in range(5)]
    with tarfile.open(os.path.join(out, files[0]), "r:gz") as t:
        names = [m.name for m in t.getmembers()]
    assert names[0] == "000000000.cap" and len(names) == 64
    tarshard.register(spark)
    back = spark.read.format("tarshard").schema("key string, cap string").load(out)
    assert back.count() == 300
    assert back.where("key = '000000299'").first().cap == "text 299"


def test_bounds_checked(spark, samples, tmp_dir):
    with pytest.raises(ValueError):
        write_tar_shards(samples, os.path.join(tmp_dir, "x"), maxsize=1000)


def test_append_keeps_earlier_shards_and_overwrite_replaces(spark, samples, tmp_dir):
    out = os.path.join(tmp_dir, "app")
    write_tar_shards(samples, out, maxcount=500, check=False)
    n1 = len(glob.glob(os.path.join(out, "*.tar")))
    write_tar_shards(samples, out, maxcount=500, check=False, mode="append")
    assert len(glob.glob(os.path.join(out, "*.tar"))) == 2 * n1
    tarshard.register(spark)
    assert spark.read.format("tarshard").load(out).count() == 2000
    write_tar_shards(samples, out, maxcount=500, check=False, mode="overwrite")
    assert spark.read.format("tarshard").load(out).count() == 1000


def shard_rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        (F.col("id") - start).alias("row_id"), F.format_string("%09d", "id").alias("key"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("cap"), F.lit(10).alias("nbytes"))


def test_appended_numbered_shards_count_on(spark, tmp_dir):
    out = os.path.join(tmp_dir, "n")
    for start, mode in ((0, "overwrite"), (200, "append")):
        write_tar_shards(shard_rows(spark, 200, start), out, maxcount=64, packing="prefix", size_col="nbytes", check=False, mode=mode)
    assert sorted(map(os.path.basename, glob.glob(f"{out}/*.tar"))) == [f"ds_{i:06d}.tar" for i in range(8)]
    tarshard.register(spark)
    assert spark.read.format("tarshard").schema("key string, cap string").load(out).distinct().count() == 400


def test_overwrite_leaves_other_shards_alone(spark, tmp_dir):
    out = os.path.join(tmp_dir, "o")
    one = dict(maxcount=64, packing="prefix", size_col="nbytes", check=False)
    write_tar_shards(shard_rows(spark, 200), out, **one)
    write_tar_shards(shard_rows(spark, 10), out, prefix="ds_b_", **one)
    write_tar_shards(shard_rows(spark, 10), os.path.join(out, "sub"), **one)
    write_tar_shards(shard_rows(spark, 30), out, **one)
    assert sorted(os.path.relpath(p, out) for p in glob.glob(f"{out}/**/*.tar", recursive=True)) == [
        "ds_000000.tar", "ds_b_000000.tar", "sub/ds_000000.tar"]


def test_rows_of_a_shard_apart_and_dotted_keys_fail(spark, tmp_dir):
    rows = spark.createDataFrame([(f"k{i}", i % 2, b"x") for i in range(6)], "key string, shard int, cap binary").coalesce(1)
    tarshard.register(spark)
    with pytest.raises(Exception, match="not together"):
        rows.write.format("tarshard").option("shardColumn", "shard").mode("append").save(os.path.join(tmp_dir, "a"))
    both = rows.where("shard = 0").repartition(2)
    with pytest.raises(Exception, match="one number"):
        both.write.format("tarshard").option("shardColumn", "shard").mode("append").save(os.path.join(tmp_dir, "b"))
    with pytest.raises(Exception, match="holds a dot"):
        rows.selectExpr("concat(key, '.a') AS key", "cap").write.format("tarshard").mode("append").save(os.path.join(tmp_dir, "c"))
    assert not glob.glob(f"{tmp_dir}/*/*.tar")


def test_unwanted_members_are_skipped_and_batches_closed_by_bytes(spark, tmp_dir, monkeypatch):
    from pyspark.sql.types import StructType

    out = os.path.join(tmp_dir, "w")
    big = spark.range(40).select(F.format_string("%09d", "id").alias("key"), F.expr("cast(repeat('x', 200000) as binary)").alias("img"),
                                 F.encode(F.lit("c"), "UTF-8").alias("cap")).coalesce(1)
    write_tar_shards(big, out, check=False)
    monkeypatch.setattr(tarshard, "BATCH_BYTES", 1_000_000)
    (shard,) = glob.glob(f"{out}/*.tar")
    schema = StructType().add("key", "string").add("img", "binary")
    r = tarshard.TarShardReader(schema, {"path": out})
    assert [b.num_rows for b in r.read(tarshard.ShardPartition(shard))] == [5] * 8
    r = tarshard.TarShardReader(StructType().add("key", "string").add("cap", "binary"), {"path": out})
    assert [b.num_rows for b in r.read(tarshard.ShardPartition(shard))] == [40]


def test_published_shards(spark, tmp_dir):
    """Numbered shards by list: append counts on, overwrite hides, lost files and the other commit are refused."""
    from capset.operators.rows import with_row_id

    out, src = f"{tmp_dir}/out", f"{tmp_dir}/src"
    spark.range(10).write.parquet(src)
    rows = with_row_id(spark.read.parquet(src)).select(
        "row_id", F.format_string("%09d", "id").alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("cap"), F.lit(5).alias("size"))
    put = lambda mode: write_tar_shards(rows, out, maxcount=4, maxsize=1e8, packing="prefix", size_col="size", mode=mode, commit="list")
    tarshard.register(spark)
    read = lambda: sorted(r.key for r in spark.read.format("tarshard").schema("key string, cap binary").load(out).collect())
    put("append")
    put("append")
    numbers = sorted(int(os.path.basename(p)[3:9]) for p in glob.glob(f"{out}/*.tar"))
    assert numbers == list(range(6)) and not glob.glob(f"{out}/.*tmp")
    assert read() == sorted(2 * [f"{i:09d}" for i in range(10)])
    with open(f"{out}/ds_000077-lost.tar", "wb") as f:
        f.write(b"half a shard of a lost attempt")
    put("overwrite")
    assert read() == [f"{i:09d}" for i in range(10)]
    with pytest.raises(Exception, match="commit=list"):
        write_tar_shards(rows, out, maxcount=4, maxsize=1e8, packing="prefix", size_col="size", mode="append")
