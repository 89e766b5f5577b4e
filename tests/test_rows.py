"""Row identity, near-equal parts, running sums, shard numbers, dense positions."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from capset.operators import rows as R


def write_csv(dirpath, name, lines):
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write("".join(l + "\n" for l in lines))
    return p


def test_with_row_id_csv_many_splits(spark, tmp_dir):
    # two files, several splits each (tiny maxPartitionBytes), row id = position in file order
    a = [f"a{i}\tcap {i}" for i in range(700)]
    b = [f"b{i}\tcap {i}" for i in range(300)]
    write_csv(tmp_dir, "part-1.tsv", a)
    write_csv(tmp_dir, "part-2.tsv", b)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = spark.read.schema("url string, caption string").option("sep", "\t").csv(tmp_dir)
        assert df.rdd.getNumPartitions() > 3
        got = {r.url: r.row_id for r in R.with_row_id(df, source="split").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expect = {u.split("\t")[0]: i for i, u in enumerate(a + b)}
    assert got == expect


def test_with_row_id_parquet(spark, tmp_dir):
    for k in range(3):
        spark.range(k * 100, k * 100 + 100).coalesce(1).write.parquet(os.path.join(tmp_dir, f"f{k}"))
    df = spark.read.parquet(*[os.path.join(tmp_dir, f"f{k}") for k in range(3)])
    got = R.with_row_id(df).collect()
    assert sorted((r.id, r.row_id) for r in got) == [(i, i) for i in range(300)]


@pytest.mark.parametrize("n,size", [(23, 5), (1000, 300), (7, 50), (100, 10), (101, 10)])
def test_near_equal_parts_equals_array_split(spark, n, size):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    got = [r.part for r in R.near_equal_parts(df, size).orderBy("row_id").collect()]
    k = max(1, n // size)
    expect = np.concatenate([np.full(len(p), i + 1) for i, p in enumerate(np.array_split(np.arange(n), k))])
    assert got == expect.tolist()


def test_running_sum_across_blocks(spark):
    vals = [(i, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(vals, "row_id long, v long")
    got = {r.row_id: r.before for r in R.running_sum_before(df, "v", block_rows=16).collect()}
    acc, expect = 0, {}
    for i, v in vals:
        expect[i] = acc
        acc += v
    assert got == expect


def greedy_prefix(sizes, maxsize, maxcount):
    out, before = [], 0
    pairs = []
    for i, s in enumerate(sizes):
        pairs.append((before // maxsize, i // maxcount))
        before += s
    uniq = sorted(set(pairs))
    return [uniq.index(p) for p in pairs]


def test_shard_numbers_bounds(spark):
    sizes = [(i * 7919) % 300 + 1 for i in range(500)]
    df = spark.createDataFrame(list(enumerate(sizes)), "row_id long, nbytes long")
    got = R.shard_numbers(df, "nbytes", maxsize=2000, maxcount=40, block_rows=64).orderBy("row_id").collect()
    shards = [r.shard for r in got]
    assert shards == greedy_prefix(sizes, 2000, 40)
    # a shard never holds more than maxcount rows; numbers are dense and increasing
    from collections import Counter
    assert max(Counter(shards).values()) <= 40
    assert sorted(set(shards)) == list(range(max(shards) + 1))
    assert shards == sorted(shards)


def test_dense_positions_after_sort(spark):
    df = spark.range(0, 1000).withColumn("k", F.md5(F.col("id").cast("string"))).repartition(7)
    got = R.dense_positions(df.orderBy("k")).collect()
    pos = sorted((r.k, r.position) for r in got)
    assert [p for _, p in pos] == list(range(1000))


def test_batch_and_range(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "row_id")
    b = R.batch(df, 100).groupBy("batch").count().orderBy("batch").collect()
    assert [(r.batch, r["count"]) for r in b] == [(0, 100), (1, 100), (2, 50)]
    assert R.row_range(df, 95, 10).count() == 10
    keys = R.sample_keys(df.where("row_id in (0, 7)")).orderBy("row_id").collect()
    assert [k.key for k in keys] == ["000000000", "000000007"]
