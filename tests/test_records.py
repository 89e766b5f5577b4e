"""TFRecord sink, index and weights; damaged input; commit by a list."""

import os
import struct

import pytest
from fixtures import example, framed, write
from pyspark.sql import functions as F

from capset.operators.ordering import weighted_interleave
from capset.sources import quarantine as Q
from capset.sources import tfrecord as TF
from capset.sources.visible import publish, visible_files


def test_examples_read_back():
    features = [("a", "bytes", [b"x", b""]), ("b", "float", [0.5, -2.0]), ("c", "int64", [1, -1, 2**62]), ("d", "bytes", []), ("é", "int64", [0])]
    assert TF.parse_example(TF.encode_example(features)) == {n: (k, v) for n, k, v in features}
    assert TF.frame_record(b"abc") == framed(b"abc")


def test_write_all_types_nulls_and_rolling(spark, tmp_dir):
    TF.register(spark)
    df = spark.sql("SELECT id, cast(id AS string) s, cast(concat('b', id) AS binary) b, id % 2 = 0 flag, cast(id AS int) i, cast(id / 4 AS float) f, "
                   "array(id, -id) many, if(id % 3 = 0, null, 'x') maybe FROM range(25)")
    df.repartition(2).write.format("tfrecord").mode("append").option("maxrecords", 5).save(tmp_dir)
    assert len([n for n in os.listdir(tmp_dir) if n.endswith(".tfrecord")]) == 6
    back = spark.read.format("tfrecord").schema(
        "id bigint, s string, b binary, flag bigint, i int, f float, many array<bigint>, maybe string").load(tmp_dir)
    want = {tuple(map(str, r)) for r in df.withColumn("flag", F.col("flag").cast("long")).collect()}
    assert {tuple(map(str, r)) for r in back.collect()} == want
    inferred = spark.read.format("tfrecord").load(tmp_dir)
    assert dict(inferred.dtypes) == dict(id="bigint", s="binary", b="binary", flag="bigint", i="bigint", f="float", many="array<bigint>", maybe="binary")
    with pytest.raises(Exception, match="can't hold"):
        spark.sql("SELECT current_timestamp() t").write.format("tfrecord").mode("append").save(tmp_dir)


def test_append_and_overwrite_by_lists(spark, tmp_dir):
    TF.register(spark)
    read = lambda: sorted(r.id for r in spark.read.format("tfrecord").schema("id bigint").load(tmp_dir).collect())
    spark.range(3).write.format("tfrecord").mode("append").save(tmp_dir)
    spark.range(3, 5).write.format("tfrecord").mode("append").save(tmp_dir)
    assert read() == [0, 1, 2, 3, 4]
    write(os.path.join(tmp_dir, "part-lost.tfrecord"), framed(example({"id": 99})))  # of an attempt that never was committed
    assert read() == [0, 1, 2, 3, 4]
    spark.range(7, 9).write.format("tfrecord").mode("overwrite").save(tmp_dir)
    assert read() == [7, 8]


def test_lists(tmp_dir):
    from pyarrow import fs

    local = fs.LocalFileSystem()
    assert visible_files(local, os.path.join(tmp_dir, "none")) is None
    publish(local, tmp_dir, ["b", "a"], False)
    publish(local, tmp_dir, ["c"], False)
    assert visible_files(local, tmp_dir) == [os.path.join(tmp_dir, n) for n in "abc"]
    publish(local, tmp_dir, ["d"], True)
    assert visible_files(local, tmp_dir) == [os.path.join(tmp_dir, "d")]


def test_index_cuts_files_and_keeps_places(spark, tmp_dir):
    data, index = os.path.join(tmp_dir, "data"), os.path.join(tmp_dir, "index")
    os.makedirs(data)
    sizes = {"a": 200, "b": 7, "c": 0}
    for name, n in sizes.items():
        write(os.path.join(data, f"{name}.tfrecord"), b"".join(framed(example({"id": i, "x": b"y" * (i % 50)})) for i in range(n)))
    assert not TF.has_index(index)
    rows = TF.read_indexed(spark, data, index, "id bigint, _file string, _index bigint, _offset bigint", split_bytes=500)
    assert rows.rdd.getNumPartitions() > 10
    got = [(os.path.basename(r._file), r.id, r._index) for r in rows.collect()]
    assert sorted(got) == sorted((f"{f}.tfrecord", i, i) for f, n in sizes.items() for i in range(n))
    splits = TF.read_index(index)
    assert sum(s["records"] for s in splits) == 207 and all(s["stop"] - s["start"] < 700 for s in splits)
    assert sorted(r.id for r in TF.read_indexed(spark, data, index).select("id").collect()) == sorted([*range(200), *range(7)])
    write(os.path.join(data, "d.tfrecord"), framed(example({"id": 1})))
    with pytest.raises(Exception, match="other files"):
        TF.read_indexed(spark, data, index, "id bigint").collect()


def test_index_of_a_damaged_file_loses_only_what_is_behind(spark, tmp_dir):
    data, index = os.path.join(tmp_dir, "data"), os.path.join(tmp_dir, "index")
    os.makedirs(data)
    frames = [framed(example({"id": i})) for i in range(50)]
    frames[30] = struct.pack("<Q", 1 << 50) + frames[30][8:]
    frames[4] = frames[4][:-5] + bytes([frames[4][-5] ^ 1]) + frames[4][-4:]
    write(os.path.join(data, "a.tfrecord"), b"".join(frames))
    rows = Q.read_tfrecord(spark, data, "id bigint", index=index)
    good, bad = Q.split_quarantined(rows, os.path.join(tmp_dir, "out"))
    assert sorted(r.id for r in good.collect()) == [i for i in range(30) if i != 4]
    found = sorted((r.position, r.reason, r.raw is None) for r in bad.collect())
    at = [sum(map(len, frames[:n])) for n in (4, 30)]
    assert found == [(at[0], f"wrong checksum of the data at byte {at[0]}", False),
                     (at[1], f"wrong checksum of a length at byte {at[1]}; the rest of the file can't be read", True)]


def test_interleave_follows_the_weights(spark):
    rows = [("a", i) for i in range(300)] + [("b", i) for i in range(100)] + [("c", i) for i in range(20)]
    df = spark.createDataFrame(rows, "file string, index long").repartition(4)
    out = [(r.file, r["index"]) for r in weighted_interleave(df, "file", "index", {"a": 3.0}, 5).collect()]
    assert sorted(out) == sorted(rows)
    for f in "abc":
        assert [i for n, i in out if n == f] == list(range(sum(n == f for n, _ in rows)))
    head = [n for n, _ in out[:80]]  # 3 : 1 : 1, to within one record each
    assert abs(head.count("a") - 48) <= 2 and abs(head.count("b") - 16) <= 2 and abs(head.count("c") - 16) <= 2
    assert out == [(r.file, r["index"]) for r in weighted_interleave(df.repartition(2), "file", "index", {"a": 3.0}, 5).collect()]
    with pytest.raises(ValueError):
        weighted_interleave(df, "file", "index", {"a": 0})


def test_damaged_lines(spark, tmp_dir):
    lines = ["1\tx\t2", "2\ty", "3\tz\t4\tmore", '4\t"open\t5', '5\t"a\tb ""c"""\t6', "x\ty\t1", "", "7\t\t8", '8\t"two\tfields"\t9', "9\té\t"]
    write(os.path.join(tmp_dir, "in", "a.tsv"), "\n".join(lines).encode())
    write(os.path.join(tmp_dir, "in", "b.tsv"), b"1\tonly\n")
    good, bad = Q.split_quarantined(Q.read_delimited(spark, os.path.join(tmp_dir, "in"), "id int, name string, n int"), os.path.join(tmp_dir, "out"))
    assert sorted(((r.id, r.name, r.n) for r in good.collect()), key=str) == [
        (1, "x", 2), (5, 'a\tb "c"', 6), (7, None, 8), (8, "two\tfields", 9), (9, "é", None)]
    got = {(os.path.basename(r.file), r.position): (r.raw, r.reason) for r in bad.collect()}
    assert got == {("a.tsv", 1): ("2\ty", "2 of 3 fields"), ("a.tsv", 2): (lines[2], "4 fields, 3 expected"), ("a.tsv", 3): (lines[3], "unclosed quote"),
                   ("a.tsv", 5): (lines[5], "wrong type"), ("a.tsv", 6): ("", "1 of 3 fields"), ("b.tsv", 0): ("1\tonly", "2 of 3 fields")}


def test_positions_over_input_splits(spark, tmp_dir):
    lines = [f"{i}\tname {i}" if i % 10 else f"{i}" for i in range(2000)]
    write(os.path.join(tmp_dir, "in", "a.tsv"), "\n".join(lines).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        rows = Q.read_delimited(spark, os.path.join(tmp_dir, "in"), "id int, name string", quote="")
        assert rows.rdd.getNumPartitions() > 3
        good, bad = Q.split_quarantined(rows, os.path.join(tmp_dir, "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert good.count() == 1800
    assert sorted((r.position, int(r.raw)) for r in bad.collect()) == [(i, i) for i in range(0, 2000, 10)]
