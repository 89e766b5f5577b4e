"""Writers: folder-partitioned captions, ledger, fault report, JSON, TSV, embeddings, corpus, single tar."""

import glob
import os
import tarfile

from pyspark.sql import functions as F

from capset import sinks as K
from capset.operators import resume as RS


def test_write_captions_and_ledger(spark, tmp_dir):
    df = spark.range(0, 30).select(F.format_string("%09d", "id").alias("key"),
                                   F.concat(F.lit("cap "), F.col("id").cast("string")).alias("caption"),
                                   F.format_string("%05d", F.floor(F.col("id") / 10)).alias("folder"))
    K.write_captions(df, f"{tmp_dir}/caps")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/caps/folder=*")) == \
        ["folder=00000", "folder=00001", "folder=00002"]
    back = spark.read.parquet(f"{tmp_dir}/caps")
    assert back.count() == 30 and back.where("folder = '00001'").count() == 10
    K.append_ledger(RS.ledger_from(spark.range(3).withColumnRenamed("id", "row_id"), "fetch", "done"), f"{tmp_dir}/ledger")
    K.append_ledger(RS.ledger_from(spark.range(3, 5).withColumnRenamed("id", "row_id"), "fetch", "failed"),
                    f"{tmp_dir}/ledger")
    led = spark.read.parquet(f"{tmp_dir}/ledger")
    assert sorted((r.row_id, r.status) for r in led.collect()) == [
        (0, "done"), (1, "done"), (2, "done"), (3, "failed"), (4, "failed")]


def test_fault_report_json_tsv_embeddings(spark, tmp_dir):
    rep = spark.createDataFrame([("f1", ["a.txt"], [], ["b.txt"], ["f1/a.txt", "f1/b.txt"])],
                                "folder string, incomplete array<string>, corrupt array<string>, "
                                "empty array<string>, delete array<string>")
    K.write_fault_report(rep, f"{tmp_dir}/rep")
    lines = [l for p in sorted(glob.glob(f"{tmp_dir}/rep/part-*.csv")) for l in open(p).read().splitlines()]
    assert set(l for l in lines if not l.startswith("f1|")) == {"folder|incomplete|corrupt|empty|delete"}
    row = [l for l in lines if l.startswith("f1|")]
    assert row == ['f1|"[""a.txt""]"|[]|"[""b.txt""]"|"[""f1/a.txt"",""f1/b.txt""]"']
    caps = spark.createDataFrame([("k1", "p/1.jpg", "c1")], "key string, path string, caption string")
    K.write_captions_json(caps, f"{tmp_dir}/json")
    assert spark.read.json(f"{tmp_dir}/json").first().caption == "c1"
    wide = spark.createDataFrame([(2, 0.5), (1, 0.25)], "image_id long, section_title double")
    K.write_similarities(wide, f"{tmp_dir}/tsv")
    back = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_dir}/tsv")
    assert sorted(int(r.image_id) for r in back.collect()) == [1, 2]
    emb = spark.range(0, 12).select(F.col("id").alias("row_id"), F.array(F.lit(0.5).cast("float")).alias("embedding"))
    K.write_embeddings(emb.coalesce(1), f"{tmp_dir}/emb", per_file=5)
    assert len(glob.glob(f"{tmp_dir}/emb/part-*.parquet")) == 3


def test_corpus_and_vocabulary(spark, tmp_dir):
    t = spark.createDataFrame([("a b\nc",), ("d",)], "text string")
    K.write_corpus(t, f"{tmp_dir}/corpus")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/corpus").collect()) == ["a b c", "d"]
    v = spark.createDataFrame([("a", 0)], "token string, id int")
    m = spark.createDataFrame([(0, "a", "b", 3)], "rank int, left string, right string, freq long")
    K.write_vocabulary(v, m, f"{tmp_dir}/vocab")
    assert spark.read.parquet(f"{tmp_dir}/vocab/merges").first().freq == 3
