"""Manifest, annotation, dictionary, narrative and caption-map readers (FIXTURES F1-F8)."""

import gzip
import os

from pyspark.sql import functions as F

from capset.sources import manifests as M
from fixtures import write


def test_two_column_tsv_with_quotes(spark, tmp_dir):
    # as pandas: quotes are special only around a whole field; doubled quotes inside one unescape
    write(f"{tmp_dir}/m.tsv", 'http://a/1.jpg\tsays ""hi"" there\nhttp://a/2.jpg\t\n"http://a/3.jpg"\t"quoted ""x"" y"\n')
    df = M.read_manifest(spark, f"{tmp_dir}/m.tsv").orderBy("row_id").collect()
    assert [(r.row_id, r.url) for r in df] == [(0, "http://a/1.jpg"), (1, "http://a/2.jpg"), (2, "http://a/3.jpg")]
    assert df[0].caption == 'says ""hi"" there'
    assert df[2].caption == 'quoted "x" y'
    assert df[1].caption is None
    other = M.read_manifest(spark, f"{tmp_dir}/m.tsv", columns=("caption", "url")).orderBy("row_id").first()
    assert other.caption == "http://a/1.jpg"


def test_pipe_manifest_keeps_columns(spark, tmp_dir):
    write(f"{tmp_dir}/y.csv", "id|final_caption|url|extra\n1|a cap|http://x/1|z\n2|b cap|http://x/2|z\n")
    df = M.read_manifest(spark, f"{tmp_dir}/y.csv", sep="|", header=True, keep=["final_caption", "url"])
    assert df.columns == ["final_caption", "url", "row_id"]
    assert df.count() == 2


def test_wide_manifest_short_and_long_rows(spark, tmp_dir):
    names = [c.split()[0] for c in M.WIDE_MANIFEST_DDL.split(", ")]
    good = ["en", "p", "http://i/a.SVG", "t", "s", "h", "ref &amp; more", "attr", "alt", "image/svg",
            "100", "200", "true", "false", "x", "ctx", "sec"]
    long_row = good + ["EXTRA"]
    short_row = good[:5]
    lines = ["\t".join(names), "\t".join(good), "\t".join(long_row), "\t".join(short_row)]
    path = f"{tmp_dir}/w.tsv.gz"
    os.makedirs(tmp_dir, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")
    df = M.read_wide_manifest(spark, path).orderBy("row_id").collect()
    assert [r.row_id for r in df] == [0, 2]  # the long row (id 1) is dropped, ids stay positional
    assert df[0].original_height == 100 and df[0].is_main_image is True
    assert df[1].caption_reference_description is None


def test_dictionary_and_annotations(spark, tmp_dir):
    write(f"{tmp_dir}/dict.csv", '/m/01,Cat\n\n/m/02,"Table, dining"\n')
    d = {r.code: r.name for r in M.read_dictionary(spark, f"{tmp_dir}/dict.csv").collect()}
    assert d == {"/m/01": "Cat", "/m/02": "Table, dining"}
    write(f"{tmp_dir}/val.csv", "ImageID,LabelName,Confidence\nimg1,/m/01,1\nimg1,/m/02,0\n")
    write(f"{tmp_dir}/train.csv", "ImageID,LabelName,Confidence\nimg2,/m/03,1\n")
    ann = M.read_annotations(spark, {"validation": f"{tmp_dir}/val.csv", "train": f"{tmp_dir}/train.csv"})
    assert sorted((r.split, r.ImageID, r.order) for r in ann.collect()) == [
        ("train", "img2", 0), ("validation", "img1", 0), ("validation", "img1", 1)]


def test_narratives_and_caption_map(spark, tmp_dir):
    write(f"{tmp_dir}/n1.jsonl", '{"image_id": "a", "caption": "first"}\n{"image_id": "a", "caption": "second"}\n')
    write(f"{tmp_dir}/n2.jsonl", '{"image_id": "b", "caption": "third", "other": 1}\n')
    n = M.read_narratives(spark, [f"{tmp_dir}/n1.jsonl", f"{tmp_dir}/n2.jsonl"])
    assert n.columns == ["image_id", "narrative"] and n.count() == 3
    write(f"{tmp_dir}/caps.json", '{"labels_x1": {"path": "p/x1.jpg", "caption": "c1"}, '
                                  '"labels_x2": {"path": "p/x2.jpg", "caption": "c2"}}')
    m = sorted((r.image_id, r.path, r.caption) for r in M.read_caption_map(spark, f"{tmp_dir}/caps.json").collect())
    assert m == [("x1", "p/x1.jpg", "c1"), ("x2", "p/x2.jpg", "c2")]


def test_corpus_and_inputs(spark, tmp_dir):
    write(f"{tmp_dir}/c/a.txt", "one\ntwo")
    write(f"{tmp_dir}/c/sub/b.txt", "three")
    write(f"{tmp_dir}/c/sub/skip.json", "{}")
    c = M.read_corpus(spark, f"{tmp_dir}/c")
    assert sorted(r.text for r in c.collect()) == ["one\ntwo", "three"]
    write(f"{tmp_dir}/in/x-00000-of-00010.tsv.gz", b"x")
    write(f"{tmp_dir}/in/x-1percent.tsv.gz", b"x")
    write(f"{tmp_dir}/in/.hidden.tsv.gz", b"x")
    files = [r.file for r in M.list_inputs(spark, f"{tmp_dir}/in", exclude_substring="1percent").collect()]
    assert files == ["x-00000-of-00010.tsv.gz"]
