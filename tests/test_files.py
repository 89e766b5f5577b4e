"""File-tree scans, image validity, pairs, fault report and sidecars on a generated tree."""

import os

import pytest
from pyspark.sql import functions as F

from capset.operators import pairs as P
from capset.sources import files as FS
from fixtures import pair_tree


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    return pair_tree(str(tmp_path_factory.mktemp("tree")))


def test_scan_and_profiles(spark, tree):
    files = FS.scan_files(spark, tree, exts=["txt", "png", "bmp", "jpeg"])
    assert files.count() == 12
    r = {x.rel: (x.folder, x.stem, x.ext) for x in files.collect()}
    assert r["w00001/000000004.jpeg"] == ("w00001", "000000004", "jpeg")
    prof = {os.path.basename(x.path): (x.width, x.height, x.valid) for x in FS.image_profiles(spark, tree).collect()}
    assert prof["000000001.bmp"] == (5, 2, True)
    assert prof["000000004.jpeg"][2] is False
    assert prof["000000005.png"][2] is False


def test_fault_report(spark, tree):
    ft = FS.file_tree(spark, tree)
    rep = {r.folder: r for r in P.fault_report(ft, 5).collect()}
    a, b = rep["w00000"], rep["w00001"]
    assert a.incomplete == ["000000002.txt", "000000003.png"]
    assert a.empty == ["000000001.txt"] and a.corrupt == []
    assert sorted(os.path.basename(p) for p in a.delete) == [
        "000000001.bmp", "000000001.txt", "000000002.txt", "000000003.png"]
    assert b.corrupt == ["000000004.jpeg", "000000005.png"] and b.incomplete == [] and b.empty == []
    assert len(b.delete) == 4
    counts = P.pair_counts(ft).first()
    assert (counts.texts, counts.images, counts.pairs, counts.incomplete, counts.corrupt) == (6, 6, 5, 2, 2)


def test_pairs_and_sidecars(spark, tree):
    files = FS.scan_files(spark, tree)
    images = P.by_extension(files, P.IMAGE_EXTS)
    texts = P.by_extension(files, ["txt"])
    pairs = P.pair(images, texts)
    assert sorted((r.folder, r.stem) for r in pairs.collect()) == [
        ("w00000", "000000000"), ("w00000", "000000001"), ("w00001", "000000000"),
        ("w00001", "000000004"), ("w00001", "000000005")]
    # scope='stem' restores the reference's keying by stem only
    assert P.pair(images, texts, scope="stem").count() == 4
    side = FS.scan_sidecars(spark, tree)
    j = {(r.folder, r.stem): (r.json, r.sidecar_corrupt)
         for r in P.with_sidecar(pairs, side.where(~F.col("corrupt")).select("folder", "stem", "json")).collect()}
    assert j[("w00000", "000000000")] == ('{"a":[1,2],"b":1}', False)
    assert j[("w00001", "000000000")] == (None, False)
    raw = spark.createDataFrame([("w00001", "000000004", '{"broken": ')], "folder string, stem string, json string")
    k = P.with_sidecar(pairs, raw).where("stem = '000000004'").first()
    assert k.json is None and k.sidecar_corrupt


def test_missing_sides_and_one_file_per_stem(spark, tree):
    files = FS.scan_files(spark, tree)
    ms = {(r.folder, r.stem): r.side for r in
          P.missing_sides(P.by_extension(files, P.IMAGE_EXTS), P.by_extension(files, ["txt"])).collect()}
    assert ms[("w00000", "000000002")] == "text_only" and ms[("w00000", "000000003")] == "image_only"
    dup = spark.createDataFrame([("f", "s", "png", "f/s.png"), ("f", "s", "bmp", "f/s.bmp"), ("f", "s", "jpg", "f/s.jpg")],
                                "folder string, stem string, ext string, path string")
    assert P.one_file_per_stem(dup).first().path == "f/s.bmp"


def test_delete_plan_lists_only(spark, tree):
    ft = FS.file_tree(spark, tree)
    plan = P.delete_plan(ft)
    assert plan.count() == 8
    assert all(os.path.exists(r.path) for r in plan.collect())  # nothing was deleted
