"""Small helpers that the other suites do not reach."""

from pyspark.sql import functions as F

from capset.functions import ids as I
from capset.functions import vectors as VC
from capset.operators import labels as L
from capset.operators import ordering as O
from capset.operators import resume as RS
from capset.operators import samples as SM
from capset.sources import files as FS
from fixtures import write


def test_group_tag_and_media_kind(spark):
    names = ["wit_v1.train.all-1percent_sample.tsv.gz", "wit_v1.train.all-00003-of-00010.tsv.gz", "other.tsv.gz"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r.t for r in df.select(I.group_tag("f").alias("t")).collect()] == ["onepercent", "main00003", "other"]
    u = spark.createDataFrame([("http://x/A.SVG",), ("http://x/b.jpg",)], "u string")
    assert [r.k for r in u.select(I.media_kind("u").alias("k")).collect()] == ["svg", "raster"]
    assert [r.s for r in u.select(I.is_svg("u", ignore_case=False).alias("s")).collect()] == [False, False]


def test_orderings(spark):
    df = spark.range(0, 200).repartition(5)
    a = [r.id for r in O.fast_shuffle(df, "id", seed=1).collect()]
    b = [r.id for r in O.fast_shuffle(df, "id", seed=1).collect()]
    assert a == b and sorted(a) == list(range(200)) and a != list(range(200))
    parts = O.sorted_within(df, "id").rdd.glom().collect()
    assert all(p == sorted(p) for p in ([r.id for r in part] for part in parts))
    assert [r.id for r in df.orderBy(F.col("id").desc()).limit(3).collect()] == [199, 198, 197]


def test_counts_inputs_and_folders(spark, tmp_dir):
    ann = spark.createDataFrame([("a",), ("a",), ("b",)], "image_id string")
    assert L.count_images(ann).first().n_images == 2
    assert L.count_images(ann, approx=True).first().n_images == 2
    exp = spark.createDataFrame([("f1",), ("f2",)], "file string")
    got = spark.createDataFrame([("f2",)], "file string")
    assert [r.file for r in RS.missing_inputs(exp, got).collect()] == ["f1"]
    write(f"{tmp_dir}/t/a/x.txt", "x")
    write(f"{tmp_dir}/t/b/y.png", b"y")
    files = FS.scan_files(spark, f"{tmp_dir}/t")
    assert [r.folder for r in FS.folders_with_text(files).collect()] == ["a"]
    assert FS.scan_files(spark, f"{tmp_dir}/t", depth=0).count() == 0


def test_timed_and_logit(spark):
    out, secs = SM.timed(lambda: spark.range(10).count())
    assert out == 10 and secs >= 0
    v = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0])], "a array<float>, b array<float>")
    r = v.select(VC.logit("a", "b", 100.0).alias("l"), VC.norm("a").alias("n"), VC.dot("a", "b").alias("d")).first()
    assert abs(r.l - 100.0) < 1e-9 and r.n == 5.0 and r.d == 25.0


def test_label_name_modes_and_file_flags(spark):
    import pytest

    from capset.sinks import check_bounds

    per = spark.createDataFrame([("i1", "/m/a"), ("i2", "/m/zz")], "image_id string, code string")
    d = spark.createDataFrame([("/m/a", "Cat")], "code string, name string")
    assert [r.image_id for r in L.with_label_names(per, d, on_unknown="drop").collect()] == ["i1"]
    with pytest.raises(KeyError):
        L.with_label_names(per, d, on_unknown="error")
    imgs = spark.createDataFrame([("i1", ["Cat"], "p/i1.jpg"), ("i2", ["Dog"], "p/i2.jpg")],
                                 "image_id string, certain_labels array<string>, path string")
    files = spark.createDataFrame([("p/i1.jpg",)], "path string")
    flags = {r.image_id: r.dropped for r in L.flag_dropped(imgs, files).collect()}
    assert flags == {"i1": False, "i2": True}
    with pytest.raises(ValueError):
        L.override_captions(per, per, on="image_id", dedupe="last")
    with pytest.raises(ValueError):
        check_bounds(1e9, 1e6)
    check_bounds(1e9, 100000)


def test_expected_counts_precounted_and_retry_all(spark):
    processed = spark.createDataFrame([("f1", "en"), ("f1", "de")], "file string, lang string")
    expected = spark.createDataFrame([("f1", 3, 2), ("f2", 1, 1)], "file string, expected_rows long, expected_en long")
    got = {r.file: (r.rows, r.rows_en, r.missing_rows) for r in RS.expected_counts(processed, expected).collect()}
    assert got == {"f1": (2, 1, 1), "f2": (0, 0, 1)}
    ledger = spark.createDataFrame([(1, "s", "done", None, 1), (2, "s", "failed", "x", 9)], RS.LEDGER_SCHEMA)
    assert [r.row_id for r in RS.done_and_failed(ledger, retry_failed=True).collect()] == [1]
    assert sorted(r.row_id for r in RS.done_and_failed(ledger, stage="s").collect()) == [1, 2]
    assert RS.done_and_failed(ledger, stage="other").count() == 0
