"""Sample mapping, image paths, score maps, generic captions, observed metrics, pixel resize."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capset.operators import filters as FL
from capset.operators import samples as SM
from capset.operators.pixels import _area_resize, resize_to_cover
from fixtures import png_bytes, write


def test_to_samples_and_keys(spark):
    df = spark.createDataFrame([("000000001", b"i", b"l")], "key string, image binary, label binary")
    enc = SM.to_samples(df, "image.pyd,label.cls", use_encoder=True)
    assert enc.columns == ["key", "image.pyd", "label.cls"]
    assert SM.to_samples(df, "image.pyd,label.cls").columns == ["key", "image", "label"]
    assert SM.image_text_keys("img,cap") == ("img", "cap")
    with pytest.raises(ValueError):
        SM.image_text_keys("a,b,c")


def test_image_path_and_filters(spark):
    df = spark.createDataFrame([("train", "abc"), ("validation", "x"), ("other", "y")], "split string, id string")
    got = [r.p for r in df.select(SM.image_path("split", "id").alias("p")).collect()]
    assert got[0].endswith("256px/train-256/abc.jpg") and got[1].endswith("256px/validation/x.jpg")
    assert got[2].endswith("256px/y.jpg")
    files = spark.createDataFrame([("a",), ("a",)], "path string")
    ex = FL.with_exists(spark.createDataFrame([("a",), ("b",)], "path string"), files)
    assert sorted((r.path, r.exists) for r in ex.collect()) == [("a", True), ("b", False)]
    t = spark.createDataFrame([(1, "en", "abc"), (2, "de", "long text")], "id int, language string, text string")
    assert [r.id for r in FL.short_texts(FL.filter_language(t, ["en", "de"]), 5).collect()] == [1]
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert [r.k for r in FL.common_keys(a, b, "k").collect()] == [2]
    assert [r.k for r in FL.only_in(a, b, "k").collect()] == [1]


def test_scores_map_and_generic_captions(spark):
    s = spark.createDataFrame([(1, "a", 0.123456), (1, "b", 0.5)], "image_id long, field string, score double")
    assert SM.scores_map(s, "image_id").first().scores == {"a": 0.1235, "b": 0.5}
    df = spark.createDataFrame([(1, ["Cat", "Dog"])], "image_id long, labels array<string>")
    out = SM.generate_captions(df, "pets", {"pets": ["a photo of {}", "{} here"]}).first()
    assert out.caption in ("a photo of cat, dog", "cat, dog here") and out.caption_key == "pets_1"
    with pytest.raises(ValueError):
        SM.generate_captions(df, "unknown", {"pets": ["{}"]})


def test_run_metrics_observe(spark):
    df = spark.range(10).withColumn("dup", F.col("id") < 3).withColumn("action", F.lit("keep"))
    observed, obs = SM.run_metrics(df, "r", duplicate="dup", action="action")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "duplicates": 3, "discarded": 0, "resized": 0}


def test_area_resize_numpy():
    img = np.arange(16, dtype=np.uint8).reshape(4, 4, 1).repeat(3, axis=2)
    out = _area_resize(img, 2, 2)
    assert out[0, 0, 0] == round((0 + 1 + 4 + 5) / 4)


def test_resize_to_cover(spark, tmp_dir):
    write(f"{tmp_dir}/img/a.png", png_bytes(4, 3, (200, 10, 10)))
    imgs = spark.read.format("image").load(f"{tmp_dir}/img")
    r = resize_to_cover(imgs, 8, 8).first()
    assert (r.width, r.height, r.nChannels) == (int(4 * (8 / 3)), 8, 3)
    px = np.frombuffer(r.data, dtype=np.uint8).reshape(r.height, r.width, 3)
    assert (px == np.array([10, 10, 200], dtype=np.uint8)).all()  # BGR order, colour kept
