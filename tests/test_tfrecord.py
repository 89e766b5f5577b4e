"""tfrecord data source with generated records."""

import os

import pytest
from fixtures import example, framed, records, write

from capset.sources import tfrecord as TF

DDL = "sampleID string, image binary, format string, label string, height bigint, width bigint"


def rows(n):
    return [{"sampleID": f"s{i:02d}".encode(), "image": bytes([i]) * 5, "format": b"jpeg", "label": b"cat",
             "height": 100 + i, "width": 200 - i} for i in range(n)]


def reader(spark, ddl=DDL, **options):
    TF.register(spark)
    return spark.read.format("tfrecord").schema(ddl).options(**options)


def test_checksums_of_the_standard():
    assert TF.crc32c(b"123456789") == 0xE3069283
    assert TF.crc32c(b"\0" * 32) == 0x8A9136AA and TF.crc32c(b"") == 0
    long = bytes(range(256)) * 40
    assert TF.crc32c(long) == _plain(long) and TF.crc32c(long[:4099]) == _plain(long[:4099])


def _plain(data):
    state = 0xFFFFFFFF
    for b in data:
        state ^= b
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_read_with_schema_and_inferred(spark, tmp_dir):
    records(os.path.join(tmp_dir, "a.tfrecord"), rows(20)[:10])
    records(os.path.join(tmp_dir, "b.tfrecord"), rows(20)[10:])
    got = sorted(reader(spark).load(tmp_dir).collect(), key=lambda r: r.sampleID)
    assert len(got) == 20
    assert (bytes(got[3].image), got[3].height, got[3].width, got[3].format) == (bytes([3]) * 5, 103, 197, "jpeg")
    inferred = spark.read.format("tfrecord").load(tmp_dir)
    assert dict(inferred.dtypes) == {"sampleID": "binary", "image": "binary", "format": "binary",
                                     "label": "binary", "height": "bigint", "width": "bigint"}


def damaged(where):
    frames = [framed(example(r)) for r in rows(6)]
    if where == "length":
        frames[2] = b"\xff" * 8 + frames[2][8:]
    elif where == "data":
        frames[2] = frames[2][:30] + b"?" + frames[2][31:]
    elif where == "tail":
        frames[5] = frames[5][:-7]
    return b"".join(frames)


@pytest.mark.parametrize(("where", "good", "rest"), [("length", 2, True), ("data", 5, False), ("tail", 5, True)])
def test_damage_is_never_silent(spark, tmp_dir, where, good, rest):
    write(os.path.join(tmp_dir, "a.tfrecord"), damaged(where))
    with pytest.raises(Exception, match="checksum|truncated|beyond"):
        reader(spark).load(tmp_dir).collect()
    if rest:
        with pytest.raises(Exception, match="checksum|truncated|beyond"):
            reader(spark, mode="DROPMALFORMED").load(tmp_dir).collect()
    else:
        assert reader(spark, mode="DROPMALFORMED").load(tmp_dir).count() == good
    got = reader(spark, DDL + ", _corrupt string, _index bigint", mode="PERMISSIVE").load(tmp_dir).collect()
    assert sum(r._corrupt is None for r in got) == good and sum(r._corrupt is not None for r in got) == 1
    assert [r._index for r in got if r._corrupt is None] == list(range(good))
    assert all(r.sampleID is None and ("rest of the file" in r._corrupt) == rest for r in got if r._corrupt)


def test_schema_comes_from_the_first_readable_record(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.tfrecord"), b"\xff" * 40)
    records(os.path.join(tmp_dir, "b.tfrecord"), rows(1))
    assert TF.infer_schema(tmp_dir).fieldNames() == ["sampleID", "image", "format", "label", "height", "width"]
    with pytest.raises(ValueError):
        TF.infer_schema(os.path.join(tmp_dir, "a.tfrecord"))


def test_float_and_lists():
    ex = TF.parse_example(example({"f": [0.5, 1.5], "n": [-3, 4], "b": [b"x", b"y"]}))
    assert ex == {"f": ("float", [0.5, 1.5]), "n": ("int64", [-3, 4]), "b": ("bytes", [b"x", b"y"])}
    assert set(TF.parse_example(example({"f": 0.5, "n": 1}), {"n"})) == {"n"}
