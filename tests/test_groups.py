"""Places and lists in groups of any size; sketches; tree listing; image files; corpus lines; bounded state."""

import datetime as dt
import glob
import os
import random
from collections import defaultdict

import numpy as np
import pytest
from fixtures import write
from pyspark.sql import functions as F

from capset.operators import labels as L
from capset.operators import pairs as P
from capset.operators.groups import chunked_lists, positions_in_group
from capset.operators.pixels import _area_resize
from capset.session import ensure_checkpoint_dir
from capset.sources import files as FS
from capset.sources import images as IM
from capset.sources import manifests as M
from capset.sources.listing import list_tree, scan_tree
from capset.streaming import ingest as ST


def hot_rows(n=3000):
    rng = random.Random(4)
    # one key holds a third of the rows, some have no key
    return [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randint(0, 40)}", rng.randint(0, 500), i) for i in range(n)]


def test_positions_over_many_ranges(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "key string, o int, id long").repartition(5)
    got = positions_in_group(df, "key", ["o", "id"]).collect()
    want = {}
    groups = defaultdict(list)
    for k, o, i in rows:
        groups[k].append((o, i))
    for members in groups.values():
        want |= {i: n for n, (_, i) in enumerate(sorted(members))}
    assert {r.id: r.position for r in got} == want and len(got) == len(rows)


def test_a_hot_group_is_spread_over_tasks(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        df = spark.createDataFrame(hot_rows(), "key string, o int, id long").repartition(5)
        positions_in_group(df, "key", ["id"])
        # the written ranges: the hot key is in several files
        written = max(glob.glob(os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "groups-*")), key=os.path.getmtime)
        assert spark.read.parquet(written).where("key = 'hot'").select(F.input_file_name()).distinct().count() >= 3
        lists = chunked_lists(df, "key", "id", ["id"], 100)
        assert lists.where("key = 'hot'").count() == 10 and lists.agg(F.max("n")).first()[0] == 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_lists_hold_all_values_in_order(spark):
    rows = hot_rows(700) + [("null", None, 9000), ("null", 1, 9001)]
    df = spark.createDataFrame(rows, "key string, o int, id long")
    got = defaultdict(list)
    for r in chunked_lists(df, "key", "o", ["id"], 7).orderBy("key", "part").collect():
        assert r.n == len(r["list"]) <= 7
        got[r.key] += r["list"]
    want = defaultdict(list)
    for k, o, i in sorted(rows, key=lambda r: r[2]):
        want[k].append(o)
    assert got == want
    assert chunked_lists(df.limit(0), "key", "o", ["id"]).collect() == []


def test_label_rows_and_faults_in_parts(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("a", "x", 3), ("b", "z", 0)], "image_id string, label string, order int")
    assert [tuple(r) for r in L.label_row_parts(df, size=2).orderBy("image_id", "part").collect()] == [
        ("a", 0, 2, ["y", "x"]), ("a", 1, 1, ["x"]), ("b", 0, 1, ["z"])]
    files = spark.createDataFrame([(f, f"s{i}", "txt", f"/{f}/s{i}.txt", f"s{i}.txt", 3, None) for f in "pq" for i in range(5)],
                                  "folder string, stem string, ext string, path string, name string, text_len long, valid boolean")
    got = P.fault_report_parts(files, size=3).where("kind = 'incomplete'").orderBy("folder", "part").collect()
    assert [(r.folder, r.part, r.n, r.files) for r in got] == [
        (f, p, n, names) for f in "pq" for p, n, names in [(0, 3, ["s0.txt", "s1.txt", "s2.txt"]), (1, 2, ["s3.txt", "s4.txt"])]]


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("image_id"), (F.col("id") % 5).alias("part"))
    sketches = L.image_sketches(df, ["part"])
    assert sketches.count() == 5
    about = L.count_sketched(sketches, []).first().about
    assert abs(about - 20_000) <= 20_000 * L.SKETCH_ERROR
    assert L.count_sketched(L.image_sketches(df.limit(0), ["part"]), []).first().about in (0, None)


def test_tree_listed_by_tasks_as_by_spark(spark, tmp_dir):
    root = os.path.join(tmp_dir, "root")
    names = ["a.txt", "b.PNG", "x/c.txt", "x/y/z/d.txt", "x/y/e.json", "_hidden/f.txt", "x/.g.txt", "w/um lauté.txt"]
    for n in names:
        write(os.path.join(root, n), n * 3)
    os.makedirs(os.path.join(root, "empty"))
    cols = ["path", "rel", "folder", "name", "stem", "ext", "length", "depth", "content"]
    for exts, depth in ((None, None), (["txt"], None), (["txt", "png"], 1)):
        mine = {tuple(r) for r in scan_tree(spark, root, exts, True, depth).select(cols).collect()}
        assert mine == {tuple(r) for r in FS.scan_files(spark, root, exts, True, depth).select(cols).collect()}
    assert [r.path for r in list_tree(spark, os.path.join(root, "a.txt")).collect()] == [os.path.join(root, "a.txt")]
    assert scan_tree(spark, os.path.join(root, "empty")).collect() == []
    with pytest.raises(FileNotFoundError):
        list_tree(spark, os.path.join(root, "none"))


def test_images_written_and_read(spark, tmp_dir):
    rng = np.random.default_rng(1)
    rows = [(f"d/{w}x{h}.{e}", e, w, h, rng.integers(0, 256, 3 * w * h, np.uint8).tobytes()) for e in ("bmp", "png") for w, h in ((1, 1), (3, 2), (40, 17))]
    df = spark.createDataFrame([*rows, ("d/none.png", "png", 2, 2, b"short")], "name string, ext string, w int, h int, data binary")
    log = IM.write_files(df.withColumn("content", IM.encoded(F.col("ext"), F.col("w"), F.col("h"), F.col("data"))), tmp_dir)
    assert log.count() == 6
    got = spark.read.format("image").load(os.path.join(tmp_dir, "d")).select("image.*").collect()
    assert {(os.path.basename(r.origin), r.width, r.height, bytes(r.data)) for r in got} == {(n[2:], w, h, d) for n, _, w, h, d in rows}


@pytest.mark.parametrize("seed", range(4))
def test_resampling_weighs_pixels_by_area(seed):
    rng = np.random.default_rng(seed)
    h, w, nh, nw = rng.integers(1, 12, 4)
    img = rng.integers(0, 256, (h, w, 3)).astype(np.uint8)
    want = np.zeros((nh, nw, 3))
    for y in range(nh):
        for x in range(nw):
            for py in range(h):
                for px in range(w):
                    a = max(0, min((y + 1) * h / nh, py + 1) - max(y * h / nh, py))
                    b = max(0, min((x + 1) * w / nw, px + 1) - max(x * w / nw, px))
                    want[y, x] += a * b * img[py, px]
    want = np.rint(np.round(want * nh * nw / (h * w), 6))
    assert (_area_resize(img, int(nh), int(nw)) == want).all()


def test_corpus_lines(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.txt"), "one\ntwo\n\nthree")
    write(os.path.join(tmp_dir, "deep", "b.txt"), "four")
    write(os.path.join(tmp_dir, "c.csv"), "no")
    got = M.read_corpus_lines(spark, tmp_dir).collect()
    assert sorted(r.text for r in got) == ["", "four", "one", "three", "two"]
    first = sorted((r.place, r.text) for r in got if r.path.endswith("a.txt"))
    assert [t for _, t in first] == ["one", "two", "", "three"]


def test_state_of_watermarked_dedup_falls_and_late_rows_go(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    day = dt.datetime(2024, 1, 1)
    states, plain = [], []
    for run in range(5):
        rows = [(day + dt.timedelta(days=run, minutes=i), f"{run}-{i}") for i in range(100)]
        again = [(t + dt.timedelta(seconds=30), k) for t, k in rows]  # delivered twice
        late = [(day, f"late {run}")] if run > 1 else []
        spark.createDataFrame(rows + again + late, "ts timestamp, k string").coalesce(1).write.mode("append").parquet(src)
        for marks, bound, name in ((states, ("ts", "1 day"), "marked"), (plain, None, "plain")):
            q = ST.dedup_increment(spark, src, "ts timestamp, k string", "k", f"{out}/{name}", f"{ck}/{name}", bound, fmt="parquet")
            marks.append(ST.state_rows(q)[-1])
    kept = [r.k for r in spark.read.parquet(f"{out}/marked").collect()]
    assert sorted(kept) == sorted(f"{run}-{i}" for run in range(5) for i in range(100))
    assert spark.read.parquet(f"{out}/plain").count() == 503
    assert plain == [100, 200, 301, 402, 503] and max(states) <= 300 and states[-1] < plain[-1]
