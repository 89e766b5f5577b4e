"""Labels, dedup (with a hot hash), scoring, resume and set operators on inline data."""

import math

from pyspark.sql import functions as F

from capset.operators import dedup as D
from capset.operators import labels as L
from capset.operators import resume as RS
from capset.operators import scoring as SC


def test_labels_per_image_and_names(spark):
    ann = spark.createDataFrame(
        [("i1", "/m/a", 1.0, 0), ("i1", "/m/b", 0.0, 1), ("i1", "/m/a", 1.0, 2), ("i1", "/m/c", 1.0, 3),
         ("i2", "/m/b", 0.0, 4), ("i3", "/m/zz", 1.0, 5)],
        "image_id string, label string, confidence double, order long")
    d = spark.createDataFrame([("/m/a", "Cat"), ("/m/b", "Dog"), ("/m/c", "Table, dining")], "code string, name string")
    per = {r.image_id: r for r in L.flag_dropped(L.labels_per_image(ann, dictionary=d)).collect()}
    assert per["i1"].certain_labels == ["Cat", "Table, dining"] and per["i1"].uncertain_labels == ["Dog"]
    assert sorted(per["i1"].certain_counts) == [1, 2] and per["i1"].uncertain_counts == [1]
    every = {r.image_id: r for r in L.labels_per_image(ann, dictionary=d, repeats=True).collect()}
    assert len(every["i1"].certain_labels) == 3 and set(every["i1"].certain_labels) == {"Cat", "Table, dining"}
    assert per["i1"].n_certain == 3 and per["i1"].n_uncertain == 1
    assert per["i2"].dropped and not per["i1"].dropped
    assert per["i3"].n_unknown == 1 and per["i3"].certain_labels == ["/m/zz"]
    caps = {r.image_id: r for r in L.render_captions(
        L.flag_dropped(L.labels_per_image(ann, dictionary=d)), ["of {certain}", "{certain} here"], [", or {maybe}"], seed=3).collect()}
    assert "cat, table, dining" in caps["i1"].caption
    assert caps["i1"].caption == caps["i1"].caption.lower()
    assert not caps["i3"].used_maybe  # strict: no maybe branch without uncertain labels
    rep = {r.split: (r.num_samples, r.dropped) for r in
           L.split_report(L.flag_dropped(L.labels_per_image(ann)).withColumn("split", F.lit("val"))).collect()}
    assert rep == {"val": (3, 1), "total": (3, 1)}


def test_override_and_last_wins(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, caption string")
    narr = spark.createDataFrame([(1, "n1", 0), (1, "n1b", 1), (3, "n3", 0)], "id long, narrative string, t long")
    out = sorted((r.id, r.caption, r.from_narrative) for r in L.override_captions(docs, narr, "id", order="t").collect())
    assert out == [(1, "n1", True), (1, "n1b", True), (2, "b", False), (3, "n3", True)]
    last = sorted((r.id, r.caption) for r in L.override_captions(docs, narr, "id", dedupe="last", order="t").collect())
    assert last == [(1, "n1b"), (2, "b"), (3, "n3")]
    a = spark.createDataFrame([("k1", "val"), ("k2", "val")], "key string, v string")
    b = spark.createDataFrame([("k1", "train")], "key string, v string")
    c = spark.createDataFrame([("k2", "test"), ("k3", "test")], "key string, v string")
    got = sorted((r.key, r.v) for r in L.last_wins_union([a, b, c], "key").collect())
    assert got == [("k1", "train"), ("k2", "test"), ("k3", "test")]


def test_dedup_hot_hash_keeps_first(spark):
    # one content value holds a third of all rows
    n = 3000
    rows = [(i, "HOT" if i % 3 == 1 else f"u{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, content string").repartition(8)
    kept = D.dedup_content(df, "content", order="row_id")
    ids = sorted(r.row_id for r in kept.collect())
    assert ids == sorted([i for i in range(n) if i % 3 != 1] + [1])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no per-hash window: the hot group is never put in one task
    flagged = D.flag_duplicates(df.withColumn("md5", F.md5("content")), "md5", "row_id")
    assert flagged.where("is_duplicate").count() == n // 3 - 1


def test_run_report_order_of_rules(spark):
    df = spark.createDataFrame([(0, "x", 100, 100), (1, "x", 400, 400), (2, "y", 500, 100), (3, "z", 200, 200)],
                               "row_id long, h string, width int, height int")
    rep = D.run_report(D.apply_size_rule(D.flag_duplicates(df, "h", "row_id"))).first()
    # row 1 duplicates row 0, which is discarded: the copy is counted as duplicate, not resized
    assert (rep.total, rep.duplicates, rep.discarded, rep.to_resize, rep.remaining) == (4, 1, 1, 1, 2)
    sized = {r.row_id: (r.action, r.new_width, r.new_height)
             for r in D.apply_size_rule(df, min_side=192, max_side=320).collect()}
    assert sized[2] == ("resize", int(500 * 3.2), 320)


def test_scoring(spark):
    img = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "image_id long, image_vec array<float>")
    cand = spark.createDataFrame([(1, 0, "a", [1.0, 0.0]), (1, 1, "b", [0.0, 1.0]), (1, 2, "c", [1.0, 0.0]),
                                  (2, 0, "a", [1.0, 1.0])],
                                 "image_id long, field_idx int, field string, text_vec array<float>")
    s = SC.score(img, cand, "image_id")
    best = {r.image_id: (r.best_field, r.best_score) for r in SC.best_caption(s, "image_id", threshold=0.3).collect()}
    assert best == {1: ("a", 1.0), 2: ("a", 0.0)}  # tie a/c -> earlier field; zero vector -> 0
    probs = {(r.image_id, r.field): r.prob for r in SC.softmax(s, "image_id", scale=1.0).collect()}
    e = [math.exp(1), math.exp(0), math.exp(1)]
    assert abs(probs[(1, "b")] - e[1] / sum(e)) < 1e-9
    wide = SC.scores_wide(s, "image_id").where("image_id = 1").first()
    assert (wide.section_title, wide.caption_reference_description) == (None, None)
    long = SC.candidates(spark.createDataFrame([(7, "t1", None, "t3")], "id long, f1 string, f2 string, f3 string"),
                         "id", ["f1", "f2", "f3"])
    assert [(r.field_idx, r.field) for r in long.collect()] == [(0, "f1"), (2, "f3")]


def test_resume(spark):
    m = spark.range(0, 10).withColumnRenamed("id", "row_id")
    ledger = spark.createDataFrame([(1, "fetch", "done", None, 1), (2, "fetch", "failed", "timeout", 3),
                                    (3, "fetch", "failed", "timeout", 1), (1, "fetch", "done", None, 1)],
                                   RS.LEDGER_SCHEMA)
    skip = RS.done_and_failed(ledger)
    assert sorted(r.row_id for r in RS.pending(m, skip).collect()) == [0, 4, 5, 6, 7, 8, 9]
    retry = RS.done_and_failed(ledger, retry_failed=True, max_attempts=3)
    assert sorted(r.row_id for r in RS.pending(m, retry).collect()) == [0, 3, 4, 5, 6, 7, 8, 9]
    p = RS.progress(m, skip).first()
    assert (p.total, p.done, p.remaining, p.percent_done) == (10, 3, 7, 30.0)
    files = spark.createDataFrame([("a/00000012.txt",), ("a/00000012.jpg",), ("b/x.txt",)], "path string")
    assert [r.row_id for r in RS.ids_from_files(files).collect()] == [12]


def test_top_k_hot_group_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{i % 40}", rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "grp string, score int, idx int").repartition(8)
    got = sorted((r.grp, r.idx, r.rank) for r in SC.top_k(df, "grp", "score", k=3, tie="idx", salts=8).collect())
    expect = []
    for g in {r[0] for r in rows}:
        ranked = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))[:3]
        expect += [(g, r[2], i + 1) for i, r in enumerate(ranked)]
    assert got == sorted(expect)
