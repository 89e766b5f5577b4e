"""Invariants on seeded random data (hypothesis): counts add up, bounds hold."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from capset.operators import dedup as D
from capset.operators import pairs as P
from capset.operators import rows as R

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30), st.sampled_from(["txt", "png", "jpg", "json"])),
                min_size=1, max_size=60))
def test_pairs_plus_incomplete_equals_stems(spark, files):
    rows = [(f"f{f}", f"s{s}", e, f"f{f}/s{s}.{e}") for f, s, e in set(files)]
    df = spark.createDataFrame(rows, "folder string, stem string, ext string, path string")
    c = P.pair_counts(df.withColumn("valid", df.ext.isin("png", "jpg"))).first()
    stems = len({(f, s) for f, s, _, _ in rows})
    assert c.pairs + c.incomplete == stems
    paired = {(f, s) for f, s, e, _ in rows if e == "txt"} & {(f, s) for f, s, e, _ in rows if e in ("png", "jpg")}
    assert c.pairs == len(paired)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(50, 500), st.integers(50, 500)), min_size=1, max_size=80))
def test_kept_plus_duplicates_plus_discarded_is_total(spark, items):
    rows = [(i, f"h{h}", w, ht) for i, (h, w, ht) in enumerate(items)]
    df = spark.createDataFrame(rows, "row_id long, h string, width int, height int")
    rep = D.run_report(D.apply_size_rule(D.flag_duplicates(df, "h", "row_id"), min_side=192, max_side=320)).first()
    assert rep.total == len(rows)
    assert rep.duplicates == len(rows) - len({h for _, h, _, _ in rows})
    assert rep.remaining + rep.duplicates + rep.discarded == rep.total
    firsts = {}
    for i, h, w, ht in rows:
        firsts.setdefault(h, (w, ht))
    assert rep.discarded == sum(1 for w, ht in firsts.values() if w < 192 and ht < 192)


@SETTINGS
@given(st.lists(st.integers(1, 400), min_size=1, max_size=300), st.integers(1, 50), st.integers(500, 5000))
def test_shard_bounds(spark, sizes, maxcount, maxsize):
    df = spark.createDataFrame(list(enumerate(sizes)), "row_id long, nbytes long")
    got = [r.shard for r in R.shard_numbers(df, "nbytes", maxsize, maxcount, block_rows=32).orderBy("row_id").collect()]
    assert got == sorted(got) and set(got) == set(range(max(got) + 1))
    assert max(Counter(got).values()) <= maxcount
    # bytes before each shard's last row stay below the next multiple of maxsize
    before, acc = [], 0
    for s in sizes:
        before.append(acc)
        acc += s
    for shard in set(got):
        idx = [i for i, g in enumerate(got) if g == shard]
        assert before[idx[-1]] // maxsize == before[idx[0]] // maxsize


@SETTINGS
@given(st.integers(1, 500), st.integers(1, 120))
def test_near_equal_parts_cover_all_rows(spark, n, size):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    parts = Counter(r.part for r in R.near_equal_parts(df, size).collect())
    k = max(1, n // size)
    assert sum(parts.values()) == n and sorted(parts) == list(range(1, k + 1))
    assert max(parts.values()) - min(parts.values()) <= 1
