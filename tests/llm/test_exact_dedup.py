import hashlib

import pytest
from helpers import LONG, frame, normal

from capset.llm.exact_dedup import drop_exact_copies, exact_groups
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = ["a  b", "a b", "a\t\nb", None, "", " ", "a\u00a0b", LONG, LONG, "x", "A b"] + ["hot"] * 200


def rows():
    return [(i, t, "en", None, None) for i, t in enumerate(TEXTS, 10)]


def brute(docs):
    groups = {}
    for i, t, *_ in docs:
        groups.setdefault(normal(t), []).append(i)
    return sorted((i, min(g), len(g), i == min(g), hashlib.sha256(normal(t).encode()).hexdigest())
                  for i, t, *_ in docs for g in [groups[normal(t)]])


def test_against_brute_force(spark):
    got = exact_groups(frame(spark, rows(), DOC))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows())


def test_equal_digests_of_different_texts_stay_apart(spark):
    """Whole texts are compared: a digest of one character joins nothing that differs."""
    docs = rows()
    got = exact_groups(frame(spark, docs, DOC), digest=lambda t: F.substring(F.sha2(F.encode(t, "UTF-8"), 256), 1, 1))
    assert sorted((r[0], r[1], r[2], r[3]) for r in got.collect()) == [x[:4] for x in brute(docs)]


def test_empty_table(spark):
    assert exact_groups(frame(spark, [], DOC)).collect() == []
    assert drop_exact_copies(frame(spark, [], DOC)).collect() == []


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "b"), (3, "c"), (3, "d"), (2, "d")]
    got = sorted(map(tuple, exact_groups(frame(spark, docs, "doc_id long, text string")).select(
        "doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == sorted([(1, 1, 4, True), (1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False), (None, None, 1, True),
                          (3, 3, 1, True), (3, 2, 2, False), (2, 2, 2, True)], key=str)
    left = drop_exact_copies(frame(spark, docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, "a"), (None, "b"), (3, "c"), (2, "d")], key=str)


@pytest.mark.parametrize("n", [1, 7])
def test_dropping_keeps_all_columns(spark, n):
    df = frame(spark, rows()[:n], DOC)
    left = drop_exact_copies(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(x[0] for x in brute(rows()[:n]) if x[3])
