import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from capset.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def remainder(a, b):
    return a - b * int(a / b)


def expected(rows, fork=True):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if fork else 0
        built[c] = tuple(own.get(c - remainder(c, 20), [])[:h] + turns[h:]) if fork else tuple(turns)
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        w = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += w
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == p))).encode()).hexdigest()) for p, m in members.items())


def got_of(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def trie(df, **more):
    c = F.col("conv")
    return T.prefix_trie(df, c - c % 20, F.crc32(c.cast("string").cast("binary")) % 4, **more)


def some(rng, convs, turns):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["Yes yes.", "No", "", None, " a  b\tc "])))
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_range_minimum(seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-1, 5, rng.integers(0, 40))
    m = T.RangeMinimum(v)
    at, least = np.repeat(np.arange(len(v)), 6), np.tile(np.arange(6), len(v))
    for step in (1, -1):
        for a, x, got in zip(at, least, m.reach(at, least, step), strict=True):
            line = v[a:] if step > 0 else v[a::-1]
            want = next((i for i, y in enumerate(line) if y < x), len(line))
            assert got == want
    for a in range(len(v)):
        b = np.arange(a, len(v))
        assert (m.least(np.full(len(b), a), b) == [v[a:e + 1].min() for e in b]).all()


@pytest.mark.parametrize(("bits", "cut"), [(10, 256), (1, 2), (2, 3), (0, 1)])
def test_against_prefix_lists(spark, bits, cut):
    # with small blocks and slices everything is open and cut
    rng = random.Random(bits)
    rows = some(rng, [*range(60), -7, -20, 2**60, 10**6], 7)
    rows += [(None, 1, "user", "lost"), (200, None, "user", "first"), (200, 3, "user", "second")]
    rows += [(300 + n, t, "user", f"copy {t}") for n in range(40) for t in range(5)]  # copies, but for what they borrow
    assert got_of(trie(frame(spark, rows, SCHEMA), bits=bits, cut=cut)) == expected(rows)


def test_copies_over_many_blocks_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(100) for t in range(20)]
    rows += [(1000, t, "user", f"turn {t}") for t in range(700)] + [(1001, t, "user", f"turn {t % 650}") for t in range(690)]
    assert got_of(T.prefix_trie(frame(spark, rows, SCHEMA), bits=3, cut=16)) == expected(rows, fork=False)


def test_intervals_and_empty_table(spark):
    assert trie(frame(spark, [], SCHEMA)).collect() == []
    rows = [(1, 0, "user", "a b"), (2, 0, "user", "a b"), (2, 1, "assistant", "c"), (3, 0, "user", "z")]
    got = T.prefix_trie(frame(spark, rows, SCHEMA)).collect()
    assert len(got) == 4
    root = next(r for r in got if r.depth == 0)
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens, root.parent_conv_id) == (3, 2, 2, 2, None)
    assert all(root["first"] <= r["first"] <= r["last"] <= root["last"] for r in got)


def test_long_texts_and_repeated_rows(spark):
    rows = [(5, 0, "user", "w " * 200_000), (6, 0, "user", "w " * 200_000), (6, 1, "user", "x"), (6, 1, "user", "x")]
    assert got_of(T.prefix_trie(frame(spark, rows, SCHEMA))) == expected(rows, fork=False)
