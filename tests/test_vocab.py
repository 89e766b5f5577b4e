"""Vocabulary statistics against plain-Python counts; BPE against a plain-Python BPE."""

import random
from collections import Counter

from pyspark.sql import functions as F

from capset.operators import vocab as V

CORPUS = [
    "the cat sat on the mat",
    "the rat ate the cheese",
    "aaaa aaa aa a",
    "thethe there then theme",
    "a$b a$b c\\d c\\d (x) (x)",
    "über über ünter",
]


def py_bpe(word_freq: dict, n: int):
    words = {tuple(w): f for w, f in word_freq.items()}
    merges = []
    for rank in range(n):
        pairs = Counter()
        for syms, f in words.items():
            for a, b in zip(syms, syms[1:]):
                pairs[(a, b)] += f
        if not pairs:
            break
        (l, r), f = min(pairs.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1]))
        merges.append((rank, l, r, f))
        new = {}
        for syms, fr in words.items():
            out, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and syms[i] == l and syms[i + 1] == r:
                    out.append(l + r)
                    i += 2
                else:
                    out.append(syms[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + fr
        words = new
    return merges


def test_word_freq(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    got = {r.word: r.freq for r in V.word_freq(df).collect()}
    assert got == dict(Counter(w for t in CORPUS for w in t.split()))


def test_bpe_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    wf = V.word_freq(df)
    expect = py_bpe(dict(Counter(w for t in CORPUS for w in t.split())), 12)
    for per_round in (1, 3, 32):
        got = [tuple(r) for r in V.bpe_merges(wf, 12, merges_per_round=per_round, checkpoint_every=3).collect()]
        assert got == expect, per_round


def test_several_merges_a_round_change_nothing(spark):
    import random

    rng = random.Random(2)
    freq = Counter("".join(rng.choice("aabbcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(400))
    wf = spark.createDataFrame(list(freq.items()), "word string, freq long")
    assert [tuple(r) for r in V.bpe_merges(wf, 60).collect()] == py_bpe(dict(freq), 60)


def test_pieces_of_words_change_nothing(spark, monkeypatch):
    """Many merges a round, from few pairs and few pieces."""
    import random

    rng = random.Random(5)
    freq = Counter("".join(rng.choice("abc") for _ in range(rng.randint(2, 12))) for _ in range(300))
    wf = spark.createDataFrame(list(freq.items()), "word string, freq long")
    want = py_bpe(dict(freq), 150)
    assert [tuple(r) for r in V.bpe_merges(wf, 150, merges_per_round=512).collect()] == want
    monkeypatch.setattr(V, "CANDIDATES", 16)
    monkeypatch.setattr(V, "SEGMENTS", 40)
    assert [tuple(r) for r in V.bpe_merges(wf, 20, merges_per_round=512).collect()] == want[:20]
    assert indexed_bpe(dict(freq), 150) == want


def test_a_symbol_made_in_two_ways_ends_the_round():
    assert V.certain_merges([(("a", "bc"), 9), (("x", "y"), 5)], 0, 9, {"abc"}) == [("a", "bc", 9)]
    assert V.certain_merges([(("a", "bc"), 9), (("x", "y"), 5)], 5, 9, set()) == [("a", "bc", 9)]


def indexed_bpe(word_freq: dict, n: int):
    """The plain BPE with an index from pairs to words, so that a whole vocabulary ends in time."""
    words, freqs = [list(w) for w in word_freq], list(word_freq.values())
    counts, where, merges = Counter(), {}, []
    for k, s in enumerate(words):
        for p in zip(s, s[1:]):
            counts[p] += freqs[k]
            where.setdefault(p, set()).add(k)
    for rank in range(n):
        best = min(((-c, *p) for p, c in counts.items() if c), default=None)
        if best is None:
            break
        left, right = best[1:]
        merges.append((rank, left, right, -best[0]))
        for k in where.pop((left, right)):
            s = words[k]
            for p in zip(s, s[1:]):
                counts[p] -= freqs[k]
            i = 0
            while i + 1 < len(s):
                if s[i] == left and s[i + 1] == right:
                    s[i:i + 2] = [left + right]
                i += 1
            for p in zip(s, s[1:]):
                counts[p] += freqs[k]
                where.setdefault(p, set()).add(k)
    return merges


def test_registered_query_learns_a_whole_vocabulary(spark):
    from conftest import SF001

    from capset.plans import QUERIES
    from capset.plans.registry import load

    kept = V.alphabet(load(spark, SF001, "documents"), coverage=0.9999).where("kept").count()
    got = [tuple(r) for r in QUERIES["bpe_vocabulary"](spark, SF001).orderBy("rank").collect()]
    assert len(got) == 4096 - kept
    words = {r.word.replace(V.SEP, ""): r.freq for r in V.word_freq(load(spark, SF001, "documents")).collect()}
    assert got == indexed_bpe(words, len(got))


def test_merges_of_a_round_are_made_in_turn():
    spelled = lambda *s: V.SEP + (V.SEP + V.SEP).join(s) + V.SEP
    rank = {("a", "a"): 0, ("aa", "b"): 1, ("c", "aa"): 2, ("x", "y"): 3, ("xy", "z"): 4}
    assert V.merge_word(spelled(*"aaaab"), rank) == spelled("aa", "aab")
    assert V.merge_word(spelled(*"caab"), rank) == spelled("c", "aab")
    # a pair that a later merge makes comes too late
    assert V.merge_word(spelled("xy", "z", "x", "y", "z"), {("xy", "z"): 0, ("x", "y"): 1}) == spelled("xyz", "xy", "z")


def test_words_of_a_batch_are_merged_as_one_by_one():
    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(200):
        words = [V.SEP + (V.SEP * 2).join(rng.choices("aab", k=rng.randrange(1, 12))) + V.SEP for _ in range(rng.randrange(1, 30))]
        symbols, merges = list("ab"), []
        for _ in range(rng.randrange(1, 14)):
            pair = rng.choice(symbols), rng.choice(symbols)
            if pair not in merges:
                merges.append(pair)
                symbols.append("".join(pair))
        batch = pa.RecordBatch.from_pydict({"w": words, "freq": pa.array([1] * len(words), pa.int64())})
        assert V.merge_batch(batch, merges) == [V.merge_word(w, {p: k for k, p in enumerate(merges)}) for w in words]


def test_tasks_count_words_and_characters(spark, monkeypatch):
    monkeypatch.setattr(V, "_WORDS", 3)
    texts = ["a b\u00a0c\u2003a\x1cd", None, "", " \t", "\U0001F600 a\u0085b " * 50, "x y z w v u a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    whole = [t for t in texts if t]
    assert {r.word: r.freq for r in V.word_freq(df).collect()} == Counter(w for t in whole for w in t.split())
    counted = V.char_counts(df)
    assert {r.char: r.n for r in counted.collect()} == Counter("".join(whole))
    # a task gives one row a character, not one row for each place
    assert "Generate" not in counted._jdf.queryExecution().toString()


def test_alphabet_coverage(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    rows = V.alphabet(df, coverage=0.9).collect()
    counts = Counter(c for t in CORPUS for c in t)
    assert {r.char: r.n for r in rows} == dict(counts)
    total = sum(counts.values())
    order = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    acc, kept = 0, set()
    for c, n in order:
        if acc < 0.9 * total:
            kept.add(c)
        acc += n
    assert {r.char for r in rows if r.kept} == kept


def test_vocabulary_ids(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    merges = V.bpe_merges(V.word_freq(df), 3)
    vocab = V.vocabulary(merges, V.alphabet(df, coverage=1.0)).collect()
    assert sorted(r.id for r in vocab) == list(range(len(vocab)))
    toks = [r.token for r in sorted(vocab, key=lambda r: r.id)]
    assert toks[-3:] == [m.left + m.right for m in merges.orderBy("rank").collect()]
