import itertools
import math
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, frame

from capset.llm import segmentation as S
from capset.llm import vocabulary as V

TINY = V.of({" ": 0, "a": 1, "b": 2, "ab": 3, " a": 4, "ba": 5, "  ": 6}, list(range(10, 266)), 266)
ODD = [None, "", " ", "a", "  a  b ", "ab\nba\r\n", "☃ab▁", "\x00", "abab" * 40, "é ü ퟿"]


def paths(vocabulary, unit, logp):
    """All ways to spell a unit, with log-probabilities that are not normalised."""
    if not unit:
        yield (), 0.0
        return
    for p, i in vocabulary.pieces.items():
        if unit.startswith(p):
            for rest, x in paths(vocabulary, unit[len(p):], logp):
                yield (i, *rest), x + logp[i]


def distribution(text):
    logp, out = S.log_probabilities(TINY), {(): 0.0}
    for u in TINY.units(text):
        own = list(paths(TINY, u, logp))
        out = {a + b: x + y for (a, x), (b, y) in itertools.product(out.items(), own)}
    z = np.logaddexp.reduce(list(out.values()))
    return {k: math.exp(x - z) for k, x in out.items()}


def test_the_first_three_samples_follow_sampling_without_replacement():
    p = distribution("abab a")
    n = 12_000
    got = [[tuple(s[0].tolist()) for s in g] for g in S.Sampler(TINY, 3, 1).sample(list(range(n)), ["abab a"] * n)]
    want = [dict(p), Counter(), Counter()]
    for a, b, c in itertools.permutations(p, 3):
        want[2][c] += p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
    for a, b in itertools.permutations(p, 2):
        want[1][b] += p[a] * p[b] / (1 - p[a])
    for turn in range(3):
        seen = Counter(g[turn] for g in got)
        assert set(seen) <= set(p)
        assert max(abs(seen[k] / n - want[turn][k]) for k in p) < 5 * 0.5 / n**0.5


def test_scores():
    p = distribution("ab ba")
    n = 6_000
    got = list(S.Sampler(TINY, 2, 3).sample(list(range(n)), ["ab ba"] * n))
    for g in got[:300]:
        for pieces, logp, _, _ in g:
            assert math.isclose(math.exp(logp), p[tuple(pieces.tolist())], rel_tol=1e-9)
        assert g[0][2] > g[1][2]
    # inverse inclusion weights estimate sums over all segmentations without bias
    assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in g) for g in got]) - 1) < 0.03
    size = np.mean([sum(len(s[0]) * math.exp(s[1] - s[3]) for s in g) for g in got])
    assert abs(size - sum(len(k) * v for k, v in p.items())) < 0.15


def test_all_segmentations_come_when_k_is_large():
    p = distribution("abab")
    (got,) = S.Sampler(TINY, 50, 1).sample([5], ["abab"])
    assert {tuple(s[0].tolist()) for s in got} == set(p) and len(got) == len(p)
    assert all(s[3] == 0.0 for s in got)
    keys = [s[2] for s in got]
    assert keys == sorted(keys, reverse=True)


@pytest.mark.parametrize("vocabulary", [TINY, None])
def test_round_trip(spark, vocabulary):
    vocabulary = vocabulary or V.load()
    docs = [(i, t) for i, t in enumerate([*ODD, LONG])] + [(None, "ab"), (3, "a"), (3, "a")]
    rows = S.sample_segmentations(frame(spark, docs, "doc_id long, text string").repartition(3), vocabulary, k=3)
    got = S.decode_pieces(rows, vocabulary, out_col="decoded").collect()
    text = {i: t or "" for i, t in docs}
    assert all(r.decoded == text[r.doc_id] for r in got)
    by = Counter(r.doc_id for r in got)
    assert set(by) == set(text) and by[0] == by[1] == 1
    assert len({(r.doc_id, tuple(r.pieces)) for r in got if r.doc_id != 3}) == sum(n for i, n in by.items() if i != 3)
    again = S.sample_segmentations(frame(spark, docs[::-1], "doc_id long, text string").coalesce(1), vocabulary, k=3).collect()
    plain = lambda rs: sorted(((r.doc_id, r["sample"], r.pieces) for r in rs), key=str)
    assert plain(got) == plain(again)


def test_decoding_nulls_and_empty_tables(spark):
    df = frame(spark, [(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.out for r in S.decode_pieces(df, TINY, "ids", "out").collect()} == {1: None, 2: ""}
    assert S.sample_segmentations(frame(spark, [], "doc_id long, text string"), TINY).collect() == []


def test_against_the_library_every_text_is_spelled(spark):
    """The public library decodes what is drawn here."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=V.DEFAULT_MODEL)
    texts = ["Hello  world\nüber 日本 ☃", "the cat"]
    for t, g in zip(texts, S.Sampler(V.load(), 2, 1).sample([1, 2], texts), strict=True):
        assert [sp.decode(s[0].tolist()) for s in g] == [t, t]
