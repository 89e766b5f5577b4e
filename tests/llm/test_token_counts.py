import random

import pytest
from helpers import LONG, frame

from capset.llm import vocabulary as V
from capset.llm.token_counts import Automaton, token_counts


def greedy(vocabulary, text):
    n = i = 0
    longest = max(map(len, vocabulary.pieces))
    while i < len(text):
        for j in range(min(len(text), i + longest), i, -1):
            if text[i:j] in vocabulary.pieces:
                n, i = n + 1, j
                break
        else:
            n, i = n + len(text[i].encode()), i + 1
    return n


@pytest.mark.parametrize("seed", range(8))
def test_against_greedy_search(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))): i for i in range(rng.randint(1, 25))}
    pieces |= {" " + p: 100 + i for p, i in list(pieces.items())[:5]}
    vocabulary = V.of(pieces, list(range(256)), 400)
    automaton = Automaton(vocabulary)
    for _ in range(300):
        text = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 40)))
        assert automaton.count(text) == greedy(vocabulary, text)


def test_public_vocabulary(spark):
    vocabulary = V.load()
    docs = [(1, None), (2, ""), (3, "Hello  wörld\n\nthe ☃ ▁x"), (4, LONG), (5, "a"), (5, "a"), (None, "x y")]
    got = token_counts(frame(spark, docs, "doc_id long, text string"), vocabulary)
    assert got.columns == ["doc_id", "n_tokens", "n_units"]
    want = sorted(((i, greedy(vocabulary, " " + t) if t else 0) for i, t in docs), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=str) == want
    assert token_counts(frame(spark, [], "doc_id long, text string"), vocabulary).collect() == []


def test_pieces_that_cross_units_are_refused():
    for bad in ("a b", "a\n"):
        with pytest.raises(ValueError):
            V.of({bad: 0}, list(range(256)), 300)
