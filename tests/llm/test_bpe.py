import random

import numpy as np
import pytest
from helpers import LONG, SF01, frame

from capset.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.DEFAULT_FILE)


def by_rounds(merges, symbols):
    """All rules one after the other."""
    for (u, v), (_, token) in merges.rules.items():
        out = []
        for s in symbols:
            if out and out[-1] == u and s == v:
                out[-1] = token
            else:
                out.append(s)
        symbols = out
    return symbols


def random_list(rng, letters=3, n=14):
    inner, final = list(range(256)), list(range(256, 512))
    made, rules = [*range(97, 97 + letters), *range(353, 353 + letters)], {}
    while len(rules) < n:
        u, v = rng.choice(made), rng.choice(made)
        if (u, v) not in rules and u not in range(256, 512):
            rules[u, v] = (len(rules), 1000 + len(rules))
            made.append(1000 + len(rules) - 1)
    return bpe.MergeList(inner, final, rules)


@pytest.mark.parametrize("seed", range(30))
def test_streamed_words_equal_rounds_over_the_whole_word(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(bpe, "STEP", rng.choice([1, 2, 5]))
    merges = random_list(rng)
    for _ in range(60):
        word = bytes(rng.choice(b"abc") for _ in range(rng.choice([1, 2, 7, 60, 200])))
        t, got, at = bpe.Transducer(merges), [], 0
        while at < len(word):
            n = rng.randint(1, 9)
            got += t.feed(word[at:at + n])
            assert len(t.rest) <= merges.lookahead + 2 * bpe.STEP + 32
            at += n
        got += t.finish()
        assert got == by_rounds(merges, [merges.inner[b] for b in word[:-1]] + [merges.final[word[-1]]])


@pytest.mark.parametrize("seed", range(8))
def test_words_side_by_side(seed):
    rng = random.Random(seed)
    merges = random_list(rng, n=rng.choice([0, 1, 14, 40]))
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, bpe.SHORT))) for _ in range(300)] + [b"a", b"ab"]
    assert merges.merge_words(words) == [by_rounds(merges, [merges.inner[b] for b in w[:-1]] + [merges.final[w[-1]]]) for w in words]


def test_lookahead_is_needed_and_enough():
    # a|b waits for b|c, which waits for c|d: what follows a "b" three letters on decides about "ab"
    inner, final = list(range(256)), list(range(256, 512))
    a, b, c, d = b"abcd"
    merges = bpe.MergeList(inner, final, {(c, d): (0, 600), (b, c): (1, 601), (a, b): (2, 602)})
    assert merges.lookahead == 3
    assert merges.merge([a, b, c]) != merges.merge([a, b, c, d])[:2]
    with pytest.raises(ValueError):
        bpe.MergeList(inner, final, {(700, a): (0, 701)})


def test_random_texts_against_the_library(vocabulary, library):
    rng = random.Random(5)
    alphabet = "aàéßİΣσ ñxyzABC'tsrevmld019½²一の한글🙂é̈‍  \n\t\r\x0b\x1c\x85.,!?<|>_-ǅﬁΌक़ᲉꟜ"
    decoder = bpe.Decoder(vocabulary)
    encoder = bpe.Encoder(vocabulary)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|>a<|startoftext|><|startoftext|", "don't I'VE 'T's", "a" * 5000, "é" * 3000, "ab" * 4000 + "Σ",
              "".join(rng.choice("etaoinshr") for _ in range(30000)), "  ", "﻿x", "a\x00b"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        got = encoder.encode(text)
        assert got.tolist() == want.ids, text
        assert decoder.feed(got) + decoder.finish() == library.decode(want.ids, skip_special_tokens=False)


def test_plain_characters_agree_with_the_library(vocabulary, library):
    words = bpe.Words(vocabulary)
    for c in [*range(0x530), *range(0x2000, 0x2070)]:
        text = f"A{chr(c)}b {chr(c)}é{chr(c)}1"
        assert words._plain(text) == words._other(text), hex(c)


def test_slices_and_kept_words_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 7)
    monkeypatch.setattr(bpe, "KEPT", 100)
    monkeypatch.setattr(bpe, "GROUP", 20)
    encoder = bpe.Encoder(vocabulary)
    text = "Some words, some <|endoftext|> more 12 words\n\n and averylongwordwithoutblanks é ́x " * 3
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_decoder_in_portions(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    text = "héllo wörld ☃ 一二 🙂 <|endoftext|> x"
    ids = encoder.encode(text)
    for marks in (True, False):
        whole = bpe.Decoder(vocabulary, marks)
        want = whole.feed(ids) + whole.finish()
        parts = bpe.Decoder(vocabulary, marks)
        assert "".join(parts.feed(ids[i:i + 1]) for i in range(len(ids))) + parts.finish() == want
    assert want == "héllo wörld ☃ 一 二 🙂 <|endoftext|>x ".replace("一 二", "一二")
    with pytest.raises(IndexError):
        whole.feed(np.array([10**6]))
    assert bpe.Decoder(vocabulary, False).feed(ids[:0]) == ""


def test_operator(spark, vocabulary, library):
    docs = [(1, None), (2, ""), (3, "Hello  wörld\n\nthe ☃"), (4, LONG), (5, "a"), (5, "a"), (None, "x y"), (6, "z" * 100_000)]
    got = bpe.encode_decode(frame(spark, docs, "doc_id long, text string"), vocabulary)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got.collect()), key=str) == sorted(want, key=str)
    back = bpe.decode_ids(got.withColumn("ids", got["ids"]), vocabulary).where("doc_id = 3").first()
    assert back.text == "hello wörld the ☃ "
    assert bpe.encode_decode(frame(spark, [], "doc_id long, text string"), vocabulary).collect() == []


def test_query_against_the_library(spark, library):
    import hashlib

    from capset.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op12_bpe_codec"](spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(rows)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
