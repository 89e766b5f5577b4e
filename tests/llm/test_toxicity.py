import random

import numpy as np
from helpers import LONG, frame, held_out

from capset.llm.toxicity import Scorer, _threshold, _thresholds, fit, score_toxicity, train

DOC = "doc_id long, text string, lang string, source string"
LABEL = "doc_id long, quality int, toxic int"
BAD = {"aa": ["rotten", "filthy"], "bb": ["schlimmo"]}


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(["aa", "bb"])
        words = [("" if lang == "aa" else "z") + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), rng.choice(BAD[lang]) + ("" if lang == "aa" else rng.choice("abcdefgh")))
        docs.append((i, " ".join(words), lang, "s"))
        if rng.random() < 0.9:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_quality(spark):
    docs, labels = corpus()
    df = frame(spark, docs, DOC)
    got = {r.doc_id: r for r in score_toxicity(df, train(df, frame(spark, labels, LABEL))).collect()}
    assert sorted(got) == [d[0] for d in docs]
    test = [(i, t) for i, _, t in labels if held_out(i)]
    assert sum(got[i].predicted == t for i, t in test) >= 0.93 * len(test)
    for r in got.values():
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(200)
    turned = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    df = frame(spark, docs, DOC).coalesce(1)
    one, two = (train(df, frame(spark, x, LABEL)) for x in (labels, turned))
    assert (one["emb"] == two["emb"]).all() and one["cut"] == two["cut"]


def test_awkward_texts_and_slices(spark, monkeypatch):
    docs, labels = corpus(300)
    by = {d[0]: d for d in docs}
    model = fit([by[i][1] for i, *_ in labels], [by[i][2] for i, *_ in labels], [t for *_, t in labels])
    odd = [(1, None), (2, ""), (3, "\n\t 123 !"), (4, LONG), (5, LONG + " filthy rotten"), (6, "x"), (6, "x"), (None, "filthy")]
    got = {r.doc_id: r.score for r in score_toxicity(frame(spark, odd, "doc_id long, text string"), model).collect()}
    assert len(got) == 7 and got[1] == got[2] == got[3]
    assert got[5] > got[4]
    from capset.llm import toxicity

    whole = Scorer(model).score([by[i][1] for i in range(50)])[0]
    monkeypatch.setattr(toxicity, "_CHUNK", 7)
    monkeypatch.setattr(toxicity, "_CACHE", 100)
    assert np.allclose(whole, Scorer(model).score([by[i][1] for i in range(50)])[0], atol=1e-5)


def test_no_rows_no_labels(spark):
    empty, none = frame(spark, [], DOC), frame(spark, [], LABEL)
    assert score_toxicity(empty, train(empty, none)).collect() == []
    rows = frame(spark, [(1, "a", None, "s")], DOC)
    odd = frame(spark, [(1, 1, None), (None, 1, 1), (1, 0, 7), (99, 1, 1)], LABEL)
    assert len(score_toxicity(rows, train(rows, odd)).collect()) == 1


def test_all_labels_are_learnt_beyond_what_the_driver_holds(spark, monkeypatch):
    from capset.llm import toxicity

    monkeypatch.setattr(toxicity, "SHARD_ROWS", 300)
    docs, labels = corpus(1500)
    # a word whose only rows are few: a sample of 150 rows of each class holds hardly any of them
    rare = [(10_000 + i, docs[i][1] + (" grubelig" if i % 2 else ""), "cc", "s") for i in range(60)]
    docs, labels = docs + rare, labels + [(i, 1, i % 2) for i, *_ in rare]
    df, lab = frame(spark, docs, DOC), frame(spark, labels, LABEL)
    one, two = (train(x, lab, rows=150) for x in (df, df.repartition(5)))
    assert (one["emb"] == two["emb"]).all() and one["cut"] == two["cut"]
    by = {i: t for i, _, t in labels if not held_out(i)}
    # the language counts hold every word of every labelled text
    words = sum(len(toxicity.words_of(t)) for i, t, *_ in docs if i in by)
    table = np.exp(one["lang"].astype(float))
    total = [sum(len(toxicity.words_of(t)) for i, t, lang, _ in docs if i in by and lang == v) for v in one["langs"]]
    assert one["langs"] == ["aa", "bb", "cc"] and sum(total) == words
    for k, n in enumerate(total):
        assert np.isclose(table[:, k].min(), 1 / (toxicity.TABLE + 5 * n), rtol=1e-3)
    got = {r.doc_id: r for r in score_toxicity(df, one).collect()}
    test = [(i, t) for i, _, t in labels if held_out(i) and i < 10_000]
    assert sum(got[i].predicted == t for i, t in test) >= 0.93 * len(test)


def test_shards_go_by_rows_not_by_partitions(spark, monkeypatch):
    """More partitions give no more nets, which the shuffle would have to hold, and the same model."""
    from capset.llm import toxicity

    monkeypatch.setattr(toxicity, "SHARD_ROWS", 300)
    docs, labels = corpus(700)
    df, lab = frame(spark, docs + docs[:20], DOC), frame(spark, labels, LABEL)
    one, own = train(df, lab, rows=100), type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda d, n, *cols: own(d, max(n, 31), *cols))
    two = train(df, lab, rows=100)
    assert (one["emb"] == two["emb"]).all() and (one["lang"] == two["lang"]).all() and one["cut"] == two["cut"]


def test_thresholds_of_all_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), round(rng.gauss(2 * y - 1, 1), 1 if rng.random() < 0.5 else 4), y) for y in (0, 1) for _ in range(300)]
    rows += [("c", 3.0, 1), ("c", 2.0, 0)]
    got = _thresholds(frame(spark, rows, "lang string, logit double, y long"))
    assert sorted(got) == ["", "a", "b"]
    for key, cut in got.items():
        own = [(x, y) for lang, x, y in rows if key in ("", lang)]
        errors = lambda c: sum((x >= c) != y for x, y in own)
        assert errors(cut) == min(errors(c) for c in [-9, *(x + d for x, _ in own for d in (0, 1e-7))])
    own = [(x + rng.random() * 1e-6, y) for lang, x, y in rows if lang == "a"]
    assert np.isclose(_thresholds(frame(spark, [("a", *r) for r in own], "lang string, logit double, y long"))["a"],
                      _threshold(np.array([x for x, _ in own]), np.array([y for _, y in own])))
