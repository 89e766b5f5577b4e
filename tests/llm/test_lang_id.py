import random

from helpers import LONG, frame, held_out

from capset.llm.lang_id import codewords, decode, fit, identify, train

DOC = "doc_id long, text string, lang string, source string"
SYLLABLES = {"aa": "ba lo mi tu ra", "bb": "sch tze ung ein ach", "cc": "ção lhe nho que per", "dd": "ть ко по ва не"}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, text(rng, lang, rng.randint(3, 60)), lang, "s") for i in range(n) for lang in [rng.choice(sorted(SYLLABLES))]]


def test_codewords_differ_in_every_pair_and_no_column_is_constant():
    for n in (2, 3, 7, 12):
        code = codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2
        assert all(abs(c.sum()) < n for c in code.T[:n])


def test_held_out_accuracy(spark):
    docs = corpus()
    df = frame(spark, docs, DOC)
    got = {r.doc_id: r for r in identify(df, train(df)).collect()}
    assert sorted(got) == [d[0] for d in docs]
    for i, *_ in docs:
        assert got[i].held_out == held_out(i) and 0 <= got[i].score <= 1
    test = [d for d in docs if held_out(d[0])]
    assert sum(got[d[0]].lang_pred == d[2] for d in test) >= 0.97 * len(test)


def test_only_learning_rows_with_a_label_are_learnt(spark):
    docs = [(i, t, "wrong" if held_out(i) else lang, s) for i, t, lang, s in corpus(100)] + [(1000, "ba lo", None, "s"), (None, "ba", "aa", "s")]
    assert train(frame(spark, docs, DOC))["names"] == sorted(SYLLABLES)


def test_awkward_texts(spark):
    model = fit([d[1] for d in corpus()], [d[2] for d in corpus()])
    docs = [(1, None), (2, ""), (3, "123 !?"), (4, "ba lo mi " * 30_000), (5, "tze"), (5, "tze"), (None, "ung ein"), (7, "\u0000 a"), (8, LONG)]
    got = sorted(identify(frame(spark, docs, "doc_id long, text string"), model).collect(), key=str)
    assert len(got) == len(docs)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert (pred[1], pred[2], pred[3], pred[4], pred[5], pred[None]) == ("und", "und", "und", "aa", "bb", "bb")
    assert all(r.score == 0 and not r.ambiguous for r in got if r.lang_pred == "und")
    assert [r for r in got if r.doc_id is None][0].held_out is False


def test_no_rows_no_labels(spark):
    empty = frame(spark, [], DOC)
    assert identify(empty, train(empty)).collect() == []
    rows = frame(spark, [(1, "ba", None, "s")], DOC)
    assert [r.lang_pred for r in identify(rows, train(rows)).collect()] == ["und"]
    one = fit(["ba lo"], ["aa"])
    assert decode(one, ["ba", "7"])[0] == ["aa", "und"]


def test_ambiguity_is_flagged():
    model = fit([d[1] for d in corpus()], [d[2] for d in corpus()])
    mixed = ["ba lo mi tu sch tze ung ein"] * 1 + ["x"] + [d[1] for d in corpus(200, 5) if len(d[1]) > 100]
    _, score, near = decode(model, mixed)
    assert not near[2:].any() and (score[near] < 0.56).all()
