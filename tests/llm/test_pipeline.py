import random

import corpus_pipeline as cp
import pytest
from helpers import frame, held_out, normal
from test_mixing import targets
from test_near_dedup import brute as near

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "tu", "ra", "sch", "ung"]) for _ in range(rng.randint(1, 4)))
    docs = []
    for i in range(160):
        docs.append((i, " ".join(word() for _ in range(rng.randint(8, 60))), rng.choice(["aa", "bb"]), rng.choice(["x", "y", "y", "z", None]), i))
    for i in range(160, 220):  # exact and near copies
        words = docs[rng.randrange(20)][1].split()
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        docs.append((i, "  ".join(words), "aa", "y", None))
    return [*docs, (900, None, "aa", "x", 1), (901, "", None, "x", 1), (902, "12 34 !", "bb", "x", 1), (903, "ba lo mi", None, "x", 1)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [], spark.createDataFrame(corpus(), DOC)
    base = str(tmp_path_factory.mktemp("stages"))
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, "").write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(docs)
    return out


def test_each_stage_on_what_the_one_before_kept(stages):
    docs = corpus()
    one, two, three, four, five = stages
    assert all(df.columns == [c.split(" ")[0] for c in DOC.split(", ")] for df in (one, two, three, four))
    assert sorted(r.doc_id for r in one.collect()) == sorted(d[0] for d in docs if d[1] and any(map(str.isalpha, d[1])))
    assert [r.lang for r in one.collect() if r.doc_id == 903][0] in ("aa", "bb")
    first = {}
    for r in sorted(one.collect()):
        first.setdefault(normal(r.text), r.doc_id)
    assert sorted(r.doc_id for r in two.collect()) == sorted(first.values())
    rows = [(r.doc_id, r.text) for r in two.collect()]
    assert sorted(r.doc_id for r in three.collect()) == [i for i, _, _, kept in near(rows, 5, 80) if kept]
    kept = {r.doc_id: r for r in three.collect()}
    size = {i: len(r.text.split()) for i, r in kept.items()}
    sizes, got = {}, {}
    for i, r in kept.items():
        sizes[r.source] = sizes.get(r.source, 0) + size[i]
    for r in four.collect():
        assert r == kept[r.doc_id]
        got[r.source] = got.get(r.source, 0) + size[r.doc_id]
    for s, n in targets(sizes).items():  # whole documents: one more or less of them
        assert abs(got.get(s, 0) - n) <= 2 * max(size.values())
    assert five.where("sample = 1").count() == four.count()
    assert five.select("doc_id").distinct().count() == four.select("doc_id").distinct().count()


def test_last_stage_decodes(spark, stages):
    from capset.llm.segmentation import decode_pieces
    from capset.llm.vocabulary import load

    text = {r.doc_id: r.text for r in stages[3].collect()}
    assert all(r.text == text[r.doc_id] for r in decode_pieces(stages[4], load()).collect())


def test_stages_with_clashing_columns_nulls_and_no_rows(spark):
    odd = [(None, "ba lo", "aa", None, None), (None, "ba lo", "aa", None, None), (1, "ba lo mi", "aa", "s", 1), (1, "ba lo mi", "aa", "s", 1),
           (2, None, None, None, None)]
    for rows in (odd, []):
        docs = frame(spark, rows, DOC)
        for k, (_, stage) in enumerate(cp.STAGES):
            got = stage(spark, docs, "").collect()
            if k < 4:
                assert not got or got[0].asDict().keys() == set(docs.columns)
            assert bool(got) == bool(rows)


def test_language_decision_takes_effect(spark):
    """A wrong label gives way to a clear prediction; an ambiguous one leaves the label."""
    from pyspark.sql import functions as F

    from capset.llm.common import prepare
    from capset.llm.lang_id import predicted, train

    rng = random.Random(7)
    words = {"aa": ["schlung", "ungsch", "schung"], "bb": ["tirami", "balomi", "ratula"]}
    docs = [(i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang, "x", 1) for i, lang in enumerate(["aa", "bb"] * 150)]
    wrong = next(i for i in range(1000, 1100) if held_out(i))  # not trained on
    docs += [(wrong, " ".join(rng.choice(words["bb"]) for _ in range(20)), "aa", "x", 1), (901, "z", "aa", "x", 1), (902, "z", "bb", "x", 1)]
    df = spark.createDataFrame(docs, DOC)
    prepare(spark)
    told = {r.doc_id: r for r in df.select("doc_id", "lang", predicted(F.col("text"), train(df)).alias("p")).collect()}
    got = {r.doc_id: r.lang for r in cp.language(spark, df, "").collect()}
    assert got == {i: r.lang if r.p.ambiguous else r.p.lang_pred for i, r in told.items() if r.p.lang_pred != "und"}
    assert got[wrong] == "bb"
