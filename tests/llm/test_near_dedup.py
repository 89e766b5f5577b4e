import random

import pytest
from helpers import LONG, Union, frame

from capset.llm.components import components
from capset.llm.near_dedup import near_duplicates, words_of

DOC = "doc_id long, text string"


def brute(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = words_of(t)
        k = min(width, len(w))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    u = Union(sets)
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    u.join(a, b)
    return sorted((i, len(sets[i]), u.find(i), i == u.find(i)) for i in ids)


def corpus(seed, n=260):
    """A large group of near copies of one text in all degrees, small groups, copies, odd texts."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 5000))
    docs, bases = [], [[word() for _ in range(rng.randint(20, 90))] for _ in range(12)]
    for _ in range(n):
        w = list(bases[0] if rng.random() < 0.6 else rng.choice(bases))
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    odd = [None, "", " \t", "one", "ONE", "one  two", "one two", "one\u00a0two", "One Two three", LONG, LONG + "x", "a b c", "a b c"]
    return list(enumerate([*docs, *odd, docs[3], docs[3].upper()], 100))


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 85, 1), (5, 80, 2)])
def test_against_brute_force(spark, width, percent, seed):
    docs = corpus(seed)
    got = near_duplicates(frame(spark, docs, DOC), width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(docs, width, percent)


def test_groups_of_many_blocks(spark):
    """Candidate groups that are cut into many blocks lose no link."""
    from capset.llm import near_dedup as N

    docs = corpus(3, 200)
    df = frame(spark, docs, DOC)
    seen = N.signatures(df, 3, 32, 8, "doc_id", "text").dropDuplicates(["digest"]).where("n_shingles > 0")
    groups = components(N.candidate_links(seen))
    u = Union([d[0] for d in docs])
    for r in N.verified_links(df, seen, groups, 3, 85, "doc_id", "text", block=7).collect():
        u.join(r.u, r.v)
    whole = {r.doc_id: r.component_id for r in near_duplicates(df, 3, 85).collect()}
    ids = [r[0] for r in seen.select("_id").collect()]
    assert all((u.find(a) == u.find(b)) == (whole[a] == whole[b]) for a in ids for b in ids)


def test_odd_tables(spark):
    assert near_duplicates(frame(spark, [], DOC)).collect() == []
    got = near_duplicates(frame(spark, [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "z"), (8, None), (8, "")], DOC)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (None, 1, None, True),
                                                       (8, 0, 8, True), (8, 0, 8, True)], key=str)


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)] \
        + [(300, 300 + i) for i in range(1, 80)] + [(500, 500)]
    u = Union(range(600))
    for a, b in edges:
        u.join(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame([*edges, (None, 1)], "u long, v long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, u.find(x)) for x in linked)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_bands_of_any_similarity(spark):
    from capset.llm.near_dedup import BANDS, MISS, bands_for

    assert all(bands_for(p) == b for p, b in BANDS.items())
    for percent in (1, 30, 50, 60, 70, 75, 90, 95, 99):
        bands, rows = bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= MISS, percent
    with pytest.raises(ValueError, match="0 %"):
        bands_for(0)
    # half of the words are the same: 40 bands of 7 miss most of these pairs
    docs = []
    for k in range(60):
        same = [f"s{k}x{j}" for j in range(30)]
        docs += [(2 * k, " ".join([*same, *(f"a{k}x{j}" for j in range(14))])), (2 * k + 1, " ".join([*same, *(f"b{k}x{j}" for j in range(14))]))]
    got = near_duplicates(frame(spark, docs, DOC), 1, 50).collect()
    assert sorted(map(tuple, got)) == brute(docs, 1, 50)


def test_null_id_between_near_copies(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(["x", *words[1:59], "y"]), " ".join(["x", "z", *words[2:58], "y", "y"])]
    plain = brute(list(zip([5, 6, 7], texts)), 3, 85)
    assert {c for _, _, c, _ in plain} == {5}
    got = near_duplicates(frame(spark, [(5, texts[0]), (None, texts[1]), (7, texts[2]), (None, "a lone text without id"), (None, None)], DOC)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(5, 5, True), (7, 5, False)]
    by = {r.n_shingles: (r.component_id, r.kept) for r in got if r.doc_id is None}
    assert by == {58: (5, False), 3: (None, True), 0: (None, True)}


def test_id_repeated_in_a_group(spark):
    words = [f"w{i}" for i in range(60)]
    one, two = " ".join(words), " ".join([*words[:59], "end"])
    rows = [(9, one)] * 500 + [(8, two), (9, two), (9, "another text of this id")]
    got = near_duplicates(frame(spark, rows, DOC)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.n_shingles == 58} == {(9, 8), (8, 8)}
    assert [(r.component_id, r.kept) for r in got if r.n_shingles == 3] == [(9, True)]


def test_plans_stay_small(spark, monkeypatch):
    """The driver plans a query anew after each of its shuffles: what is written at once holds few of them."""
    import contextlib
    import io

    rng = random.Random(7)
    path = [(i, i + 1) for i in range(40)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(20)]
    df, edges = frame(spark, corpus(4, 60), DOC), spark.createDataFrame(path, "u long, v long")
    shuffles, own = [], type(df).checkpoint

    def exchanges(plan):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            plan.explain()
        return out.getvalue().count("Exchange")

    def noted(plan, *args, **kwargs):
        shuffles.append(exchanges(plan))
        return own(plan, *args, **kwargs)

    monkeypatch.setattr(type(df), "checkpoint", noted)
    shuffles += [exchanges(components(edges)), exchanges(near_duplicates(df))]
    assert max(shuffles) <= 14, shuffles
