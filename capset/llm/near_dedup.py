"""Near-duplicate documents: MinHash banding, verification on full shingle sets, components.

1. Texts with the same words (lower-cased) are one class; its smallest id stands for it.
2. Each class gets many universal hash minima (a x + b mod 2^64, odd a); each band of minima is a
   bucket.  Members of a bucket are linked in salted stars, so a bucket with a third of all
   rows is dealt to many tasks, and no pairs are listed.
3. Components of these links are the candidate groups.  The members of a group are cut, by set size, into
   blocks; each pair of blocks whose sizes allow the similarity meets once, with the full sets.
   Similarities of all pairs of the two blocks are counted through an inverted index, and the links that
   span what they connect are kept: a block pair gives fewer rows than it has members.
4. Components of the verified links are the result.

The similarity is that of the full sets, on 64-bit hashes of the shingles.  What can be missed is a
pair that shares no band in any way, also not through others: see ``BANDS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.llm.common import SALTS, salt_bit, salt_of, salts_in, with_group_values
from capset.llm.components import components

#: Least similarity in percent -> (bands, minima in a band).  Chance to miss a pair that is exactly
#: that similar: 4e-5 at 85 (32 bands of 8), 8e-5 at 80 (40 bands of 7).
BANDS = {85: (32, 8), 80: (40, 7)}
#: Chance to miss such a pair at any other similarity, at most; and minima in a band and bands, at most, where that can be.
MISS, ROWS, MOST = 1e-4, 10, 64
#: Members of a block.
BLOCK = 128
_CACHE = 250_000  # words whose hashes a worker keeps
_SLICE = 1 << 15  # shingles hashed at once


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case; words are runs without blank and U+0009 to U+000D (what bytes split at)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], width: int, cache: dict) -> np.ndarray:
    """Hashes of the distinct runs of ``width`` words, sorted; with fewer words, of all as one."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(width, len(h))
    got = _mix(h[:len(h) - width + 1] + np.uint64(width))
    for j in range(1, width):
        got = _mix(got * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - width + 1 + j])
    return np.unique(got)


def bands_for(percent: float) -> tuple[int, int]:
    """Bands and minima in a band for a least similarity: as in ``BANDS``, or else by ``MISS``."""
    if percent in BANDS:
        return BANDS[percent]
    if not percent > 0:
        raise ValueError(f"least similarity is {percent} %: no bands find pairs that share nothing")
    need = lambda r: 1 if percent >= 100 else int(np.ceil(np.log(MISS) / np.log1p(-(percent / 100) ** r)))
    rows = next((r for r in range(ROWS, 1, -1) if need(r) <= MOST), 1)
    return need(rows), rows


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of all hash functions, one row a set (sets are not empty)."""
    out = np.full((len(sets), len(a)), np.iinfo(np.uint64).max, np.uint64)
    i = 0
    while i < len(sets):  # as many sets at once as a slice holds, at least one
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= _SLICE):
            n += len(sets[j])
            j += 1
        x = np.concatenate(sets[i:j])
        starts = np.cumsum([0, *map(len, sets[i:j - 1])])
        t = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=t)
            np.add(t, b[k], out=t)
            out[i:j, k] = np.minimum.reduceat(t, starts)
        i = j
    return out


def signatures(docs: DataFrame, width: int, bands: int, rows: int, id_col: str, text_col: str,
               seed: int = 1) -> DataFrame:
    """``_id, _th`` (hash of the text), ``n_shingles, digest`` (of the words), ``bands`` (a hash for each band; null if empty)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        cache = _Words()
        for df in batches:
            sets, digests = [], []
            for text in df["text"]:
                if len(cache) > _CACHE:
                    cache.clear()
                words = words_of(text)
                sets.append(shingle_hashes(words, width, cache))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
            full = [k for k, s in enumerate(sets) if len(s)]
            got: list = [None] * len(sets)
            if full:
                m = _minima([sets[k] for k in full], a, b).reshape(len(full), bands, rows)
                h = np.zeros((len(full), bands), np.uint64)
                for r in range(rows):
                    h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + m[:, :, r])
                for k, row in zip(full, h.view(np.int64), strict=True):
                    got[k] = row
            yield pd.DataFrame({"_id": df["_id"], "_th": df["_th"], "n_shingles": [len(s) for s in sets], "digest": digests, "bands": got})

    # ids travel as text: pandas would make floats of a column of integers with nulls
    return docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_th")) \
        .mapInPandas(run, "_id string, _th long, n_shingles long, digest binary, bands array<long>") \
        .withColumn("_id", F.col("_id").cast("long"))


def candidate_links(classes: DataFrame) -> DataFrame:
    """Salted stars of the buckets with two members or more: ``u, v``."""
    member = classes.select("_id", F.posexplode("bands").alias("_band", "_hash")).withColumn("_salt", salt_of(F.col("_id")))
    part = member.groupBy("_band", "_hash", "_salt").agg(F.min("_id").alias("_m"), F.max("_id").alias("_x"))
    whole = part.groupBy("_band", "_hash").agg(
        F.min("_m").alias("v"), F.max("_x").alias("_x"), F.bit_or(salt_bit(F.col("_salt"))).alias("_mask"))
    leader = whole.where("v != _x").select("_band", "_hash", "v", F.explode(salts_in(F.col("_mask"))).alias("_salt"))
    return member.join(leader, ["_band", "_hash", "_salt"]).select(F.col("_id").alias("u"), "v").where("u != v").distinct()


def _spanning_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that span what all verified links connect; in a pair of blocks only links across count."""
    n = len(ids)
    size = np.array([len(s) for s in sets])
    shingle, at = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.repeat(np.arange(n), size)
    order = np.argsort(at, kind="stable")
    who = own[order]  # members of each shingle in turn
    start = np.searchsorted(at[order], np.arange(len(shingle) + 1))
    first = np.concatenate([[0], np.cumsum(size)])
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    two = side.min() != side.max()
    for i in range(n):
        if two and side[i]:
            continue
        terms = at[first[i]:first[i + 1]]
        lo, length = start[terms], start[terms + 1] - start[terms]
        step = np.repeat(lo - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        shared = np.bincount(who[step], minlength=n)
        fits = 100 * shared >= percent * (size[i] + size - shared)
        fits &= (side == 1) if two else (np.arange(n) > i)
        for j in np.flatnonzero(fits):
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def _levels(n: str) -> Column:
    return F.floor(F.log(F.col(n).cast("double")) / float(np.log(1.05))).cast("int")


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, width: int, percent: int, id_col: str,
                   text_col: str, block: int = BLOCK) -> DataFrame:
    """Links ``u, v``, on full sets, that span what is similar among classes of a candidate group.

    ``classes`` has ``_id`` (the class' number), ``n_shingles`` and, if that is not its number, ``_rid`` and ``_th``: id and hash of
    the text that stands for it.  ``groups`` has ``node, component``.  A group of up to ``block`` members is one block.  A larger one is cut
    by set size (levels of 5 %) and inside a level by hash; only levels near enough for the
    similarity meet.
    """
    own_id = "_rid" if "_rid" in classes.columns else "_id"
    member = classes.select(F.col("_id").alias("node"), "n_shingles", F.col(own_id).alias("_rid"), "_th").join(groups, "node").withColumns(
        {"_level": _levels("n_shingles"), "_salt": salt_of(F.col("node"))}).checkpoint()  # read twice
    part = member.groupBy("component", "_level", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    level = part.groupBy("component", "_level").agg(F.sum("_n").alias("_n"), F.bit_or(salt_bit(F.col("_salt"))).alias("_mask"))
    # a group has as many levels as there are powers of 1.05 below the largest set: a few hundred at most
    whole = level.groupBy("component").agg(
        F.sum("_n").alias("_members"), F.bit_or("_mask").alias("_mask"),
        F.collect_list(F.struct("_level", F.ceil(F.col("_n") / block).cast("int").alias("_parts"))).alias("_of")).checkpoint()
    back = whole.select("component", "_members", "_of", F.explode(salts_in(F.col("_mask"))).alias("_salt"))
    placed = member.join(back, ["component", "_salt"])
    near = int(np.ceil(np.log(100 / percent) / np.log(1.05)))
    own = F.element_at(F.filter("_of", lambda x: x["_level"] == F.col("_level")), 1)["_parts"]
    code = lambda lv, p: lv.cast("long") * (1 << 32) + p
    mine = code(F.col("_level"), F.pmod(F.xxhash64("node", F.lit(5)), own))
    others = F.flatten(F.transform(
        F.filter("_of", lambda x: F.abs(x["_level"] - F.col("_level")) <= near),
        lambda x: F.transform(F.sequence(F.lit(0), x["_parts"] - 1), lambda p: code(x["_level"], p))))
    one = F.col("_members") <= block
    placed = placed.withColumns({"_mine": F.when(one, F.lit(0).cast("long")).otherwise(mine),
                                 "_others": F.when(one, F.array(F.lit(0).cast("long"))).otherwise(others)})
    placed = placed.select("node", "_rid", F.col("_th").alias("_rth"), "component", "_mine", "_others")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for df in batches:
            if len(cache) > _CACHE:
                cache.clear()
            df["_set"] = [shingle_hashes(words_of(t), width, cache).tobytes() for t in df["text"]]
            yield df.drop(columns="text")

    # the text by id and hash, so null ids don't meet each other; rows that repeat both give one set
    text = docs.select(F.col(id_col).cast("long").alias("_own"), F.xxhash64(text_col).alias("_oth"), F.col(text_col).alias("text"))
    same = (F.col("_oth") == F.col("_rth")) & F.col("_own").eqNullSafe(F.col("_rid"))
    full = text.join(placed.hint("shuffle_hash"), same).select("node", "component", "_mine", "_others", "text").mapInPandas(
        sets_of, "node long, component long, _mine long, _others array<long>, _set binary").dropDuplicates(["node"])
    met = full.select(
        F.col("node").alias("_id"), "component", "_mine", F.explode("_others").alias("_other"), "_set").select(
        "_id", "component", F.least("_mine", "_other").alias("_a"), F.greatest("_mine", "_other").alias("_b"),
        (F.col("_mine") > F.col("_other")).cast("int").alias("_side"), "_set")

    def verify(df: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(b, np.uint64) for b in df["_set"]]
        got = _spanning_links(df["_id"].to_numpy(), sets, df["_side"].to_numpy(), percent)
        return pd.DataFrame(got, columns=["u", "v"], dtype="int64")

    return met.groupBy("component", "_a", "_b").applyInPandas(verify, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text", bands: int | None = None, rows: int | None = None) -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if ``100 * shared >= percent * all`` of their distinct shingles of ``width`` words
    (fewer words: all as one); ``component_id`` is the smallest id reachable.  Null and empty texts,
    and those of white space alone, have no shingles and are linked with nothing.  Rows that repeat an id
    but not its text are documents of their own; a null id links too, but never names a component (null, and kept, if it has no other).  Ids
    are integers.  An empty table gives an empty result; other columns are not read.
    """
    b, r = bands_for(percent)
    b, r = bands or b, rows or r
    salt = F.pmod(F.xxhash64("_id", "_th"), F.lit(SALTS)).cast("int")
    salted = signatures(docs, width, b, r, id_col, text_col).withColumn("_salt", salt).checkpoint()
    # a class is stood for by the row of its smallest id (null if it has no other), of these by the least text hash
    stands = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_th")
    part = salted.groupBy("digest", "_salt").agg(F.min(stands).alias("_rep"))
    whole = part.groupBy("digest").agg(F.min("_rep").alias("_rep"), F.bit_or(salt_bit(F.col("_salt"))).alias("_mask"))
    # classes are joined under numbers of their own, so those without an id link too
    whole = whole.select("digest", "_mask", F.col("_rep._id").alias("_rid"), F.col("_rep._th").alias("_rth"),
                         F.monotonically_increasing_id().alias("_class")).checkpoint()
    # the row that stands for a class is in that row's salt, so hot texts are no hot keys
    heads = whole.select("digest", "_class", "_rid", "_rth", F.pmod(F.xxhash64("_rid", "_rth"), F.lit(SALTS)).cast("int").alias("_salt"))
    classes = salted.where("n_shingles > 0").join(heads, ["digest", "_salt"]).where("_id <=> _rid and _th = _rth").select(
        F.col("_class").alias("_id"), "_rid", "_th", "n_shingles", "bands").dropDuplicates(["_id"]).checkpoint()
    groups = components(candidate_links(classes))
    linked = components(verified_links(docs, classes, groups, width, percent, id_col, text_col)).withColumnRenamed("node", "_class")
    # a component is named by its least id that is not null
    member = linked.join(whole.select("_class", "_rid"), "_class").checkpoint()  # read twice
    member = with_group_values(member, ["component"], F.col("_class"), {"_m": F.min("_rid")}, {"_least": F.min("_m")}).select(
        "_class", "_least").checkpoint()
    named = whole.join(member, "_class", "left").select(
        "digest", F.coalesce("_least", "_rid").alias("_component"), F.explode(salts_in(F.col("_mask"))).alias("_salt"))
    empty = F.col("n_shingles") == 0
    got = salted.select("_id", "n_shingles", "digest", "_salt").join(named, ["digest", "_salt"]).select(
        F.col("_id").alias("doc_id"), "n_shingles", F.when(empty, F.col("_id")).otherwise(F.col("_component")).alias("component_id"))
    return got.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
