"""Corpus statistics for a sub-word vocabulary: words, character coverage, BPE merges.

The reference hands one text file to a native trainer; the data work inside it is counting,
which runs here as Spark aggregates:

* ``word_freq``: tasks count words in Arrow batches, ``groupBy`` adds up (a very frequent word
  is pre-counted in every task before the shuffle).
* ``alphabet``: characters by frequency; the cumulative share runs over the *aggregated*
  character table (one row per distinct character, bounded by the character set), never over
  the text rows.
* ``bpe_merges``: iterative pair counting on the distinct-word table.  Each round is one
  aggregate over pairs weighted by word frequency; the best pairs (a bounded list) go to the
  driver, which is inherent to BPE's sequential definition, and as many of them are merged as
  can be without changing the result.  The word table is reliably checkpointed every few rounds.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capset.functions.text import words as split_words


def chars(c) -> "F.Column":
    """Characters (Unicode code points) of a string, as an array."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


def word_split(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("words", split_words(text))


#: Texts looked at together, and different words or characters that a task counts before it hands them on.
_TEXTS, _WORDS, _CHARS = 256, 200_000, 1 << 20


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        for k in range(0, batch.num_rows, _TEXTS):
            yield [t for t in batch.column(0).slice(k, _TEXTS).to_pylist() if t]


def word_freq(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, freq)`` over the whole corpus; tasks count in Arrow batches (``str.split`` cuts as ``words`` does), then words are grouped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for texts in _texts(batches):
            for t in texts:
                counts.update(t.split())
                if len(counts) > _WORDS:
                    yield pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "freq": pa.array(counts.values(), pa.int64())})
                    counts.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "freq": pa.array(counts.values(), pa.int64())})

    return df.select(text).mapInArrow(run, "word string, freq long").groupBy("word").agg(F.sum("freq").alias("freq"))


def char_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(char, n)`` of all characters (code points); a task counts its texts as arrays, one row a character comes out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0x110000, np.int64)
        for texts in _texts(batches):
            whole = "".join(texts)
            for k in range(0, len(whole), _CHARS):
                found = np.bincount(np.frombuffer(whole[k:k + _CHARS].encode("utf-32-le"), np.uint32))
                counts[:len(found)] += found
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"char": pa.array(map(chr, at.tolist()), pa.string()), "n": counts[at]})

    return df.select(text).mapInArrow(run, "char string, n long").groupBy("char").agg(F.sum("n").alias("n"))


def alphabet(df: DataFrame, text: str = "text", coverage: float = 0.9999) -> DataFrame:
    """Characters with counts; ``kept`` marks the most frequent ones that cover ``coverage`` of
    all characters (ties by character)."""
    counts = char_counts(df, text)
    # windows over the per-character table (bounded by the character set, not by the corpus);
    # the total is a window over the same table, so the corpus is read once
    w = Window.orderBy(F.col("n").desc(), F.col("char")).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.sum("n").over(w), F.lit(0))
    return counts.select("char", "n", (before < F.lit(coverage) * total).alias("kept"))


# Words are kept as one string with a separator on either side of every symbol
# (``\x01t\x01\x01h\x01\x01e\x01``), so a merge is a literal replacement of ``r\x01\x01l``.
SEP = "\u0001"
#: Of the ranked pairs, how many the driver looks at in a round; and of the words' pieces.
CANDIDATES = 1024
SEGMENTS = 100_000


class _Flat:
    """The symbols of a batch of words as one array of numbers; number 0, the empty symbol, stands between words."""

    def __init__(self, batch: pa.RecordBatch, first: list[str] = ()):
        whole = (SEP + SEP).join(batch.column("w").to_pylist())
        symbols = whole[1:-1].split(SEP + SEP)
        self.names = ["", *dict.fromkeys(s for s in first if s)]
        number = {s: k for k, s in enumerate(self.names)}
        for s in set(symbols):
            if s not in number:
                number[s] = len(self.names)
                self.names.append(s)
        self.number = number
        self.ids = np.fromiter(map(number.__getitem__, symbols), np.int64, len(symbols))
        self.freq = batch.column("freq").fill_null(0).to_numpy(zero_copy_only=False)

    def word(self) -> np.ndarray:
        return np.cumsum(self.ids == 0)

    def pairs(self) -> np.ndarray:
        """A number for each two neighbours; -1 across words."""
        left, right = self.ids[:-1], self.ids[1:]
        return np.where((left > 0) & (right > 0), (left << 32) + right, -1)

    def code(self, left: str, right: str) -> int:
        return (self.number[left] << 32) + self.number[right]


def _batches(df: DataFrame, run, schema: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(run(batch))

    return df.mapInArrow(each, schema)


def pair_counts(words: DataFrame, col: str = "w") -> DataFrame:
    """Adjacent symbol pairs weighted by word frequency: ``(left, right, freq)``."""

    def run(batch: pa.RecordBatch) -> dict:
        flat = _Flat(batch)
        pairs = flat.pairs()
        inside = np.flatnonzero(pairs >= 0)
        code, n = pairs[inside], flat.freq[flat.word()[inside]]
        order = np.argsort(code, kind="stable")
        code = code[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        total = np.add.reduceat(n[order], starts) if len(starts) else np.zeros(0, np.int64)
        names = [flat.names[c >> 32] + SEP + flat.names[c & 0xFFFFFFFF] for c in code[starts].tolist()]
        return {"p": pa.array(names, pa.string()), "freq": total}

    # a pair travels as one string: the aggregate's keys are strings, not structs
    counts = _batches(words.select(F.col(col).alias("w"), "freq"), run, "p string, freq long").groupBy("p").agg(F.sum("freq").alias("freq"))
    parts = F.split("p", SEP)
    return counts.select(F.element_at(parts, 1).alias("left"), F.element_at(parts, 2).alias("right"), "freq")


def certain_merges(segments: list, floor: int, limit: int, known: set) -> list:
    """Merges ``(left, right, freq)`` that are certain from ``segments`` (symbols, freq): those above ``floor``.

    Words are cut between symbols of pairs that come up to ``floor`` times.  A pair made by a merge stands
    at places where one pair stood before, so what lies across a cut never comes up more often.  That needs
    new symbols to be made in one way only: a merge whose symbol is in ``known`` or was made before is the last.
    """
    words = [list(s) for s, _ in segments]
    freqs = [f for _, f in segments]
    counts, where, made, taken = Counter(), defaultdict(set), set(), []
    for k, s in enumerate(words):
        for p in zip(s, s[1:]):
            counts[p] += freqs[k]
            where[p].add(k)
    heap = [(-n, *p) for p, n in counts.items() if n > floor]
    heapq.heapify(heap)
    while heap and len(taken) < limit:
        n, left, right = heapq.heappop(heap)
        if counts[left, right] != -n:
            continue  # counted anew since
        taken.append((left, right, -n))
        token = left + right
        if token in known or token in made:
            break
        made.add(token)
        changed = set()
        for k in where.pop((left, right)):
            s, out, i = words[k], [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == left and s[i + 1] == right:
                    out.append(token)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            for p in zip(s, s[1:]):
                counts[p] -= freqs[k]
                changed.add(p)
            for p in zip(out, out[1:]):
                counts[p] += freqs[k]
                where[p].add(k)
                changed.add(p)
            words[k] = out
        for p in changed:
            if counts[p] > floor:
                heapq.heappush(heap, (-counts[p], *p))
    return taken


def _segments(words: DataFrame, hot: list) -> DataFrame:
    """``(s, freq)``: runs of symbols (with ``SEP`` between) whose adjacent pairs are all ``hot``."""
    hot = [(left, right) for left, right, _ in hot]

    def run(batch: pa.RecordBatch) -> dict:
        flat = _Flat(batch, [s for p in hot for s in p])
        joint = np.append(np.isin(flat.pairs(), [flat.code(*p) for p in hot]), False)
        between = np.array([SEP + SEP, SEP], object)[joint.astype(int)]
        pieces = "".join(x for two in zip(map(flat.names.__getitem__, flat.ids.tolist()), between, strict=True) for x in two)[:-2].split(SEP + SEP)
        starts = np.flatnonzero(~np.concatenate([[False], joint[:-1]]))
        counts: Counter = Counter()
        freqs = flat.freq[flat.word()[starts]].tolist()
        for k in np.flatnonzero(joint[starts]).tolist():
            counts[pieces[k]] += freqs[k]
        return {"s": pa.array(counts.keys(), pa.string()), "freq": pa.array(counts.values(), pa.int64())}

    return _batches(words.select("w", "freq"), run, "s string, freq long").groupBy("s").agg(F.sum("freq").alias("freq"))


def merge_word(word: str, rank: dict[tuple[str, str], int]) -> str:
    """The ranked merges made in turn, each from left to right; pairs that come up for a rank already past stay."""
    symbols, never = word[1:-1].split(SEP + SEP), len(rank)
    ranks = [rank.get(p, never) for p in zip(symbols, symbols[1:], strict=False)]
    while ranks:
        now = min(ranks)
        if now == never:
            break
        at = ranks.index(now)
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        del ranks[at]
        for k in (at - 1, at):
            if 0 <= k < len(ranks):
                new = rank.get((symbols[k], symbols[k + 1]), never)
                ranks[k] = new if new > now else never
    return SEP + (SEP + SEP).join(symbols) + SEP


def merge_batch(batch: pa.RecordBatch, merges: list[tuple[str, str]]) -> list[str]:
    """The words of a batch after the merges, as ``merge_word`` makes them; all words take a step of their own at once."""
    flat = _Flat(batch, [s for left, right in merges for s in (left, right, left + right)])
    codes = np.array([flat.code(*p) for p in merges], np.int64)
    made = np.array([flat.number[left + right] for left, right in merges], np.int64)
    rank, never = np.argsort(codes), len(merges)
    codes = codes[rank]
    past = np.full(batch.num_rows, -1)
    while True:
        pairs, word = flat.pairs(), flat.word()
        at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
        ranks = np.where(codes[at] == pairs, rank[at], never)
        ranks[ranks <= past[word[:-1]]] = never
        able = np.flatnonzero(ranks < never)
        if not len(able):
            break
        least = np.full(batch.num_rows, never)
        np.minimum.at(least, word[able], ranks[able])
        hit = able[ranks[able] == least[word[able]]]
        # of pairs that overlap (the same symbol again and again) every other one
        new = np.diff(hit, prepend=-2) != 1
        first = np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
        past[word[hit]] = ranks[hit]
        flat.ids[hit] = made[ranks[hit]]
        flat.ids = np.delete(flat.ids, hit + 1)
    whole = (SEP + SEP).join(map(flat.names.__getitem__, flat.ids.tolist()))
    return [SEP + w + SEP for w in whole.split(SEP * 4)]


def _all_merged(words: DataFrame, merges: list) -> DataFrame:
    """``w, freq`` with all ``merges`` made in turn, in Arrow batches.

    As an expression it would be one replacement a merge over every word; here a word costs what it is long."""
    pairs = [(left, right) for left, right, _ in merges]
    return _batches(words, lambda b: {"w": pa.array(merge_batch(b, pairs), pa.string()), "freq": b.column("freq")}, "w string, freq long")


def bpe_merges(words: DataFrame, num_merges: int, word: str = "word", freq: str = "freq",
               merges_per_round: int = 512, checkpoint_every: int = 8) -> DataFrame:
    """Learn ``num_merges`` BPE merges from ``(word, freq)``: the most frequent adjacent pair
    (ties: smallest left, then right symbol) is merged in every word, again and again.

    A round counts all pairs, cuts the words between symbols of rarer pairs and takes up to
    ``merges_per_round`` merges from the distinct pieces, as far as merging one by one is certain to take
    the same (``certain_merges``); with 1 it is one merge a round, with the same result.  The driver sees up to
    ``SEGMENTS`` pieces: with more, the pieces (written, so the words are read once a round) are cut again between
    more of the pairs.  The words are checkpointed reliably every
    ``checkpoint_every`` rounds or some dozen merges, and what lies between is replayed from there.

    Returns ``(rank, left, right, freq)``; stops early when no pair is left.
    """
    from capset.operators.rows import materialize

    spark = words.sparkSession
    clean = F.replace(F.col(word), F.lit(SEP), F.lit(""))
    spelled = F.concat(F.lit(SEP), F.array_join(chars(clean), SEP + SEP), F.lit(SEP))
    cur = materialize(words.where(F.length(clean) > 1).select(spelled.alias("w"), F.col(freq).cast("long").alias("freq")))
    merges: list[tuple] = []
    known: set[str] = set()
    rounds = pending = 0
    wide = CANDIDATES
    while len(merges) < num_merges:
        top = [tuple(r) for r in pair_counts(cur).orderBy(F.col("freq").desc(), "left", "right").limit(CANDIDATES).collect()]
        if not top:
            break
        wide, pieces = min(CANDIDATES, 2 * wide), None
        while True:
            floor = 0 if wide == CANDIDATES and len(top) < CANDIDATES else top[min(wide, len(top)) - 1][2]
            hot = [p for p in top if p[2] > floor]
            found = top[:1]
            if not hot or merges_per_round == 1:
                break
            pieces = _segments(cur if pieces is None else pieces, hot)
            got = pieces.limit(SEGMENTS + 1).collect()
            if len(got) <= SEGMENTS:
                found = certain_merges([(r.s.split(SEP), r.freq) for r in got], floor, min(merges_per_round, num_merges - len(merges)), known)
                break
            if wide == 1:
                break
            wide = max(1, wide // 4)
            whole = F.concat(F.lit(SEP), F.replace("s", F.lit(SEP), F.lit(SEP + SEP)), F.lit(SEP))
            pieces = materialize(pieces).select(whole.alias("w"), "freq")
        merges += [(len(merges) + k, left, right, int(n)) for k, (left, right, n) in enumerate(found)]
        known |= {left + right for left, right, _ in found}
        cur = _all_merged(cur, found)
        rounds, pending = rounds + 1, pending + len(found)
        if rounds % checkpoint_every == 0 or pending >= CANDIDATES // 32:
            cur, pending = materialize(cur.where(F.instr("w", SEP + SEP) > 0)), 0
    return spark.createDataFrame(merges, "rank int, left string, right string, freq long")


def vocabulary(merges: DataFrame, alphabet_df: DataFrame) -> DataFrame:
    """``(token, id)``: kept characters first (by frequency), then merged tokens by rank."""
    base = alphabet_df.where("kept").select(F.col("char").alias("token"), F.col("n").alias("_o1"),
                                            F.lit(0).alias("_grp"))
    merged = merges.select(F.concat("left", "right").alias("token"), (-F.col("rank")).alias("_o1"),
                           F.lit(1).alias("_grp"))
    u = base.unionByName(merged)
    w = Window.orderBy("_grp", F.col("_o1").desc(), "token")
    return u.select("token", (F.row_number().over(w) - 1).alias("id"))
