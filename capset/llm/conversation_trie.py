"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations are sorted by their turns (each a digest of role and text).  All that begin with one prefix are then
neighbours, and of two rows the common prefix is the least of the common prefixes between them.  A sparse table answers such
minima at once, so each prefix finds the left and the right end of its interval by two binary searches of its own;
the interval is its list of members, and counts over a subtree are differences of running sums.

Spark does it in bounded parts:

* A conversation is cut into slices of ``SLICE`` turns.  A slice is sorted behind a fingerprint of all turns before it, so no
  row holds more than a slice, however long the conversation is.
* The sorted slices are cut into blocks of ``1 << BLOCK_BITS`` rows, which also know their neighbours' next rows.  A prefix whose
  interval ends inside its block is done there.  Others are *open*: they are prefixes of a block's first or last row, so few,
  and their parts are summed under the prefix's hash.
* What later slices add to the subtrees of earlier ones is summed per conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capset.llm.common import SPACE, with_group_values
from capset.llm.ordered_hash import EMPTY, ordered_sha256
from capset.session import scratch_path

#: Turns of a slice; slices of a block, as a power of two.
SLICE, BLOCK_BITS = 256, 10
_KEY = 32  # characters of a turn's digest
_WORD = SPACE.replace("[", "[^", 1)


def numbered_turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, index`` (from 0, by turn, nulls first), ``key, words`` and ``n``, the conversation's turns.

    Sorted in ranges that may cut a conversation; what it has in the ranges before is added."""
    spark = rows.sparkSession
    by = ["conv", F.col("turn").asc_nulls_first(), "key", "_tie"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    turn = F.to_json(F.struct(F.coalesce(F.col(role_col), F.lit("")).alias("r"), text.alias("t")))
    narrow = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(F.encode(turn, "UTF-8"), 256), 1, _KEY).alias("key"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("_tie"))
    path = scratch_path(spark, "turns")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_pos", F.monotonically_increasing_id()) \
        .select("conv", "key", "words", "_pos").write.parquet(path)
    turns = spark.read.parquet(path).withColumn("_part", F.shiftright("_pos", 33))
    own = Window.partitionBy("conv")  # one row for each range that the conversation is in
    before = turns.groupBy("conv", "_part").agg(F.min("_pos").alias("_low"), F.count(F.lit(1)).alias("_n")).select(
        "conv", "_part", "_low", (F.sum("_n").over(own.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(own).alias("n"))
    return turns.join(before, ["conv", "_part"]).select(
        "conv", (F.col("_pos") - F.col("_low") + F.col("_before")).alias("index"), "key", "words", "n")


def rebuilt(turns: DataFrame, parent: Column, borrowed: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``) and their turns (``conv, depth`` from 1, ``key, words``) after rebuilding.

    Each begins with the first ``borrowed`` turns of conversation ``parent`` (expressions over ``conv``) and goes on with its own
    after as many.  The turns stay apart; only the few that are lent are joined, by rows that no conversation has many of."""
    convs = turns.where("index = 0").select("conv", "n").withColumns({"_from": parent, "_h": borrowed.cast("long")})
    lent = convs.select(F.col("conv").alias("_from"), F.col("n").alias("_has"))
    convs = convs.join(lent, "_from", "left").withColumn("_got", F.least("_h", F.coalesce("_has", F.lit(0).cast("long"))))
    most = convs.agg(F.max("_h")).first()[0] or 0
    heads = turns.where(F.col("index") < most).select(F.col("conv").alias("_from"), "index", "key", "words")
    lent = convs.join(heads, "_from").where("index < _h").select("conv", (F.col("index") + 1).alias("depth"), "key", "words")
    # own turns move by the difference of what was left out and what was put in; it is 0 but where too little was there
    moved = convs.where("_got != _h").select("conv", (F.col("_h") - F.col("_got")).alias("_less"))
    own = turns.withColumn("_h", borrowed.cast("long")).where("index >= _h").join(moved, "conv", "left").select(
        "conv", (F.col("index") + 1 - F.coalesce("_less", F.lit(0).cast("long"))).alias("depth"), "key", "words")
    return convs.select("conv"), lent.unionByName(own)


def slices(convs: DataFrame, turns: DataFrame, cut: int, bits: int) -> DataFrame:
    """``conv, k, p1, p2`` (fingerprint of the turns before slice ``k``), ``seq`` (its keys), ``words, more`` (does another follow);
    ``_pos`` rises in sorted order, ``_block`` counts the blocks."""
    spark = convs.sparkSession
    cut = turns.withColumn("k", F.floor((F.col("depth") - 1) / cut)).groupBy("conv", "k").agg(
        F.sort_array(F.collect_list(F.struct("depth", "key", "words"))).alias("_t"))  # at most ``cut`` of them
    cut = convs.join(cut, "conv", "left").select(
        "conv", F.coalesce("k", F.lit(0).cast("long")).alias("k"), F.coalesce(F.array_join("_t.key", ""), F.lit("")).alias("seq"),
        F.coalesce("_t.words", F.array().cast("array<long>")).alias("words"))
    digest = F.sha2(F.concat(F.col("k").cast("string"), F.lit(":"), "seq").cast("binary"), 256)
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    own = Window.partitionBy("conv").orderBy("k")  # one row for each slice of the conversation
    until = own.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    cut = cut.withColumns({"p1": F.coalesce(F.bit_xor(half(1)).over(until), zero), "p2": F.coalesce(F.bit_xor(half(16)).over(until), zero),
                           "more": F.lead("k").over(own).isNotNull()})
    by = ["k", "p1", "p2", "seq", "conv"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "slices")
    cut.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_pos", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumns({"_part": F.shiftright("_pos", 33), "_place": F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))})
    # blocks before each range: one row for each range
    sizes = rows.groupBy("_part").agg((F.shiftright(F.max("_place"), bits) + 1).alias("_blocks"))
    before = sizes.select("_part", (F.sum("_blocks").over(Window.orderBy("_part")) - F.col("_blocks")).alias("_before"))
    return rows.join(before, "_part").withColumn("_block", F.col("_before") + F.shiftright("_place", bits)).drop("_part", "_place", "_before")


def with_neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` and, marked by ``_side`` -1 and 1, each block's last row before and first row after it."""
    what = F.struct("k", "p1", "p2", "seq")
    ends = rows.groupBy("_block").agg(F.min_by(what, "_pos").alias("_first"), F.max_by(what, "_pos").alias("_last"))
    beside = ends.select((F.col("_block") + 1).alias("_block"), F.lit(-1).alias("_side"), "_last.*").unionByName(
        ends.select((F.col("_block") - 1).alias("_block"), F.lit(1).alias("_side"), "_first.*"))
    # no nulls: pandas would make floats of the numbers
    zero = F.lit(0).cast("long")
    return rows.withColumn("_side", F.lit(0)).unionByName(beside.withColumns(
        {"conv": zero, "_pos": zero, "words": F.array().cast("array<long>"), "more": F.lit(False)}))


class RangeMinimum:
    """Sparse table over ``values``: minima of all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of ``values[low:high + 1]``."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for n, table in enumerate(self.levels):
            at = np.flatnonzero(level == n)
            out[at] = np.minimum(table[low[at]], table[high[at] + 1 - (1 << n)])
        return out

    def reach(self, at: np.ndarray, least: np.ndarray, step: int) -> np.ndarray:
        """How many values from ``at`` on (to the right, or to the left for ``step`` -1) are ``least`` or more: a binary search."""
        n, got = len(self.levels[0]), np.zeros(len(at), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            run = 1 << level
            begin = at + got if step > 0 else at - got - run + 1
            fits = np.flatnonzero((begin >= 0) & (begin + run <= n))
            go = fits[self.levels[level][begin[fits]] >= least[fits]]
            got[go] += run
        return got


def _common(a: tuple, b: tuple) -> int:
    """Turns in common of two slices (k, p1, p2, seq); -1 if they don't follow the same turns."""
    if a[:3] != b[:3]:
        return -1
    x, y = (np.frombuffer(s[3].encode(), np.uint64) for s in (a, b))
    n = min(len(x), len(y))
    apart = np.flatnonzero(x[:n] != y[:n])
    return int(apart[0] if len(apart) else n) * 8 // _KEY


class Block:
    """The prefixes in a block, each at the first row of the block that has it: row ``I``, turns ``D``."""

    def __init__(self, df: pd.DataFrame, cut: int):
        self.cut, side = cut, df["_side"].to_numpy()
        own = df[side == 0].sort_values("_pos")
        self.rows, n = own, len(own)
        names = ["k", "p1", "p2", "seq"]
        seq = list(own[names].itertuples(index=False, name=None))
        beside = {s: next(df[side == s][names].itertuples(index=False, name=None), None) for s in (-1, 1)}
        self.seq, self.conv = seq, own["conv"].to_numpy(np.int64)
        chain = [beside[-1], *seq, beside[1]]
        # common prefix of each row with the one before it; the last of the next block's first row
        lcp = np.array([-1 if a is None or b is None else _common(a, b) for a, b in zip(chain, chain[1:], strict=False)], np.int64)
        self.length = np.array([len(s[3]) // _KEY for s in seq], np.int64)
        shared = lcp[:-1].copy()
        shared[0] = -1
        self.count = self.length - shared
        self.base = np.cumsum(self.count) - self.count
        self.I = np.repeat(np.arange(n), self.count)  # noqa: E741
        self.D = np.arange(len(self.I)) - self.base[self.I] + shared[self.I] + 1
        between = RangeMinimum(lcp[1:-1])
        left = self.I - between.reach(self.I - 1, self.D, -1)
        self.R = self.I + between.reach(self.I, self.D, 1)
        assert (left == self.I).all()
        # the prefix that is one turn shorter: on the same row, or where its interval begins
        self.parent = np.arange(len(self.I)) - 1
        first = self.base[(self.count > 0) & (shared >= 0)]
        begin = self.I[first] - between.reach(self.I[first] - 1, self.D[first] - 1, -1)
        self.parent[first] = self.base[begin] + self.D[first] - 1 - shared[begin] - 1
        self.parent[self.D == 0] = -1
        before = (self.I == 0) & (self.D <= lcp[0])  # begins in an earlier block
        self.starts = ~before
        self.open = before | ((self.R == n - 1) & (self.D <= lcp[-1]))
        self.n = self.R - self.I + 1
        self.low = RangeMinimum(self.conv).least(self.I, self.R)
        counted = self.starts & (self.D > 0)
        self.children = np.bincount(self.parent[counted], minlength=len(self.I)).astype(np.int64)
        more = np.concatenate([[0], np.cumsum(own["more"].to_numpy().astype(np.int64))])
        self.more = more[self.R + 1] - more[self.I]
        words = np.concatenate([np.zeros(0, np.int64), *own["words"]]).astype(np.int64)
        at = np.cumsum(self.length) - self.length
        self.words = np.where(self.D > 0, np.append(words, 0)[at[self.I] + self.D - 1], 0)
        self.k = own["k"].to_numpy(np.int64)[self.I]
        self.extra = [np.zeros(n, np.int64), np.zeros(n, np.int64)]  # of a row's later slices

    def name(self, node: int) -> str:
        k, p1, p2, seq = self.seq[self.I[node]]
        return f"{k}:{p1}:{p2}:{hashlib.sha256(seq[:int(self.D[node]) * _KEY].encode()).hexdigest()}"

    def link(self, node: int) -> str | None:
        """Where slices meet: the fingerprint of the prefix, for those that end a slice and go on, and for those that begin one."""
        k, p1, p2, seq = self.seq[self.I[node]]
        if k and not self.D[node]:
            return f"{k}:{p1}:{p2}"
        if self.D[node] == self.cut and self.more[node]:
            h = hashlib.sha256(f"{k}:{seq}".encode()).hexdigest()
            return f"{k + 1}:{p1 ^ int(h[:15], 16)}:{p2 ^ int(h[15:30], 16)}"
        return None

    def learn(self, known: pd.DataFrame) -> None:
        """Whole counts of the open prefixes, and what later slices add to rows (those without a name)."""
        whole = {r.name: r for r in known.itertuples(index=False) if r.name}
        for node in np.flatnonzero(self.open).tolist():
            r = whole[self.name(node)]
            self.n[node], self.low[node], self.children[node], self.more[node] = r.n, r.low, r.children, r.more
        at = {p: i for i, p in enumerate(self.rows["_pos"].tolist())}
        for r in known.itertuples(index=False):
            if not r.name:
                self.extra[0][at[r.low]], self.extra[1][at[r.low]] = r.n, r.children

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and saved tokens of what begins in this block, for each prefix's subtree; and by row."""
        leaf = (self.starts & (self.children == 0) & (self.more == 0)).astype(np.int64)
        saved = np.where(self.starts, (self.n - 1) * self.words, 0)
        end, out = self.base + self.count, []
        self.by_row = []
        for v, extra in ((leaf, self.extra[0]), (saved, self.extra[1])):
            run, more = np.concatenate([[0], np.cumsum(v)]), np.concatenate([[0], np.cumsum(extra)])
            self.by_row.append(run[end] - run[self.base])
            # a subtree is one run of prefixes, and whole rows' later slices
            out.append(run[end[self.R]] - run[:-1] + more[self.R + 1] - more[self.I])
        return out[0], out[1]

    def ends(self) -> dict[int, list[int]]:
        """Members without another turn, in order, by prefix."""
        out: dict[int, list[int]] = {}
        # a row's longest prefix; a row without one of its own repeats the row before
        whole = np.maximum.accumulate(np.where(self.count > 0, self.base + self.count - 1, -1))
        for i in np.flatnonzero(~self.rows["more"].to_numpy().astype(bool)).tolist():
            out.setdefault(int(whole[i]), []).append(int(self.conv[i]))
        return out


_OPEN = "name string, _block long, depth long, n long, low long, children long, more long, first long, last long, conv long"
_NODE = ("name string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, first long, last long, begins boolean, link string, up string")


def _columns(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def open_parts(df: pd.DataFrame, cut: int) -> pd.DataFrame:
    """Parts of the open prefixes of a block, and (with ``conv``) the members that end at one."""
    out = []
    if (df["_side"] == 0).any():
        b = Block(df, cut)
        number, pos = int(b.rows["_block"].iloc[0]), b.rows["_pos"].to_numpy()
        names = {node: b.name(node) for node in np.flatnonzero(b.open).tolist()}
        for node, name in names.items():
            out.append((name, number, int(b.k[node]) * cut + int(b.D[node]), int(b.n[node]), int(b.low[node]), int(b.children[node]),
                        int(b.more[node]), int(pos[b.I[node]]), int(pos[b.R[node]]), None))
        out += [(names[node], number, *[None] * 7, c) for node, convs in b.ends().items() if node in names for c in convs]
    return pd.DataFrame(out, columns=_columns(_OPEN), dtype=object)


def row_sums(df: pd.DataFrame, known: pd.DataFrame, cut: int) -> pd.DataFrame:
    """What the rows of conversations of several slices begin: leaves and saved tokens."""
    columns = ["conv", "k", "_block", "_pos", "leaves", "saved"]
    own = df[df["_side"] == 0]
    if not len(own) or not (own["more"] | (own["k"] > 0)).any():
        return pd.DataFrame(columns=columns, dtype="int64")
    b = Block(df, cut)
    b.learn(known)
    b.sums()
    out = b.rows.assign(leaves=b.by_row[0], saved=b.by_row[1])
    return out[out["more"] | (out["k"] > 0)][columns]


def nodes_of(df: pd.DataFrame, known: pd.DataFrame, cut: int) -> pd.DataFrame:
    """The prefixes of a block; of open ones (with a name) the sums are parts."""
    if not (df["_side"] == 0).any():
        return pd.DataFrame(columns=_columns(_NODE), dtype=object)
    b = Block(df, cut)
    b.learn(known)
    leaves, saved = b.sums()
    ends, pos, n = b.ends(), b.rows["_pos"].to_numpy(), len(b.I)
    name, sha = np.full(n, None, object), np.full(n, EMPTY, object)
    for node in np.flatnonzero(b.open).tolist():
        name[node], sha[node] = b.name(node), None
    for node, convs in ends.items():
        if not b.open[node]:
            sha[node] = hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest()
    begins = (b.D == 0) & (b.k > 0)
    link, up = np.full(n, None, object), np.full(n, None, object)
    for node in np.flatnonzero(begins | ((b.D == cut) & (b.more > 0))).tolist():
        link[node] = b.link(node)
    for node in np.flatnonzero((b.D == 1) & (b.k > 0)).tolist():
        up[node] = b.link(int(b.parent[node]))
    parent = pd.Series(b.low[b.parent], dtype="Int64").where(pd.Series(b.D > 0))
    return pd.DataFrame({
        "name": name, "conv_id": b.low, "depth": b.k * cut + b.D, "parent_conv_id": parent, "n_convs": b.n, "n_children": b.children,
        "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": sha, "first": pos[b.I], "last": pos[b.R], "begins": begins, "link": link, "up": up})


def prefix_trie(rows: DataFrame, parent: Column | None = None, borrowed: Column | None = None, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                cut: int = SLICE, bits: int = BLOCK_BITS) -> DataFrame:
    """One row for each distinct prefix of conversations: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``, and ``first, last``: the interval of its members in the sorted order.

    ``parent`` and ``borrowed`` (expressions over ``conv``) rebuild conversations before, see ``rebuilt``; ``cut`` turns make a
    slice, two to the ``bits`` slices a block (neither changes the result).  Turns go by
    ``turn`` (nulls first), turns of one number by a hash of role and text.  A null role or text is empty; rows
    without a conversation belong to none and are left out.  Ids are integers.  A repeated row is a turn
    more.  Conversations without turns are members of the root.  Other columns are not read; an empty table gives an empty result.
    """
    spark = rows.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    turns = kept(numbered_turns(rows, conv_col, turn_col, role_col, text_col), "numbered")
    convs, turns = rebuilt(turns, F.lit(None).cast("long") if parent is None else parent, F.lit(0) if borrowed is None else borrowed)
    blocks = with_neighbours(slices(convs, turns, cut, bits))
    parts = kept(blocks.groupBy("_block").applyInPandas(lambda df: open_parts(df, cut), _OPEN), "open")
    part = parts.where("conv is null").select("name", "_block", *[F.col(c).alias(f"_{c}") for c in ("n", "low", "children", "more")])
    add = {c: F.sum for c in ("n", "children", "more")} | {"low": F.min}
    known = with_group_values(part, ["name"], F.col("_block"), {f"{c}_": f(f"_{c}") for c, f in add.items()},
                              {c: f(f"{c}_") for c, f in add.items()}).select("_block", "name", "n", "low", "children", "more")
    known = kept(known, "known")
    sums = blocks.groupBy("_block").cogroup(known.groupBy("_block")).applyInPandas(
        lambda df, more: row_sums(df, more, cut), "conv long, k long, _block long, _pos long, leaves long, saved long")
    later = Window.partitionBy("conv").orderBy("k").rowsBetween(1, Window.unboundedFollowing)  # one row for each slice
    later = sums.select("_block", F.lit("").alias("name"), F.sum("leaves").over(later).alias("n"), F.col("_pos").alias("low"),
                        F.sum("saved").over(later).alias("children"), F.lit(0).cast("long").alias("more")).where("n is not null")
    nodes = kept(blocks.groupBy("_block").cogroup(known.unionByName(later).groupBy("_block")).applyInPandas(
        lambda df, more: nodes_of(df, more, cut), _NODE), "nodes")
    hashes = ordered_sha256(parts.where("conv is not null"), F.col("name"), ["conv"], F.col("conv").cast("string"), ",")
    same = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "begins", "link", "up"]
    whole = nodes.where("name is not null").groupBy("name").agg(
        *[F.max(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")], F.min("first").alias("first"),
        F.max("last").alias("last")).join(hashes, F.col("name") == F.col("_key"), "left").withColumn(
        "ends_sha256", F.coalesce("sha256", F.lit(EMPTY)))
    columns = [c for c in _columns(_NODE) if c != "name"]
    found = nodes.where("name is null").select(columns).unionByName(whole.select(columns))
    # where slices meet: a prefix that ends one has the children of the one that follows, whose first prefixes it is the parent of
    follow = found.where("begins").select("link", F.col("n_children").alias("_children"))
    meet = found.where("not begins and link is not null")
    meet = meet.join(follow, "link").withColumn("n_children", F.col("_children"))
    above = meet.select(F.col("link").alias("up"), F.col("conv_id").alias("_parent"))
    plain = found.where("not begins and link is null").unionByName(meet.select(columns))
    lifted = plain.where("up is not null").join(above, "up").withColumn("parent_conv_id", F.col("_parent"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "first", "last"]
    return plain.where("up is null").select(out).unionByName(lifted.select(out))
