"""Conversation structure repair by a generalised LR parser.

The roles of a conversation are parsed by the grammar of ``PRODUCTIONS``: an optional system turn, then pairs of a user and an
assistant turn.  A turn may be kept, given another role or deleted, and an empty turn may be inserted; each
has its weight.  The parser follows all choices at once: stacks share their nodes, and of stacks with an equal
top (which have the same future in this grammar) the one of least ``(cost, audit)`` goes on, where the audit
spells the edits so far.

Spark does it in bounded parts.  Turns are sorted into ranges that also cut through one conversation, and cut into
blocks of ``1 << BLOCK_BITS`` turns.  A block whose first conversation began before is parsed from every top that a
stack can have; such parts are joined like distances, (top before, top after) by least cost, audit.  No task
holds a conversation's texts; its audit, which is a value of the result, is the longest thing in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import groupby
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.session import scratch_path

#: Left side, right side.  ``s``, ``u``, ``a`` are initials of roles.
PRODUCTIONS = [("Start", "C"), ("C", ""), ("C", "HT"), ("H", ""), ("H", "s"), ("T", "P"), ("T", "TP"), ("P", "ua")]
TERMINALS, END = "sua", "$"
#: Roles that a turn can be given, by initial.
ROLES = {"u": "user", "a": "assistant"}
KEEP, DELETE, REROLE, INSERT, TRUNCATED = 0, 3, 2, 2, 1
#: Turns of a block, as a power of two.
BLOCK_BITS = 10
_SPACE = " \u0009\u000A\u000B\u000C\u000D"


class Stack(NamedTuple):
    """A node of the graph-structured stack: an LR state on what lies below."""

    state: int
    below: Stack | None


class Tables:
    """SLR(1) tables of ``PRODUCTIONS``, built from the grammar."""

    def __init__(self):
        heads = {head for head, _ in PRODUCTIONS}
        nullable: set[str] = set()
        first = {h: set() for h in heads} | {t: {t} for t in TERMINALS}
        follow = {h: {END} if h == "Start" else set() for h in heads}
        while True:  # to a fixed point
            before = len(nullable) + sum(map(len, first.values())) + sum(map(len, follow.values()))
            for head, body in PRODUCTIONS:
                if all(x in nullable for x in body):
                    nullable.add(head)
                for x in body:
                    first[head] |= first[x]
                    if x not in nullable:
                        break
                after = set(follow[head])
                for x in reversed(body):
                    if x in heads:
                        follow[x] |= after
                    after = (after if x in nullable else set()) | first[x]
            if before == len(nullable) + sum(map(len, first.values())) + sum(map(len, follow.values())):
                break
        start = self._closure({(0, 0)}, heads)
        states, self.shift, self.reduce = [start], {}, {}
        for n, items in enumerate(states):
            for x in {PRODUCTIONS[p][1][d] for p, d in items if d < len(PRODUCTIONS[p][1])}:
                into = self._closure({(p, d + 1) for p, d in items if PRODUCTIONS[p][1][d:d + 1] == x}, heads)
                if into not in states:
                    states.append(into)
                self.shift[n, x] = states.index(into)
            for p, d in items:
                if d == len(PRODUCTIONS[p][1]):
                    for x in follow[PRODUCTIONS[p][0]]:
                        self.reduce.setdefault((n, x), []).append(p)

    @staticmethod
    def _closure(items: set, heads: set) -> frozenset:
        todo = list(items)
        while todo:
            p, d = todo.pop()
            x = PRODUCTIONS[p][1][d:d + 1]
            new = {(q, 0) for q, (head, _) in enumerate(PRODUCTIONS) if x and x in heads and head == x} - items
            items |= new
            todo += new
        return frozenset(items)


@cache
def tables() -> Tables:
    return Tables()


@cache
def advance(stack: Stack, symbol: str) -> tuple[Stack, ...]:
    """The stacks after all reductions that ``symbol`` allows and its shift; at the end, those that accept."""
    t, out, todo = tables(), [], [stack]
    while todo:
        s = todo.pop()
        for p in t.reduce.get((s.state, symbol), ()):
            head, body = PRODUCTIONS[p]
            if head == "Start":
                out.append(s)
                continue
            low = s
            for _ in body:
                low = low.below
            todo.append(Stack(t.shift[low.state, head], low))
        if (s.state, symbol) in t.shift:
            out.append(Stack(t.shift[s.state, symbol], s))
    return tuple(out)


@cache
def tops() -> tuple[Stack, ...]:
    """A stack for each top that a parse can have, the empty parse first."""
    found, todo = {}, [Stack(0, None)]
    while todo:
        s = todo.pop(0)
        if s.state not in found:
            found[s.state] = s
            todo += [n for x in TERMINALS for n in advance(s, x)]
    return tuple(found.values())


#: Frontier of a parse: stack to (cost, audit), one stack for each top.
Frontier = dict[int, tuple[int, str, Stack]]


def _put(frontier: Frontier, stack: Stack, cost: int, audit: str) -> bool:
    old = frontier.get(stack.state)
    if old is None or (cost, audit) < old[:2]:
        frontier[stack.state] = (cost, audit, stack)
        return True
    return False


def with_inserts(frontier: Frontier) -> Frontier:
    out, todo = dict(frontier), list(frontier)
    while todo:
        cost, audit, stack = out[todo.pop()]
        for x in ROLES:
            todo += [n.state for n in advance(stack, x) if _put(out, n, cost + INSERT, audit + "I")]
    return out


def parse_turn(frontier: Frontier, initial: str, must_go: bool, extra: int) -> Frontier:
    """One turn more.  Audits after a turn never begin each other, so comparing them now is comparing them at the end."""
    out: Frontier = {}
    for cost, audit, stack in with_inserts(frontier).values():
        _put(out, stack, cost + DELETE, audit + "D")
        if not must_go:
            if initial in TERMINALS:
                for n in advance(stack, initial):
                    _put(out, n, cost + KEEP + extra, audit + "K")
            for x in ROLES:
                for n in advance(stack, x):
                    _put(out, n, cost + REROLE + extra, audit + "R")
    return out


def edits_of(start: Stack, audit: str, initials: list[str]) -> Iterator[tuple[int, int, str, str | None]]:
    """(turn, step, edit, new role) of an audit of the turns; inserts take the number of the turn they precede, or of the last."""
    turn, step, stack = 0, 0, start
    for edit in audit:
        if edit in "IR":
            x, n = next((x, n) for x in ROLES for n in advance(stack, x))
        elif edit == "K":
            x, n = initials[turn], advance(stack, initials[turn])[0]
        else:
            x, n = None, stack
        stack = n
        yield (turn, step, edit, ROLES[x] if edit in "IR" else None) if turn < len(initials) else (len(initials) - 1, step + 1000, edit, ROLES[x])
        turn, step = (turn, step + 1) if edit == "I" else (turn + 1, 0)


def blank(text: Column) -> Column:
    return F.length(F.trim(text, F.lit(_SPACE))) == 0


def sorted_turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``_pos`` (rises through the whole order), ``conv, turn, role, text``, written to the scratch folder and read again.

    Turns are dealt by ranges of (conversation, turn, role, text's hash, place in the input), so a conversation, or rows that
    are all alike, can span many tasks."""
    spark = rows.sparkSession
    by = ["conv", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "_tie"]
    named = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("_tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "turns")
    named.repartitionByRange(parts, *by).sortWithinPartitions(*by) \
        .withColumn("_pos", F.monotonically_increasing_id()).drop("_tie").write.parquet(path)
    return spark.read.parquet(path)


def with_faults(turns: DataFrame) -> DataFrame:
    """Narrow rows: ``_pos, _block, conv, turn, initial, fault`` (blank, duplicate, truncated or empty); no texts."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(_SPACE)), -1, 1)
    narrow = turns.select("_pos", "conv", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"),
                          F.sha2(F.encode(F.to_json(F.struct("role", "text")), "UTF-8"), 256).alias("_digest"),
                          blank(F.col("text")).alias("_blank"), last.isin(".", "!", "?").alias("_ends"))
    # the first of equal turns, by partial aggregates; back to the rows by their unique place, so no key is hot
    first = narrow.groupBy("conv", "_digest").agg(F.min("_pos").alias("_pos")).select("_pos", F.lit(True).alias("_first"))
    fault = F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(~F.col("_ends"), "truncated").otherwise("")
    return narrow.join(first, "_pos", "left").select(
        "_pos", F.shiftright("_pos", BLOCK_BITS).alias("_block"), F.col("conv").cast("string").alias("conv"),
        F.col("turn").cast("string").alias("turn"), "initial", fault.alias("fault"))


_PART = ("conv string, _block long, tops array<int>, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, "
         "illegal long, first string, last string, low string, high string, turns long")
_FAULTS = ("blank", "duplicate", "truncated")


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _conversations(df: pd.DataFrame) -> Iterator[tuple[str | None, pd.DataFrame]]:
    """The runs of equal ``conv`` of sorted rows; null is a conversation too."""
    names = df["conv"].tolist()
    at = 0
    for name, run in groupby(names, key=lambda x: x if isinstance(x, str) else None):
        n = len(list(run))
        yield name, df.iloc[at:at + n]
        at += n


def parse_block(df: pd.DataFrame) -> pd.DataFrame:
    """Parts of the conversations of a block: least (cost, audit) from tops to tops, faults, and what joining parts takes."""
    out = []
    df = df.sort_values("_pos")
    for n, (conv, own) in enumerate(_conversations(df)):
        initials, faults = own["initial"].tolist(), own["fault"].tolist()
        pairs, costs, audits = [], [], []
        # only the block's first conversation can have begun before
        for start in (tops() if n == 0 else tops()[:1]):
            frontier: Frontier = {start.state: (0, "", start)}
            for i, f in zip(initials, faults, strict=True):
                frontier = parse_turn(frontier, i, f in ("blank", "duplicate"), TRUNCATED if f == "truncated" else 0)
            for state, (cost, audit, _) in frontier.items():
                pairs += [start.state, state]
                costs.append(cost)
                audits.append(audit)
        turns = [int(t) for t in own["turn"] if isinstance(t, str)]
        out.append((conv, int(own["_block"].iloc[0]), pairs, costs, audits, *(faults.count(f) for f in _FAULTS),
                    sum(not _legal(a, b) for a, b in zip(initials, initials[1:], strict=False)), initials[0], initials[-1],
                    str(turns[0]) if turns else None, str(turns[-1]) if turns else None, len(set(turns))))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in _PART.split(", ")])


class _Joined:
    """A conversation's parts joined so far: for each top least cost, its rank among the audits, and the way there."""

    def __init__(self, conv: str | None):
        self.conv, self.blocks = conv, []
        self.now = {tops()[0].state: (0, 0)}
        self.ways: list[dict[int, tuple[int, str]]] = []  # for each part: top after it to (top before, audit)
        self.counts, self.last, self.low, self.high, self.turns = [0, 0, 0, 0], None, None, None, 0

    def add(self, part) -> None:
        ways: dict[int, tuple] = {}
        for (x, y), cost, audit in zip(zip(part.tops[::2], part.tops[1::2], strict=True), part.costs, part.audits, strict=True):
            if x in self.now:
                new = (self.now[x][0] + int(cost), self.now[x][1], audit, int(x))
                ways[int(y)] = min(ways.get(int(y), new), new)
        order = sorted(ways, key=lambda y: ways[y][1:3])
        self.now = {y: (ways[y][0], order.index(y)) for y in ways}
        self.ways.append({y: (w[3], w[2]) for y, w in ways.items()})
        self.blocks.append(int(part.block))
        own = [int(part.blank), int(part.duplicate), int(part.truncated), int(part.illegal)]
        own[3] += self.last is not None and not _legal(self.last, part.first)
        self.counts = [a + b for a, b in zip(self.counts, own, strict=True)]
        self.last = part.last
        if isinstance(part.low, str):
            self.turns += int(part.turns) - (self.high == int(part.low))
            self.low = int(part.low) if self.low is None else self.low
            self.high = int(part.high)

    def rows(self) -> Iterator[tuple]:
        """The report (block null) and each block's part of the best audit with the top before it."""
        stacks = {s.state: s for s in tops()}
        best = None
        for top, (cost, rank) in self.now.items():
            for c, tail, stack in with_inserts({top: (cost, "", stacks[top])}).values():
                if advance(stack, END):
                    best = min(best or (c, rank, tail, top), (c, rank, tail, top))
        cost, _, tail, top = best
        pieces = []
        for ways in reversed(self.ways):
            before, audit = ways[top]
            pieces.append((before, audit + tail))
            top, tail = before, ""
        pieces.reverse()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        yield (self.conv, None, None, "".join(a for _, a in pieces), gaps, *self.counts, cost)
        for block, (before, audit) in zip(self.blocks, pieces, strict=True):
            yield (self.conv, block, before, audit, *[None] * 6)


_REPORT = ["gaps", *_FAULTS, "illegal", "cost"]


def join_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and block; one conversation at a time."""
    columns = ["conv", "_block", "top", "audit", *_REPORT]
    joined, out, size = None, [], 0

    def frame():
        return pd.DataFrame(out, columns=columns, dtype=object)

    for df in batches:
        for part in df.itertuples(index=False, name=None):
            part = _Part(*part)
            conv = part.conv if isinstance(part.conv, str) else None
            if joined is None or joined.conv != conv:
                if joined:
                    for row in joined.rows():
                        out.append(row)
                        size += len(row[3])
                joined = _Joined(conv)
            joined.add(part)
            if size > 1 << 22:
                yield frame()
                out, size = [], 0
    if joined:
        out += joined.rows()
    if out:
        yield frame()


_Part = NamedTuple("_Part", [(c.split(" ")[0].replace("_block", "block"), object) for c in _PART.split(", ")])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The report, one row a conversation, and the edits, in order, one row for each.

    Report: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.  Edits: ``conv_id, place, step`` (their order),
    ``edit`` (K, R, D, I), ``fault``, ``turn, role, text`` as they are after it; those without ``D`` are the repaired conversation.

    Turns go by ``turn`` (nulls first), turns of one number by role and a hash of the text, equal rows one after the
    other.  A null conversation is one too; a null role or text is one blank, so such a text is a blank one.  Roles
    that begin with another letter than the grammar's, or are empty, can't be kept.  Turns are integers.  Other columns are not
    read; an empty table gives two empty results.
    """
    spark = rows.sparkSession
    kind = rows.schema[conv_col].dataType
    turns = sorted_turns(rows, conv_col, turn_col, role_col, text_col)
    narrow = with_faults(turns)
    path = scratch_path(spark, "faults")
    narrow.write.parquet(path)
    narrow = spark.read.parquet(path)
    parts = narrow.groupBy("_block").applyInPandas(parse_block, _PART)
    best = parts.repartition("conv").sortWithinPartitions("conv", "_block").mapInPandas(
        join_parts, "conv string, _block long, top int, audit string, " + ", ".join(f"{c} long" for c in _REPORT))
    path = scratch_path(spark, "audits")
    best.write.parquet(path)
    best = spark.read.parquet(path)
    report = best.where("_block is null").select(F.col("conv").cast(kind).alias("conv_id"), *_REPORT, "audit")

    def apply(own: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
        stacks, out = {s.state: s for s in tops()}, []
        audits = {c if isinstance(c, str) else None: (t, a) for c, t, a in zip(pieces["conv"], pieces["top"], pieces["audit"], strict=True)}
        for conv, turns_ in _conversations(own.sort_values("_pos")):
            top, audit = audits[conv]
            places, faults = turns_["_pos"].tolist(), turns_["fault"].tolist()
            for turn, step, edit, role in edits_of(stacks[int(top)], audit, turns_["initial"].tolist()):
                out.append((places[turn], step, edit, role, faults[turn] if edit != "I" else ""))
        return pd.DataFrame(out, columns=["_pos", "step", "edit", "_role", "fault"])

    made = narrow.groupBy("_block").cogroup(best.where("_block is not null").groupBy("_block")).applyInPandas(
        apply, "_pos long, step int, edit string, _role string, fault string")
    inserted = F.col("edit") == "I"
    edits = made.join(turns, "_pos").select(
        F.col("conv").alias("conv_id"), F.col("_pos").alias("place"), "step", "edit", "fault", F.when(~inserted, F.col("turn")).alias("turn"),
        F.coalesce("_role", "role").alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    return report, edits


def damage(rows: DataFrame) -> DataFrame:
    """Turns with the faults of the contract, chosen by a checksum of conversation and turn; nulls count as one blank."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat_ws(":", part("conv_id"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("_what") == 1, "").when(F.col("_what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), what.alias("_what")).where("_what != 0").select(
        "conv_id", "turn", F.when(F.col("_what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
