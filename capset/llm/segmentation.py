"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The lattice of a text holds every way to spell it in pieces; a path's probability is proportional to the
product of its pieces' probabilities.  A perturbed best-first (A-star) search emits the ``k`` paths of
largest perturbed log-probability, which is a sample without replacement:

* A node of the search is a prefix with some next edges excluded; its key is the largest Gumbel-perturbed
  log-probability among its paths, which needs only the total probability of those paths.
* The best node is completed by drawing edges from their exact conditional probabilities (backward sums
  of the lattice).  Each step leaves a node with the other edges, whose key is a Gumbel truncated at
  the parent's key.
* Of the nodes that a path leaves, only the ``k`` best can come up again.

Units (words) that no piece crosses have lattices of their own, built once per distinct unit by numpy;
all units of many texts draw their edges in step.  Random numbers are hashes of the row's key, the unit, the
step and the sample, so reruns and other partitions give the same pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.llm.vocabulary import Vocabulary

_UNITS = 160_000  # distinct units whose lattices a worker keeps
_REST = 1 << 15  # of these, those that stay from task to task: half of it, the most frequent
_GROUP = 1 << 19  # characters whose units are drawn in step
_REACH = 37.0  # -log(-log(u)) is less for every such u
_DRAW = 1 << 32  # apart from the other uses of the hashes
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _hashes(key: np.ndarray, *more: int | np.ndarray) -> np.ndarray:
    h = np.asarray(key, np.uint64)
    with np.errstate(over="ignore"):
        for m in more:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.asarray(m, np.uint64) + np.uint64(1))
    return h


def _uniform(h: np.ndarray) -> np.ndarray:
    """Of 52 bits, in (0, 1)."""
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


def log_probabilities(vocabulary: Vocabulary, offset: float = 10.0) -> np.ndarray:
    """By Zipf's law on the rank of a piece in the file; bytes share what the rank after the last has."""
    logp = np.full(vocabulary.size, -np.inf)
    ids = np.array(sorted(vocabulary.pieces.values()))
    logp[ids] = -np.log(np.arange(len(ids)) + offset)
    logp[vocabulary.bytes] = -np.log(len(ids) + offset) - 2.0
    return logp - np.logaddexp.reduce(logp[np.isfinite(logp)])


class _Column:
    """An array that grows by a quarter."""

    def __init__(self, kind: type):
        self.all, self.n = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.all):
            grown = np.zeros(max(self.n + len(more), len(self.all) * 5 // 4), self.all.dtype)
            grown[:self.n] = self.all[:self.n]
            self.all = grown
        self.all[self.n:self.n + len(more)] = more
        self.n += len(more)


class Lattices:
    """Lattices of distinct units: for each position its edges (piece, next position, probabilities)."""

    def __init__(self, vocabulary: Vocabulary, logp: np.ndarray):
        self.v, self.logp = vocabulary, logp
        symbols = sorted(vocabulary.chars)
        self.symbol = {c: 256 + i for i, c in enumerate(symbols)}  # 0 to 255 are bytes
        self.alphabet = 256 + len(symbols)
        self.of_code = np.full(0x110000, -1, np.int32)
        for c, s in self.symbol.items():
            self.of_code[ord(c)] = s
        child, piece = {}, [-1]
        strings = [([self.symbol[c] for c in p], i) for p, i in vocabulary.pieces.items()]
        # characters that occur in pieces only with others are spelled in bytes
        alone = {p for p in vocabulary.pieces if len(p) == 1}
        for c in vocabulary.chars - alone:
            self.of_code[ord(c)] = -1
        strings = [(s, i) for s, i in strings if all(symbols[x - 256] in alone for x in s)]
        for s, i in [*strings, *(([b], i) for b, i in enumerate(vocabulary.bytes))]:
            node = 0
            for x in s:
                node = child.setdefault(node * self.alphabet + x, len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = i
        keys = np.array(sorted(child), np.int64)
        self.keys, self.child, self.piece = keys, np.array([child[k] for k in keys.tolist()]), np.array(piece)
        first = np.zeros(self.alphabet, np.int64)
        for x in range(self.alphabet):
            first[x] = child.get(x, 0)
        self.first = first
        self.longest = max(len(s) for s, _ in strings) if strings else 1
        self.clear()

    def clear(self) -> None:
        self.number, self.seen = _Numbers(), np.zeros(0, np.int64)
        self._columns = {"base": _Column(np.int32), "last": _Column(bool), "edges": _Column(np.int32),
                         "to": _Column(np.int32), "id": _Column(np.int32), "cdf": _Column(np.float32), "cond": _Column(np.float64)}
        self._columns["edges"].add(np.zeros(1, np.int32))
        self._show()

    def _show(self) -> None:
        for name, column in self._columns.items():
            # base: first position of a unit; last: is the position a unit's end; edges: where a position's
            # edges begin; of an edge: next position, piece, cumulative and log conditional probability
            setattr(self, name, column.all[:column.n])

    def add_new(self) -> None:
        """Build the lattices of the units that were looked up first since the last call."""
        units, self.number.new = self.number.new, []
        if not units:
            return
        text = "".join(units)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sym, length = self.of_code[code], np.fromiter(map(len, units), np.int64, len(units))
        if (sym < 0).any():  # spell unknown characters in bytes
            spelled = [[s] if s >= 0 else list(chr(c).encode("utf-8", "surrogatepass")) for s, c in zip(sym.tolist(), code.tolist(), strict=True)]
            n = np.fromiter(map(len, spelled), np.int64, len(spelled))
            own = np.repeat(np.arange(len(units)), length)
            length = np.bincount(own, weights=n, minlength=len(units)).astype(np.int64)
            sym = np.array([x for s in spelled for x in s], np.int32)
        sym = sym.astype(np.int64)
        # positions: one more than symbols in each unit
        base = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        total = int((length + 1).sum())
        place = np.arange(len(sym)) + np.repeat(np.arange(len(units)), length)
        left = np.zeros(total, np.int64)  # symbols up to the unit's end
        left[place] = np.repeat(length, length) - (place - np.repeat(base, length))
        at_sym = np.zeros(total, np.int64)
        at_sym[place] = sym
        pos, node = place, self.first[sym]
        frm, size, ids = [], [], []
        for n in range(1, self.longest + 1):
            here = self.piece[node] >= 0
            frm.append(pos[here])
            size.append(np.full(int(here.sum()), n))
            ids.append(self.piece[node[here]])
            go = left[pos] > n
            pos, node = pos[go], node[go]
            if not len(pos):
                break
            key = node * self.alphabet + at_sym[pos + n]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[k] == key
            pos, node = pos[hit], self.child[k[hit]]
            if not len(pos):
                break
        # longest first: they are mostly the likeliest, and a draw looks at the edges in turn
        frm, size, ids = np.concatenate(frm[::-1]), np.concatenate(size[::-1]), np.concatenate(ids[::-1])
        # edges of a position together: the lists of each length are sorted already, so this is a merge
        order = np.argsort(frm, kind="stable")
        frm, size, ids = frm[order], size[order], ids[order]
        raw, to = self.logp[ids], frm + size
        count = np.bincount(frm, minlength=total)
        begin = np.concatenate([[0], np.cumsum(count)])
        # backward sums by the number of symbols that are left, from the ends on
        inner = np.flatnonzero(left)
        inner = inner[np.argsort(left[inner].astype(np.uint16) if left.max() < 1 << 16 else left[inner], kind="stable")]
        n = count[inner]
        ahead = np.cumsum(n) - n
        turn = np.arange(int(n.sum())) + np.repeat(begin[inner] - ahead, n)
        level = np.flatnonzero(np.diff(left[inner], prepend=0))
        beta = np.zeros(total)
        for a, b in zip(level, [*level[1:], len(inner)], strict=True):
            lo, hi = ahead[a], ahead[b - 1] + n[b - 1]
            e = turn[lo:hi]
            beta[inner[a:b]] = np.logaddexp.reduceat(raw[e] + beta[to[e]], ahead[a:b] - lo)
        weight = raw + beta[to] - beta[frm]
        run = np.cumsum(np.exp(weight))
        cdf = run - np.repeat(np.concatenate([[0.0], run])[begin[:-1]], count)
        cdf[begin[1:][count > 0] - 1] = 2.0  # the last edge takes what rounding leaves
        last = np.zeros(total, bool)
        last[base + length] = True
        c = self._columns
        shift, eshift = c["last"].n, c["to"].n
        for name, more in (("base", base + shift), ("last", last), ("edges", begin[1:] + eshift), ("to", to + shift),
                           ("id", ids), ("cdf", cdf), ("cond", weight)):
            c[name].add(more)
        self._show()

    def met(self, units: np.ndarray) -> None:
        """Count how often units occur."""
        seen = np.bincount(units, minlength=len(self.number))
        seen[:len(self.seen)] += self.seen
        self.seen = seen

    def trim(self, limit: int) -> None:
        """With more than ``limit`` units, keep the most frequent half of them."""
        if len(self.number) <= limit:
            return
        kept = np.sort(np.argsort(-self.seen, kind="stable")[:limit // 2])
        names = list(self.number)
        old, first = {k: getattr(self, k) for k in self._columns}, np.append(self.base, len(self.last))
        nodes = first[kept + 1] - first[kept]
        node = np.repeat(first[kept] - (np.cumsum(nodes) - nodes), nodes) + np.arange(int(nodes.sum()))
        count = old["edges"][node + 1] - old["edges"][node]
        edge = np.repeat(old["edges"][node] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        moved = np.repeat(first[kept] - (np.cumsum(nodes) - nodes), nodes)  # how far a position moves
        seen = self.seen[kept]
        self.clear()
        self.seen = seen
        self.number.update((names[k], n) for n, k in enumerate(kept.tolist()))
        for name, more in (("base", np.cumsum(nodes) - nodes), ("last", old["last"][node]), ("edges", np.cumsum(count)),
                           ("to", old["to"][edge] - np.repeat(moved, count)), ("id", old["id"][edge]), ("cdf", old["cdf"][edge]),
                           ("cond", old["cond"][edge])):
            self._columns[name].add(more)
        self._show()

    def draw(self, at: np.ndarray, key: np.ndarray, step: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """From each position to its unit's end: all edges, row after row, and each row's number of them."""
        count = np.zeros(len(at), np.int64)
        rows, steps = np.flatnonzero(~self.last[at]), []
        at, key = at[rows], _hashes(key[rows], _DRAW + sample)
        turn = step[rows]
        while len(rows):
            u = _uniform(_hashes(key, turn))
            e = self.edges[at]
            wait = np.flatnonzero(u >= self.cdf[e])
            while len(wait):
                e[wait] += 1
                wait = wait[u[wait] >= self.cdf[e[wait]]]
            steps.append((rows, e))
            count[rows] += 1
            at = self.to[e]
            go = np.flatnonzero(~self.last[at])
            rows, at, key, turn = rows[go], at[go], key[go], turn[go] + 1
        out = np.zeros(int(count.sum()), np.int64)
        begin = np.cumsum(count) - count
        for n, (rows, e) in enumerate(steps):
            out[begin[rows] + n] = e
        return out, count


class _Numbers(dict):
    """Numbers units as they are first looked up; ``new`` lists those without a lattice yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


def _truncated(where, g, h: np.ndarray) -> np.ndarray:
    """Gumbels at ``where`` under the condition that they are at most ``g``, from hashes."""
    e = -np.log(_uniform(h))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isfinite(where), -np.logaddexp(-g, np.log(e) - where), -np.inf)


def _left_nodes(cond: np.ndarray, length: np.ndarray, fresh: np.ndarray, g: np.ndarray, key: np.ndarray, number: int,
                k: int) -> list[list[tuple[float, int, float]]]:
    """For paths one behind the other: the ``k`` (as many as can still come up) best nodes that their free edges leave: key, place,
    log-probability up to there.

    ``cond`` are the log conditional probabilities of all edges; those from place ``fresh`` on were free.
    """
    begin = np.cumsum(length) - length
    own = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(cond)) - begin[own]
    run = np.cumsum(cond) - cond
    run = run - run[np.minimum(begin, max(0, len(cond) - 1))][own] if len(cond) else run
    x = np.full(len(cond), -np.inf)

    def fill(at: np.ndarray) -> None:
        with np.errstate(divide="ignore"):
            where = run[at] + np.log(-np.expm1(np.minimum(cond[at], 0.0)))
        x[at] = _truncated(where, g[own[at]], _hashes(key[own[at]], place[at], number, 1))

    free = place >= fresh[own]
    near = free & (place < fresh[own] + 64)
    fill(np.flatnonzero(near))
    full = np.flatnonzero(length)
    bound = np.full(len(length), -np.inf)  # the k-th best so far
    rest = x.copy()
    for _ in range(k if len(full) else 0):
        bound[full] = np.maximum.reduceat(rest, begin[full])
        rest[rest == bound[own]] = -np.inf
    # further on, only nodes that can still be above it
    fill(np.flatnonzero(free & ~near & (run + _REACH > bound[own])))
    out: list[list[tuple[float, int, float]]] = [[] for _ in length]
    for _ in range(k if len(full) else 0):
        best = np.maximum.reduceat(x, begin[full])
        hit = np.flatnonzero((x == np.repeat(best, length[full])) & (x > -np.inf))
        paths, first = np.unique(own[hit], return_index=True)
        for d, i in zip(paths.tolist(), hit[first].tolist(), strict=True):
            out[d].append((float(x[i]), int(place[i]), float(run[i])))
        x[hit[first]] = -np.inf
    return out


class _Search:
    """The perturbed best-first search of one text."""

    def __init__(self, lat: Lattices, key: np.uint64, units: np.ndarray):
        self.lat, self.key, self.units = lat, key, units
        self.samples: list[tuple[np.ndarray, np.ndarray, float]] = []  # edges, edges a unit, key
        self.heap: list[tuple] = []  # -key, order, sample, place in its path, log-probability there, edges excluded

    def emit(self, edges: np.ndarray, count: np.ndarray, g: float, left: list[tuple[float, int, float]]) -> None:
        """A path and the best of the nodes that it leaves (key, place, log-probability up to there)."""
        number = len(self.samples)
        self.samples.append((edges, count, g))
        for x, p, phi in left:
            heapq.heappush(self.heap, (-x, len(self.heap), number, p, phi, (int(edges[p]),)))

    def branch(self, node: tuple, u: float, h: np.ndarray) -> tuple:
        """From the best node: the path with its next edge, unit and step of that edge, key.

        ``u`` draws the edge among those that are not excluded, ``h`` the key of what is left."""
        g, _, number, p, phi, excluded = node
        edges, count, _ = self.samples[number]
        ends = np.cumsum(count)
        unit = int(np.searchsorted(ends, p, side="right"))
        step = p - int(ends[unit] - count[unit])
        at = int(self.lat.to[edges[p - 1]] if step else self.lat.base[self.units[unit]])
        left = [e for e in range(int(self.lat.edges[at]), int(self.lat.edges[at + 1])) if e not in excluded]
        prob = [exp(x) for x in self.lat.cond[left].tolist()]
        aim, e = u * sum(prob), left[-1]
        for e, x in zip(left, prob, strict=True):  # noqa: B007
            aim -= x
            if aim < 0:
                break
        rest = sum(x for o, x in zip(left, prob, strict=True) if o != e)
        if rest > 0:
            x = float(_truncated(phi + log(rest), -g, h))
            heapq.heappush(self.heap, (-x, len(self.heap), number, p, phi, (*excluded, e)))
        return np.append(edges[:p], e), unit, step, count[:unit], -g

    def result(self) -> list[tuple[np.ndarray, float, float, float]]:
        """Piece ids, log-probability, key, log of the chance to be among the first k, for each sample."""
        kappa = -self.heap[0][0] if self.heap else -np.inf
        out = []
        for edges, _, g in self.samples:
            phi = float(self.lat.cond[edges].sum())
            x = phi - kappa
            log_in = 0.0 if x > 4 else float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else x
            out.append((self.lat.id[edges], phi, g, log_in))
        return out


class Sampler:
    """Draws up to ``k`` distinct segmentations of each text."""

    def __init__(self, vocabulary: Vocabulary, k: int, seed: int):
        self.v, self.k, self.seed = vocabulary, k, seed
        self.lat = Lattices(vocabulary, log_probabilities(vocabulary))

    def sample(self, keys: list[int], texts: list[str | None]) -> Iterator[list]:
        """For each text its samples, largest key first (see ``_Search.result``)."""
        i = 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n + len(texts[j] or "") <= _GROUP):
                n += len(texts[j] or "")
                j += 1
            yield from self._group(keys[i:j], texts[i:j])
            i = j

    def _group(self, keys: list[int], texts: list[str | None]) -> Iterator[list]:
        lat = self.lat
        lat.trim(_UNITS)
        units = [self.v.units(t) for t in texts]
        n = np.fromiter(map(len, units), np.int64, len(units))
        flat = np.fromiter(map(lat.number.__getitem__, chain.from_iterable(units)), np.int64, int(n.sum()))
        lat.add_new()
        lat.met(flat)
        begin = np.concatenate([[0], np.cumsum(n)])
        doc_key = _hashes(np.array(keys, np.int64).view(np.uint64), self.seed)
        own = np.repeat(np.arange(len(texts)), n)
        unit_key = _hashes(doc_key[own], np.arange(len(flat)) - begin[own])
        top = -np.log(-np.log(_uniform(_hashes(doc_key, 3))))  # the total probability is 1
        edge, count = lat.draw(lat.base[flat], unit_key, np.zeros(len(flat), np.int64), 0)
        cut = np.concatenate([[0], np.cumsum(count)])[begin]
        search = [_Search(lat, doc_key[d], flat[begin[d]:begin[d + 1]]) for d in range(len(texts))]
        left = _left_nodes(lat.cond[edge], np.diff(cut), np.zeros(len(texts), np.int64), top, doc_key, 0, self.k)
        for d, s in enumerate(search):
            s.emit(edge[cut[d]:cut[d + 1]], count[begin[d]:begin[d + 1]], float(top[d]), left[d])
        for turn in range(1, self.k):
            nodes = [(d, heapq.heappop(s.heap)) for d, s in enumerate(search) if s.heap]
            if not nodes:
                break
            own, at = doc_key[[d for d, _ in nodes]], np.array([n[3] for _, n in nodes])
            u, h = _uniform(_hashes(own, at, turn, 2)).tolist(), _hashes(own, at, 1000 + turn, 1)
            todo = [(d, search[d].branch(n, x, y)) for (d, n), x, y in zip(nodes, u, h, strict=True)]
            # fresh draws from behind the branch's edge to the end of its unit, and of all units after it
            at, key, step = [], [], []
            for d, (head, unit, place, _, _) in todo:
                span = slice(begin[d] + unit, begin[d + 1])
                where, after = lat.base[flat[span]], np.zeros(begin[d + 1] - begin[d] - unit, np.int64)
                where[0], after[0] = lat.to[head[-1]], place + 1
                at.append(where)
                key.append(unit_key[span])
                step.append(after)
            edge, count = lat.draw(np.concatenate(at), np.concatenate(key), np.concatenate(step), turn)
            rows = np.concatenate([[0], np.cumsum([len(a) for a in at])])
            cut = np.concatenate([[0], np.cumsum(count)])[rows]
            paths = [np.append(head, edge[cut[t]:cut[t + 1]]) for t, (_, (head, *_)) in enumerate(todo)]
            left = _left_nodes(
                lat.cond[np.concatenate(paths)], np.array([len(x) for x in paths]), np.array([len(b[0]) for _, b in todo]),
                np.array([b[4] for _, b in todo]), doc_key[[d for d, _ in todo]], turn, self.k - turn)
            for t, (d, (_, _, place, before, g)) in enumerate(todo):
                more = count[rows[t]:rows[t + 1]].copy()
                more[0] += place + 1
                search[d].emit(paths[t], np.append(before, more), g, left[t])
        for s in search:
            yield s.result()


_KEPT: dict[tuple, Sampler] = {}


def _sampler(vocabulary: Vocabulary, k: int, seed: int) -> Sampler:
    """A worker keeps the lattices of one vocabulary from task to task (what is drawn does not depend on it)."""
    name = (id(vocabulary), k, seed)
    if name not in _KEPT or _KEPT[name].v is not vocabulary:
        _KEPT.clear()
        _KEPT[name] = Sampler(vocabulary, k, seed)
    return _KEPT[name]


def sample_segmentations(docs: DataFrame, vocabulary: Vocabulary, k: int = 2, seed: int = 23, id_col: str = "doc_id",
                         text_col: str = "text", more: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """``doc_id, sample`` (1 to ``k``), ``pieces, log_prob, key, log_inclusion``: the sampled segmentations.

    ``more`` names text columns that go along; ``decoded`` adds what the pieces decode to as ``text``.

    Up to ``k`` rows per row, distinct segmentations of the whole text in falling order of their keys (perturbed
    log-probabilities); fewer where a text has fewer.  Null and empty texts have one, without pieces, of
    probability 1.  ``log_inclusion`` is the log of the probability that a segmentation is among
    the first k given the next key (0 if there is no next).  The draws depend on the id and the text
    alone: rows that repeat an id and text get the same samples; a null id draws as id 0 does.
    Other columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["_id", *[f"_more{i}" for i in range(len(more))]]
    results = ["sample", "pieces", "log_prob", "key", "log_inclusion", *["text"] * decoded]
    columns = [*names, *results]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, decoder = _sampler(shared.value, k, seed), Decoder(shared.value)
        for df in batches:
            rows, size = [], 0
            got = sampler.sample(df["_key"].tolist(), df["_text"].tolist())
            for row, samples in zip(df[names].itertuples(index=False, name=None), got, strict=True):
                for n, (pieces, phi, g, log_in) in enumerate(samples, 1):
                    rows.append((*row, n, pieces, phi, g, log_in, *[decoder.decode(pieces)] * decoded))
                    size += len(pieces)
                if size > _OUT:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=columns)
        sampler.lat.trim(_REST)

    # the key of a row's draws: any id, as a hash of its text form
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), *[F.col(c).alias(n) for c, n in zip(more, names[1:], strict=True)],
                       F.col(text_col).alias("_text"), F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("0"))).alias("_key"))
    strings = ", ".join(f"{n} string" for n in names)
    return rows.mapInPandas(
        run, f"{strings}, sample int, pieces array<int>, log_prob double, key double, log_inclusion double" + ", text string" * decoded).select(
        F.col("_id").cast(kind).alias("doc_id"), *[F.col(n).alias(c) for c, n in zip(more, names[1:], strict=True)],
        *results)


_OUT = 500_000  # pieces in a frame that goes back to Spark



class Decoder:
    """Piece ids to text: the exact inverse of encoding for any segmentation."""

    def __init__(self, vocabulary: Vocabulary):
        text: list[bytes] = [b""] * vocabulary.size
        for p, i in vocabulary.pieces.items():
            text[i] = p.encode("utf-8", "surrogatepass")
        for b, i in enumerate(vocabulary.bytes):
            text[i] = bytes([b])
        self.spelled = np.frombuffer(b"".join(text), np.uint8)
        self.length = np.fromiter(map(len, text), np.int64, len(text))
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids) -> str:
        """Ids that the vocabulary does not have raise; the blank that begins a text goes."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() < 0:
            raise IndexError("a negative piece id")
        n = self.length[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.spelled[at].tobytes()[1:].decode("utf-8", "replace")


def decode_pieces(rows: DataFrame, vocabulary: Vocabulary, pieces_col: str = "pieces", out_col: str = "text") -> DataFrame:
    """``rows`` with ``out_col``: the text of the piece ids; null pieces give null, no pieces an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(shared.value)
        for s in batches:
            yield s.map(lambda ids: None if ids is None else decoder.decode(ids))

    return rows.withColumn(out_col, decoded(F.col(pieces_col)))
