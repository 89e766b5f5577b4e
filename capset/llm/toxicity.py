"""Toxicity by a small convolutional text classifier, trained here in numpy.

A word's vector is the mean of hashed embeddings of the word, its beginnings and its end, so that words
never seen share what their parts have learnt.  Filters of widths 1, 2 and 3 run over the words of the
whole text; each filter's largest response (max pooling) feeds a logistic output.  A naive Bayes
model over the same hashed parts guesses the language from the text alone; the threshold of that
language, calibrated on rows kept back from training, becomes score 0.5.

All labelled rows outside the held-out fold are learnt from.  Up to ``TRAIN_ROWS`` of each class are fitted
on the driver.  With more, a net fitted to so many is where the tasks start: each goes once through the rows
of its shard, the nets are averaged by rows, words are counted by language and the thresholds come from
all rows kept back, all of it in Spark.
"""

from __future__ import annotations

import copy
import itertools
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capset.llm.common import held_out

#: Labelled rows of each class that the driver holds, at most.
TRAIN_ROWS = 2_500
#: Labelled rows of a shard, about; and rows and words that a task trains on at once, about.
SHARD_ROWS, _ROWS_AT_ONCE, _WORDS_AT_ONCE = 8_192, 1_024, 1 << 20
#: Numbers in a block of what the shards add up; bins of the thresholds in one unit of the logit.
_BLOCK, _BINS = 1 << 13, 64
TABLE = 1 << 15
DIM, FILTERS, WIDTHS = 16, 12, (1, 2, 3)
EPOCHS, BATCH = 8, 32
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = 5
_PAD = max(WIDTHS) - 1
_CHUNK = 200_000  # words whose responses are held at once
_CACHE = 200_000  # words whose filter responses a worker keeps


def _parts(word: str) -> tuple[int, ...]:
    """Hashed parts: the word, its first 3, 4 and 5 letters and its last 3."""
    return (crc32(word.encode("utf-8", "replace")) % TABLE, crc32(word[:3].encode("utf-8", "replace"), 3) % TABLE,
            crc32(word[:4].encode("utf-8", "replace"), 4) % TABLE, crc32(word[:5].encode("utf-8", "replace"), 5) % TABLE,
            crc32(word[-3:].encode("utf-8", "replace"), 9) % TABLE)


class _Numbers(dict):
    """Numbers words as they are first looked up; ``new`` lists those since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Net:
    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.3, (TABLE, DIM)).astype(np.float32)
        self.conv = [rng.normal(0, 1 / np.sqrt(w * DIM), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.out0 = np.zeros(1, np.float32)


    def tensors(self) -> list[np.ndarray]:
        return [self.emb, self.out, self.out0, *self.conv, *self.bias]


def _train(docs: list[np.ndarray], parts: np.ndarray, y: np.ndarray, seed: int = 5, net: _Net | None = None, epochs: int = EPOCHS) -> _Net:
    """``docs``: word numbers of each text; ``parts``: hashed parts of each word.  Adagrad; a given ``net`` learns on."""
    rng = np.random.default_rng(seed)
    if net is None:
        net = _Net(seed)
        net.seen = [np.full_like(t, 1e-3) for t in net.tensors()]
    tensors, seen = net.tensors(), net.seen

    def step(k: int, grad: np.ndarray, at=slice(None)) -> None:
        seen[k][at] += grad * grad
        tensors[k][at] -= 0.1 * grad / np.sqrt(seen[k][at])

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for s in range(0, len(order), BATCH):
            rows = order[s:s + BATCH]
            used, local = np.unique(np.concatenate([docs[r] for r in rows] or [[]]).astype(np.int64), return_inverse=True)
            vec = net.emb[parts[used]].mean(axis=1)
            x = np.zeros((len(local) + (len(rows) + 1) * _PAD, DIM), np.float32)
            word_at = np.full(len(x), -1)
            starts, ends, at, p = [], [], 0, 0
            for r in rows:
                n = len(docs[r])
                x[p:p + n], word_at[p:p + n] = vec[local[at:at + n]], used[local[at:at + n]]
                starts.append(p)
                ends.append(max(p + n, p + 1))
                at, p = at + n, p + n + _PAD
            pooled, where = [], []
            for w, width in enumerate(WIDTHS):
                c = sum(x[j:len(x) - width + 1 + j] @ net.conv[w][j] for j in range(width)) + net.bias[w]
                best = np.stack([a + c[a:b].argmax(axis=0) for a, b in zip(starts, ends, strict=True)])
                where.append(best)
                pooled.append(np.maximum(np.take_along_axis(c, best, axis=0), 0))
            h = np.concatenate(pooled, axis=1)
            prob = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out0, -30, 30)))
            d = ((prob - y[rows]) / len(rows)).astype(np.float32)
            dh = d[:, None] * net.out * (h > 0)
            dx = np.zeros_like(x)
            for w, width in enumerate(WIDTHS):
                g = dh[:, w * FILTERS:(w + 1) * FILTERS]
                dw = np.zeros_like(net.conv[w])
                for j in range(width):
                    dw[j] = np.einsum("bf,bfd->df", g, x[where[w] + j])
                    np.add.at(dx, (where[w] + j).ravel(), (g[:, :, None] * net.conv[w][j].T[None]).reshape(-1, DIM))
                step(3 + w, dw + 1e-5 * net.conv[w])
                step(3 + len(WIDTHS) + w, g.sum(axis=0))
            step(1, h.T @ d + 1e-4 * net.out)
            step(2, d.sum(keepdims=True))
            hit = np.flatnonzero((word_at >= 0) & np.abs(dx).any(axis=1))
            if len(hit):
                ids = parts[word_at[hit]]
                rows_hit, back = np.unique(ids, return_inverse=True)
                g = np.zeros((len(rows_hit), DIM), np.float32)
                np.add.at(g, back.ravel(), np.repeat(dx[hit] / _PARTS, _PARTS, axis=0))
                step(0, g, rows_hit)
    return net


class Scorer:
    """Scores texts with a model; keeps the filter responses of the words it has met."""

    def __init__(self, model: dict):
        self.m, self.cols = model, FILTERS * sum(WIDTHS)
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.resp = np.zeros((1 << 12, self.cols + max(1, len(self.m["langs"]))), np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        got = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if new := self.number.new:
            ids = np.array([_parts(w) for w in new])
            n = len(self.number)
            while n > len(self.resp):
                self.resp = np.concatenate([self.resp, np.zeros_like(self.resp)])
            self.resp[n - len(new):n, :self.cols] = self.m["emb"][ids].mean(axis=1) @ self.m["filters"]
            self.resp[n - len(new):n, self.cols:] = self.m["lang"][ids].mean(axis=1)
            self.number.new = []
        return got

    def pooled(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Largest responses of every filter, and mean language scores, one row a text."""
        h = np.zeros((len(docs), FILTERS * len(WIDTHS)), np.float32)
        lang = np.zeros((len(docs), self.resp.shape[1] - self.cols), np.float32)
        for i, words in enumerate(docs):
            if len(self.number) > _CACHE:
                self.clear()
            best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
            for s in range(0, max(1, len(words)), _CHUNK):  # slices overlap by what a filter spans
                ids = self.numbers(words[s:s + _CHUNK + _PAD])
                part = self.resp[ids]
                lang[i] += part[:_CHUNK, self.cols:].sum(axis=0)
                n, at = min(len(part), _CHUNK), 0
                if not n:
                    best[:] = np.stack(self.m["bias"])
                for w, width in enumerate(WIDTHS if n else ()):
                    c = part[:n, at:at + FILTERS].copy()
                    for j in range(1, width):
                        more = part[j:n + j, at + j * FILTERS:at + (j + 1) * FILTERS]
                        c[:len(more)] += more
                    at += width * FILTERS
                    best[w] = np.maximum(best[w], c.max(axis=0) + self.m["bias"][w])
            lang[i] /= max(1, len(words))
            h[i] = np.maximum(best, 0).ravel()
        return h, lang

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        langs = self.m["langs"] or ["und"]
        h, lang = self.pooled([words_of(t) for t in texts])
        guess = [langs[k] for k in lang.argmax(axis=1)] if len(texts) else []
        logit = h @ self.m["out"] + self.m["out0"] - np.array([self.m["cut"].get(g, self.m["cut"][""]) for g in guess])
        return 1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30))), guess


def _threshold(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of the best gap."""
    if not len(y) or y.min() == y.max():
        return 0.0
    order = np.argsort(logit)
    l, t = logit[order], y[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
    edges = np.concatenate([[l[0] - 1], (l[1:] + l[:-1]) / 2, [l[-1] + 1]])
    best = np.flatnonzero(errors == errors.min())
    return float(np.median(edges[best]))


def _model(net: _Net, table: np.ndarray, names: list[str]) -> dict:
    """A model without thresholds; ``table`` has the (smoothed) counts of the parts by language."""
    table = np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return {"emb": net.emb, "filters": np.concatenate([c[j] for c in net.conv for j in range(len(c))], axis=1),
            "bias": net.bias, "out": net.out, "out0": float(net.out0[0]), "lang": table, "langs": names, "cut": {"": 0.0}}


def _numbered(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Word numbers of each text, and the hashed parts of each word."""
    number = _Numbers()
    docs = [np.array([number[w] for w in words_of(t)], np.int64) for t in texts]
    return docs, np.array([_parts(w) for w in number] or np.zeros((1, _PARTS)), np.int64)


def fit(texts: list[str], langs: list[str | None], labels: list[int]) -> dict:
    """Model from labelled texts; every fifth row calibrates the thresholds, the others train."""
    docs, parts = _numbered(texts)
    y = np.array(labels, np.float32)
    kept = np.arange(len(docs)) % 5 == 4
    net = _train([d for d, k in zip(docs, kept, strict=True) if not k], parts, y[~kept])
    names = sorted({v for v in langs if v is not None})
    table = np.ones((max(1, len(names)), TABLE))
    for d, v in zip(docs, langs, strict=True):
        if v is not None:
            table[names.index(v)] += np.bincount(parts[d].ravel(), minlength=TABLE)
    model = _model(net, table, names)
    held = [t for t, k in zip(texts, kept, strict=True) if k]
    score, guess = Scorer(model).score(held)
    logit, guess = np.log(score / (1 - score)) if len(held) else np.zeros(0), np.array(guess)
    cut = {"": _threshold(logit, y[kept])}
    for g in set(guess.tolist()):
        own = guess == g
        if (y[kept][own] > 0).sum() >= 10 and (y[kept][own] == 0).sum() >= 10:
            cut[g] = _threshold(logit[own], y[kept][own])
    return model | {"cut": cut}


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``_id, _y, _kept`` of all labels outside the held-out fold; every fifth id is kept back from training."""
    return labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_y"), (F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(5)) == 4).alias("_kept")) \
        .dropDuplicates(["_id"])


def training_rows(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> list:
    """At most ``rows`` texts of each class of ``known``, chosen by a hash of the id (and ``4 * rows + 1`` where ids repeat)."""
    count = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}

    def share(k: int) -> int:
        n = count.get(k, 0)
        return int((1.0 if n <= rows else (rows - 3 * rows**0.5) / n) * (1 << 30))

    bound = F.when(F.col("_y") == 1, F.lit(share(1))).otherwise(F.lit(share(0)))
    chosen = known.where(F.pmod(F.xxhash64("_id", F.lit(9)), F.lit(1 << 30)) < bound).limit(2 * rows)
    # at most 2 * rows ids
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.col(lang_col).alias("lang")).join(F.broadcast(chosen), "_id")
    return sorted(text.orderBy("_id").limit(4 * rows + 1).collect(), key=lambda r: (hash((r["_id"] * 2654435761) % 4294967291), r["text"]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Model from all labelled texts outside the held-out fold."""
    known = labelled(labels)
    if max([r[1] for r in known.groupBy("_y").count().collect()], default=0) <= rows:
        got = training_rows(docs, known, rows)
        if len(got) <= 4 * rows:
            return fit([r["text"] for r in got], [r["lang"] for r in got], [r["_y"] for r in got])
    got = training_rows(docs, known.where("not _kept"), rows)
    words, parts = _numbered([r["text"] for r in got])
    start = _train(words, parts, np.array([r["_y"] for r in got], np.float32))
    shards = max(1, -(-known.count() // SHARD_ROWS))
    model = _learn_all(_sharded(docs, known, shards), start)
    kept = _texts(docs.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) == 4)).repartition(shards, "_id") \
        .join(known.where("_kept").repartition(shards, "_id").hint("merge"), "_id")
    return model | {"cut": _thresholds(_logits(kept, model))}


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")


def _sharded(docs: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """All labelled texts, ``_id, text, lang, _y, _kept, shard``; a shard is in one task, its rows in the same order at every run.

    Shards go by the id, not by partitions, so there are as many nets as labels ask for, however many
    partitions there are.  Labels travel with the texts: both are shuffled once, by shard."""
    none = known.select("_id", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), "_y", "_kept")
    rows = none.unionByName(_texts(docs), allowMissingColumns=True).withColumn("shard", F.pmod(F.hash("_id"), F.lit(shards)))
    of_id = Window.partitionBy("shard", "_id")
    # more partitions than shards, so that few hold two
    return rows.repartition(4 * shards, "shard").withColumns({"_y": F.max("_y").over(of_id), "_kept": F.max("_kept").over(of_id)}) \
        .where("text is not null and _y is not null").sortWithinPartitions("shard", "_id", F.xxhash64("text"))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one shard put together to about as many as a task trains on at once."""
    have, size, shard, step = [], 0, None, 64
    for df in batches:
        for at, part in df.groupby("shard"):  # rows come in order of their shards
            if have and at != shard:
                yield pd.concat(have)
                have, size = [], 0
            shard = at
            for k in range(0, len(part), step):
                have.append(part.iloc[k:k + step])
                size += int(have[-1]["text"].str.len().sum()) // 6
                if len(have) * step >= _ROWS_AT_ONCE or size >= _WORDS_AT_ONCE:
                    yield pd.concat(have)
                    have, size = [], 0
    if have:
        yield pd.concat(have)


def _learn_all(rows: DataFrame, start: _Net) -> dict:
    """A model without thresholds from all rows: the nets of the shards, averaged by rows, and counts by language."""
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, chunks in itertools.groupby(_chunks(batches), lambda df: df["shard"].iloc[0]):
            yield from learn_shard(chunks)

    def learn_shard(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net, n, shard, counts = copy.deepcopy(shared.value), 0, "", {}
        for df in chunks:
            shard = shard or str(df["_id"].iloc[0])
            docs, parts = _numbered(df["text"].tolist())
            for words, lang in zip(docs, df["lang"], strict=True):
                if lang is not None:
                    mine = counts.setdefault(lang, np.zeros(TABLE))
                    at, times = np.unique(parts[words], return_counts=True)
                    mine[at] += times
            learn = np.flatnonzero(~df["_kept"].to_numpy(bool))
            n += len(learn)
            _train([docs[k] for k in learn], parts, df["_y"].to_numpy(np.float32)[learn], net=net, epochs=1)
        found = {(False, lang): c for lang, c in counts.items()}
        if n:
            found[True, ""] = n * np.concatenate([t.ravel() for t in net.tensors()] + [np.ones(1)]).astype(float)
        for (is_net, lang), values in found.items():
            blocks = range(0, len(values), _BLOCK)
            yield pd.DataFrame({"net": is_net, "lang": lang, "block": [k // _BLOCK for k in blocks], "shard": shard,
                                "data": [values[k:k + _BLOCK].tobytes() for k in blocks]})

    def add(df: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(df["data"].iloc[0]) // 8)
        for data in df.sort_values("shard")["data"]:  # in one order, so that reruns agree
            total += np.frombuffer(data)
        return df.iloc[:1].assign(data=[total.tobytes()])

    form = "net boolean, lang string, block int, shard string, data binary"
    got = rows.mapInPandas(run, form).groupBy("net", "lang", "block").applyInPandas(add, form).collect()
    sums: dict = {}
    for r in sorted(got, key=lambda r: r["block"]):
        sums.setdefault((r["net"], r["lang"]), []).append(np.frombuffer(r["data"]))
    if (True, "") in sums:
        values = np.concatenate(sums.pop((True, "")))
        values, at = values[:-1] / values[-1], 0
        for t in start.tensors():
            t[...] = values[at:at + t.size].reshape(t.shape)
            at += t.size
    names = sorted(lang for _, lang in sums)
    return _model(start, 1 + np.stack([np.concatenate(sums[False, v]) for v in names]) if names else np.ones((1, TABLE)), names)


def _logits(rows: DataFrame, model: dict) -> DataFrame:
    """``lang`` (as guessed), ``logit, y`` of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for df in batches:
            score, guess = scorer.score(df["text"].tolist())
            yield pd.DataFrame({"lang": guess, "logit": np.log(score / (1 - score)), "y": df["_y"].astype("int64")})

    return rows.select("text", "_y").mapInPandas(run, "lang string, logit double, y long")


def _thresholds(logits: DataFrame, least: int = 10) -> dict:
    """The cut with the fewest errors (``_threshold``) of all rows, under "", and of each language with ``least`` rows of both classes.

    Errors are summed over narrow bins of the logit and then inside each bin, so no task gets all rows of a language."""
    rows = logits.select(F.explode(F.array(F.lit(""), "lang")).alias("key"), "logit", "y").groupBy("key", "logit").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).withColumn("bin", F.floor(F.col("logit") * _BINS))
    bins = rows.groupBy("key", "bin").agg(F.sum("p").alias("bp"), F.sum("n").alias("bn"), F.min("logit").alias("low"))
    by = Window.partitionBy("key").orderBy("bin")
    every = Window.partitionBy("key")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("key", "bin", "low", F.coalesce(F.sum("bp").over(before), F.lit(0)).alias("p0"),
                       F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"), F.sum("bp").over(every).alias("pos"),
                       F.sum("bn").over(every).alias("neg"), F.lead("low").over(by).alias("up"), F.row_number().over(by).alias("_k"))
    inside = Window.partitionBy("key", "bin").orderBy("logit")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = rows.withColumns({"p": F.sum("p").over(so_far), "n": F.sum("n").over(so_far), "next": F.lead("logit").over(inside)}) \
        .join(bins, ["key", "bin"]).select(
            "key", "pos", "neg", (F.col("p0") + F.col("p") + F.col("neg") - F.col("n0") - F.col("n")).alias("errors"),
            F.coalesce((F.col("logit") + F.coalesce("next", "up")) / 2, F.col("logit") + 1).alias("edge"))
    first = bins.where("_k = 1").select("key", "pos", "neg", F.col("neg").alias("errors"), (F.col("low") - 1).alias("edge"))
    edges = after.unionByName(first).groupBy("key", "pos", "neg", "errors").agg(F.median("edge").alias("edge"))
    cut = {"": 0.0}
    for r in edges.groupBy("key", "pos", "neg").agg(F.min_by("edge", "errors").alias("edge")).collect():
        if min(r["pos"], r["neg"]) >= (least if r["key"] else 1):
            cut[r["key"]] = r["edge"]
    return cut


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, held_out, score, predicted, lang_guess``.

    Only the text decides; a null text counts as empty, and empty texts get the score of no words.
    Repeated rows each get a row; a null id is not held out.  With no labelled rows the model is an
    untrained one with scores that mean nothing.  Whole texts are read, however long.
    """
    kind = docs.schema[id_col].dataType
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for df in batches:
            score, guess = scorer.score(df["text"].tolist())
            yield pd.DataFrame({"_id": df["_id"], "held_out": df["held_out"], "score": score,
                                "predicted": (score >= 0.5).astype("int32"), "lang_guess": guess})

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "_id string, held_out boolean, score double, predicted int, lang_guess string") \
        .withColumn("doc_id", F.col("_id").cast(kind)).select("doc_id", "held_out", "score", "predicted", "lang_guess")
