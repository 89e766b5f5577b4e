"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks.  Each block is a vector: hashed embeddings of the elements above it
(names and words of class, id and role), of its words, and a few shape numbers.  A bidirectional LSTM
in numpy reads the whole sequence, so a block is judged with the page around it.  It is trained here on
pages made from the corpus' own words in many layouts, whose blocks are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.llm.html_blocks import Block, blocks
from capset.llm.html_layouts import made_pages

#: Pages whose words the training pages are made of, at most, and the number of those.
SAMPLE_PAGES, TRAIN_PAGES = 300, 1_200
TABLE = 1 << 12
PATH, WORD, SHAPE, HIDDEN = 24, 8, 7, 24
INPUT = PATH + WORD + SHAPE
EPOCHS, BATCH, RATE = 6, 32, 0.01
_CACHE = 300_000
_CELLS = 20_000  # blocks that the LSTM reads side by side


def _path_ids(path: tuple[str, ...]) -> list[int]:
    """Hashes of what a path holds: words of every element, and which are innermost."""
    ids = []
    for depth, name in enumerate(reversed(path)):
        tag, *words = name.split(" ")
        ids.append(crc32(f"<{tag}".encode()) % TABLE)
        if depth < 3:
            ids.append(crc32(f"{depth}<{tag}".encode()) % TABLE)
        for w in words:
            ids.append(crc32(w.encode()) % TABLE)
            if len(w) > 5:
                ids.append(crc32(b"^" + w[:5].encode()) % TABLE)
    return ids or [0]


def _word_id(word: str) -> int:
    return crc32(word.lower().strip(".,:;!?()\"'").encode("utf-8", "replace"), 7) % TABLE


def _shape(page: list[Block]) -> np.ndarray:
    n = np.array([len(b.text) for b in page], float)
    words = np.array([b.text.count(" ") + 1 for b in page], float)
    ends = np.array([b.text[-1] in ".!?…\"”»" for b in page], float)
    marks = np.array([sum(map(b.text.count, ".,;")) for b in page]) / words
    where = np.arange(len(page)) / max(1, len(page) - 1)
    return np.stack([np.log1p(n) / 4, np.log1p(words) / 3, ends, np.minimum(marks, 1), [b.linked for b in page], where,
                     n / max(1.0, n.max())], axis=1)


class Features:
    """Turns pages into what the embeddings are looked up by; keeps what it has met."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        got = self.paths.get(path)
        if got is None:
            if len(self.paths) > _CACHE:
                self.paths.clear()
            got = self.paths[path] = np.array(_path_ids(path))
        return got

    def text(self, text: str) -> np.ndarray:
        if len(self.words) > _CACHE:
            self.words.clear()
        words, known = text.split(" "), self.words
        for w in words:
            if w not in known:
                known[w] = _word_id(w)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def page(self, page: list[Block]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        return [self.path(b.path) for b in page], [self.text(b.text) for b in page], _shape(page)


def _means(table: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    total = np.zeros((len(ids), table.shape[1]))
    flat, own = np.concatenate(ids), np.repeat(np.arange(len(ids)), n)
    for k in range(table.shape[1]):
        total[:, k] = np.bincount(own, weights=table[flat, k], minlength=len(ids))
    return total / n[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w = {"path": rng.normal(0, 0.5, (TABLE, PATH)), "word": rng.normal(0, 0.2, (TABLE, WORD)),
                  "out": rng.normal(0, 0.3, 2 * HIDDEN + INPUT), "out0": np.zeros(1)}
        for d in ("f", "b"):
            self.w |= {f"x{d}": rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * HIDDEN)),
                       f"h{d}": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)), f"c{d}": np.zeros(4 * HIDDEN)}
            self.w[f"c{d}"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def inputs(self, pages: list[tuple]) -> np.ndarray:
        """Vectors of all blocks of all pages, one below the other."""
        paths, words = [i for p in pages for i in p[0]], [i for p in pages for i in p[1]]
        first = {id(p): k for k, p in enumerate(paths)}  # blocks of one path share its array
        distinct = {k: n for n, k in enumerate(first.values())}
        vec = _means(self.w["path"], [paths[k] for k in distinct])
        return np.concatenate([vec[[distinct[first[id(p)]] for p in paths]], _means(self.w["word"], words),
                               np.concatenate([p[2] for p in pages])], axis=1).astype(np.float32)

    def _run(self, x: np.ndarray, live: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """One direction over (time, page, input); ``live`` masks the padding.  Keeps what training needs."""
        steps, n = x.shape[:2]
        z = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = z[t] + h @ self.w[f"h{d}"]
            i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            m = live[t][:, None]
            now = f * c + i * u
            kept.append((t, i, f, o, u, c, now, h))
            c = np.where(m, now, c)
            h = np.where(m, o * np.tanh(now), h)
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
        f, kf = self._run(x, live, "f")
        b, kb = self._run(x, live, "b")
        top = np.concatenate([f, b, x], axis=2)
        return top @ self.w["out"] + self.w["out0"], top, kf, kb

    def _back(self, dh_out: np.ndarray, x: np.ndarray, live: np.ndarray, kept: list, d: str, grad: dict) -> np.ndarray:
        dx = np.zeros_like(x)
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        for t, i, f, o, u, before, now, h in reversed(kept):
            m = live[t][:, None]
            dh = dh + dh_out[t]
            tan = np.tanh(now)
            do, dnow = dh * tan, dh * o * (1 - tan * tan) + dc
            g = np.concatenate([dnow * u * i * (1 - i), dnow * before * f * (1 - f), do * o * (1 - o), dnow * i * (1 - u * u)], axis=1)
            g = np.where(m, g, 0)
            grad[f"x{d}"] += x[t].T @ g
            grad[f"h{d}"] += h.T @ g
            grad[f"c{d}"] += g.sum(axis=0)
            dx[t] = g @ self.w[f"x{d}"].T
            dh = np.where(m, g @ self.w[f"h{d}"].T, dh)
            dc = np.where(m, dnow * f, dc)
        return dx

    def train(self, pages: list[tuple], labels: list[np.ndarray], seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        turn = 0
        for _ in range(EPOCHS):
            order = np.array(sorted(range(len(pages)), key=lambda k: (len(labels[k]) // 8, rng.random())))
            for s in rng.permutation(np.arange(0, len(order), BATCH)):
                rows = order[s:s + BATCH]
                own = [pages[r] for r in rows]
                x, live, at = _padded(self.inputs(own), [len(labels[r]) for r in rows])
                y = np.zeros(live.shape, np.float32)
                y[at] = np.concatenate([labels[r] for r in rows])
                logit, top, kf, kb = self.forward(x, live)
                d = np.where(live, _sigmoid(logit) - y, 0).astype(np.float32) / live.sum()
                grad = {k: np.zeros_like(v) for k, v in self.w.items()}
                grad["out"], grad["out0"] = np.einsum("tnk,tn->k", top, d), d.sum(keepdims=True).ravel()
                dtop = d[:, :, None] * self.w["out"]
                dx = self._back(dtop[:, :, :HIDDEN], x, live, kf, "f", grad)
                dx += self._back(dtop[:, :, HIDDEN:2 * HIDDEN], x, live, kb, "b", grad) + dtop[:, :, 2 * HIDDEN:]
                dx = dx[at]
                for k, ids, part in (("path", [i for p in own for i in p[0]], dx[:, :PATH]),
                                     ("word", [i for p in own for i in p[1]], dx[:, PATH:PATH + WORD])):
                    n = np.array([len(i) for i in ids])
                    np.add.at(grad[k], np.concatenate(ids), np.repeat(part / n[:, None], n, axis=0))
                turn += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for k, g in grad.items():  # Adam
                    g = g * min(1.0, 1.0 / max(size, 1e-9))
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.w[k] -= RATE * (m1[k] / (1 - 0.9**turn)) / (np.sqrt(m2[k] / (1 - 0.999**turn)) + 1e-8)

    def label(self, pages: list[tuple]) -> list[np.ndarray]:
        """Probability of each block to be main text; pages of like length are read side by side."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k][0])), key=lambda k: len(pages[k][0]))
        s = 0
        while s < len(order):
            e = s + 1
            while e < len(order) and (e + 1 - s) * len(pages[order[e]][0]) <= _CELLS:
                e += 1
            own = order[s:e]
            x, live, at = _padded(self.inputs([pages[k] for k in own]), [len(pages[k][0]) for k in own])
            p = _sigmoid(self.forward(x, live)[0])[at]
            for k, part in zip(own, np.split(p, np.cumsum([len(pages[k][0]) for k in own])[:-1]), strict=True):
                out[k] = part
            s = e
        return out


def _padded(x: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(time, page, input), the mask of blocks, and the places of the rows of ``x`` in order."""
    n = np.array(lengths)
    page = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(page)) - np.repeat(np.cumsum(n) - n, n)
    out, live = np.zeros((n.max(), len(n), x.shape[1]), np.float32), np.zeros((n.max(), len(n)), bool)
    out[step, page], live[step, page] = x, True
    return out, live, (step, page)


def train(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES, made: int = TRAIN_PAGES) -> dict:
    """Weights, learnt on ``made`` pages; the driver reads at most ``sample`` pages for their words."""
    some = pages.where(F.col(html_col).isNotNull()).select(html_col, F.xxhash64(html_col).alias("_h"))
    n = some.count()
    bound = int((1.0 if n <= sample else max(1.0, sample - 3 * sample**0.5) / n) * (1 << 30))
    got = some.where(F.pmod("_h", F.lit(1 << 30)) <= bound).limit(sample).select(html_col).collect()
    return fit(sorted(r[0] for r in got), made)


_APART = frozenset("nav aside footer form menu dialog".split())


def declared(page: list[Block]) -> np.ndarray | None:
    """Labels of a page that itself says what its main text is; None if it doesn't.

    That is a page with blocks inside and outside of ``article`` or ``main``; elements that are set apart by name
    inside of it are not main text.
    """
    tags = [[n.split(" ")[0] for n in b.path] for b in page]
    inside = np.array([bool({"article", "main"} & set(t)) and not _APART & set(t) for t in tags])
    outside = sum(bool(_APART & set(t)) for t in tags)
    plain = all(n.split(" ")[0] != "article" or len(n.split(" ")) == 1 for b in page for n in b.path)
    return inside.astype(np.float32) if inside.any() and outside and plain else None


def fit(sample: list[str], made: int = TRAIN_PAGES, seed: int = 6) -> dict:
    """From sampled pages: their words make the training pages, and those that declare their parts join them."""
    features, seen, labels = Features(), [], []
    own = [blocks(html) for html in sample]
    for page in own:
        if page and (known := declared(page)) is not None:
            seen.append(features.page(page))
            labels.append(known)
    words = sorted({w for page in own for b in page for w in b.text.split(" ")[:400]})
    for html, main in made_pages(words, made, seed):
        page = blocks(html)
        if page:
            seen.append(features.page(page))
            labels.append(np.array([main(b.text) for b in page], np.float32))
    labeller = Labeller()
    labeller.train(seen, labels)
    return labeller.w


def extract(pages: DataFrame, weights: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars, n_blocks``.

    ``text`` holds the blocks labelled as main text, in page order, joined by one line end; it is empty for a
    null or empty page and for one without main text.  ``n_chars`` counts its code points.  Repeated
    rows each get a row; ids and urls may be null; other columns are not read.
    """
    kind = pages.schema[id_col].dataType
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller, features = Labeller(), Features()
        labeller.w = shared.value
        for df in batches:
            text, size = [], []
            for s in range(0, len(df), 500):
                own = [blocks(h) for h in df["html"].iloc[s:s + 500]]
                probs = labeller.label([features.page(p) if p else ([], [], None) for p in own])
                text += ["\n".join(b.text for b, x in zip(p, q, strict=True) if x >= 0.5) for p, q in zip(own, probs, strict=True)]
                size += list(map(len, own))
            yield pd.DataFrame({"_id": df["_id"], "url": df["url"], "text": text, "n_blocks": size})

    rows = pages.select(F.col(id_col).cast("string").alias("_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInPandas(run, "_id string, url string, text string, n_blocks long").select(
        F.col("_id").cast(kind).alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")
