"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier over hashed character
n-grams (1 to 4 bytes of the lower-cased text) is fitted: logistic regression on feature
frequencies.  A text gets the language whose codeword has the least loss, where each bit's loss is
weighted by how well that bit was told apart in training.  If the second nearest codeword is almost as
near, the row is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.llm.common import held_out

#: Labelled rows that the classifiers are fitted on, at most; the driver holds their features.
TRAIN_ROWS = 4_000
#: Hashed n-gram features.
DIM = 1 << 12
BITS = 15
AMBIGUOUS = 0.1
_ROWS = 256  # texts whose features are held at once
_BYTES = 1 << 20  # of a text, hashed at once
UNKNOWN = "und"


def features(texts: list[str], dim: int = DIM) -> np.ndarray:
    """Square roots of the frequencies of hashed byte n-grams (n = 1 to 4), one row a text."""
    out = np.zeros((len(texts), dim), np.float32)
    shift = np.uint32(32 - int(np.log2(dim)))
    for i, text in enumerate(texts):
        # punctuation and digits tell nothing of the language
        b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
        b = np.where(_PLAIN[b], b, np.uint8(32))
        b = b[np.append(True, (b[1:] != 32) | (b[:-1] != 32))]
        got = np.zeros(dim, np.int64)
        for s in range(0, len(b), _BYTES):  # long texts in slices that share their last n-grams
            h = b[s:s + _BYTES].astype(np.uint32)
            for n in range(1, 5):
                if n > 1:
                    more = b[s + n - 1:s + n - 1 + len(h)].astype(np.uint32)
                    h = (h[:len(more)] * np.uint32(0x01000193)) ^ more
                got += np.bincount((h * np.uint32(2654435761)) >> shift, minlength=dim)
        out[i] = np.sqrt(got / max(1, got.sum()))
    return out


_PLAIN = np.ones(256, bool)
_PLAIN[:65] = False
_PLAIN[91:97] = False
_PLAIN[123:128] = False


def codewords(n: int, bits: int = BITS, seed: int = 11) -> np.ndarray:
    """``n`` rows of ``bits`` signs; of 200 seeded draws the one whose closest rows differ most.

    The first columns set one language apart each, so that no column is constant and no two are told
    apart by chance alone.
    """
    bits = max(bits, n + 3)
    if n == 1:
        return np.ones((1, bits))
    rng, best, most = np.random.default_rng(seed), None, -1.0
    own = np.where(np.eye(n) > 0, 1.0, -1.0)
    for _ in range(200):
        code = np.concatenate([own, rng.choice([-1.0, 1.0], (n, bits - n))], axis=1)
        code[0, (np.abs(code.sum(axis=0)) == n)] *= -1
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) if n > 1 else 1
        if apart > most:
            best, most = code, apart
    return best


def fit(texts: list[str], langs: list[str], dim: int = DIM, steps: int = 150) -> dict:
    """Model: languages, codewords, weights of the bits' classifiers, bit weights, scale."""
    names = sorted(set(langs))
    if not names:
        return {"names": []}
    x = features(texts, dim)
    y = np.array([names.index(v) for v in langs])
    code = codewords(len(names))
    share = np.bincount(y, minlength=len(names)) / len(y)
    row_w = (1 / (len(names) * np.maximum(share, 1e-9)))[y][:, None].astype(np.float32)
    target = ((code[y] + 1) / 2).astype(np.float32)
    scale = np.float32(np.sqrt(dim) / 4)
    mean = x.mean(axis=0)
    w = np.zeros((dim + 1, code.shape[1]), np.float32)
    z = np.concatenate([(x - mean) * scale, np.ones((len(x), 1), np.float32)], axis=1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):  # Adam on the whole sample
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ ((p - target) * row_w) / len(z) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    out = z @ w
    wrong = ((out > 0) != (target > 0.5)).mean(axis=0)
    bit_w = np.clip(0.5 - wrong, 0.01, 0.5)
    if len(names) > 1:
        bit_w = np.where(np.abs(code.sum(axis=0)) == len(names), 0.0, bit_w)
    w[-1] -= (mean * scale) @ w[:-1]
    w[:-1] *= scale
    return {"names": names, "code": code, "w": w, "bit_w": bit_w / max(bit_w.sum(), 1e-9), "dim": dim}


def decode(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, scores (0 to 1) and whether the two nearest codewords are almost equally near."""
    names = model["names"]
    letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~letters
    out = np.concatenate([features(texts[i:i + _ROWS], model["dim"]) @ model["w"][:-1] + model["w"][-1]
                          for i in range(0, len(texts), _ROWS)]) if texts else np.zeros((0, model["code"].shape[1]))
    # logistic loss of each bit under each codeword, weighted
    loss = (np.logaddexp(0, -out[:, None, :] * model["code"][None]) * model["bit_w"]).sum(axis=2)
    near = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 8)
    near /= near.sum(axis=1, keepdims=True)
    best = near.argmax(axis=1)
    ranked = np.sort(near, axis=1)
    second = ranked[:, -2] if len(names) > 1 else np.zeros(len(texts))
    pred = [names[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
    return pred, np.where(letters, ranked[:, -1], 0.0), letters & (ranked[:, -1] - second < AMBIGUOUS)


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows outside the held-out fold, chosen by a hash of the id.

    The hash bound is set by a count of the eligible rows, a little below what would give ``rows``.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    n = usable.count()
    bound = int(min(1.0, max(0.0, rows - 3 * rows**0.5) / max(n, 1) if n > rows else 1.0) * (1 << 30))
    return usable.where(F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 30)) < bound).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).limit(rows)


def predicted(text: Column, model: dict) -> Column:
    """Struct ``lang_pred, score, ambiguous`` of a text column (see ``identify``)."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            pred, score, near = decode(model, s.tolist())
            yield pd.DataFrame({"lang_pred": pred, "score": score, "ambiguous": near})

    return run(F.coalesce(text, F.lit("")))


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, held_out, lang_pred, score, ambiguous``.

    A null text, or one without any letter, is ``und`` with score 0 and not ambiguous; so is every text
    if the model knows no language.  Whole texts are read.  Repeated rows each get a row; a null id is
    not held out.  Only the text decides the prediction; other columns are not read.
    """
    return docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       predicted(F.col(text_col), model).alias("_p")).select("doc_id", "held_out", "_p.*")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = TRAIN_ROWS) -> dict:
    """Fit on a bounded sample of labelled rows; the driver holds at most ``rows`` of them."""
    got = sorted(training_sample(docs, id_col, text_col, lang_col, rows).collect())
    return fit([r[0] for r in got], [r[1] for r in got])
