"""BPE encoding by a transducer of bounded lookahead, and decoding by a byte-to-text machine.

Merges are made in the order of the list.  What follows a known prefix can only change the tokens at its end,
and how far back is a property of the list (``MergeList.lookahead``).  So the transducer keeps a short
rest of a word, emits each token once it can no longer change, and a word of any length needs constant memory.

*Sufficient lookahead.*  Left of some place two continuations have the same tokens.  A rule ``(u, v)``
that joins the last of them with what is right of the place in one continuation alone moves the place back by
``u``.  From then on the token right of the place begins with ``u``, so the next rule that moves the place,
which is later in the list, has a ``v`` that was built from ``u`` on its left side.  The longest such chain, in
bytes, bounds how far back the place can come.  It is found in one pass over the list.  That needs a list
in which every rule's parts are bytes or made by earlier rules; others are refused.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

DEFAULT_FILE = "/opt/tokenizers/word_bpe_49k.json"
#: Symbols that a transducer takes in, beyond its lookahead, before it looks for stable tokens.
STEP = 1024
#: Symbols up to which pairs are looked through one by one.
SHORT = 48
#: Characters of a text that are looked at together, and of the words whose tokens a task keeps (each
#: counts 64 more), twice.
SLICE, KEPT = 1 << 18, 1 << 25
#: Characters whose new words are merged side by side.
GROUP = 1 << 21
#: Characters for which Python's tables and the library's agree (tests hold them together).
_PLAIN = regex.compile("[\\x00-ԯ -⁯]*")
_BLANKS = regex.compile("[\t-\r \x85\xa0  -     　]+")


_PAIR = 1 << 24  # ids are smaller


def byte_letters() -> list[str]:
    """The letter of each byte in a byte-level vocabulary: itself where it prints, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


@dataclass
class MergeList:
    """Ids of the bytes inside a word and at its end, and of rules: ``(left id, right id)`` to (rank, id)."""

    inner: list[int]
    final: list[int]
    rules: dict[tuple[int, int], tuple[int, int]]
    size: dict[int, int] = field(default_factory=dict)  # bytes of a token
    lookahead: int = 0
    token: list[int] = field(default_factory=list)  # by rank
    rank: dict[tuple[int, int], int] = field(default_factory=dict)
    ended: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        self.size = dict.fromkeys([*self.inner, *self.final], 1)
        first: dict[int, int] = {}  # left part of a token
        reach: dict[int, int] = {}  # longest chain that ends with a rule of this left part
        ranks = [rank for rank, _ in self.rules.values()]
        if ranks != sorted(ranks):
            raise ValueError("rules out of order")
        for (u, v), (_, token) in self.rules.items():
            if u not in self.size or v not in self.size or token in self.size:
                raise ValueError("a rule before its parts are made, or a token made twice")
            chain, part = reach.get(v, 0), v
            while part in first:
                part = first[part]
                chain = max(chain, reach.get(part, 0))
            chain += self.size[u]
            reach[u] = max(reach.get(u, 0), chain)
            self.lookahead = max(self.lookahead, chain)
            self.size[token], first[token] = self.size[u] + self.size[v], u
        self.token = [token for _, token in self.rules.values()]
        self.rank = {pair: n for n, pair in enumerate(self.rules)}
        self.ended = dict(zip(self.inner, self.final, strict=True))
        key = np.array([left * _PAIR + right for left, right in self.rules], np.int64)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def merge(self, symbols: list[int]) -> list[int]:
        """Make the rules in their order, each from left to right."""
        if len(symbols) > SHORT:
            return self._merge_long(symbols)
        rank, never, now = self.rank, len(self.token), list(symbols)
        ranks = [rank.get(p, never) for p in zip(now, now[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            now[at:at + 2] = [self.token[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get((now[at - 1], now[at]), never)
            if at < len(ranks):
                ranks[at] = rank.get((now[at], now[at + 1]), never)
        return now

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * _PAIR + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], len(self.token)) if len(self.keys) else np.full(key.shape, len(self.token))

    def merge_words(self, words: list[bytes]) -> list[list[int]]:
        """Whole words side by side, each as ``merge`` does it: a step makes each word's next merge."""
        out: list[list[int]] = [[] for _ in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        inner, final, token, low = np.array(self.inner), np.array(self.final), np.array([*self.token, 0]), 0
        for width in (8, 16, SHORT):
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            if not len(rows):
                continue
            n = size[rows]
            now = np.full((len(rows), width), -1, np.int64)  # symbols, filled up with what no rule knows
            now[np.arange(width) < n[:, None]] = inner[np.frombuffer(b"".join([words[r] for r in rows.tolist()]), np.uint8)]
            last = np.frombuffer(bytes(words[r][-1] for r in rows.tolist()), np.uint8)
            now[np.arange(len(rows)), n - 1] = final[last]
            ranks = self._ranks(now[:, :-1], now[:, 1:])
            while len(rows):
                at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
                best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), len(self.token))
                done = best == len(self.token)
                if done.any():
                    for r, symbols in zip(rows[done].tolist(), now[done].tolist(), strict=True):
                        out[r] = [x for x in symbols if x >= 0]
                    go = ~done
                    rows, now, ranks, at, best = rows[go], now[go], ranks[go], at[go], best[go]
                    if not len(rows):
                        break
                every = np.arange(len(rows))
                now[every, at] = token[best]
                keep = np.ones(now.shape, bool)
                keep[every, at + 1] = False
                now = now[keep].reshape(len(rows), -1)
                keep = np.ones(ranks.shape, bool)
                keep[every, at] = False
                ranks = ranks[keep].reshape(len(rows), -1)
                for k in (at - 1, at):  # the pairs on either side are new
                    fits = np.flatnonzero((k >= 0) & (k < ranks.shape[1]))
                    ranks[fits, k[fits]] = self._ranks(now[fits, k[fits]], now[fits, k[fits] + 1])
        return out

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap of the pairs."""
        rules, n = self.rules, len(symbols)
        now, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*rules[p][:1], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in rules]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if now[i] != left or j >= n or now[j] != right:
                continue  # merged otherwise since
            now[i], now[j] = rules[left, right][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (now[i], now[k]) in rules:
                    heapq.heappush(heap, (rules[now[i], now[k]][0], i, now[i], now[k]))
            h = before[i]
            if h >= 0 and (now[h], now[i]) in rules:
                heapq.heappush(heap, (rules[now[h], now[i]][0], h, now[h], now[i]))
        return [s for s in now if s >= 0]


class Transducer:
    """Bytes of a word in, in any portions; ids out as soon as nothing that follows can change them."""

    def __init__(self, merges: MergeList):
        self.merges, self.rest = merges, []

    def feed(self, data: bytes) -> list[int]:
        merges, out = self.merges, []
        window = merges.lookahead + STEP
        for at in range(0, len(data), STEP):
            self.rest += [merges.inner[b] for b in data[at:at + STEP]]
            if len(self.rest) > window:
                stable, done = len(self.rest) - 1 - merges.lookahead, 0  # the last byte may end the word
                for token in merges.merge(self.rest):
                    if done + merges.size[token] > stable:
                        break
                    out.append(token)
                    done += merges.size[token]
                self.rest = self.rest[done:]
        return out

    def finish(self) -> list[int]:
        """The word ends here."""
        rest, self.rest = self.rest, []
        if rest:
            rest[-1] = self.merges.ended[rest[-1]]
        return self.merges.merge(rest)


@dataclass
class WordVocabulary:
    """A public vocabulary file: merge list, word pattern, tokens of their own, and the file's text."""

    merges: MergeList
    words: str
    special: dict[str, int]
    tokens: dict[int, str]
    end: str
    source: str


def load(path: str = DEFAULT_FILE) -> WordVocabulary:
    """Read a vocabulary file (BPE with word ends over bytes) on the driver; some MB go to the tasks."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    ids = model["vocab"]
    letters = byte_letters()
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    rules = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {i: t for t, i in [*ids.items(), *special.items()]}
    return WordVocabulary(MergeList([ids[c] for c in letters], [ids[c + end] for c in letters], rules),
                          split["pattern"]["Regex"], special, tokens, end, source)


class Words:
    """Texts to the words of the pre-tokenizer (normalised, lower case) and to tokens of their own."""

    def __init__(self, vocabulary: WordVocabulary):
        from tokenizers import Tokenizer

        self.find = regex.compile(vocabulary.words).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        # normalisation and word pattern of the library, for characters that tables of other years class otherwise
        self.library = Tokenizer.from_str(vocabulary.source)
        self.bytes = {c: b for b, c in enumerate(byte_letters())}

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # character by character: a capital sigma at a word's end has no form of its own
        return self.find("".join(map(str.lower, text)) if "Σ" in text else text.lower())

    def _other(self, text: str) -> list[str]:
        text = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.bytes.__getitem__, w)).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def slices(self, text: str) -> Iterator[str]:
        """Parts of about ``SLICE`` characters, cut before a blank, which no word holds."""
        at = 0
        while len(text) - at > SLICE:
            cut = _BLANKS.search(text, at + SLICE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def of(self, part: str) -> list[str | tuple[str]]:
        """The words of a part; tokens of their own stand alone in a tuple."""
        if self.special and "<" in part:
            words: list[str | tuple[str]] = []
            for n, own in enumerate(self.special.split(part)):
                words += [(own,)] if n % 2 else self._words(own)
            return words
        return self._words(part)

    def _words(self, part: str) -> list[str]:
        if part.isascii() or _PLAIN.fullmatch(part):
            return self._plain(part)
        # what stands between blanks has words of its own; only some of it needs the library
        return [w for piece in _BLANKS.split(part) for w in (self._plain(piece) if _PLAIN.fullmatch(piece) else self._other(piece))]


class Encoder:
    """Texts to ids.  The tokens of distinct words of up to ``KEPT`` characters in all are kept."""

    def __init__(self, vocabulary: WordVocabulary):
        self.vocabulary, self.words = vocabulary, Words(vocabulary)
        self.transducer, self.known = Transducer(vocabulary.merges), _Words()

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of the text; none for null."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waits: list[tuple[int, list]] = []
        size = 0
        for n, text in enumerate(texts):
            for part in self.words.slices(text or ""):
                waits.append((n, self.words.of(part)))
                size += len(part)
                if size > GROUP:
                    self._encode(waits, out)
                    waits, size = [], 0
        self._encode(waits, out)
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in out]

    def _encode(self, waits: list[tuple[int, list]], out: list[list[np.ndarray]]) -> None:
        """The words of parts of texts, by number; those not met before are encoded together."""
        known = self.known
        known.trim()
        numbers = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for _, words in waits]
        self._add_new()
        begin, ids = np.frombuffer(known.begin, np.int64), np.frombuffer(known.ids, np.int32)
        for (n, _), number in zip(waits, numbers, strict=True):
            size = begin[number + 1] - begin[number]
            ahead = np.cumsum(size) - size
            out[n].append(ids[np.arange(int(size.sum())) + np.repeat(begin[number] - ahead, size)])

    def _add_new(self) -> None:
        known = self.known
        numbers, ids, begin = known.old
        found: dict = {}
        for w in known.new:
            n = numbers.get(w)
            if n is not None:
                found[w] = ids[begin[n]:begin[n + 1]]
        fresh = [w for w in known.new if w not in found]
        spelled = [w.encode() if isinstance(w, str) else b"" for w in fresh]
        short = [k for k, data in enumerate(spelled) if 0 < len(data) <= SHORT]
        found.update(zip([fresh[k] for k in short], self.vocabulary.merges.merge_words([spelled[k] for k in short]), strict=True))
        for w, data in zip(fresh, spelled, strict=True):
            if isinstance(w, tuple):
                found[w] = [self.vocabulary.special[w[0]]]
            elif len(data) > SHORT:  # in steps, however long
                found[w] = self.transducer.feed(data) + self.transducer.finish()
        known.add([found[w] for w in known.new])


class _Words(dict):
    """Numbers words as they are first looked up (``new``); ``ids[begin[n]:begin[n + 1]]`` are the tokens of word ``n``."""

    def __init__(self):
        self.old = ({}, array("i"), array("q"))
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.begin, self.letters, self.new = array("i"), array("q", [0]), 0, []

    def trim(self) -> None:
        """When there are many, begin anew; what comes up again is taken from those before."""
        if self.letters > KEPT:
            self.old = (dict(self), self.ids, self.begin)
            self.clear()

    def __missing__(self, word) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def add(self, tokens: list) -> None:
        """The tokens of the new words, in their order."""
        for t in tokens:
            self.ids.extend(t)
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begin.extend((np.cumsum(size) + self.begin[-1]).tolist())
        self.letters += sum(map(len, self.new)) + 64 * len(self.new)
        self.new = []


class Decoder:
    """Ids in, in any portions, text out: bytes wait until they make a whole character.

    With ``marks`` tokens come as they stand in the vocabulary, one blank between them (as the library shows
    them).  Without, bytes are bytes again, the word end is a blank, and bytes that no character
    has become U+FFFD.
    """

    def __init__(self, vocabulary: WordVocabulary, marks: bool = True):
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        own = set(vocabulary.special.values())
        spelled = [b""] * (max(vocabulary.tokens) + 1)
        for i, token in vocabulary.tokens.items():
            if marks:
                spelled[i] = b" " + token.encode()
            elif i in own:
                spelled[i] = token.encode()
            else:
                inside = token.removesuffix(vocabulary.end)
                spelled[i] = bytes(to_byte[c] for c in inside) + b" " * (inside != token)
        self.known = np.zeros(len(spelled), bool)
        self.known[list(vocabulary.tokens)] = True
        self.spelled, self.marks = spelled, marks
        self.reset()

    def reset(self) -> None:
        self.text = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = not self.marks

    def feed(self, ids: np.ndarray) -> str:
        """The characters that are whole after ``ids``; an id that the vocabulary has not raises."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise IndexError("an id that the vocabulary does not have")
        data = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        if not self.started and data:
            data, self.started = data[1:], True  # no blank before the first token
        return self.text.decode(data)

    def finish(self) -> str:
        rest = self.text.decode(b"", final=True)
        self.reset()
        return rest


_LAST: dict[str, Encoder] = {}


def _encoder(vocabulary: WordVocabulary) -> Encoder:
    """A worker keeps one encoder, with the words it knows (a bounded number), from task to task."""
    if "it" not in _LAST or _LAST["it"].vocabulary is not vocabulary:
        _LAST["it"] = Encoder(vocabulary)
    return _LAST["it"]


def _frame(ids: list[np.ndarray], texts: list[str]) -> list[pa.Array]:
    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
    return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(texts, pa.string())]


def encode_decode(docs: DataFrame, vocabulary: WordVocabulary, id_col: str = "doc_id", text_col: str = "text",
                  marks: bool = True) -> DataFrame:
    """One row per row: ``doc_id, ids, decoded`` (ids of the whole text, and what they decode to).

    Null and empty texts have no ids and decode to an empty text.  Repeated rows each get a row;
    null ids stay null; other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(shared.value), Decoder(shared.value, marks)
        for batch in batches:
            start, letters, texts = 0, 0, []
            for n, text in enumerate(batch.column(1)):
                texts.append(text.as_py())
                letters += len(texts[-1] or "")
                if letters > GROUP or n + 1 == batch.num_rows:
                    ids = encoder.encode_all(texts)
                    decoded = [decoder.feed(i) + decoder.finish() for i in ids]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, n + 1 - start), *_frame(ids, decoded)],
                                                     names=["doc_id", "ids", "decoded"])
                    start, letters, texts = n + 1, 0, []

    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType),
                         StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: WordVocabulary, ids_col: str = "ids", out_col: str = "text",
               marks: bool = False) -> DataFrame:
    """``rows`` with ``out_col``: the text of the ids; null ids give null, no ids an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(shared.value, marks)
        for s in batches:
            yield s.map(lambda ids: None if ids is None else decoder.feed(ids) + decoder.finish())

    return rows.withColumn(out_col, decoded(F.col(ids_col)))
