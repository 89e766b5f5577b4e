"""Pieces of a public SentencePiece model file, in the form the operators here need.

A blank begins a word (``▁`` of the model file).  Characters that no piece holds are spelled in
bytes.  Texts are cut into units that no piece can cross: before blanks, at line ends, which no piece
holds, and, if the vocabulary has no piece with anything behind a letter but letters, behind words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNIT = re.compile(r" +[^ \n]*|[^ \n]+|\n")
@dataclass
class Vocabulary:
    """``pieces``: text to id, blanks as blanks; ``bytes``: ids of the 256 byte pieces."""

    pieces: dict[str, int]
    bytes: list[int]
    size: int
    chars: frozenset = field(default_factory=frozenset)
    unit: re.Pattern = _UNIT

    def units(self, text: str | None) -> list[str]:
        """The text behind a blank, cut where no piece can cross; nothing for no text."""
        if not text:
            return []
        return self.unit.findall(" " + text)


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a model file on the driver; what it returns (some MB) goes to the tasks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelled = {}, [0] * 256
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            spelled[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i).replace("▁", " ")] = i
    return of(pieces, spelled, sp.get_piece_size())


def of(pieces: dict[str, int], spelled: list[int], size: int) -> Vocabulary:
    for p in pieces:
        if "\n" in p or " " in p.lstrip(" "):
            raise ValueError(f"a piece holds a blank after a letter, or a line end: {p!r}")
    chars = frozenset("".join(pieces))
    letters = "".join(map(re.escape, sorted(c for c in chars if c.isalpha())))
    unit = _UNIT
    # where letters are only ever followed by letters, a unit ends with its first run of them
    if letters and not any(a in letters and not b.isalpha() for p in pieces for a, b in zip(p, p[1:], strict=False)):
        unit = re.compile(rf"\n| *[^{letters} \n]*[{letters}]+| *[^{letters} \n]+| +")
    return Vocabulary(pieces, spelled, size, chars, unit)
