"""Caption text expressions (JVM-side, codegen friendly).

All functions take and return ``Column`` objects, so they compose inside ``select`` and stay
inside whole-stage codegen.  Regular expressions are written once here so that the Spark
(Java regex) form and the DuckDB (RE2) form of the oracles use the same text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
# The caption clean-up steps, applied in this order (pattern in Python ``re`` spelling,
# replacement).  The order matters: the fourth step also removes " ." before a word.
CLEAN_STEPS = (
    (r"^\.+\s+", ""),
    (r"\.\.+", "."),
    (r"\s\s+", " "),
    (r"\s+\.+", ""),
    (r"&amp;", "and"),
)
# ----------------------------------------------------------------------------------------

# ``\s`` of Python ``re`` on ``str`` is Unicode white space (``str.isspace``).  Each engine gets
# its own spelling of that exact set (``tests/test_text.py`` checks both on every code point):
# * Java (Spark): two predicates plus U+0085 -- far cheaper per character than a long class;
# * RE2 (DuckDB oracles): ``\s`` is ASCII there, so the class is spelled out.
WS_JAVA = r"[\p{javaWhitespace}\p{javaSpaceChar}\x{85}]"
WS = (
    r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# What of it can be in a text of ASCII characters: a class that costs a fraction of the other.
WS_ASCII = r"[\t\n\x0b\f\r\x1c-\x1f ]"
# The same set as plain characters, from Python's own definition, for ``trim`` (which only looks
# at the two ends instead of running a regex over the whole text).
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def for_engine(pattern: str, ws_class: str) -> str:
    r"""A clean-up pattern with Python's ``\s`` replaced by an engine's white-space class."""
    return pattern.replace(r"\s", ws_class)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading/trailing Unicode white space (Python's ``str.strip()``): ``trim`` with the
    white-space character set, so only the two ends of the text are looked at."""
    return F.trim(_c(c), F.lit(WS_CHARS))


def _replace(col: Column, pattern: str, replacement: str) -> Column:
    """``regexp_replace`` with ``\\s`` as Python's; texts of ASCII characters take the cheap class."""
    plain = F.octet_length(col) == F.length(col)
    return F.when(plain, F.regexp_replace(col, for_engine(pattern, WS_ASCII), replacement)).otherwise(
        F.regexp_replace(col, for_engine(pattern, WS_JAVA), replacement))


def build_caption(*fields) -> Column:
    """Join description fields with newlines, nulls as empty strings, framed by newlines.

    ``'\\n' + a + '\\n' + b + ... + '\\n'``
    """
    parts = [F.lit("\n")]
    for f in fields:
        parts += [F.coalesce(_c(f), F.lit("")), F.lit("\n")]
    return F.concat(*parts)


def clean_caption(c) -> Column:
    """The five replacements of the caption clean-up, then a Unicode strip.

    Step 1 is anchored at the start and needs a leading dot, so it only runs on texts that
    start with one; step 5 is a literal replacement.
    """
    col = _c(c)
    (p1, r1), (p2, r2), (p3, r3), (p4, r4), (lit5, r5) = CLEAN_STEPS
    out = F.when(col.startswith("."), F.regexp_replace(col, for_engine(p1, WS_JAVA), r1)).otherwise(col)
    out = F.regexp_replace(out, p2, r2)
    out = _replace(out, p3, r3)
    out = _replace(out, p4, r4)
    out = F.replace(out, F.lit(lit5), F.lit(r5))
    return strip(out)


def english_segment(c, tag: str = "English:") -> Column:
    """Keep only the lines that hold ``tag`` (tag removed, each line stripped) when any does."""
    col = _c(c)
    lines = F.split(col, "\n")
    kept = F.filter(lines, lambda l: F.instr(l, tag) > 0)
    cleaned = F.transform(kept, lambda l: strip(F.replace(l, F.lit(tag), F.lit(""))))
    return F.when(F.instr(col, tag) > 0, F.array_join(cleaned, "\n")).otherwise(col)


def collapse_lower(c) -> Column:
    """Collapse white space runs to one blank, strip, lower-case."""
    return F.lower(strip(_replace(_c(c), r"\s+", " ")))


def word_pieces(c) -> Column:
    """Split on white-space runs; may hold an empty first/last piece (for ``explode`` + filter)."""
    return F.split(_c(c), WS_JAVA + "+")


def words(c) -> Column:
    """Split a caption in words on white space; empty words dropped."""
    return F.array_remove(F.split(_c(c), WS_JAVA + "+"), "")


def decode_utf8(c) -> Column:
    return F.decode(_c(c), "UTF-8")


# What ``html.unescape`` takes for a reference, behind its ``&``; a reference never holds another ``&``.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def html_unescape(c) -> Column:
    """Full HTML5 entity decoding (Python's ``html.unescape``).

    The text is cut at its ``&`` and put together again in the JVM; an Arrow UDF gets the references alone, so
    Python holds no text."""
    parts = F.split(_c(c), "&")
    rest = F.slice(parts, F.lit(2), F.size(parts) - 1)
    refs = F.transform(rest, lambda p: F.regexp_extract(p, REFERENCE, 1))
    values = _references_udf()(F.coalesce(refs, F.array().cast("array<string>")))
    decoded = F.zip_with(rest, values, lambda p, v: F.concat(v, F.substr(p, F.length(F.regexp_extract(p, REFERENCE, 1)) + 1)))
    return F.concat(F.element_at(parts, 1), F.array_join(decoded, ""))


_REFERENCES = None


def _references_udf():
    global _REFERENCES
    if _REFERENCES is None:

        @F.arrow_udf("array<string>")
        def _decode(refs: pa.Array) -> pa.Array:
            import html

            found = refs.values.dictionary_encode()
            values = pa.array([html.unescape("&" + r) for r in found.dictionary.to_pylist()], refs.type.value_type)
            return type(refs).from_arrays(refs.offsets, values.take(found.indices))

        _REFERENCES = _decode
    return _REFERENCES
