"""SQL (DuckDB) spellings of the Column expressions, built from the same fixed values."""

from __future__ import annotations

from capset.functions.text import CLEAN_STEPS, WS, WS_CHARS, for_engine


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {q(WS_CHARS)})"


def build_caption(*fields: str) -> str:
    parts = ["chr(10)"]
    for f in fields:
        parts += [f"coalesce({f}, '')", "chr(10)"]
    return "(" + " || ".join(parts) + ")"


def clean_caption(expr: str) -> str:
    out = expr
    for pattern, repl in CLEAN_STEPS:
        out = f"regexp_replace({out}, {q(for_engine(pattern, WS))}, {q(repl)}, 'g')"
    return strip(out)


def collapse_lower(expr: str) -> str:
    inner = f"regexp_replace({expr}, {q(WS + '+')}, ' ', 'g')"
    return f"lower({strip(inner)})"


def english_segment(expr: str, tag: str) -> str:
    t = q(tag)
    seg = (f"array_to_string(list_transform(list_filter(string_split({expr}, chr(10)), "
           f"lambda l: instr(l, {t}) > 0), lambda l: {strip(f'replace(l, {t}, {q('')})')}), chr(10))")
    return f"(CASE WHEN instr({expr}, {t}) > 0 THEN {seg} ELSE {expr} END)"


def pad_id(expr: str, width: int = 9, prefix: str = "") -> str:
    return f"({q(prefix)} || printf('%0{width}d', CAST({expr} AS BIGINT)))"


def shard_dir(expr: str, per_folder: int = 10000, width: int = 5) -> str:
    return f"printf('%0{width}d', CAST(floor(CAST({expr} AS BIGINT) / {per_folder}) AS BIGINT))"


def seeded_md5(key: str, seed) -> str:
    return f"md5(CAST({key} AS VARCHAR) || {q(str(seed))})"


def seeded_bucket(key: str, seed, n: int) -> str:
    return f"(CAST(('0x' || substr({seeded_md5(key, seed)}, 1, 8)) AS BIGINT) % {n})"
