"""Caption expressions against plain-Python versions of the same rules."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from capset.functions import ids as I
from capset.functions import text as T

SAMPLES = [
    "\n.. Hello  world ..\nsecond line&amp;more \n\n",
    "...   leading dots",
    "A caption . with dots.. and   spaces",
    "non breaking spaces　here",
    "sep\x1cchars\x1fhere",
    "English: first\nDeutsch: zweite\nEnglish:  third ",
    "",
    "tab\tand\vvertical\fform",
]


def py_clean(x: str) -> str:
    from capset.functions.text import CLEAN_STEPS

    for step in CLEAN_STEPS:
        x = re.sub(step[0], step[1], x)
    return x.strip()


#: Text, and what the segment of the tag "English:" is.
SEGMENTS = [
    ("English: first\nDeutsch: zweite\nEnglish:  third ", "first\nthird"),
    ("Deutsch: eins\nFrançais: un", "Deutsch: eins\nFrançais: un"),
    ("one English: two", "one  two"),
    ("English:", ""),
    ("English:\nEnglish: b", "\nb"),
    ("\u3000English: wide\u3000\n", "wide"),
    (" no tag, spaces stay ", " no tag, spaces stay "),
    ("", ""),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")


def test_clean_caption_matches_python(df):
    got = {r.i: r.c for r in df.select("i", T.clean_caption("s").alias("c")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == py_clean(s), (i, s)


def test_build_caption_then_clean(spark):
    d = spark.createDataFrame([("a..", None, " b")], "x string, y string, z string")
    got = d.select(T.clean_caption(T.build_caption("x", "y", "z")).alias("c")).first().c
    assert got == py_clean("\n" + "a.." + "\n" + "" + "\n" + " b" + "\n")


def test_english_segment(spark):
    df = spark.createDataFrame(SEGMENTS, "s string, want string")
    got = df.select("s", "want", T.english_segment("s", "English:").alias("c")).collect()
    assert [(r.s, r.c) for r in got] == SEGMENTS


def test_collapse_lower(df):
    got = {r.i: r.c for r in df.select("i", T.collapse_lower("s").alias("c")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == re.sub(r"\s+", " ", s).strip().lower()


def test_words(df):
    got = {r.i: r.w for r in df.select("i", T.words("s").alias("w")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == s.split()


def test_html_unescape(spark):
    vals = ["a &amp; b", "&lt;p&gt; &quot;q&quot; &#39;s", "&copy; 2024 &eacute;", "&amp;lt;", None]
    d = spark.createDataFrame([(v,) for v in vals], "s string")
    full = [r.u for r in d.select(T.html_unescape("s").alias("u")).collect()]
    assert full == [html.unescape(v) if v is not None else None for v in vals]


def test_html_unescape_of_awkward_texts(spark):
    rng = random.Random(4)
    bits = ["&", "&&", "amp", ";", "#", "x", "#x41", "#65;", "#128;", "#0", "#xD800;", "#1114112;", "#11;", "notit;", "not", "&CounterClockwiseContourIntegral;",
            "\n", " ", "<", "\u00e9", "\U0001F600", "&NotEqualTilde;", "&nosuchname;", "a" * 40, "&lt", "&#X1F600;", ""]
    vals = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(400)] + ["", "&", None, "no reference", "&" * 5000, None]
    d = spark.createDataFrame(list(enumerate(vals)), "i int, s string").repartition(3)
    got = {r.i: r.u for r in d.select("i", T.html_unescape("s").alias("u")).collect()}
    assert [got[i] for i in range(len(vals))] == [html.unescape(v) if v is not None else None for v in vals]


def test_html_unescape_gives_python_references_alone():
    import pyarrow as pa

    refs = pa.array([["x"], ["amp;", "#65;", ""], [], ["lt", "amp;"]])
    assert T._references_udf().func(refs[1:]).to_pylist() == [["&", "A", "&"], [], ["<", "&"]]


def test_ids(spark):
    d = spark.createDataFrame([(0,), (42,), (12345,), (1234567890,)], "id long")
    r = d.select(I.pad_id("id", 9).alias("k"), I.pad_id("id", 8, "w").alias("w"),
                 I.shard_dir("id").alias("f")).collect()
    assert [x.k for x in r] == ["%09d" % v for v in (0, 42, 12345, 1234567890)]
    assert r[3].k == "1234567890"  # longer ids keep every digit
    assert [x.w for x in r] == ["w" + "%08d" % v for v in (0, 42, 12345, 1234567890)]
    assert [x.f for x in r] == ["%05d" % (v // 10000) for v in (0, 42, 12345, 1234567890)]


def test_paths(spark):
    paths = ["data/w00000/w00000003.txt", "a/b/IMG.JPEG", "x/y.tar.gz", "https://h.example.com/en/12.html?x=1",
             "noext", "https://h.example.com/a/176/"]
    d = spark.createDataFrame([(p,) for p in paths], "p string")
    r = d.select(I.base_name("p").alias("b"), I.stem("p").alias("s"), I.extension("p").alias("e"),
                 I.numeric_id("p").alias("n")).collect()
    assert [x.b for x in r] == ["w00000003.txt", "IMG.JPEG", "y.tar.gz", "12.html", "noext", "176"]
    assert [x.s for x in r] == ["w00000003", "IMG", "y.tar", "12", "noext", "176"]
    assert [x.e for x in r] == ["txt", "jpeg", "gz", "html", "", ""]
    assert [x.n for x in r] == [3, None, None, 12, None, 176]


def test_white_space_classes_equal_python_on_every_code_point(spark):
    import duckdb
    import pandas as pd

    rows = [(i, chr(i)) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    expect = {i for i, c in rows if c.isspace()}
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["i", "c"]))
    java = {r.i for r in df.where(F.col("c").rlike("^" + T.WS_JAVA + "$")).select("i").collect()}
    assert java == expect
    con = duckdb.connect()
    con.register("cp", pd.DataFrame(rows, columns=["i", "c"]))
    re2 = {r[0] for r in con.execute(f"SELECT i FROM cp WHERE regexp_full_match(c, '{T.WS}')").fetchall()}
    assert re2 == expect
    assert set(map(ord, T.WS_CHARS)) == expect
