"""Small awkward inputs and plain counterparts of the operators."""

import re
import zlib

#: Names that operators use inside: extra columns of an input may have them too.
CLASHING = {"_id": 1, "_text": "x", "_salt": 2, "_key": 3, "_keep": 4, "_n": 5, "_digest": "d", "_class": 6, "_name": "n",
            "component": 7, "node": 8, "size": 9, "taken": 10, "kept": True, "score": 0.5, "held_out": "h", "pieces": "p", "_p": 1}
LONG = "lang " * 60_000
SF01 = "/root/testdata/sf0.01"


def held_out(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


def normal(text) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def frame(spark, rows, schema):
    """``rows`` under ``schema``, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.withColumns({c: F.lit(v) for c, v in CLASHING.items() if c not in df.columns})


class Union:
    def __init__(self, items):
        self.root = {i: i for i in items}

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)
