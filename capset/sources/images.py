"""Image files from pixels: BMP and PNG, written by tasks.

Pixels are those of Spark's ``image`` source: rows from the top, three bytes (blue, green, red) each.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.sources.tarshard import _fs


def encode_bmp(width: int, height: int, data: bytes) -> bytes:
    """24 bits a pixel, rows from the bottom, each filled up to four bytes."""
    fill = bytes(-3 * width % 4)
    rows = b"".join(data[y * 3 * width:(y + 1) * 3 * width] + fill for y in range(height - 1, -1, -1))
    head = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(rows), 2835, 2835, 0, 0)
    return struct.pack("<2sIHHI", b"BM", 14 + len(head) + len(rows), 0, 0, 14 + len(head)) + head + rows


def encode_png(width: int, height: int, data: bytes) -> bytes:
    """Eight bits red, green, blue; rows without a filter."""
    import numpy as np

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rgb = np.frombuffer(data, np.uint8).reshape(height, width, 3)[:, :, ::-1]
    rows = b"".join(b"\0" + rgb[y].tobytes() for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) \
        + chunk(b"IEND", b"")


_ENCODERS = {"bmp": encode_bmp, "png": encode_png}


def encoded(ext: Column, width: Column, height: Column, data: Column) -> Column:
    """The image file as bytes; null where a part is null or the pixels are not ``3 * width * height`` bytes."""
    @F.pandas_udf("binary")
    def run(e: pd.Series, w: pd.Series, h: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([_ENCODERS[a](int(b), int(c), x) if x is not None and a in _ENCODERS and len(x) == 3 * b * c and b * c > 0 else None
                          for a, b, c, x in zip(e, w, h, d, strict=True)], dtype=object)

    return run(ext, width, height, data)


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write each row's ``content`` to the file ``name`` below ``path``; ``name, bytes`` of what was written.

    Files are written whole under their names by the tasks, so a repeated attempt writes the same file again.  Runs at once; rows
    without a content write no file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = _fs(path)
        made = set()
        for part in batches:
            part = part[part["_content"].notna()]
            for n, c in zip(part["_name"], part["_content"], strict=True):
                where = posixpath.join(base, n)
                folder = posixpath.dirname(where)
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                with filesystem.open_output_stream(where, compression=None) as out:
                    out.write(bytes(c))
            yield pd.DataFrame({"name": part["_name"], "bytes": part["_content"].map(len).astype("int64")})

    from capset.session import scratch_path

    log = scratch_path(df.sparkSession, "written")
    df.select(F.col(name).alias("_name"), F.col(content).alias("_content")).mapInPandas(run, "name string, bytes long").write.parquet(log)
    return df.sparkSession.read.schema("name string, bytes long").parquet(log)
