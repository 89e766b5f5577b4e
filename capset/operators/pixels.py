"""Pixel resampling (re-aimed image resize): area averaging on raw pixels with numpy.

Input is Spark's ``image`` source struct (``origin, height, width, nChannels, mode, data`` with
BGR(A) bytes).  ``resize_to_cover`` scales every image to the cover-fit size of a box
(``max(W/w, H/h)``, truncated like Python's ``int``), flattening alpha onto white and forcing
3 channels.  It runs as ``mapInPandas``: Arrow batches of rows, numpy per image, no row-at-a-time
Python UDF.  Encoding the result to JPEG is not done (no codec in the container); the output is
a raw-pixel table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

OUT_SCHEMA = "origin string, height int, width int, nChannels int, data binary"


def _at(table: np.ndarray, places: np.ndarray, axis: int) -> np.ndarray:
    """Running sums at fractional places: between two pixels' edges they rise evenly."""
    low = np.minimum(places.astype(int), table.shape[axis] - 2)
    part = (places - low).reshape([-1 if k == axis else 1 for k in range(table.ndim)])
    return np.take(table, low, axis) * (1 - part) + np.take(table, low + 1, axis) * part


def _area_resize(img: np.ndarray, new_h: int, new_w: int) -> np.ndarray:
    """Box filter: each output pixel is the mean of the input it covers, pixels that it covers in part by their share.

    Sums come from a summed-area table, read at fractional edges; means (to six digits) are rounded, halves to even."""
    h, w, c = img.shape
    table = np.zeros((h + 1, w + 1, c))
    table[1:, 1:] = img.astype(np.float64).cumsum(0).cumsum(1)
    ys, xs = np.arange(new_h + 1) * h / new_h, np.arange(new_w + 1) * w / new_w
    sums = np.diff(np.diff(_at(_at(table, ys, 0), xs, 1), axis=0), axis=1)
    return np.clip(np.rint(np.round(sums * new_h * new_w / (h * w), 6)), 0, 255).astype(np.uint8)


def _to_rgb(img: np.ndarray) -> np.ndarray:
    if img.shape[2] == 1:
        return np.repeat(img, 3, axis=2)
    if img.shape[2] == 4:  # BGRA: blend onto white
        a = img[..., 3:4].astype(np.float64) / 255.0
        return np.rint(img[..., :3] * a + 255.0 * (1 - a)).astype(np.uint8)
    return img[..., :3]


def resize_to_cover(images: DataFrame, box_w: int = 256, box_h: int = 256, col: str = "image") -> DataFrame:
    """Raw-pixel images resized to cover ``box_w x box_h``; invalid images are skipped."""
    flat = images.select(f"{col}.origin", f"{col}.height", f"{col}.width", f"{col}.nChannels", f"{col}.data")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for o, h, w, c, data in zip(pdf.origin, pdf.height, pdf.width, pdf.nChannels, pdf.data):
                if h is None or h <= 0 or w <= 0 or data is None:
                    continue
                img = np.frombuffer(data, dtype=np.uint8).reshape(h, w, c)
                img = _to_rgb(img)
                a = max(box_w / w, box_h / h)
                nw, nh = int(w * a), int(h * a)
                res = _area_resize(img, nh, nw)
                out.append((o, nh, nw, 3, res.tobytes()))
            yield pd.DataFrame(out, columns=["origin", "height", "width", "nChannels", "data"])

    return flat.mapInPandas(run, OUT_SCHEMA)
