"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2 c) apart, so the pairs wanted are those within a distance
epsilon.  Vectors are projected on a few leading principal dimensions (an orthonormal basis fitted on a
bounded sample: distances of projections are never larger), sorted by their cells of width epsilon,
and cut in that order into intervals: blocks, and ranges of blocks.  The join goes down
recursively, as Spark joins over the small table of intervals: pairs of ranges whose boxes
are at most epsilon apart, then pairs of their blocks, then, in the task that two blocks meet in, halves of
them down to small intervals.  Cosines are computed in double precision.

Equal vectors are one class; a class stands for all its members in the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capset.llm.common import salt_bit, salt_of, salts_in
from capset.llm.components import components

#: Vectors that the principal dimensions are fitted on, at most.
SAMPLE = 4_000
LEADING = 8
BLOCK = 4096
#: Blocks of a range, the first level of the recursive join.
RANGE = 32
#: The join goes down to intervals of this many vectors inside a task.
LEAF = 128


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    # scaled first: squares of very large or small components would leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vec) -> F.Column:
    """Not null, not empty, all components finite numbers, one of them not zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def principal(vectors: DataFrame, leading: int = LEADING, rows: int = SAMPLE) -> np.ndarray | None:
    """Mean and leading directions of at most ``rows`` vectors, chosen by a hash; of the longest kind."""
    n = vectors.count()
    bound = int((1.0 if n <= rows else (rows - 3 * rows**0.5) / n) * (1 << 30))
    got = vectors.where(F.pmod(F.xxhash64("_vec", F.lit(4)), F.lit(1 << 30)) <= bound).limit(rows).select("_vec").collect()
    if not got:
        return None
    dim = max(len(r[0]) for r in got)
    x = _unit(pd.Series(sorted(tuple(r[0]) for r in got if len(r[0]) == dim)))
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True).reshape(dim, dim))
    return basis[:, np.argsort(-values)[:leading]].T


def _near_intervals(p: np.ndarray, a: tuple[int, int], b: tuple[int, int], eps: float) -> Iterator[tuple[int, int, int, int]]:
    """Leaf intervals of ``a`` and ``b`` (of the rows of ``p``) that are not provably more than ``eps`` apart."""
    one, two = p[a[0]:a[1]], p[b[0]:b[1]]
    gap = np.maximum(0, np.maximum(one.min(axis=0) - two.max(axis=0), two.min(axis=0) - one.max(axis=0)))
    if (gap * gap).sum() > eps * eps:
        return
    if max(a[1] - a[0], b[1] - b[0]) <= LEAF:
        yield (*a, *b)
        return

    def halves(x: tuple[int, int]) -> list[tuple[int, int]]:
        middle = (x[0] + x[1]) // 2
        return [(x[0], middle), (middle, x[1])] if x[1] - x[0] > LEAF else [x]

    for i, left in enumerate(halves(a)):
        for right in halves(b)[i if a == b else 0:]:
            yield from _near_intervals(p, left, right, eps)


def _links(x: np.ndarray, p: np.ndarray, cut: int, weight: np.ndarray, cosine: float, eps: float):
    """Weighted link counts, and links that span what the links connect: of the rows before ``cut`` with
    those from it on, or of all rows with each other if there is no cut (0)."""
    n = len(x)
    count, root, links = np.zeros(n, np.int64), np.arange(n), []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    a, b = ((0, cut), (cut, n)) if cut else ((0, n), (0, n))
    for a0, a1, b0, b1 in _near_intervals(p, a, b, eps):
        near = x[a0:a1] @ x[b0:b1].T >= cosine
        if (a0, a1) == (b0, b1):
            near = np.triu(near, 1)
        if not near.any():
            continue
        count[a0:a1] += near @ weight[b0:b1]
        count[b0:b1] += near.T @ weight[a0:a1]
        for i, j in zip(*np.nonzero(near), strict=True):
            r, s = find(a0 + int(i)), find(b0 + int(j))
            if r != s:
                root[max(r, s)] = min(r, s)
                links.append((a0 + int(i), b0 + int(j)))
    return count, links


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                 leading: int = LEADING, block: int = BLOCK) -> DataFrame:
    """One row per row: ``vec_id, n_links, component_id, kept``.

    Vectors are linked if their cosine, in double precision, is at least ``cosine``.  Vectors that are null,
    empty or zero or hold null or non-finite components link with nothing; vectors of different length do
    not link.  Equal vectors are linked with each other.  Rows that repeat an id are vectors of their
    own that share a component.  Ids are integers; a null id is linked and counted, but never names
    a component (null, and kept, if it has no other).  An empty table gives an empty result.
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    wide = "double" in vectors.schema[vec_col].dataType.simpleString()  # floats travel as floats
    kind = "double" if wide else "float"
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast(f"array<{kind}>").alias("_vec"))
    good = rows.where(usable(F.col("_vec"))).withColumns({"_digest": F.sha2(_bytes("_vec"), 256), "_salt": salt_of(F.col("_id"))})
    part = good.groupBy("_digest", "_salt").agg(F.min("_id").alias("_class"), F.count(F.lit(1)).alias("_n"))
    whole = part.groupBy("_digest").agg(F.min("_class").alias("_class"), F.sum("_n").alias("_n"),
                                        F.bit_or(salt_bit(F.col("_salt"))).alias("_mask"))
    heads = whole.select("_digest", "_class", "_n", salt_of(F.col("_class")).alias("_salt"))
    reps = good.join(heads, ["_digest", "_salt"]).where("_id <=> _class").dropDuplicates(["_digest"]).select(
        "_digest", "_class", "_n", "_vec")
    basis = principal(reps, leading)
    linked = None
    if basis is not None:
        linked = _join(reps, basis, cosine, eps, block, np.float64 if wide else np.float32)
    spark = vectors.sparkSession
    if linked is None:
        counts = spark.createDataFrame([], "_digest string, n_links long")
        edges = spark.createDataFrame([], "u long, v long")
    else:
        counts = linked.where("u is null").groupBy("_digest").agg(F.sum("n").alias("n_links"))
        edges = linked.where("u is not null").select("u", "v")
    # classes are joined under their digests' numbers; a component is named by its least id that is not null
    member = components(edges).withColumnRenamed("node", "_node").join(whole.select(_node().alias("_node"), "_class"), "_node")
    salted = member.withColumn("_part", salt_of(F.col("_node")))
    least = salted.groupBy("component", "_part").agg(F.min("_class").alias("_least")).groupBy("component").agg(
        F.min("_least").alias("_least"), F.collect_set("_part").alias("_parts"))
    comp = salted.join(least.select("component", "_least", F.explode("_parts").alias("_part")), ["component", "_part"]).select("_node", "_least")
    named = whole.withColumn("_node", _node()).join(counts, "_digest", "left").join(comp, "_node", "left").select(
        "_digest", (F.coalesce("n_links", F.lit(0).cast("long")) + F.col("_n") - 1).alias("n_links"),
        F.coalesce("_least", "_class").alias("component_id"), F.explode(salts_in(F.col("_mask"))).alias("_salt"))
    found = good.select("_id", "_digest", "_salt").join(named, ["_digest", "_salt"]).select("_id", "n_links", "component_id")
    alone = rows.where(~usable(F.col("_vec"))).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return found.union(alone).select(
        F.col("_id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _node() -> F.Column:
    """The first 60 bits of a class' digest: its number as a node."""
    return F.conv(F.substring("_digest", 1, 15), 16, 10).cast("long")


def _bytes(vec: str):
    # zero has two signs
    return F.array_join(F.transform(vec, lambda x: (x + F.lit(0.0)).cast("string")), ",")


def _join(reps: DataFrame, basis: np.ndarray, cosine: float, eps: float, block: int, number_type: type) -> DataFrame:
    """Rows of link counts (``_digest, n``) and of spanning links (``u, v``) between classes' numbers."""
    lead, dim = basis.shape

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = np.zeros((len(df), lead))
            fits = df["_vec"].map(len).to_numpy() == dim
            if fits.any():  # vectors of another length have no box of their own: all are at zero
                out[fits] = _unit(df["_vec"][fits]) @ basis.T
            yield df[["_digest", "_n"]].assign(_p=list(out), _vec=[np.asarray(v, number_type).tobytes() for v in df["_vec"]])

    kind = "_digest string, _n long, _p array<double>, _vec binary"
    placed = reps.select("_digest", "_n", "_vec").mapInPandas(project, kind)
    cells = [F.floor(F.get("_p", F.lit(k)) / eps) for k in range(lead)]
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, *cells, F.col("_digest")).sortWithinPartitions(*cells, "_digest")
    # the order is written down, since ranges may be cut otherwise when a lost part is computed again
    ordered = ordered.withColumn("_row", F.monotonically_increasing_id()).select(
        "*", F.shiftrightunsigned("_row", 33).alias("_part"), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")) \
        .drop("_row").checkpoint()
    # places in the whole order, by a running sum over the partitions' sizes; blocks and ranges of blocks
    sizes = ordered.groupBy("_part").agg((F.max("_place") + 1).alias("_rows"))
    before = sizes.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))
    ordered = ordered.join(before, "_part").withColumn("_block", F.floor((F.col("_before") + F.col("_place")) / block)) \
        .withColumn("_range", F.floor(F.col("_block") / RANGE)).drop("_part", "_place", "_before")
    ends = [f(F.get("_p", F.lit(k))).alias(f"{n}{k}") for k in range(lead) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    blocks = ordered.groupBy("_range", "_block").agg(*ends)
    ranges = blocks.groupBy("_range").agg(*[f(f"{n}{k}").alias(f"{n}{k}") for k in range(lead) for f, n in ((F.min, "lo"), (F.max, "hi"))])

    def apart() -> F.Column:
        """Square of the distance of the boxes ``a`` and ``b``."""
        total = F.lit(0.0)
        for k in range(lead):
            gap = F.greatest(F.lit(0.0), F.col(f"a.lo{k}") - F.col(f"b.hi{k}"), F.col(f"b.lo{k}") - F.col(f"a.hi{k}"))
            total = total + gap * gap
        return total

    # cells of the first dimension are compared as a band join: a range meets those of its cell and the next
    def cell(c: str) -> F.Column:
        return F.floor(F.col(c) / eps)

    spread = ranges.withColumn("_cell", F.explode(F.sequence(cell("lo0"), cell("hi0") + 1)))
    pairs = spread.alias("a").join(spread.alias("b"), F.col("a._cell") == F.col("b._cell")) \
        .where((F.col("a._range") <= F.col("b._range")) & (apart() <= eps * eps)) \
        .select(F.col("a._range").alias("_ra"), F.col("b._range").alias("_rb")).distinct()
    left = pairs.join(blocks.withColumnRenamed("_range", "_ra"), "_ra").alias("a")
    deeper = left.join(blocks.alias("b"), F.col("a._rb") == F.col("b._range")) \
        .where(((F.col("a._ra") < F.col("a._rb")) | (F.col("a._block") <= F.col("b._block"))) & (apart() <= eps * eps)) \
        .select("_ra", F.col("a._block").alias("_ba"), "_rb", F.col("b._block").alias("_bb"))
    both = deeper.select("*", F.lit(0).alias("_side"), F.col("_ra").alias("_range"), F.col("_ba").alias("_block")).union(
        deeper.where("_ra != _rb or _ba != _bb").select("*", F.lit(1), "_rb", "_bb"))
    met = ordered.drop("_p").join(both, ["_range", "_block"]).drop("_range", "_block")

    def compare(df: pd.DataFrame) -> pd.DataFrame:
        df = df.assign(_length=df["_vec"].map(len))
        out = []
        for _, own in df.groupby("_length"):  # vectors of different length do not meet
            own = own.sort_values(["_side", "_digest"], kind="stable")
            x = _unit(own["_vec"].map(lambda b: np.frombuffer(b, number_type)))
            p = x @ basis.T if x.shape[1] == dim else np.zeros((len(x), lead))
            cut = int((own["_side"] == 0).sum())
            if df["_side"].nunique() > 1:
                if cut in (0, len(own)):
                    continue
            else:
                cut = 0
            # grid order inside each side, so that halves are near each other
            order = np.lexsort([*np.floor(p / eps).T[::-1], own["_side"].to_numpy()])
            own, x, p = own.iloc[order], x[order], p[order]
            count, links = _links(x, p, cut, own["_n"].to_numpy(), cosine, eps)
            names = own["_digest"].to_numpy()
            ids = [int(d[:15], 16) for d in names]
            out += [(names[i], count[i], None, None) for i in np.flatnonzero(count)]
            out += [(None, 0, ids[i], ids[j]) for i, j in links]
        # as objects first: floats would not hold the numbers beside nulls
        return pd.DataFrame(out, columns=["_digest", "n", "u", "v"], dtype=object).astype({"n": "int64", "u": "Int64", "v": "Int64"})

    return met.groupBy("_ra", "_ba", "_rb", "_bb").applyInPandas(compare, "_digest string, n long, u long, v long").checkpoint()
