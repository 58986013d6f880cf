"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors are compared when their labels (and dimensions) are equal.  Equal
vectors are one class before any comparison, so thousands of copies cost one
row.  The classes of a label are dealt by hash into blocks of about ``block``
rows, and a tile is a pair of blocks: memory per task is bounded whatever the
label's share of all rows.  Inside a tile the unit vectors are quantised,
x = s q + e with int8 q; from Cauchy-Schwarz

    x.y <= s_x s_y (q_x.q_y) + |s_x q_x| |e_y| + |e_x| |y|   (|y| = 1)

so a pair whose bound is under the threshold is none, and only the others are
recomputed in double precision.  q_x.q_y is exact: it is a product of float32
matrices of integers whose sums stay under 2^24, or of float64 ones beyond 1040
dimensions.  A tile returns, per class, the number of vectors linked to it and
a spanning forest; never its pairs.

Every pair of a label is bounded once, so work is quadratic within a label (the
method's nature); it spreads over (rows / block)^2 / 2 even tiles.

Defined results: vectors that are null, empty, zero, or hold nulls, NaN or
infinities, and rows without a label, link with nothing (component: their own
id); repeated rows are vectors of their own; null ids never name a component;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import written
from loadcast.llm.components import Forest, connected_components

THRESHOLD = 0.98
BLOCK = 1024
_SLACK = 1e-9  # over the rounding of the bound itself


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``unit`` -> int8 codes, scales, norms of what is lost."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def tile_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Row pairs with cosine >= threshold, and how many were recomputed."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    ux, uy = x / nx[:, None], y / ny[:, None]
    (qx, sx, ex), (qy, sy, ey) = quantise(ux), quantise(uy)
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    products = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float64)
    hx = sx * np.linalg.norm(qx.astype(np.float64), axis=1)
    bound = products * sx[:, None] * sy[None, :] + hx[:, None] * ey[None, :] + ex[:, None]
    i, j = np.nonzero(bound + _SLACK >= threshold)
    exact = np.einsum("ij,ij->i", x[i], y[j]) / (nx[i] * ny[j])
    keep = exact >= threshold
    return i[keep], j[keep], len(i)


def _tile(key, table: pa.Table, threshold: float) -> pa.Table:
    lower, upper = key[2].as_py(), key[3].as_py()
    cid, own, n = (table.column(c).to_numpy() for c in ("cid", "own", "n"))
    values = table.column("embedding").combine_chunks()
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(cid), -1)
    first, second = np.flatnonzero(own == lower), np.flatnonzero(own == upper)
    links, forest = np.zeros(len(cid), np.int64), Forest(len(cid))
    step = max(1, (1 << 20) // max(1, len(second)))
    for s in range(0, len(first), step):
        part = first[s:s + step]
        i, j, _ = tile_pairs(x[part], x[second], threshold)
        i, j = part[i], second[j]
        if lower == upper:
            i, j = i[i < j], j[i < j]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        forest.add(i, j)
    hit = np.flatnonzero(links)
    return pa.table({"cid": cid[hit], "links": links[hit], "root": cid[forest.parent[hit]]})


def near_duplicates(emb: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector."""
    rows = emb.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label"))
    sound = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0)
                       & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
                       & F.exists("embedding", lambda v: v != 0), F.lit(False))
    sound_rows, other = rows.filter(sound), rows.filter(~sound)
    classes = written(sound_rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
                      .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    dim = F.size("embedding").alias("dim")
    blocks = (classes.groupBy("label", dim).count()
              .select("label", "dim", F.ceil(F.col("count") / block).cast("int").alias("nb")))
    own = F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int")
    tiles = (classes.withColumn("dim", dim).join(blocks, ["label", "dim"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("label", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "cid", "own", "n", "embedding"))
    found = written(tiles.groupBy("label", "dim", "i", "j").applyInArrow(
        lambda key, t: _tile(key, t, threshold), "cid long, links long, root long"), "tiles")
    comps = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("cid").alias("lid")).agg(F.sum("links").alias("links"))
    known = (classes.select("label", "embedding", "least", "n", "cid")
             .join(comps, F.col("cid") == F.col("node"), "left").join(links, F.col("cid") == F.col("lid"), "left")
             .select("label", "embedding", "least", F.coalesce("component", "cid").alias("root"),
                     (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(names, "root").select("label", "embedding", "n_links", "component_id")
    out = sound_rows.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id").union(
        other.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
