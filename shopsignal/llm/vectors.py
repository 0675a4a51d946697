"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Equal vectors under one label are one class. The classes of a label (and length) are cut into
tiles, and every pair of tiles is one unit of work: a label that holds a third of all vectors is
worked off by many tasks, each with two tiles in memory.

In a unit, vectors are scaled to length 1 in double precision and quantised to 8 bits:
x = s q + e, with the scale s of the vector and its exact error length |e|. For two vectors

    | x . y  -  s t (q . r) |  <=  |e| |t r| + |f| |s q| + |e| |f|

so a product of the int8 tiles, exact in integers, bounds each cosine from both sides. Only
pairs whose upper bound reaches the threshold are computed again in double precision from the
full vectors; all others are proven to be below it. A unit returns the number of links of each
class and a spanning forest of the links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import join_groups, whole_runs, written
from shopsignal.llm.components import components, local_forest

THRESHOLD = 0.93
TILE = 2048
_ROWS = 512  # rows of a tile that are multiplied at a time
_SLACK = 1e-9  # more than the rounding of the bound itself, in double precision


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of length 1 -> (int8 q, scale s, error length |x - s q|, length |s q|)."""
    s = np.abs(x).max(1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.linalg.norm(x - back, axis=1), np.linalg.norm(back, axis=1)


def _product(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact product of int8 matrices: float32 sums of at most 1,024 products stay below 2 ** 24."""
    out = np.zeros((len(q), len(r)), np.float64)
    for i in range(0, q.shape[1], 1024):
        out += q[:, i:i + 1024].astype(np.float32) @ r[:, i:i + 1024].astype(np.float32).T
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float):
    """Places (i, j) with cosine >= ``threshold`` between rows of ``x`` and ``y`` (finite, not zero)."""
    # powers of two change no digit of a cosine, and keep squares of very large or small numbers in range
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None]) for v in (x, y))
    unit_x, unit_y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    (q, s, e, m), (r, t, f, n) = quantise(unit_x), quantise(unit_y)
    found = []
    for lo in range(0, len(x), _ROWS):
        a = slice(lo, lo + _ROWS)
        upper = _product(q[a], r) * s[a, None] * t[None, :]
        upper += e[a, None] * n[None, :] + m[a, None] * f[None, :] + e[a, None] * f[None, :]
        i, j = np.nonzero(upper >= threshold - _SLACK)
        for k in range(0, len(i), 200_000):  # bounds the memory of the recomputation
            ii, jj = i[k:k + 200_000] + lo, j[k:k + 200_000]
            dot = np.einsum("ij,ij->i", x[ii], y[jj])
            cos = dot / (np.linalg.norm(x[ii], axis=1) * np.linalg.norm(y[jj], axis=1))
            real = cos >= threshold
            found.append((ii[real], jj[real]))
    return (np.concatenate([p[k] for p in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def _unit(t: pa.Table, threshold: float):
    """One pair of tiles: (node, links) counts and (u, v) forest edges."""
    node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
    size = t.column("size").to_numpy()
    flat = t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.astype(np.float64).reshape(len(node), -1)
    order = np.argsort(side, kind="stable")
    node, side, size, x = node[order], side[order], size[order], x[order]
    cut = int(np.searchsorted(side, 1))  # sides -1 (a tile against itself) and 0 come first
    if side[0] < 0:
        i, j = linked_pairs(x, x, threshold)
        links = np.bincount(i, weights=size[j], minlength=len(node)).astype(np.int64)
        own = i == j  # a class linked with itself: each of its vectors with all others of it
        links[i[own]] -= 1
        up = i < j
        i, j = i[up], j[up]
    else:
        i, j = linked_pairs(x[:cut], x[cut:], threshold)
        j = j + cut
        links = (np.bincount(i, weights=size[j], minlength=len(node))
                 + np.bincount(j, weights=size[i], minlength=len(node))).astype(np.int64)
    root = local_forest(i, j, len(node))
    return node, links, node[root]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two vectors link if their labels are equal and not null, their lengths are equal and their cosine in
    double precision is at least ``threshold``. Vectors that are null, empty, zero, or hold null
    or non-finite components link with nothing, and so do those without a label: 0 links, a
    component of their own, kept. ``n_links`` counts the other rows linked directly (copies
    count each). ``component_id`` is the smallest vec_id reachable, null ids being never the
    smallest; ``kept`` is vec_id = component_id, also true for a row with a null id alone.
    Repeated rows get a row each; an empty table gives none. Other columns are not read.
    """
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    real = F.expr("forall(vec, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) "
                  "and exists(vec, c -> c <> 0)")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          v.alias("vec"))
    rows = rows.withColumn("linkable", F.coalesce(F.col("label").isNotNull() & real, F.lit(False)))
    # equal vectors are one node; the node's number must be the same for all readers: written
    node = F.monotonically_increasing_id().alias("node")
    nodes = written(rows.where("linkable").groupBy("label", F.size("vec").alias("dim"), "vec").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("low")).select("*", node), "nodes")
    per = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    met = nodes.join(per, ["label", "dim"]).select("label", "dim", "node", "size", "vec", "tiles", own.alias("own"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "dim", F.least("own", "other").alias("t0"),
        F.greatest("own", "other").alias("t1"), "node", "size", "vec",
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    keys = ["label", "dim", "t0", "t1"]
    met = met.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_runs(batches, keys):
            for lo, hi in zip(starts, starts[1:]):
                node, links, root = _unit(t.slice(lo, hi - lo), threshold)
                yield pa.record_batch([pa.array(node), pa.array(links), pa.array(root)], ["node", "links", "root"])

    found = written(met.mapInArrow(run, "node long, links long, root long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    root = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = nodes.join(links, "node").join(root, "node", "left").select(
        "label", "vec", "size", "low", "n_links", F.coalesce("root", "node").alias("root"))
    named = written(named, "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = written(named.join(lowest, "root").select("label", "vec", "size", "n_links", "component_id"), "classes")
    done = join_groups(rows.where("linkable"), classes, ["label", "vec"], "size").select(
        "vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("linkable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                  F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
