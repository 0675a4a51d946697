"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint has a bit set where over half of its shingles' hashes have it set.
Equal fingerprints are one point. Points within ``max_bits`` = 3 bits of each other agree on at
least two of five bit fields, so every pair of such points meets in one of the ten blocks named
by two fields' values. Within a block, each point's Hamming distances to a table of pivot
fingerprints are known: by the triangle inequality, a pair whose distances to any pivot differ
by more than ``max_bits`` cannot link, and only pairs whose largest coordinate difference is
small enough are compared bit by bit. Blocks above ``tile`` points are split into tile pairs, so
any block is worked off by many tasks of bounded memory. A task returns a spanning forest of
the links it has found, never all pairs.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import join_checked, join_groups, lean, record, unpack, whole_runs, whole_text, written
from shopsignal.llm.components import components, local_forest

SHINGLE_WORDS = 3
MAX_BITS = 3
PIVOTS = 32
TILE = 4096
#: Bit fields of a fingerprint: 3 differing bits touch at most 3 of them, so 2 agree.
_FIELDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_PAIRS = tuple(combinations(range(len(_FIELDS)), 2))


def pivot_table(n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """``n`` reference fingerprints, drawn once from a seed."""
    draw = random.Random(seed)
    return np.array([draw.getrandbits(64) for _ in range(n)], np.uint64)


def fingerprint(text: str, k: int = SHINGLE_WORDS, block: int = 50_000) -> int:
    """Fingerprint of a whole text (lower-cased A-Z, words between ASCII spaces)."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only ASCII letters and ASCII spaces count
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, block):  # blocks bound the memory of very long texts
        part = words[lo:min(lo + block, n) + k - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
        hashes = np.fromiter((xxh64_intdigest(s, 42) for s in joined), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def with_fingerprint(docs: DataFrame, text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """``rec`` (all columns) and ``fp``, the fingerprint as a signed 64-bit number."""
    columns = docs.select(record(docs), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            fps = np.fromiter((fingerprint(t.as_py(), k) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["rec", "fp"])

    schema = columns.select("rec", F.lit(0).cast("long").alias("fp")).schema
    return columns.mapInArrow(run, schema)


def _links(fps: np.ndarray, starts: np.ndarray, sides: np.ndarray, pivots: np.ndarray, max_bits: int):
    """Linked pairs (places a, b) within each run of points; of two tiles, only across them."""
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # by distance to the first pivot within each run: partners lie in a narrow window
    order = np.lexsort((table[:, 0], group))
    fps, table, sides = fps[order], table[order], sides[order]
    rank = group[order] * 256 + table[:, 0]
    stop = np.searchsorted(rank, rank + max_bits, side="right")
    i, out = 0, []
    width = stop - np.arange(len(fps)) - 1
    total = np.cumsum(width)
    while i < len(fps):  # at most about a million pairs at a time
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 1_000_000, side="right")))
        a = np.repeat(np.arange(i, j), width[i:j])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(width[i:j]) - width[i:j], width[i:j])
        across = (sides[a] != sides[b]) | (sides[a] < 0)
        a, b = a[across], b[across]
        for p in range(1, table.shape[1]):  # largest coordinate difference, one pivot after the other
            if not len(a):
                break
            near = np.abs(table[a, p] - table[b, p]) <= max_bits
            a, b = a[near], b[near]
        real = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        out.append((a[real], b[real]))
        i = j
    a, b = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
    return order[a], order[b]


def link_points(points: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """``points`` (fp long, distinct) -> (u, v): a spanning forest of all links within ``max_bits`` <= 3."""
    if max_bits > 3:
        raise ValueError("five fields prove agreement on two of them for at most 3 bits")
    pivots = pivot_table(n_pivots)

    def field(i: int):
        at, bits = _FIELDS[i]
        return F.shiftrightunsigned("fp", at).bitwiseAND((1 << bits) - 1)

    keys = F.array(*[F.lit(n << 26) + F.shiftleft(field(i), 13) + field(j) for n, (i, j) in enumerate(_PAIRS)])
    met = points.select("fp", F.explode(keys).alias("block"))
    size = met.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    met = met.join(size, "block").select("fp", "block", tiles.alias("tiles")).withColumn("own", own)
    # a point goes to every pair of tiles with its own; side -1: the tile against itself
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "fp", "block", F.least("own", "other").alias("t0"), F.greatest("own", "other").alias("t1"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    met = met.repartition("block", "t0", "t1").sortWithinPartitions("block", "t0", "t1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_runs(batches, ["block", "t0", "t1"]):
            fps = t.column("fp").to_numpy().view(np.uint64)
            a, b = _links(fps, starts, t.column("side").to_numpy(), pivots, max_bits)
            if not len(a):
                continue
            nodes, place = np.unique(fps.view(np.int64), return_inverse=True)
            root = local_forest(place[a], place[b], len(nodes))
            child = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.record_batch([pa.array(nodes[child]), pa.array(nodes[root[child]])], ["u", "v"])

    return met.mapInArrow(run, "u long, v long").distinct()


def group_points(points: DataFrame, **settings: int) -> DataFrame:
    """``points`` (fp, size, low: smallest id of the fingerprint's rows) -> fp, size, component_id."""
    root = components(link_points(points.select("fp"), **settings))
    named = points.join(root.withColumnRenamed("node", "fp"), "fp", "left")
    named = written(named.select("fp", "size", "low", F.coalesce("root", "fp").alias("root")), "roots")
    smallest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return written(named.join(smallest, "root").select("fp", "size", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    **settings: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links of at most 3 differing bits, the
    row's own included. Texts without words have fingerprint 0 and link like others, so null
    and empty texts are one group. Null ids are never the smallest (a group of null ids alone
    has a null one). Repeated rows get a row each; an empty table gives none.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fps = with_fingerprint(slim, "text", k).select(F.col("rec.doc_id").alias("doc_id"), "fp")
    fps = written(fps, "fingerprints")
    points = written(fps.groupBy("fp").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("low")), "points")
    joined = join_groups(fps, group_points(points, **settings), ["fp"], "size")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                         **settings: int) -> DataFrame:
    """One row of each group of ``near_duplicates`` stays, that with the smallest id, with all columns.

    Of several rows with that id the first stays; of a group without ids, one row.
    """
    rows = with_fingerprint(docs, text_col, k).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "fingerprints")
    slim = rows.select("row", "fp", F.col(f"rec.`{id_col}`").cast("long").alias("doc_id"))
    points = written(slim.groupBy("fp").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("low"),
                                            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")),
                     "points")
    root = components(link_points(points.select("fp"), **settings)).withColumnRenamed("node", "fp")
    best = (points.join(root, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("best").alias("best")).select(F.col("best.row").alias("row")))
    # the rows that go are few or many: their numbers are broadcast if few, and texts are shuffled only if many
    goes = written(slim.select("row").join(best, "row", "left_anti"), "goes")
    return unpack(join_checked(rows, goes, ["row"], "left_anti"), docs.columns)
