"""Histogram trees: binned row blocks, split search over histograms, node tables and their scoring.

All rows are packed into blocks. A block holds its distinct binned rows (one byte a value) and, for
each model, how its rows spread over these: rows that are equal in bins, class and weight have the
same gradient, so they are one cell with a count, and only the hashes of their keys are kept apart
where a model samples rows. A pass returns one histogram per open node: sums of gradients, hessians
and rows by (feature, bin). Gradients are rounded to multiples of 2 ** -24, so these sums are exact
and do not depend on how rows are partitioned or combined.

Bin 0 of a feature with a missing marker holds just the missing rows; each split has a default
direction for them, the better one on the training rows. For other features the default direction
is left, which is where their lowest bin goes in any split.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.plans.ranking import with_prefix_sum

MAX_BINS = 64
#: Distinct values up to which a feature's quantiles are read from one map of counts; more are range-sorted.
MAP_VALUES = 200_000
#: Rows of a block at most.
BLOCK_ROWS = 1 << 18
GRADIENT_UNIT = 2.0 ** 24
#: Partitions up to which histograms are added on the driver; more are added in a tree of tasks.
FLAT_SUM = 32


@dataclass(frozen=True)
class Binning:
    """Bin b of a feature holds the values in (borders[b - 1], borders[b]]."""

    borders: tuple[np.ndarray, ...]
    marker: float | None = None
    marked: tuple[int, ...] = ()

    @classmethod
    def fit(cls, df: DataFrame, features: str = "features", max_bins: int = MAX_BINS, marker: float | None = None,
            marked: tuple[int, ...] = (), exact: bool = True) -> Binning:
        """Borders at quantiles of all rows; the marker has a bin of its own.

        ``exact`` quantiles lie between order statistics as ``percentile`` has them, others come from ``percentile_approx``.
        """
        x = vector_to_array(F.col(features))
        first = df.select(F.size(x).alias("d")).first()
        d = first["d"] if first else 0
        at = [i / max_bins for i in range(1, max_bins)]
        many = _many_values(df, x, d) if exact else []
        column = lambda i: (F.percentile(x[i], F.array(*map(F.lit, at))) if exact
                            else F.percentile_approx(x[i], at, 10_000))
        few = [i for i in range(d) if i not in many]
        row = dict(zip(few, df.agg(*[column(i).alias(f"q{i}") for i in few]).first())) if few else {}
        row |= _between_ranks(df, x, many, at) if many else {}
        borders = []
        for i in range(d):
            own = set(row[i] or [])
            if marker is not None and i in marked:
                own = {v for v in own if v > marker} | {marker}
            borders.append(np.array(sorted(own)[:max_bins - 1], np.float64))
        return cls(tuple(borders), marker, tuple(marked))

    @property
    def bins(self) -> int:
        return 1 + max((len(b) for b in self.borders), default=0)

    def apply(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for i, b in enumerate(self.borders):
            out[:, i] = np.searchsorted(b, x[:, i])
        return out

    def lowest(self) -> np.ndarray:
        """Per feature the value up to which a row counts as missing."""
        out = np.full(len(self.borders), -np.inf)
        if self.marker is not None:
            out[list(self.marked)] = self.marker
        return out


def _many_values(df: DataFrame, x: Column, d: int) -> list[int]:
    """The features with more than about ``MAP_VALUES`` distinct values."""
    row = df.agg(*[F.approx_count_distinct(x[i]) for i in range(d)]).first() if d else []
    return [i for i, n in enumerate(row) if n > MAP_VALUES]


def order_statistics(df: DataFrame, x: Column, columns: list[int], ranks) -> dict[int, list[float]]:
    """Per column the values at the 0-based ``ranks(rows)`` of its order; nulls are left out.

    Equal values are counted first and the counts range-sorted, so neither a task nor the driver holds a column.
    """
    cells = df.select(F.posexplode(F.array(*[x[i] for i in columns])).alias("i", "v")).where("v is not null")
    counts = with_prefix_sum(cells.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")), [F.col("i"), F.col("v")], "n", "upto")
    rows = {r["i"]: r["n"] for r in counts.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    wanted, before = {}, 0
    for i in sorted(rows):  # places in the order of all columns
        wanted[i] = [before + r for r in ranks(rows[i])]
        before += rows[i]
    places = np.array(sorted({r for v in wanted.values() for r in v}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            upto, n = (b.column(c).to_numpy() for c in ("upto", "n"))
            a, z = np.searchsorted(places, upto - n), np.searchsorted(places, upto)
            at = np.repeat(np.arange(len(a)), z - a)
            place = np.arange(len(at)) - np.repeat(np.cumsum(z - a) - z, z - a)
            yield pa.record_batch([pa.array(places[place], pa.int64()), b.column("v").take(pa.array(at))], ["place", "v"])

    got = dict(map(tuple, counts.select("v", "n", "upto").mapInArrow(run, "place long, v double").collect()))  # a row a rank
    return {c: [got[r] for r in wanted[j]] if j in wanted else [] for j, c in enumerate(columns)}


def _between_ranks(df: DataFrame, x: Column, columns: list[int], at: list[float]) -> dict[int, list[float]]:
    """Quantiles between order statistics, with the arithmetic of ``percentile``."""
    spots = lambda n: [(p * (n - 1), int(np.floor(p * (n - 1))), int(np.ceil(p * (n - 1)))) for p in at]
    held = {}

    def ranks(n: int) -> list[int]:
        held[n] = spots(n)
        return [r for _, low, high in held[n] for r in (low, high)]

    got, out = order_statistics(df, x, columns, ranks), {}
    sizes = {len(v) for v in got.values()}
    assert sizes <= {0, 2 * len(at)}
    numbers = df.agg(*[F.count(x[i]) for i in columns]).first()
    for c, n in zip(columns, numbers):
        v = got[c]
        pairs = zip(held.get(n, []), v[::2], v[1::2])
        out[c] = [a if a == b else (high - p) * a + (p - low) * b for (p, low, high), a, b in pairs]
    return out


@dataclass
class Cells:
    """The rows of one model: those it trains on by (distinct row, class, weight), held-out ones by (distinct row, class)."""

    at: np.ndarray  # the distinct row of the block
    y: np.ndarray
    weight: np.ndarray
    rows: np.ndarray
    key: np.ndarray  # 64-bit hashes of the rows' keys and the model, in order of the cells: what random choices depend on; may be left out
    held_at: np.ndarray
    held_y: np.ndarray
    held_rows: np.ndarray

    def drawn(self, share: float, salt: int) -> np.ndarray:
        """How many rows of each cell are among a random ``share`` of the rows (those whose ``uniform`` number is below it)."""
        if share >= 1 or not len(self.rows):
            return self.rows
        limit, on, step = np.uint64(math.ceil(share * (1 << 53)) << 11), np.empty(len(self.key), np.int64), 1 << 15
        for a in range(0, len(on), step):
            on[a:a + step] = mixed(mixed(self.key[a:a + step], salt), 0) < limit
        return np.add.reduceat(on, np.cumsum(self.rows) - self.rows)


@dataclass
class Block:
    bins: np.ndarray  # distinct rows x features
    cells: list[Cells]  # a model each
    margin: np.ndarray  # distinct rows x models
    rows: int
    drawn: dict = field(default_factory=dict)  # per model the rows of each cell that the round trains on

    def of_model(self, m: int) -> Block:
        """What model m trains on or is validated on."""
        c = self.cells[m]
        own = np.zeros(len(self.bins), bool)
        own[c.at] = own[c.held_at] = True
        place = np.cumsum(own) - 1
        return Block(self.bins[own], [replace(c, at=place[c.at], held_at=place[c.held_at])], self.margin[own, m:m + 1], self.rows)

    @classmethod
    def joined(cls, parts: list[Block]) -> Block:
        """Blocks of one model as one."""
        start = np.cumsum([len(p.bins) for p in parts]) - [len(p.bins) for p in parts]
        of = lambda name: [getattr(p.cells[0], name) + (s if name in ("at", "held_at") else 0) if name != "key" else p.cells[0].key
                           for p, s in zip(parts, start)]
        cells = Cells(*(np.concatenate(of(n)) for n in Cells.__dataclass_fields__))
        return cls(np.concatenate([p.bins for p in parts]), [cells], np.concatenate([p.margin for p in parts]), sum(p.rows for p in parts))


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of rows by the columns, the first place of each run of equal rows in it, and the runs' lengths."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(order)))


def block_of(bins: np.ndarray, y: np.ndarray, key: np.ndarray, weight: np.ndarray, held: np.ndarray,
             salts: list[tuple[int, ...] | None]) -> Block:
    """Rows (their weights and held-out flags by model) as a block; ``salts``: of the models that sample rows."""
    distinct, at = distinct_rows(bins)
    cells = []
    for m, salt in enumerate(salts):
        on, kept = np.flatnonzero(weight[:, m] > 0), np.flatnonzero(held[:, m])
        order, first, rows = _runs(at[on], y[on], weight[on, m])
        on = on[order]
        own, (order, start, counts) = on[first], _runs(at[kept], y[kept])
        kept, mine = kept[order][start], key[:0] if salt is None else key[on]
        for s in salt or ():
            mine = mixed(mine, s)
        cells.append(Cells(at[own], y[own], weight[own, m], rows, mine, at[kept], y[kept], counts))
    return Block(distinct, cells, np.zeros((len(distinct), len(salts))), len(y))


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and for each row which of them it is."""
    if not x.shape[1]:
        return x[:1], np.zeros(len(x), np.int64)
    x = np.ascontiguousarray(x)
    _, first, back = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return x[first], back


def pack(df: DataFrame, binning: Binning, weights: list[Column], held: list[Column], keys: list[str],
         salts: list[tuple[int, ...] | None], features: str = "features",
         label: str = "label") -> RDD:
    """Blocks of all rows, kept in memory (or on disk) by Spark; ``salts``: of the models that sample rows."""
    models, width = len(weights), len(binning.borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, rows = [], 0

        def block():
            made = block_of(*(np.concatenate(v) for v in zip(*got)), salts)
            return pa.record_batch([pa.array([pickle.dumps(made, 5)], pa.binary())], ["block"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = binning.apply(b.column(0).flatten().to_numpy().reshape(n, width))
            w, h = (b.column(i).flatten().to_numpy().reshape(n, models) for i in (3, 4))
            got.append((x, b.column(1).to_numpy(), b.column(2).to_numpy().view(np.uint64), w, h > 0))
            rows += n
            if rows >= BLOCK_ROWS:
                yield block()
                got, rows = [], 0
        if got:
            yield block()

    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"),
                     F.xxhash64(*[F.col(k) for k in keys]).alias("key"), F.array(*[w.cast("double") for w in weights]).alias("w"),
                     F.array(*[F.coalesce(h.cast("double"), F.lit(0.0)) for h in held]).alias("h"))
    packed = rows.mapInArrow(run, "block binary")
    return packed.rdd.map(lambda r: pickle.loads(r["block"])).persist(StorageLevel.MEMORY_AND_DISK)


def mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """splitmix64's finaliser of the keys and the salt."""
    with np.errstate(over="ignore"):
        x = key + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        part = x >> np.uint64(30)
        x ^= part
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(x, np.uint64(27), out=part)
        x ^= part
        x *= np.uint64(0x94D049BB133111EB)
        np.right_shift(x, np.uint64(31), out=part)
        x ^= part
    return x


def uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the rows' keys and the salt only."""
    x = key.astype(np.uint64)
    for s in (*salt, 0):
        x = mixed(x, s)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def total(rdd: RDD, partial) -> list:
    """The sum over partitions of ``partial(blocks)``, a list of arrays (entries of one place have one shape)."""
    def run(blocks):
        yield partial(blocks)

    def add(a, b):
        return b if a is None else a if b is None else [x + y for x, y in zip(a, b)]

    parts = rdd.mapPartitions(run)
    if parts.getNumPartitions() > FLAT_SUM:
        return parts.treeReduce(add)
    out = None
    for p in parts.collect():
        out = add(out, p)
    return out


def histogram(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, slots: int, n_bins: int,
              columns: np.ndarray) -> np.ndarray:
    """(slots, 3, features, bins): sums of g, h and n (rows). ``slot`` < 0: the row is not counted."""
    d = bins.shape[1]
    out = np.zeros((slots, 3, d, n_bins))
    rows = np.flatnonzero(slot >= 0)
    if len(rows) and len(columns):
        cell = bins[np.ix_(rows, columns)].astype(np.int64) + np.arange(len(columns)) * n_bins
        cell += slot[rows, None] * (len(columns) * n_bins)
        cell = cell.ravel()
        size = slots * len(columns) * n_bins
        for k, v in enumerate((g, h, n)):
            out[:, k, columns] = np.bincount(cell, np.repeat(v[rows], len(columns)), size).reshape(slots, len(columns), n_bins)
    return out


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int = -1
    bin: int = -1
    default_left: bool = True
    left: tuple[float, float, float] = (0.0, 0.0, 0.0)  # g, h, rows
    right: tuple[float, float, float] = (0.0, 0.0, 0.0)


def best_split(hist: np.ndarray, allowed: np.ndarray, marked: np.ndarray, l2: float = 0.0, min_hessian: float = 0.0,
               min_rows: float = 1, by_rows: bool = False) -> Split:
    """The split of largest gain G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2); gain 0: none.

    ``hist``: (3, features, bins) in gradient units. ``by_rows``: rows in place of H, so that the
    gain is the fall of the gradients' squared error. Ties go to the lower feature, then bin, then
    to the left as default direction.
    """
    left = np.cumsum(hist, axis=2)
    whole = left[:, :, -1:]
    best, top = Split(0.0), 0.0
    for direction in (True, False):
        part = left if direction else left - hist[:, :, :1]
        rest = whole - part
        (gl, hl, nl), (gr, hr, nr) = part / _UNITS, rest / _UNITS
        fine = (hl >= min_hessian) & (hr >= min_hessian) & (nl >= max(1, min_rows)) & (nr >= max(1, min_rows)) & allowed[:, None]
        if not direction:
            fine &= marked[:, None]
        if not fine.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            g, h = whole[0] / GRADIENT_UNIT, whole[2] if by_rows else whole[1] / GRADIENT_UNIT
            a, b = (nl, nr) if by_rows else (hl, hr)
            gain = np.where(fine, gl * gl / (a + l2) + gr * gr / (b + l2) - g * g / (h + l2), -np.inf)
        at = int(np.argmax(gain))
        if gain.flat[at] > top + 1e-12:
            top = float(gain.flat[at])
            f, b = divmod(at, hist.shape[2])
            best = Split(top, f, b, direction, tuple(float(v[f, b]) for v in (gl, hl, nl)), tuple(float(v[f, b]) for v in (gr, hr, nr)))
    return best


_UNITS = np.array([GRADIENT_UNIT, GRADIENT_UNIT, 1.0]).reshape(3, 1, 1)


@dataclass
class Tree:
    """One row per node; node 0 is the root. ``feature`` is -1 at leaves."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    default_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    NAMES = ("feature", "bin", "threshold", "default_left", "left", "right", "value", "gain", "cover")

    def leaf_of_bins(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            now = node[rows]
            f = self.feature[now]
            rows, now, f = rows[f >= 0], now[f >= 0], f[f >= 0]
            b = bins[rows, f]
            go = np.where(b == 0, self.default_left[now], b <= self.bin[now])
            node[rows] = np.where(go, self.left[now], self.right[now])
        return node

    def leaf_of_values(self, x: np.ndarray, lowest: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            now = node[rows]
            f = self.feature[now]
            rows, now, f = rows[f >= 0], now[f >= 0], f[f >= 0]
            v = x[rows, f]
            go = np.where(v <= lowest[f], self.default_left[now], v <= self.threshold[now])
            node[rows] = np.where(go, self.left[now], self.right[now])
        return node


def of_distinct(x: np.ndarray, score) -> np.ndarray:
    """``score(x)``, a number a row, computed once for equal rows: pairs of a user share their features."""
    if not len(x):
        return np.zeros(0)
    rows, back = distinct_rows(x)
    return score(rows)[back]


def node_table(spark: SparkSession, trees: list[Tree]) -> DataFrame:
    """tree, node and the node's columns: the form in which models are written, read and summed up."""
    rows = [(t, i, *(getattr(tree, c)[i].item() for c in Tree.NAMES)) for t, tree in enumerate(trees) for i in range(len(tree.feature))]
    return spark.createDataFrame(rows, "tree int, node int, feature int, bin int, threshold double, default_left boolean, "
                                       "left int, right int, value double, gain double, cover double")


def trees_of(table: DataFrame) -> list[Tree]:
    """The trees of a node table (a booster's trees have a bounded number of nodes)."""
    got = table.orderBy("tree", "node").toPandas()
    return [Tree(**{c: part[c].to_numpy() for c in Tree.NAMES}) for _, part in got.groupby("tree")]


def importance(table: DataFrame, by: str = "split") -> DataFrame:
    """(feature, importance): how often a feature is split on, or the gain of these splits."""
    value = F.count(F.lit(1)).cast("double") if by == "split" else F.sum("gain")
    return table.where("feature >= 0").groupBy("feature").agg(value.alias("importance"))
