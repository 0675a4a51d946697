"""Exact k nearest neighbours (M10) over tiles of rows.

Rows that are close to the same pivots are packed into tiles of at most ``TILE_ROWS`` rows with a
centre and a radius. Whatever lies in two tiles is at least as far apart as their centres less
both radii, and at most as far as their centres plus both radii. So from the tiles' centres alone

* the nearest tiles that hold k rows between them bound the k-th distance of all queries of a tile,
* a pair of tiles further apart than that bound is never formed.

The pairs left are read in order of their lower bound, by groups of at most ``GROUP`` query tiles: a
tile of rows is sent once a group, not once a query tile. A task holds one group with k places per
query and one tile of rows, and skips the rest once no query can gain. Equal vectors that follow each
other (at most ``COPIES``) are one vector of a tile with its ids, so they are sent and compared once.
Within a pair a matrix product finds the rows that may be among the k nearest; only these get their
exact distance. The output is k rows a query, or one with their number and the sum of what they carry
(``totals``); pairs of rows are never emitted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.session import ensure_checkpoint_dir, ship_sources

TILE_ROWS = 1024  # distinct vectors
#: Equal vectors that are held as one at most.
COPIES = 256
#: Query tiles that a task holds at a time.
GROUP = 16
#: Rows that are merged into the k places, and rows that are put out, at a time.
MERGED, EMITTED = 2048, 200_000
PIVOTS = 64
#: Tiles whose centres a task holds at a time; more are handled in blocks.
CENTRES = 50_000
#: Relative error allowed for the matrix product's distances before the exact ones are computed.
SLACK = 1e-9

_TILE = "tile long, n int, counts binary, ids binary, pay binary, x binary, centre array<double>, radius double"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _usable(df: DataFrame, id_col: str, vector: Column, pay: Column, d: int | None) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("x"), pay.cast("double").alias("pay"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & ~bad & (F.size("x") == d if d else F.lit(True)))


def _tiles(rows: DataFrame, pivots: np.ndarray, name: str) -> DataFrame:
    """Pack rows (id, x, pay) into tiles, near ones together; no tile grows with how many rows are alike."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                far = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T
                order = np.argsort(far, axis=1, kind="stable")[:, :2]
                yield pa.record_batch([*b.columns, pa.array(order[:, 0], pa.int32()), pa.array(order[:, -1], pa.int32())],
                                      ["id", "x", "pay", "first", "second"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tile, held, size, now = TaskContext.get().partitionId() << 32, [], 0, None

        def close():
            x, counts, ids, pay = (np.concatenate(v) for v in zip(*held))
            centre = x.mean(0)
            radius = float(np.sqrt(((x - centre) ** 2).sum(1).max()) * (1 + 1e-12))
            return pa.record_batch([
                pa.array([tile], pa.int64()), pa.array([len(ids)], pa.int32()),
                *(pa.array([v.tobytes()], pa.binary()) for v in (counts, ids, pay, x)),
                pa.array([centre], pa.list_(pa.float64())), pa.array([radius], pa.float64())],
                ["tile", "n", "counts", "ids", "pay", "x", "centre", "radius"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column("x").flatten().to_numpy().reshape(n, -1)
            ids, pay, key = (b.column(c).to_numpy() for c in ("id", "pay", "first"))
            new = np.append(True, (x[1:] != x[:-1]).any(1) | (key[1:] != key[:-1]))
            run = np.flatnonzero(new)
            new |= (np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))) % COPIES == 0
            at = np.flatnonzero(new)
            end, i = np.append(at[1:], n), 0
            while i < len(at):
                if held and (key[at[i]] != now or size >= TILE_ROWS):
                    yield close()
                    tile, held[:], size = tile + 1, [], 0
                now = key[at[i]]
                j = i + int(np.argmin(np.append(key[at[i:i + TILE_ROWS - size]] == now, False)))
                part = slice(at[i], end[j - 1])
                held.append((x[at[i:j]], end[i:j] - at[i:j], ids[part], pay[part]))
                size, i = size + j - i, j
        if held:
            yield close()

    keyed = rows.mapInArrow(near, "id long, x array<double>, pay double, first int, second int")
    keyed = keyed.withColumn("h", F.xxhash64("x"))
    order = ["first", "second", "h", "id"]
    return _written(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, _TILE), name)


def _pairs(queries: DataFrame, tiles: DataFrame, k: int) -> DataFrame:
    """(query tile, tile, lower bound) of the pairs that may hold one of the k nearest rows."""
    meta = tiles.select("tile", "n", "centre", "radius")
    blocks = max(1, -(-meta.count() // CENTRES))
    centres = queries.select(F.col("tile").alias("q"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    part = lambda i: meta if blocks == 1 else meta.where(F.pmod(F.xxhash64("tile"), F.lit(blocks)) == i)

    def against(i: int, bound_col: bool):
        got = part(i).toArrow()
        ids, n = got.column("tile").to_numpy(), got.column("n").to_numpy().astype(np.int64)
        c = got.column("centre").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        r = got.column("radius").to_numpy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for j in range(b.num_rows):
                    q, qr = b.column("q")[j].as_py(), b.column("qr")[j].as_py()
                    apart = np.sqrt(((c - b.column("qc")[j].values.to_numpy()) ** 2).sum(1))
                    if bound_col:
                        top = apart + qr + r
                        order = np.argsort(top, kind="stable")
                        enough = int(np.searchsorted(np.cumsum(n[order]), k))
                        bound = float(top[order[enough]]) if enough < len(order) else float("inf")
                        yield pa.record_batch([pa.array([q], pa.int64()), pa.array([bound], pa.float64())], ["q", "bound"])
                    else:
                        low = np.maximum(0.0, apart - qr - r) * (1 - 1e-9)
                        keep = low <= b.column("bound")[j].as_py() * (1 + 1e-9)
                        yield pa.record_batch([pa.array(np.full(int(keep.sum()), q), pa.int64()), pa.array(ids[keep], pa.int64()),
                                               pa.array(low[keep], pa.float64())], ["q", "tile", "low"])
        return run

    bounds = [centres.mapInArrow(against(i, True), "q long, bound double") for i in range(blocks)]
    every = bounds[0]
    for b in bounds[1:]:
        every = every.unionByName(b)
    bounded = _written(centres.join(every.groupBy("q").agg(F.min("bound").alias("bound")), "q"), "knn-bounds")
    out = None
    for i in range(blocks):
        got = bounded.mapInArrow(against(i, False), "q long, tile long, low double")
        out = got if out is None else out.unionByName(got)
    return out


class _Nearest:
    """The k nearest so far of every query of a tile: distances squared, ids and payloads, unordered."""

    def __init__(self, x: np.ndarray, k: int):
        n = len(x)
        self.x, self.k, self.sq = x, k, (x * x).sum(1)
        self.far, self.ids, self.pay = np.full((n, k), np.inf), np.zeros((n, k), np.int64), np.zeros((n, k))
        self.kth = np.full(n, np.inf)

    def add(self, x: np.ndarray, counts: np.ndarray, ids: np.ndarray, pay: np.ndarray) -> None:
        """Vectors, how many rows each of them is, and the rows' ids and payloads."""
        end = np.cumsum(counts)
        cuts = np.unique(np.append(np.searchsorted(end, np.arange(MERGED, end[-1], MERGED)), len(x)))
        for a, b in zip(np.append(0, cuts), cuts):
            if a < b:
                rows = slice(end[a] - counts[a], end[b - 1])
                self._add(x[a:b], counts[a:b], ids[rows], pay[rows])

    def _add(self, x: np.ndarray, counts: np.ndarray, ids: np.ndarray, pay: np.ndarray) -> None:
        sq = (x * x).sum(1)
        rough = self.sq[:, None] + sq - 2 * self.x @ x.T
        slack = SLACK * (self.sq.max(initial=0) + sq.max(initial=0)) + 1e-300
        bar = self.kth
        if len(ids) > self.k:  # the nearest vectors that are k rows between them
            order = np.argsort(rough, axis=1)[:, :self.k]
            enough = (np.cumsum(counts[order], axis=1) < self.k).sum(1)
            last = np.take_along_axis(order, enough[:, None], 1)
            bar = np.minimum(bar, np.take_along_axis(rough, last, 1)[:, 0] + slack)
        q, t = np.nonzero(rough <= (bar + slack)[:, None])
        if not len(q):
            return
        exact = np.empty(len(q))
        for a in range(0, len(q), 100_000):
            part = slice(a, a + 100_000)
            exact[part] = ((self.x[q[part]] - x[t[part]]) ** 2).sum(1)
        many, first = counts[t], (np.cumsum(counts) - counts)[t]
        q, exact = np.repeat(q, many), np.repeat(exact, many)
        t = np.arange(len(q)) - np.repeat(np.cumsum(many) - many - first, many)  # rows of the vectors
        count = np.bincount(q, minlength=len(self.x))
        most = int(count.max())
        place = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        far, number, load = (np.full((len(self.x), most), v, kind) for v, kind in ((np.inf, float), (0, np.int64), (0, float)))
        far[q, place], number[q, place], load[q, place] = exact, ids[t], pay[t]
        far, number, load = (np.concatenate(v, axis=1) for v in ((self.far, far), (self.ids, number), (self.pay, load)))
        order = np.argpartition(far, self.k - 1, axis=1)[:, :self.k]
        kth = np.take_along_axis(far, order, 1).max(1)
        for i in np.flatnonzero(((far <= kth[:, None]).sum(1) > self.k) & np.isfinite(kth)):  # ties: lower ids first
            order[i] = np.lexsort((number[i], far[i]))[:self.k]
        self.far, self.ids, self.pay = (np.take_along_axis(v, order, 1) for v in (far, number, load))
        self.kth = kth

    def rows(self, counts: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The places of every query (``counts`` and ``own``: the ids of each vector), some at a time."""
        order = np.lexsort((self.ids, self.far), axis=1)
        far, ids, pay = (np.take_along_axis(v, order, 1) for v in (self.far, self.ids, self.pay))
        of, step = np.repeat(np.arange(len(counts)), counts), max(1, EMITTED // self.k)
        for a in range(0, len(own), step):
            i, real = of[a:a + step], np.isfinite(far[of[a:a + step]])
            rank = np.broadcast_to(np.arange(1, self.k + 1), real.shape)
            yield pa.record_batch([pa.array(np.repeat(own[a:a + step], real.sum(1)), pa.int64()), pa.array(rank[real], pa.int32()),
                                   pa.array(ids[i][real], pa.int64()), pa.array(np.sqrt(far[i][real]), pa.float64()),
                                   pa.array(pay[i][real], pa.float64())], ["query", "rank", "neighbour", "distance", "pay"])


    def totals(self, counts: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        """For every query how many places are taken, and the sum of their payloads; none for queries without any."""
        real = np.isfinite(self.far)
        n, total = (np.repeat(v, counts) for v in (real.sum(1), np.where(real, self.pay, 0.0).sum(1)))
        yield pa.record_batch([pa.array(own[n > 0], pa.int64()), pa.array(n[n > 0], pa.int64()), pa.array(total[n > 0], pa.float64())], ["query", "n", "total"])


def nearest(queries: DataFrame, rows: DataFrame, k: int, id_col: str = "id", vector: Column | None = None,
            pay: Column | None = None, totals: bool = False) -> DataFrame:
    """The k rows nearest to every query by Euclidean distance: query, rank, neighbour, distance, pay.

    ``totals``: one row a query instead, with the number of its nearest rows and the sum of their ``pay``.

    Equal distances are in ascending order of the neighbour's id. Fewer than k rows: all of them.
    Null ids and vectors that are null, hold null or non-finite components, or differ in length
    from the first usable row are left out on both sides; an empty side gives no rows. A query that is
    also a row finds itself. ``pay``: a number of the row that travels with it (its label).
    """
    spark = rows.sparkSession
    ship_sources(spark)
    vector = F.col("x") if vector is None else vector
    pay = F.lit(None) if pay is None else pay
    first = _usable(rows, id_col, vector, F.coalesce(pay, F.lit(0.0)), None).orderBy(F.xxhash64("id"), "id").limit(1).first()
    schema = "query long, n long, total double" if totals else "query long, rank int, neighbour long, distance double, pay double"
    if first is None:
        return spark.createDataFrame([], schema)
    own, given = (_usable(df, id_col, vector, value, len(first["x"])) for df, value in (
        (rows, F.coalesce(pay, F.lit(0.0))), (queries, F.lit(0.0))))
    pivots = np.array([r["x"] for r in own.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()])
    tiles, asked = _tiles(own, pivots, "knn-rows"), _tiles(given, pivots, "knn-queries")
    data, of = ["counts", "ids", "pay", "x"], (F.col("q") / GROUP).cast("long").alias("g")
    todo = (_pairs(asked, tiles, k).groupBy(of, "tile").agg(F.min("low").alias("low"), F.collect_list(F.struct("q", "low")).alias("for"))
            .join(tiles.select("tile", *data), "tile").select("g", "low", "tile", "for", *data))
    # a group's query tiles come before the tiles they are compared with, these by lower bound
    heads = asked.select(F.col("tile").alias("q"), *data).select(of, F.lit(-1.0).alias("low"), F.col("q").alias("tile"),
                                                                F.array(F.struct("q", F.lit(-1.0).alias("low"))).alias("for"), *data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def close():
            for best, counts, ids in held.values():
                yield from best.totals(counts, ids) if totals else best.rows(counts, ids)
            held.clear()

        for b in batches:
            for i in range(b.num_rows):
                g = b.column("g")[i].as_py()
                if g != now:
                    yield from close()
                    now = g
                pairs = [(p["q"], p["low"]) for p in b.column("for")[i].as_py()]
                pairs = [(q, low) for q, low in pairs if low < 0 or low * low <= held[q][0].kth.max() * (1 + 1e-9)]
                if not pairs:
                    continue
                counts, ids, pay, x = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in zip(data, (np.int64, np.int64, float, float)))
                x = x.reshape(len(counts), -1)
                for q, low in pairs:
                    if low < 0:
                        held[q] = _Nearest(x, k), counts, ids
                    else:
                        held[q][0].add(x, counts, ids, pay)
        yield from close()

    return heads.unionByName(todo).repartition("g").sortWithinPartitions("g", "low", "tile").mapInArrow(run, schema)


class KNeighbors:
    """Share of positives among the ``k`` nearest training rows."""

    def __init__(self, k: int = 200, features: str = "features", label: str = "label", keys=("user_id", "merchant_id")):
        self.k, self.features, self.label, self.keys = k, features, label, list(keys)

    def fit(self, df: DataFrame) -> KNeighborsModel:
        rows = df.select(F.xxhash64(*[F.col(c) for c in self.keys]).alias("id"), vector_to_array(F.col(self.features)).alias("x"),
                         F.col(self.label).cast("double").alias("y"))
        return KNeighborsModel(_written(rows, "knn-train"), self.k, self.features)


class KNeighborsModel:
    def __init__(self, rows: DataFrame, k: int, features: str):
        self.rows, self.k, self.features = rows, k, features
        self.columns = {"probability": "probability", "prediction": "prediction"}

    def setProbabilityCol(self, name: str):
        self.columns["probability"] = name
        return self

    def setPredictionCol(self, name: str):
        self.columns["prediction"] = name
        return self

    def setRawPredictionCol(self, name: str):
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probability (a vector) and prediction; 0.5 where a row has no neighbours."""
        given = _written(df.withColumn("_row", F.monotonically_increasing_id()), "knn-given")
        ask = given.select(F.col("_row").alias("id"), vector_to_array(F.col(self.features)).alias("x"), F.lit(0.0).alias("y"))
        got = nearest(ask, self.rows, self.k, pay=F.col("y"), totals=True).select(F.col("query").alias("_row"), (F.col("total") / F.col("n")).alias("_p"))
        p = F.coalesce("_p", F.lit(0.5))
        return (given.join(got, "_row", "left").withColumn(self.columns["probability"], array_to_vector(F.array(1 - p, p)))
                .withColumn(self.columns["prediction"], (p > 0.5).cast("double")).drop("_p", "_row"))
