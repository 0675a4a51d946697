"""Second-order gradient boosting on Spark (M4, M6, M7, M20): many boosters grown side by side.

A round needs a few passes over the same row blocks, each giving the histograms of all open nodes;
the split search over these is bounded by nodes x features x bins. Margins are a running column of
the blocks: a finished tree is added to it before the next round's first pass, which also gives
the held-out metric, so early stopping costs no refit and no extra pass.

Passes are Spark jobs over all partitions for all boosters (folds, bags, settings) at once. Blocks
are checkpointed every ``CUT_ROUNDS`` rounds; a lost executor recomputes from there. A job takes a
tenth of a second however little it counts, so up to ``LOCAL_ROWS`` rows (8 bytes each where rows are
sampled, besides the distinct ones) each booster's rows are dealt to a task of its own, which makes the
same passes over them in memory: boosters run side by side and a booster is one task. Both ways read
all rows and give the same trees bit by bit.

* Leaf-wise growth splits the open leaf of largest gain until there are ``leaves``. A pass expands
  all leaves that may still be split, so a tree takes about as many passes as it is deep; the
  best-first order is then replayed over the known gains, and the result is that of one split at
  a time.
* Depth-wise growth splits all nodes up to ``depth``; splits whose gain is below ``gamma`` are
  then cut back from the leaves up.
* Of two children only the one with less weight is counted; the other is the difference.
"""

from __future__ import annotations

import copy
import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.operators.trees import (GRADIENT_UNIT, MAX_BINS, Binning, Block, Split, Tree, best_split, histogram, node_table, of_distinct,
                                        pack, total, trees_of)
from shopsignal.session import ensure_checkpoint_dir, ship_sources

CUT_ROUNDS = 25
#: Rows up to which a booster's passes run in one task.
LOCAL_ROWS = 20_000_000
#: Cells of the score histogram that the held-out AUC is read from.
AUC_CELLS = 16_384


@dataclass(frozen=True)
class Boosting:
    """Settings of one booster; the defaults are plain logistic boosting."""

    rounds: int = 100
    patience: int = 0  # 0: no early stopping
    rate: float = 0.1
    leaves: int = 0  # leaf-wise growth up to so many leaves; 0: depth-wise
    depth: int = 0  # 0: no limit
    l2: float = 0.0
    gamma: float = 0.0
    min_hessian: float = 1e-3
    min_rows: int = 1
    by_rows: bool = False  # split by squared error of the gradients; leaf values stay second-order
    row_share: float = 1.0
    bag_every: int = 1
    column_share: float = 1.0  # of the features, per tree
    level_share: float = 1.0  # of the tree's features, per level
    metric: str = "log_loss"  # or "auc"
    both_classes: bool = False  # a tree per class under softmax: for two classes mirror images
    from_prior: bool = True  # begin at the log odds of the training rows
    missing: bool = False  # read the marker as missing
    seed: int = 0

    @property
    def steepness(self) -> float:
        return 2.0 if self.both_classes else 1.0


class _Growing:
    """A tree while it grows: nodes as far as they have been expanded, and what the next pass must count."""

    def __init__(self, config: Boosting, d: int, marked: np.ndarray, model: int, round_: int):
        self.c, self.d, self.marked, self.salt = config, d, marked, (config.seed, model, round_)
        self.columns = self._some(np.arange(d), config.column_share, 0)
        self.split: list[Split | None] = [None]
        self.children: list[tuple[int, int] | None] = [None]
        self.depth, self.hist, self.sums = [0], {}, [(0.0, 0.0, 0.0)]
        self.wanted: list[int] = [0]

    def _some(self, columns: np.ndarray, share: float, level: int) -> np.ndarray:
        if share >= 1:
            return columns
        rng = np.random.default_rng([*self.salt, level])
        return np.sort(rng.permutation(columns)[:max(1, round(share * len(columns)))])

    def counted(self) -> list[int]:
        """The nodes to count: the root, or the lighter child of each expanded node."""
        if self.split[0] is None:
            return [0]
        return [min(self.children[i], key=lambda c: (self.sums[c][1], c)) for i in self.wanted]

    def feed(self, hists: np.ndarray) -> None:
        for node, hist in zip(self.counted(), hists):
            if node == 0:
                self.sums[0] = tuple(hist[:, self.columns[0]].sum(axis=1) / (GRADIENT_UNIT, GRADIENT_UNIT, 1.0))
                self._search(0, hist)
            else:
                parent = next(i for i in self.wanted if node in self.children[i])
                a, b = self.children[parent]
                self._search(node, hist)
                self._search(b if node == a else a, self.hist.pop(parent) - hist)
        while True:
            done, fresh = self._replay()
            for i in fresh:
                self._expand(i)
            # children that stay leaves need no count: their sums are known from the split
            last = self.c.leaves and len(done) + 2 == self.c.leaves
            self.wanted = [] if last else [i for i in fresh if self._may_split(self.children[i][0])]
            if self.wanted or last or not fresh:
                return

    def _search(self, node: int, hist: np.ndarray) -> None:
        allowed = np.zeros(self.d, bool)
        allowed[self._some(self.columns, self.c.level_share, 1 + self.depth[node])] = True
        s = best_split(hist, allowed, self.marked, self.c.l2, self.c.min_hessian, self.c.min_rows, self.c.by_rows)
        self.split[node] = s
        if s.gain > 0:
            self.hist[node] = hist

    def _may_split(self, node: int) -> bool:
        return not self.c.depth or self.depth[node] < self.c.depth

    def _open(self, node: int) -> bool:
        s = self.split[node]
        return s is not None and s.gain > 0 and self._may_split(node)

    def _expand(self, node: int) -> None:
        k = len(self.split)
        self.children[node] = (k, k + 1)
        for side in (self.split[node].left, self.split[node].right):
            self.split.append(None)
            self.children.append(None)
            self.depth.append(self.depth[node] + 1)
            self.sums.append(side)

    def _replay(self) -> tuple[list[int], list[int]]:
        """(nodes split in best-first order, open leaves that come next but are not expanded)."""
        if not self.c.leaves:
            nodes = [i for i in range(len(self.split)) if self._open(i)]
            return [i for i in nodes if self.children[i]], [i for i in nodes if not self.children[i]]
        heap = [(-self.split[0].gain, 0)] if self._open(0) else []
        done, count = [], 1
        while heap and count < self.c.leaves:
            node = heap[0][1]
            if self.children[node] is None:
                missing = [i for _, i in heapq.nsmallest(self.c.leaves - count, heap) if self.children[i] is None]
                return done, missing
            heapq.heappop(heap)
            done.append(node)
            count += 1
            for c in self.children[node]:
                if self._open(c):
                    heapq.heappush(heap, (-self.split[c].gain, c))
        return done, []

    def routing(self) -> Tree:
        """All nodes expanded so far, for finding the rows of those to count."""
        return self._tree(set(i for i, c in enumerate(self.children) if c), None)

    def finished(self, binning: Binning) -> Tree:
        keep = set(self._replay()[0])
        if self.c.gamma:
            for i in sorted(keep, reverse=True):  # children have higher numbers than their parent
                if self.split[i].gain < self.c.gamma and not any(c in keep for c in self.children[i]):
                    keep.discard(i)
        return self._tree(keep, binning)

    def _tree(self, inner: set[int], binning: Binning | None) -> Tree:
        order, at = [0], 0
        while at < len(order):
            if order[at] in inner:
                order += self.children[order[at]]
            at += 1
        place = {n: i for i, n in enumerate(order)}
        rows = []
        for n in order:
            s, (g, h, _) = self.split[n], self.sums[n]
            value = -g / (h + self.c.l2) * self.c.rate if h + self.c.l2 > 0 else 0.0
            if n in inner:
                a, b = self.children[n]
                threshold = float(binning.borders[s.feature][s.bin]) if binning else 0.0
                rows.append((s.feature, s.bin, threshold, s.default_left, place[a], place[b], 0.0, s.gain, h))
            else:
                rows.append((-1, -1, 0.0, True, -1, -1, value, 0.0, h))
        types = (np.int32, np.int32, np.float64, bool, np.int32, np.int32, np.float64, np.float64, np.float64)
        tree = Tree(*(np.array(v, t) for v, t in zip(zip(*rows), types)))
        tree.numbers = np.array(order)
        return tree


class BoostedModel:
    """Trees and what is needed to score raw features; written and read as tables."""

    def __init__(self, trees: list[Tree], start: float, steepness: float, lowest: np.ndarray, features: str = "features"):
        self.trees, self.start, self.steepness, self.lowest, self.features = trees, start, steepness, lowest, features
        self.columns = {"probability": "probability", "prediction": "prediction", "raw": "rawPrediction"}

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def setProbabilityCol(self, name: str):
        self.columns["probability"] = name
        return self

    def setPredictionCol(self, name: str):
        self.columns["prediction"] = name
        return self

    def setRawPredictionCol(self, name: str):
        self.columns["raw"] = name
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.value[t.leaf_of_values(x, self.lowest)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds raw prediction, probability (vectors) and prediction, as Spark's classifiers do."""
        ship_sources(df.sparkSession)
        margins = self.margins

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            n = len(x)
            return pa.array(of_distinct(x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1), margins) if n else [], pa.float64())

        m = score(vector_to_array(F.col(self.features))) * F.lit(self.steepness)
        p = 1 / (1 + F.exp(-F.col("_margin")))
        c = self.columns
        return (df.withColumn("_margin", m).withColumn(c["raw"], array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))))
                .withColumn(c["probability"], array_to_vector(F.array(1 - p, p)))
                .withColumn(c["prediction"], (p > 0.5).cast("double")).drop("_margin"))

    def nodes(self, spark: SparkSession) -> DataFrame:
        return node_table(spark, self.trees)

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).write.parquet(f"{path}/nodes")
        meta = [(self.start, self.steepness, self.features, [float(v) for v in self.lowest])]
        spark.createDataFrame(meta, "start double, steepness double, features string, lowest array<double>").write.parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        m = spark.read.parquet(f"{path}/model").first()
        return cls(trees_of(spark.read.parquet(f"{path}/nodes")), m["start"], m["steepness"], np.array(m["lowest"]), m["features"])


def _draw(block: Block, b: _Booster, round_: int) -> None:
    """Sets how many rows of each cell the round trains on; a bag of several rounds is drawn once."""
    bag = round_ // b.c.bag_every
    if b.column not in block.drawn or block.drawn[b.column][0] != bag:
        block.drawn[b.column] = bag, block.cells[b.column].drawn(b.c.row_share, bag)


def _gradients(block: Block, b: _Booster) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct row the sums of gradients, hessians and rows of the round."""
    c, (_, n), k, size = block.cells[b.column], block.drawn[b.column], b.c.steepness, len(block.bins)
    p = (1 / (1 + np.exp(-k * block.margin[:, b.column])))[c.at]
    w = c.weight * GRADIENT_UNIT
    g, h = n * np.rint(w * (p - c.y)), n * np.rint(w * np.maximum(k * p * (1 - p), 1e-16))
    return np.bincount(c.at, g, size), np.bincount(c.at, h, size), np.bincount(c.at, n, size)


def _metric(block: Block, b: _Booster) -> np.ndarray:
    """Log loss and rows of the held-out rows, or rows by class and score cell."""
    c = block.cells[b.column]
    m, y, n = (block.margin[:, b.column] * b.c.steepness)[c.held_at], c.held_y, c.held_rows
    if b.c.metric != "auc":
        return np.array([(n * np.rint((np.logaddexp(0, m) - y * m) * GRADIENT_UNIT)).sum(), n.sum()])
    cell = ((m - b.low) / max(b.high - b.low, 1e-300) * (AUC_CELLS - 1)).astype(np.int64).clip(0, AUC_CELLS - 1)
    return np.stack([np.bincount(cell, n * (1 - y), AUC_CELLS), np.bincount(cell, n * y, AUC_CELLS)])


def _count(blocks, n_bins: int, round_: int, jobs, watched=()) -> list[np.ndarray] | None:
    """Histograms per job, then the metric of each watched booster; None without blocks.

    A job is (booster, routing tree or None, slot of each of its nodes, slots, columns).
    """
    out = None
    for block in blocks:
        got = []
        for b, tree, slot_of, slots, columns in jobs:
            _draw(block, b, round_)
            g, h, n = _gradients(block, b)
            slot = np.where(n > 0, 0 if tree is None else slot_of[tree.leaf_of_bins(block.bins)], -1)
            got.append(histogram(block.bins, slot, g, h, n, slots, n_bins, columns))
        got += [_metric(block, b) for b in watched]
        out = got if out is None else [a + b for a, b in zip(out, got)]
    return out


class _SparkPasses:
    """Passes as jobs over all partitions."""

    def __init__(self, blocks: RDD, n_bins: int):
        self.n_bins, self.spent, self.state = n_bins, [], blocks

    def add(self, added: list[tuple[_Booster, Tree | float]], round_: int) -> None:
        def run(block: Block) -> Block:
            out = Block(block.bins, block.cells, block.margin.copy(), block.rows, dict(block.drawn))
            for b, tree in steps:
                out.margin[:, b.column] += tree.value[tree.leaf_of_bins(out.bins)] if isinstance(tree, Tree) else tree
                _draw(out, b, round_)  # once a round, not once a pass
            return out

        steps = [(b.bare(), tree) for b, tree in added]
        self.spent.append(self.state)
        self.state = self.state.map(run).persist()

    def first(self, live: list[_Booster], watched: list[_Booster], round_: int) -> list[np.ndarray]:
        if round_ and round_ % CUT_ROUNDS == 0:
            self.state.checkpoint()
        n_bins, jobs = self.n_bins, [(b.bare(), None, None, 1, b.growing.columns) for b in live]
        watched = [b.bare() for b in watched]
        got = total(self.state, lambda part: _count(part, n_bins, round_, jobs, watched))
        while self.spent:
            self.spent.pop().unpersist()
        return got

    def more(self, open_: list[_Booster], round_: int) -> list[np.ndarray]:
        n_bins, jobs = self.n_bins, []
        for b in open_:
            tree, nodes = b.growing.routing(), b.growing.counted()
            slot_of = np.full(len(tree.feature), -1)
            slot_of[[int(np.flatnonzero(tree.numbers == n)[0]) for n in nodes]] = range(len(nodes))
            jobs.append((b.bare(), tree, slot_of, len(nodes), b.growing.columns))
        return total(self.state, lambda part: _count(part, n_bins, round_, jobs))

    def end(self) -> None:
        for x in (*self.spent, self.state):
            x.unpersist()


class _LocalPasses:
    """The same passes over one booster's rows in memory, which keep the rows of every open node."""

    def __init__(self, block: Block, n_bins: int):
        self.block, self.n_bins = block, n_bins

    def add(self, added: list[tuple[_Booster, Tree | float]], round_: int) -> None:
        for b, tree in added:
            step = tree.value[tree.leaf_of_bins(self.block.bins)] if isinstance(tree, Tree) else tree
            self.block.margin[:, b.column] += step

    def _histogram(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return histogram(self.block.bins[rows], np.zeros(len(rows), np.int64), self.g[rows], self.h[rows], self.n[rows], 1, self.n_bins,
                         columns)[0]

    def first(self, live: list[_Booster], watched: list[_Booster], round_: int) -> list[np.ndarray]:
        b, = live
        _draw(self.block, b, round_)
        self.g, self.h, self.n = _gradients(self.block, b)
        self.rows = {0: np.flatnonzero(self.n)}
        return [self._histogram(self.rows[0], b.growing.columns)[None], *(_metric(self.block, w) for w in watched)]

    def more(self, open_: list[_Booster], round_: int) -> list[np.ndarray]:
        b, = open_
        grown = b.growing
        for i in grown.wanted:
            s, rows = grown.split[i], self.rows.pop(i)
            bins = self.block.bins[rows, s.feature]
            left = np.where(bins == 0, s.default_left, bins <= s.bin)
            for child, own in zip(grown.children[i], (rows[left], rows[~left])):
                self.rows[child] = own
        return [np.stack([self._histogram(self.rows[n], grown.columns) for n in grown.counted()])]

    def end(self) -> None:
        pass


def auc_of(counts: np.ndarray) -> float:
    """AUC from rows by class and ascending score cell; ties count half."""
    neg, pos = counts
    if not neg.sum() or not pos.sum():
        return 0.5
    below = np.cumsum(neg) - neg
    return float((pos * (below + neg / 2)).sum() / (neg.sum() * pos.sum()))


class _Booster:
    """One booster between rounds. ``model`` names it in random choices, ``column`` its place in the blocks."""

    def __init__(self, model: int, column: int, config: Boosting, rows: np.ndarray):
        weight, positive, held = rows
        self.model, self.column, self.c = model, column, config
        share = min(max(positive / weight, 1e-12), 1 - 1e-12) if weight else 0.5
        self.start = math.log(share / (1 - share)) / config.steepness if config.from_prior else 0.0
        self.trees: list[Tree] = []
        self.best, self.best_score, self.history = 0, -math.inf, []
        self.low = self.high = self.start * config.steepness
        self.active, self.watched, self.growing = bool(weight) and config.rounds > 0, bool(config.patience and held), None

    def bare(self) -> _Booster:
        """What a task needs of it."""
        out = copy.copy(self)
        out.trees, out.growing, out.history = [], None, []
        return out

    def judge(self, counts: np.ndarray) -> None:
        """The held-out metric after the trees so far; stop if it has not improved for ``patience`` rounds."""
        score = auc_of(counts) if self.c.metric == "auc" else float(-counts[0] / max(1.0, counts[1]))
        self.history.append(score)
        if score > self.best_score:
            self.best, self.best_score = len(self.trees), score
        if len(self.trees) - self.best >= self.c.patience:
            self.active = False

    def add(self, tree: Tree) -> None:
        self.trees.append(tree)
        leaves = tree.value[tree.feature < 0] * self.c.steepness
        self.low, self.high = self.low + min(0, leaves.min()), self.high + max(0, leaves.max())

    def model_of(self, binning: Binning, features: str) -> BoostedModel:
        lowest = binning.lowest() if self.c.missing else np.full(len(binning.borders), -np.inf)
        model = BoostedModel(self.trees[:self.best] if self.watched else self.trees, self.start, self.c.steepness, lowest, features)
        model.history = self.history
        return model


class HistogramBooster:
    """One booster as a learner; ``valid``: a boolean column of held-out rows, ``weight``: of training weights."""

    def __init__(self, settings: Boosting, features: str = "features", label: str = "label", valid: str | None = None,
                 weight: str | None = None, missing: tuple[float, tuple[int, ...]] | None = None, keys=("user_id", "merchant_id")):
        self.settings, self.features, self.label, self.valid, self.weight = settings, features, label, valid, weight
        self.marker, self.marked = missing or (None, ())
        self.keys = list(keys)

    def fit(self, df: DataFrame) -> BoostedModel:
        held = F.col(self.valid) if self.valid else F.lit(False)
        weight = F.when(~held, F.col(self.weight) if self.weight else F.lit(1.0)).otherwise(0.0)
        return fit_boosters(df, [self.settings], [weight], [held], self.keys, self.features, self.label, self.marker, self.marked)[0]


def _train(boosters: list[_Booster], binning: Binning, passes) -> None:
    """All rounds of the boosters, side by side."""
    d = len(binning.borders)
    marks = np.zeros(d, bool)
    marks[list(binning.marked)] = True
    passes.add([(b, b.start) for b in boosters], 0)
    round_ = 0
    while live := [b for b in boosters if b.active]:
        for b in live:
            b.growing = _Growing(b.c, d, marks if b.c.missing else np.zeros(d, bool), b.model, round_)
        watched = [b for b in live if b.watched and b.trees]
        got = passes.first(live, watched, round_)
        for b, counts in zip(watched, got[len(live):]):
            b.judge(counts)
        for b, hist in zip(live, got):
            b.active = b.active and len(b.trees) < b.c.rounds
            if b.active:
                b.growing.feed(hist)
        live = [b for b in live if b.active]
        while open_ := [b for b in live if b.growing.wanted]:
            for b, hists in zip(open_, passes.more(open_, round_)):
                b.growing.feed(hists)
        added = [(b, b.growing.finished(binning)) for b in live]
        for b, tree in added:
            b.add(tree)
            b.growing = None
        if added:
            passes.add(added, round_ + 1)
        round_ += 1
    passes.end()


def fit_boosters(df: DataFrame, settings: list[Boosting], weights: list[Column], held: list[Column], keys: list[str],
                 features: str = "features", label: str = "label", marker: float | None = None, marked: tuple[int, ...] = (),
                 max_bins: int = MAX_BINS, exact_bins: bool = True, local_rows: int = LOCAL_ROWS) -> list[BoostedModel]:
    """Fit one booster per entry of ``settings`` over the rows of ``df``.

    ``weights[m]``: the training weight of a row for booster m (0 or null: not trained on),
    ``held[m]``: whether booster m is validated on it. Boosters with ``patience`` keep the rounds
    up to their best one; without held-out rows, or with no patience, all rounds. ``marked``
    features hold ``marker`` where they are missing, which boosters with ``missing`` send in a
    learned direction; others take it as a value. No rows: models without trees, at 0.5.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_sources(spark)
    binning = Binning.fit(df, features, max_bins, marker, marked, exact_bins)
    n_bins, models = binning.bins, range(len(settings))
    weights = [F.coalesce(w.cast("double"), F.lit(0.0)) for w in weights]
    blocks = pack(df, binning, weights, held, keys, [(c.seed, m) if c.row_share < 1 else None for m, c in enumerate(settings)], features, label)

    def sums(part):
        out = np.zeros((len(settings), 4))
        for b in part:
            out += [((c.weight * c.rows).sum(), (c.weight * c.rows * c.y).sum(), c.held_rows.sum(), b.rows) for c in b.cells]
        return [out]

    rows = (total(blocks, sums) or [np.zeros((len(settings), 4))])[0]
    count, rows = rows[:, 3].max(initial=0), rows[:, :3]
    if not binning.borders:
        rows[:] = 0
    if count > local_rows:
        boosters = [_Booster(m, m, settings[m], rows[m]) for m in models]
        _train(boosters, binning, _SparkPasses(blocks, n_bins))
        return [b.model_of(binning, features) for b in boosters]

    def run(part):
        own: dict[int, list[Block]] = {}
        for m, block in part:
            own.setdefault(m, []).append(block)
        for m, parts in own.items():
            booster = _Booster(m, 0, settings[m], rows[m])
            _train([booster], binning, _LocalPasses(Block.joined(parts), n_bins))
            yield booster

    dealt = blocks.flatMap(lambda b: [(m, b.of_model(m)) for m in models if rows[m, 0]])
    fitted = {b.model: b for b in dealt.partitionBy(max(1, len(settings)), int).mapPartitions(run).collect()}
    blocks.unpersist()
    return [(fitted.get(m) or _Booster(m, 0, settings[m], rows[m])).model_of(binning, features) for m in models]
