"""Leaf-wise boosted trees on aggregated cells.

Features are binned, and rows of equal bins become one *cell* with a count and sums of the target. All that boosting needs of
rows, gradients, histograms and losses, follows from cells, so rows are read once, by one aggregation, however many models are
trained: a grid of settings on several folds trains from the same cells.

Trees grow best first: the leaf whose split gains most is split next, until the leaves are used up. A bounded table of cells
is one block, and a task trains whole models on it; models are spread over the tasks. A larger table stays spread over blocks:
each pass sums gradient histograms of a task's blocks by model and finds the best splits where they meet; only splits reach the
driver. As the gains of leaves do not depend on the order of splits, a pass looks into all leaves that the best-first order
may still reach, so a tree takes about as many passes as it has levels.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.operators.sampling import with_fold
from liftspark.session import checkpointed, scratch_path

#: Bins of a feature, the first for missing values; one byte holds a bin.
MAX_BINS = 255
#: Cells of a table that one model is trained on without passes, about 40 MB; cells of a block of larger tables.
BLOCK_CELLS, PART_CELLS = 1 << 20, 1 << 16
#: Models that a task trains or sums up at once; rounds after which scores of larger tables are stored anew.
MODELS_PER_TASK, REFRESH = 8, 10
#: The fold of rows without folds, and the fold held out where none is.
_NO_FOLD, _NONE_HELD = -1, -2


@dataclass(frozen=True)
class Settings:
    """How one model is trained; ``depth`` 0 means no limit."""

    rounds: int = 100
    leaves: int = 31
    depth: int = 0
    step: float = 0.1
    min_rows: int = 20
    l1: float = 0.0
    l2: float = 0.0
    min_hessian: float = 1e-3

    def value(self, g: float, h: float) -> float:
        return -math.copysign(max(abs(g) - self.l1, 0.0), g) / (h + self.l2 + 1e-300) * self.step


# Many small steps on trees of bounded leaves and depth.
EXPERT = Settings(rounds=650, leaves=31, depth=14, step=0.01)


@dataclass(frozen=True)
class Job:
    """One model to train: its settings, and the fold it does not see."""

    settings: Settings
    held: int = _NONE_HELD


@dataclass
class Cells:
    """Binned features, fold, count, target sums by output and the sum of squares, one entry a cell."""

    bins: np.ndarray
    fold: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    def packed(self) -> bytes:
        return pickle.dumps((self.bins, self.fold, self.n, self.sums, self.squares))

    @staticmethod
    def unpacked(data: bytes) -> "Cells":
        return Cells(*pickle.loads(data))

    def without(self, fold: int) -> "Cells":
        """Counts and sums of one fold set to nothing."""
        rest = (self.fold != fold).astype(float)
        return replace(self, n=self.n * rest, sums=self.sums * rest[:, None], squares=self.squares * rest)

    def only(self, fold: int) -> "Cells":
        at = self.fold == fold
        return Cells(self.bins[at], self.fold[at], self.n[at], self.sums[at], self.squares[at])


# objectives: the start and the gradients of scores, from counts and sums of a cell


def start(objective: str, n: float, sums: np.ndarray) -> np.ndarray:
    share = sums / max(n, 1.0)
    if objective == "squared":
        return share
    share = np.clip(share, 1e-12, 1 - 1e-12)
    return np.log(share) if objective == "softmax" else np.log(share / (1 - share))


def probabilities(objective: str, scores: np.ndarray) -> np.ndarray:
    if objective == "squared":
        return scores
    if objective == "logistic":
        return 1 / (1 + np.exp(-scores))
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def gradients(objective: str, scores: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    p = probabilities(objective, scores)
    n = cells.n[:, None]
    return n * p - cells.sums, n * (np.ones_like(p) if objective == "squared" else p * (1 - p))


def loss(objective: str, scores: np.ndarray, cells: Cells) -> float:
    """The mean squared error or log-loss of the cells' rows."""
    n = cells.n.sum()
    if not n:
        return math.nan
    p = probabilities(objective, scores)
    if objective == "squared":
        return float((cells.squares - 2 * p[:, 0] * cells.sums[:, 0] + cells.n * p[:, 0] ** 2).sum() / n)
    p = np.clip(p, 1e-15, 1 - 1e-15)
    if objective == "softmax":
        return float(-(cells.sums * np.log(p)).sum() / n)
    return float(-(cells.sums * np.log(p) + (cells.n[:, None] - cells.sums) * np.log1p(-p)).sum() / n)


# one tree


@dataclass
class Tree:
    """Nodes by number, the root first; a leaf has feature -1. Bins up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                column.append(empty)
        return self.left[node], self.right[node]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        inner = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(inner):
            at = node[inner]
            node[inner] = np.where(bins[inner, feature[at]] <= cut[at], left[at], right[at])
            inner = inner[feature[node[inner]] >= 0]
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]

    def cells_of(self, bins: np.ndarray) -> dict[int, np.ndarray]:
        """The cells of each leaf; ``bins`` has a row for each feature."""
        out = {0: np.arange(bins.shape[1])}
        queue = [0]
        while queue:
            node = queue.pop()
            if self.feature[node] < 0:
                continue
            at = out.pop(node)
            goes = bins[self.feature[node]][at] <= self.cut[node]
            out[self.left[node]], out[self.right[node]] = at[goes], at[~goes]
            queue += (self.left[node], self.right[node])
        return out


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    left: tuple[float, float, float]
    right: tuple[float, float, float]


def worth(g: np.ndarray, h: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """What leaves of these sums contribute to a gain."""
    return np.maximum(np.abs(g) - l1, 0) ** 2 / (h + (l2 + 1e-300))


def best_splits(histograms: np.ndarray, settings: Sequence[Settings]) -> list[Split | None]:
    """For each leaf, with its model's settings, the split of largest gain; of equals the first feature and cut.

    Histograms have gradients, hessians and rows by leaf, feature and bin.
    """
    rules = np.array([(s.l1, s.l2, max(s.min_rows, 1), s.min_hessian) for s in settings])[:, :, None, None]
    l1, l2 = rules[:, 0], rules[:, 1]
    left = histograms.cumsum(axis=2)
    total = left[:, :1, -1:]
    left = left[:, :, :-1]
    right = total - left
    least = np.minimum(left[..., 1:], right[..., 1:])
    fits = (least[..., 1] >= rules[:, 2]) & (least[..., 0] >= rules[:, 3])
    whole = worth(total[..., 0], total[..., 1], l1, l2)
    gain = worth(left[..., 0], left[..., 1], l1, l2) + worth(right[..., 0], right[..., 1], l1, l2) - whole
    gain[~fits] = -np.inf
    flat = gain.reshape(len(gain), -1)
    out: list[Split | None] = []
    for i, at in enumerate(flat.argmax(axis=1).tolist()):
        # what rounding leaves of no gain is none
        if flat[i, at] <= 1e-12 * (1 + float(whole[i, 0, 0])):
            out.append(None)
            continue
        feature, cut = divmod(at, gain.shape[2])
        out.append(Split(float(flat[i, at]), feature, cut, tuple(left[i, feature, cut].tolist()), tuple(right[i, feature, cut].tolist())))
    return out


class Growing:
    """A tree on its way: what is known of its leaves, and which to look into next.

    ``known`` holds the best split of each node that was looked into. With ``ahead`` all leaves are looked into that the
    best-first order may reach with the splits left, else only the next.
    """

    def __init__(self, settings: Settings, ahead: bool):
        self.settings, self.ahead, self.tree = settings, ahead, Tree()
        self.known: dict[int, Split | None] = {}
        self.depth = {0: 0}
        self.wanted = [0]
        self.chosen: list[int] = []
        self._queue: list[tuple[float, int]] = []
        self._open: list[int] = [0]  # nodes whose splits join the queue once they are known

    def learn(self, found: Mapping[int, Split | None]) -> list[int]:
        """Take the splits of the wanted nodes, and find out what is wanted next; returns the nodes that were split for that."""
        self.known.update(found)
        self.wanted, parents = [], self._next()
        for node in parents:
            split = self.known[node]
            for child in self.tree.split(node, split.feature, split.cut):
                self.depth[child] = self.depth[node] + 1
                if self.settings.depth and self.depth[child] >= self.settings.depth:
                    self.known[child] = None
                else:
                    self.wanted.append(child)
        return parents + self.learn({}) if parents and not self.wanted else parents

    def _next(self) -> list[int]:
        """The leaves to split and look behind; none once the order of splits is known to its end."""
        most = self.settings.leaves - 1
        while True:
            self._open, fresh = [], self._open
            for node in fresh:
                if self.known[node]:
                    heapq.heappush(self._queue, (-self.known[node].gain, node))
            if not self._queue or len(self.chosen) >= most:
                return []
            _, node = heapq.heappop(self._queue)
            self.chosen.append(node)
            if len(self.chosen) == most:
                return []
            if self.tree.feature[node] < 0:
                rest = [node, *(n for _, n in heapq.nsmallest(most - len(self.chosen), self._queue))] if self.ahead else [node]
                self._open = [len(self.tree.feature), len(self.tree.feature) + 1]  # the numbers its children get, as it is split first
                return [n for n in rest if self.tree.feature[n] < 0]
            self._open = [self.tree.left[node], self.tree.right[node]]

    def finished(self, g: float, h: float) -> Tree:
        """The tree of the chosen splits; ``g`` and ``h`` are the root's sums."""
        out, at, sums = Tree(), {0: 0}, {0: (g, h)}
        for node in self.chosen:
            split = self.known[node]
            if self.tree.feature[node] < 0:
                self.tree.split(node, split.feature, split.cut)
            children = out.split(at[node], split.feature, split.cut)
            for old, new, stats in zip((self.tree.left[node], self.tree.right[node]), children, (split.left, split.right)):
                at[old], sums[new] = new, stats[:2]
        for node, (g, h) in sums.items():
            if out.feature[node] < 0:
                out.value[node] = self.settings.value(g, h)
        return out


def histograms(bins: Sequence[np.ndarray], weights: Sequence[np.ndarray], width: int, place: np.ndarray | int = 0, nodes: int = 1) -> np.ndarray:
    """Sums of the weights (gradient, hessian, rows) by node, feature and bin; ``bins`` are columns, ``place`` is the node of each cell."""
    out = np.empty((nodes, len(bins), width, len(weights)))
    base = place * width
    for f, column in enumerate(bins):
        at = base + column.astype(np.int64)
        for j, weight in enumerate(weights):
            out[:, f, :, j] = np.bincount(at, weight, nodes * width).reshape(nodes, width)
    return out


class _Here:
    """A tree that grows on cells at hand: its rows and histograms by leaf. ``bins`` has a row for each feature."""

    def __init__(self, cells: Cells, bins: np.ndarray, width: int, settings: Settings, g: np.ndarray, h: np.ndarray):
        self.bins, self.width, self.weights = bins, width, (np.ascontiguousarray(g), np.ascontiguousarray(h), cells.n)
        self.growing = Growing(settings, ahead=False)
        self.rows = {0: np.flatnonzero(cells.n > 0)}
        self.known = {0: self.sums(self.rows[0])}

    def sums(self, at: np.ndarray) -> np.ndarray:
        return histograms([column[at] for column in self.bins], [weight[at] for weight in self.weights], self.width)[0]

    def learn(self, found: Mapping[int, Split | None]) -> None:
        tree = self.growing.tree
        for node in self.growing.learn(found):
            at, whole, low = self.rows.pop(node), self.known.pop(node), tree.left[node]
            goes = self.bins[tree.feature[node]][at] <= tree.cut[node]
            self.rows[low], self.rows[low + 1] = at[goes], at[~goes]
            # sums over the smaller side; the other side's are the rest
            small = low if len(self.rows[low]) <= len(self.rows[low + 1]) else low + 1
            self.known[small] = self.sums(self.rows[small])
            self.known[2 * low + 1 - small] = whole - self.known[small]


def train(cells: Cells, objective: str, jobs: Sequence[Job], width: int) -> list[tuple[np.ndarray, list[list[Tree]], np.ndarray]]:
    """For each job the start scores, the trees of each round by output, and the scores of the cells, from cells that are all at hand.

    Jobs go in step, so that the splits of all their leaves are searched together.
    """
    bins = np.ascontiguousarray(cells.bins.T)
    own = [cells.without(job.held) for job in jobs]
    bases = [start(objective, c.n.sum(), c.sums.sum(axis=0)) for c in own]
    scores = [np.tile(base, (len(cells.n), 1)) for base in bases]
    rounds: list[list[list[Tree]]] = [[] for _ in jobs]
    for turn in range(max(job.settings.rounds for job in jobs)):
        growing: list[list[_Here]] = [[] for _ in jobs]
        for i, job in enumerate(jobs):
            if turn < job.settings.rounds:
                g, h = gradients(objective, scores[i], own[i])
                growing[i] = [_Here(own[i], bins, width, job.settings, g[:, k], h[:, k]) for k in range(len(bases[i]))]
        every = [here for trees in growing for here in trees]
        while open_ := [here for here in every if here.growing.wanted]:
            wanted = [(here, node) for here in open_ for node in here.growing.wanted]
            found = best_splits(np.stack([here.known[node] for here, node in wanted]), [here.growing.settings for here, _ in wanted])
            by_tree: dict[int, dict[int, Split | None]] = {}
            for (here, node), split in zip(wanted, found):
                by_tree.setdefault(id(here), {})[node] = split
            for here in open_:
                here.learn(by_tree[id(here)])
        for i, trees in enumerate(growing):
            if trees:
                rounds[i].append([here.growing.finished(*(float(w.sum()) for w in here.weights[:2])) for here in trees])
                for k, tree in enumerate(rounds[i][-1]):
                    for leaf, at in tree.cells_of(bins).items():
                        scores[i][at, k] += tree.value[leaf]
    return list(zip(bases, rounds, scores))


# data


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of each feature's bins: between the values where these are few, else approximate quantiles."""
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    distinct = numbers.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in numbers.columns]).first()
    few = [c for c in numbers.columns if distinct[c] <= max_bins * 3 // 4]
    values: dict[str, list[float]] = {c: [] for c in few}
    if few:  # at most about ``max_bins`` values of each
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("v")) for c in few])).alias("p")
        for f, v in numbers.select(pairs).select("p.f", "p.v").filter("v is not null and not isnan(v)").distinct().collect():
            values[f].append(v)
    many = [c for c in numbers.columns if c not in values]
    found = numbers.approxQuantile(many, [i / (max_bins - 1) for i in range(1, max_bins - 1)], 1 / (4 * max_bins)) if many else []
    quantiles = {c: np.unique(q) for c, q in zip(many, found)}
    out = []
    for c in numbers.columns:
        known = np.unique(np.array(values.get(c, ()), float))
        out.append((known[1:] + known[:-1]) / 2 if c in values else quantiles[c])
    return out


def binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of rows: 0 for missing values, then the number of edges below the value, plus one."""
    out = np.empty((len(columns[0]) if columns else 0, len(edges)), np.uint8)
    for i, (values, cuts) in enumerate(zip(columns, edges)):
        out[:, i] = np.where(np.isnan(values), 0, np.searchsorted(cuts, values, "left") + 1)
    return out


def _floats(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for c in names]


def cell_table(df: DataFrame, features: Sequence[str], label: str, edges: Sequence[np.ndarray], classes: int = 0, fold: str | None = None) -> DataFrame:
    """One stored row per combination of bins and fold: ``bins, fold, n, sums, squares``. Rows without a label take no part.

    ``classes`` counts the rows of each class; without it sums are of the label itself.
    """
    names = [f"f{i}" for i in range(len(features))]
    rows = df.select(
        *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, names)],
        F.col(f"`{label}`").cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(_NO_FOLD)).cast("int").alias("fold"),
    ).filter("y is not null and not isnan(y)")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned(_floats(batch, names), edges)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), batch.column("fold"), batch.column("y")], names=["bins", "fold", "y"])

    sums = [F.count_if(F.col("y") == k).cast("double") for k in range(classes)] or [F.sum("y")]
    found = rows.mapInArrow(key, "bins binary, fold int, y double").groupBy("bins", "fold")
    return checkpointed(found.agg(F.count("*").cast("double").alias("n"), F.array(*sums).alias("sums"), F.sum(F.col("y") * F.col("y")).alias("squares")))


def blocks(table: DataFrame, size: int) -> DataFrame:
    """Cells packed into blocks of at most ``size``: ``block, data``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> pa.RecordBatch:
            bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
            sums = rows["sums"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            cells = Cells(bins, rows["fold"].to_numpy(), rows["n"].to_numpy(), sums, rows["squares"].to_numpy())
            return pa.RecordBatch.from_pydict({"data": pa.array([cells.packed()], pa.binary())})

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                rows = pa.Table.from_batches(held)
                yield out(rows.slice(0, size))
                held = rows.slice(size).to_batches()
        if sum(b.num_rows for b in held):
            yield out(pa.Table.from_batches(held))

    packed = table.mapInArrow(pack, "data binary").select(F.monotonically_increasing_id().alias("block"), "data")
    return checkpointed(packed)


# training


def _train_here(data: DataFrame, jobs: Sequence[Job], objective: str, width: int, keep: bool, together: int) -> list[tuple]:
    """Train on a single block: groups of jobs, ``together`` at most, are spread over tasks, each with the block."""
    groups = -(-len(jobs) // together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, packed in zip(batch.column("group").to_pylist(), batch.column("data").to_pylist()):
                cells, mine = Cells.unpacked(packed), range(group, len(jobs), groups)
                for i, (base, rounds, scores) in zip(mine, train(cells, objective, [jobs[i] for i in mine], width)):
                    at = cells.fold == jobs[i].held
                    value = loss(objective, scores[at], cells.only(jobs[i].held)) if at.any() else None
                    model = pickle.dumps((base, rounds)) if keep else None
                    yield pa.RecordBatch.from_pydict({"job": [i], "loss": pa.array([value], pa.float64()), "model": pa.array([model], pa.binary())})

    spread = data.select("data", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    return [tuple(r) for r in spread.repartition(groups).mapInArrow(run, "job long, loss double, model binary").collect()]


def _train_spread(data: DataFrame, jobs: Sequence[Job], objective: str, width: int, keep: bool) -> list[tuple]:
    """Train on many blocks, all jobs in step: a few passes per round.

    Blocks and their scores stay cached between passes; the scores of a round are brought up to date by the first pass of the next.
    """
    spark = data.sparkSession

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("data").to_pylist():
                cells = Cells.unpacked(packed)
                for i, job in enumerate(jobs):
                    own = cells.without(job.held)
                    yield pa.RecordBatch.from_pydict({"job": [i], "n": [float(own.n.sum())], "sums": pa.array([own.sums.sum(axis=0).tolist()], pa.list_(pa.float64())), "features": [own.bins.shape[1]]})

    seen: dict[int, tuple[float, np.ndarray]] = {}
    features = 0
    summed = data.mapInArrow(totals, "job long, n double, sums array<double>, features long").select("job", "n", "features", F.posexplode("sums").alias("k", "s"))
    for i, k, n, s, f in summed.groupBy("job", "k").agg(F.sum("n"), F.sum("s"), F.max("features")).collect():  # one row for each job and output
        features = f
        seen.setdefault(i, (n, {}))[1][k] = s
    bases = [start(objective, seen[i][0], np.array([seen[i][1][k] for k in sorted(seen[i][1])])) for i in range(len(jobs))]
    outputs, shape = len(bases[0]), (features, width)
    models: list[list[list[Tree]]] = [[] for _ in jobs]

    def first(row) -> tuple[bytes, np.ndarray]:
        n = len(Cells.unpacked(row["data"]).n)
        return row["data"], np.repeat(np.stack(bases)[:, None, :], n, axis=1)

    def grown(trees: Mapping[int, Sequence[Tree]]) -> Callable[[tuple[bytes, np.ndarray]], tuple[bytes, np.ndarray]]:
        """Adds a round of trees to the scores of a block, by job, cell and output."""

        def run(block: tuple[bytes, np.ndarray]) -> tuple[bytes, np.ndarray]:
            packed, scores = block
            bins, scores = np.ascontiguousarray(Cells.unpacked(packed).bins.T), scores.copy()
            for i, row in trees.items():
                for k, tree in enumerate(row):
                    for leaf, at in tree.cells_of(bins).items():
                        scores[i, at, k] += tree.value[leaf]
            return packed, scores

        return run

    def look(state: RDD, wanted: Mapping[tuple[int, int], tuple[Tree, list[int]]]) -> dict[tuple[int, int], dict[int, tuple[Split | None, np.ndarray]]]:
        """The best splits and the sums of the wanted nodes of each job and output."""

        def partial(part: int, held: Iterator[tuple[bytes, np.ndarray]]) -> Iterator[tuple]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for packed, scores in held:
                cells = Cells.unpacked(packed)
                bins = np.ascontiguousarray(cells.bins.T)
                for (i, k), (tree, nodes) in wanted.items():
                    own = cells.without(jobs[i].held)
                    g, h = gradients(objective, scores[i], own)
                    leaves = tree.cells_of(bins)
                    at = np.concatenate([leaves[node] for node in nodes])
                    place = np.repeat(np.arange(len(nodes)), [len(leaves[node]) for node in nodes])
                    kept = own.n[at] > 0
                    at, place = at[kept], place[kept]
                    found = histograms(bins[:, at], (g[at, k], h[at, k], own.n[at]), width, place, len(nodes))
                    sums[i, k] = sums[i, k] + found if (i, k) in sums else found
            for (i, k), (_, nodes) in wanted.items():
                if (i, k) in sums:
                    yield from (((i, k, node), (part, table)) for node, table in zip(nodes, sums[i, k]))

        def decide(met: tuple[tuple[int, int, int], Iterable]) -> tuple:
            (i, k, node), parts = met
            total = np.zeros((*shape, 3))
            for _, table in sorted(parts, key=lambda p: p[0]):  # in one order, so that reruns agree
                total = total + table
            (split,) = best_splits(total[None], [jobs[i].settings])
            return i, k, node, split, total[0].sum(axis=0)

        spread = min(sum(len(nodes) for _, nodes in wanted.values()), state.getNumPartitions())
        found: dict = {}
        for i, k, node, split, total in state.mapPartitionsWithIndex(partial).groupByKey(spread).map(decide).collect():  # one row a node
            found.setdefault((i, k), {})[node] = (split, total)
        return found

    state = data.select("data").rdd.map(first).persist(StorageLevel.MEMORY_AND_DISK)
    before: RDD | None = None
    for turn in range(max(j.settings.rounds for j in jobs)):
        active = [i for i, j in enumerate(jobs) if turn < j.settings.rounds]
        growing = {(i, k): Growing(jobs[i].settings, ahead=True) for i in active for k in range(outputs)}
        roots: dict[tuple[int, int], np.ndarray] = {}
        while wanted := {key: (g.tree, list(g.wanted)) for key, g in growing.items() if g.wanted}:
            found = look(state, wanted)
            if before is not None:
                before, _ = None, before.unpersist()
            for key in wanted:
                if 0 in wanted[key][1]:
                    roots[key] = found[key][0][1]
                growing[key].learn({node: found[key][node][0] if node in found[key] else None for node in wanted[key][1]})
        trees = {i: [growing[i, k].finished(*roots[i, k][:2].tolist()) for k in range(outputs)] for i in active}
        for i, row in trees.items():
            models[i].append(row)
        before, state = state, state.map(grown(trees)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % REFRESH == REFRESH - 1:  # stored, so that a lost block is not grown from the start
            path = scratch_path(spark, "scores")
            state.saveAsPickleFile(path)
            before.unpersist()
            before, state = state, spark.sparkContext.pickleFile(path).persist(StorageLevel.MEMORY_AND_DISK)

    def lost(block: tuple[bytes, np.ndarray]) -> Iterator[tuple[int, tuple[float, float]]]:
        cells, scores = Cells.unpacked(block[0]), block[1]
        for i, job in enumerate(jobs):
            own, at = cells.only(job.held), cells.fold == job.held
            n = float(own.n.sum())
            yield i, (loss(objective, scores[i][at], own) * n if n else 0.0, n)

    losses = state.flatMap(lost).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect() if any(j.held != _NONE_HELD for j in jobs) else []
    for held in (before, state):
        if held is not None:
            held.unpersist()
    by_job = {i: total / n if n else None for i, (total, n) in losses}
    return [(i, by_job.get(i), pickle.dumps((bases[i], models[i])) if keep else None) for i in range(len(jobs))]


def run_jobs(table: DataFrame, jobs: Sequence[Job], objective: str, width: int, keep: bool = False) -> list[tuple[float | None, bytes | None]]:
    """The loss on the fold each job did not see (null without one) and, with ``keep``, its model; in the order of ``jobs``."""
    n = table.count()
    if not n:
        raise ValueError("no row has a label")
    # a bounded table goes into one block, if its copies for all jobs are bounded too
    features, least = len(table.first()["bins"]), min(PART_CELLS, BLOCK_CELLS)
    if n <= max(least, BLOCK_CELLS // max(len(jobs), features // 32)):
        together = max(1, min(MODELS_PER_TASK, MODELS_PER_TASK * least // n))
        found = _train_here(blocks(table.coalesce(1), n), jobs, objective, width, keep, together)
    else:
        found = _train_spread(blocks(table, least), jobs, objective, width, keep)
    return [tuple(r[1:]) for r in sorted(found, key=lambda r: r[0])]


@dataclass(frozen=True)
class Boosted:
    """A trained model: edges of bins, start scores and trees."""

    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    objective: str
    base: np.ndarray
    rounds: list[list[Tree]]

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(bins), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += tree.scores(bins)
        return out

    def split_shares(self) -> np.ndarray:
        """For each feature the share of all splits that use it."""
        used = np.array([f for trees in self.rounds for tree in trees for f in tree.feature if f >= 0], np.int64)
        return np.bincount(used, minlength=len(self.features)) / max(1, len(used))

    def _added(self, df: DataFrame, of: Callable[[np.ndarray], list[pa.Array]], fields: Sequence[pa.Field], like: DataFrame) -> DataFrame:
        names = [f"_f{i}" for i in range(len(self.features))]
        rows = df.select("*", *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(self.features, names)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = of(self.scores(binned(_floats(batch, names), self.edges)))
                kept = batch.select([c for c in batch.schema.names if c not in names])
                yield pa.RecordBatch.from_arrays([*kept.columns, *new], schema=pa.schema([*kept.schema, *fields]))

        return rows.mapInArrow(run, like.schema)

    def with_scores(self, df: DataFrame, output: str = "scores") -> DataFrame:
        """Adds the raw scores, an array with one number for each output."""
        field = pa.field(output, pa.list_(pa.float64()))
        return self._added(df, lambda s: [pa.array(list(s), field.type)], [field], df.limit(0).withColumn(output, F.array(F.lit(0.0))))

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """Adds the prediction: the value, or the class and (as an array) the probability of each."""
        value, shares = pa.field(prediction, pa.float64()), pa.field(probability, pa.list_(pa.float64()))
        like = df.limit(0).withColumn(prediction, F.lit(0.0))
        if self.objective == "squared":
            return self._added(df, lambda s: [pa.array(s[:, 0])], [value], like)

        def classes(scores: np.ndarray) -> list[pa.Array]:
            p = probabilities(self.objective, scores)
            p = np.hstack([1 - p, p]) if self.objective == "logistic" else p
            return [pa.array(p.argmax(axis=1).astype(float)), pa.array(list(p), shares.type)]

        return self._added(df, classes, [value, shares], like.withColumn(probability, F.array(F.lit(0.0))))


def width_of(edges: Sequence[np.ndarray]) -> int:
    return max((len(e) for e in edges), default=0) + 2


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, objective: str = "logistic", settings: Settings = Settings(), classes: int = 0, max_bins: int = MAX_BINS
) -> Boosted:
    """Train one model: ``"squared"``, ``"logistic"`` (labels 0 and 1) or ``"softmax"`` (labels 0 to ``classes - 1``)."""
    if (objective == "softmax") != (classes > 1):
        raise ValueError("softmax, and only softmax, takes classes")
    edges = bin_edges(df, features, max_bins)
    table = cell_table(df, features, label, edges, classes)
    ((_, model),) = run_jobs(table, [Job(settings)], objective, width_of(edges), keep=True)
    return Boosted(tuple(features), tuple(edges), objective, *pickle.loads(model))


@dataclass(frozen=True)
class Halving:
    """Search in rungs: all points with ``first`` rounds, then the best ``1 / keep`` with ``keep`` times as many, up to all rounds.

    Points that learn slowly are judged early; a larger ``first`` gives them more time.
    """

    first: int = 4
    keep: int = 3

    def rungs(self, points: int, rounds: int) -> Iterator[tuple[int, int]]:
        """Points and rounds of each rung; the last has all rounds."""
        now = min(self.first, rounds)
        while now < rounds:
            yield points, now
            points, now = max(1, -(-points // self.keep)), min(rounds, now * self.keep)
        yield points, rounds


SCORES_SCHEMA = "trial int, fold int, rounds int, loss double"


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    id: str,
    points: Sequence[Settings],
    objective: str = "squared",
    folds: int = 5,
    classes: int = 0,
    halving: Halving | None = None,
    max_bins: int = MAX_BINS,
    hash_fn: str = "murmur3",
) -> DataFrame:
    """``trial, fold, rounds, loss``: each point on each fold by row id, from one table of cells.

    Exact: every point is trained in full. With ``halving`` points drop out early; their rows then have the rounds they reached,
    and a point's last rung counts. Edges of bins come from all rows.
    """
    edges = bin_edges(df, features, max_bins)
    table = cell_table(with_fold(df, id, folds, hash_fn), features, label, edges, classes, "fold")
    out: list[tuple[int, int, int, float]] = []
    alive = list(range(len(points)))
    most = max(p.rounds for p in points)
    for count, rounds in halving.rungs(len(points), most) if halving else [(len(points), most)]:
        if out:
            last = {t: np.mean([r[3] for r in out if r[0] == t and r[2] == max(x[2] for x in out if x[0] == t)]) for t in alive}
            alive = sorted(sorted(alive, key=lambda t: (last[t], t))[:count])
        pairs = [(t, fold) for t in alive for fold in range(folds)]
        jobs = [Job(replace(points[t], rounds=min(rounds, points[t].rounds)), fold) for t, fold in pairs]
        found = run_jobs(table, jobs, objective, width_of(edges))
        out += [(t, fold, job.settings.rounds, value) for (t, fold), job, (value, _) in zip(pairs, jobs, found)]
    return df.sparkSession.createDataFrame(out, SCORES_SCHEMA)
