"""Gradient boosting by histograms, several models in one run (M3–M6).

Feature values become bins once (split points from Spark's quantile
sketch).  Every level of a round is one small Spark job over arrays of binned
rows in a persisted RDD (several rounds are one where the counted rows are few
enough for a single task, or one task a model; the trees are the same): tasks
add the gradients of (model, node, feature, bin) of the lighter children, tasks add the
histograms of many tasks (``FAN_IN``), and the driver gets a few of a size that
does not depend on the rows.  The models of a
cross-validation share these passes: a row counts for every model but the
one that holds it out (``held``), so k folds cost k histograms in one scan
and not k trainings.

Rounds continue one another: the margin of every row is kept and gets the
new trees; rows and margins are written to the shared checkpoint folder every
``KEEP_EVERY`` rounds.  The loss of the held-out rows is summed in the first
pass of the next round, so a patience rule ends the training where it is,
without a second run of any length.

Gradients are added as integers (fixed point), so sums and with them the
trees do not depend on partitioning or on the order of arrival, nor on which
other models are trained along.  Row and column samples are hashes of the
row key and the round.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Versions, drop_checkpoint, ship_package

POINT = float(1 << 24)          # fixed point of gradients and losses
KEEP_EVERY = 10                 # rounds between two written versions of the margins
CELLS = 20_000_000              # rows x features x models up to which one task is quicker than an exchange per level
FAN_IN = 16                     # histograms that the driver, or one task, adds
CHUNK = 100_000                 # rows of one array at most


@dataclass(frozen=True)
class Boosting:
    """Parameters of a run (``patience``: rounds without a lower held-out loss)."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    row_share: float = 1.0
    column_share: float = 1.0
    l2: float = 1.0
    least_hessian: float = 1.0
    seed: int = 42
    patience: int | None = None


@dataclass
class Tree:
    """Binary tree in heap order: children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    cut: np.ndarray             # rows with a bin of at most ``cut`` go left
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node of every row after at most ``levels`` splits."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(levels):
            at = self.step(bins, at)
        return at

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Nodes one split below ``at``; leaves stay."""
        f = self.feature[at]
        down = 2 * at + 1 + (bins[np.arange(len(bins)), np.maximum(f, 0)] > self.cut[at])
        return np.where(f >= 0, down, at)

    def __eq__(self, other) -> bool:
        return all(np.array_equal(a, b) for a, b in zip(vars(self).values(), vars(other).values()))


@dataclass
class Ensemble:
    """Trees per model, and the held-out loss per round where a run watched it."""

    features: list
    edges: list                 # per feature: the sorted split points
    depth: int
    trees: list = field(default_factory=list)       # [round][model]
    losses: list = field(default_factory=list)      # of the held-out rows, by round
    kept: int = 0               # leading rounds that count


def split_points(df: DataFrame, features: Sequence[str], bins: int = 64) -> list:
    """Distinct approximate quantiles of every feature (``bins`` - 1 at most)."""
    probs = [i / bins for i in range(1, bins)]
    got = df.approxQuantile(list(features), probs, 1.0 / (4 * bins))
    return [np.unique(np.array(x, dtype=float)) for x in got]


def binned(df: DataFrame, features: Sequence[str], edges: list, label: str, key: Sequence[str], held=None,
           models: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., y, held, row, bins, margin): rows ready for training.  ``held`` is a
    column with the number of the model that does not train on the row (-1: none).
    Nulls and NaN lie above all split points."""
    held = F.lit(-1) if held is None else held
    # columns of their own name, whatever the kept ones are called
    src = df.select(*keep, F.col(label).cast("double").alias("__y"), held.cast("int").alias("__held"),
                    F.xxhash64(*[F.col(k).cast("string") for k in key]).alias("__row"), F.array(*[F.col(c).cast("double") for c in features]).alias("__x"))
    schema = T.StructType([*src.schema.fields[:len(keep)], T.StructField("y", T.DoubleType()), T.StructField("held", T.IntegerType()),
                           T.StructField("row", T.LongType()), T.StructField("bins", T.BinaryType()), T.StructField("margin", T.BinaryType())])
    names, k, missing = schema.fieldNames(), len(keep), _width(edges) - 1

    def run(batches):
        for b in batches:
            x = b.column(k + 3).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, len(edges))
            code = np.empty(x.shape, np.uint8)
            for j, e in enumerate(edges):
                code[:, j] = np.where(np.isnan(x[:, j]), missing, np.searchsorted(e, x[:, j], side="left"))
            zero = np.zeros(models).tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns[:k + 3], pa.array([r.tobytes() for r in code], pa.binary()),
                                              pa.array([zero] * b.num_rows, pa.binary())], names=names)

    ship_package(df.sparkSession)
    return src.mapInArrow(run, schema)


def _width(edges: list) -> int:
    """Bins of a feature: between split points, and one for nulls and NaN."""
    return max(map(len, edges)) + 2


def _matrices(b: pa.RecordBatch, n_features: int, models: int):
    bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(b.num_rows, n_features)
    margin = np.frombuffer(b"".join(b.column("margin").to_pylist()), float).reshape(b.num_rows, models).copy()
    return bins, margin


def _add(margin: np.ndarray, bins: np.ndarray, rounds: list, depth: int) -> None:
    for trees in rounds:
        for m, t in enumerate(trees):
            margin[:, m] += t.value[t.nodes(bins, depth)]


def _in_sample(row: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Row sample of one round: a hash of row key and seed."""
    with np.errstate(over="ignore"):
        x = row.view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


PACKED = T.StructType([T.StructField(c, T.BinaryType()) for c in ("columns", "y", "held", "row", "margin")])


def _round_columns(p: Boosting, n_features: int, round_no: int) -> np.ndarray:
    """Column sample of a round."""
    share = max(1, round(n_features * p.column_share))
    return np.sort(np.random.default_rng([p.seed, round_no]).permutation(n_features)[:share])


class _Rows:
    """Some binned rows with their margins, as arrays (``columns``: features x rows)."""

    def __init__(self, columns, y, held, row, margin):
        self.columns, self.y, self.held, self.row, self.margin, self.at = columns, y, held, row, margin, {}

    @classmethod
    def of(cls, b: pa.RecordBatch, n_features: int, models: int) -> "_Rows":
        bins, margin = _matrices(b, n_features, models)
        return cls(np.ascontiguousarray(bins.T), *(b.column(c).to_numpy() for c in ("y", "held", "row")), margin)

    def node(self, m: int, tree: Tree, level: int) -> np.ndarray:
        """Nodes of the rows in the growing tree of model ``m``, from those of the level before where they are known."""
        of, known, at = self.at.get(m, (None, 0, None))
        if of is not tree or known > level:
            known, at = 0, np.zeros(len(self.y), np.int64)
        each = np.arange(len(self.y))
        for _ in range(level - known):
            f = tree.feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (self.columns[np.maximum(f, 0), each] > tree.cut[at]), at)
        self.at[m] = tree, level, at
        return at

    def with_trees(self, growing: list, depth: int) -> "_Rows":
        """The same rows, their margins with one more tree a model."""
        margin = self.margin.copy()
        for m, t in enumerate(growing):
            margin[:, m] += t.value[self.node(m, t, depth)]
        return _Rows(self.columns, self.y, self.held, self.row, margin)

    def __getstate__(self):
        return {**vars(self), "at": {}}


def _histograms(parts, n_features: int, models: int, p: Boosting, growing: list, level: int, counted: np.ndarray, round_no: int, width: int) -> dict:
    """{(model, node): sums} of a level's ``counted`` nodes: gradients and hessians by
    feature and bin; at level 0 also node -1, the loss and number of the held-out rows."""
    columns = _round_columns(p, n_features, round_no)
    first, nodes = 2 ** level - 1, 2 ** level
    sums = np.zeros((models, 2, nodes, len(columns) * width))
    loss = np.zeros((models, 2))
    for rows in parts:
        sampled = _in_sample(rows.row, p.seed * 100_003 + round_no, p.row_share)
        for m in range(models):
            z = rows.margin[:, m]
            out = rows.held == m
            if level == 0 and out.any():
                each = np.logaddexp(0.0, np.where(rows.y[out] > 0.5, -z[out], z[out]))
                loss[m] += np.rint(each * POINT).sum(), out.sum()
            node = rows.node(m, growing[m], level)
            use = np.flatnonzero(sampled & ~out & (node >= first) & counted[m][node])
            start = (node[use] - first) * width
            prob = 1.0 / (1.0 + np.exp(-z[use]))
            each = [np.rint(v * POINT) for v in (prob - rows.y[use], prob * (1.0 - prob))]
            for j, c in enumerate(columns):
                at = start + rows.columns[c][use]
                for k in (0, 1):
                    sums[m, k, :, j * width:(j + 1) * width] += np.bincount(at, each[k], minlength=nodes * width).reshape(nodes, width)
    got = {(m, -1): loss[m].astype("<i8") for m in range(models) if loss[m, 1]}
    for m in range(models):
        for n in np.flatnonzero(sums[m, 1].any(axis=1)):
            got[m, first + int(n)] = sums[m, :, n].ravel().astype("<i8")
    return got


def _best_splits(sums: dict, columns: np.ndarray, p: Boosting) -> list:
    """(model, node, feature, cut, left_g, left_h, g, h) of every node: the split of
    the greatest gain in G^2 / (H + l2), feature -1 without one; losses as g, h."""
    out = []
    for (m, n), s in sums.items():
        if n < 0:
            out.append((m, n, -1, 0, 0.0, 0.0, float(s[0]), float(s[1])))
            continue
        g, h = s.reshape(2, len(columns), -1) / POINT
        left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
        all_g, all_h = left_g[0, -1], left_h[0, -1]
        right_g, right_h = all_g - left_g, all_h - left_h
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g ** 2 / (left_h + p.l2) + right_g ** 2 / (right_h + p.l2) - all_g ** 2 / (all_h + p.l2)
        gain = np.where((left_h >= p.least_hessian) & (right_h >= p.least_hessian) & np.isfinite(gain), gain, -np.inf)
        f, c = np.unravel_index(int(gain.argmax()), gain.shape)
        some = gain[f, c] > 1e-9
        out.append((m, n, int(columns[f]) if some else -1, int(c), float(left_g[f, c]), float(left_h[f, c]), float(all_g), float(all_h)))
    return out


def _grow(growing: list, splits: list, p: Boosting) -> bool:
    """Write the splits of a level into the growing trees; whether any node split."""
    split = False
    for m, n, feature, cut, left_g, left_h, g, h in splits:
        if n < 0:
            continue
        t = growing[m]
        if feature < 0:
            t.value[n] = -p.rate * g / (h + p.l2)
            continue
        split = True
        t.feature[n], t.cut[n] = feature, cut
        t.value[2 * n + 1] = -p.rate * left_g / (left_h + p.l2)
        t.value[2 * n + 2] = -p.rate * (g - left_g) / (h - left_h + p.l2)
    return split


def _mean_loss(splits: list) -> float | None:
    lost = [s for s in splits if s[1] < 0]
    return sum(s[6] for s in lost) / POINT / sum(s[7] for s in lost) if lost else None


def _packed(rows: DataFrame, n_features: int, models: int):
    """RDD of ``_Rows``: the binned rows as arrays, ``CHUNK`` rows at most each."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                r = _Rows.of(b.slice(at, CHUNK), n_features, models)
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (r.columns, r.y, r.held, r.row, r.margin)],
                                                 names=PACKED.fieldNames())

    def joined(parts):
        held, n = [], 0
        for p in parts:
            held.append((np.frombuffer(p["columns"], np.uint8).reshape(n_features, -1), np.frombuffer(p["y"], float), np.frombuffer(p["held"], np.int32),
                         np.frombuffer(p["row"], np.int64), np.frombuffer(p["margin"], float).reshape(-1, models)))
            n += len(held[-1][1])
            if n >= CHUNK:
                yield _Rows(*(np.concatenate(x, axis=k) for x, k in zip(zip(*held), (1, 0, 0, 0, 0))))
                held, n = [], 0
        if held:
            yield _Rows(*(np.concatenate(x, axis=k) for x, k in zip(zip(*held), (1, 0, 0, 0, 0))))

    return rows.mapInArrow(run, PACKED).rdd.mapPartitions(joined)


def _added(a: dict, b: dict) -> dict:
    """Sums of two histograms by (model, node)."""
    return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}


def _over_tasks(state, tasks: int, how):
    """``how(rows)`` of all rows, added."""
    each = state.coalesce(tasks).mapPartitions(lambda parts: [how(parts)])
    if tasks > FAN_IN:
        return each.treeReduce(_added, max(2, math.ceil(math.log(tasks, FAN_IN))))
    return functools.reduce(_added, each.collect(), {})                  # one histogram a task


def _one_round(count, models: int, p: Boosting, columns: np.ndarray, over=lambda loss: False):
    """(loss before the round, its trees, whether ``over(loss)``).  ``count(growing, level,
    counted)`` gives the histograms of one child of a split node: the other one is the rest of their parent."""
    growing, loss, above = [Tree.empty(p.depth) for _ in range(models)], None, {}
    counted = np.ones((models, 2 ** (p.depth + 1) - 1), bool)
    for level in range(p.depth):
        keys = _open_nodes(growing, level)
        sums = count(growing, level, counted)
        for m, n in keys if level else ():
            if not counted[m, n]:
                other, parent = n + 1 if n % 2 else n - 1, above[m, (n - 1) // 2]
                rest = parent - sums[m, other] if (m, other) in sums else parent
                if rest[len(rest) // 2:].any():
                    sums[m, n] = rest
        got, above = _best_splits(sums, columns, p), sums
        if level == 0:
            loss = _mean_loss(got)
            if over(loss):
                return loss, growing, True
        if not _grow(growing, got, p):
            break
        for m, n, feature, _, _, left_h, _, h in got:                    # the lighter child is counted
            if feature >= 0:
                counted[m, 2 * n + 1], counted[m, 2 * n + 2] = left_h <= h - left_h, left_h > h - left_h
    return loss, growing, False


TREES = T.StructType([T.StructField("round", T.IntegerType()), T.StructField("model", T.IntegerType()), T.StructField("loss", T.DoubleType()),
                      T.StructField("feature", T.BinaryType()), T.StructField("cut", T.BinaryType()), T.StructField("value", T.BinaryType())])


def _open_nodes(growing: list, level: int) -> list:
    """(model, node) of a level that a split leads to; at level 0 the loss as node -1 too."""
    if not level:
        return [(m, n) for m in range(len(growing)) for n in (-1, 0)]
    return [(m, n) for m, t in enumerate(growing) for n in range(2 ** level - 1, 2 ** (level + 1) - 1) if t.feature[(n - 1) // 2] >= 0]


def _some_rounds(rows: DataFrame, n_features: int, models: int, p: Boosting, rounds: range, width: int) -> list:
    """[(loss before the round, trees)] of a few rows: with nothing to exchange, one
    task runs the same steps for several rounds, or one a model where no loss over
    all models is watched."""
    apart = models > 1 and p.patience is None
    names = ["y", "held", "row", "bins", "margin"]

    def one_model(key, table):
        m = key[0].as_py()
        margin = np.frombuffer(b"".join(table.column("margin").to_pylist()), float).reshape(table.num_rows, models)[:, m]
        held = np.where(table.column("held").to_numpy() == m, 0, -1)
        own = [*(table.column(c) for c in names[:1]), pa.array(held, pa.int32()), *(table.column(c) for c in names[2:4]),
               pa.array([x.tobytes() for x in margin], pa.binary())]
        return pa.Table.from_batches(grown(pa.table(own, names=names).to_batches(10_000), 1, m), pa_trees)

    def run(batches):
        return grown(batches, models, 0)

    def grown(batches, models, number):
        parts = [_Rows.of(b, n_features, models) for b in batches if b.num_rows]
        for r in rounds:
            loss, growing, _ = _one_round(lambda growing, level, counted: _histograms(parts, n_features, models, p, growing, level, counted, r, width), models, p,
                                          _round_columns(p, n_features, r))
            parts = [x.with_trees(growing, p.depth) for x in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r] * models, pa.int32()), pa.array(range(number, number + models), pa.int32()), pa.array([loss] * models, pa.float64()),
                 *(pa.array([getattr(t, c).tobytes() for t in growing], pa.binary()) for c in ("feature", "cut", "value"))], schema=pa_trees)

    pa_trees = pa.schema([("round", pa.int32()), ("model", pa.int32()), ("loss", pa.float64()),
                          *((c, pa.binary()) for c in ("feature", "cut", "value"))])
    if apart:
        trained = rows.crossJoin(rows.sparkSession.range(models).withColumnRenamed("id", "number")).groupBy("number").applyInArrow(one_model, TREES)
    else:
        trained = rows.coalesce(1).mapInArrow(run, TREES)
    got: dict = {}
    for r in trained.collect():                                         # trees of a few rounds
        got.setdefault(r["round"], {})[r["model"]] = r
    return [(got[r][0]["loss"], [Tree(np.frombuffer(got[r][m]["feature"], np.int32), np.frombuffer(got[r][m]["cut"], np.int32),
                                      np.frombuffer(got[r][m]["value"], float)) for m in range(models)]) for r in rounds if r in got]


def train(rows: DataFrame, features: Sequence[str], edges: list, p: Boosting, models: int = 1) -> Ensemble:
    """Boost ``models`` models over ``binned`` rows."""
    spark = rows.sparkSession
    ship_package(spark)
    out = Ensemble(list(features), edges, p.depth)
    n_features, width, watched = len(features), _width(edges), p.patience is not None
    last = p.rounds + watched                                            # the last round's loss takes a pass of its own
    best = (float("inf"), 0)
    versions = Versions(spark, "boosting")

    def over(loss, r) -> bool:
        """Note the loss after ``r`` rounds; whether the training ends there."""
        nonlocal best
        if not watched or not r or loss is None:
            return r >= p.rounds
        out.losses.append(loss)
        best = min(best, (loss, r))
        return r - best[1] >= p.patience or r >= p.rounds

    state = before = kept = None
    try:
        current = versions.write(rows.select("y", "held", "row", "bins", "margin"))
        one_task = current.count() * n_features * models <= CELLS
        parts = 1 if one_task else current.rdd.getNumPartitions()
        done = False
        while not done and len(out.trees) < last and parts <= 1:
            start = len(out.trees)
            got = _some_rounds(current, n_features, models, p, range(start, min(start + KEEP_EVERY, last)), width)
            for loss, trees in got:
                done = over(loss, len(out.trees))
                if done:
                    break
                out.trees.append(trees)
            done = done or not got                                       # no rows
            if not done and len(out.trees) < last:
                current = versions.write(_with_margins(current, out.trees[start:], n_features, models, p.depth))
        if parts > 1:
            state = _packed(current, n_features, models).persist(StorageLevel.MEMORY_AND_DISK)
            tasks = min(parts, spark.sparkContext.defaultParallelism)
        while not done and len(out.trees) < last and parts > 1:
            r = len(out.trees)
            if r and r % KEEP_EVERY == 0:
                state.checkpoint()
            count = functools.partial(_count, state, tasks, n_features, models, p, r, width)
            _, growing, done = _one_round(count, models, p, _round_columns(p, n_features, r), lambda loss: over(loss, r))
            if before is not None:
                before.unpersist()
            kept = drop_checkpoint(spark, kept, state)
            if not done:
                out.trees.append(growing)
                before, state = state, _next(state, growing, p.depth).persist(StorageLevel.MEMORY_AND_DISK)
        out.kept = best[1] if watched and out.losses else len(out.trees)
        return out
    finally:
        for rdd in (state, before):
            if rdd is not None:
                rdd.unpersist()
        drop_checkpoint(spark, kept, None)
        versions.drop()


def _count(state, tasks: int, n_features: int, models: int, p: Boosting, round_no: int, width: int, growing: list, level: int, counted: np.ndarray) -> dict:
    return _over_tasks(state, tasks, lambda parts: _histograms(parts, n_features, models, p, growing, level, counted, round_no, width))


def _next(state, growing: list, depth: int):
    return state.map(lambda rows: rows.with_trees(growing, depth))


def _with_margins(rows: DataFrame, pending: list, n_features: int, models: int, depth: int) -> DataFrame:
    at = rows.columns.index("margin")

    def run(batches):
        for b in batches:
            bins, margin = _matrices(b, n_features, models)
            _add(margin, bins, pending, depth)
            cols = list(b.columns)
            cols[at] = pa.array([m.tobytes() for m in margin], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def score(rows: DataFrame, model: Ensemble, keep: Sequence[str], number=None, models: int = 1) -> DataFrame:
    """Columns ``keep`` of ``binned`` rows with ``probability_1`` and ``predicted``:
    of model ``number``, or (None) of the model that holds the row out."""
    kept, n_features, depth = model.trees[:model.kept], len(model.features), model.depth
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("probability_1", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for b in batches:
            bins, margin = _matrices(b, n_features, models)
            which = b.column("held").to_numpy() if number is None else np.full(b.num_rows, number)
            _add(margin, bins, kept, depth)
            p = 1.0 / (1.0 + np.exp(-margin[np.arange(b.num_rows), which])) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                                             names=schema.fieldNames())

    ship_package(rows.sparkSession)
    return rows.select(*dict.fromkeys([*keep, "held", "bins", "margin"])).mapInArrow(run, schema)
