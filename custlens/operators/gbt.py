"""Training of Spark ML's ``GBTClassifier`` over many rows, without its cost per row.

The algorithm is Spark ML's: log loss, regression trees by variance, split points
of a row sample, rows sampled per tree and partition, features per node, and the
same random draws for the same seed and partitions.  So the trees are those that
``GBTClassifier.fit`` grows (tested), up to the order in which floats are added.
The result is a ``GBTClassificationModel``, built by way of its saved form.

Rows are binned once, one byte a feature, and stay as one array per partition in a
persisted RDD with their margins.  A level of a tree is one small Spark job: tasks
add (count, sum, sum of squares) by node, feature and bin with numpy; partial
sums of many tasks are added in tasks (``FAN_IN``), so the driver gets a few
histograms of a size that does not depend on the rows.  Of two siblings the one of
fewer rows is counted, the other one is the rest of their parent.  The margins take the new tree in the
first job of the next one; every ``KEEP_EVERY`` trees the state is checkpointed and
the checkpoint before it is deleted.
"""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, drop_checkpoint, ship_package

KEEP_EVERY = 10              # trees between two checkpoints
CHUNK = 500_000              # rows of one array at most
FAN_IN = 16                  # histograms that the driver, or one task, adds
GROUP_BYTES = 256 << 20      # Spark ML's maxMemoryInMB: up to it a level is one group of nodes
EPSILON = 2.0 ** -52
LANES = 1024

MASK = (1 << 64) - 1


# ------------------------------------------------------------ Spark's random numbers

def _murmur(data: bytes, seed: int) -> int:
    h, m = seed, 0xFFFFFFFF
    for i in range(0, 8, 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xcc9e2d51 & m
        k = ((k << 15 | k >> 17) & m) * 0x1b873593 & m
        h ^= k
        h = ((h << 13 | h >> 19) & m) * 5 + 0xe6546b64 & m
    h ^= 8
    h = (h ^ h >> 16) * 0x85ebca6b & m
    h = (h ^ h >> 13) * 0xc2b2ae35 & m
    return h ^ h >> 16


def xorshift_start(seed: int) -> int:
    """State of Spark's ``XORShiftRandom`` after ``setSeed``."""
    data = (seed & MASK).to_bytes(8, "big")
    low = _murmur(data, 0x3c074a61)
    return _murmur(data, low) << 32 | low


def _step(s: np.ndarray) -> np.ndarray:
    s = s ^ s << np.uint64(21)
    s = s ^ s >> np.uint64(35)
    return s ^ s << np.uint64(4)


def _apply(images: np.ndarray, s: np.ndarray) -> np.ndarray:
    """A linear map over bits, given by the images of the 64 single bits."""
    out = np.zeros_like(s)
    for i in range(64):
        out ^= np.where(s >> np.uint64(i) & np.uint64(1), images[i], np.uint64(0))
    return out


@functools.lru_cache(16)
def _lanes(steps: int) -> np.ndarray:
    """Starts of ``LANES`` lanes of so many steps, for each single bit of the first state."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    start, jump = bits[:, None], bits
    for _ in range(steps):
        jump = _step(jump)
    while start.shape[1] < LANES:
        start = np.concatenate([start, _apply(jump, start)], axis=1)
        jump = _apply(jump, jump)
    return start


def xorshift_doubles(seed: int, n: int) -> np.ndarray:
    """The first ``n`` results of ``XORShiftRandom(seed).nextDouble()``.  The generator
    is linear, so its stream is cut into lanes that advance together."""
    first, pairs, s = xorshift_start(seed), n, None
    if n > LANES:
        pairs = -(-n // LANES // 16) * 16 + 16                           # few lengths, so that their lanes are kept
        s = np.bitwise_xor.reduce(_lanes(2 * pairs)[[i for i in range(64) if first >> i & 1]], axis=0)
    else:
        s = np.array([first], np.uint64)
    out = np.empty((pairs, len(s)), np.uint64)
    low26, low27 = np.uint64((1 << 26) - 1), np.uint64((1 << 27) - 1)
    for i in range(pairs):
        a = _step(s)
        s = _step(a)
        np.add((a & low26) << np.uint64(27), s & low27, out=out[i])
    return out.T.ravel()[:n] * 2.0 ** -53


class JavaRandom:
    """``java.util.Random``: ``nextLong``."""

    def __init__(self, seed: int):
        self.s = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.s = self.s * 0x5DEECE66D + 0xB & (1 << 48) - 1
        v = self.s >> 16
        return v - (1 << 32) if v >> 31 else v

    def long(self) -> int:
        return (self._next() << 32) + self._next() & MASK


def feature_sample(n: int, k: int, seed: int) -> np.ndarray:
    """``SamplingUtils.reservoirSampleAndCount`` of 0 .. n - 1."""
    out = list(range(k))
    for i, u in enumerate(xorshift_doubles(seed, n - k) if n > k else ()):
        at = int(u * (k + i + 1))
        if at < k:
            out[at] = k + i
    return np.array(out)


def java_exp(x: np.ndarray) -> np.ndarray:
    """``StrictMath.exp`` (fdlibm) for |x| up to some hundreds: other libraries differ in the
    last bit, which decides between equal gains."""
    big, small = np.abs(x) > 0.5 * math.log(2), np.abs(x) < 2.0 ** -28
    k = np.where(big, np.where(np.abs(x) < 1.03972076416015625, np.sign(x), np.trunc(1.44269504088896338700 * x + np.where(x < 0, -0.5, 0.5))), 0.0)
    hi, lo = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
    r = hi - lo
    t = r * r
    c = r - t * (1.66666666666666019037e-01 + t * (-2.77777777770155933842e-03 + t * (6.61375632143793436117e-05 + t * (
        -1.65339022054652515390e-06 + t * 4.13813679705723846039e-08))))
    y = np.where(k == 0, 1.0 - ((r * c) / (c - 2.0) - r), 1.0 - ((lo - (r * c) / (2.0 - c)) - hi))
    return np.where(small, 1.0 + x, np.ldexp(y, k.astype(np.int32)))


# ------------------------------------------------------------ split points

def thresholds(values: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """Split points of one feature over sampled values, about ``expected`` of them
    (as ``RandomForest.findSplitsForContinuousFeature``)."""
    values, counts = np.unique(values[values != 0.0], return_counts=True)
    counts, found = counts.astype(float), counts.sum()
    if not len(values):
        return np.zeros(0)
    if expected - found > EPSILON * found * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, expected - found)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= splits:
        return middle
    stride, out, seen = expected / (splits + 1), [], counts[0]
    target = stride
    for i in range(1, len(values)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


# ------------------------------------------------------------ trees

class Node:
    """A node of a growing tree: ``stats`` are the sampled rows' count, sum and sum of squares."""

    __slots__ = ("id", "stats", "impurity", "gain", "feature", "cut", "left", "right")

    def __init__(self, id: int, stats: np.ndarray):
        self.id, self.stats, self.impurity = id, stats, float(variance(*stats))
        self.gain, self.feature, self.cut, self.left, self.right = -1.0, -1, 0, None, None

    @property
    def value(self) -> float:
        return float(self.stats[1] / self.stats[0]) if self.stats[0] else 0.0

    def pruned(self) -> "Node":
        """Leaves of one parent that predict the same are one."""
        if self.left is not None:
            self.left.pruned(), self.right.pruned()
            if self.left.left is None and self.right.left is None and self.left.value == self.right.value:
                self.gain, self.feature, self.left, self.right = -1.0, -1, None, None
        return self


def variance(count, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


def arrays(root: Node, depth: int) -> tuple:
    """(feature, cut, value) in heap order, from 1."""
    feature, cut, value = np.full(2 << depth, -1, np.int32), np.zeros(2 << depth, np.int32), np.zeros(2 << depth)
    todo = [root]
    while todo:
        n = todo.pop()
        feature[n.id], cut[n.id], value[n.id] = n.feature, n.cut, n.value
        todo += [n.left, n.right] if n.left is not None else []
    return feature, cut, value


def places(bins: np.ndarray, tree: tuple, levels: int) -> np.ndarray:
    """Node of every row of ``bins`` (features x rows) after at most ``levels`` splits."""
    feature, cut, _ = tree
    at, rows = np.ones(bins.shape[1], np.int64), np.arange(bins.shape[1])
    for _ in range(levels):
        f = feature[at]
        at = np.where(f >= 0, 2 * at + (bins[np.maximum(f, 0), rows] > cut[at]), at)
    return at


def histogram(bins: np.ndarray, labels: np.ndarray, slot: np.ndarray, slots: int, width: int) -> np.ndarray:
    """(slot, feature, bin, [count, sum, sum of squares]) of the rows."""
    out = np.empty((slots, len(bins), width, 3))
    base, squares = slot * width, labels * labels
    for f, b in enumerate(bins):
        at = base + b
        for k, w in enumerate((None, labels, squares)):
            out[:, f, :, k] = np.bincount(at, w, slots * width).reshape(slots, width)
    return out


def split(node: Node, h: np.ndarray, subset, n_splits: list) -> tuple | None:
    """The best (feature, bin, gain, left stats, right stats) of a node, or None."""
    best = None
    for f in subset:
        if not n_splits[f]:
            continue
        cum = np.cumsum(h[f, :n_splits[f] + 1], axis=0)
        left = cum[:-1]
        right = cum[-1] - left
        if node.stats is None:
            node.stats = left[0] + right[0]
            node.impurity = float(variance(*node.stats))
        total = left[:, 0] + right[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = node.impurity - left[:, 0] / total * variance(*left.T) - right[:, 0] / total * variance(*right.T)
        gain = np.where((left[:, 0] >= 1) & (right[:, 0] >= 1) & (gain >= 0), gain, -np.inf)
        i = int(gain.argmax())
        if best is None or gain[i] > best[2]:
            best = int(f), i, float(gain[i]), left[i], right[i]
    if best is None or best[2] == -np.inf:
        node.impurity = -1.0                                             # as Spark ML notes it
    return best if best and best[2] > 0 else None


# ------------------------------------------------------------ training

def trains(estimator: GBTClassifier, n_features: int) -> bool:
    """Whether ``fit`` takes this estimator's parameters; for others there is Spark ML."""
    share = estimator.getFeatureSubsetStrategy()
    usual = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "lossType": "logistic"}
    return (all(estimator.getOrDefault(k) == v for k, v in usual.items()) and (share in ("all", "auto") or _number(share))
            and not estimator.isDefined("weightCol") and not estimator.isDefined("validationIndicatorCol") and estimator.getMaxBins() <= 256
            and 2 ** estimator.getMaxDepth() * n_features * estimator.getMaxBins() * 32 <= GROUP_BYTES)


def _number(text: str) -> bool:
    try:
        return float(text) > 0
    except ValueError:
        return False


def _per_node(share: str, n_features: int) -> int:
    if share in ("all", "auto"):
        return n_features
    return min(int(share), n_features) if share.isdigit() else min(math.ceil(float(share) * n_features), n_features)


BINNED = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("bins", T.BinaryType()),
                       T.StructField("y", T.BinaryType())])


def _binned(df: DataFrame, edges: list) -> DataFrame:
    """Rows of a partition as arrays: (rows, first row, bins, labels of -1 and 1)."""
    def run(batches):
        start, held, n = 0, [], 0

        def out():
            bins, y = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([start], pa.int64()), pa.array([bins.tobytes()], pa.binary()),
                                               pa.array([y.tobytes()], pa.binary())], names=BINNED.fieldNames())

        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(0).to_numpy(zero_copy_only=False).astype(float)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, len(edges))
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            if not np.isfinite(x).all():
                raise ValueError("vector values must not be NaN or infinite")
            code = np.empty((len(edges), b.num_rows), np.uint8)
            for j, e in enumerate(edges):
                code[j] = np.searchsorted(e, x[:, j], side="left")
            held.append((code, (2 * y - 1).astype(np.int8)))
            n += b.num_rows
            if n >= CHUNK:
                yield out()
                start, held, n = start + n, [], 0
        if n:
            yield out()

    return df.mapInArrow(run, BINNED)


def fit(df: DataFrame, estimator: GBTClassifier) -> GBTClassificationModel:
    """``estimator.fit(df)`` by the passes of this module."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    depth, seed, share = estimator.getMaxDepth(), estimator.getSeed(), estimator.getSubsamplingRate()
    df = df.select(F.col(estimator.getLabelCol()).cast("double").alias("y"), F.col(estimator.getFeaturesCol()).alias("x"))
    n_rows = df.count()
    n_features = df.first()["x"].size
    per_node = _per_node(estimator.getFeatureSubsetStrategy(), n_features)
    most = min(estimator.getMaxBins(), n_rows)

    # split points, of a sample as Spark ML's
    wanted = max(estimator.getMaxBins() ** 2, 10_000)
    part = wanted / n_rows if wanted < n_rows else 1.0
    drawn = df
    if part < 1.0:
        s = int(_step(np.array([xorshift_start(seed)], np.uint64))[0]) & 0xFFFFFFFF
        java = df._jdf.javaRDD().sample(False, part, s - (1 << 32) if s >> 31 else s)
        drawn = DataFrame(spark._jsparkSession.createDataFrame(java, df._jdf.schema()), spark)
    sample = np.array([r.x for r in drawn.select(vector_to_array("x").alias("x")).collect()], float).reshape(-1, n_features)   # some 10,000 rows
    edges = [thresholds(sample[:, j], part * n_rows, most - 1) for j in range(n_features)]
    n_splits = [len(e) for e in edges]
    width = max(n_splits) + 1

    binned = _binned(df.select("y", vector_to_array("x").alias("x")), edges).rdd
    tasks = max(1, min(binned.getNumPartitions(), spark.sparkContext.defaultParallelism))

    def state_of(number, start, bins, y, margin, tree_seed, first=False):
        """A partition's rows for one tree: which are drawn, and their labels."""
        n = len(y)
        use = np.arange(n) if share >= 1.0 else np.flatnonzero(xorshift_doubles(tree_seed + number + 1, start + n)[start:] < share)
        label = y[use].astype(float)
        if not first:
            label = 4.0 * label / (1.0 + java_exp(2.0 * label * margin[use]))
        return number, start, bins, y, margin, use.astype(np.int32), label

    def begin(number, rows):
        for r in rows:
            bins, y = np.frombuffer(r["bins"], np.uint8).reshape(n_features, r["n"]), np.frombuffer(r["y"], np.int8)
            yield state_of(number, r["start"], bins, y, np.zeros(r["n"]), seed, True)

    def later(tree, weight, tree_seed):
        def run(p):
            number, start, bins, y, margin = p[:5]
            return state_of(number, start, bins, y, margin + tree[2][places(bins, tree, depth)] * weight, tree_seed)
        return run

    def level(tree, at_level, slots):
        def run(parts):
            out, size = None, int(slots.max()) + 1
            for _, _, bins, _, _, use, label in parts:
                slot = slots[places(bins, tree, at_level)[use]] if at_level else np.zeros(len(use), np.int64)
                if at_level:
                    kept = np.flatnonzero(slot >= 0)
                    use, label, slot = use[kept], label[kept], slot[kept]
                h = histogram(bins.take(use, axis=1), label, slot, size, width)
                out = h if out is None else out + h
            if out is not None:
                yield out
        return run

    def total(state, *how) -> np.ndarray:
        h = state.coalesce(tasks).mapPartitions(level(*how))
        if tasks > FAN_IN:
            return h.treeReduce(np.add, max(2, math.ceil(math.log(tasks, FAN_IN))))
        out = None
        for x in h.collect():                                            # one histogram a task
            out = x if out is None else out + x
        return out

    roots, state, before, kept = [], binned.mapPartitionsWithIndex(begin).persist(StorageLevel.MEMORY_AND_DISK), None, None
    try:
        for m in range(estimator.getMaxIter()):
            if m and m % KEEP_EVERY == 0:
                state.checkpoint()
            rng, root = JavaRandom(seed + m), Node.__new__(Node)
            root.id, root.stats, root.gain, root.feature, root.cut, root.left, root.right = 1, None, -1.0, -1, 0, None, None
            root.impurity = 0.0
            open_nodes, at_level, parents = [root], 0, {}
            while open_nodes:
                subsets = [feature_sample(n_features, per_node, rng.long()) if per_node < n_features else np.arange(n_features) for _ in open_nodes]
                rows_of = {n.id: n.stats[0] for n in open_nodes if n.id > 1}
                # of two open siblings the one of fewer rows is counted, the other one is the rest of their parent
                small = [n for n in open_nodes if n.id == 1 or n.id ^ 1 not in rows_of or (rows_of[n.id], n.id) < (rows_of[n.id ^ 1], n.id ^ 1)]
                slots = np.full(2 << depth, -1, np.int64)
                slots[[n.id for n in small]] = range(len(small))
                tree = arrays(root, depth) if at_level else None
                counted = total(state, tree, at_level, slots)
                h = {n.id: counted[i] for i, n in enumerate(small)}
                for n in open_nodes:
                    if n.id not in h:
                        h[n.id] = parents[n.id // 2] - h[n.id ^ 1]
                if at_level == 0 and before is not None:
                    before.unpersist()
                    before = None
                if at_level == 0:
                    kept = drop_checkpoint(spark, kept, state)
                stack = []
                for i, n in enumerate(open_nodes):
                    best = split(n, h[n.id], subsets[i], n_splits)
                    if n.stats is None:                                  # a root without any split point
                        n.stats = h[n.id].sum(axis=1)[0]
                    if best is None:
                        continue
                    n.feature, n.cut, n.gain = best[:3]
                    n.left, n.right = Node(2 * n.id, best[3]), Node(2 * n.id + 1, best[4])
                    stack += [c for c in (n.left, n.right) if at_level + 1 < depth and abs(c.impurity) >= EPSILON]
                open_nodes, at_level, parents = stack[::-1], at_level + 1, h
            roots.append(root.pruned())
            if m + 1 < estimator.getMaxIter():
                before, state = state, state.map(later(arrays(root, depth), 1.0 if m == 0 else estimator.getStepSize(), seed + m + 1))
                state.persist(StorageLevel.MEMORY_AND_DISK)
        return _model(df, estimator, roots, edges)
    finally:
        for rdd in (state, before):
            if rdd is not None:
                rdd.unpersist()
        drop_checkpoint(spark, kept, None)


def _model(df: DataFrame, estimator: GBTClassifier, roots: list, edges: list) -> GBTClassificationModel:
    """The trees as Spark ML's model: a model of the same parameters over a few made-up
    rows is saved, its nodes are replaced, and it is loaded again."""
    import json

    from pyspark.ml.linalg import DenseVector
    spark, path = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/gbt-{uuid.uuid4().hex}"
    y, x = estimator.getLabelCol(), estimator.getFeaturesCol()
    few = spark.createDataFrame([(float(i % 2), DenseVector([float(i % 2)] * len(edges))) for i in range(4)],
                                T.StructType([T.StructField(y, T.DoubleType()), T.StructField(x, df.schema["x"].dataType)])).coalesce(1)
    estimator.copy({estimator.maxIter: 1, estimator.subsamplingRate: 1.0}).fit(few).write().overwrite().save(f"{path}/few")
    nodes, trees = spark.read.parquet(f"{path}/few/data"), spark.read.parquet(f"{path}/few/treesMetadata")
    rows = []

    def add(t, n, i):
        """Nodes in depth-first order; the number after the last one."""
        me = len(rows)
        rows.append(None)
        right = after = i + 1
        if n.left is not None:
            right = add(t, n.left, i + 1)
            after = add(t, n.right, right)
        leaf = n.left is None
        at = (-1, [], -1) if leaf else (n.feature, [float(edges[n.feature][n.cut])], -1)
        rows[me] = (t, (i, n.value, n.impurity, [float(s) for s in n.stats], int(n.stats[0]), n.gain, -1 if leaf else i + 1, -1 if leaf else right, at))
        return after

    for t, r in enumerate(roots):
        add(t, r, 0)
    spark.createDataFrame(rows, nodes.schema).write.parquet(f"{path}/model/data")
    about = trees.first()[1]                                             # (number, parameters, weight)
    weights = [1.0 if t == 0 else estimator.getStepSize() for t in range(len(roots))]
    spark.createDataFrame([(t, about, w) for t, w in enumerate(weights)], trees.schema).coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    meta = json.loads(spark.read.text(f"{path}/few/metadata").first()[0])
    meta["numTrees"] = len(roots)
    meta["paramMap"].update(maxIter=estimator.getMaxIter(), subsamplingRate=estimator.getSubsamplingRate())
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    model = GBTClassificationModel.load(f"{path}/model")
    model.featureImportances                                             # kept with the model: its files go
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return model
