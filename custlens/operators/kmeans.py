"""K-means for many models at once.

Points travel as blocks, packed rows of doubles that are held once.  A pass
meets every point with the centres of all models that are not settled, so the
starts of all k share their passes: the number of passes is that of the
slowest start, not the sum over all starts, and all silhouettes take two.  Only centres and their sums
(models x k rows) reach the driver.

Starts are k-means|| (two rounds of about 2k points drawn by their cost, then a
weighted k-means++ over the drawn points); rounds follow Spark ML: a centre
without points stays, a model is settled when no centre moves by more than
``tol``, its cost is that of its last round.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

BLOCK = 1024        # points that meet all centres in one numpy step
ROUNDS = 2          # of k-means||

BLOCKS = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.BinaryType())])
SUMS = T.StructType([T.StructField("model", T.IntegerType()), T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()),
                     T.StructField("cost", T.DoubleType()), T.StructField("s", T.ArrayType(T.DoubleType()))])
DRAWN = T.StructType([T.StructField("model", T.IntegerType()), T.StructField("key", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])


def blocks(points: DataFrame, vec: str) -> DataFrame:
    """The vectors of ``points`` packed into blocks and cached (the caller
    unpersists).  Null vectors and null, NaN or infinite components are an error."""
    spark = points.sparkSession
    ship_package(spark)

    def run(batches):
        for b in batches:
            col = b.column(0)
            x = col.flatten()
            flat = x.to_numpy(zero_copy_only=False)
            if col.null_count or x.null_count or not np.isfinite(flat).all():
                raise ValueError("k-means takes no null vectors and no null, NaN or infinite components")
            if len(flat) and (np.diff(col.offsets.to_numpy()) != len(flat) // b.num_rows).any():
                raise ValueError("k-means takes vectors of one length")
            flat = flat.astype("<f8").reshape(b.num_rows, -1)
            parts = [flat[i:i + BLOCK] for i in range(0, b.num_rows, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int64()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], names=BLOCKS.names)

    rows = points.select(F.transform(vec, lambda v: v.cast("double")).alias("v"))
    packed = rows.mapInArrow(run, BLOCKS)
    # dealt evenly: a task's points are what a pass waits for
    parts = max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return packed.repartition(parts).cache()


def _arrays(batches):
    for b in batches:
        for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield np.frombuffer(x, "<f8").reshape(n, -1)


def _by_size(models: dict) -> list:
    """[(numbers of the models with k centres, their centres [k, models, d])]."""
    sizes: dict = {}
    for m, c in models.items():
        sizes.setdefault(len(c), []).append(m)
    return [(ms, np.stack([models[m] for m in ms], axis=1)) for _, ms in sorted(sizes.items())]


def _nearest(x: np.ndarray, groups: list):
    """For every group (models of one k): the nearest centre of every model and
    point (ties to the smaller) and its squared distance, both [models, points]."""
    xx, xt = np.einsum("ij,ij->i", x, x), np.ascontiguousarray(x.T)
    for ms, c in groups:
        k, m, d = c.shape
        h = (c.reshape(-1, d) @ xt).reshape(k, m, -1)
        h *= -2.0
        h += np.einsum("kmd,kmd->km", c, c)[:, :, None]
        best, at = h[0].copy(), np.zeros(h.shape[1:], np.int32)
        for j in range(1, k):
            closer = h[j] < best
            at[closer] = j
            np.minimum(best, h[j], out=best)
        best += xx
        yield ms, k, at, np.maximum(best, 0.0, out=best)


def _sums(data: DataFrame, models: dict) -> dict:
    """{(model, cluster): (points, cost, sum of the points)} of one pass."""
    groups = _by_size(models)
    d = len(next(iter(models.values()))[0])

    def run(batches):
        total = None
        for x in _arrays(batches):
            total = [np.zeros((k, len(ms), d + 2)) for ms, (k, _, _) in ((ms, c.shape) for ms, c in groups)] if total is None else total
            x1 = np.concatenate((x, np.ones((len(x), 1))), axis=1)
            for t, (_, k, at, best) in zip(total, _nearest(x, groups)):
                for j in range(k):
                    own = (at == j).astype(np.float64)
                    t[j, :, :d + 1] += own @ x1
                    t[j, :, d + 1] += np.einsum("ij,ij->i", own, best)
        if total is not None:
            out = [(m, j, int(t[j, i, d]), float(t[j, i, d + 1]), t[j, i, :d].tolist())
                   for t, (ms, _) in zip(total, groups) for i, m in enumerate(ms) for j in range(len(t)) if t[j, i, d]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())))], names=SUMS.names)

    sums = data.mapInArrow(run, SUMS).groupBy("model", "cluster").agg(
        F.sum("n"), F.sum("cost"), F.array(*[F.sum(F.col("s")[i]) for i in range(d)]))
    return {(m, j): (n, cost, np.array(s)) for m, j, n, cost, s in sums.collect()}         # a row per centre


def _first(data: DataFrame, seeds: Sequence[int]) -> dict:
    """{number of the seed: one point, drawn evenly}: the point with the largest of
    evenly drawn keys; a block draws its largest key and the point that has it."""
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        rngs, best = [np.random.default_rng((s, 0, part)) for s in seeds], {}
        for x in _arrays(batches):
            for i, r in enumerate(rngs):
                key, at = np.log1p(-r.random()) / len(x), r.integers(len(x))
                if i not in best or key > best[i][0]:
                    best[i] = (key, x[at].tolist())
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([b[0] for b in best.values()], pa.float64()),
                                              pa.array([b[1] for b in best.values()], pa.list_(pa.float64()))], names=DRAWN.names)

    got = data.mapInArrow(run, DRAWN).groupBy("model").agg(F.max_by("x", "key"))
    return {m: np.array(x)[None, :] for m, x in got.collect()}                             # a row per seed


def _draw(data: DataFrame, models: dict, share: dict, seeds: dict, step: int) -> dict:
    """{model: points, each drawn with probability ``share`` x its cost}."""
    groups = _by_size({m: c for m, c in models.items() if m in share})

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        rngs = {m: np.random.default_rng((seeds[m], step, part)) for m in share}
        for x in _arrays(batches):
            out = [(m, 0.0, p) for ms, _, _, best in _nearest(x, groups) for m, cost in zip(ms, best)
                   for p in x[rngs[m].random(len(x)) < share[m] * cost].tolist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int32(), pa.float64(), pa.list_(pa.float64())))], names=DRAWN.names)

    drawn: dict = {}
    for m, _, x in data.mapInArrow(run, DRAWN).collect() if groups else []:                # about 2k rows a model
        drawn.setdefault(m, []).append(x)
    return drawn


def _plus_plus(points: np.ndarray, weights: np.ndarray, k: int, seed: int, rounds: int = 30) -> np.ndarray:
    """Weighted k-means++ over a few points, then ``rounds`` weighted rounds."""
    rng = np.random.default_rng((seed, ROUNDS + 1))
    centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        p = weights * ((points[:, None] - centres) ** 2).sum(2).min(1)
        if not p.sum() > 0:
            break
        centres = np.concatenate((centres, points[[rng.choice(len(points), p=p / p.sum())]]))
    for _ in range(rounds):
        at = ((points[:, None] - centres) ** 2).sum(2).argmin(1)
        for j in range(len(centres)):
            w = weights * (at == j)
            if w.sum() > 0:
                centres[j] = w @ points / w.sum()
    return centres


def starts(data: DataFrame, wanted: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """k-means|| centres for every (k, seed); fewer than k where fewer distinct points were drawn."""
    seeds = sorted({s for _, s in wanted})
    first = _first(data, seeds)
    if not first:
        raise ValueError("k-means needs at least one point")
    models = {m: first[seeds.index(s)] for m, (_, s) in enumerate(wanted)}
    for step in range(1, ROUNDS + 1):
        cost = dict.fromkeys(models, 0.0)
        for (m, _), (_, c, _) in _sums(data, models).items():
            cost[m] += c
        share = {m: 2.0 * wanted[m][0] / c for m, c in cost.items() if c > 0}
        for m, xs in _draw(data, models, share, {m: s * 1000 + k for m, (k, s) in enumerate(wanted)}, step).items():
            models[m] = np.concatenate((models[m], np.array(sorted(xs))))
    models = {m: np.unique(c, axis=0) for m, c in models.items()}
    sums, out = _sums(data, models), []
    for m, (k, s) in enumerate(wanted):
        c = models[m]
        weights = np.array([sums[m, j][0] if (m, j) in sums else 0 for j in range(len(c))], np.float64)
        out.append(c if len(c) <= k else _plus_plus(c, weights, k, s))
    return out


def lloyd(data: DataFrame, centres: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of every start after its rounds; one pass a round for all that are not settled."""
    centres, cost = [np.array(c, np.float64) for c in centres], [0.0] * len(centres)
    active = list(range(len(centres)))
    for _ in range(max_iter):
        if not active:
            break
        sums, moving = _sums(data, {m: centres[m] for m in active}), []
        for m in active:
            old, cost[m] = centres[m], 0.0
            centres[m] = old.copy()
            for j in range(len(old)):
                if (m, j) in sums:
                    n, c, s = sums[m, j]
                    cost[m] += c
                    centres[m][j] = s / n
            if (((centres[m] - old) ** 2).sum(1) > tol * tol).any():
                moving.append(m)
        active = moving
    return list(zip(centres, cost))


def silhouettes(data: DataFrame, models: Sequence[np.ndarray]) -> list[float]:
    """Mean squared-Euclidean silhouette (``segment.silhouette_sq``) of every
    model's nearest-centre clusters, in two passes for all models."""
    sums = _sums(data, dict(enumerate(models)))
    kept = {m: np.array([c for j, c in enumerate(cs) if (m, j) in sums]) for m, cs in enumerate(models)}
    of = {m: [(*sums[m, j], c) for j, c in enumerate(cs) if (m, j) in sums] for m, cs in enumerate(models)}
    groups = _by_size(kept)
    # clusters of the groups: points n [k, m], sums of the points s [k, m, d], and of their squared lengths q [k, m]
    stats = [tuple(np.stack([np.array([f(*c) for c in of[m]]) for m in ms], axis=1) for f in (
        lambda n, cost, s, c: n, lambda n, cost, s, c: s, lambda n, cost, s, c: cost + 2.0 * (c @ s) - n * (c @ c))) for ms, _ in groups]

    def run(batches):
        total, points = {m: 0.0 for m in kept}, 0
        for x in _arrays(batches):
            points += len(x)
            xx, xt = np.einsum("ij,ij->i", x, x), x.T
            for (n, s, q), (ms, _, at, _) in zip(stats, _nearest(x, groups)):
                t = n[:, :, None] * xx - 2.0 * (s @ xt) + q[:, :, None]          # squared distances to all points of a cluster
                own_n = n[at, np.arange(len(ms))[:, None]]
                a = np.take_along_axis(t, at[None], axis=0)[0] / np.maximum(own_n - 1, 1)
                t /= n[:, :, None]
                np.put_along_axis(t, at[None], np.inf, axis=0)
                b = t.min(0)
                most = np.maximum(a, b)
                ok = (own_n > 1) & np.isfinite(b) & (most != 0)
                value = np.where(ok, np.where(ok, b - a, 0.0) / np.where(ok, most, 1.0), 0.0).sum(1)
                for m, v in zip(ms, value):
                    total[m] += float(v)
        if points:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([0] * len(total), pa.int32()),
                                              pa.array([points] * len(total), pa.int64()), pa.array(list(total.values()), pa.float64()),
                                              pa.array([[]] * len(total), pa.list_(pa.float64()))], names=SUMS.names)

    got = data.mapInArrow(run, SUMS).groupBy("model").agg(F.sum("cost") / F.sum("n")).collect()   # a row per model
    return [v for _, v in sorted(got)]
