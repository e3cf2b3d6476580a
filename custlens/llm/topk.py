"""Exact top-k search by distributed histogram selection.

Every candidate is scored against every query of a block (one matrix
product per block and batch).  The k-th best score of each query is not
found by sorting but by selection: tasks count scores in a histogram of
the range that still holds it, Spark sums the histograms, and the range
shrinks to one bin until a bin is one score.  Then one more pass keeps the
rows at or above the k-th score, ties to the smaller id.

Tasks send only the bins down to their own k-th best score (no bin below
can hold the global one), and only the k smallest ids of a tie, so what
moves is bounded by queries x tasks x k however many rows share a vector.
Queries are taken in blocks of ``QUERY_BLOCK``; a block is the only thing
that is shipped to all tasks.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, nor do rows with a null id; vectors are only compared with
vectors of the same length; repeated rows are candidates of their own; a
query id that occurs with several vectors asks with the smallest; rows with
the query's own id are not its candidates; finite components of any size are
scored exactly (pairs that could leave 64 bits in Python integers), a score
beyond ``+-LIMIT`` counts as that; with
fewer than k candidates all are returned; an empty table gives no rows;
extra columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_by_value

ship_by_value(__name__)

SCALE = 256
QUERY_BLOCK = 8192
SUB_BLOCK = 512
BINS = 512
LIMIT = 2 ** 63 - 2        # scores are longs


def _floor(x: np.ndarray) -> np.ndarray:
    """floor(256 * x); 256 * x is exact but for the largest doubles, which stay finite."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * x), -np.finfo(np.float64).max, np.finfo(np.float64).max)


def scaled(vectors) -> list:
    """floor(256 * x) of every usable vector, None for the others."""
    out = []
    for v in vectors:
        if v is None or len(v) == 0:
            out.append(None)
            continue
        x = np.array([np.nan if c is None else c for c in v], dtype=np.float64) if isinstance(v, list) else v
        if not np.isfinite(x).all():
            out.append(None)
            continue
        out.append(_floor(x))
    return out


def _by_length(ids, vectors) -> dict:
    """{length: (ids, matrix)} of the usable rows."""
    rows: dict = {}
    for i, v in zip(ids, scaled(vectors)):
        if i is not None and v is not None:
            rows.setdefault(len(v), []).append((i, v))
    return {n: (np.array([i for i, _ in x], dtype=np.int64), np.array([v for _, v in x])) for n, x in rows.items()}


def _fast_rows(batch) -> dict:
    """The same for an Arrow batch; equal-length arrays without nulls go as one matrix."""
    ids, vec = batch.column(0), batch.column(1)
    if batch.num_rows and not ids.null_count and not vec.null_count:
        n = np.diff(vec.offsets.to_numpy())
        flat = vec.flatten()
        if n[0] > 0 and (n == n[0]).all() and not flat.null_count:
            m = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n[0])
            ok = np.isfinite(m).all(axis=1)
            return {int(n[0]): (ids.to_numpy(zero_copy_only=False)[ok], _floor(m[ok]))} if ok.any() else {}
    return _by_length(ids.to_pylist(), vec.to_pylist())


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products (as float64 when all of them fit)."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    big_q, big_c = np.abs(q).max(axis=1), np.abs(c).max(axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        if big_q.max() * big_c.max() * q.shape[1] < 2.0 ** 53:
            return (q @ c.T).astype(np.int64)
        out = _int64(q) @ _int64(c).T                             # exact where no term leaves 64 bits
        wide = np.outer(big_q, big_c) * q.shape[1] >= 2.0 ** 62
    for i, j in zip(*(x.tolist() for x in np.nonzero(wide))):
        out[i, j] = max(-LIMIT, min(LIMIT, sum(int(a) * int(b) for a, b in zip(q[i].tolist(), c[j].tolist()))))
    return out


def _int64(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -2.0 ** 62, 2.0 ** 62).astype(np.int64)


class Block:
    """Queries of one block with the range that holds each one's k-th score."""

    def __init__(self, ids, vectors):
        self.rows = _by_length(ids, vectors)
        self.ids = {n: x[0] for n, x in self.rows.items()}
        self.lo = {n: np.full(len(x[0]), 0, np.int64) for n, x in self.rows.items()}
        self.end = {n: np.full(len(x[0]), 1, np.int64) for n, x in self.rows.items()}      # range: lo <= score < end
        self.width = {n: np.full(len(x[0]), 1, np.int64) for n, x in self.rows.items()}
        self.above = {n: np.zeros(len(x[0]), np.int64) for n, x in self.rows.items()}
        self.open = {n: np.ones(len(x[0]), bool) for n, x in self.rows.items()}


def _batches(batches):
    for b in batches:
        for k in range(0, b.num_rows, 2048):
            yield _fast_rows(b.slice(k, 2048))


def _histogram(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """(length, query, bin, count): bins counted from the low end of each query's
    range, summed over all tasks."""
    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("dim", "query", "bin", "count")])

    def run(batches):
        total = {n: np.zeros((len(i), BINS), np.int64) for n, i in block.ids.items()}
        for got in _batches(batches):
            for n, (ids, c) in got.items():
                if n not in total:
                    continue
                q_ids, q = block.rows[n]
                for a in range(0, len(q), SUB_BLOCK):
                    z = slice(a, a + SUB_BLOCK)
                    s = _scores(q[z], c)
                    ok = (s >= block.lo[n][z, None]) & (s < block.end[n][z, None])
                    at = (s.view(np.uint64) - block.lo[n][z, None].view(np.uint64)) // block.width[n][z, None].view(np.uint64)
                    ok &= (q_ids[z, None] != ids[None, :]) & block.open[n][z, None]
                    row = np.nonzero(ok)[0]
                    total[n][z] += np.bincount(row * BINS + at[ok].astype(np.int64), minlength=s.shape[0] * BINS).reshape(-1, BINS)
        for n, t in total.items():
            best = np.cumsum(t[:, ::-1], axis=1)[:, ::-1]             # scores in this bin or above
            useful = (t > 0) & (best - t < k)                          # down to the task's own k-th score
            qi, bi = np.nonzero(useful)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(qi), n), pa.int64()), pa.array(qi, pa.int64()), pa.array(bi, pa.int64()),
                 pa.array(t[qi, bi], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema).groupBy("dim", "query", "bin").agg(F.sum("count").alias("count"))


def _select(rows: DataFrame, block: Block, bounds: dict, k: int) -> None:
    """Shrink every query's range to the one score that is its k-th best; queries
    with fewer than k candidates keep a range below all scores."""
    for n, (_, q) in block.rows.items():
        with np.errstate(over="ignore", invalid="ignore"):
            reach = np.nan_to_num(np.linalg.norm(q, axis=1) * bounds.get(n, 0.0), nan=0.0, posinf=2.0 ** 63) * (1 + 1e-9)
        reach = [min(LIMIT, int(x) + 2) for x in np.minimum(reach, 2.0 ** 63)]
        block.lo[n] = np.array([-x for x in reach], np.int64)
        block.end[n] = np.array([x + 1 for x in reach], np.int64)
        block.width[n] = np.array([max(1, -(-(2 * x + 1) // BINS)) for x in reach], np.int64)
    while True:
        below = Window.partitionBy("dim", "query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        hist = _histogram(rows, block, k).withColumn("better", F.coalesce(F.sum("count").over(below), F.lit(0)))
        kth = hist.where(F.col("better") < k).groupBy("dim", "query").agg(F.collect_list(F.struct("bin", "better", "count")).alias("bins"))
        found = {(r["dim"], r["query"]): r["bins"] for r in kth.collect()}  # <= k bins a query of the block
        again = False
        for n in block.rows:
            for j in np.flatnonzero(block.open[n]):
                need = k - block.above[n][j]
                hit = next((b for b in sorted(found.get((n, int(j)), []), key=lambda b: -b["bin"])
                            if b["better"] + b["count"] >= need), None)
                if hit is None:                                        # fewer than k candidates: all stay
                    block.width[n][j], block.open[n][j] = 1, False
                    continue
                block.above[n][j] += hit["better"]
                block.lo[n][j] = int(block.lo[n][j]) + hit["bin"] * int(block.width[n][j])
                block.end[n][j] = min(int(block.end[n][j]), int(block.lo[n][j]) + int(block.width[n][j]))
                if block.width[n][j] == 1:
                    block.open[n][j] = False
                else:
                    block.width[n][j] = -(-block.width[n][j] // BINS)
                    again = True
        if not again:
            return


def _filter(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """Rows above each query's k-th score, and of those at it the k smallest ids
    of every task."""
    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("query_id", "vec_id", "score")])

    def run(batches):
        ties: dict = {}
        for got in _batches(batches):
            for n, (ids, c) in got.items():
                if n not in block.rows:
                    continue
                q_ids, q = block.rows[n]
                for a in range(0, len(q), SUB_BLOCK):
                    z = slice(a, a + SUB_BLOCK)
                    s = _scores(q[z], c)
                    t = block.lo[n][z, None]
                    own = q_ids[z, None] != ids[None, :]
                    qi, ci = np.nonzero((s > t) & own)
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[z][qi], pa.int64()), pa.array(ids[ci], pa.int64()),
                                                      pa.array(s[qi, ci], pa.int64())], names=schema.names)
                    qi, ci = np.nonzero((s == t) & own)
                    for j in np.unique(qi):
                        at = (n, a + int(j))
                        ties[at] = sorted([*ties.get(at, []), *ids[ci[qi == j]].tolist()])[:k]
        if ties:
            flat = [(block.ids[n][j], i, block.lo[n][j]) for (n, j), x in ties.items() for i in x]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*flat)], names=schema.names)

    return rows.mapInArrow(run, schema)


def top_k(rows: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every row
    for which ``is_query`` (a condition on ``id_col``) holds, among all other rows."""
    spark = rows.sparkSession
    src = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias(id_col), F.col(f"`{vec_col}`").alias("vec"))
    queries = src.where(is_query).where(F.col("vec").isNotNull())
    # at least |floor(256 * x)|, squared
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (F.abs(x.cast("double")) * SCALE + 1) * (F.abs(x.cast("double")) * SCALE + 1))
    usable = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    longest = src.where(F.col("vec").isNotNull()).where(usable).groupBy(F.size("vec").alias("dim")).agg(F.max(norm).alias("n"))
    bounds = {r["dim"]: float(np.sqrt(r["n"])) for r in longest.collect()}              # one row per vector length
    n_blocks = -(-queries.select(id_col).distinct().count() // QUERY_BLOCK)
    schema = "query_id long, vec_id long, score long"
    out = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        mine = queries.where(F.pmod(F.xxhash64(id_col), F.lit(n_blocks)) == b).groupBy(id_col).agg(F.min("vec").alias("vec"))
        got = mine.collect()                                                              # about QUERY_BLOCK rows
        block = Block([r[0] for r in got], [list(r[1]) for r in got])
        _select(src, block, bounds, k)
        out = out.unionByName(_filter(src, block, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
