"""Sharding by a hypergeometric communication matrix.

A uniform shuffle into shards of exact size (law ``rows``: counts at most
one apart).  Source partitions hold n_1..n_P rows; the number of rows that
each sends to each shard is drawn from the multivariate hypergeometric
distribution with those row sums and the shard sizes as column sums.  Rows
are permuted inside their partition, cut by the drawn counts, exchanged,
and permuted again inside the shard.  The result is a uniform permutation,
yet only the matrix (partitions x shards numbers) is made centrally.

The main path uses DataFrame functions only.  A row's second permutation
key is a hash of its row number, so every run over the same partitions
gives the same shards; slots are numbered by counted key ranges, never by
sorting a whole shard in one task.

Defined cases: null texts have size 1 and the checksum of no bytes;
repeated rows are rows of their own; null ids are kept; with fewer rows
than shards some shards are empty; an empty table gives no rows; columns
named like an output are replaced.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, fresh_name

MAX_SOURCES = 4096        # rows of the matrix; more input partitions are coalesced (no shuffle)
SLOT_RANGE = 50_000       # rows of a shard that one task orders


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good ones among ``draws`` without replacement, by inversion
    outwards from the mode (expected steps: the standard deviation)."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(_log_choose(good, mode) + _log_choose(bad, draws - mode) - _log_choose(good + bad, draws))
    u = rng.random() - p
    if u <= 0:
        return mode
    up, down, p_up, p_down = mode, mode, p, p
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1.0) * (bad - draws + up + 1.0))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1.0) * (draws - down + 1.0))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode               # rounding left over less than one unit in the last place


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows sum to ``sources``, columns to ``shards``; drawn cell by cell."""
    rng = random.Random(seed)
    left = list(shards)
    out = []
    for n in sources:
        row, need, pool = [], n, sum(left)
        for k, room in enumerate(left):
            pool -= room
            x = hypergeometric(rng, room, pool, need) if need else 0
            row.append(x)
            need -= x
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def shard_rows(rows: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """``rows`` plus shard (0 to shards - 1) and slot (gapless from 0 in the shard)."""
    rows = rows.drop(*[c for c in rows.columns if c.lower() in ("shard", "slot")])
    spark = rows.sparkSession
    if rows.limit(1).isEmpty():
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    names = {k: fresh_name(rows, k) for k in ("rid", "part", "rank", "key", "range")}
    rid, part, rank, key, rng = names.values()

    # fixed source partitions and row numbers; later passes must see the same ones
    fixed = cut_lineage(rows.coalesce(MAX_SOURCES).withColumn(rid, F.monotonically_increasing_id()))
    first = fixed.sortWithinPartitions(F.xxhash64(F.lit(seed), rid), rid).withColumn(rank, F.monotonically_increasing_id())
    first = first.withColumns({part: F.shiftright(rank, 33).cast("int"), rank: F.col(rank).bitwiseAND(F.lit((1 << 33) - 1))})

    sizes = {r[0]: r[1] for r in fixed.groupBy(F.shiftright(rid, 33).cast("int")).count().collect()}  # <= MAX_SOURCES
    total, parts = sum(sizes.values()), sorted(sizes)
    columns = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = communication_matrix([sizes[p] for p in parts], columns, seed)
    ends = []
    for p, row in zip(parts, matrix):
        acc, cum = 0, []
        for x in row:
            acc += x
            cum.append(acc)
        ends.append([p, cum])
    table = spark.range(1).select(F.inline(F.from_json(                               # <= MAX_SOURCES x shards numbers
        F.lit(json.dumps([{"p": p, "ends": cum} for p, cum in ends])), "array<struct<p:int,ends:array<bigint>>>"))).select(
        F.col("p").alias(part), F.col("ends").alias("__ends"))
    sent = first.join(F.broadcast(table), part).withColumn(
        "shard", F.size(F.filter("__ends", lambda e: e <= F.col(rank)))).drop("__ends", part, rank)

    # second permutation: key ranges of a shard, counted, then ordered one by one
    ranges = max(1, -(-total // (shards * SLOT_RANGE)))
    keyed = sent.withColumn(key, F.xxhash64(F.lit(seed + 1), rid)).withColumn(
        rng, F.floor((F.shiftright(key, 24) + F.lit(1 << 39)) * ranges / F.lit(1 << 40)).cast("int"))
    before = Window.partitionBy("shard").orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("shard", rng).count().select(                             # shards x ranges rows
        "shard", rng, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("shard", rng).orderBy(key, rid))
    return (keyed.withColumn("__inside", inside).join(F.broadcast(counts) if ranges * shards <= 1_000_000 else counts, ["shard", rng])
            .withColumn("slot", F.col("__before") + F.col("__inside") - 1)
            .select(*rows.columns, "shard", "slot"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """Write the rows as Parquet, one sub-folder per shard; a shard's files hold
    consecutive slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
