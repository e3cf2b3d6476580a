"""Embedding near-dedup by cross-polytope hashing.

Vectors of one label link when their cosine is ``THRESHOLD`` or more.  Each
table rotates the unit vectors with random signs and fast Hadamard
transforms and hashes them to the nearest vertices of cross-polytopes, the
coordinate of the greatest size and its sign.  A vector is indexed under its
own bucket and asks in the ``PROBES`` buckets of least loss (multiprobe).
Pairs that share a bucket and whose 128-bit sign sketches allow the angle
are candidates; every candidate pair is verified in double precision.

Copies and near copies do not become pairs.  Equal vectors are one class.
Classes that fall into one cell in great number form a ball around their
mean as far as they lie within half the threshold angle of it: all its
members link, by the triangle inequality.  Balls are then searched like
vectors (under the buckets of all their members), and the same inequality
says that two balls link entirely or not at all; only pairs that it leaves
open are compared member by member, in blocks.  So a tight group costs its
rows, not their square.  A wider group is verified pair by pair.

The number of polytopes of a hash grows with the logarithm of the counted
classes (about ``PER_BUCKET`` in a bucket), the tables with the polytopes;
recall at the threshold itself is 0.99 up to 10**8 vectors of 64 dimensions
(simulated) and rises quickly above it.

Defined cases: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing, nor do rows without a label or id;
vectors are only compared with vectors of their length; repeated rows are
vectors of their own and link; a row without id has no component and is
kept; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, Scratch, lookup, ship_by_value
from .components import components

ship_by_value(__name__)

THRESHOLD = 0.93
SEED = 12
PROBES = 6
TABLES_PER_POLYTOPE = 4
PER_BUCKET = 16
HOT = 32                     # classes of a cell from which on it may form a ball
BALL_ROUNDS = 2
BLOCK = 512                  # members of one side of an opened block
SKETCH_BITS = 128
SENT = 500_000               # buckets of balls that a task remembers
ROWS = 2048
MARGIN = 1e-6                # radians kept away from every bound


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Walsh-Hadamard transform of every row."""
    h = 1
    while h < x.shape[1]:
        x = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(len(x), -1)
        h *= 2
    return x / np.sqrt(x.shape[1])


def rotated(x: np.ndarray, table: int, polytope: int) -> np.ndarray:
    """Pseudo-random rotation: three times random signs and a transform."""
    signs = np.random.default_rng([SEED, table, polytope]).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def bucket_codes(x: np.ndarray, table: int, polytopes: int, probes: int = PROBES) -> np.ndarray:
    """Codes [rows, probes] of the buckets of least loss, a row's own first."""
    near, loss = [], []
    for k in range(polytopes):
        y = rotated(x, table, k)
        top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
        v = np.take_along_axis(y, top, axis=1)
        near.append(2 * top + (v < 0))
        loss.append((np.abs(v[:, :1]) - np.abs(v)) ** 2)
    ways = np.array(list(itertools.product(range(near[0].shape[1]), repeat=polytopes)))
    cost = sum(loss[k][:, ways[:, k]] for k in range(polytopes))
    chosen = ways[np.argsort(cost, axis=1, kind="stable")[:, :probes]]                # [rows, probes, polytopes]
    code = np.zeros(chosen.shape[:2], dtype=np.int64)
    for k in range(polytopes):
        code = code * (2 * x.shape[1]) + np.take_along_axis(near[k], chosen[:, :, k], axis=1)
    return code


def sketches(x: np.ndarray) -> np.ndarray:
    """Sign sketch of every row as two 64-bit integers."""
    n = -(-SKETCH_BITS // x.shape[1])
    bits = np.concatenate([rotated(x, 1 << 20, k) < 0 for k in range(n)], axis=1)[:, :SKETCH_BITS]
    return np.packbits(bits, axis=1).view("<i8")


def _units(vectors: list, dim: int) -> np.ndarray:
    """Unit vectors [rows, dim]; rows of zeros for vectors that link with nothing."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        if v is not None and len(v):
            x = np.array([np.nan if c is None else c for c in v], dtype=np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top
                out[i, :len(x)] = x / np.sqrt((x * x).sum())
    return out


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def _map(df: DataFrame, add: str, fn) -> DataFrame:
    """``df`` with the columns of the schema text ``add``; ``fn(batch)`` returns them."""
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(add).fields)
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in schema.fields[len(df.columns):]]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, type=t) for c, t in zip(fn(b), types))],
                                                 names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def _sized(df: DataFrame) -> DataFrame:
    """A written table as a broadcast side while its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _prepared(rows: DataFrame, dim: int) -> DataFrame:
    """(vec_id, space, key, unit): key of the class of equal vectors (null: links with
    nothing); vectors of one space are compared."""
    def fn(b):
        ids, labels, vectors = (c.to_pylist() for c in b.columns[:3])
        unit = _units(vectors, dim)
        ok = [i is not None and s is not None and u.any() for i, s, u in zip(ids, labels, unit)]
        space = [f"{len(v)} {s}" if o else None for o, v, s in zip(ok, vectors, labels)]
        raw = [np.asarray(v, dtype=np.float64) + 0.0 if o else None for o, v in zip(ok, vectors)]
        return (space, [xxhash.xxh3_128_digest(s.encode() + b"\0" + v.tobytes()) if o else None for o, s, v in zip(ok, space, raw)],
                [u.tobytes() if o else None for o, u in zip(ok, unit)])

    return _map(rows, "space string, key binary, unit binary", fn).select("vec_id", "space", "key", "unit")


def _sums(df: DataFrame, dim: int) -> DataFrame:
    """(space, cell, centre): unit mean directions of cells, added up inside tasks first."""
    schema = T.StructType.fromDDL("space string, cell long, place int, value double")

    def run(batches):
        held: dict = {}

        def flush():
            for (space, cell), v in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([space] * dim, pa.string()), pa.array([cell] * dim, pa.int64()),
                                                  pa.array(range(dim), pa.int32()), pa.array(v, pa.float64())], names=schema.fieldNames())
            held.clear()

        for b in batches:
            for space, cell, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _matrix(b.column(2), dim)):
                held[space, cell] = held.get((space, cell), 0.0) + u
            if len(held) > 4096:
                yield from flush()
        yield from flush()

    total = df.select("space", "cell", "unit").mapInArrow(run, schema).groupBy("space", "cell", "place").agg(F.sum("value").alias("value"))
    return total.groupBy("space", "cell").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("centre"))   # dim values


MEMBER = ["point", "low", "high", "radius", "members"]        # what a member knows of its point


def _contracted(classes: DataFrame, scratch: Scratch, dim: int, polytopes: int):
    """Members (space, key, unit, n, ``MEMBER``) and points (space, point, unit,
    radius, n, members): balls of the hot cells, and every other class by itself."""
    half = math.acos(THRESHOLD) / 2 - MARGIN
    rest, members, points = classes, [], []
    for t in range(BALL_ROUNDS):
        def cell(b, t=t):
            return [bucket_codes(_matrix(b.column("unit"), dim), (1 << 16) + t, polytopes, 1)[:, 0]]

        cells = _map(rest, "cell long", cell)
        hot = scratch.keep(cells.groupBy("space", "cell").count().where(F.col("count") >= HOT).select("space", "cell"), f"hot{t}")
        if hot.isEmpty():
            break
        centres = scratch.keep(_sums(cells.join(_sized(hot), ["space", "cell"]), dim), f"centres{t}")

        def angle(b):
            x = _matrix(b.column("unit"), dim)
            out = []
            for u, c in zip(x, b.column("centre").to_pylist()):
                c = None if c is None else np.array(c)
                norm = 0.0 if c is None else np.sqrt((c * c).sum())
                a = math.acos(max(-1.0, min(1.0, float(u @ c) / norm))) if norm > 0 else math.inf
                out.append(a if a <= half else None)
            return [out]

        near = scratch.keep(_map(cells.join(_sized(centres), ["space", "cell"], "left"), "angle double", angle).drop("centre"), f"near{t}")
        rest = near.where("angle IS NULL").drop("cell", "angle")
        inside = near.where("angle IS NOT NULL")
        balls = inside.groupBy("space", "cell").agg(F.max("angle").alias("radius"), F.sum("n").alias("n"), F.count("*").alias("members"))

        def ball(b, t=t):
            c = np.array(b.column("centre").to_pylist()).reshape(b.num_rows, dim)
            c = c / np.sqrt((c * c).sum(axis=1, keepdims=True))
            s = sketches(c) if len(c) else np.zeros((0, 2), np.int64)
            names = [xxhash.xxh3_128_digest(f"{t} {cell} {space}") for cell, space in
                     zip(b.column("cell").to_pylist(), b.column("space").to_pylist())]
            return names, [u.tobytes() for u in c], s[:, 0], s[:, 1]

        balls = scratch.keep(_map(balls.join(centres, ["space", "cell"]), "point binary, unit binary, low long, high long", ball), f"balls{t}")
        points.append(balls.select("space", "point", "unit", "radius", "n", "members"))
        named = balls.select("space", "cell", "point", "low", "high", "radius", "members")
        members.append(inside.join(_sized(named), ["space", "cell"]).select("space", "key", "unit", "n", *MEMBER))

    def alone(b):
        s = sketches(_matrix(b.column("unit"), dim)) if b.num_rows else np.zeros((0, 2), np.int64)
        return s[:, 0], s[:, 1]

    single = _map(rest, "low long, high long", alone).withColumns(
        {"point": F.col("key"), "radius": F.lit(0.0), "members": F.lit(1).cast("long")})
    members.append(single.select("space", "key", "unit", "n", *MEMBER))
    points.append(rest.select("space", F.col("key").alias("point"), "unit", F.lit(0.0).alias("radius"), "n", F.lit(1).cast("long").alias("members")))
    union = lambda x: x[0] if len(x) == 1 else union([x[0].unionByName(x[1]), *x[2:]])
    return scratch.keep(union(members), "members"), scratch.keep(union(points), "points")


def _candidates(members: DataFrame, dim: int, polytopes: int) -> DataFrame:
    """Distinct pairs (a, b) of points that share a bucket and whose sketches allow a link."""
    schema = T.StructType.fromDDL("bucket long, probe boolean, point binary, low long, high long, radius double")

    def run(batches):
        sent: set = set()                                  # buckets that a ball of this task has asked in already
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                x = _matrix(b.column(0), dim)
                rest = [b.column(c) for c in ("point", "low", "high", "radius")]
                points = rest[0].to_pylist()
                in_ball = np.flatnonzero(rest[3].to_numpy() > 0).tolist()
                spaces = np.array([xxhash.xxh3_64_intdigest(s) for s in b.column("space").to_pylist()], dtype=np.uint64)
                if len(sent) > SENT:
                    sent.clear()
                for t in range(polytopes * TABLES_PER_POLYTOPE):
                    codes = bucket_codes(x, t, polytopes)
                    for p in range(codes.shape[1]):
                        key = (codes[:, p].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t)) * np.uint64(0xBF58476D1CE4E5B9)
                        key = ((key ^ key >> np.uint64(29)) + spaces).view(np.int64)
                        for probe in ([False, True] if p == 0 else [True]):
                            new = np.ones(len(x), bool)
                            for i in in_ball:
                                mine = (points[i], int(key[i]), probe)
                                new[i] = mine not in sent
                                sent.add(mine)
                            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([probe] * len(x), pa.bool_()), *rest],
                                                             names=schema.fieldNames()).filter(pa.array(new))

    # dealt by bucket once: what is left of a ball's repeated buckets goes in place
    rows = members.select("unit", "space", "point", "low", "high", "radius").mapInArrow(run, schema)
    rows = rows.repartition("bucket").dropDuplicates(["bucket", "probe", "point"])
    a, b = rows.where("NOT probe").alias("a"), rows.where("probe").alias("b")
    share = (F.col("a.radius") + F.col("b.radius") + math.acos(THRESHOLD)) / math.pi           # greatest angle of the middles
    share = F.least(share, F.lit(1.0))
    allowed = SKETCH_BITS * share + 6 * F.sqrt(SKETCH_BITS * share * (1 - share))
    differing = F.bit_count(F.col("a.low").bitwiseXOR(F.col("b.low"))) + F.bit_count(F.col("a.high").bitwiseXOR(F.col("b.high")))
    hit = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.point") != F.col("b.point")) & (differing <= allowed))
    return hit.select(F.least("a.point", "b.point").alias("a"), F.greatest("a.point", "b.point").alias("b")).distinct()


def _decided(pairs: DataFrame, points: DataFrame, dim: int) -> DataFrame:
    """(a, b, ..., verdict): ``all`` members link, ``none`` do, or the pair is ``open``."""
    side = lambda s: points.select(F.col("point").alias(s), F.col("space").alias(f"{s}_space"), F.col("unit").alias(f"{s}_unit"), F.col("radius").alias(f"{s}_radius"),
                                   F.col("n").alias(f"{s}_n"), F.col("members").alias(f"{s}_members"))
    theta = math.acos(THRESHOLD)

    def fn(b):
        cos = np.einsum("ij,ij->i", _matrix(b.column("a_unit"), dim), _matrix(b.column("b_unit"), dim)) if b.num_rows else np.zeros(0)
        reach = np.array(b.column("a_radius").to_pylist()) + np.array(b.column("b_radius").to_pylist())
        angle = np.arccos(np.clip(cos, -1.0, 1.0))
        sure = np.where(reach > 0, angle + reach <= theta - MARGIN, cos >= THRESHOLD)
        never = np.where(reach > 0, angle - reach > theta + MARGIN, cos < THRESHOLD)
        return [np.where(sure, "all", np.where(never, "none", "open")).tolist()]

    both = pairs.join(side("a"), "a").join(side("b"), "b").where("a_space = b_space").drop("a_space", "b_space")   # buckets are hashes
    return _map(both, "verdict string", fn).drop("a_unit", "b_unit")


def _opened(pairs: DataFrame, members: DataFrame, dim: int):
    """(a, b, key, n): links of members in pairs of points that the bounds leave open."""
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    pairs = pairs.select("a", "b", each("a_members").alias("a_block"), "b_members").select("a", "b", "a_block", each("b_members").alias("b_block"))
    mine = members.select("point", F.pmod(F.xxhash64("key"), blocks("members")).cast("int").alias("block"), "key", "unit", F.col("n").alias("size"))

    def side(s):
        at = (F.col(s) == F.col("point")) & (F.col(f"{s}_block") == F.col("block"))       # a ball is spread over its blocks
        return pairs.join(mine, at).select("a", "b", "a_block", "b_block", F.lit(s).alias("side"), "key", "unit", "size")

    schema = T.StructType.fromDDL("a binary, b binary, key binary, n long")

    def count(table: pa.Table) -> pa.Table:
        sides = np.array(table.column("side").to_pylist())
        unit, size, key = _matrix(table.column("unit"), dim), table.column("size").to_numpy(), np.array(table.column("key").to_pylist(), dtype=object)
        i, j = np.flatnonzero(sides == "a"), np.flatnonzero(sides == "b")
        link = unit[i] @ unit[j].T >= THRESHOLD
        keys = [*key[i], *key[j]]
        n = np.concatenate((link @ size[j], size[i] @ link)).astype(np.int64)
        some = np.flatnonzero(n)
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        return pa.table({"a": pa.array([a] * len(some), pa.binary()), "b": pa.array([b] * len(some), pa.binary()),
                         "key": pa.array([keys[k] for k in some], pa.binary()), "n": pa.array(n[some], pa.int64())})

    return side("a").unionByName(side("b")).groupBy("a", "b", "a_block", "b_block").applyInArrow(count, schema)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    scratch = Scratch(rows.sparkSession, "near-duplicates")
    src = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vec_col}`").alias("vec"))
    longest = src.agg(F.max(F.size("vec"))).first()[0] or 0
    dim = 1 << max(3, (longest - 1).bit_length())
    ready = _prepared(src, dim)
    keyed = scratch.keep(ready.select("vec_id", "key"), "keyed")
    classes = scratch.keep(ready.where("key IS NOT NULL").groupBy("key").agg(
        F.first("space").alias("space"), F.first("unit").alias("unit"), F.min("vec_id").alias("least"), F.count("*").alias("n")), "classes")
    total = classes.count()
    polytopes = max(1, math.ceil(math.log(max(1.0, total / PER_BUCKET)) / math.log(2 * dim)))
    members, points = _contracted(classes.drop("least"), scratch, dim, polytopes)
    decided = scratch.keep(_decided(_candidates(members, dim, polytopes), points, dim), "decided")
    opened = scratch.keep(_opened(decided.where("verdict = 'open'"), members, dim), "opened")
    sure = decided.where("verdict = 'all'")

    of_point = (points.select("point", F.col("n").alias("links"))
                .unionByName(sure.select(F.col("a").alias("point"), F.col("b_n").alias("links")))
                .unionByName(sure.select(F.col("b").alias("point"), F.col("a_n").alias("links")))
                .groupBy("point").agg(F.sum("links").alias("links")))
    of_member = opened.groupBy("key").agg(F.sum("n").alias("more"))
    edges = sure.select("a", "b").unionByName(opened.select("a", "b").distinct())
    group = components(edges).withColumnRenamed("id", "point")
    of_point = scratch.keep(of_point.join(group, "point", "left"), "of-point")
    of_class = scratch.keep(classes.select("key", "least").join(of_member, "key", "left"), "of-class")
    linked = lookup(members.select("key", "point"), of_point, "point").join(of_class, "key").select(
        "key", F.coalesce("component_id", "point").alias("component"),
        (F.col("links") + F.coalesce("more", F.lit(0)) - 1).alias("n_links"), "least")
    linked = scratch.keep(linked, "linked")
    least = scratch.keep(linked.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    result = scratch.keep(lookup(linked, least, "component").select("key", "n_links", "component_id"), "result")
    out = lookup(keyed, result, "key").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                              F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
