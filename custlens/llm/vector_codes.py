"""Vector code compression: product codes with an exact slice-and-intersect search.

Vectors are floored to integers, cut into ``PARTS`` equal parts, and every
part is coded by the nearest of the ``ENTRIES`` entries of its codebook.
Codebooks are refined by exact rounds: tasks assign every part of every
vector and add up the parts of each entry, Spark adds the tasks' sums, and
an entry becomes the floored mean of its parts.

The nearest entry is found by slicing: each dimension of a codebook keeps
its sorted coordinates with prefix masks, where the mask at place i has the
bits of the i entries before it.  The distance to one near entry is the
initial radius; in every dimension two searches give the range of
coordinates within it, the XOR of the two prefix masks gives the entries of
the range, and the AND over the dimensions gives the exact candidates: no
entry outside can be as near.  Only candidates are measured, in the order of
their indexes, so ties go to the lower one.

Everything is exact: parts whose distances fit into 64 bits are handled as
64-bit integers, others as Python integers; sums travel in limbs of 32 bits.
Tasks send ``PARTS x ENTRIES x (length + 1)`` numbers a round, however many
rows there are.

Defined cases: vectors that are null or hold a null or non-finite component
are dropped; the first codebook is made of the rows with the smallest ids
(rows without an id last, equal ids by vector), of fewer than ``ENTRIES``
when there are fewer; repeated rows are coded each; vectors shorter than the
longest kept one, and lengths that ``PARTS`` does not divide, are read with
zeros behind them; an empty table gives no rows; errors above the range of a
long are given as its largest value; extra columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, lookup, ship_by_value

ship_by_value(__name__)

SCALE = 4096
PARTS = 8
ENTRIES = 16                # at most 64, the bits of a mask
ROUNDS = 6
ROWS = 4096                 # vectors handled by one numpy step
LIMB = 32
LARGEST = (1 << 63) - 1


def _whole(x: float) -> int:
    """floor(SCALE * x) of a finite float, exactly, whatever its size."""
    num, den = x.as_integer_ratio()
    return num * SCALE // den


def _bound(step: int) -> int:
    """Components up to this size have distances below 2**62 in ``step`` dimensions."""
    return int(2.0 ** 30 / max(1, step) ** 0.5)


def vectors(batch: pa.RecordBatch, width: int):
    """(row numbers, integer matrix [rows, width]) of a batch whose first column
    holds usable vectors: one matrix of 64-bit integers, and one of Python
    integers for the rows that go beyond ``_bound``.  Short vectors are
    followed by zeros."""
    vec = batch.column(0)
    n = np.diff(vec.offsets.to_numpy())
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(n) and (n == width).all():
        x = flat.reshape(len(n), width)
    else:
        x = np.zeros((len(n), width))
        x[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    fits = (np.abs(x) * SCALE < _bound(width // PARTS)).all(axis=1)
    rows = np.flatnonzero(fits)
    if len(rows):
        yield rows, np.floor(x[rows] * SCALE).astype(np.int64)
    rows = np.flatnonzero(~fits)
    if len(rows):
        wide = np.empty((len(rows), width), dtype=object)
        wide[:] = [[_whole(v) for v in r] for r in x[rows].tolist()]
        yield rows, wide


class Slices:
    """Codebook of one part laid out for the search.

    Entries beyond ``_bound`` stay outside the slices.  Those beyond 2**32 are
    farther from every 64-bit row than any entry inside; the others are
    measured one by one."""

    def __init__(self, book: list):
        step = len(book[0])
        size = [max(map(abs, e), default=0) for e in book]
        self.exact = np.empty((len(book), step), dtype=object)
        self.exact[:] = book
        self.inside = [e for e, s in enumerate(size) if s <= _bound(step)]
        self.near = [e for e, s in enumerate(size) if _bound(step) < s <= 1 << 32] if self.inside else range(len(book))
        self.book = self.exact[self.inside].astype(np.int64)
        bit = np.uint64(1) << np.arange(len(self.inside), dtype=np.uint64)
        self.order = [np.argsort(c, kind="stable") for c in self.book.T]
        self.sorted = [c[o] for c, o in zip(self.book.T, self.order)]
        self.prefix = [np.concatenate((np.zeros(1, np.uint64), np.bitwise_or.accumulate(bit[o]))) for o in self.order]

    def nearest(self, x: np.ndarray):
        """(index, squared distance) of the nearest entry of every row."""
        if x.dtype == object:
            return self._one_by_one(x, range(len(self.exact)), None, None)
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        code = least = None
        if self.inside:
            code, least = self._candidates(x)
        return self._one_by_one(x.astype(object), self.near, code, least) if len(self.near) else (code, least)

    def _candidates(self, x: np.ndarray):
        # the entries next to the row in the widest dimension give the initial radius
        wide = int(np.argmax([s[-1] - s[0] for s in self.sorted]))
        at = np.searchsorted(self.sorted[wide], x[:, wide])
        pick = [self.order[wide][np.clip(at - k, 0, len(self.inside) - 1)] for k in (0, 1)]
        first = np.minimum(*(((x - self.book[p]) ** 2).sum(axis=1) for p in pick))
        radius = np.sqrt(first.astype(np.float64)).astype(np.int64) + 1            # never below the true root
        mask = np.full(len(x), np.iinfo(np.uint64).max, dtype=np.uint64)
        for j, (s, prefix) in enumerate(zip(self.sorted, self.prefix)):
            lo = np.searchsorted(s, x[:, j] - radius, side="left")
            hi = np.searchsorted(s, x[:, j] + radius, side="right")
            mask &= prefix[hi] ^ prefix[lo]
        best, least = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        for k, e in enumerate(self.inside):
            rows = np.flatnonzero(mask >> np.uint64(k) & np.uint64(1))
            d = ((x[rows] - self.book[k]) ** 2).sum(axis=1)
            better = d < least[rows]
            best[rows[better]], least[rows[better]] = e, d[better]
        return best, least

    def _one_by_one(self, x: np.ndarray, entries, code, least):
        code = [None] * len(x) if code is None else code.tolist()
        least = [None] * len(x) if least is None else least.tolist()
        for e in entries:
            for i, d in enumerate(((x - self.exact[e]) ** 2).sum(axis=1) if x.shape[1] else [0] * len(x)):
                if least[i] is None or (d, e) < (least[i], code[i]):
                    code[i], least[i] = e, d
        exact = np.empty(len(x), dtype=object)
        exact[:] = least
        return np.array(code, dtype=np.int64), exact


def _usable(rows: DataFrame, vec_col: str) -> DataFrame:
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col(vec_col).isNotNull()).where(~bad)


def _chunks(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _refined(vecs: DataFrame, books: list, width: int) -> list:
    """One round: every entry becomes the floored mean of its parts."""
    step = width // PARTS
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("part", "entry", "place", "limb")] + [T.StructField("value", T.LongType())])

    def run(batches):
        laid = [Slices(b) for b in books]
        sums: dict = {}                                           # (part, entry) -> [count, sums as Python integers]
        for _, x in (got for batch in _chunks(batches) for got in vectors(batch, width)):
            for p, book in enumerate(laid):
                y = x[:, p * step:(p + 1) * step]
                code, _ = book.nearest(y)
                for e in np.unique(code).tolist():
                    mine = y[code == e]
                    old = sums.setdefault((p, e), [0] * (step + 1))
                    sums[p, e] = [a + b for a, b in zip(old, [len(mine), *mine.sum(axis=0).tolist()])]
        out = []
        for (p, e), values in sums.items():
            for place, v in enumerate(values):
                sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
                while v:
                    out.append((p, e, place, limb, sign * (v & (1 << LIMB) - 1)))
                    v, limb = v >> LIMB, limb + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] * 4 + [pa.int64()])],
                                             names=schema.fieldNames())

    total = vecs.mapInArrow(run, schema).groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value"))
    sums: dict = {}
    for r in total.collect():                                      # PARTS x ENTRIES x (length + 1) numbers
        at = r["part"], r["entry"], r["place"]
        sums[at] = sums.get(at, 0) + (r["value"] << LIMB * r["limb"])
    new = []
    for p, book in enumerate(books):
        rows = []
        for e in range(len(book)):
            n = sums.get((p, e, 0), 0)
            rows.append([sums.get((p, e, 1 + j), 0) // n for j in range(step)] if n else book[e])
        new.append(rows)
    return new


def fit(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", rounds: int = ROUNDS, entries: int = ENTRIES):
    """Codebooks [PARTS][entries, part length] over all usable rows, and the width."""
    usable = _usable(vecs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("vec")), "vec")
    longest = usable.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return [], 0
    width = -(-longest // PARTS) * PARTS
    seeds = usable.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    rows = [[*(_whole(float(v)) for v in r["vec"]), *[0] * (width - len(r["vec"]))] for r in seeds]
    step = width // PARTS
    books = [[r[p * step:(p + 1) * step] for r in rows] for p in range(PARTS)]
    for _ in range(rounds):
        books = _refined(usable.select("vec"), books, width)
    return books, width


def digest(books: list) -> str:
    """SHA-256 of all entries' components by part, entry, place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def encode(rows: DataFrame, books: list, width: int, vec_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of the usable rows plus code (two hex digits a part) and
    error (squared distances summed over the parts)."""
    keep = [c for c in rows.columns if c != vec_col] if keep is None else keep
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    step = width // PARTS if width else 0

    def run(batches):
        laid = [Slices(b) for b in books]
        for batch in _chunks(batches):
            codes, error = np.zeros((batch.num_rows, PARTS), np.uint8), np.zeros(batch.num_rows, dtype=object)
            for at, x in vectors(batch, width):
                for p, book in enumerate(laid):
                    codes[at, p], d = book.nearest(x[:, p * step:(p + 1) * step])
                    error[at] += d.astype(object)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array([min(int(e), LARGEST) for e in error], pa.int64())], names=schema.fieldNames())

    src = _usable(rows.select(F.col(f"`{vec_col}`").alias("__vec"), *[F.col(f"`{c}`") for c in keep]), "__vec")
    return src.mapInArrow(run, schema)


def compress(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every usable row."""
    books, width = fit(rows, id_col, vec_col)
    src = rows.select(F.col(f"`{vec_col}`").alias("__vec"), F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").alias("__label"))
    scratch = Scratch(rows.sparkSession, "vector-codes")
    coded = scratch.keep(encode(src, books, width, "__vec", ["__id", "__label"]), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    by_label = scratch.keep(coded.groupBy("__label").agg(total.alias("label_error")), "labels")
    return lookup(coded, by_label, "__label").select(
        F.col("__id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
