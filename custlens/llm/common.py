"""Helpers shared by the operators of this subpackage.

Functions that run inside tasks are shipped by value
(``ship_by_value``), so executors need neither this package nor a
shared Python path.
"""

from __future__ import annotations

import gc
import sys
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.session import checkpoint_dir, cut_lineage

__all__ = ["Scratch", "append_columns", "cut_lineage", "fresh_name", "held_out", "keep_rows", "lookup", "map_rows", "only", "read",
           "ship_by_value", "slices", "words", "WordHash", "mix64"]

SLICE_BYTES = 1 << 20  # text bytes handled by one numpy step inside a task


def ship_by_value(module_name: str) -> None:
    """Pickle the functions of a module by value when Spark ships them."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


class Scratch:
    """Parquet tables in the shared checkpoint folder that an operator needs for
    a while: ``keep`` writes and rereads, ``drop`` deletes."""

    def __init__(self, spark: SparkSession, stem: str):
        self.spark, self.folder = spark, f"{checkpoint_dir(spark)}/{stem}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str = "") -> None:
        """Delete a table, or the whole folder, and let the driver forget plans
        that no variable holds, so that executors free their shuffle files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()


BROADCAST_ROWS = 1_000_000


def only(df: DataFrame, ids: DataFrame, col: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``col`` is in ``ids`` (distinct, materialised).  The
    ids travel as a broadcast when their counted number allows it (8 MB of
    longs), so wide rows are dropped before any shuffle; else by a
    shuffled semi join."""
    ids = ids.select(col)
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, col, "left_semi")


def held_out(id_col: str, mod: int, rem: int):
    """crc32(id as text) mod ``mod`` equals ``rem``; a null id counts as text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == rem


def slices(batch: pa.RecordBatch, column: int = 0, limit: int = SLICE_BYTES):
    """Cut a batch into runs of rows with at most ``limit`` bytes of the text
    column (a single longer row is a run of its own)."""
    arr = batch.column(column)
    if batch.num_rows == 0:
        return
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def append_columns(df: DataFrame, text_col: str, fields: list[T.StructField], compute,
                   keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``df`` (all by default) plus the columns that
    ``compute(list of texts)`` returns as a dict of arrays, computed over
    whole texts in Arrow batches.  A column of ``df`` that has one of the
    new names is replaced."""
    new = {f.name.lower() for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    used = list(dict.fromkeys([*keep, text_col]))
    at, text_at = [used.index(c) for c in keep], used.index(text_col)
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in fields]
    names = keep + [f.name for f in fields]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_at):
                out = compute(part.column(text_at).to_pylist())
                cols = [part.column(i) for i in at]
                cols += [pa.array(out[f.name], type=t) for f, t in zip(fields, types)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.select([F.col(f"`{c}`") for c in used]).mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, wanted) -> DataFrame:
    """The rows of ``df`` for which ``wanted(list of texts)`` is true, with all
    their columns; decided in Arrow batches without a join."""
    text_at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_at):
                yield part.filter(pa.array(wanted(part.column(text_at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def map_rows(df: DataFrame, schema: T.StructType, fn) -> DataFrame:
    """Arrow map: ``fn(batch slice)`` yields dicts of columns of ``schema``
    (first input column sizes the slices)."""
    from pyspark.sql.pandas.types import to_arrow_type
    names = [f.name for f in schema.fields]
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                for out in fn(part):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[n], type=t) for n, t in zip(names, types)], names=names)

    return df.mapInArrow(run, schema)


def words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and split at ASCII white space (\\x20, \\x09-\\x0D)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered for a bounded number of words."""

    LIMIT = 150_000

    def __missing__(self, w):
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 arrays (wraps modulo 2**64)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def lookup(df: DataFrame, table: DataFrame, on: str, salts: int = 16) -> DataFrame:
    """Left join of ``df`` with a materialised table that has one row per ``on``
    (null-safe).  A table of at most ``BROADCAST_ROWS`` counted rows is
    broadcast; a larger one is replicated ``salts`` times, so that a key with a
    great share of the rows of ``df`` is dealt over as many tasks."""
    right = table.withColumnRenamed(on, "__key")
    if table.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(right), F.col(on).eqNullSafe(F.col("__key")), "left").drop("__key")
    left = df.withColumn("__salt", F.floor(F.rand(1) * salts).cast("int"))
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, F.col(on).eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__salt_r")), "left").drop(
        "__key", "__salt", "__salt_r")
