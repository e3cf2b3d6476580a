"""Source divergence audit by count-cell ranking.

Inside every language the sources are compared by the smoothed shares they
give to the language's terms.  A term's value depends only on its count in
the group and its count in the language, so terms are grouped into cells of
equal (group count, language count): the share difference is evaluated once
per cell, cells with equal values are merged, values are ranked by the
cumulative number of terms above them, and only cells that reach the report
are expanded into terms, in UTF-8 order.

All arithmetic is exact (integers and DECIMAL(38, 0)): a share is
``1 + floor(SCALE * (count + ADD) / (N + ADD * V))`` with N the group's
occurrences of kept terms and V the number of kept terms of its language.

Documents are counted inside tasks per (lang, source), so a source or a
term with a great share of all rows is a few rows per task.  Pairs of
sources are summed in blocks of ``SOURCE_BLOCK`` sources by blocks of terms;
a block sends one row per pair of its sources, whatever the number of terms.

Defined cases: null text, lang and source count as ''; empty texts give
their group without terms; repeated rows are documents of their own; the id
is not read; an empty table gives no rows; a language without kept terms
has pairs of value 0 and no terms; equal values are ranked by UTF-8 bytes;
texts are counted in pieces of about ``PIECE`` bytes, so very long ones need
the memory of their distinct terms; extra columns are not carried.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, ship_by_value, slices

ship_by_value(__name__)

SCALE = 1_000_000_000
ADD = 5
LEAST_DOCUMENTS = 30
TOP_TERMS = 50
PIECE = 1 << 20             # text bytes split at once
HELD = 200_000              # distinct terms that a task holds before it sends them on
SOURCE_BLOCK = 256          # sources of one side of a block of pairs
CELLS = 1 << 15             # counts of one block of terms, about
SMALL_ROWS = 200_000        # rows of a table that travels as a broadcast, some MB
STEP = 2048                 # terms of a block that are laid out at once

# a term is a run of ASCII letters and bytes above 127; only A-Z change case
_FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def _pieces(text: bytes):
    """The folded text in pieces that end between two terms."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + PIECE)
        while stop < len(text) and _FOLD[text[stop]] != 32:
            stop += 1
        yield text[at:stop].translate(_FOLD)
        at = stop


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in
    every group; a row with term null and n 0 names every occurring group."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType()),
                           T.StructField("docs", T.LongType())])
    names = schema.fieldNames()
    types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        held: dict = {}                       # (lang, source) -> (occurrences, documents)
        groups, size = set(), 0

        def flush():
            for (lang, source), (n, d) in held.items():
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, type=t) for x, t in zip(
                            ([lang] * len(n), [source] * len(n), list(n), list(n.values()), [d[w] for w in n]), types)], names=names)
            held.clear()

        for batch in batches:
            for part in slices(batch):
                for text, lang, source in zip(*(c.to_pylist() for c in part.columns)):
                    groups.add((lang, source))
                    n, d = held.setdefault((lang, source), (Counter(), Counter()))
                    before, seen = len(n), set()
                    for piece in _pieces(text):
                        ws = piece.split()
                        n.update(ws)
                        seen.update(ws)
                    d.update(seen)
                    size += len(n) - before
                    if size > HELD:
                        yield from flush()
                        size = 0
        yield from flush()
        if groups:
            lang, source = zip(*sorted(groups))
            k = len(groups)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(
                (lang, source, [None] * k, [0] * k, [0] * k), types)], names=names)

    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(part(text_col).cast("binary").alias("text"), part(lang_col).alias("lang"), part(source_col).alias("source"))
    return rows.mapInArrow(run, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count, total, kept):
    """1 + floor(SCALE * (count + ADD) / (total + ADD * kept)), exactly (0 without terms)."""
    whole = f"CAST({SCALE} AS DECIMAL(38,0)) * CAST({count} + {ADD} AS DECIMAL(28,0))"
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + CAST({whole} AS DECIMAL(38,0)) DIV "
                  f"CAST({total} + {ADD} * {kept} AS DECIMAL(28,0)) ELSE 0 END").cast("long")


def _sized(df: DataFrame) -> DataFrame:
    """A written table as a broadcast side while its counted rows allow it."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, seen, total) of numbered sources a < b: share differences
    summed over the terms that a block of pairs saw, and how many it saw.  Every
    source is in all its blocks by a row without a term."""
    buckets = max(1, -(-counts.count() // CELLS))
    blocks = groups.groupBy("lang").agg((F.max("number") / SOURCE_BLOCK).cast("int").alias("last"))
    mine = (F.col("number") / SOURCE_BLOCK).cast("int")
    named = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
                          F.lit(None).cast("binary").alias("term"), "number", F.col("p_none").alias("p"))
    counted = counts.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), "term", "number", "p")
    rows = (counted.unionByName(named).join(_sized(blocks), "lang")
            .withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("lang", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "bucket", "term", "number", "p"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("a", T.IntegerType()),
                           T.StructField("b", T.IntegerType()), T.StructField("seen", T.LongType()), T.StructField("total", T.LongType())])

    def sums(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        number, p = table.column("number").to_numpy(), table.column("p").to_numpy()
        term = table.column("term").combine_chunks()
        named = term.is_null().to_numpy(zero_copy_only=False)
        order = np.argsort(number[named])
        none = p[named][order]
        name = number[named][order]
        term = term.drop_null().dictionary_encode()
        n = len(term.dictionary)
        who, which, p = np.searchsorted(name, number[~named]), term.indices.to_numpy(), p[~named]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(name // SOURCE_BLOCK == i), np.flatnonzero(name // SOURCE_BLOCK == j)
        total = np.zeros((len(left), len(right)), np.int64)
        order = np.argsort(which, kind="stable")
        for k in range(0, n, STEP):
            mine = order[np.searchsorted(which[order], k):np.searchsorted(which[order], k + STEP)]
            share = np.repeat(none[:, None], min(STEP, n - k), axis=1)               # [sources, some terms]
            share[who[mine], which[mine] - k] = p[mine]
            for x, row in enumerate(left):
                total[x] += np.abs(share[right] - share[row]).sum(axis=1)
        x, y = np.nonzero(left[:, None] < right[None, :])
        return pa.table({"lang": pa.array([lang] * len(x), pa.string()), "a": pa.array(name[left[x]], pa.int32()),
                         "b": pa.array(name[right[y]], pa.int32()), "seen": pa.array(np.full(len(x), n), pa.int64()),
                         "total": pa.array(total[x, y], pa.int64())})

    got = rows.groupBy("lang", "i", "j", "bucket").applyInArrow(sums, schema)
    return got.groupBy("lang", "a", "b").agg(F.sum("seen").alias("seen"), F.sum("total").alias("total"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): the ranked distances of every
    source of a language to the others (part ``pair``) and its ``top_terms``
    terms of the greatest excess over the language (part ``term``)."""
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = scratch.keep(term_counts(docs, text_col, lang_col, source_col), "counts")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= least_documents).select("lang", "term", "lang_n")
    kept = scratch.keep(kept, "kept")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    cells = counts.where("term IS NOT NULL").join(_sized(kept), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    cells = scratch.keep(cells, "cells")
    in_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term IS NULL").select("lang", "source").join(in_group, ["lang", "source"], "left")
              .join(of_lang, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
              .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("p_none", _share("0", "total", "v")))
    groups = scratch.keep(groups, "groups")          # one row per source of a language
    scratch.drop("counts")

    # sources against sources: terms that no block saw are absent from both
    shares = cells.join(_sized(groups), ["lang", "source"]).withColumn("p", _share("n", "total", "v"))
    sums = _pair_sums(shares.select("lang", "term", "number", "p"), groups.select("lang", "number", "p_none"))
    side = groups.select("lang", "number", "source", "v", "p_none")
    both = (side.alias("x").join(side.alias("y"), F.expr("x.lang = y.lang AND x.number <> y.number"))   # the result's own rows
            .select("x.lang", "x.source", F.col("y.source").alias("item"), "x.v",
                    F.least("x.number", "y.number").alias("a"), F.greatest("x.number", "y.number").alias("b"),
                    F.abs(F.col("x.p_none") - F.col("y.p_none")).alias("none")))
    value = F.coalesce("total", F.lit(0)) + (F.col("v") - F.coalesce("seen", F.lit(0))) * F.col("none")
    pairs = both.join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    # terms of a group: cells, merged by value, ranked by the terms above them
    cell = cells.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms"))
    excess = _share("n", "total", "v") - _share("lang_n", "lang_total", "v")
    valued = cell.join(_sized(groups), ["lang", "source"]).withColumn("value", excess).where("value > 0")
    valued = scratch.keep(valued.select("lang", "source", "n", "lang_n", "terms", "value"), "valued")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    best = merged.withColumn("at", F.row_number().over(down)).where(F.col("at") <= top_terms)   # a value has a term at least
    best = best.withColumn("above", F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    best = best.where(F.col("above") < top_terms).select("lang", "source", "value", "above")
    reached = scratch.keep(valued.join(best, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "above"), "reached")
    terms = cells.join(_sized(reached), ["lang", "source", "n", "lang_n"])
    order = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = terms.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top_terms)
    terms = terms.withColumn("rank", (F.col("at") + F.col("above")).cast("int")).where(F.col("rank") <= top_terms)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    return pairs.select("lang", "source", "part", "item", "value", "rank").unionByName(terms)
