"""N-gram Jaccard join with a token-group matrix.

Documents are sets of 5-word shingles.  Similar documents are put into
bounded groups; the matrix row of a group is the union of its members'
tokens.  A query document can only be similar to a member of a group
when its overlap with that union reaches the threshold, so only the
qualifying groups are opened and compared member by member, exactly.

Distributed form:

1. one pass over the texts gives every document its set size, a digest
   of the set, eight min-hashes and a fixed-size sketch of shingle
   frequencies; equal sets collapse to one representative;
2. a representative's group key is its most shared min-hash; the most
   central document of a key is its hub, the members similar to the
   hub are linked to it at once, and members are cut into groups of
   bounded size, linked ones and others apart;
3. the matrix is kept sparsely as (token, group) rows and only for the
   tokens that can decide: two sets that reach the threshold share a
   token among the first ``n // 4 + 1`` of each in any common order,
   here rare tokens first;
4. pairs of groups that share such a token, unless both are linked to
   the same hub, are opened: bound of every query against the other
   union, then exact Jaccard, in blocks;
5. connected components of the links, then back to all copies.

Any common order gives exact results; the sketch only decides how many
groups have to be opened.

Defined cases: null, empty and white-space texts have ``n_shingles`` 0,
link with nothing and are their own component; null ids are kept, have
a null component and link with nothing; repeated rows of an id come
back once per row with equal values; input columns named like an output
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, Scratch, WordHash, cut_lineage, fresh_name, map_rows, mix64, only, ship_by_value, slices, words
from .components import components

ship_by_value(__name__)

WIDTH = 5
KEYS = 8                 # min-hashes per document
KEYS_SHARED = 4          # shared ones from which a document joins a group (others are their own group)
GROUP_MEMBERS = 64       # members of a group on average ...
HUB_MEMBERS = 256        # members compared with one copy of a hub
GROUP_CHARS = 2_000_000  # ... and characters of its texts (one longer text: a group of its own)
SKETCH_BITS = 20
SKETCH_CHUNKS = 16

_HASH = WordHash()
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    w = words(text)
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, w), dtype=np.uint64, count=len(w))
    with np.errstate(over="ignore"):
        if len(h) < WIDTH:
            return np.array([xxhash.xxh3_64_intdigest(b"short " + b" ".join(w))], dtype=np.uint64)
        m = len(h) - WIDTH + 1
        s = h[:m] * _MUL[0]
        for i in range(1, WIDTH):
            s += h[i:i + m] * _MUL[i]
        return np.unique(mix64(s))


def _sketch_slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _profile(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind 0: (id, n, chars, digest, keys); rows of kind 1: parts of a
    task's shingle-frequency sketch."""
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("id", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("chars", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    src = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"))
    from pyspark.sql.pandas.types import to_arrow_schema
    aschema = to_arrow_schema(schema)

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                n, chars, digest, keys, slots = [], [], [], [], []
                for t in part.column(0).to_pylist():
                    s = shingle_set(t)
                    n.append(len(s))
                    chars.append(len(t) if t else 0)
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    if len(s):
                        slots.append(_sketch_slot(s))
                        with np.errstate(over="ignore"):
                            keys.append([int((s * m).min().view(np.int64)) for m in _MUL])
                    else:
                        keys.append(None)
                if slots:
                    sketch += np.bincount(np.concatenate(slots), minlength=len(sketch))
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(rows, np.int32)), part.column(1).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(chars, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], schema=aschema)
        if sketch.any():
            chunks = np.minimum(sketch, 65535).reshape(SKETCH_CHUNKS, -1).astype("<u2")
            k = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(k, np.int32)), pa.array(np.arange(k), pa.int64()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.int64()), pa.array([c.tobytes() for c in chunks], pa.binary()),
                 pa.nulls(k, pa.list_(pa.int64()))], schema=aschema)

    return src.mapInArrow(run, schema)


def _rarity(profile: DataFrame) -> np.ndarray:
    """Rank of every sketch slot by its count (2**SKETCH_BITS numbers): a slot that
    holds a shared shingle stands out from the noise of the unique ones."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("digest", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    aschema = to_arrow_schema(schema)

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(d, "<u8" if len(d) == per * 8 else "<u2").astype(np.uint64)
                sums[i] = sums[i] + v if i in sums else v
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.astype("<u8").tobytes() for v in sums.values()], pa.binary())],
            schema=aschema)

    per = (1 << SKETCH_BITS) // SKETCH_CHUNKS
    parts = profile.where("kind = 1").select("id", "digest")
    parts = parts.mapInArrow(total, schema).repartition(SKETCH_CHUNKS, "id").mapInArrow(total, schema)
    counts = np.zeros((SKETCH_CHUNKS, per), dtype=np.uint64)
    for r in parts.collect():  # SKETCH_CHUNKS rows of fixed size
        counts[r["id"]] += np.frombuffer(r["digest"], "<u8")
    rank = np.unique(counts.ravel(), return_inverse=True)[1]
    return (rank >> max(0, int(rank.max()).bit_length() - 16)).astype(np.uint16)


def _ordered(s: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The set, rare tokens first, ties by hash: one order for all documents."""
    return s[np.argsort(rarity[_sketch_slot(s)], kind="stable")]


def _token_rows(reps: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(token, id, n, pos) of the deciding tokens of every representative."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("id", T.LongType()),
                           T.StructField("n", T.IntegerType()), T.StructField("pos", T.IntegerType())])

    def rows(part):
        tok, ids, ns, pos = [], [], [], []
        for t, i in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            s = shingle_set(t)
            k = len(s) // 4 + 1 if len(s) else 0
            tok.append(_ordered(s, rarity)[:k].astype(np.int64))
            ids.append(np.full(k, i, dtype=np.int64))
            ns.append(np.full(k, len(s), dtype=np.int32))
            pos.append(np.arange(k, dtype=np.int32))
        if tok:
            yield {"token": np.concatenate(tok), "id": np.concatenate(ids),
                   "n": np.concatenate(ns), "pos": np.concatenate(pos)}

    return map_rows(reps.select("text", "id"), schema, rows)


def _matrix(texts: DataFrame, home: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(token, grp, range of set sizes, best places, star): deciding tokens that
    several representatives share, per group.  Copies go before tokens are
    counted: with their texts when the ids can be broadcast, else with their
    token rows, which are narrower to shuffle."""
    ids = home.select("id")
    if ids.count() <= BROADCAST_ROWS:
        tokens = _token_rows(texts.join(F.broadcast(ids), "id", "left_semi"), rarity)
    else:
        tokens = _token_rows(texts, rarity).join(ids, "id", "left_semi")
    shared = tokens.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1").drop("df")
    return shared.join(home, "id").groupBy("token", "grp").agg(
        F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.max("pos").alias("pos"),
        F.max(F.col("n") - F.col("pos") - 1).alias("rest"), F.first("star").alias("star"))


def _links_within(q_ids, q_sets, c_ids, c_sets, threshold):
    """Links between the documents of two opened groups, thinned to a spanning
    forest (components lose nothing)."""
    union = np.unique(np.concatenate(c_sets))                  # the group's matrix row
    sizes_c = np.array([len(s) for s in c_sets])
    cols = np.concatenate([np.searchsorted(union, s) for s in c_sets])
    owner = np.repeat(np.arange(len(c_sets)), sizes_c)
    root = {i: i for i in {*q_ids, *c_ids}}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for qi, q in zip(q_ids, q_sets):
        at = np.searchsorted(union, q)
        at[at == len(union)] = 0
        hit = at[union[at] == q]
        if 100 * len(hit) < threshold * len(q):                # bound: the group stays closed for q
            continue
        mark = np.zeros(len(union), dtype=bool)
        mark[hit] = True
        inter = np.bincount(owner[mark[cols]], minlength=len(c_sets))
        for j in np.flatnonzero(100 * inter >= threshold * (len(q) + sizes_c - inter)):
            a, b = find(qi), find(c_ids[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((qi, c_ids[j]))
    return out


def _open(pairs: DataFrame, threshold: int) -> DataFrame:
    """Rows (q: array<struct<text,id>>, c: the same or null for q itself) -> links (a, b)."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    aschema = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                q = batch.column(0)[k].as_py()
                c = batch.column(1)[k].as_py()
                q_ids, q_sets = [x["id"] for x in q], [shingle_set(x["text"]) for x in q]
                c_ids, c_sets = (q_ids, q_sets) if c is None else ([x["id"] for x in c], [shingle_set(x["text"]) for x in c])
                found = _links_within(q_ids, q_sets, c_ids, c_sets, threshold)
                if found:
                    a, b = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=aschema)

    return pairs.mapInArrow(run, schema)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: int = 75) -> DataFrame:
    """(id_col, n_shingles, component_id), one row per input row: documents with
    100 * |intersection| >= threshold * |union| are linked; component_id is the
    smallest id reachable by links."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    profile = scratch.keep(_profile(docs, id_col, text_col), "profile")
    rarity = _rarity(profile)
    base = cut_lineage(profile.where("kind = 0").drop("kind"))
    del profile
    scratch.drop("profile")

    several = base.where("id IS NOT NULL").groupBy("id").agg(
        F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.min("n").alias("n_lo"), F.count(F.lit(1)).alias("rows"))
    several = several.agg(F.max(F.expr("lo <> hi OR (hi IS NOT NULL AND n_lo = 0)")), F.max("rows")).first()
    if several[0]:
        return _by_row(docs, id_col, text_col, threshold)
    repeated = (several[1] or 0) > 1

    # equal sets collapse to their smallest id
    sets = base.where("id IS NOT NULL AND n > 0")
    reps = sets.groupBy("n", "digest").agg(F.min("id").alias("id"), F.first("keys").alias("keys"), F.first("chars").alias("chars"))
    reps = cut_lineage(reps.select("id", "n", "digest", "keys", "chars"))

    # group key: the most shared min-hash; hub: the most central document of a key
    keyed = reps.select("id", "chars", F.posexplode("keys").alias("slot", "key"))
    shared = keyed.groupBy("slot", "key").count().where("count > 1")
    votes = keyed.join(shared, ["slot", "key"]).groupBy("id").agg(
        F.max(F.struct("count", "slot", "key")).alias("top"), F.sum("count").alias("central"), F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("keys"))
    votes = cut_lineage(votes.where(F.col("keys") >= KEYS_SHARED).select("id", "central", "chars", F.col("top.slot").alias("slot"), F.col("top.key").alias("key")))
    hubs = votes.groupBy("slot", "key").agg(F.max(F.struct("central", (-F.col("id")).alias("id"))).alias("h"),
                                            F.count(F.lit(1)).alias("members"))
    hubs = hubs.where("members > 1").select("slot", "key", (-F.col("h.id")).alias("hub"))
    near_hub = cut_lineage(votes.join(hubs, ["slot", "key"]).select("id", "slot", "key", "hub", "chars"))

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def with_text(ids: DataFrame) -> DataFrame:
        """(id, text), one row per id: all rows of an id have the same set here."""
        found = only(texts, ids)
        return found.dropDuplicates(["id"]) if repeated else found

    # a hub with many members is dealt over several pieces
    pieces = near_hub.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("long").alias("pieces"))
    pieces = cut_lineage(pieces)
    of_group = scratch.keep(with_text(near_hub.select("id")), "of_group")
    hub_text = (of_group.join(pieces, F.col("id") == F.col("hub"))
                .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
                .select("hub", "piece", F.array(F.struct("text", "id")).alias("c")))
    member = (near_hub.where("id <> hub").select("id", "hub").join(pieces, "hub")
              .withColumn("piece", F.pmod(F.xxhash64("id"), "pieces")).join(of_group, "id"))
    hub_links = cut_lineage(_open(
        member.select("hub", "piece", F.array(F.struct("text", "id")).alias("q"))
        .join(hub_text, ["hub", "piece"]).select("q", "c"), threshold))

    # groups of bounded size; members linked to the hub and others apart
    star = near_hub.join(hub_links.select(F.col("a").alias("id"), F.col("b").alias("hub_linked")), "id", "left")
    star = star.withColumn("star", F.when(F.col("id") == F.col("hub"), F.col("hub")).otherwise(F.col("hub_linked")))
    star = star.withColumn("part", F.xxhash64("slot", "key", F.col("star").isNull(), "star"))
    cut = star.groupBy("part").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / GROUP_MEMBERS), F.ceil(F.sum("chars") / GROUP_CHARS)).cast("long").alias("cuts"))
    grouped = star.join(cut, "part").select("id", "star", F.xxhash64("part", F.pmod(F.xxhash64("id"), "cuts")).alias("grp"))
    grouped = cut_lineage(grouped)

    # the deciding rows of the matrix: tokens that at least two groups (or documents) share
    home = cut_lineage(reps.select("id").join(grouped, "id", "left").select(
        "id", "star", F.coalesce("grp", F.xxhash64(F.lit("single"), "id")).alias("grp")))
    matrix = scratch.keep(_matrix(texts.where("id IS NOT NULL AND text IS NOT NULL"), home, rarity), "matrix")
    scratch.drop("hub")
    x, y = matrix.alias("x"), matrix.alias("y")
    can = F.least("x.pos", "y.pos") + 1 + F.least("x.rest", "y.rest")
    # tokens of two sets that are not among the deciding ones of both lie behind those of one of them
    behind = lambda n: F.col(n) - F.floor(F.col(n) / 4) - 1
    need = lambda a, b: F.ceil((F.col(a) + F.col(b)) * threshold / (100 + threshold))
    pairs = (x.join(y, F.col("x.token") == F.col("y.token"))
             .where("x.grp < y.grp")
             .where((F.col("x.n_hi") * 100 >= F.col("y.n_lo") * threshold) & (F.col("y.n_hi") * 100 >= F.col("x.n_lo") * threshold))
             .where(can >= need("x.n_lo", "y.n_lo"))
             .where("x.star IS NULL OR y.star IS NULL OR x.star <> y.star")
             .groupBy(F.col("x.grp").alias("g1"), F.col("y.grp").alias("g2"))
             .agg(F.count(F.lit(1)).alias("both"), F.min("x.n_lo").alias("a_lo"), F.max("x.n_hi").alias("a_hi"),
                  F.min("y.n_lo").alias("b_lo"), F.max("y.n_hi").alias("b_hi"))
             .where(F.col("both") + F.greatest(behind("a_hi"), behind("b_hi")) >= need("a_lo", "b_lo"))
             .select("g1", "g2"))
    pairs = cut_lineage(pairs)
    del x, y, matrix
    scratch.drop("matrix")

    # open the qualifying groups, and every group of unlinked members against itself
    own = grouped.where("star IS NULL").groupBy("grp").count().where("count > 1").select("grp")
    wanted = pairs.select(F.col("g1").alias("grp")).union(pairs.select(F.col("g2").alias("grp"))).union(own).distinct()
    wanted_docs = cut_lineage(home.join(wanted, "grp").select("id", "grp"))
    known = of_group.join(wanted_docs, "id")
    single = with_text(cut_lineage(wanted_docs.join(of_group, "id", "left_anti"))).join(wanted_docs, "id")
    packed = scratch.keep(known.unionByName(single, allowMissingColumns=True).groupBy("grp").agg(
        F.collect_list(F.struct("text", "id")).alias("docs")), "packed")
    del known, single
    nothing = F.lit(None).cast(packed.schema["docs"].dataType)
    first = packed.select(F.col("grp").alias("g1"), F.col("docs").alias("q"))
    second = packed.select(F.col("grp").alias("g2"), F.col("docs").alias("c"))
    opened = (pairs.join(first, "g1").join(second, "g2").select("q", "c")
              .unionByName(packed.join(own, "grp").select(F.col("docs").alias("q"), nothing.alias("c"))))
    links = cut_lineage(hub_links.unionByName(_open(opened, threshold)))
    del opened, first, second, packed, of_group
    scratch.drop()

    comp = components(links)
    of_rep = reps.select("n", "digest", F.col("id").alias("rep")).join(
        comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n", "digest", F.coalesce("component_id", "rep").alias("component_id"))
    named = base.join(of_rep, ["n", "digest"], "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _by_row(docs: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """Ids with several different texts: rows are joined under numbers of their
    own, then an id ties the components of its rows together."""
    rows = cut_lineage(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                                   F.monotonically_increasing_id().alias("row")))
    found = cut_lineage(similar_components(rows, "row", "text", threshold).join(rows.select("row", "id"), "row"))
    linked = found.where("id IS NOT NULL AND n_shingles > 0")
    first = linked.groupBy("component_id").agg(F.min("id").alias("a"))
    comp = components(linked.join(first, "component_id").select("a", F.col("id").alias("b")))
    return found.join(comp.withColumnRenamed("component_id", "c"), "id", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("c", "id").alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 75) -> DataFrame:
    """``docs`` without the near copies: of every component one row stays, of the
    smallest id (null ids last) the first; documents without words all stay."""
    ids = docs.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    if ids.where("id IS NULL OR rows > 1").isEmpty():
        flag = similar_components(docs, id_col, text_col, threshold).where(F.col(id_col) == F.col("component_id"))
        keep = flag.select(F.col(id_col).alias("__keep"))
        return docs.join(keep, docs[id_col] == keep["__keep"], "left_semi")
    # rows are joined under numbers of their own
    row = fresh_name(docs, "row")
    docs = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    ids = docs.select(F.col(f"`{row}`").alias("row"), F.col(f"`{id_col}`").alias("id"))
    texts = docs.select(F.col(f"`{row}`").alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = cut_lineage(similar_components(texts, "row", "text", threshold).join(ids, "row"))
    first = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    keep = cut_lineage(first.select(F.col("first.row").alias("__keep")).unionByName(
        found.where("n_shingles = 0").select(F.col("row").alias("__keep"))))
    return docs.join(keep, F.col(f"`{row}`") == keep["__keep"], "left_semi").drop(row)
