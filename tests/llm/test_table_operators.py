"""Top-k search, chat formatting, URL filter, sharding and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from custlens.llm import chat as C
from custlens.llm import sharding as S
from custlens.llm import topk as K
from custlens.llm import url_filter as U
from custlens.llm.common import lookup, read
from custlens.llm.components import components
from custlens.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMOKE
from tests.oracle_util import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    compare(QUERIES[name](spark, SMOKE).toPandas(), duck(SMOKE).sql(ORACLE_SQL[name]).df())


# -- top-k ------------------------------------------------------------------

def _brute_topk(rows, k):
    import math
    v = {}
    for n, (i, e) in enumerate(rows):
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            v.setdefault(len(e), []).append((i, [math.floor(256 * x) for x in e]))
    out = []
    for group in v.values():
        queries = {}
        for i, e in sorted(group):
            if i % 50 == 0:
                queries.setdefault(i, e)
        for q, e in queries.items():
            s = sorted((-sum(a * b for a, b in zip(e, c)), i) for i, c in group if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def test_topk_ties_nulls_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(100)]               # one common vector
    rows += [(301, None), (302, [1.0, None, 0.0, 0.0]), (350, [float("nan")] * 4), (351, [float("inf")] * 4), (None, [9.0] * 4),
             (400, [1.0, 2.0]), (401, [1.0, 1.0]), (500, []), (7, [0.5] * 4), (7, [0.5] * 4), (600, [0.0] * 4)]
    df = spark.createDataFrame([(i, e, 0, 0) for i, e in rows], "vec_id long, embedding array<double>, rank int, score int").repartition(5)
    got = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    assert got == _brute_topk(rows, 5)
    assert K.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


@pytest.mark.parametrize("far", [1e6, 1e13, -1e13, 1e18, 1e308])
def test_topk_with_finite_outliers(spark, far):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(16)]) for i in range(120)]
    rows += [(1001, [far] + [0.5] * 15), (1050, [1.0, -far] + [0.25] * 14)]       # a candidate and a query
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    big = 2.0 ** 1023 * (2 - 2.0 ** -52)
    scaled = [(i, [int(min(big, max(-big, float(np.floor(np.float64(256) * x))))) for x in e]) for i, e in rows]
    want = []
    for q, e in scaled:
        if q % 50 == 0:
            s = sorted((-max(-K.LIMIT, min(K.LIMIT, sum(a * b for a, b in zip(e, c)))), i) for i, c in scaled if i != q)[:5]
            want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert got == sorted(want)


# -- chat -------------------------------------------------------------------

def _events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, turn long, kind string, role string, text string")


def test_fold_of_deltas_edits_and_regenerations(spark):
    e = _events(spark, [
        (1, 0, 0, "message", "user", "hel"), (1, 1, 0, "edit", "user", "hello"),
        (1, 2, 1, "message", "assistant", ""), (1, 3, 1, "delta", "assistant", "a"), (1, 4, 1, "delta", "assistant", "b"),
        (1, 5, 2, "message", "user", "more"),
        (1, 6, 1, "regenerate", "assistant", None), (1, 7, 1, "message", "assistant", "x"), (1, 8, 1, "delta", "assistant", "y"),
        (2, 0, 0, None, None, None)])
    got = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in C.fold(e).collect())
    assert got == [(1, 0, "user", "hello"), (1, 1, "assistant", "xy"), (2, 0, "", "")]


def test_derived_log_folds_back_to_its_rows(spark):
    """All kinds of events occur; repeated rows, turns with several messages, nulls."""
    from custlens.llm.queries import _chat_log
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a", "some text", "é<|end|>\\", "x" * 50]))
            for c in range(12) for t in range(6) for _ in range(rng.choice([1, 1, 2]))] + [(None, None, "user", "lost"), (3, None, None, "void")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    log = _chat_log(df)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in C.fold(log).collect())
    assert got == Counter((c, t, r or "", x or "") for c, t, r, x in rows)


def test_render_round_trip_and_mask(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|>", "\\e\\l<|user|>", "", "|>|", "é\n[x]\\", None]
    rows = [(1, i, i, "message", ["user", "assistant", "a|>b"][i % 3], t) for i, t in enumerate(texts)]
    f = C.parse(C.format_conversations(_events(spark, rows))).first()
    assert [(t["role"], t["text"]) for t in f["turns"]] == [(r[4], r[5] or "") for r in rows]
    masked = [f["formatted"][m["start"]:m["start"] + m["length"]] for m in f["loss_mask"] if m["loss"]]
    back = "".join(masked).replace("\\p", "|").replace("\\b", "[").replace("\\l", "<").replace("\\e", "\\")
    assert back == f["loss_text"] == "".join(r[5] or "" for r in rows if r[4] == "assistant")
    inside = "".join(f["formatted"][m["start"]:m["start"] + m["length"]] for m in f["loss_mask"])
    assert "<" not in inside and "[" not in inside and "|" not in inside
    assert C.format_conversations(_events(spark, [])).count() == 0


def test_repeated_rows_and_null_conversations(spark):
    rows = [(None, 0, 0, "message", "user", "a"), (3, 0, 0, "message", "user", "a"), (3, 0, 0, "message", "user", "a"),
            (3, None, None, "message", "assistant", "n")]
    got = {r["conv_id"]: r for r in C.parse(C.format_conversations(_events(spark, rows))).collect()}
    assert len(got[None]["turns"]) == 1 and len(got[3]["turns"]) == 3
    assert hashlib.sha256(got[3]["loss_text"].encode()).hexdigest() == hashlib.sha256(b"n").hexdigest()


# -- URLs -------------------------------------------------------------------

def _judge(url, rules=U.RULES):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(r), r, v) for r, v in rules for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.example.ORG/es/1?x#y", "https://example.org/en/12", "http://example.org", "http://xorg/", "http://org/", "http://a.com/fr/",
            "http://com/de/x", "http://a.com/FR/", "mailto:x", None, "", "x://y?z=http://org/", "http:///p", "HTTP://B.COM/de/é", "http://é.org/a b"]
    rows = [(i, u, "<p>words here</p>") for i, u in enumerate(urls)] + [(None, "http://x.org/", None), (0, urls[0], "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"verdict": F.lit(1), "rule": F.lit(2)})
    got = U.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = _judge(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert U.judge(pages.limit(0)).count() == 0


def test_segmentation_and_bayes(spark):
    assert U.segment("cheappillsnow", ["cheap", "pills", "now", "pill", "snow", "s"], [3, 3, 3, 3, 9, 9]) == ["cheap", "pills", "now"]
    assert "".join(U.segment("qqq", [], [])) == "qqq"
    html = "<script>var spamx</script><p>" + "green tea house " * 30 + "</p>"
    rows = [(i, f"http://greenteahouse.example.net/{i}", html) for i in range(20)] + [(50, "http://cheappills.example.net/1", html)]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["page_id"] for r in got.where("verdict = 'block'").collect()} == {50}
    counts = {r["word"]: r["n"] for r in U.word_counts(spark.createDataFrame([(html,), (None,)], "html string"), "html").collect()}
    assert counts == {"green": 30, "tea": 30, "house": 30}


# -- sharding ---------------------------------------------------------------

def test_shards_are_exact_and_whole(spark):
    df = spark.range(1003).select((F.col("id") % 500).alias("doc_id"), F.lit("s").alias("shard"), F.lit(1).alias("rid"), F.lit(None).cast("int").alias("x"))
    out = S.shard_rows(df.repartition(7), 16)
    got = out.collect()
    sizes = Counter(r["shard"] for r in got)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sizes[k]))
    assert Counter(r["doc_id"] for r in got) == Counter(i % 500 for i in range(1003))
    few = S.shard_rows(spark.createDataFrame([(None,), (1,)], "doc_id long"), 16).collect()
    assert len(few) == 2 and all(r["slot"] == 0 for r in few)
    assert S.shard_rows(df.limit(0), 16).count() == 0


def test_matrix_and_hypergeometric():
    rng = random.Random(1)
    m = S.communication_matrix([100, 0, 37, 1], [35, 35, 34, 34], 3)
    assert [sum(r) for r in m] == [100, 0, 37, 1] and [sum(c) for c in zip(*m)] == [35, 35, 34, 34]
    draws = [S.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert min(draws) >= 0 and max(draws) <= 20 and abs(sum(draws) / len(draws) - 6) < 0.15
    var = sum((d - 6) ** 2 for d in draws) / len(draws)
    assert abs(var - 20 * 0.3 * 0.7 * 80 / 99) < 0.3


# -- helpers and pipeline ---------------------------------------------------

def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_by_salted_joins(spark, monkeypatch):
    rng = random.Random(9)
    links = [(0, k) for k in range(1, 200)] + [(k, k + 1000) for k in range(0, 200, 3)] + [(rng.randrange(5000, 5300), rng.randrange(5000, 5300)) for _ in range(150)]
    root = {i: i for x in links for i in x}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    monkeypatch.setattr("custlens.llm.common.BROADCAST_ROWS", 0)
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {i for a, b in links if a != b for i in (a, b)}
    assert got == {i: find(i) for i in linked}


def test_lookup_both_ways(spark, monkeypatch):
    left = spark.createDataFrame([("a",)] * 5 + [("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", 1), ("c", 2)], "k string, v int")
    want = Counter([("a", 1)] * 5 + [("b", None), (None, None)])
    assert Counter(map(tuple, lookup(left, table, "k").collect())) == want
    monkeypatch.setattr("custlens.llm.common.BROADCAST_ROWS", 0)
    assert Counter(map(tuple, lookup(left, table, "k").collect())) == want


def test_pipeline_stages(spark):
    docs = read(spark, SMOKE, "documents")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMOKE)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            ids = [r["doc_id"] for r in out.select("doc_id").collect()]
            assert set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
            seen.append(len(ids))
            docs = spark.createDataFrame(out.collect(), docs.schema)
    assert seen == sorted(seen, reverse=True) and seen[-1] > 100
    last = corpus_pipeline.run(spark, SMOKE)
    kept = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == kept
