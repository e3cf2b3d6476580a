import random

from pyspark.sql import functions as F

from custlens.llm import jaccard_join as J


def _sets(rows):
    out = {}
    for i, t in rows:
        w = t.encode().lower().split() if t else []
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def _brute(rows):
    sets = _sets(rows)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def _corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(20))
    rows = []
    for base in range(12):
        words = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 60, 200]))]
        for copy in range(rng.choice([1, 3, 40])):
            w = list(words)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows) * 3 + 1, " ".join(w) + (" " + line if copy % 5 == 4 else "")))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "two words"), (1004, "TWO  words"), (1005, "one two three four five"),
             (1006, "one two three"), (1007, line), (1008, line.upper())]
    return rows


def test_matches_brute_force_with_ties_and_copies(spark, make_docs):
    rows = _corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_components(make_docs(rows)).collect()}
    assert got == _brute(rows)


def test_threshold_is_inclusive(spark, make_docs):
    base = [f"a{k}" for k in range(11)]                  # 7 shingles
    more = base + ["x"]                                  # 8 shingles, 7 shared: 87.5 %
    far = base[:-1] + ["y", "z"]                         # 8 shingles, 6 shared of 9: 66 %
    rows = [(5, " ".join(base)), (6, " ".join(more)), (7, " ".join(far))]
    got = {r["doc_id"]: r["component_id"] for r in J.similar_components(make_docs(rows)).collect()}
    assert got == {i: c for i, (_, c) in _brute(rows).items()}


def test_repeated_ids_and_null_ids(spark, make_docs):
    text = "a b c d e f g h i j"
    rows = [(1, text), (1, text), (2, "k l m n o p q"), (2, text), (3, "k l m n o p q"), (None, text), (None, None)]
    got = sorted(J.similar_components(make_docs(rows)).collect(), key=str)
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (None, None)}


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert J.similar_components(make_docs([])).collect() == []
    docs = make_docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]).withColumns(
        {"n_shingles": F.lit("x"), "component_id": F.lit("y"), "id": F.lit(0), "grp": F.lit(1)})
    kept = J.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_one_row_of_every_component_stays(make_docs):
    same, other = "a b c d e f g", "one two three four five six"
    docs = make_docs([(3, same), (3, same), (None, same), (None, other), (None, other), (7, same), (8, None), (8, None), (None, "")])
    kept = J.one_per_component(docs.withColumn("row", F.lit(1)))
    assert kept.columns == [*docs.columns, "row"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert got == [(False, 3, same), (False, 8, ""), (False, 8, ""), (True, 0, ""), (True, 0, other)]


def test_hot_group_of_near_copies(spark, make_docs):
    rng = random.Random(5)
    words = [f"v{k}" for k in range(60)]
    rows = []
    for i in range(300):
        w = list(words)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in J.similar_components(make_docs(rows)).collect()}
    assert got == {i: c for i, (_, c) in _brute(rows).items()}
