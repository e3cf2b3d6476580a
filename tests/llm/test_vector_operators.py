"""Vector codes, embedding near-dedup and the source divergence audit."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from custlens.llm import divergence as D
from custlens.llm import neardup as N
from custlens.llm import vector_codes as V

# -- vector codes -----------------------------------------------------------


def _brute_codes(rows):
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    width = -(-max(len(e) for _, e, _ in kept) // 8) * 8
    step = width // 8

    def whole(e):
        ints = [x.as_integer_ratio()[0] * 4096 // x.as_integer_ratio()[1] for x in map(float, e)] + [0] * (width - len(e))
        return [ints[p * step:(p + 1) * step] for p in range(8)]

    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [whole(e) for _, e, _ in kept]
    books = [[x[k][p] for k in range(min(16, len(x)))] for p in range(8)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            mine = defaultdict(list)
            for v in x:
                mine[near(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k])] if mine[k] else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, total = [], Counter()
    for (i, _, lab), v in zip(kept, x):
        got = [near(v[p], books[p]) for p in range(8)]
        error = min(sum(d for d, _ in got), V.LARGEST)
        total[lab] += error
        out.append((i, "".join(f"{k:02x}" for _, k in got), error, lab))
    return sorted(((i, c, e, min(total[lab], V.LARGEST), sha) for i, c, e, lab in out), key=repr)


def _codes(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, e, lab, "x") for i, e, lab in rows], f"vec_id long, embedding array<{kind}>, label int, code string").repartition(5)
    return sorted(map(tuple, V.compress(df).collect()), key=repr)


def test_codes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(16)], i % 3) for i in range(150)]
    rows += [(200 + i, [0.25] * 16, None) for i in range(40)] + [(7, [0.1] * 16, 1), (7, [0.1] * 16, 1), (None, [0.3] * 16, None)]
    rows += [(300, None, 0), (301, [None] * 16, 0), (302, [float("inf")] * 16, 0), (303, [float("nan")] * 16, 0),
             (304, [0.5] * 3, 2), (305, [], 2)]
    assert _codes(spark, rows) == _brute_codes(rows)


@pytest.mark.parametrize("at", [-1, 10**6])
def test_codes_with_finite_outliers(spark, at):
    """Huge components stay exact, in the first codebook and outside it."""
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 0) for i in range(60)]
    rows += [(at, [1e30, -1e30, 1e200, 0.0, 3e5, 1e6, -2e5, 1.0], 1), (at + 1, [0.0, 3e4, 1e5, 2e5, 1e6, 0.0, 0.0, 1.0], None)]
    assert _codes(spark, rows) == _brute_codes(rows)


def test_codes_of_few_and_no_rows(spark):
    rows = [(3, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [5.0, -2.0], None)]
    assert _codes(spark, rows) == _brute_codes(rows)
    assert _codes(spark, []) == [] and _codes(spark, [(1, None, 1)]) == []
    assert _codes(spark, [(1, [], 1)]) == _brute_codes([(1, [], 1)])


def test_slices_give_the_nearest_entry():
    rng = np.random.default_rng(1)
    book = rng.integers(-5, 6, (16, 3))
    x = rng.integers(-8, 9, (500, 3))                               # many ties
    code, d = V.Slices(book.tolist()).nearest(x)
    full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()


# -- near duplicates --------------------------------------------------------

def _brute_links(rows):
    unit = []
    for i, e, lab in rows:
        ok = i is not None and lab is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
        x = np.array(e) / np.abs(e).max() if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    n, links = len(rows), defaultdict(list)
    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) \
                    and float(unit[a] @ unit[b]) >= 0.93:
                links[a].append(b)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        i = rows[a][0]
        c = None if i is None else min(rows[b][0] for b in seen)
        out.append((i, len(links[a]), c, i is None or i == c))
    return sorted(out, key=repr)


def _links(spark, rows):
    df = spark.createDataFrame([(i, e, lab, 0) for i, e, lab in rows], "vec_id long, embedding array<double>, label int, n_links int").repartition(5)
    return sorted(map(tuple, N.near_duplicates(df).collect()), key=repr)


def _around(rng, centre, angle, n):
    z = rng.normal(size=(n, len(centre)))
    z -= (z @ centre)[:, None] * centre
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return np.cos(angle) * centre + np.sin(angle) * z


def _centre(rng, dim):
    c = rng.normal(size=dim)
    return c / np.linalg.norm(c)


def test_near_duplicates_against_brute_force(spark):
    """Tight, half tight and wide groups, copies, scaled copies, and every odd row."""
    rng = np.random.default_rng(8)
    vectors = list(rng.normal(size=(150, 32)))
    a, b, c = (_centre(rng, 32) for _ in range(3))
    vectors += list(_around(rng, a, 0.11, 150) * 3)                  # a ball
    vectors += list(_around(rng, a, 0.3, 40))                        # open against the ball
    vectors += list(_around(rng, b, 0.25, 60))                       # too wide for a ball
    vectors += [c] * 80 + [2.5 * c, 1e200 * c, 1e-200 * c]           # copies
    rows = [(i, v.tolist(), 1 + (i % 7 == 0)) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, c.tolist(), None), (None, c.tolist(), 1), (903, [float("nan")] * 32, 1),
             (904, [None] * 32, 1), (905, [], 1), (906, c[:16].tolist(), 1), (340, c.tolist(), 1), (340, a.tolist(), 2)]
    got, want = _links(spark, rows), _brute_links(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and found <= there and found >= 0.99 * there
    assert [r[2] for r in got] == [r[2] for r in want] and [r[3] for r in got] == [r[3] for r in want]


def test_tight_groups_and_copies_are_exact(spark):
    rng = np.random.default_rng(9)
    centre = _centre(rng, 64)
    vectors = [*_around(rng, centre, 0.11, 300), *[centre] * 50, *rng.normal(size=(50, 64))]
    rows = [(1000 - i, v.tolist(), 0) for i, v in enumerate(vectors)]
    assert _links(spark, rows) == _brute_links(rows)


def test_recall_of_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = np.concatenate([_around(rng, v, math.acos(0.93) - 1e-9, 1) for v in x])
    rows = [(i, v.tolist(), 5) for i, v in enumerate(np.concatenate((x, pairs)))]
    got = _links(spark, rows)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in _brute_links(rows))


def test_near_duplicates_of_an_empty_table(spark):
    assert _links(spark, []) == []
    assert _links(spark, [(1, None, 1), (2, [0.0], None)]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_tight_groups_do_not_become_pairs(spark):
    """Candidates of a ball are few whatever its size."""
    rng = np.random.default_rng(11)
    v = _around(rng, _centre(rng, 64), 0.11, 600)
    df = spark.createDataFrame([(x.tobytes(), x.tobytes(), "64 1", 1) for x in v], "key binary, unit binary, space string, n long")
    members, points = N._contracted(df, N.Scratch(spark, "test"), 64, 1)
    assert members.count() == 600 and points.count() < 200
    assert N._candidates(members, 64, 1).count() < 600 * 20


# -- source divergence ------------------------------------------------------

def _brute_audit(rows, least, top):
    docs = [((lang or ""), (source or ""), [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        n_of = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}
        whole = sum(n_of.values(), Counter())

        def p(counts):
            total = sum(counts.values())
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = p(whole)
        share = {s: p(n) for s, n in n_of.items()}
        for s in share:
            pairs = [(o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in share if o != s]
            terms = [(t, share[s][t] - q[t]) for t in kept if n_of[s][t] and share[s][t] > q[t]]
            for part, got, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(got, key=lambda g: (-g[1], g[0].encode()))[:limit]
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(ranked)]
    return sorted(out)


def _audit(spark, rows, least, top):
    df = spark.createDataFrame([(*r, 0, "y") for r in rows], "doc_id long, text string, lang string, source string, value int, term string").repartition(5)
    return sorted(map(tuple, D.audit(df, least_documents=least, top_terms=top).collect()))


def _corpus(n=300):
    rng = random.Random(12)
    words = [f"w{'abcdefghij'[i % 10]}{'klmno'[i // 10]}" for i in range(50)] + ["Ärger", "ÄRGER", "été", "日本", "a1b", "it's", "𝔘x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))).replace("w", rng.choice("wW")), rng.choice(["en", "de", None]),
             "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 6)}") for i in range(n)]
    return rows + [(400, None, "en", "s1"), (401, "", None, None), (402, "12 34", "xx", "empty"), (403, None, "xx", None), (0, "wak wak", "en", None)]


def test_audit_against_brute_force(spark):
    rows = _corpus()
    assert _audit(spark, rows, 5, 7) == _brute_audit(rows, 5, 7)


def test_audit_in_small_blocks(spark, monkeypatch):
    """Pairs in blocks of two sources and few counts, terms sent on early."""
    monkeypatch.setattr(D, "SOURCE_BLOCK", 2)
    monkeypatch.setattr(D, "CELLS", 40)
    monkeypatch.setattr(D, "STEP", 3)
    monkeypatch.setattr(D, "HELD", 25)
    monkeypatch.setattr(D, "PIECE", 9)
    rows = _corpus(120)
    assert _audit(spark, rows, 3, 4) == _brute_audit(rows, 3, 4)


def test_audit_of_long_texts_ties_and_no_rows(spark):
    rows = [(i, "same other " * 3, "en", f"s{i % 2}") for i in range(6)] + [(9, "Wort ñ_x " * 400_000, "en", "s0")]
    assert _audit(spark, rows, 1, 50) == _brute_audit(rows, 1, 50)
    assert _audit(spark, [], 1, 50) == []
    assert _audit(spark, [(1, "a", "en", "s"), (2, "b", "en", "t")], 30, 50) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, v = 10**13 + 7, 10**14 + 3, 12345
    got = spark.range(1).select(D._share(str(n), str(total), str(v))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)
