"""Toxicity, language, packing, decontamination and LM scoring."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from custlens.llm import attention_lm as A
from custlens.llm import decontam as D
from custlens.llm import langid as L
from custlens.llm import packing as P
from custlens.llm import toxicity as X
from custlens.llm.common import held_out, read
from custlens.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SMALL, SMOKE


# -- toxicity ---------------------------------------------------------------

def test_grammar_rewrites_insults_by_context():
    t = X.Tagger({"idiot": 1.0}, {"slur": 0.5})

    def classes(text):
        f = X.clause_features(text, t)
        return {c for c, v in zip(X.CLASSES, f[1:9]) if v}

    assert classes("you utter idiot") == {"J"}
    assert classes("an idiot") == {"I"}
    assert classes("not an idiot") == {"i"}
    assert classes("they wrote idiot on it") == {"q"}
    assert classes("an idiot you are") == {"I", "K"}
    assert classes("not so. idiot") == {"I"}                 # a clause ends a denial
    assert classes("slurry and slurs") == {"I"}              # stems
    assert classes("i kill you") >= {"t"} or classes("kill it") == {"T"}


def test_grammar_table_agrees_with_running_the_transducers():
    rng = random.Random(1)
    machine = [(X._reported, 0), (X._negated, 0), (X._aimed, 0), (X._aimed_after, 0)]
    for _ in range(200):
        word = [rng.choice("OITYNR") for _ in range(12)]
        states, state = [s for _, s in machine], 0
        for x in word:
            y = x
            for k, (step, _) in enumerate(machine):
                states[k], y = step(states[k], y)
            state, z = X.GRAMMAR[state, x]
            assert z == y


def test_toxicity_held_out(spark):
    got = QUERIES["op10_toxicity"](spark, SMALL).join(read(spark, SMALL, "labels"), "doc_id").where("held_out AND toxic IS NOT NULL")
    hit = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert hit > 0.9


def test_toxicity_without_labels_and_edge_texts(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (2, "..."), (None, "you idiot, you moron, you scum. idiot! idiot! moron!"), (4, "a fine day")])
    docs = docs.withColumns({"score": F.lit("s"), "predicted": F.lit(7)})
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    got = {(r["doc_id"], r["text"]): r for r in X.score(docs, model).collect()}
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got.values())
    assert [r["predicted"] for k, r in got.items() if k[0] is None] == [1]
    assert got[4, "a fine day"]["predicted"] == got[1, None]["predicted"] == got[2, ""]["predicted"] == 0
    kept = X.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    assert X.score(make_docs([]), model).count() == 0


# -- language ---------------------------------------------------------------

def test_language_held_out(spark):
    got = QUERIES["op1_language_id"](spark, SMALL).join(read(spark, SMALL, "documents").select("doc_id", "lang"), "doc_id")
    hit = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert hit > 0.97
    assert got.where("score < 0 OR score > 1").isEmpty()


def test_trigrams_and_owner_of_words():
    slot, starts, owner = L.trigrams(["ab c", None, "", "İx d"])
    # lower-casing makes the dotted capital a letter and a mark, which ends the word
    assert len(starts) == 5 and owner.tolist() == [0, 0, 3, 3, 3] and len(slot) == 6


def test_languages_of_a_text_do_not_depend_on_its_slice():
    # a and b nearly alike, c apart: two languages do not pay, three do
    table = np.full((1 << L.BITS, 3), -12.0, dtype=np.float32)
    for word, row in (("x", (-5, -5.3, -12)), ("y", (-5.3, -5, -12)), ("z", (-12, -12, -5))):
        table[L.trigrams([word])[0][0]] = row
    model = L.Model(["a", "b", "c"], table)
    text, mate = "x " * 8 + "y " * 7 + "z " * 5, "x " * 10 + "z " * 10
    alone = L.mixtures([text], model)[0]
    assert (alone > 0).all()
    assert np.allclose(alone, L.mixtures([mate, text], model)[1], atol=1e-6)


def test_language_mixture_and_edges(spark, make_docs):
    en = "the of and thing with that this " * 12
    de = "der die und nicht schon über sich " * 12
    rows = [(i, en, "en") for i in range(4)] + [(10 + i, de, "de") for i in range(4)] + [
        (20, None, "en"), (21, "", None), (22, "12 34 !", "en"), (23, en + de, None), (None, de, None)]
    docs = make_docs(rows).withColumn("score", F.lit("x"))
    model = L.fit(docs)
    got = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    assert got[0]["lang_pred"] == "en" and got[10]["lang_pred"] == got[None]["lang_pred"] == "de"
    assert [got[i]["lang_pred"] for i in (20, 21, 22)] == ["und"] * 3 and got[20]["score"] == 0
    assert sorted(got[23]["languages"]) == ["de", "en"] and abs(got[23]["score"] - 0.5) < 0.1
    nothing = L.fit(make_docs([]))
    assert {r["lang_pred"] for r in L.predict(docs, nothing).collect()} == {"und"}
    assert L.reject(docs, model).columns == docs.columns


# -- packing ----------------------------------------------------------------

def test_pieces_are_powers_of_two():
    for n in [1, 2, 3, 4095, 4096, 4097, 12345]:
        p = list(P.pieces(n))
        assert sum(m for _, m in p) == n and [s for s, _ in p] == [sum(m for _, m in p[:k]) for k in range(len(p))]
        assert all(m & (m - 1) == 0 and m <= 4096 for _, m in p)


def test_packing_round_trip(spark, make_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    odd = ["Hello  WORLD's it's <|endoftext|> <|ENDOFTEXT|>x", "été ́x Σίσυφος ΑΣ", "a\x0bb\x1cc\x85d", "İstanbul ǅ 日本語 12,345.67 don't",
           "", None, " \n", "ﬁn ½ x²", "the,and.,! 'll 's it,s", "word " * 5000]
    rows = [(i, t) for i, t in enumerate(odd)] + [(r["doc_id"] + 100, r["text"]) for r in read(spark, SMOKE, "documents").collect()]
    got = P.pack(make_docs(rows), tokenizer_path()).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in got}) == len(got) and all(r["offset"] == 0 for r in got)
    for i, t in rows:
        want = tok.encode(t or "", add_special_tokens=False).ids + [2]
        have = sorted(by_doc[i], key=lambda r: r["start"])
        assert np.frombuffer(b"".join(r["ids"] for r in have), "<u4").tolist() == want
        assert all(r["doc_tokens"] == len(want) and r["length"] == len(r["ids"]) // 4 == 1 << r["bucket"] for r in have)
    assert P.pack(make_docs([]), tokenizer_path()).count() == 0
    twice = P.pack(make_docs([(1, "a b"), (1, "a b"), (None, None)]), tokenizer_path()).collect()
    assert sum(r["length"] for r in twice) == 7


# -- decontamination --------------------------------------------------------

def test_decontamination_against_substrings(spark):
    import re
    docs, bench = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")

    def plain(t):
        return re.sub(r"[\W_]+", " ", t.lower()).strip()

    items = {r["item_id"]: plain(r["text"]) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items() if t in plain(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()}
    assert got == want and want
    kept = {r["doc_id"] for r in D.clean(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {i for i, _ in want}


def test_edits_within_the_budget_are_found():
    rng = random.Random(2)
    item = "".join(rng.choice("abcdefgh ") for _ in range(200))
    index = D.Index([(7, item)])
    for edits, found in ((0, True), (2, True), (60, False)):
        t = list(item)
        for k in range(edits):
            t[10 + k * (180 // max(1, edits))] = "x"
        assert bool(D.find("before it " + "".join(t) + " after it", index)) is found
    assert D.find(item[50:160].upper().replace(" ", " ,\n"), index)          # a part, other case and marks


def _plain_edits(seg, window):
    """Least edits of ``seg`` against any part of ``window``, row by row."""
    row, window = np.zeros(len(window) + 1, np.int64), np.asarray(window)
    for i, c in enumerate(seg, 1):
        new = np.concatenate(([i], np.minimum(row[:-1] + (window != c), row[1:] + 1)))
        step = np.arange(len(new))
        row = np.minimum.accumulate(new - step) + step                      # bytes of the text that the segment lacks
    return int(row.min()), int(row.argmin())


def test_alignment_against_a_plain_table():
    rng = np.random.default_rng(4)
    flat = rng.integers(97, 100, 900).astype(np.uint8)
    text = np.concatenate([rng.integers(97, 100, 200), flat[300:500], rng.integers(97, 100, 200)]).astype(np.uint8)
    at, lo = rng.integers(0, 800, 60), rng.integers(0, len(text) - 106, 60)
    at[:20], lo[:20] = 320 + np.arange(20), 200 + np.arange(20)              # some that fit
    length = np.where(np.arange(60) % 3, 64, rng.integers(40, 64, 60))
    edits, end = D.align(flat, at, length, text, lo, 106)
    want = [_plain_edits(flat[p:p + m].tolist(), text[x:x + 106].tolist()) for p, m, x in zip(at, length, lo)]
    assert list(zip(edits.tolist(), end.tolist())) == want and want[1][0] == 0


def _edited(passage, edits, rng):
    t = list(passage)
    for at in rng.sample(range(len(t)), edits):
        t[at] = rng.choice([c for c in "abcdefghijklmnopqrstuvwxyz" if c != t[at]])
    return "".join(t)


def test_random_edits_in_a_passage_of_one_segment():
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = ["".join(rng.choice(letters) for _ in range(200)) for _ in range(20)]
    index = D.Index(list(enumerate(items)))

    def caught(edits):
        n = 0
        for _ in range(400):
            k, at = rng.randrange(20), rng.randrange(137)
            n += k in D.find("".join(rng.choice(letters) for _ in range(99)) + _edited(items[k][at:at + 64], edits, rng) + "0" * 99, index)
        return n / 400

    assert caught(0) == caught(4) == caught(7) == 1.0                        # by the lemma
    assert caught(10) >= 0.97
    assert caught(30) <= 0.01


def test_found_segments_against_every_alignment():
    """Every (text, item) with a segment of at most 7 edits is found, none without one of at most 10."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([3, 5, 7]))) for _ in range(60)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(16)) for _ in range(4)]
    index = D.Index(list(enumerate(items)))
    for k in range(12):
        item = items[k % 4]
        text = " ".join(rng.choice(vocabulary) for _ in range(12)) + " " + _edited(item[5:75], 3 * (k // 4) + k % 3, rng)
        got = D.find(text, index)
        for j, t in enumerate(items):
            code, seg = D.compared(text).tolist(), D.compared(t)
            least = min(_plain_edits(seg[p:p + 64].tolist(), code)[0] for p in range(0, len(seg) - 63))
            assert (j in got) or least > 7
            assert (j not in got) or least <= got[j][1] <= 10


def test_items_that_share_a_prompt_are_aligned_once():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    prompt = "".join(rng.choice(letters) for _ in range(64))
    items = [prompt + "".join(rng.choice(letters) for _ in range(60)) for _ in range(3000)]
    index = D.Index(list(enumerate(items)))
    got = D.find("x" * 50 + prompt + "y" * 90, index)
    assert len(got) == 3000 and all(v[1] == 0 for v in got.values())
    repeated = D.Index([(1, "la " * 60), (2, items[0])])                     # a syllable over and over
    assert list(D.find("la " * 3000, repeated)) == [0]


def test_pieces_are_halved_where_many_places_are_shared(monkeypatch):
    rng = random.Random(6)
    item = "".join(rng.choice("abc ") for _ in range(300))
    index = D.Index([(1, item)])
    text = " ".join("".join(rng.choice("abc ") for _ in range(900)) + item[k * 20:k * 20 + 100] for k in range(8))
    want = D.find(text, index)
    monkeypatch.setattr(D, "HITS", 50)
    got = D.find(text, index)
    assert list(got) == list(want) == [0] and got[0][1:] == want[0][1:]


def test_passages_are_found_at_any_offset_and_with_replaced_words():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice([2, 4, 6, 8]))) for _ in range(500)]
    items = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(5)]
    index = D.Index(list(enumerate(items)))
    for k, t in enumerate(items):
        for s in range(len(t) - 64 + 1):
            if t[s] != " " and t[s + 63] != " ":
                assert k in D.find("q7 " + t[s:s + 64] + " q8", index), s
        w = t.split()
        w[4::8] = [rng.choice(words) for _ in w[4::8]]
        assert k in D.find(" ".join(w), index)
        assert not D.find(t[:32] + " q7 q8 " + t[-32:], index)
    far = "x " * 40000 + items[2]                                            # across pieces of a long text
    assert list(D.find(far, index)) == [2] and D.find(far, index)[2][3] == len(far)


def test_short_items_match_whole_words():
    index = D.Index([(1, "Who are you?"), (2, "who"), (3, "are you ok"), (4, "?!")])
    found = {index.items[k] for k in D.find("And: WHO are you, then", index)}
    assert found == {1, 2}
    assert not D.find("whoare youok", index) and not D.find("", index)


def test_decontamination_edges(spark, make_docs):
    long = "this is one sentence of a benchmark item that is long enough to be used here"
    bench = spark.createDataFrame([(1, long), (1, long), (2, None), (3, "short"), (None, "")], "item_id long, text string")
    docs = make_docs([(1, "x " + long), (1, "x " + long), (2, None), (3, ""), (None, long), (5, "y " * 50000 + long)]).withColumn("edits", F.lit(0))
    got = [(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(1, 1)] * 4 + [(None, 1)] * 2 + [(5, 1)] * 2, key=str)
    assert sorted(r["doc_id"] for r in D.clean(docs, bench).collect()) == [2, 3]
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(docs, none).count() == 0 and D.clean(docs, none).count() == 6
    assert D.contaminated(make_docs([]), bench).count() == 0


# -- LM ---------------------------------------------------------------------

def _tiny():
    rng = np.random.default_rng(0)
    m = A.Model(rng.integers(1, 50, A.SYMBOLS).astype(float))
    m.bias = A.Bias(rng.random((A.BOS + 1, A.HEAD + 1)))
    for name in ("wc", "wi", "rel", "bc"):
        w = getattr(m.weights, name)
        w[...] = rng.normal(0, 0.3, w.shape)
    return m, rng


def test_attention_gradient_by_differences():
    m, rng = _tiny()
    x, y = rng.integers(0, A.BOS + 1, (4, A.WINDOW)), rng.integers(0, A.HEAD + 1, (4, A.HALF))
    use = rng.random((4, A.HALF)) < 0.8
    g = A.gradient(m.weights, m.bias, x, y, use)

    def loss():
        return -(A.log_probs(m.weights, m.bias, x, y) * use).sum() / use.sum()

    for name in A.Weights.SHAPES:
        p, d = getattr(m.weights, name).reshape(-1), getattr(g, name).reshape(-1)
        i = int(np.abs(d).argmax())
        old = p[i]
        p[i] = old + 1e-2
        up = loss()
        p[i] = old - 1e-2
        down = loss()
        p[i] = old
        assert abs((up - down) / 2e-2 - d[i]) < 0.05 * abs(d[i]) + 2e-4, name


def test_attention_probabilities_sum_to_one_and_windows_score_once():
    m, rng = _tiny()
    x = np.repeat(rng.integers(0, A.BOS + 1, (1, A.WINDOW)), A.HEAD + 1, axis=0)
    y = np.repeat(np.arange(A.HEAD + 1)[:, None], A.HALF, axis=1)
    total = np.exp(A.log_probs(m.weights, m.bias, x, y).astype(float)).sum(0)
    assert np.allclose(total, 1, atol=1e-3)
    tail = m.tail[m.row_of > A.HEAD]
    assert abs(np.exp(tail.astype(float)).sum() - 1) < 1e-3
    streams = [np.concatenate((np.full(A.HALF + 1, A.BOS), np.arange(n) % 100)) for n in (1, 16, 17, 40)]
    _, y, use, at = A.windows(streams)
    assert [int(use[at == i].sum()) for i in range(4)] == [1, 16, 17, 40]
    assert y[at == 3][use[at == 3]].tolist() == [k % 100 for k in range(40)]


def test_attention_trains_on_every_symbol_of_every_text(make_docs, monkeypatch):
    texts = ["a short text", None, "one more " * 200, ""] + [f"text number {i}" for i in range(20)]
    trained, real = [], A.train
    monkeypatch.setattr(A, "train", lambda docs, model, *rest: trained.append((real(docs, model, *rest), model)))
    A.score(make_docs(list(enumerate(texts))), F.lit(True), tokenizer_path())
    table = A.Symbols(tokenizer_path())
    (n, model), = trained
    assert n == sum(len(table.of((t or "").encode().split())) + 1 for t in texts)
    assert (model.weights.flat != A.Weights.start().flat).any()


def test_attention_gradient_and_large_logits():
    m, rng = _tiny()
    x, y = rng.integers(0, A.BOS + 1, (8, A.WINDOW)), rng.integers(0, A.HEAD + 1, (8, A.HALF))
    use, into = np.ones(y.shape, bool), A.Weights(np.full(m.weights.flat.size, 7.0))
    plain = A.gradient(m.weights, m.bias, x, y, use)
    assert A.gradient(m.weights, m.bias, x, y, use, into) is into and np.array_equal(into.flat, plain.flat)    # all parts are set
    m.weights.bc[...] += 500                                   # the same for all classes: no softmax changes
    assert np.allclose(A.gradient(m.weights, m.bias, x, y, use).flat, plain.flat, atol=1e-4)
    m.weights.bc[...] -= 1000
    assert np.allclose(A.gradient(m.weights, m.bias, x, y, use).flat, plain.flat, atol=1e-4)


def test_attention_tokenises_a_word_once(monkeypatch):
    texts = ["The cat, the dog the end", None, "", "zork \u00e9t\u00e9 zork", "x" * 300 + " the", "\t \n"] * 3
    ws = [[*(t or "").lower().encode().split()] for t in texts]
    m, _ = _tiny()
    hashes = [xxhash.xxh3_64_intdigest(w) for w in (b"the", b"zork")]
    order = np.argsort(np.array(hashes, np.uint64))
    known = np.array(hashes, np.uint64)[order], np.array([5, 2])[order]
    lexicon, asked, real = A.Lexicon(tokenizer_path(), m, known), [], A.Symbols.__missing__
    monkeypatch.setattr(A.Symbols, "__missing__", lambda self, w: asked.append(w) or real(self, w))
    parts = [lexicon.encode(texts[:7]), lexicon.encode(texts[7:])]
    assert sorted(asked) == sorted({w for x in ws for w in x})
    got = {k: [v for p in parts for v in (p[k].to_pylist() if hasattr(p[k], "to_pylist") else p[k].tolist())] for k in parts[0]}
    table = A.Symbols(tokenizer_path())
    log = {b"the": np.log10(5.1), b"zork": np.log10(2.1)}
    for k, x in enumerate(ws):
        s = np.append(table.of(x), A.END)
        assert np.frombuffer(got["rows"][k], "<u2").tolist() == m.row_of[s].tolist()
        assert np.isclose(got["tail"][k], m.tail[s].sum(dtype=float)) and got["n_tokens"][k] == len(x) + 1
        assert got["n_often"][k] == sum(w in log for w in x) and np.isclose(got["often"][k], sum(log.get(w, 0) for w in x))
        assert got["rare"][k] == [np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64) for w in x if w not in log]
    lexicon.LIMIT = 0                                          # forgets all words, with the same result
    again = lexicon.encode(texts[:7])
    assert all(again[k].equals(parts[0][k]) if hasattr(again[k], "equals") else np.allclose(again[k], parts[0][k]) for k in again)


def test_lm_base_by_brute_force_and_edges(spark, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SMOKE, "documents").collect()][:60]
    rows += [(5000, None), (5001, ""), (5001, "\t"), (None, "Zork zork the")]
    docs = make_docs(rows)
    got = A.score(docs, ~held_out("doc_id", 10, 0), tokenizer_path()).collect()
    assert len(got) == len(rows)
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    from collections import Counter
    c = Counter(w for t in train for w in (t or "").encode().lower().split())
    n, v = sum(c.values()) + len(train), len(c) + 1
    want = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        base = sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) + np.log10((len(train) + 0.1) / (n + 0.1 * (v + 1)))
        want.append((str(i), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6)))
    have = [(str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(have) == sorted(want)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    empty = A.score(make_docs([]), ~held_out("doc_id", 10, 0), tokenizer_path())
    assert empty.count() == 0
    alone = A.score(make_docs([(10, "a b")]), F.lit(False), tokenizer_path()).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["score"] < 0


# -- plain versions of language ID and toxicity -----------------------------

def _plain_mixture(text, table):
    """Expectation-maximisation word by word, every set size, without arrays."""
    import re as r
    words = r.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return None
    likes = []
    for w in words:
        slot, starts, _ = L.trigrams([w])
        x = [float(sum(np.float64(table[s, k]) for s in slot)) for k in range(table.shape[1])]
        likes.append([math.exp(v - max(x)) for v in x])

    def em(pi, rounds):
        for _ in range(rounds):
            total = [0.0] * len(pi)
            for like in likes:
                z = sum(a * b for a, b in zip(like, pi)) + 1e-30
                total = [t + a * b / z for t, a, b in zip(total, like, pi)]
            pi = [t / len(likes) for t in total]
        return pi

    n = table.shape[1]
    full = em([1.0 / n] * n, L.ROUNDS)
    order = sorted(range(n), key=lambda k: -full[k])
    best, best_fit = None, -math.inf
    for k in range(1, n + 1):
        pi = [full[j] + 1e-6 if j in order[:k] else 0.0 for j in range(n)]
        pi = [v / sum(pi) for v in pi]
        if 1 < k < n:
            pi = em(pi, L.ROUNDS)
        fit = sum(math.log(sum(a * b for a, b in zip(like, pi)) + 1e-30) for like in likes)
        fit -= L.PENALTY * (k - 1) * math.log(len(likes) + 1)
        if fit > best_fit:
            best, best_fit = pi, fit
    return best


def _mixture_model(n_lang=6, seed=2):
    rng = np.random.default_rng(seed)
    return L.Model([f"l{k}" for k in range(n_lang)], np.log(rng.dirichlet(np.full(1 << L.BITS, 0.02), n_lang).T + 1e-9).astype(np.float32))


def _mixture_texts(rng):
    words = ["".join(rng.choices("abcdefgéß", k=rng.randint(1, 7))) for _ in range(80)]
    return [None, "", "12 !", "a"] + [" ".join(rng.choices(words[:k], k=n)) for k, n in ((5, 30), (20, 7), (80, 60), (80, 200), (3, 2), (40, 25))]


def test_mixtures_against_a_plain_version():
    model, texts = _mixture_model(), _mixture_texts(random.Random(3))
    got = L.mixtures(texts, model)
    for text, shares in zip(texts, got):
        want = _plain_mixture(text, model.table)
        assert shares.sum() == 0 if want is None else shares == pytest.approx(want, abs=1e-4)


def test_mixtures_do_not_depend_on_pieces_or_neighbours(monkeypatch):
    model, texts = _mixture_model(), _mixture_texts(random.Random(4))
    whole = L.mixtures(texts, model)
    alone = np.concatenate([L.mixtures([t], model) for t in texts])
    monkeypatch.setattr(L, "PIECE", 11)
    monkeypatch.setattr(L, "GATHER", 7)
    pieces = L.mixtures(texts, model)
    assert whole == pytest.approx(alone, abs=1e-6) and whole == pytest.approx(pieces, abs=1e-6)


def test_language_of_a_very_long_text_needs_little_memory():
    import tracemalloc
    text = " ".join(_mixture_texts(random.Random(5))[-3:]) * 40_000           # some 30 MB
    model = _mixture_model()
    tracemalloc.start()
    shares = L.mixtures([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shares.sum() == pytest.approx(1.0) and peak < 120 << 20


def test_clause_features_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(6)
    words = X.SEED_INSULTS + X.THREATS + X.TARGETS + X.NEGATIONS + X.REPORTS + ["house", "Tree", "it's"]
    text = " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "!", "\n", ";"]) for _ in range(800))
    tagger = X.Tagger({w: 0.5 for w in X.SEED_INSULTS}, {})
    whole = X.clause_features(text, tagger)
    monkeypatch.setattr(X, "PIECE", 17)
    assert (X.clause_features(text, tagger) == whole).all() and whole[9] > 0
