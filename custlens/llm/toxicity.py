"""Toxicity scoring with a weighted finite-state pattern grammar.

Letter transducers for reported speech, negation, target and retroactive
target are composed into one machine that runs over the word classes of
a clause.  It rewrites an insult or threat word by its context (aimed at
someone, denied, quoted, plain) and weights it; a document's score is a
logistic function of the weights of its matched clauses.  Isolated words
have no weight outside the clause that the machine accepted.

The insult lexicon (whole words and word stems with log-odds weights) and
the logistic weights are learned from labelled rows: from all of them up to
``FIT_ROWS``, beyond that from a hash sample of about that many.  Support
of a lexicon entry counts distinct neighbour pairs, so a word that copies
of one text repeat counts once.

Defined cases: null, empty and word-free texts get the score of a document
without any match; with no labels the seed words and the prior weights
serve; very long texts are read whole, in parts that end with a clause; a
document labelled twice takes the larger label; repeated and
null ids are scored row by row; columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, cut_lineage, keep_rows, map_rows, ship_by_value

ship_by_value(__name__)

FIT_ROWS = 20_000       # labelled rows that the lexicon and the weights are fitted on, about
MIN_CONTEXTS = 8        # distinct neighbour pairs that a lexicon entry needs
MIN_LOG_ODDS = 3.0
STEMS = (4, 5, 6, 7, 8)       # lengths of the word stems that may enter the lexicon

# Fixed word lists of the grammar (English, German, French, Spanish).
SEED_INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting clown fool imbecile".split()
THREATS = ("kill hurt destroy punch shoot stab beat murder burn attack töten schlagen zerstören umbringen "
           "tuer frapper détruire brûler matar golpear destruir quemar").split()
TARGETS = ("you your yours yourself he him she her they them their these those everyone "
           "du dich dir ihr euch sie tu toi te vous ils elles tú ti usted ustedes ellos ellas vosotros").split()
NEGATIONS = "not no never none nobody nothing without isn't aren't nicht kein keine nie pas jamais sans nunca jamás ningún sin".split()
REPORTS = ("said says say quoted quote wrote writes claimed claims called reported according "
           "sagte sagt schrieb laut dit disait écrit selon dijo dice escribió según").split()

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:|\n]")
ENDS = frozenset(".!?;:|\n")
CLAUSE_END = re.compile(r"[.!?;:|\n]")
PIECE = 1 << 18         # characters of a text whose tokens are held at once
CONTEXTS = 200_000      # feature contexts that a task holds before it sends them on

# Word classes: O other, I insult, T threat, Y target, N negation, R report.
# Written by the transducers: J/U insult/threat aimed at someone, i/t denied
# insult/threat, q quoted, K a target right after an insult.


class Transducer:
    """Letter transducer: ``step(state, symbol) -> (state, symbol)``."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def compose(self, other: "Transducer") -> "Transducer":
        def step(state, x):
            a, y = self.step(state[0], x)
            b, z = other.step(state[1], y)
            return (a, b), z
        return Transducer((self.start, other.start), step)

    def compile(self, alphabet):
        """States reachable from the start as one transition table."""
        number, todo, table = {self.start: 0}, [self.start], {}
        while todo:
            s = todo.pop()
            for x in alphabet:
                n, y = self.step(s, x)
                if n not in number:
                    number[n] = len(number)
                    todo.append(n)
                table[number[s], x] = (number[n], y)
        return table


def _reported(state, x):
    if x == "R":
        return 1, x
    return state, "q" if state and x in "IT" else x


def _negated(state, x):
    if x == "N":
        return 3, x
    return max(state - 1, 0), {"I": "i", "T": "t"}.get(x, x) if state else x


def _aimed(state, x):
    if x == "Y":
        return 4, x
    return max(state - 1, 0), {"I": "J", "T": "U"}.get(x, x) if state else x


def _aimed_after(state, x):
    if x in "IT":
        return 2, x
    return max(state - 1, 0), "K" if state and x == "Y" else x


GRAMMAR = Transducer(0, _reported).compose(Transducer(0, _negated)).compose(
    Transducer(0, _aimed)).compose(Transducer(0, _aimed_after)).compile("OITYNR")
CLASSES = "JIUTKitq"
PRIOR = np.array([-4.0, 3.0, 2.4, 1.6, 0.3, 0.5, 0.3, 0.0, 0.4, 1.0, 0.0])  # bias, classes, clauses, rate


class Tagger(dict):
    """word -> (class, weight), learned entries before the fixed lists."""

    LIMIT = 100_000

    def __init__(self, whole: dict, stems: dict):
        super().__init__()
        self.whole, self.stems = whole, stems
        self.fixed = {w: c for c, ws in (("R", REPORTS), ("N", NEGATIONS), ("Y", TARGETS), ("T", THREATS)) for w in ws}

    def __missing__(self, w):
        if len(self) >= self.LIMIT:
            self.clear()
        weight = max([self.whole.get(w, 0.0), *(self.stems.get(w[:k], 0.0) for k in STEMS if len(w) >= k)])
        tag = ("I", weight) if weight > 0 else (self.fixed.get(w, "O"), 1.0)
        self[w] = tag
        return tag


def _clauses(text: str):
    """Tokens of ``text`` in parts of about ``PIECE`` characters that end with a clause."""
    at = 0
    while at < len(text):
        end = CLAUSE_END.search(text, at + PIECE) if at + PIECE < len(text) else None
        stop = end.end() if end else len(text)
        yield TOKEN.findall(text[at:stop].lower())
        at = stop


def clause_features(text: str | None, tagger: Tagger) -> np.ndarray:
    """Summed weights per class of the matched clauses, number of matched
    clauses, matches per 100 words: one vector per document."""
    out = np.zeros(len(PRIOR))
    out[0] = 1.0
    clauses = n_hits = n_words = 0
    for words in _clauses(text or ""):
        n_words += len(words)
        tags = [tagger[w] for w in words]
        hits = [i for i, t in enumerate(tags) if t[0] in "IT"]
        n_hits += len(hits)
        done = -1
        for i in hits:
            if i <= done:
                continue
            a = i
            while a > 0 and words[a - 1] not in ENDS:
                a -= 1
            b = i
            while b < len(words) and words[b] not in ENDS:
                b += 1
            done, state, matched = b, 0, False
            for j in range(a, b):
                state, y = GRAMMAR[state, tags[j][0]]
                k = CLASSES.find(y)
                if k >= 0:
                    out[1 + k] += tags[j][1]
                    matched = True
            clauses += matched
    if n_hits:
        out[1:9] = np.log1p(out[1:9])
        out[9] = np.log1p(clauses)
        out[10] = min(10.0, 100.0 * n_hits / n_words)
    return out


def _features(word):
    return {word + "$", *(word[:k] for k in STEMS if len(word) >= k)}


def _learn_lexicon(sample: DataFrame):
    """Weights of whole words and stems from (text, toxic) rows."""
    pair = T.StructType([T.StructField("feature", T.StringType()), T.StructField("n", T.LongType())])

    def contexts(part):
        seen = set()
        for t in part.column(0).to_pylist():
            w = [x for x in TOKEN.findall((t or "").lower()) if x not in ENDS]
            for i, x in enumerate(w):
                if len(x) > 3:
                    c = xxhash.xxh3_64_intdigest(" ".join(w[max(0, i - 1):i] + ["_"] + w[i + 1:i + 2]).encode()) >> 1
                    seen.update((f, c) for f in _features(x))
                if len(seen) > CONTEXTS:
                    f, c = zip(*seen)
                    yield {"feature": f, "n": c}
                    seen.clear()
        if seen:
            f, c = zip(*seen)
            yield {"feature": f, "n": c}

    toxic = map_rows(sample.where("toxic = 1").select("text"), pair, contexts)
    support = toxic.distinct().groupBy("feature").count().where(F.col("count") >= MIN_CONTEXTS)
    found = {r["feature"]: r["count"] for r in support.collect()}  # bounded by FIT_ROWS texts
    candidates = frozenset(found)

    def occurrences(part):
        n, total = Counter(), 0
        for t in part.column(0).to_pylist():
            for x in TOKEN.findall((t or "").lower()):
                total += 1
                if len(x) > 3:
                    n.update(_features(x) & candidates)
        n[""] += total
        yield {"feature": list(n), "n": list(n.values())}

    def totals(rows):
        return {r["feature"]: r["n"] for r in
                map_rows(rows.select("text"), pair, occurrences).groupBy("feature").agg(F.sum("n").alias("n")).collect()}

    clean = totals(sample.where("toxic = 0"))
    size_pos = max(1, totals(sample.where("toxic = 1")).get("", 0))
    size_neg = max(1, clean.get("", 0))
    whole, stems = {w: 0.5 for w in SEED_INSULTS}, {}
    for f, n in found.items():
        odds = np.log((n + 0.5) / size_pos) - np.log((clean.get(f, 0) + 0.5) / size_neg)
        if odds >= MIN_LOG_ODDS:
            weight = float(min(odds / 4.0, 2.0))
            if f.endswith("$"):
                whole[f[:-1]] = weight
            else:
                stems[f] = weight
    return whole, stems


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a ridge towards the prior weights."""
    w = PRIOR.copy()
    if not len(y):
        return w
    ridge = np.full(len(w), 1.0)
    ridge[0] = 1e-3
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Lexicon and weights; both are of bounded size."""

    def __init__(self, whole, stems, weights):
        self.whole, self.stems, self.weights = whole, stems, weights


def fit(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learn from the labelled rows; ``usable`` is a condition on ``id_col``."""
    rows = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("toxic"))
    total = rows.count()
    if total > FIT_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(FIT_ROWS / total * (1 << 30)))
    sample = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(rows), "__id").select("text", "toxic")   # about FIT_ROWS ids and labels
    sample = cut_lineage(sample)
    whole, stems = _learn_lexicon(sample)
    fields = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def vectors(part):
        tagger = Tagger(whole, stems)
        yield {"toxic": part.column(1).to_pylist(),
               "x": [clause_features(t, tagger).tolist() for t in part.column(0).to_pylist()]}

    got = map_rows(sample, fields, vectors).collect()        # about FIT_ROWS short vectors
    x = np.array([r["x"] for r in got], dtype=float).reshape(len(got), len(PRIOR))
    return Model(whole, stems, _fit_logistic(x, np.array([r["toxic"] for r in got], dtype=float)))


class Scorer:
    """Texts -> scores; remembers the classes of words within a task."""

    def __init__(self, model: Model):
        self.model, self.tagger = model, None

    def __call__(self, texts):
        if self.tagger is None:
            self.tagger = Tagger(self.model.whole, self.model.stems)
        z = np.array([clause_features(t, self.tagger) @ self.model.weights for t in texts])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) plus score (0 to 1) and
    predicted (score >= 0.5)."""
    scorer = Scorer(model)

    def compute(texts):
        p = scorer(texts)
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return append_columns(docs, text_col, [T.StructField("score", T.DoubleType()),
                                           T.StructField("predicted", T.IntegerType())], compute, keep)


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more."""
    scorer = Scorer(model)
    return keep_rows(docs, text_col, lambda texts: scorer(texts) < 0.5)
