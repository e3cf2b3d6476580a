"""Language ID by mixture inference.

A document is a mixture of languages: every word comes from one of them,
with the likelihood of the word's letter trigrams.  Expectation-
maximisation estimates the document's language proportions; the set of
languages is the one with the best penalised likelihood (each language
beyond the first costs ``PENALTY * log(words + 1)``).  Every size of the set
is tried until the text's own likelihood bound says that no larger one can
win.  The prediction is the language with the largest share, the score is
that share.

Trigram counts cover all training rows; they are summed in fixed-size
hashed tables (``1 << BITS`` counters a language), so the model has a
proven size whatever the corpus.

Defined cases: a null text and a text without a letter give ``und`` with
score 0 and no languages; very long texts are read whole in parts of
``PIECE`` characters and need the memory of their distinct words; rows with null text or language are not learned
from; with no training row every text is ``und``; equal shares take the
alphabetically first language; repeated and null ids are predicted row by
row; columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, keep_rows, ship_by_value, slices

ship_by_value(__name__)

BITS = 16
PENALTY = 2.0
ROUNDS = 8
SMOOTH = 0.5
UNDETERMINED = "und"

_LETTERS = None


def _letters() -> np.ndarray:
    """Is a code point a letter (built once per process)."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


PIECE = 1 << 20             # characters handled at once of a longer text
GATHER = 1 << 21            # likelihoods laid out at once, trigrams x languages


def trigrams(texts: list):
    """Hashed letter trigrams of all words of ``texts`` (words padded by one
    boundary on both sides): trigram slots, start of every word in them,
    and the text that every word belongs to."""
    joined = "\n".join((t or "").lower() for t in texts)
    code = np.frombuffer(("\n" + joined + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[code]
    c = np.where(letter, code, 0).astype(np.uint32)
    # a trigram for every letter: (before, it, after)
    at = np.flatnonzero(letter)
    mul1, mul2, mul3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
    h = c[at - 1] * mul1 + c[at] * mul2 + c[at + 1] * mul3
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    slot = (h >> np.uint32(32 - BITS)).astype(np.int32)
    first = ~letter[at - 1]
    starts = np.flatnonzero(first)
    # lower-casing may change lengths: texts are told apart by their ends in the joined string
    ends = np.cumsum([len((t or "").lower()) + 1 for t in texts])
    owner = np.searchsorted(ends, at[starts] - 1, side="right")
    return slot, starts, owner


def _pieces(texts: list):
    """``texts`` in lists of (number, text) of at most ``PIECE`` characters; a longer
    text comes in parts that end between two words, so a part is only longer
    when a word is."""
    held, size = [], 0
    for k, text in enumerate(texts):
        at, text = 0, text or ""
        while True:
            stop = at + PIECE
            while stop < len(text) and text[stop].isalpha():
                stop += 1
            part = text[at:stop] if at or stop < len(text) else text
            if held and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((k, part))
            size += len(part)
            at = stop
            if at >= len(text):
                break
    if held:
        yield held


def _distinct(slot, starts, owner):
    """The distinct words of every text: (text, 64-bit name of the word), how often
    they occur, and where one occurrence starts."""
    length = np.diff(np.append(starts, len(slot)))
    place = np.arange(len(slot)) - np.repeat(starts, length)
    power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    name = np.add.reduceat((slot.astype(np.uint64) + np.uint64(1)) * power[place], starts)
    order = np.lexsort((name, owner))
    o, n = owner[order], name[order]
    new = np.append(True, (o[1:] != o[:-1]) | (n[1:] != n[:-1]))
    first = np.flatnonzero(new)
    return o[first], n[first], np.diff(np.append(first, len(order))), starts[order[first]], length[order[first]]


def word_likelihoods(texts: list, table: np.ndarray):
    """(text, times, log-likelihoods [words, languages]) of the distinct words of
    every text, by text.  Pieces of a long text add up, so what is held grows
    with its distinct words."""
    parts: dict = {}                                                  # text -> [names, times, likelihoods] of its parts
    for piece in _pieces(texts):
        slot, starts, owner = trigrams([t for _, t in piece])
        if not len(starts):
            continue
        text, name, times, begin, length = _distinct(slot, starts, owner)
        like = np.empty((len(name), table.shape[1]), dtype=np.float32)
        step = max(1, GATHER // max(1, table.shape[1]))
        cuts = np.searchsorted(np.cumsum(length), np.arange(step, int(length.sum()) + step, step))
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(name))):
            if lo < hi:
                begins = np.cumsum(length[lo:hi]) - length[lo:hi]
                at = np.repeat(begin[lo:hi] - begins, length[lo:hi]) + np.arange(length[lo:hi].sum())
                like[lo:hi] = np.add.reduceat(table[slot[at]], begins, axis=0)
        number = np.array([k for k, _ in piece])[text]
        for k in np.unique(number):
            z = slice(*np.searchsorted(number, (k, k + 1)))
            new = name[z], times[z], like[z]
            if k in parts:
                names, which = np.unique(np.concatenate((parts[k][0], new[0])), return_inverse=True)
                _, one = np.unique(which, return_index=True)
                new = names, np.bincount(which, np.concatenate((parts[k][1], new[1]))).astype(np.int64), np.concatenate((parts[k][2], new[2]))[one]
            parts[k] = new
    if not parts:
        return np.empty(0, np.int64), np.empty(0), np.empty((0, table.shape[1]), np.float32)
    keys = sorted(parts)
    return (np.repeat(keys, [len(parts[k][0]) for k in keys]), np.concatenate([parts[k][1] for k in keys]).astype(float),
            np.concatenate([parts[k][2] for k in keys]))


class Model:
    def __init__(self, languages: list, table: np.ndarray):
        self.languages, self.table = languages, table  # table: log-likelihood [1 << BITS, languages]


def fit(docs: DataFrame, usable=None, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram likelihoods of every language over all usable rows."""
    rows = docs if usable is None else docs.where(usable)
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    schema = pa.schema([("lang", pa.string()), ("counts", pa.binary())])
    spark_schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("counts", T.BinaryType())])

    def emit(sums):
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()),
                                              pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary())],
                                             schema=schema)

    def count(batches):
        sums: dict = {}
        for batch in batches:
            for part in slices(batch):
                texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
                for piece in _pieces(texts):
                    slot, starts, owner = trigrams([t for _, t in piece])
                    name_of = [langs[k] for k, _ in piece]
                    for name in sorted(set(name_of)):
                        mine = np.array([x == name for x in name_of])[owner]
                        of = np.repeat(mine, np.diff(np.append(starts, len(slot))))
                        sums[name] = sums.get(name, 0) + np.bincount(slot[of], minlength=1 << BITS)
        yield from emit(sums)

    def add(batches):
        sums: dict = {}
        for b in batches:
            for name, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[name] = sums.get(name, 0) + np.frombuffer(v, "<i8")
        yield from emit(sums)

    partial = rows.mapInArrow(count, spark_schema)
    # a few adders share a language, the driver adds their rows: languages x 4 tables of fixed size
    total = partial.repartition(16, "lang", F.pmod(F.xxhash64("counts"), F.lit(4))).mapInArrow(add, spark_schema)
    sums: dict = {}
    for r in total.toLocalIterator():
        sums[r["lang"]] = sums.get(r["lang"], 0) + np.frombuffer(r["counts"], "<i8")
    languages = sorted(sums)
    counts = np.array([sums[x] for x in languages], dtype=float).reshape(len(languages), 1 << BITS)
    p = np.log((counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * (1 << BITS)))
    return Model(languages, np.ascontiguousarray(p.T, dtype=np.float32))


def _best_set(like: np.ndarray, times: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares [texts, languages] of the set with the best penalised likelihood.
    ``like`` and ``times`` are by word, words of text i start at ``at[i]``."""
    n = np.add.reduceat(times, at)
    penalty = PENALTY * np.log(n + 1)

    def em(like, times, row, at, n, pi):
        for _ in range(ROUNDS):
            r = like * pi[row]
            r *= (times / (r.sum(axis=1) + 1e-30))[:, None]
            pi = np.add.reduceat(r, at, axis=0) / n[:, None]
        return pi

    def fit_of(like, times, row, at, pi):
        return np.add.reduceat(times * np.log((like * pi[row]).sum(axis=1) + 1e-30), at)

    n_lang = like.shape[1]
    full = em(like, times, row, at, n, np.full((len(at), n_lang), 1.0 / n_lang))
    # the likelihood is concave in the shares: its gradient bounds what any set can reach
    mass = times / ((like * full[row]).sum(axis=1) + 1e-30)
    most = fit_of(like, times, row, at, full) + np.maximum(0.0, np.add.reduceat(like * mass[:, None], at, axis=0).max(axis=1) - n)
    order = np.argsort(-full, axis=1, kind="stable")
    best, best_fit = np.zeros_like(full), np.full(len(at), -np.inf)
    live = np.arange(len(at))
    for k in range(1, n_lang + 1):
        live = live[(most - penalty * (k - 1))[live] > best_fit[live]]   # a text ends by its own bound
        if not len(live):
            break
        chosen = order[live, :k]
        mine = np.zeros(len(at), bool)
        mine[live] = True
        w = np.flatnonzero(mine[row])
        size = np.diff(np.append(at, len(row)))[live]
        where, to = np.repeat(np.arange(len(live)), size), np.cumsum(size) - size
        some, t = np.take_along_axis(like[w], chosen[where], axis=1), times[w]
        pi = np.take_along_axis(full[live], chosen, axis=1) + 1e-6
        pi /= pi.sum(axis=1, keepdims=True)
        if 1 < k < n_lang:
            pi = em(some, t, where, to, n[live], pi)
        got = fit_of(some, t, where, to, pi) - penalty[live] * (k - 1)
        better = got > best_fit[live]
        win = live[better]
        best[win] = 0.0
        best[win[:, None], chosen[better]] = pi[better]
        best_fit[win] = got[better]
    return best


def mixtures(texts: list, model: Model):
    """Shares [texts, languages] of the selected languages (0 elsewhere; all 0
    without a letter)."""
    shares = np.zeros((len(texts), len(model.languages)))
    if not model.languages:
        return shares
    text, times, like = word_likelihoods(texts, model.table)
    if not len(text):
        return shares
    like = np.exp(like - like.max(axis=1, keepdims=True))
    docs, at, row = np.unique(text, return_index=True, return_inverse=True)
    shares[docs] = _best_set(like, times, row, at)
    return shares


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) plus lang_pred, score, and the
    selected languages with their shares."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("languages", T.ArrayType(T.StringType())),
              T.StructField("shares", T.ArrayType(T.DoubleType()))]

    def compute(texts):
        s = mixtures(texts, model)
        out = {"lang_pred": [], "score": [], "languages": [], "shares": []}
        for x in s:
            k = int(x.argmax()) if len(x) else -1
            chosen = [i for i in np.argsort(-x, kind="stable") if x[i] > 0]
            out["lang_pred"].append(model.languages[k] if chosen else UNDETERMINED)
            out["score"].append(min(1.0, float(x[k])) if chosen else 0.0)
            out["languages"].append([model.languages[i] for i in chosen])
            out["shares"].append([float(x[i]) for i in chosen])
        return out

    return append_columns(docs, text_col, fields, compute, keep)


def reject(docs: DataFrame, model: Model, text_col: str = "text", least_share: float = 0.5) -> DataFrame:
    """``docs`` without the rows that have no language, or of which no language
    makes up ``least_share``."""
    return keep_rows(docs, text_col, lambda texts: [x.max(initial=0.0) >= least_share for x in mixtures(texts, model)])
