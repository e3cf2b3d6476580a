"""Benchmark decontamination by the q-gram lemma.

A text is contaminated by a benchmark item when it holds a segment of the
item: ``SEGMENT`` bytes from any place of it (a shorter item as a whole),
with at most ``EDITS`` of its bytes edited, about one word.  A text that
holds a segment of ``m`` bytes with at most ``k`` edits shares at least
``m - Q + 1 - k * Q`` q-grams with it on ``k + 1`` neighbouring diagonals.
One pass over the documents looks up every q-gram of the whole text among
those of whole items.  Where ``SHARED`` q-grams lie in a diagonal band
within one segment's length, every segment that holds them is retained and
decided by banded alignment.  So no segment with at most
``(m - SHARED - Q + 1) // Q`` edits (7 for 64 bytes) anywhere is missed; with
more, up to ``EDITS``, those that keep ``SHARED`` q-grams are found: all with
a replaced word, 99 % with 10 bytes replaced at random places.

A segment that starts one byte further differs by at most one edit more or
less, so a retained region is searched from its fullest segment, and an
alignment over the budget by ``x`` settles its ``x`` neighbours on both sides.
Segments with equal bytes against the same place of a text are aligned once,
however many items hold them.

Items with fewer than ``MIN_CHARS`` compared bytes are matched whole and
exactly, on word boundaries.

Texts are compared as lower-case UTF-8 bytes with every run of ASCII
characters other than letters and digits as one space; lengths and spans
count these bytes.  Benchmarks larger than ``BLOCK_CHARS``
are taken in blocks, each with its own pass, so what is shipped to the
tasks has a proven size; texts are looked up in pieces of ``PIECE`` bytes
that overlap by more than a segment, in smaller ones where more than ``HITS``
shared q-grams would be held at once.

Defined cases: null and empty texts match nothing, nor do items without a
compared byte; repeated rows of a document match once per row; repeated
item ids are items of their own with one row each; an empty benchmark
matches nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, map_rows, mix64, ship_by_value

ship_by_value(__name__)

Q = 7
SEGMENT = 64
MIN_CHARS = 40            # shorter items: whole and exactly
EDITS = 10 / 64           # edits per byte of a segment
SHARED = 7                # q-grams that a segment must share (a run of 13 bytes)
PIECE, OVERLAP = 1 << 18, 2 * SEGMENT
HITS = 2_000_000          # shared q-grams held at once
ALIGNED = 4096            # segments aligned at once
BLOCK_CHARS = 4_000_000   # benchmark characters of one pass
FILTER_BITS = 20

_SPACED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def compared(text: str) -> np.ndarray:
    """The compared form of a text as bytes."""
    raw = text.lower().encode("utf-8", "replace").translate(_SPACED)
    return np.frombuffer(b" ".join(raw.split()), dtype=np.uint8)


def qgram_hashes(code: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at every place."""
    if len(code) < Q:
        return np.empty(0, dtype=np.uint32)
    c, n = code.astype(np.uint32), len(code) - Q + 1
    h = c[:n].copy()
    for i in range(1, Q):
        h *= np.uint32(0x01000193)
        h += c[i:i + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h


def _segment_classes(flat: np.ndarray) -> np.ndarray:
    """A number for the ``SEGMENT`` bytes from every place; equal bytes, equal number."""
    h, width = np.concatenate([flat, np.zeros(SEGMENT, np.uint8)]).astype(np.uint64) + np.uint64(1), 1
    while width < SEGMENT:                                    # doubling
        h = mix64(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2
    return np.unique(h[:len(flat)], return_inverse=True)[1].astype(np.int64)


class Index:
    """Items of one benchmark block, laid out one after the other, and where
    their q-grams are; short items by their words."""

    def __init__(self, items):
        self.items, codes, at, hashes, places = [], [], 0, [], []
        self.short: dict = {}                                 # compared bytes -> item numbers
        self.sizes: dict = {}                                 # first word -> numbers of words
        self.start, self.number = [], []                      # of the long items
        for item_id, text in items:
            code = compared(text or "")
            if not len(code):
                continue
            k = len(self.items)
            self.items.append(item_id)
            if len(code) < MIN_CHARS:
                whole = code.tobytes()
                self.short.setdefault(whole, []).append(k)
                self.sizes.setdefault(whole.split(b" ")[0], set()).add(whole.count(b" ") + 1)
                continue
            self.start.append(at)
            self.number.append(k)
            codes += [code, np.zeros(SEGMENT, np.uint8)]
            h = qgram_hashes(code)
            hashes.append(h)
            places.append(np.arange(at, at + len(h)))
            at += len(code) + SEGMENT                         # no segment's length reaches the next item
        self.total = at
        self.flat = np.concatenate([*codes, np.zeros(SEGMENT, np.uint8)])
        self.classes = _segment_classes(self.flat[:at])
        self.start = np.array(self.start, np.int64)
        self.length = np.array([len(c) for c in codes[::2]], np.int64)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint32)
        place = np.concatenate(places) if hashes else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.h, self.place = h[order], place[order].astype(np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self.h >> np.uint32(32 - FILTER_BITS)] = True

    def shared(self, h: np.ndarray):
        """(places in the text, first and number of their entries in the index)."""
        at = np.flatnonzero(self.filter[h >> np.uint32(32 - FILTER_BITS)])
        lo = np.searchsorted(self.h, h[at], side="left")
        n = np.searchsorted(self.h, h[at], side="right") - lo
        some = n > 0
        return at[some], lo[some], n[some]


def align(flat: np.ndarray, at: np.ndarray, length: np.ndarray, text: np.ndarray, lo: np.ndarray, columns: int):
    """(least edits, end) of the segments ``flat[at:at + length]`` (64 bytes at most)
    against any part of ``text[lo:lo + columns]``.  A column of the alignment is the
    bits of a word, set where the edits rise or fall from one byte of the segment to
    the next; all segments go through their windows side by side."""
    edits, ends = [], []
    one = np.uint64(1)
    for x in range(0, len(at), ALIGNED):
        z = slice(x, x + ALIGNED)
        seg = flat[at[z, None] + np.arange(SEGMENT)]
        window = text[lo[z, None] + np.arange(columns)]
        last = (length[z] - 1).astype(np.uint64)
        up, down = np.full(len(seg), ~np.uint64(0)), np.zeros(len(seg), np.uint64)
        now = length[z].astype(np.int64)
        best, end = now.copy(), np.zeros(len(seg), np.int64)
        for j in range(columns):
            same = np.packbits(seg == window[:, j, None], axis=1, bitorder="little").view("<u8")[:, 0]
            diagonal = (((same & up) + up) ^ up) | same
            rise, fall = down | ~(diagonal | up), up & diagonal
            now += ((rise >> last) & one).astype(np.int64) - ((fall >> last) & one).astype(np.int64)
            better = now < best
            best[better], end[better] = now[better], j + 1
            rise, fall, vertical = rise << one, fall << one, same | down
            up, down = fall | ~(vertical | rise), rise & vertical
        edits.append(best)
        ends.append(end)
    return (np.concatenate(edits), np.concatenate(ends)) if edits else (np.empty(0, np.int64),) * 2


def _add(out: dict, item: int, segment: int, edits: int, start: int, end: int) -> None:
    old = out.get(item)
    if old is None:
        out[item] = [{segment}, edits, start, end]
    else:
        old[0].add(segment)
        old[1], old[2], old[3] = min(old[1], edits), min(old[2], start), max(old[3], end)


def _find_short(code: np.ndarray, index: Index, out: dict) -> None:
    """Short items as runs of whole words."""
    ws = code.tobytes().split(b" ")
    at = 0
    for i, w in enumerate(ws):
        for n in index.sizes.get(w, ()):
            whole = b" ".join(ws[i:i + n])
            for item in index.short.get(whole, ()):
                _add(out, item, 0, 0, at, at + len(whole))
        at += len(w) + 1


def _dense(band: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which shared q-grams may lie among ``SHARED`` of two neighbouring bands and
    one segment's length: counted in hashed cells of a band by ``SEGMENT`` places."""
    size = 1 << max(12, int(4 * len(band)).bit_length())
    row = 40_503                                              # cells from one band to the next
    cell = (band * row + pos // SEGMENT) & (size - 1)
    n = np.bincount(cell, minlength=size)
    n += np.roll(n, -row)
    n += np.roll(n, -1)                                       # two bands by two cells, from each cell on
    n = np.maximum(n, np.roll(n, row))
    n = np.maximum(n, np.roll(n, 1))                          # the fullest of those that a cell is in
    return n[cell] >= SHARED


def _regions(keys: np.ndarray, index: Index):
    """(band, item, first and last segment start, fullest segment) where ``SHARED``
    keys, band << 32 | place, lie within one segment's length."""
    span = SEGMENT - Q
    full = np.flatnonzero(keys[SHARED - 1:] - keys[:len(keys) - SHARED + 1] <= span)
    low, high = keys[full + SHARED - 1] - span, keys[full]    # starts of segments that hold them
    new = np.append(True, low[1:] > high[:-1] + 1)            # bands are further apart than that
    at = np.flatnonzero(new)
    held = np.searchsorted(keys, high + span, side="right") - full
    top = np.maximum.reduceat(held << 32 | (high & 0xFFFFFFFF), at) & 0xFFFFFFFF
    band, a, b = high[at] >> 32, low[at], high[np.append(at[1:], len(full)) - 1]
    item = np.searchsorted(index.start, high[at] & 0xFFFFFFFF, side="right") - 1
    origin = index.start[item]
    free = origin + np.maximum(0, index.length[item] - SEGMENT)
    a, b = a - (band << 32), b - (band << 32)
    return band, item, np.clip(a, origin, free), np.clip(b, origin, free), np.clip(top, origin, free)


def _find_pieces(pieces: list, index: Index, out: list) -> None:
    """Segments of long items in pieces of texts, (text, where the piece starts in
    it, bytes), laid out with gaps that no band and no window bridges."""
    gap = np.zeros(OVERLAP, np.uint8)
    code = np.concatenate([x for _, _, c in pieces for x in (c, gap)])
    starts = np.cumsum([0] + [len(c) + OVERLAP for _, _, c in pieces[:-1]])
    at, lo, n = index.shared(qgram_hashes(code))
    total = int(n.sum())
    if total < SHARED:
        return
    if total > HITS and (len(pieces) > 1 or len(code) > 5 * OVERLAP):
        if len(pieces) == 1:
            t, base, c = pieces[0]
            half = len(c) // 2
            pieces = [(t, base, c[:half + OVERLAP]), (t, base + half, c[half:])]
        _find_pieces(pieces[:len(pieces) // 2], index, out)
        _find_pieces(pieces[len(pieces) // 2:], index, out)
        return
    place, pos = np.repeat(at, n), index.place[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(total)]
    k_max = int(EDITS * SEGMENT)
    # overlapping bands of diagonals, half a band apart: any k + 1 neighbours share one
    band = (place - pos + index.total) // (k_max + 1) + 1     # > 0
    near = _dense(band, pos)
    band, pos = band[near], pos[near]
    keys = np.sort(np.concatenate((band << 32 | pos, (band - 1) << 32 | pos)))
    keys = keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]
    if len(keys) < SHARED or not (keys[SHARED - 1:] - keys[:len(keys) - SHARED + 1] <= SEGMENT - Q).any():
        return
    band, item, a, b, p = _regions(keys, index)
    margin = 4 * SEGMENT
    text = np.concatenate([np.zeros(margin, np.uint8), code, np.zeros(margin, np.uint8)])
    columns = SEGMENT + 2 * (k_max + 1) + 2 * k_max

    def edits(r, p):
        """Edits, budget, length and end in the layout of the segments at ``p`` in the regions ``r``."""
        length = np.minimum(index.length[item[r]], SEGMENT)
        first = (band[r] - 1) * (k_max + 1) - index.total + p                 # of the band's first diagonal
        left = np.clip(first - k_max + margin, 0, len(text) - columns)
        which = np.unique(index.classes[p] * len(text) + left, return_index=True, return_inverse=True)
        got, end = align(index.flat, p[which[1]], length[which[1]], text, left[which[1]], columns)
        return got[which[2]], (EDITS * length).astype(np.int64), length, left + end[which[2]] - margin

    def found(r, p, e, length, end):
        where = np.searchsorted(starts, end - 1, side="right") - 1
        for w, j, q, x, m, z in zip(where.tolist(), item[r].tolist(), p.tolist(), e.tolist(), length.tolist(), (end - starts[where]).tolist()):
            t, base, c = pieces[w]
            z = base + min(z, len(c))
            _add(out[t], index.number[j], q - int(index.start[j]), x, max(0, z - m), z)

    r = np.arange(len(band))
    lo, hi = a, b                                             # starts that are still open
    while len(r):
        e, k, length, end = edits(r, p)
        ok = e <= k
        found(r[ok], p[ok], e[ok], length[ok], end[ok])
        if ok.any():                                          # where the found region begins and ends
            ends = np.concatenate((r[ok], r[ok])), np.concatenate((a[r[ok]], b[r[ok]]))
            e2, k2, length2, end2 = edits(*ends)
            also = e2 <= k2
            found(ends[0][also], ends[1][also], e2[also], length2[also], end2[also])
        r, p, lo, hi, over = r[~ok], p[~ok], lo[~ok], hi[~ok], (e - k)[~ok]
        r, lo, hi = np.concatenate((r, r)), np.concatenate((lo, p + over)), np.concatenate((p - over, hi))
        some = lo <= hi
        r, lo, hi = r[some], lo[some], hi[some]
        p = (lo + hi) // 2


def find_all(texts: list, index: Index) -> list[dict]:
    """{item number: (segments found, least edits, start, end)} over each whole text."""
    out: list[dict] = [{} for _ in texts]
    if not index.items:
        return out
    pieces, size = [], 0
    for k, text in enumerate(texts):
        code = compared(text) if text else ()
        if index.short and len(code):
            _find_short(code, index, out[k])
        if len(code) < Q or not len(index.h):
            continue
        for base in range(0, max(1, len(code) - OVERLAP), PIECE - OVERLAP):
            piece = code[base:base + PIECE]
            if pieces and size + len(piece) > PIECE:
                _find_pieces(pieces, index, out)
                pieces, size = [], 0
            pieces.append((k, base, piece))
            size += len(piece)
    if pieces:
        _find_pieces(pieces, index, out)
    return out


def find(text: str | None, index: Index) -> dict:
    """``find_all`` of one text."""
    return find_all([text], index)[0]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark as lists of (id, text) of bounded size."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where("t IS NOT NULL")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for k in range(n):
        yield [(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, segments, edits, span_start, span_end): one row for every
    document and benchmark item of which it holds a segment."""
    schema = T.StructType([
        docs.select(F.col(f"`{id_col}`")).schema[0], benchmark.select(F.col(f"`{item_col}`")).schema[0],
        T.StructField("segments", T.IntegerType()), T.StructField("edits", T.IntegerType()),
        T.StructField("span_start", T.LongType()), T.StructField("span_end", T.LongType())])
    src = docs.select(F.col(f"`{text_col}`").alias("__text"), F.col(f"`{id_col}`"))
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text):
        index = Index(items)

        def rows(part, index=index):
            found = [(i, index.items[k], len(v[0]), *v[1:])
                     for i, got in zip(part.column(1).to_pylist(), find_all(part.column(0).to_pylist(), index))
                     for k, v in sorted(got.items())]
            if found:
                yield dict(zip(schema.names, zip(*found)))

        out = out.unionByName(map_rows(src, schema, rows))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark segment (all its columns
    stay; decided row by row, without a join)."""
    for items in _blocks(benchmark, item_col, item_text):
        index = Index(items)
        docs = keep_rows(docs, text_col, lambda texts, index=index: [not got for got in find_all(texts, index)])
    return docs
