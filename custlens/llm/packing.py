"""Packing by power-of-two decomposition.

A document's tokens (and the end token) are cut into pieces whose lengths
are powers of two, longest first: full contexts, then the binary digits of
the rest.  Every piece is a sequence of its own, so no sequence crosses
documents and none needs padding; sequences of equal length form a bucket.
The work is one map over the documents without any shuffle.

Texts are split at ASCII white space before tokenisation.  The tokenizer
never joins text across white space, so the ids are those of the whole
text; the ids of a word are remembered for a bounded number of words.

Defined cases: null and empty texts have only the end token; repeated and
null ids are packed row by row; an empty table gives no piece; extra
columns are not carried; sequence ids are unique within one run.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_by_value, slices

ship_by_value(__name__)

CONTEXT = 4096
_PRINTED = re.compile(r"[!-~]*\Z")    # bytes that stand for themselves
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?%$&#*|)\"]*)\Z")


def _byte_letters() -> dict:
    """Byte -> printable character of byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return table


class WordIds(dict):
    """word bytes -> its ids as little-endian uint32 bytes."""

    LIMIT = 1_000_000

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters, self.merge = _byte_letters(), self.tokenizer.model.tokenize
        # lower-case Latin words may go to the merge model directly, if that is what the whole tokenizer does
        probe = "theséntüble"
        self.direct = self._merged(probe) == self._encoded(probe) and self._encoded("the,") == self._encoded("the") + self._encoded(",")

    def _encoded(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _merged(self, word: str) -> bytes:
        text = word if _PRINTED.match(word) else "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.merge(text)]).tobytes()

    def __missing__(self, w: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        word = w.decode("utf-8", "replace")
        plain = _PLAIN.match(word) if self.direct else None
        if plain is None:
            ids = self._encoded(word)
        elif plain[2]:
            ids = self[plain[1].encode()] + self._mark(plain[2])
        else:
            ids = self._merged(word)
        self[w] = ids
        return ids

    def _mark(self, marks: str) -> bytes:
        key = marks.encode()
        got = dict.get(self, key)
        if got is None:
            got = self[key] = self._encoded(marks)
        return got

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text without special tokens."""
        if not text:
            return b""
        raw = text.encode("utf-8", "replace")
        if b"<|" not in raw:      # names of special tokens count as written
            raw = raw.lower()
        return b"".join(map(self.__getitem__, raw.split()))


def pieces(tokens: int, context: int = CONTEXT):
    """(start, length) of the power-of-two pieces of a document."""
    start = 0
    for _ in range(tokens // context):
        yield start, context
        start += context
    rest = tokens % context
    while rest:
        length = 1 << (rest.bit_length() - 1)
        yield start, length
        start += length
        rest -= length


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = 2, context: int = CONTEXT) -> DataFrame:
    """(id_col, start, length, ids, doc_tokens, sequence_id, offset, bucket): one
    row per piece; ``ids`` are little-endian uint32 bytes, ``bucket`` is
    log2(length)."""
    schema = T.StructType([
        docs.select(F.col(f"`{id_col}`")).schema[0], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])
    cache = None
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        nonlocal cache
        if cache is None:
            cache = WordIds(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                row, start, length, ids, total = [], [], [], [], []
                for k, text in enumerate(part.column(0).to_pylist()):
                    raw = cache.ids(text) + end
                    n = len(raw) // 4
                    for s, m in pieces(n, context):
                        row.append(k)
                        start.append(s)
                        length.append(m)
                        ids.append(raw[4 * s:4 * (s + m)])
                        total.append(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    names=[id_col, "start", "length", "ids", "doc_tokens"])

    out = docs.select(F.col(f"`{text_col}`").alias("__text"), F.col(f"`{id_col}`")).mapInArrow(run, schema)
    return out.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                      F.log2(F.col("length")).cast("int").alias("bucket"))


def write_buckets(packed: DataFrame, folder: str) -> None:
    """Write the sequences as Parquet, one sub-folder per length."""
    packed.write.partitionBy("bucket").parquet(folder)
