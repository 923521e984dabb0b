"""Concatenate and cut: documents laid end to end and cut into windows of one fixed length.

Pass 1 tokenises and stores, per document, its ids, the partition it was in and the running
total there. The totals of the partitions, one small row each, are summed up in order, which
gives every document its place in one global run of tokens. Pass 2 reads the stored ids and cuts
them at multiples of the window; a piece at a cut is the boundary record of its two windows. No
pass shuffles a text, and only the last window is not full.

Null and empty texts hold the end id alone. Repeated rows are packed as often as they occur. An
empty table gives an empty table, and other columns are not read. A text of any length is one
row; its ids are kept as two bytes each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import stored, table
from wordloom.llm.tokencount import ByteMerges
from wordloom.operators.order import running

WINDOW = 2048
END_ID = 1
BROADCAST = 1_000_000  # partitions (16 bytes each) up to which their offsets are broadcast
MEMORY = 200_000  # words after which a Python worker begins to forget


# White space to `str.split`, but not to the tokeniser.
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Letters that no normal form changes and whose lower case does not depend on neighbours.
_LATIN = re.compile("[!-\u024f]+")


class WordTokenizer:
    """Ids of whole texts as the `tokenizers` library gives them, with late words remembered.

    A file qualifies if its pre-tokeniser splits at white space and none of its rules looks
    across it, so that a text has the ids of its words one after the other. New words in Latin
    letters are merged together as arrays; other words, and texts with a special string or with
    separators on which Python and the library differ, go through the library.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = ByteMerges(path)
        spec = self.merges.spec
        rules = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = [c["type"] for c in spec["pre_tokenizer"].get("pretokenizers", [])]
        if rules != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} cuts texts by other rules")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # Plain words are cut by hand where the pattern cuts them so.
        marks = {c for c in ".,;:!?" if self.pattern.findall("ab" + c) == ["ab", c]}
        self.marks = marks if self.pattern.findall("ab\u00e9\u00dfc") == ["ab\u00e9\u00dfc"] else None
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4"
        self.memory, self.known, self.older = memory, {}, {}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _cut(self, word: str) -> list[str]:
        """The pre-tokens of a lower-case word that is more than letters."""
        if self.marks is not None and word[-1] in self.marks and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def _learn(self, words: list[str]) -> None:
        latin = [w for w in words if (w.isascii() and w.isprintable()) or _LATIN.fullmatch(w)]
        self.known.update((w, self._library(w)) for w in set(words).difference(latin))
        for at in range(0, len(latin), 20_000):
            part = latin[at : at + 20_000]
            cut = [[low] if (low := w.lower()).isalpha() and self.marks is not None else self._cut(low) for w in part]
            ids, sizes = self.merges.merged([p.encode() for c in cut for p in c])
            # From sizes of pre-tokens to the byte range of every word.
            total = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(c) for c in cut]))]
            raw, at_byte = ids.astype(self.kind).tobytes(), (total * np.dtype(self.kind).itemsize).tolist()
            self.known.update((w, raw[a:z]) for w, a, z in zip(part, at_byte, at_byte[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in bytes of the type `kind`."""
        whole = [any(s in t for s in self.merges.special) or _SEPARATORS.search(t) is not None for t in texts]
        words = [[] if w else t.split() for t, w in zip(texts, whole)]
        missing = set().union(*words) - self.known.keys()
        found = missing & self.older.keys()
        self.known.update((w, self.older[w]) for w in found)
        self._learn(list(missing - found))
        get = self.known.__getitem__
        made = [self._library(t) if w else b"".join(map(get, x)) for t, w, x in zip(texts, whole, words)]
        if len(self.known) > self.memory:
            self.older, self.known = self.known if len(self.known) <= 2 * self.memory else {}, {}
        return made


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _groups(texts: list[str], rows: int = 256, characters: int = 2_000_000) -> Iterator[list[str]]:
    """Runs of texts of bounded number and size; a longer text is a run of its own."""
    held, size = [], 0
    for t in texts:
        if held and (len(held) == rows or size + len(t) > characters):
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _tokenise(path: str, end_id: int):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = tokenizer(path), TaskContext.get().partitionId(), 0
        size = np.dtype(words.kind).itemsize
        end = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            keys, at = batch.column(0), 0
            for texts in _groups([t or "" for t in batch.column(1).to_pylist()]):
                ids = [i + end for i in words.encode(texts)]
                sizes = np.array([len(i) // size for i in ids], np.int64)
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [keys[at : at + len(ids)], pa.array([part] * len(ids), pa.int64()), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                    ["k", "part", "at", "n", "ids"],
                )
                at += len(ids)

    return tokenise


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, begins, sizes = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            rows, starts, lengths, sums = [], [], [], []
            for i, (begin, size) in enumerate(zip(begins.tolist(), sizes.tolist())):
                raw = batch.column(3)[i].as_py()
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4").astype("<u4")
                lo = 0
                while lo < size:
                    hi = min(size, lo + window - (begin + lo) % window)
                    rows.append(i)
                    starts.append(lo)
                    lengths.append(hi - lo)
                    sums.append(zlib.crc32(ids[lo:hi].tobytes()))
                    lo = hi
            at = np.array(rows, np.int64)
            place = begins[at] + np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(at)),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(sizes[at]),
                    pa.array(place // window),
                    pa.array(place % window),
                ],
                ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return cut


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    `path` names a file of the `tokenizers` library. The order of the run is that of the input's
    partitions and of the rows in them, as pass 1 stored it.
    """
    kind = docs.schema[key].dataType
    made = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        _tokenise(path, end_id),
        T.StructType([T.StructField("k", kind), T.StructField("part", T.LongType()), T.StructField("at", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())]),
    )
    ids = stored(made, "token-ids")
    totals = ids.groupBy("part").agg(F.sum("n").alias("n")).withColumn("_g", F.lit(0))
    # One row per partition of pass 1: block sums, linked in order.
    first = stored(
        running(totals, ["_g"], "part", {"first": (F.col("n"), "sum")}, inclusive=False).select("part", F.coalesce("first", F.lit(0)).alias("first")),
        "firsts",
    )
    if first.count() <= BROADCAST:
        first = F.broadcast(first)
    placed = ids.join(first, "part").select("k", (F.col("first") + F.col("at")).alias("begin"), "n", "ids")
    cut = placed.mapInArrow(
        _cut(window),
        T.StructType([T.StructField("k", kind)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]),
    )
    return cut.withColumnRenamed("k", key)


def op5_packing(spark, sf: str) -> DataFrame:
    """One row per piece of every document in sequences of 2,048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
