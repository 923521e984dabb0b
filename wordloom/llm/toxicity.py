"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fit: a bounded sample of labelled rows (`EXAMPLES` of each class, by hash order, one of each group
of copies) is cut into terms. Every word of the sample is one; so is every beginning of words that
goes with a label beyond chance, which catches inflected forms. The weight of a term grows with its
frequency in the text, its rarity, and with how far it goes with one of the labels, either of them
(chi-square).

The examples form an inverted index: the postings of a term lie in blocks of `BLOCK` examples, each
with the largest weight it holds. Texts are scored many at a time. The `FREQUENT` most frequent terms
have postings almost everywhere; theirs are rows of a matrix and are added up first, which gives
every example a part of its similarity and every text a k-th similarity that is reached at least.
With the largest weights of the other terms this bounds what a block can hold; their postings are
read only in blocks whose bound reaches that similarity. Blocks are left out only when nothing in
them can be among the k nearest, so the neighbours are exact.

Score: the neighbours vote by closeness and by how many labelled rows each stands for; a score is the
share of votes for label 1. A text without any known term has no direction; its score is the toxic
share of the labelled texts without one, so every score is a share of votes.

Null and empty texts score like texts without terms. Repeated rows score alike; equally near
examples are taken by their place in the sample. Without labels every score is 0. Null keys are in
no held-out fold and teach nothing. Keys may be of any type. An empty table gives an empty table;
other columns are not read. Texts are read whole, a batch of them at a time, whatever their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table, words

EXAMPLES = 3000  # labelled rows of each class, at most
CHI_SQUARE = 30.0  # a term of this chi-square has half of the largest weight
NEIGHBOURS = 15
BLOCK = 256
FREQUENT = 256  # terms whose postings are matrix rows
TEXTS = 16  # texts scored together
SOFT = 0.05  # added to a distance before it is inverted
FOLDS = 5
LENGTHS = (4, 5, 6)  # letters of a word's beginning
MEMORY = 100_000  # remembered tokens per Python worker

_LETTERS = regex.compile(r"\p{L}+")


def words_of(token: str) -> list[str]:
    """The words of a white-space token: its letter runs."""
    return [token] if token.isalpha() else _LETTERS.findall(token)


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in LENGTHS if len(word) >= n]


def fold(doc_id: Column) -> Column:
    """The held-out fold is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges low..high, and the number of the range that each is in."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) + np.repeat(low - (np.cumsum(n) - n), n), which


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Values summed by place; doubles also where there are none."""
    return np.bincount(at, values, minlength=size).astype(np.float64, copy=False)


@dataclass
class Index:
    """Labelled examples as a block-max inverted index."""

    words: dict[str, int]  # word -> term
    starts: dict[str, int]  # beginning -> term
    scale: np.ndarray  # weight of one occurrence of each term
    keys: pa.Array  # example -> key of its row
    label: np.ndarray
    stands_for: np.ndarray  # labelled rows per example
    prior: float  # toxic share of all labelled rows
    blank: float  # of those without a term
    first: np.ndarray  # term -> its first entry
    block: np.ndarray  # entry -> block of examples
    top: np.ndarray  # entry -> largest weight there
    start: np.ndarray  # entry -> its first posting
    example: np.ndarray  # posting -> example
    weight: np.ndarray
    row: np.ndarray  # term -> its matrix row, or -1
    frequent: np.ndarray  # frequent terms x examples

    def weighted(self, doc: np.ndarray, term: np.ndarray, times: np.ndarray, docs: int) -> np.ndarray:
        """Unit vectors: the weight of every (text, term)."""
        raw = (1 + np.log(times)) * self.scale[term]
        return raw / np.sqrt(np.bincount(doc, raw * raw, minlength=docs))[doc]

    def nearest(self, doc: np.ndarray, term: np.ndarray, times: np.ndarray, docs: int, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, example, cosine) of the k nearest examples with a common term, in order, for
        `docs` texts given as (text, term, times) ascending."""
        n, blocks = len(self.label), -(-len(self.label) // BLOCK)
        if not len(doc) or not n:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        w = self.weighted(doc, term, times, docs)
        row = self.row[term]
        often = row >= 0
        dense = np.zeros((docs, len(self.frequent)))
        dense[doc[often], row[often]] = w[often]
        grid, take = dense @ self.frequent, min(k, n)
        kth = np.partition(grid, n - take, axis=1)[:, n - take]
        entry, of = _spans(self.first[term], self.first[term + 1])
        doc, w, block = doc[of], w[of], self.block[entry].astype(np.int64)
        bound = _added(doc * blocks + block, w * self.top[entry], docs * blocks).reshape(docs, blocks)
        bound += np.maximum.reduceat(grid, np.arange(0, n, BLOCK), axis=1)
        # A bound is a sum in another order than the scores: allow for rounding.
        at = np.flatnonzero((bound >= kth[:, None] - 1e-9)[doc, block])
        posting, e = _spans(self.start[entry[at]], self.start[entry[at] + 1])
        e = at[e]
        grid += _added(doc[e] * n + self.example[posting], w[e] * self.weight[posting], docs * n).reshape(docs, n)
        kth = np.partition(grid, n - take, axis=1)[:, n - take]
        rows, found = np.nonzero((grid >= kth[:, None] - 1e-9) & (grid > 0))
        cosine = np.round(grid[rows, found], 9)
        order = np.lexsort((found, -cosine, rows))
        rows, found, cosine = rows[order], found[order], cosine[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < k
        return rows[kept], found[kept], cosine[kept]

    def score(self, doc: np.ndarray, term: np.ndarray, times: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The score of every text, and the examples (text, example) behind it."""
        rows, found, cosine = self.nearest(doc, term, times, docs)
        votes = self.stands_for[found] / (SOFT + 1 - np.minimum(cosine, 1.0))
        # One row's vote from afar for the overall share keeps scores off 0 and 1.
        far = 1 / (SOFT + 1)
        toxic, every = (np.bincount(rows, v, minlength=docs) for v in (votes * self.label[found], votes))
        return np.where(every > 0, (toxic + far * self.prior) / (every + far), self.blank), rows, found


def chi_square(a, b, n1, n0):
    """How far a term held by `a` of `n1` toxic and `b` of `n0` clean examples is from chance."""
    lead = a * n0 - b * n1
    return (n1 + n0) * lead * lead / ((a + b) * (n1 + n0 - a - b) * n1 * n0 + 1e-9)


def build_index(
    keys: pa.Array, label: np.ndarray, example: np.ndarray, word: np.ndarray, times: np.ndarray, names: list[str], starts: list[str],
    classes: dict[int, tuple[int, int]],
) -> Index:
    """From (example, word, times) rows, where `names` has the words and `starts` the telling
    beginnings; `classes` maps a label to how many rows have it, and how many examples."""
    n, n1, n0 = len(label), float((label == 1).sum()), float((label == 0).sum())
    words = {w: i for i, w in enumerate(names)}
    begun = {x: len(names) + i for i, x in enumerate(sorted(starts))}
    if begun:
        # Occurrences of the words that begin so, added up by example.
        of = [(i, begun[x]) for i, w in enumerate(names) for x in beginnings(w) if x in begun]
        its, start = (np.array([p[i] for p in of], np.int64) for i in (0, 1))
        at, which = _spans(np.searchsorted(its, word), np.searchsorted(its, word, "right"))
        size = len(names) + len(begun)
        pair, where = np.unique(example[which].astype(np.int64) * size + start[at], return_inverse=True)
        added = np.bincount(where, times[which], minlength=len(pair))
        example, term, times = (
            np.append(x, y.astype(x.dtype)) for x, y in ((example, pair // size), (word, pair % size), (times, added))
        )
    else:
        term = word

    a, b = (np.bincount(term[label[example] == y], minlength=len(names) + len(begun)).astype(float) for y in (1, 0))
    chi, holds = chi_square(a, b, n1, n0), a + b
    scale = np.log1p(n / np.maximum(holds, 1)) * chi / (chi + CHI_SQUARE) + 1e-6
    raw = (1 + np.log(times)) * scale[term]
    # Examples of one label that share their weightiest term stand together: tighter bounds.
    heaviest = np.zeros(n, np.int64)
    order = np.lexsort((raw, example))
    heaviest[example[order]] = term[order]
    place = np.empty(n, np.int32)
    place[np.lexsort((np.arange(n), heaviest, label))] = np.arange(n)
    by_place = np.argsort(place)
    keys, label, example = keys.take(pa.array(by_place)), label[by_place], place[example]

    rate = {y: every / max(1, sampled) for y, (every, sampled) in classes.items()}
    stands = np.array([rate[y] for y in label.tolist()], np.float64)
    prior = classes.get(1, (0, 0))[0] / max(1, sum(e for e, _ in classes.values()))
    bare = np.bincount(example, minlength=n) == 0
    blank = float(stands[bare] @ label[bare] + prior) / (float(stands[bare].sum()) + 1)

    weight = raw / np.sqrt(np.bincount(example, raw * raw, minlength=n))[example]
    often = np.argsort(-holds, kind="stable")[:FREQUENT]
    row = np.full(len(scale), -1)
    row[often] = np.arange(len(often))
    frequent, apart = np.zeros((len(often), n)), row[term] >= 0
    frequent[row[term[apart]], example[apart]] = weight[apart]
    example, term, weight = example[~apart], term[~apart], weight[~apart]
    order = np.lexsort((example, term))
    term, example, weight = term[order], example[order], weight[order].astype(np.float32)
    pair = term.astype(np.int64) * (n // BLOCK + 1) + example // BLOCK
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    top = np.maximum.reduceat(weight, start) if len(start) else weight
    return Index(
        words, begun, scale, keys, label.astype(np.float64), stands, prior, blank, np.searchsorted(term[start], np.arange(len(scale) + 1)),
        (example[start] // BLOCK).astype(np.int32), top, np.append(start, len(term)).astype(np.int64), example.astype(np.int32), weight,
        row, frequent,
    )


class _Known(dict):
    """White-space token -> its terms in the index, remembered up to a bound."""

    def __init__(self, index: Index):
        self.words, self.starts = index.words, index.starts
        self.heads = {x[: LENGTHS[0]] for x in index.starts}

    def __missing__(self, token: str) -> list[int] | tuple[()]:
        made = []
        for word in words_of(token):
            if (t := self.words.get(word)) is not None:
                made.append(t)
            if word[: LENGTHS[0]] in self.heads:
                made += [t for x in beginnings(word) if (t := self.starts.get(x)) is not None]
        made = made or ()  # one object for the many tokens without a term
        if len(self) >= MEMORY:
            self.clear()  # frequent tokens are back at once
        if len(token) < 64:
            self[token] = made
        return made


def _counted(known: _Known, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, times), ascending, of some texts."""
    counts = [Counter((t or "").lower().split()) for t in texts]
    doc, term, times = [], [], []
    for i, c in enumerate(counts):
        found = list(map(known.__getitem__, c))
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        n = np.repeat(np.fromiter(c.values(), np.int64, len(c)), np.fromiter(map(len, found), np.int64, len(found)))
        ids, where = np.unique(ids, return_inverse=True)
        doc.append(np.full(len(ids), i))
        term.append(ids)
        times.append(np.bincount(where, n, minlength=len(ids)))
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (doc, term, times))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, words, times) of the examples."""
    for batch in batches:
        made = []
        for text in batch.column(2):
            counts = Counter()
            for token, n in Counter((text.as_py() or "").lower().split()).items():
                for word in words_of(token):
                    counts[word] += n
            made.append(counts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([list(c) for c in made], pa.list_(pa.string())),
                pa.array([list(c.values()) for c in made], pa.list_(pa.int32())),
            ],
            ["k", "y", "w", "n"],
        )


def indexed(made: pa.Table, starts: list[str], totals: dict[int, int]) -> Index:
    """The index of examples (k, y, w, n) as `_vectors` makes them; `totals` counts labelled rows."""
    made = made.sort_by("k")
    keys, label = _whole(made["k"]), made["y"].to_numpy().astype(np.int64)
    lists = _whole(made["w"])
    example = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    found = lists.flatten().dictionary_encode()
    times = _whole(made["n"]).flatten().to_numpy().astype(np.float32)
    classes = {y: (totals.get(y, 0), int((label == y).sum())) for y in (0, 1)}
    word, names = found.indices.to_numpy(), found.dictionary.to_pylist()
    del made, lists, found
    return build_index(keys, label, example, word, times, names, starts, classes)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def telling_starts(examples: DataFrame) -> list[str]:
    """The beginnings of words (y, w) that go with a label beyond chance."""
    n1, n0 = (examples.where(F.col("y") == y).count() for y in (1, 0))
    if not n1 or not n0:
        return []
    cut = F.filter(F.flatten(F.transform("w", lambda x: F.array(*[F.when(F.length(x) >= n, F.substring(x, 1, n)) for n in LENGTHS]))), F.isnotnull)
    held = examples.select("y", F.explode(F.array_distinct(cut)).alias("x")).groupBy("x").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    chi = chi_square(F.col("a").cast("double"), F.col("b").cast("double"), float(n1), float(n0))
    return [r["x"] for r in held.where(chi >= CHI_SQUARE).select("x").collect()]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", examples: int = EXAMPLES) -> Index:
    """Learn from labelled rows (key, toxic) outside fold 0. What reaches the driver is the sample:
    at most `examples` rows of each class, as term counts."""
    kind = docs.schema[key].dataType.simpleString()
    usable = labels.where((fold(F.col(key)) != 0) & F.col("toxic").isin(0, 1)).select(F.col(key).alias("k"), F.col("toxic").cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [usable.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(examples) for y in (0, 1)]
    sample = F.broadcast(drawn[0].unionByName(drawn[1]).dropDuplicates(["k"]))
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(sample, "k")
    # Copies would make their every word look telling: of texts with the same smallest shingle
    # (the more alike, the likelier) one stays. The sample is bounded, and so is this window.
    w = words(F.col("t"))
    texts = texts.withColumn("_w", w).withColumn("_s", F.array_min(F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))))
    alike = W.partitionBy("y", F.coalesce("_s", F.lit(0))).orderBy("k", F.xxhash64("t"))
    texts = texts.withColumn("_n", F.row_number().over(alike)).where("_n = 1").select("k", "y", "t")
    made = stored(texts.mapInArrow(_vectors, f"k {kind}, y int, w array<string>, n array<int>"), "examples")
    return indexed(made.toArrow(), telling_starts(made), totals)


def toxicity(text: Column, index: Index, spark) -> Column:
    """STRUCT(score, neighbours): share of toxic votes, and the keys of the nearest examples."""
    shared = spark.sparkContext.broadcast(index)
    kept: list[_Known] = []
    evidence = pa.list_(index.keys.type)
    kind = "string" if pa.types.is_string(index.keys.type) else "long" if pa.types.is_int64(index.keys.type) else "int"

    @F.arrow_udf(f"score double, neighbours array<{kind}>")
    def judge(texts: pa.Array) -> pa.Array:
        index = shared.value
        if not kept:
            kept.append(_Known(index))
        scores, lists = [], []
        for lo in range(0, len(texts), TEXTS):
            part = texts.slice(lo, TEXTS).to_pylist()
            score, rows, found = index.score(*_counted(kept[0], part), len(part))
            scores.append(score)
            ends = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(ends), index.keys.take(pa.array(found))))
        lists = pa.concat_arrays(lists) if lists else pa.array([], evidence)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(scores) if scores else [], pa.float64()), lists], ["score", "neighbours"])

    return judge(text)


def op3_toxicity(spark, sf: str) -> DataFrame:
    """One row per document: held_out, score, predicted, and the nearest examples as evidence."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    index = fit(docs, table(spark, sf, "labels"))
    judged = docs.select("doc_id", toxicity(F.col("text"), index, spark).alias("j"))
    return judged.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("j.score").alias("score"),
        (F.col("j.score") >= 0.5).cast("int").alias("predicted"),
        F.col("j.neighbours").alias("evidence"),
    )
