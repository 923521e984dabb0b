"""Quality by a regularised quadratic discriminant over transformed document statistics.

A whole text is reduced to `len(STATISTICS)` statistics: sizes, shares and repetition. Shares enter
as smoothed log odds and sizes as logarithms, which makes both classes roughly normal. Each class of
labelled rows is a normal distribution with its own mean and covariance; covariances are shrunk
towards the pooled one and that towards its diagonal, so few rows or constant statistics do no harm.
The fit sums counts, means and products inside the tasks; what reaches the driver is one count, mean
and matrix per class, however many rows are labelled.

A score is the logistic of the difference of two log densities plus the log odds of the classes.
Each density is a squared Mahalanobis distance under the class's Cholesky factor, which is inverted
once in the fit and kept in the model; a batch of texts is scored as two matrix products.

Defined cases: null and empty texts have no words and are scored by that. Labels other than 0 and 1,
null keys, and labels without a document teach nothing; a document with several labels teaches each
of them. With one class only, every score is that class's share, 0.5 with none. Repeated rows score
alike. Texts are read as bytes from end to end, whatever their length. An empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table

FOLDS, HELD_OUT = 3, 1
SHRINK = 0.1  # of a class covariance, towards the pooled one
FLATTEN = 0.1  # of the pooled covariance, towards its diagonal
FLOOR = 0.05  # least standard deviation of a statistic
ROWS = 30.0  # rows a class counts as already having at the pooled covariance

STATISTICS = (
    "words", "lines", "word_length", "line_length", "symbols", "exclamations", "upper", "digits",
    "separators", "sentence_ends", "repeated_next", "repeated_lines", "distinct", "commonest", "bare",
)

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS = b"0123456789"
_SYMBOLS, _SEPARATORS, _ENDS = b"#*$%&<>=~^{}[]\\@_+", b"|", b".?"
_LETTERS = _UPPER + _LOWER + bytes(range(128, 256))
_SPACES = b" \t\n\x0b\x0c\r"
# One pass over a text leaves one letter per kind of byte.
_KINDS = bytearray(b"o" * 256)
for _kind, _members in ((b"U", _UPPER), (b"l", _LOWER), (b"d", _DIGITS), (b"s", _SYMBOLS), (b"p", _SEPARATORS), (b"e", _ENDS), (b"w", _SPACES), (b"!", b"!")):
    for _byte in _members:
        _KINDS[_byte] = _kind[0]
_KINDS, _WRITTEN = bytes(_KINDS), _LETTERS + _DIGITS


def _odds(part: float, whole: float) -> float:
    """Log odds of a share, smoothed by half a case on either side."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS."""
    words, kinds = text.split(), text.translate(_KINDS)
    n = len(words)
    chars = len(text) - kinds.count(b"w")
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    upper, lower = kinds.count(b"U"), kinds.count(b"l")
    again = sum(map(bytes.__eq__, words, words[1:]))
    bare = sum(k for w, k in counts.items() if w.translate(None, _WRITTEN) == w)
    return [
        math.log1p(n),
        math.log1p(len(lines)),
        math.log((chars + 1) / (n + 1)),
        math.log((n + 1) / (len(lines) + 1)),
        _odds(kinds.count(b"s"), chars),
        _odds(kinds.count(b"!"), chars),
        _odds(upper, upper + lower),
        _odds(kinds.count(b"d"), chars),
        _odds(kinds.count(b"p"), chars),
        _odds(kinds.count(b"e"), chars),
        _odds(again, n),
        _odds(len(lines) - len(set(lines)), len(lines)),
        math.log((len(counts) + 1) / math.sqrt(n + 1)),
        _odds(max(counts.values(), default=0), n),
        _odds(bare, n),
    ]


@dataclass
class Discriminant:
    """Two normal distributions: means, inverses of their Cholesky factors, and constants."""

    means: dict[int, np.ndarray]
    whiten: dict[int, np.ndarray]  # inverse Cholesky factors
    constant: dict[int, float]  # log prior minus the log of the factor's determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        """The share of label 1, for rows of statistics."""
        if len(self.means) < 2:
            return np.full(len(x), 0.5 if not self.means else float(next(iter(self.means))))
        log = {y: self.constant[y] - 0.5 * np.square((x - self.means[y]) @ self.whiten[y].T).sum(axis=1) for y in (0, 1)}
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def discriminant(sums: dict[int, tuple[int, np.ndarray, np.ndarray]], shrink: float = SHRINK, flatten: float = FLATTEN) -> Discriminant:
    """From label -> (rows, sum of statistics, sum of their outer products)."""
    model = Discriminant({}, {}, {})
    rows = {y: n for y, (n, _, _) in sums.items() if n}
    scatter = {}
    for y, n in rows.items():
        _, total, square = sums[y]
        model.means[y] = total / n
        scatter[y] = square - n * np.outer(model.means[y], model.means[y])
    if len(rows) < 2:
        return model
    every = sum(rows.values())
    pooled = sum(scatter.values()) / every
    pooled = (1 - flatten) * pooled + flatten * np.diag(np.diag(pooled)) + FLOOR**2 * np.eye(len(pooled))
    for y, n in rows.items():
        # Few rows lean on the pooled covariance by themselves.
        own = (scatter[y] + ROWS * pooled) / (n + ROWS)
        factor = np.linalg.cholesky((1 - shrink) * own + shrink * pooled)
        model.whiten[y] = np.linalg.inv(factor)
        model.constant[y] = math.log(n / every) - float(np.log(np.diag(factor)).sum())
    return model


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def measured(text: Column) -> Column:
    """The statistics of every whole text, as ARRAY<DOUBLE>."""

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        rows = [statistics(t.as_buffer().to_pybytes()) for t in texts]
        flat = pa.array(np.array(rows, np.float64).ravel(), pa.float64())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32()), flat)

    return measure(F.coalesce(text, F.lit("")).cast("binary"))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per label and task: how many, the sums, and the sums of products."""
    d = len(STATISTICS)
    held = {y: [0, np.zeros(d), np.zeros((d, d))] for y in (0, 1)}
    for batch in batches:
        x, y = _matrix(batch.column(0)), batch.column(1).to_numpy()
        for label, sums in held.items():
            own = x[y == label]
            sums[0] += len(own)
            sums[1] += own.sum(axis=0)
            sums[2] += own.T @ own
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(held), pa.int32()), pa.array([s[0] for s in held.values()], pa.int64()),
            pa.array([np.concatenate([s[1], s[2].ravel()]) for s in held.values()], pa.list_(pa.float64())),
        ],
        ["y", "n", "sums"],
    )


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", x: str = "x", label: str = "quality") -> Discriminant:
    """Learn from all labelled rows outside the held-out fold; `x` holds what `measured` gives."""
    d = len(STATISTICS)
    usable = labels.where((fold(F.col(key)) != HELD_OUT) & F.col(label).isin(0, 1)).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    # Statistics are joined, not texts: about a hundred bytes a document move.
    known = docs.select(F.col(key).alias("k"), F.col(x).alias("x")).where(fold(F.col("k")) != HELD_OUT)
    taught = known.join(usable, "k").select("x", "y").mapInArrow(_sums, "y int, n long, sums array<double>")
    cells = taught.select("y", "n", *[F.get("sums", F.lit(i)).alias(f"s{i}") for i in range(d + d * d)])
    made = cells.groupBy("y").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d + d * d)]).collect()
    flat = {r["y"]: (r["n"], np.array([r[f"s{i}"] for i in range(d + d * d)])) for r in made}
    return discriminant({y: (n, s[:d], s[d:].reshape(d, d)) for y, (n, s) in flat.items()})


def quality_score(x: Column, model: Discriminant, spark) -> Column:
    """The score of every row of statistics, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)  # a few kilobytes, whatever the data

    @F.arrow_udf("double")
    def judge(rows: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(_matrix(rows)), pa.float64())

    return judge(x)


def op11_quality_classifier(spark, sf: str) -> DataFrame:
    """One row per document: held_out, score and predicted."""
    docs = table(spark, sf, "documents")
    docs = stored(docs.select("doc_id", measured(F.col("text")).alias("x")), "statistics")  # texts are read once
    model = fit(docs, table(spark, sf, "labels"))
    scored = docs.select("doc_id", quality_score(F.col("x"), model, spark).alias("score"))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
