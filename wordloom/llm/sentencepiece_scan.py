"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is a lattice: nodes are (place, piece that ends there), and an arc leads to the next piece.
Arcs weigh 0 if the two pieces stand side by side when the model encodes just the two of them, and
minus infinity if not. Merges act on neighbours only, so a path of weight 0 through the whole text
exists, is the only one, and is the model's own encoding. (The public model is of the BPE kind;
with these weights the scan gives its ids, which piece scores as weights would not.)

Every cut of a giant text has few states: the pieces that cover it. A chunk yields the matrix of
best weights from the states of its left cut to those of its right cut, computed without knowing
the rest. Matrices combine associatively; a scan forward and one backward over the (tiny) matrices
of a text leave one state per cut, and every chunk then traces its own pieces independently. A
text of one chunk has one start and one end state. Words are independent in this model, so the
trace of a word is remembered, up to a bound. The new words of a group of texts lie as rows of
matrices, and all rows merge their best pair at once.

Null and empty texts have no pieces. Repeated rows are encoded alike; texts of any length are cut;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import stored, table
from wordloom.llm.tokencount import PairTable

SPACE = "▁"  # a fixed value: what stands for a space in pieces
CHUNK = 32_768  # characters
MEMORY = 80_000  # words of a generation that a Python worker remembers, of two, and pairs of pieces
LONG = 40  # longer words are not remembered, and traced through the lattice
WIDTHS = (6, 9, 12, 16, 24, LONG)  # characters: words of up to so many share a matrix
FEW = 100  # fewer new words are merged one by one
ROWS = 4_096  # words of a matrix at most
GROUP = 500_000  # characters of texts whose words are looked up together
NONE = -np.inf

_WORDS = regex.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Merges:
    """The merges of a model of the BPE kind, for many words at once.

    Symbols are ids of pieces; then come characters of pieces that are none themselves. Characters
    in no piece are -2 - code point, and merge with nothing. The latter two become bytes in the end.
    """

    def __init__(self, ids: dict[str, int], score: dict[str, float], byte: list[int]):
        self.size = max(ids.values()) + 1
        bare = sorted({c for p in ids for c in p} - set(ids))
        symbol = ids | {c: self.size + i for i, c in enumerate(bare)}
        self.bare = np.array([ord(c) for c in bare], np.int64)
        self.byte = np.array(byte, np.int64)
        single = {ord(c): i for c, i in symbol.items() if len(c) == 1}
        self.char = -2 - np.arange(max(single) + 1, dtype=np.int64)  # as far as characters of pieces go
        self.char[list(single)] = list(single.values())
        pairs = [(a, b, p) for p in ids for n in range(1, len(p)) if (a := p[:n]) in symbol and (b := p[n:]) in symbol]
        made = np.array([(symbol[a], symbol[b], symbol[p]) for a, b, p in pairs], np.int64).reshape(-1, 3)
        self.pairs = PairTable(made)
        # Equal scores have equal ranks: the leftmost pair merges, however it is made up.
        ranks = np.unique([-score[p] for _, _, p in pairs], return_inverse=True)[1]
        self.none = np.iinfo(np.int32).max  # the rank of pairs that do not merge
        self.rank = np.append(ranks, self.none).astype(np.int32)
        self.made = np.append(made[:, 2], -1).astype(np.int32)

    def symbols(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        return np.where(code < len(self.char), self.char[np.minimum(code, len(self.char) - 1)], -2 - code)

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.ranks(left.astype(np.int64) << 20 | right)

    def rows(self, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after their merges, word after word, and how many each has.

        A word is a row of `width` places; those of merged symbols are skipped by the places after
        and before. In each round every row merges its best pair, until no row has one.
        """
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        # One place more, -1, stands for the neighbour of a word's ends.
        last = n * width
        symbol = np.full(last + 1, -1, np.int32)
        alive = (np.arange(width) < sizes[:, None]).ravel()
        symbol[:last][alive] = self.symbols("".join(words))
        place = np.arange(last, dtype=np.int32).reshape(n, width)
        after, before = np.append(place + 1, last).astype(np.int32), np.append(place - 1, last).astype(np.int32)
        after[place[:, -1]] = before[place[:, 0]] = last
        pair = np.full(last + 1, len(self.made) - 1, np.int32)
        pair[:last] = self.found(symbol[:last], symbol[after[:last]])
        rank = self.rank[pair]
        table, row = rank[:last].reshape(n, width), np.arange(n)
        while len(row):
            at = row * width + table[row].argmin(1)  # the leftmost of equals
            live = rank[at] < self.none
            row, at = row[live], at[live]
            gone = after[at]
            then, prior = after[gone], before[at]
            symbol[at] = self.made[pair[at]]
            alive[gone] = False
            rank[gone] = self.none
            after[at], before[then] = then, at
            fresh = self.found(np.concatenate([symbol[prior], symbol[at]]), np.concatenate([symbol[at], symbol[then]]))
            for places, p in ((prior, fresh[: len(at)]), (at, fresh[len(at) :])):
                pair[places], rank[places] = p, self.rank[p]
        return symbol[:last][alive], alive.reshape(n, width).sum(1)

    def ids(self, words: list[str], width: int) -> list[bytes]:
        """The ids of each word, none of them longer than `width`."""
        symbols, sizes = self.rows(words, width)
        symbols, ends = symbols.astype(np.int64), np.cumsum(sizes)
        bare = symbols >= self.size
        symbols[bare] = -2 - self.bare[symbols[bare] - self.size]
        other = symbols < 0
        if other.any():
            chars = -2 - symbols[other]
            raw = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            count = np.ones(len(symbols), np.int64)
            count[other] = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
            symbols, other = np.repeat(symbols, count), np.repeat(other, count)
            symbols[other] = self.byte[np.frombuffer(raw, np.uint8)]
            ends = np.cumsum(count)[ends - 1]
        raw, ends = symbols.astype("<i4").tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


class Pieces:
    """The pieces of a model of the BPE kind, with which pairs may stand side by side."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = {i: p.encode() for p, i in self.id.items()} | {i: bytes([b]) for b, i in enumerate(self.byte)}
        self.longest = max(map(len, self.id))
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError(f"{path}: pieces reach across words")
        self.merges = Merges(self.id, self.score, self.byte)
        # Every beginning of a piece, and whether it is one.
        self.begun = {p[:n]: False for p in self.id for n in range(1, len(p))} | dict.fromkeys(self.id, True)
        self.pairs: dict[str, bool] = {}
        self.words: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text: the best-scored pair merges, the leftmost of equals."""
        parts, score = list(text), self.score.get
        pairs = [score(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == NONE:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NONE)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NONE)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Weight 0 (true) or minus infinity of the arc between two pieces; `left` may be empty."""
        key = f"{left} {right}"  # no piece holds a space
        got = self.pairs.get(key)
        if got is None:
            got = self.merged(left + right) == ([left, right] if left else [right])
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def known(self, text: str) -> bool:
        return len(text) == 1 or text in self.id

    def reach(self, text: str, lo: int, hi: int, first: str = "", until: int | None = None) -> dict[int, str]:
        """Place -> the piece that ends there, over all places from `lo` to `hi` that paths of
        weight 0 reach from `lo`, where the piece `first` ends. Pieces start before `until`."""
        last = {lo: first}
        begun, pairs = self.begun.get, self.pairs.get
        for p in range(lo, hi if until is None else min(hi, until)):
            left = last.get(p)
            if left is None:
                continue
            for end in range(p + 1, min(hi, p + self.longest) + 1):
                right = text[p:end]
                whole = begun(right)  # None: no piece begins like this
                if whole or end == p + 1:
                    fit = pairs(f"{left} {right}")
                    # At most one piece fits at a place.
                    if self.fits(left, right) if fit is None else fit:
                        last[end] = right
                if whole is None:
                    break
        return last

    def trace(self, last: dict[int, str], lo: int, hi: int) -> list[str]:
        """The pieces on the path from `lo` to `hi`, last first."""
        out = []
        while hi > lo:
            out.append(last[hi])
            hi -= len(last[hi])
        return out[::-1]

    def ids(self, pieces: list[str]) -> bytes:
        out = []
        for p in pieces:
            i = self.id.get(p)
            if i is None:
                out.extend(self.byte[b] for b in p.encode("utf-8", "surrogatepass"))
            else:
                out.append(i)
        return np.array(out, "<i4").tobytes()

    def word(self, word: str) -> bytes:
        # A word within a chunk has no unknown state: its merges give the one path directly.
        # They cost the square of its length, so a long word is traced through the lattice.
        return self.ids(self.merged(word) if len(word) <= LONG else self.trace(self.reach(word, 0, len(word)), 0, len(word)))

    def coded(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new words, merged together unless they are few or long."""
        if len(words) < FEW:
            return {w: self.word(w) for w in words}
        out, kinds = {}, [[] for _ in WIDTHS]
        for w in words:
            if len(w) > LONG:
                out[w] = self.word(w)
            else:
                kinds[bisect_left(WIDTHS, len(w))].append(w)
        for width, kind in zip(WIDTHS, kinds):
            for at in range(0, len(kind), ROWS):
                part = kind[at : at + ROWS]
                out.update(zip(part, self.merges.ids(part, width)))
        return out

    def remember(self, word: str, ids: bytes) -> None:
        """A full generation becomes the former one; words that return from it are kept."""
        if len(self.words) >= MEMORY:
            self.words, self.former = {}, self.words
        self.words[word] = ids

    def runs(self, texts: list[str]) -> list[bytes]:
        """Ids of stretches that start and end between words."""
        words = [words_of(t) for t in texts]
        wanted = set().union(*words)
        found = {w: ids for w in wanted if (ids := self.words.get(w) or self.former.get(w))}
        found |= self.coded([w for w in wanted if w not in found])
        for w, ids in found.items():
            if w not in self.words and len(w) <= LONG:
                self.remember(w, ids)
        return [b"".join(map(found.__getitem__, w)) for w in words]

    def run(self, text: str) -> bytes:
        return self.runs([text])[0]

    def decode(self, ids) -> bytes:
        """The UTF-8 bytes of the normalised text."""
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def words_of(text: str) -> list[str]:
    """The words of a normalised text: plain splits unless marks follow each other."""
    if SPACE * 2 in text or " " in text:
        return _WORDS.findall(text)
    found = text.replace(SPACE, f" {SPACE}").split(" ")
    return found if found[0] else found[1:]


def normalised(text: str | None) -> str:
    """The model's only normalisation: spaces are marked, and one is put in front."""
    return SPACE + text.replace(" ", SPACE) if text else ""


# ── one chunk: text[lo:hi] of a text with `context` characters on both sides ─────────────


def starts_of_words(text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """The first and the last place from `lo` to before `hi` where a word starts."""
    at = [m.start() for m in _WORDS.finditer(text) if m.start() > 0 and lo <= m.start() < hi]
    return (at[0], at[-1]) if at else None


def states(p: Pieces, text: str, cut: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces that may cover a cut: they start before it and end at or after."""
    n = p.longest
    return [(s, e) for s in range(max(0, cut - n), cut) for e in range(cut, min(len(text), s + n) + 1) if p.known(text[s:e]) and p.fits("", text[s:e])]


def matrix(p: Pieces, text: str, lo: int, hi: int, first: bool, final: bool) -> tuple[list, list, np.ndarray]:
    """(left states, right states, weights) of the chunk text[lo:hi]."""
    left = [(lo, lo)] if first else states(p, text, lo)
    right = [(hi, hi)] if final else states(p, text, hi)
    weights = np.full((len(left), len(right)), NONE)
    words = starts_of_words(text, lo, hi)
    tail = p.reach(text, words[1], right_end(right, hi), "", hi if not final else None) if words else None
    for i, (s, e) in enumerate(left):
        own = text[s:e]
        if words:
            ok = e <= words[0] and words[0] in p.reach(text, e, words[0], own)
            last = tail if ok else {}
        else:
            last = p.reach(text, e, right_end(right, hi), own, hi if not final else None)
        for j, (a, b) in enumerate(right):
            same_piece = not words and (a, b) == (s, e)  # one piece over both cuts
            if (final and b in last) or same_piece or (not final and a >= e and last.get(b) == text[a:b] and b - len(last[b]) == a):
                weights[i, j] = 0.0
    return left, right, weights


def right_end(right: list[tuple[int, int]], hi: int) -> int:
    return max([hi, *[e for _, e in right]])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1, initial=NONE)


def traced(p: Pieces, text: str, lo: int, hi: int, enter: tuple[int, int], leave: tuple[int, int]) -> bytes:
    """Ids of the pieces after the entering one, up to and with the leaving one."""
    own, start, end = text[enter[0] : enter[1]], enter[1], leave[1]
    if enter == leave and enter[0] < enter[1]:
        return b""
    words = starts_of_words(text, max(start, lo), min(end, hi))
    if words is None:
        return p.ids(p.trace(p.reach(text, start, end, own), start, end))
    head = p.ids(p.trace(p.reach(text, start, words[0], own), start, words[0]))
    tail = p.ids(p.trace(p.reach(text, words[1], end), words[1], end))
    return head + p.run(text[words[0] : words[1]]) + tail


# ── Spark ────────────────────────────────────────────────────────────────────────────────


_LONG = pa.int64()
_IDS = [("chunk", _LONG), ("start", _LONG), ("ids", pa.binary())]
_CUTS = [("r", _LONG), ("chunk", _LONG), ("chunks", _LONG), ("base", _LONG), ("lo", _LONG), ("hi", _LONG), ("piece", pa.string())]
_STATES = "r long, chunk long, enter_start long, enter_end long, leave_start long, leave_end long"


def _batch(key: pa.DataType, fields: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (key, *fields)."""
    kinds = [("k", key), *fields]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])


def _small(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            keys, texts, size = [], [], 0
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keys += part.column("k").to_pylist()
                texts += map(normalised, part.column("t").to_pylist())
                size += sum(map(len, texts[-part.num_rows :]))
                if size >= GROUP or at + 64 >= batch.num_rows:
                    yield _batch(batch.schema.field("k").type, _IDS, [(k, 0, 0, ids) for k, ids in zip(keys, p.runs(texts))])
                    keys, texts, size = [], [], 0

    return encode


def _cut(size: int, context: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, r, text = (batch.column(c)[i].as_py() for c in range(3))
                text = normalised(text)
                n = -(-len(text) // size)
                for k in range(n):
                    base, hi = max(0, k * size - context), min(len(text), (k + 1) * size)
                    row = (key, r, k, n, base, k * size - base, hi - base, text[base : hi + context])
                    yield _batch(batch.schema.field("k").type, _CUTS, [row])

    return cut


def _matrices(path: str):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(path)
        for frame in frames:
            rows = []
            for c in frame.itertuples():
                left, right, w = matrix(p, c.piece, c.lo, c.hi, c.chunk == 0, c.chunk == c.chunks - 1)
                shift = lambda s: [[a + c.base, b + c.base] for a, b in s]  # noqa: B023, E731
                rows.append((c.r, c.chunk, shift(left), shift(right), w.ravel().tolist()))
            yield pd.DataFrame(rows, columns=["r", "chunk", "enter", "leave", "weights"])

    return of


def resolve(frame: pd.DataFrame) -> pd.DataFrame:
    """The state at both cuts of every chunk of one text, from the matrices alone."""
    frame = frame.sort_values("chunk")
    enter = [[tuple(s) for s in x] for x in frame["enter"]]
    leave = [[tuple(s) for s in x] for x in frame["leave"]]
    mats = [np.array(w, np.float64).reshape(len(a), len(b)) for w, a, b in zip(frame["weights"], enter, leave)]
    # Vectors of best weights from the start and to the end: prefix and suffix products.
    ahead = [np.zeros((1, 1))]
    for m in mats:
        ahead.append(combine(ahead[-1], m))
    behind = [np.zeros((1, 1))]
    for m in reversed(mats):
        behind.append(combine(m, behind[-1]))
    behind.reverse()
    rows = []
    best = [int(np.argmax(a[0] + b[:, 0])) for a, b in zip(ahead, behind)]
    for k, (r, chunk) in enumerate(zip(frame["r"], frame["chunk"])):
        rows.append((r, chunk, *enter[k][best[k]], *leave[k][best[k + 1]]))
    return pd.DataFrame(rows, columns=["r", "chunk", "enter_start", "enter_end", "leave_start", "leave_end"])


def _trace(path: str):
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            for c in batch.to_pylist():
                b = c["base"]
                enter, leave = (c["enter_start"] - b, c["enter_end"] - b), (c["leave_start"] - b, c["leave_end"] - b)
                ids = traced(p, c["piece"], c["lo"], c["hi"], enter, leave)
                yield _batch(batch.schema.field("k").type, _IDS, [(c["k"], c["chunk"], c["enter_end"], ids)])

    return trace


def _schema(docs: DataFrame, key: str, fields: list[tuple]) -> T.StructType:
    kinds = {_LONG: T.LongType(), pa.binary(): T.BinaryType(), pa.string(): T.StringType()}
    return T.StructType([T.StructField("k", docs.schema[key].dataType), *[T.StructField(n, kinds[t]) for n, t in fields]])


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(key, chunk, start, ids): the ids of every text, chunk by chunk.

    `ids` are little-endian 32-bit values; `start` is where the chunk's first piece starts in the
    normalised text. A text of fewer than `chunk` characters has one chunk. Of a giant text one
    task holds the matrices, a small part of it; a text itself is one row of at most 2 GB.
    """
    rows = docs.select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    ids = _schema(docs, key, _IDS)
    done = rows.where(F.length("t") < chunk).select("k", "t").mapInArrow(_small(path), ids)
    giant = rows.where(F.length("t") >= chunk).mapInArrow(_cut(chunk, pieces(path).longest), _schema(docs, key, _CUTS))
    cuts = stored(giant.repartition("r", "chunk"), "chunks")
    mats = cuts.drop("k").mapInPandas(_matrices(path), "r long, chunk long, enter array<array<long>>, leave array<array<long>>, weights array<double>")
    found = mats.groupBy("r").applyInPandas(resolve, _STATES)
    traced_ = cuts.join(found, ["r", "chunk"]).mapInArrow(_trace(path), ids)
    return done.unionByName(traced_).withColumnRenamed("k", key)


def decoded(ids: Column, path: str) -> Column:
    """The normalised text of an ids column: bytes of pieces, invalid UTF-8 replaced."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        p = pieces(path)
        parts = []
        for at in range(0, max(1, len(rows)), 256):
            part = rows.slice(at, 256).to_pylist()
            parts.append(pa.array([None if i is None else p.decode(np.frombuffer(i, "<i4").tolist()).decode("utf-8", "replace") for i in part], pa.string()))
        return pa.concat_arrays(parts)

    return decode(ids)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, chunk, text): each chunk back as text, spaces restored; the first chunk of a text
    loses the space that encoding put in front."""
    text = F.replace(decoded(F.col("ids"), path), F.lit(SPACE), F.lit(" "))
    return encoded.select(key, "chunk", F.when(F.col("chunk") == 0, F.substring(text, F.lit(2), F.length(text))).otherwise(text).alias("text"))


def op8_sentencepiece(spark, sf: str) -> DataFrame:
    """One row per chunk of every document: its pieces, and the CRCs of ids and of decoded text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode(table(spark, sf, "documents").select("doc_id", "text"), path)
    back = coded.withColumn("_t", decoded(F.col("ids"), path))
    return back.select(
        "doc_id", "chunk", "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("_t").cast("long").alias("n_chars"),
        F.crc32(F.col("_t").cast("binary")).alias("text_crc32"),
    )
