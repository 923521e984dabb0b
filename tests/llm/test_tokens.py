"""Token counts, packing and SentencePiece against the tokenizer libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from wordloom.llm import packing, sentencepiece_scan as scan, tokencount

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", "a", " ", "  \n\n  x", "don't DON'T we'll 'S", "<|endoftext|>x <|endoftext|> <|startoftext|>", "aaaaaaaaaaaaaaaa aaaaaaa",
    "İstanbul ΟΔΟΣ Σ é é ﬁ ª²¼ ß ẞ", "한국어 日本語 हिन्दी 😀😀", "\x00\x1c\x85\xa0​ 1234567890 ...!!!???", "x" * 5000, "ab " * 4000,
    "a▁b ▁▁ c", "tab\tand\r\nlines", "same", "same",
]


def random_texts(seed, n=60):
    rnd = random.Random(seed)
    pool = ["the", "internationalization", "é", "日本", "a", "  ", "\n", "don't", "x" * 40, "12345", "▁", "ciónmente", "ẞtraße", "'re"]
    return ["".join(rnd.choice(pool) + rnd.choice([" ", "", " "]) for _ in range(rnd.randint(1, 40))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3)


# ── token counts ─────────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize("memory", [0, 20, 100000])
def test_counts_equal_the_library(memory):
    library = tokenizers.Tokenizer.from_file(BYTES)
    texts = TEXTS + random_texts(memory)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert tokencount.Counter(tokencount.merges(BYTES), memory).count(texts) == want


def test_texts_above_the_group_size(monkeypatch):
    library = tokenizers.Tokenizer.from_file(BYTES)
    texts = random_texts(9, 5)
    monkeypatch.setattr(tokencount, "GROUP", 40)
    assert tokencount.Counter(tokencount.merges(BYTES)).count(texts) == [len(library.encode(t).ids) for t in texts]


def test_count_table(spark, sf):
    rows = tokencount.count_tokens(frame(spark, TEXTS), BYTES).collect()
    library = tokenizers.Tokenizer.from_file(BYTES)
    for r in rows:
        t = TEXTS[r.doc_id] or ""
        n = len(library.encode(t).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 1024)
    assert tokencount.count_tokens(frame(spark, TEXTS).limit(0), BYTES).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in tokencount.op4_token_counts(spark, sf).collect()}
    assert got == {i: len(library.encode(t).ids) for i, t in docs.items()}


# ── packing ──────────────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize("memory", [0, 10, 100000])
def test_word_ids_equal_the_library(memory):
    mine = packing.WordTokenizer(WORDS, memory)
    for texts in (TEXTS, random_texts(memory)):
        for got, t in zip(mine.encode([t or "" for t in texts]), texts):
            want = mine.tokenizer.encode(t or "", add_special_tokens=False).ids
            assert np.frombuffer(got, mine.kind).tolist() == want, t


def test_latin_words_equal_the_library():
    mine, rnd = packing.WordTokenizer(WORDS), random.Random(2)
    letters = [chr(c) for c in range(0x21, 0x250)]
    text = " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(3000))
    assert np.frombuffer(mine.encode([text])[0], mine.kind).tolist() == mine.tokenizer.encode(text, add_special_tokens=False).ids


def check_packed(rows, texts, window):
    library = tokenizers.Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids, at = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or k == len(by_sequence) - 1


@pytest.mark.parametrize("window", [1, 7, 2048])
def test_pack(spark, window):
    rows = packing.pack(frame(spark, TEXTS), WORDS, window=window).collect()
    check_packed(rows, dict(enumerate(TEXTS)), window)


def test_pack_without_broadcast_and_empty(spark, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST", 0)
    check_packed(packing.pack(frame(spark, TEXTS), WORDS).collect(), dict(enumerate(TEXTS)), 2048)
    assert packing.pack(frame(spark, TEXTS).limit(0), WORDS).count() == 0


def test_pack_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_packed(packing.op5_packing(spark, sf).collect(), docs, 2048)


# ── SentencePiece ────────────────────────────────────────────────────────────────────────

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library():
    p = scan.pieces(PIECES)
    for t in TEXTS + random_texts(1, 200):
        assert np.frombuffer(p.run(scan.normalised(t)), "<i4").tolist() == LIBRARY.encode(t or "")


def chunked(p, text, size):
    text, rows, cuts = scan.normalised(text), [], []
    n = -(-len(text) // size)
    for k in range(n):
        base, hi = max(0, k * size - p.longest), min(len(text), (k + 1) * size)
        part, lo = text[base : hi + p.longest], k * size - base
        left, right, w = scan.matrix(p, part, lo, hi - base, k == 0, k == n - 1)
        rows.append((1, k, [[a + base, b + base] for a, b in left], [[a + base, b + base] for a, b in right], w.ravel().tolist()))
        cuts.append((base, part, lo, hi - base))
    found = scan.resolve(pd.DataFrame(rows, columns=["r", "chunk", "enter", "leave", "weights"]))
    made = b""
    for (base, part, lo, hi), s in zip(cuts, found.itertuples()):
        made += scan.traced(p, part, lo, hi, (s.enter_start - base, s.enter_end - base), (s.leave_start - base, s.leave_end - base))
    return np.frombuffer(made, "<i4").tolist()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 16, 33, 64])
def test_any_cut_gives_the_same_pieces(size):
    p = scan.pieces(PIECES)
    for t in random_texts(size, 40) + ["x" * 200, "unglichkeit" * 30]:
        assert chunked(p, t, size) == LIBRARY.encode(t)


def test_products_are_associative():
    rnd = np.random.default_rng(3)
    a, b, c = (np.where(rnd.random((4, 4)) < 0.5, 0.0, scan.NONE) for _ in range(3))
    assert np.array_equal(scan.combine(scan.combine(a, b), c), scan.combine(a, scan.combine(b, c)))


@pytest.mark.parametrize("chunk", [50, 32768])
def test_encode_and_decode_tables(spark, chunk):
    coded = scan.encode(frame(spark, TEXTS), PIECES, chunk=chunk).cache()
    parts, back = defaultdict(list), defaultdict(list)
    for r in coded.collect():
        parts[r.doc_id].append((r.chunk, r.ids))
    for r in scan.decode(coded, PIECES).collect():
        back[r.doc_id].append((r.chunk, r.text))
    for i, t in enumerate(TEXTS):
        assert np.frombuffer(b"".join(x for _, x in sorted(parts[i])), "<i4").tolist() == LIBRARY.encode(t or "")
        assert "".join(x for _, x in sorted(back[i])) == (t or "").replace("▁", " ")
    assert scan.encode(frame(spark, TEXTS).limit(0), PIECES).count() == 0


def test_scan_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = defaultdict(int)
    for r in scan.op8_sentencepiece(spark, sf).select("doc_id", F.col("n_pieces")).collect():
        got[r.doc_id] += r.n_pieces
    assert got == {i: len(LIBRARY.encode(t)) for i, t in docs.items()}


def test_remembered_words_are_bounded_and_common_ones_stay(monkeypatch):
    from wordloom.llm import sentencepiece_scan as scan

    monkeypatch.setattr(scan, "MEMORY", 50)
    p = scan.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    calls, merged = [], p.merged
    monkeypatch.setattr(p, "merged", lambda w: calls.append(w) or merged(w))
    for i in range(400):
        p.run(f"{scan.SPACE}common{scan.SPACE}rare{i}")
        assert len(p.words) <= 50 and len(p.former) <= 50
    assert calls.count(f"{scan.SPACE}common") == 1


def odd_words(seed, n=3000):
    rnd = random.Random(seed)
    letters = "aaaabeehinoorstt" + "▁.,#0é日😀\n\x00ẞñ한𐍈"
    return ["▁" * rnd.randint(0, 3) + "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 36))).replace("▁", "") for _ in range(n)]


def test_words_merged_together_equal_words_merged_one_by_one():
    p = scan.Pieces(PIECES)
    words = list(dict.fromkeys([*filter(None, odd_words(4)), "a" * 40, "▁" + "a" * 39, "▁" * 17, "x", "\n", "\U0010ffff"]))
    assert p.coded(words) == {w: p.ids(p.merged(w)) for w in words}


def test_symbols_that_are_no_pieces_and_equal_scores():
    # "b" is no piece but merges; "aaa" is made from two pairs of equal score, the leftmost merges.
    ids, score = {"a": 3, "aa": 4, "aaa": 5, "ab": 6}, {"a": 0.0, "aa": -1.0, "aaa": -2.0, "ab": -3.0}
    p = scan.Pieces(PIECES)
    p.id, p.score, p.byte = ids, score, list(range(100, 356))
    merges = scan.Merges(ids, score, p.byte)
    words = ["a" * n for n in range(1, 12)] + ["b", "ab", "aab", "aaaab", "bab", "éab", "aaaaabaaaaa"]
    assert merges.ids(words, 12) == [p.ids(p.merged(w)) for w in words]


def test_many_new_words_are_not_merged_one_by_one(monkeypatch):
    p = scan.Pieces(PIECES)
    calls, merged = [], p.merged
    monkeypatch.setattr(p, "merged", lambda w: calls.append(w) or merged(w))
    text = " ".join(f"wordy{i}ness" for i in range(3000)) + "  é日\n😀"
    assert np.frombuffer(p.run(scan.normalised(text)), "<i4").tolist() == LIBRARY.encode(text)
    assert len(calls) < 100


def test_groups_of_texts_and_decoding_in_parts(spark, monkeypatch):
    texts = [*TEXTS, *random_texts(5, 600)]
    coded = scan.encode(frame(spark, texts).coalesce(1), PIECES)
    rows = {r.doc_id: np.frombuffer(r.ids, "<i4").tolist() for r in coded.collect()}
    assert rows == {i: LIBRARY.encode(t or "") for i, t in enumerate(texts)}
    ids = coded.select(F.when(F.col("doc_id") != 300, F.col("ids")).alias("ids"), "doc_id").coalesce(1)
    back = {r.doc_id: r.t for r in ids.select("doc_id", scan.decoded(F.col("ids"), PIECES).alias("t")).collect()}
    assert back == {i: None if i == 300 else scan.normalised(t) for i, t in enumerate(texts)}
