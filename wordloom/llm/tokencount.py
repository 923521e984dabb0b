"""Token counts by rank-synchronous array merging.

A batch of texts is cut into pre-tokens. The distinct new ones of the batch lie as one ragged
numpy array of symbol ids; in each round every pre-token finds its own lowest-ranked adjacent pair
and merges it, all pre-tokens at once, until none has a pair left. A token count is the number of
symbols that survive. Counts of pre-tokens are remembered up to a documented bound.

Null and empty texts have no tokens. Repeated rows are counted alike, long texts are cut into
pre-tokens piece by piece, an empty table gives an empty table, and other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import table

MEMORY = 200_000  # remembered pre-tokens per Python worker
GROUP = 1_000_000  # characters cut into pre-tokens before their counts are looked up
LONG = 64  # longer pre-tokens are merged, but not remembered


class PairTable:
    """Rank and product of symbol pairs, found by hashing: slots of equal hash are layers."""

    BITS = 20

    def __init__(self, pairs: np.ndarray):
        self.keys = pairs[:, 0] << 20 | pairs[:, 1]
        self.made = pairs[:, 2]
        self.layers, left = [], np.arange(len(pairs))
        while len(left):
            slot = self._slot(self.keys[left])
            layer = np.full(1 << self.BITS, -1, np.int32)
            layer[slot[::-1]] = left[::-1]
            self.layers.append(layer)
            left = left[layer[slot] != left]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, key: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the number of pairs if there is none."""
        slot = self._slot(key)
        none = len(self.keys)
        out = np.full(len(key), none, np.int32)
        todo = np.arange(len(key))
        for layer in self.layers:
            at = layer[slot[todo]]
            hit = at >= 0
            todo, at = todo[hit], at[hit]
            if not len(todo):
                break
            same = self.keys[at] == key[todo]
            out[todo[same]] = at[same]
            todo = todo[~same]
        return out


class ByteMerges:
    """The merges of a byte-level BPE file, applied to many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.spec, vocab, suffix = spec, model["vocab"], model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs = PairTable(np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64))
        self.byte = np.array([vocab[c] for c in _byte_letters()], np.int64)
        self.last = np.array([vocab[c + suffix] for c in _byte_letters()], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that survive all merges, piece after piece, and how many each piece has.

        In every round each piece merges its own lowest-ranked pair. Pieces without one are
        finished and leave the arrays.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbol = self.byte[raw]
        ends = np.cumsum(sizes[sizes > 0]) - 1
        symbol[ends] = self.last[raw[ends]]
        none = len(self.pairs.keys)
        rank = np.full(len(symbol), none, np.int32)
        if len(symbol) > 1:
            rank[:-1] = self.pairs.ranks(symbol[:-1] << 20 | symbol[1:])
            rank[ends] = none
        done = []
        while len(symbol):
            first = np.empty(len(symbol), bool)
            first[0] = True
            np.not_equal(owner[1:], owner[:-1], out=first[1:])
            starts = np.flatnonzero(first)
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(symbol)))
            live = best < none
            if not live.all():
                stay = np.repeat(live, size)
                done.append((owner[~stay], symbol[~stay]))
                owner, symbol, rank = owner[stay], symbol[stay], rank[stay]
                best, size = best[live], size[live]
                if not len(symbol):
                    break
            run = np.flatnonzero(rank == np.repeat(best, size))
            # Equal neighbouring pairs overlap (a a a): within a run every second one merges.
            if len(run) > 1 and (np.diff(run) == 1).any():
                at = np.arange(len(run))
                begins = np.maximum.accumulate(np.where(np.append(True, np.diff(run) > 1), at, 0))
                run = run[(at - begins) % 2 == 0]
            symbol[run] = self.pairs.made[rank[run]]
            keep = np.ones(len(symbol), bool)
            keep[run + 1] = False
            shift = run - np.arange(len(run))  # where the merged symbols are afterwards
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            last = np.append(owner[1:] != owner[:-1], True)
            # Only pairs that touch a merged symbol have a new rank.
            touched = np.zeros(len(symbol), bool)
            touched[shift] = True
            touched[shift[shift > 0] - 1] = True
            touched = np.flatnonzero(touched)
            fresh = np.full(len(touched), none, np.int32)
            inner = ~last[touched]
            t = touched[inner]
            fresh[inner] = self.pairs.ranks(symbol[t] << 20 | symbol[t + 1])
            rank[touched] = fresh
        owners = np.concatenate([o for o, _ in done]) if done else np.empty(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(pieces))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def merges(path: str) -> ByteMerges:
    return ByteMerges(path)


class Counter:
    """Counts tokens of texts, group by group, with a bounded memory of pre-tokens."""

    def __init__(self, table: ByteMerges, memory: int = MEMORY):
        if table.spec["pre_tokenizer"]["type"] != "ByteLevel" or table.spec["normalizer"]:
            raise ValueError("the file cuts texts by other rules")
        self.table, self.memory, self.known = table, memory, {}
        self.pattern = regex.compile(public_tokenizers.PATTERN)

    def _pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of pre-tokens, and the number of special strings."""
        spans = [text] if text else []
        if spans and self.table.split is not None:
            spans = self.table.split.split(text)
            yield len(spans) - 1
        for span in spans:
            if len(span) <= GROUP:
                yield self.pattern.findall(span)
            else:
                found = (m.group() for m in self.pattern.finditer(span))
                while part := list(islice(found, GROUP // 4)):
                    yield part

    def _lookup(self, pieces: list[list[str]]) -> dict[str, int]:
        """The counts of all pre-tokens in `pieces`; new ones are merged together."""
        wanted = set().union(*pieces)
        new = [p for p in wanted if p not in self.known]
        found = {}
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            found.update(zip(part, self.table.merged([p.encode() for p in part])[1].tolist()))
        short = {p: n for p, n in found.items() if len(p) <= LONG}
        found.update((p, self.known[p]) for p in wanted if p in self.known)
        if len(self.known) + len(short) > self.memory:
            self.known = {}
        if len(short) <= self.memory:
            self.known.update(short)
        return found

    def count(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        group, size = [], 0

        def settle():
            if group:
                get = self._lookup([p for _, p in group]).__getitem__
                for i, pieces in group:
                    totals[i] += sum(map(get, pieces))
                group.clear()

        for i, text in enumerate(texts):
            for part in self._pieces(text or ""):
                if isinstance(part, int):
                    totals[i] += part
                    continue
                group.append((i, part))
                size += len(part)
                if size >= GROUP // 4:
                    settle()
                    size = 0
        settle()
        return totals


def token_counts(text: Column, path: str) -> Column:
    """Tokens of each text as the byte-level BPE file at `path` cuts it; special strings in a
    text count as one token each, none are added."""
    kept: list[Counter] = []

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Counter(merges(path)))
        return pa.array(kept[0].count(texts.to_pylist()), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row of `docs`; null texts count as empty."""
    n = token_counts(F.col(text), path)
    counted = docs.select(key, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark, sf: str) -> DataFrame:
    """One row per document: bytes, tokens, and whether it exceeds 1,024 tokens."""
    return count_tokens(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
