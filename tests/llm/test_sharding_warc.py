import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordloom.llm import sharding, warc
from wordloom.session import scratch_path

# ── sharding ─────────────────────────────────────────────────────────────────────────────


def test_place_follows_the_dot_product():
    rnd = np.random.default_rng(1)
    sizes, room = rnd.random((200, 3)) / 100, np.ones((5, 3))
    left, want = room.copy(), [0] * 200
    for i in np.argsort(-sizes.sum(1), kind="stable"):
        want[i] = max(range(5), key=lambda b: (round(float(left[b] @ sizes[i]), 12), -b))
        left[want[i]] -= sizes[i]
    assert sharding.place(sizes, room, (1, 1, 1)).tolist() == want


def check_shards(rows, texts, shards=40):
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    size, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    by_key = dict(texts)
    import zlib

    for r in rows:
        raw = (by_key[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < shards
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[raw].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size, homes


def test_balance_with_a_group_of_a_third_of_all_rows(spark):
    rnd = random.Random(5)
    texts = [(i, "copy " * 30 if i % 3 == 0 else "w" * rnd.randint(20, 400) + str(i // 2)) for i in range(9000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    size, homes = check_shards(sharding.shard(df).collect(), texts)
    mean = sum(size.values()) / 40
    assert len(size) == 40 and max(size.values()) < 1.02 * mean and min(size.values()) > 0.98 * mean
    assert all(len(h) == 1 for raw, h in homes.items() if not raw.startswith(b"copy"))


def test_shard_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "long " * 20000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, shard int")
    check_shards(sharding.shard(df).collect(), texts)
    assert sharding.shard(df.limit(0)).count() == 0


def test_buckets_do_not_change_the_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 400)
    texts = [(i, "w" * random.Random(i).randint(20, 400) + str(i)) for i in range(4000)]
    size, _ = check_shards(sharding.shard(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts)
    mean = sum(size.values()) / 40
    assert max(size.values()) < 1.05 * mean and min(size.values()) > 0.95 * mean


# ── archives ─────────────────────────────────────────────────────────────────────────────


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = [
    (4, "http://a/", "<p>x</p>"), (2, "http://b/é\r\n", "<p>x</p>"), (9, None, None), (7, "u", ""), (5, "v", "WARC/1.1 \x1f\x8b\x08 inside"),
    (6, "w", "한국 " * 9000), (6, "w", "한국 " * 9000), (None, "n", "<p>x</p>"), (None, "m", "own"),
]


@pytest.mark.parametrize("size", [1, 500, 8_000_000])
def test_round_trip(spark, size):
    path = scratch_path(spark, "t-warc")
    warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2), path, size=size)
    rows = warc.read_archives(spark, path).collect()
    assert all(r.gap_bytes is None for r in rows)
    by_type = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows)
    x, k = b"<p>x</p>", ("한국 " * 9000).encode()
    odd = PAGES[4][2].encode()
    assert by_type == Counter([
        (2, "response", None, len(x), digest(x)), (4, "revisit", 2, len(x), digest(x)), (None, "revisit", 2, len(x), digest(x)),
        (7, "response", None, 0, digest(b"")), (9, "revisit", 7, 0, digest(b"")), (5, "response", None, len(odd), digest(odd)),
        (6, "response", None, len(k), digest(k)), (6, "revisit", 6, len(k), digest(k)), (None, "response", None, 3, digest(b"own")),
    ])
    assert (6, k) in {(r.page_id, bytes(r.payload)) for r in rows if r.record_type == "response"}


def test_small_payloads_and_shuffled_repeats(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST", 0)
    path = scratch_path(spark, "t-warc")
    warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path, min_bytes=100)
    types = Counter(r.record_type for r in warc.read_archives(spark, path).collect())
    assert types == {"response": 8, "revisit": 1}


def test_empty_table(spark):
    path = scratch_path(spark, "t-warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def archive(n=6, plain=False):
    rnd = random.Random(3)
    made = [warc.record(i, f"http://{i}/", bytes(rnd.randrange(256) for _ in range(300)) + b"WARC/1.1\r\n" * (i % 2)) for i in range(n)]
    return made if plain else [warc.member(r) for r in made]


def pages_of(records):
    return [int(f["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")) for _, f in records]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage_after_damage(plain):
    parts = archive(plain=plain)
    whole = b"".join(parts)
    records, gaps = warc.salvage(whole)
    assert pages_of(records) == list(range(6)) and gaps == []
    start, end = len(b"".join(parts[:2])), len(b"".join(parts[:3]))
    for spot in (start, start + 15, (start + end) // 2, end - 6):
        hurt = bytearray(whole)
        hurt[spot] ^= 0x55
        records, gaps = warc.salvage(bytes(hurt))
        assert pages_of(records) == [0, 1, 3, 4, 5] and gaps == [(start, end - start)]
    # Junk in front, a record cut short at the end, and a hole in the middle.
    records, gaps = warc.salvage(b"junk" + whole[:-20])
    assert pages_of(records) == [0, 1, 2, 3, 4] and gaps[0] == (0, 4) and sum(n for _, n in gaps[1:]) == len(parts[5]) - 20
    records, gaps = warc.salvage(whole[: start + 10] + whole[end:])
    assert pages_of(records) == [0, 1, 3, 4, 5] and gaps == [(start, 10)]
    assert warc.salvage(b"") == ([], []) and warc.salvage(b"nothing here") == ([], [(0, 12)])


def test_padding_is_no_gap_and_members_are_gzip():
    parts = archive(2)
    records, gaps = warc.salvage(parts[0] + b"\0\0" + parts[1] + b"\0")
    assert pages_of(records) == [0, 1] and gaps == []
    assert gzip.decompress(b"".join(parts) + b"\0").count(b"WARC-Type: response") == 2


def test_gaps_are_rows(spark, tmp_path):
    parts = archive(3)
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"broken" + parts[2])
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in rows if r.gap_bytes is None) == [0, 2]
    assert [(r.at, r.gap_bytes) for r in rows if r.gap_bytes is not None] == [(len(parts[0]), 6)]


def test_whole_table(spark, sf):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = {r.page_id: tuple(r)[1:] for r in warc.op9_warc(spark, sf).collect()}
    assert got == {i: (len(p), digest(p), "response" if first[p] == i else "revisit", None if first[p] == i else first[p]) for i, p in pages.items()}


def test_long_urls(spark, tmp_path):
    url = "data:text/html," + "aé\x07" * 50_000
    df = spark.createDataFrame([(1, url, "<p>one</p>"), (2, "http://b", "two\r\n\r\n" + "x" * 100)], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"))
    rows = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(r.page_id for r in rows) == [1, 2] and all(r.gap_bytes is None for r in rows)
    plain = warc.record(1, url, b"one") + warc.record(2, url, b"two")
    records, gaps = warc.salvage(plain)
    assert [f["payload"] for _, f in records] == [b"one", b"two"] and not gaps
    broken = b"WARC/1.1\r\nWARC-Type: response\r\n" + plain
    records, gaps = warc.salvage(broken)
    assert [f["payload"] for _, f in records] == [b"one", b"two"] and gaps == [(0, len(broken) - len(plain))]


def test_a_gap_in_a_new_archive_stops_op9(spark, sf, monkeypatch):
    monkeypatch.setattr(warc, "read_archives", lambda spark, path: spark.sql(
        "select 'f' file, 0L at, 9L gap_bytes, 1L page_id, 0L payload_bytes, '' payload_digest, '' record_type, 1L refers_to"))
    with pytest.raises(Exception, match="unreadable bytes"):
        warc.op9_warc(spark, sf).collect()
