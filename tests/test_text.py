import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from wordloom.functions.text import accent_tables, expanding_letters, portable, strip_accents, tokens, trimmed
from wordloom.params import CONVERSATIONAL, DEFAULT, TECHNICAL, Encoding, get_encoding, list_encodings, register_encoding

# Adversarial texts.
EDGE = [
    "caf\xe9 na\xefve",
    "café résumé",
    "İstanbul",
    "ΟΔΟΣ Σ",
    "x\xb2 ١٢ Ⅷ",
    "a\xa0b c​d\x1ce\x85f",
    "don't stop 'x' it's",
    "end. 3.14 foo.bar a . b",
    "snake_case hy-phen -- -",
    "\U0001f600 ok! 你好。",
    "한국",
    "हिन्दी",
    "",
    "  \n\t",
]


def plain(text, enc):
    """What a token is, said the long way: isolate, split, keep."""
    if enc.strip_accents:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    text = text.lower() if enc.lowercase else text
    pieces = re.sub(enc.token_pattern, r" \1 ", text).split()
    return [p for p in pieces if p in enc.keep_punctuation or re.fullmatch(r"[\w\-]+", p)]


def run(spark, texts, enc):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = rows.select("i", tokens(F.col("text"), enc).alias("t")).collect()
    return [r["t"] for r in sorted(got)]


@pytest.mark.parametrize("enc", [DEFAULT, CONVERSATIONAL, TECHNICAL.updated(strip_accents=False), TECHNICAL])
def test_edge_texts(spark, enc):
    assert run(spark, EDGE, enc) == [plain(t, enc) for t in EDGE]


def test_known_losses(spark):
    assert run(spark, ["don't stop 'x' it's"], CONVERSATIONAL) == [["stop"]]
    assert run(spark, ["end. 3.14 foo.bar a . b"], TECHNICAL) == [["a", ".", "b"]]
    assert run(spark, ["résumé"], DEFAULT) == [["re", "sume"]]


def test_custom_punctuation_takes_the_long_way(spark):
    enc = DEFAULT.updated(keep_punctuation=["-", ".", "→"])
    assert run(spark, ["a-b - c. → x!"], enc) == [plain("a-b - c. → x!", enc)]


@settings(max_examples=5, deadline=None)
@given(hs.lists(hs.text(alphabet="aB\xe9 .,-_'!\n3ß", max_size=30), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    for enc in (DEFAULT, CONVERSATIONAL, TECHNICAL):
        assert run(spark, texts, enc) == [plain(t, enc) for t in texts]


def test_accents(spark):
    source, target = accent_tables()
    assert len(source) == len(target) > 1000
    assert len(expanding_letters()) > 40
    texts = ["\xc9\xe0 \ud55c\uad6d \u1e69", "".join(expanding_letters()), "\uac00\ud7a3 plain", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = {r.i: r for r in df.select("i", strip_accents(F.col("t")).alias("a"), trimmed(F.lit("\xa0 x \n")).alias("c")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")
        assert rows[i]["a"] == want
    assert rows[0]["c"] == "x"


def test_technical_preset_decomposes(spark):
    text = "\ud55c\uad6d Stra\xdfe caf\xe9 " + " ".join(expanding_letters())
    assert run(spark, [text], TECHNICAL) == [plain(text, TECHNICAL)]


def test_portable():
    assert portable(r"([^\w\s\-])").startswith(r"([^\p{L}\p{N}_")
    assert portable(r"\w+") == r"[\p{L}\p{N}_]+"


def test_registry():
    register_encoding("mine", DEFAULT.updated(min_frequency=2))
    assert get_encoding("mine").name == "mine" and get_encoding("mine").min_frequency == 2
    assert {"default", "conversational", "technical", "mine"} <= {e["name"] for e in list_encodings()}
    with pytest.raises(KeyError):
        get_encoding("none")


@pytest.mark.parametrize(
    "bad",
    [
        {"min_frequency": 0},
        {"max_vocab_size": 0},
        {"max_vocab_size": 4},
        {"unk_threshold": 1.5},
        {"seq_length": 0},
        {"dataset_rows": -1},
        {"special_tokens": {"pad": "<PAD>"}},
    ],
)
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        DEFAULT.updated(**bad).check()


def test_settings_round_trip():
    with pytest.raises(KeyError):
        DEFAULT.updated(colour="red")
    assert Encoding.from_dict({**TECHNICAL.to_dict(), "extra": 1}) == TECHNICAL
    assert Encoding.from_stored(None, 7).min_frequency == 7
    assert DEFAULT.merged({"min_frequency": 30}).check() == ["min_frequency 30 drops most words"]
    assert len(DEFAULT.updated(max_vocab_size=10).check()) == 1
