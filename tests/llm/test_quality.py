import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.llm import quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    spots = defaultdict(list)
    for i in range(len(w) - 2):
        spots[tuple(w[i : i + 3])].append(i)
    covered = {p + d for at in spots.values() if len(at) > 1 for p in at for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def texts():
    rnd = random.Random(1)
    pool = ["a", "b", "the", "Ünï", "x.", "#y", "z|", "\x0bq", "한국"]
    made = [None, "", " ", "\n\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "same\nsame\nsame", " x  y"]
    for n in (5, 60, 400):
        made += ["".join(rnd.choice(pool) + rnd.choice(" \n\t\r\x0c") for _ in range(n)) for _ in range(15)]
    return made + ["word " * 30000]


def frame(spark, made):
    return spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)


def test_base_counts(spark):
    made = texts()
    df = frame(spark, made)
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r.doc_id: tuple(r)[1:] for r in quality.clean_documents(df).select("row.doc_id", *[q[n].alias(n) for n in names]).collect()}
    assert got == {i: plain(t) for i, t in enumerate(made)}


@pytest.mark.parametrize("bits", [0, 2, 20])
def test_windows_of_any_number_and_hash(spark, bits, monkeypatch):
    """With few place bits the windows are sorted as texts instead; the counts are the same."""
    monkeypatch.setattr(quality, "PLACE_BITS", bits)
    made = texts()[:40]
    rows = quality.clean_documents(frame(spark, made)).select("row.doc_id", "quality.n_repeat_words").collect()
    assert {r.doc_id: r.n_repeat_words for r in rows} == {i: plain(t)[4] for i, t in enumerate(made)}


GOOD = "This line is a sentence with some words in it. Another one follows here, and it ends well."


@pytest.mark.parametrize(
    "line, rule",
    [
        (GOOD, None),
        ("", None),
        ("Home | News | Sports | Weather | Contact", "navigation"),
        ("Read more »", "navigation"),
        ("All rights reserved by the owner of this text.", "boilerplate"),
        ("These### words$$$ all### end%%% badly***", "symbols"),
        ("again again again again again words words words words.", "repetition"),
        ("THIS LINE SHOUTS AT EVERYBODY WHO IS NEAR ENOUGH TO READ IT.", "shouting"),
        ("a line of words that never comes to any end", "punctuation"),
        ("A heading", None),
        ("It ended. but goes on", None),
    ],
)
def test_line_rules(spark, line, rule):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(quality.line_fault(F.col("l"), quality.LineRules()).alias("f")).first().f == rule


def test_verdict_and_clean_text(spark):
    good = " ".join(f"word{i} goes here." for i in range(20))
    junk = "Home | News | Sports | Weather"
    rows = {0: f"{good}\n{junk}", 1: "\n".join([good.replace(".", "")] * 1 + [GOOD]), 2: good, 3: good}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.quality for r in quality.clean_documents(df).select("row.doc_id", "quality").collect()}
    assert got[0].kept and got[0].clean_text == good and got[0].faults == ["navigation"]
    assert not got[1].kept and not got[1].base_failed
    assert got[2].kept and got[2] == got[3]


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, GOOD, True, "w", 5)], "doc_id long, text string, kept boolean, _q_w string, quality int")
    made = quality.clean_documents(df).select("row.*")
    assert made.columns == df.columns and made.collect() == df.collect()
    assert quality.clean_documents(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = quality.op2_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
