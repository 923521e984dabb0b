"""The pipeline against plain Python, stage by stage, and its registration."""

import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline as cp
from test_quality import plain
from test_search_toxicity import plain_toxicity
from test_similar import grams, plain_groups
from test_tokens import check_packed
from wordloom.llm import quality, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf):
    from wordloom.llm.common import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    made = [docs]
    for name, stage in cp.STAGES:
        made.append(stored(stage(spark, made[-1], sf), f"t-{name}"))
    return made


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.schema.simpleString() == stages[0].schema.simpleString()
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "pii", "packing"]


def test_toxic_documents_go(spark, sf, stages):
    before, after = rows(stages[0]), rows(stages[1])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    sample = toxicity.fit(stages[0], spark.read.parquet(f"{sf}/labels.parquet")).keys.to_pylist()
    examples = [(k, labels[k], before[k].text) for k in sorted(sample)]
    totals = Counter(labels.values())
    made = plain_toxicity(examples, totals, [r.text for r in before.values()])
    assert set(after) == {i for i, (score, _, _) in zip(before, made) if score < 0.5}
    assert all(before[i] == r for i, r in after.items())


def test_rejected_documents_and_lines_go(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert not any(plain(before[i].text)[5] for i in after)
    for i, r in after.items():
        lines = before[i].text.split("\n")
        kept = r.text.split("\n")
        assert r.n_chars == len(r.text) and all(x in lines for x in kept)
    assert len(after) < len(before)
    rules = quality.LineRules()
    assert all(len(re.sub(r"\s", "", after[i].text)) >= rules.keep_share * len(re.sub(r"\s", "", before[i].text)) - 1 for i in after)


def test_one_of_each_group_stays(stages):
    found = plain_groups({i: grams(r.text) for i, r in rows(stages[2]).items()})
    assert set(rows(stages[3])) == {i for i, c in found.items() if i == c}


def test_personal_data_go(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for i, r in before.items():
        for m in re.finditer(r"[\w.]+@[\w.]+\w|AKIA\w{16}|\+1 \(\d{3}\) \d{3}-\d{4}", r.text):
            assert m.group() not in after[i].text


def test_sequences(spark, sf, stages):
    docs = {i: r.text for i, r in rows(stages[4]).items()}
    check_packed(stages[5].collect(), docs, 2048)
    got = cp.run(spark, sf).select("doc_id", "start", "length", "ids_crc32").collect()
    assert {r.doc_id for r in got} == set(docs)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_registered():
    import __spark_entry__ as e
    from wordloom.llm.queries import QUERIES

    names = e.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_stages_take_other_columns_nulls_and_empty_tables(spark, sf):
    df = spark.createDataFrame(
        [(1, None, "en", "s", 0, 1.5, "row"), (2, "", "en", None, None, None, None), (3, "Some words here. " * 40, "en", "s", 680, 2.0, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, score double, row string",
    )
    for docs in (df, df.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == df.columns
        assert docs.count() <= 1
