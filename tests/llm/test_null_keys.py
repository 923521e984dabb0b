"""Near duplicates among rows that have no key."""

from wordloom.llm import simhash as sh


def null_rows(spark):
    rows = [(5, None, "x"), (3, "", "y"), (9, " ", "z"), (9, " ", "z"), (7, "a b c d", None), (8, "A b c d", None), (None, "a b c d", None)]
    rows += [(None, "alone in the world", "n"), (None, "Alone in the world", "n"), (4, "one more", "m"), (4, "one more", "m")]
    return spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(3)


def check_null_rows(spark, keep_one):
    df = null_rows(spark)
    kept = keep_one(df)
    assert kept.columns == df.columns and keep_one(df.limit(0)).count() == 0
    got = sorted((r.doc_id or -1, (r.text or "").lower()) for r in kept.collect())
    assert got == [(-1, "alone in the world"), (3, ""), (4, "one more"), (4, "one more"), (7, "a b c d")]


def test_rows_without_a_key_stay_unless_linked(spark):
    check_null_rows(spark, sh.keep_one)


def test_a_fingerprint_without_a_key_connects(spark, monkeypatch):
    monkeypatch.setattr(sh, "fingerprints", lambda text, width=3: text.cast("long"))
    df = spark.createDataFrame([(1, "0"), (None, "7"), (2, "63"), (None, "4611686018427387903")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component or -1) for r in sh.near_duplicates(df).collect()) == [(-1, -1), (-1, 1), (1, 1), (2, 1)]
