"""Line-first cleaning: rules judge single lines, failed lines go, and a document that loses too
much of its text is rejected.

Everything is one projection of DataFrame functions: no shuffle, no Python, no state beyond one
row. Repeated word windows are found by sorting one long per window, so a very long text costs
n log n.

Null and empty texts have no words and are rejected; repeated rows are judged alike; an empty
table gives an empty table; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import SPACE, bind, table, words

# ── fixed values ─────────────────────────────────────────────────────────────────────────
SYMBOLS = "#*$%&|<>"
SENTENCE_END = "[.!?\\u2026\\u3002\\uFF01\\uFF1F](?:[\"'\\u2019\\u201D)\\]»]*)(?:\\s|$)"
NAVIGATION = (
    "(?i)^\\s*(?:home|menu|next|previous|back to top|skip to (?:main )?content|log ?in|sign (?:in|up)"
    "|read more|share(?: this)?|print|search|contact us|about us|site ?map)\\s*[.:>»]*\\s*$"
)
BOILERPLATE = (
    "(?i)lorem ipsum|all rights reserved|cookie policy|privacy policy|terms of (?:use|service)"
    "|enable javascript|click here|subscribe to our|released under the [\\w .-]* licen[cs]e"
)
SEPARATORS = "[|»•·>]"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict on the document."""

    separators: int = 3  # a line with this many separators ...
    separator_share: float = 0.15  # ... and this share of its words is navigation
    symbol_share: float = 0.3  # words that end in a symbol
    repeat_share: float = 0.4  # words equal to the word before
    upper_share: float = 0.7  # upper-case letters among letters ...
    upper_letters: int = 40  # ... in lines with this many letters
    short_line: int = 3  # lines up to this many words need no sentence end
    keep_share: float = 0.5  # a document must keep this share of its characters


PLACE_BITS = 20  # windows of up to a million words carry their place in the low bits of the hash


def repeated_words(w: Column, n: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array column `w`.

    Windows are sorted as longs: hash in the high bits, place in the low ones. Neighbours with
    equal hash are compared word by word; should any differ, or the text be too long for the
    place bits, the windows themselves are sorted instead.
    """
    mask = (1 << PLACE_BITS) - 1

    def window(i: Column) -> Column:
        return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def covered(places: Column) -> Column:
        """Words under windows that start at the given ascending places."""
        return bind(places, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)).cast("int"))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ))

    starts = F.slice(w, F.lit(1), n - 2)
    packed = F.sort_array(F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(~mask).bitwiseOR(i.cast("long"))))

    def high(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def place(x: Column) -> Column:
        return x.bitwiseAND(mask).cast("int")

    def by_hash(s: Column) -> Column:
        same = F.filter(s, lambda x, j: (high(F.get(s, j - 1).bitwiseXOR(x)) == 0) | (high(F.get(s, j + 1).bitwiseXOR(x)) == 0))
        return bind(same, lambda t: F.when(
            F.exists(F.transform(t, lambda x, j: F.struct(x.alias("x"), F.get(t, j - 1).alias("y"))),
                     lambda p: p.y.isNotNull() & (high(p.x) == high(p.y)) & (window(place(p.x)) != window(place(p.y)))),
            by_text(),
        ).otherwise(covered(F.sort_array(F.transform(t, place)))))

    def by_text() -> Column:
        rows = F.sort_array(F.transform(starts, lambda x, i: F.struct(window(i).alias("w"), i.alias("i"))))
        return bind(rows, lambda s: covered(F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1).w == x.w, F.lit(False)) | F.coalesce(F.get(s, j + 1).w == x.w, F.lit(False))),
            lambda x: x.i,
        ))))

    return F.when(n < 3, F.lit(0).cast("long")).when(n - 2 > mask, by_text()).otherwise(bind(packed, by_hash))


def line_fault(line: Column, rules: LineRules) -> Column:
    """The name of the first rule that a line breaks, or null. Blank lines break none."""
    letters = F.regexp_replace(line, "\\P{L}+", "")

    def judged(w: Column) -> Column:
        n = F.size(w)
        ends = F.regexp_count(line, F.lit(f"[{SYMBOLS}](?=\\s|$)"))
        again = F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))
        parts = F.regexp_count(line, F.lit(SEPARATORS))
        upper = bind(letters, lambda t: (F.length(t) >= rules.upper_letters) & (F.length(F.regexp_replace(t, "\\P{Lu}+", "")) > rules.upper_share * F.length(t)))
        return (
            F.when(n == 0, F.lit(None).cast("string"))
            .when(line.rlike(NAVIGATION) | ((parts >= rules.separators) & (parts > rules.separator_share * n)), "navigation")
            .when(line.rlike(BOILERPLATE), "boilerplate")
            .when(ends > rules.symbol_share * n, "symbols")
            .when(again > rules.repeat_share * n, "repetition")
            .when(upper, "shouting")
            .when((n > rules.short_line) & ~line.rlike(SENTENCE_END), "punctuation")
        )

    return bind(words(line), judged)


def assess(text: Column, rules: LineRules = LineRules()) -> list[tuple[str, Column]]:
    """Steps of columns; each may use the ones before it. Names start with `_q_`."""
    t, w, n = F.col("_q_t"), F.col("_q_w"), F.col("_q_n")
    lines, faults = F.col("_q_lines"), F.col("_q_faults")
    with_words = F.filter(lines, lambda x: F.length(F.trim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    clean = F.transform(
        F.filter(F.arrays_zip(lines.alias("l"), faults.alias("f")), lambda z: z.f.isNull()), lambda z: z.l
    )
    chars = F.length(F.array_join(w, ""))
    kept_chars = F.length(F.regexp_replace(F.col("_q_clean"), SPACE, ""))
    return [
        ("_q_t", F.coalesce(text, F.lit(""))),
        ("_q_w", words(t)),
        ("_q_n", F.size(w)),
        ("_q_lines", F.split(t, "\n")),
        ("_q_chars", chars),
        ("_q_symbols", F.regexp_count(t, F.lit(f"[{SYMBOLS}]"))),
        ("_q_dup", bind(with_words, lambda x: F.size(x) - F.size(F.array_distinct(x)))),
        ("_q_repeat", repeated_words(w, n)),
        ("_q_faults", F.transform(lines, lambda x: line_fault(x, rules))),
        ("_q_clean", F.array_join(clean, "\n")),
        ("_q_left", kept_chars),
    ]


def clean_documents(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """(row, quality): the input row as a struct and the assessment as a struct.

    `quality` holds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_bad_lines, faults (array of the broken rules), clean_text, kept_chars and kept.
    A document is kept if it passes the base rules and its clean lines hold at least
    `rules.keep_share` of its characters other than white space.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    steps = assess(F.col("_row").getField(text), rules)
    for wave in ([0], [1, 3, 5], [2, 4, 6], [7, 8], [9], [10]):
        df = df.withColumns({steps[i][0]: steps[i][1] for i in wave})
    n, chars = F.col("_q_n"), F.col("_q_chars")
    failed = (n < 50) | (F.col("_q_repeat") * 100 > n * 50)
    broken = F.filter(F.col("_q_faults"), lambda f: f.isNotNull())
    quality = F.struct(
        n.cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        F.col("_q_symbols").cast("long").alias("n_symbols"),
        F.col("_q_dup").cast("long").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        F.size(broken).cast("long").alias("n_bad_lines"),
        F.array_sort(F.array_distinct(broken)).alias("faults"),
        F.col("_q_clean").alias("clean_text"),
        F.col("_q_left").cast("long").alias("kept_chars"),
        (~failed & (F.col("_q_left") >= rules.keep_share * chars)).alias("kept"),
    )
    # A generator ends the plan: a caller's filter on the verdict must not be copied down into the
    # steps, where it would put whole array expressions in the place of their computed columns.
    return df.select(F.col("_row").alias("row"), F.explode_outer(F.array(quality)).alias("quality"))


def op2_quality_rules(spark, sf: str) -> DataFrame:
    """One row per document: base counts, and the verdict of the line rules."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_bad_lines")
    return clean_documents(docs).select("row.doc_id", *[q.getField(c).alias(c) for c in names])
