"""Readers that bring six row shapes to one schema of training examples.

Examples are (ex_id, kind, prompt, response, text): `pair` rows fill prompt and response,
`text` rows fill text. Every input carries its own LONG order key, because the row cap, the
split and the vocabulary order depend on it. Nulls count as empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from wordloom.functions.text import trimmed
from wordloom.operators.order import first_rows

# Shapes in order of precedence, and the answer columns in order of preference.
SHAPES = ("messages", "instruction", "preference", "qa", "text", "fallback")
ANSWERS = ("prediction", "answer", "extracted_answer", "gold")


def read_texts(spark, path: str, n: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) of a Parquet corpus, optionally its first `n` rows; other columns are not read.

    A session may ask for its scans to be dealt out (`wordloom.scan.partitions`), as one on a
    single machine does whose small files have one row group; unset, texts are not moved.
    """
    df = spark.read.parquet(path).select(key, text)
    df = df if n is None else first_rows(df, key, n)
    dealt = spark.conf.get("wordloom.scan.partitions", None)
    return df.repartition(int(dealt), key) if dealt else df


def read_rows(spark, path: str, fmt: str = "parquet", n: int | None = None, key: str = "ex_id", schema=None) -> DataFrame:
    """Rows of any shape, optionally capped before any of them is rejected."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if n is None else first_rows(df, key, n)


def detect_shape(columns: Sequence[str]) -> str:
    """The shape of a data set from its column names."""
    has = set(columns).__contains__
    if has("messages"):
        return "messages"
    if has("instruction") and has("output"):
        return "instruction"
    if has("chosen") or has("prompt"):
        return "preference"
    if has("question") and any(map(has, ANSWERS)):
        return "qa"
    return "text" if has("text") else "fallback"


def row_shape(json_text: Column) -> Column:
    """The same decision per row of mixed JSON lines."""
    keys = F.json_object_keys(json_text)

    def has(name):
        return F.array_contains(keys, name)

    answered = has(ANSWERS[0])
    for name in ANSWERS[1:]:
        answered = answered | has(name)
    return (
        F.when(has("messages"), "messages")
        .when(has("instruction") & has("output"), "instruction")
        .when(has("chosen") | has("prompt"), "preference")
        .when(has("question") & answered, "qa")
        .when(has("text"), "text")
        .otherwise("fallback")
    )


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _pairs(df: DataFrame, key: str, prompt: Column, response: Column) -> DataFrame:
    rows = df.select(
        F.col(key).alias("ex_id"),
        F.lit("pair").alias("kind"),
        prompt.alias("prompt"),
        response.alias("response"),
        F.lit(None).cast("string").alias("text"),
    )
    return rows.where("prompt <> '' and response <> ''")


def _texts(df: DataFrame, key: str, text: Column, keep: Column) -> DataFrame:
    return df.where(keep).select(
        F.col(key).alias("ex_id"),
        F.lit("text").alias("kind"),
        F.lit(None).cast("string").alias("prompt"),
        F.lit(None).cast("string").alias("response"),
        text.alias("text"),
    )


def _struct_fields(df: DataFrame, name: str) -> list[str]:
    t = df.schema[name].dataType
    inside = t.elementType if isinstance(t, ArrayType) else None
    return inside.names if isinstance(inside, StructType) else []


def normalize_messages(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """Content and reasoning of every message in turn, joined by a space."""
    fields = [f for f in ("content", "reasoning") if f in _struct_fields(df, "messages")]
    parts = F.flatten(F.transform("messages", lambda m: F.array(*[m[f] for f in fields])))
    said = F.filter(parts, lambda p: p.isNotNull() & (p != ""))
    return _texts(df, key, F.array_join(said, " "), F.size(said) > 0)


def normalize_instruction(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """Instruction plus input, if any, as the prompt; output as the response."""
    instruction = _text(F.col("instruction"))
    prompt = instruction
    if "input" in df.columns:
        extra = _text(F.col("input"))
        prompt = F.when(extra != "", trimmed(F.concat_ws(" ", instruction, extra))).otherwise(instruction)
    return _pairs(df, key, prompt, _text(F.col("output")))


def _side(df: DataFrame, name: str) -> Column:
    """A preference side: a string, or the contents of a list of messages."""
    if name not in df.columns:
        return F.lit("")
    if "content" in _struct_fields(df, name):
        return _text(F.array_join(F.transform(name, lambda m: _text(m["content"])), " "))
    return _text(F.col(name).cast("string"))


def normalize_preference(df: DataFrame, key: str = "ex_id") -> DataFrame:
    return _pairs(df, key, _side(df, "prompt"), _side(df, "chosen"))


def normalize_qa(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """The question, and the first answer column that is not empty."""
    present = [F.nullif(F.col(a).cast("string"), F.lit("")) for a in ANSWERS if a in df.columns]
    return _pairs(df, key, _text(F.col("question").cast("string")), F.coalesce(*present, F.lit("")))


def normalize_text(df: DataFrame, key: str = "ex_id") -> DataFrame:
    return _texts(df, key, F.col("text"), F.coalesce(F.col("text") != "", F.lit(False)))


def normalize_fallback(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """Every string column, and content/value of every list of structs, in column order."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            parts.append(F.array(f.name))
            continue
        inside = _struct_fields(df, f.name)
        field = next((n for n in ("content", "value") if n in inside), None)
        if field:
            said = F.transform(F.col(f"{f.name}.{field}").cast("array<string>"), _text)
            parts.append(F.coalesce(said, F.array().cast("array<string>")))
    if not parts:
        return _texts(df, key, F.lit(""), F.lit(False))
    found = F.filter(F.concat(*parts), lambda p: p.isNotNull())
    return _texts(df, key, F.array_join(found, " "), F.size(found) > 0)


_NORMALIZERS = {
    "messages": normalize_messages,
    "instruction": normalize_instruction,
    "preference": normalize_preference,
    "qa": normalize_qa,
    "text": normalize_text,
    "fallback": normalize_fallback,
}


def normalize(df: DataFrame, key: str = "ex_id", shape: str | None = None) -> DataFrame:
    """Training examples from rows of one shape, detected from the columns unless given."""
    columns = [c for c in df.columns if c != key]
    return _NORMALIZERS[shape or detect_shape(columns)](df, key)


def read_json_lines(spark, path: str) -> DataFrame:
    """(js): the lines of JSON files, whatever shapes they mix."""
    return spark.read.text(path).select(F.col("value").alias("js"))


def normalize_mixed(lines: DataFrame, js: str = "js", key: str = "ex_id") -> DataFrame:
    """Training examples (with their `shape`) from JSON lines of all six shapes in one scan.

    A line is parsed once, into a VARIANT; its keys decide its shape, and its fields are taken out as
    that shape needs them. `key` is the field with the order key. The rules are those of the
    normalisers above, applied to a row instead of a table: a field counts as a list of messages
    where it is one in this row. Lines that are no JSON object are left out.
    """
    v, shape = F.col("_v"), F.col("shape")

    def field(name: str, kind: str = "string") -> Column:
        return F.try_variant_get(v, f"$.{name}", kind)

    def side(name: str) -> Column:
        listed = field(name, "array<struct<content:string>>")
        said = F.array_join(F.transform(listed, lambda m: _text(m["content"])), " ")
        return F.when(listed.isNotNull(), said).otherwise(_text(field(name)))

    messages = F.flatten(F.transform(field("messages", "array<struct<content:string,reasoning:string>>"), lambda m: F.array(m["content"], m["reasoning"])))
    said = F.filter(messages, lambda p: p.isNotNull() & (p != ""))
    instruction, extra = _text(field("instruction")), _text(field("input"))
    asked = F.when(extra != "", trimmed(F.concat_ws(" ", instruction, extra))).otherwise(instruction)
    answer = F.coalesce(*[F.nullif(field(a), F.lit("")) for a in ANSWERS], F.lit(""))

    def parts(name: Column) -> Column:
        """The texts in one field: a string, or the contents of a list of objects."""
        value = F.element_at(F.col("_all"), name)
        listed = F.try_variant_get(value, "$", "array<struct<content:string,value:string>>")
        lists = F.transform(F.filter(listed, lambda m: m.isNotNull()), lambda m: F.coalesce(m["content"], m["value"], F.lit("")))
        return F.when(F.schema_of_variant(value) == "STRING", F.array(F.try_variant_get(value, "$", "string"))).otherwise(F.coalesce(lists, F.array().cast("array<string>")))

    found = F.flatten(F.transform("_keys", parts))
    rows = lines.select(F.try_parse_json(js).alias("_v"), F.json_object_keys(js).alias("_keys"), row_shape(F.col(js)).alias("shape"))
    rows = rows.where("_keys is not null").withColumn("_all", F.try_variant_get("_v", "$", "map<string,variant>"))
    pair, text = shape.isin("instruction", "preference", "qa"), F.when(shape == "messages", F.array_join(said, " "))
    text = text.when(shape == "text", field("text")).when(shape == "fallback", F.array_join(found, " "))
    made = rows.select(
        field(key, "long").alias("ex_id"),
        "shape",
        F.when(pair, "pair").otherwise("text").alias("kind"),
        F.when(shape == "instruction", asked).when(shape == "preference", side("prompt")).when(shape == "qa", _text(field("question"))).alias("prompt"),
        F.when(shape == "instruction", _text(field("output"))).when(shape == "preference", side("chosen")).when(shape == "qa", answer).alias("response"),
        text.alias("text"),
        F.when(shape == "fallback", F.size(found) > 0).otherwise(True).alias("_any"),
    )
    whole = (F.col("prompt") != "") & (F.col("response") != "")
    kept = F.when(F.col("kind") == "pair", whole).when(shape == "fallback", F.col("_any")).otherwise(F.coalesce(F.col("text"), F.lit("")) != "")
    return made.where(kept).drop("_any")


def flatten_for_vocab(examples: DataFrame) -> DataFrame:
    """(flat_id, ex_id, side, text): prompt before response, plain texts as they are.

    `flat_id` keeps the order of (ex_id, side) in one LONG.
    """
    pair = F.array(
        F.struct(F.lit(0).alias("side"), F.col("prompt").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("response").alias("text")),
    )
    single = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")))
    rows = examples.select("ex_id", F.explode_outer(F.when(F.col("kind") == "pair", pair).otherwise(single)).alias("_s"))
    return rows.select((F.col("ex_id") * 2 + F.col("_s.side")).alias("flat_id"), "ex_id", "_s.side", "_s.text")
