"""A scan over ordered rows, for groups of any length: summarise blocks, link them, finish them.

A block is 2**bits neighbouring positions of a group. Rows move once, on (group, block); both the
summaries and the finished rows are made from that exchange. A summary is one small row. Summaries
of a group are walked in order, as a stream with a constant state, to tell every block what it
needs to know of the rows before it; that reaches the blocks in a third, small exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BITS = 16  # 65,536 rows of a block; a few megabytes in a task
BLOCK = "_block"


def tagged(df: DataFrame, pos: str, bits: int = BITS) -> DataFrame:
    return df.withColumn(BLOCK, F.shiftright(F.col(pos).cast("long"), bits))


def in_order(table: pa.Table, pos: str) -> pa.Table:
    return table.sort_by(pos)


def scan(
    df: DataFrame,
    group: str,
    pos: str,
    summarise: Callable[[pa.Table], dict],
    link: Callable[[dict | None, dict], tuple[dict, dict]],
    finish: Callable[[pa.Table, dict], pa.Table],
    told: str,
    carried: str,
    made: str,
    bits: int = BITS,
) -> DataFrame:
    """The columns of `df` and those named in `made`.

    `summarise` makes the fields of `told` from the ordered rows of a block. `link(state, summary)`
    gets the state before a block, None at the first, and gives what the block is handed (fields
    of `carried`) and the state after it. `finish` gets the ordered rows and what was handed on.
    """
    keys = f"{group} {df.schema[group].dataType.simpleString()}, {BLOCK} long"
    wide = tagged(df, pos, bits)
    names = [group, BLOCK]

    def one(rows: pa.Table) -> pa.Table:
        first = {k: rows[k][0].as_py() for k in names}
        return pa.Table.from_pylist([first | summarise(in_order(rows, pos))], summary_schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row[group] != current:
                    current, state = row[group], None
                given, state = link(state, row)
                out.append({k: row[k] for k in names} | given)
            yield pa.RecordBatch.from_pylist(out, carry_schema)

    def done(rows: pa.Table, carry: pa.Table) -> pa.Table:
        rows = finish(in_order(rows, pos), carry.to_pylist()[0])
        return rows.drop_columns([BLOCK])

    spark = df.sparkSession
    empty = lambda fields: spark.createDataFrame([], f"{keys}, {fields}").schema
    summary_schema, carry_schema = to_arrow_schema(empty(told)), to_arrow_schema(empty(carried))
    summaries = wide.groupBy(*names).applyInArrow(one, empty(told))
    links = summaries.repartition(group).sortWithinPartitions(*names).mapInArrow(walk, empty(carried))
    result = StructType([*df.schema.fields, *spark.createDataFrame([], made).schema.fields])
    return wide.groupBy(*names).cogroup(links.groupBy(*names)).applyInArrow(done, result)
