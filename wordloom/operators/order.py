"""Order-dependent building blocks that never put a whole order, or a whole run, in one task.

Spark rows have no order, so every operator takes an explicit LONG order key. Work over an
order is cut into blocks of the key; a block holds a bounded number of rows whatever the data
look like, blocks are hashed over the cluster, and only one small row per block takes part in
the step that links blocks together. Everything is deterministic: a lost executor recomputes
the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.session import checkpoint

BLOCK_BITS = 12  # 4,096 positions per block of a dense order
LINK_BITS = 16  # 65,536 positions per block where blocks are linked in order
KEY_BITS = 16  # at most 65,536 unique keys per block of a sparse order
LEVEL_BITS = 16  # at most 65,536 rows per window task on every level of linked blocks
WIDTH = 64  # bits of a key

_START = W.unboundedPreceding


def _local(how: str, col: Column) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max}[how](col) if how != "last" else F.last(col, True)


def _join(how: str, earlier: Column, later: Column) -> Column:
    if how == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(later, F.lit(0))
    if how == "last":
        return F.coalesce(later, earlier)
    return (F.least if how == "min" else F.greatest)(earlier, later)


def known_key(key: Column) -> Column:
    """The order key; a null has no place in an order and stops the job."""
    return F.when(key.isNull(), F.raise_error(F.lit("an order key is null")).cast("long")).otherwise(key.cast("long"))


def _before(blocks: DataFrame, group: Sequence[str], block: str, hows: dict[str, str], width: int = WIDTH) -> DataFrame:
    """For one row per block: each column combined over all earlier blocks of its group.

    Blocks are linked inside parents of 65,536 neighbours, parents inside theirs, and so on, until
    the blocks of every group fit one window task: known from their count, or from the `width` of
    block numbers in bits. However sparse the keys are, no task holds more rows than that.
    """
    g = list(group)
    if width > LEVEL_BITS:
        blocks = checkpoint(blocks)
        most = blocks.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    if width <= LEVEL_BITS or most <= 1 << LEVEL_BITS:
        here = W.partitionBy(*g).orderBy(block).rowsBetween(_START, -1)
        over = {c: _local(h, F.col(c)).over(here) for c, h in hows.items()}
        return blocks.select(*g, block, *[(F.coalesce(over[c], F.lit(0)) if h == "sum" else over[c]).alias(c) for c, h in hows.items()])
    up = f"_p{width}"
    tagged = blocks.withColumn(up, F.shiftright(block, LEVEL_BITS))
    inside = W.partitionBy(*g, up).orderBy(block).rowsBetween(_START, -1)
    local = tagged.select(*g, up, block, *[_local(h, F.col(c)).over(inside).alias(c) for c, h in hows.items()])
    parents = tagged.groupBy(*g, up).agg(
        *[
            (F.max_by(c, F.when(F.col(c).isNotNull(), F.col(block))) if h == "last" else _local(h, F.col(c))).alias(c)
            for c, h in hows.items()
        ]
    )
    above = _before(parents, g, up, hows, width - LEVEL_BITS)
    above = above.withColumnsRenamed({c: f"_up_{c}" for c in hows})
    return local.join(above, [*g, up]).select(
        *g, block, *[_join(h, F.col("_up_" + c), F.col(c)).alias(c) for c, h in hows.items()]
    )


def positional_index(
    df: DataFrame,
    key: str,
    group: Sequence[str] = (),
    out: str = "idx",
    tie: Sequence[str] = (),
    bits: int = KEY_BITS,
) -> DataFrame:
    """Dense 0-based position of every row in the order (key, *tie) of its group.

    `key` is a LONG that is unique within the group, or nearly so: a block holds the rows of
    2**bits neighbouring keys. The rows move once, on (group, block); the window and the join
    with the block offsets share that exchange.
    """
    g = list(group)
    tagged = df.withColumn("_b", F.shiftright(known_key(F.col(key)), bits))
    counts = tagged.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _before(counts, g, "_b", {"_n": "sum"}, WIDTH - bits)
    here = W.partitionBy(*g, "_b").orderBy(key, *tie)
    return (
        tagged.withColumn("_r", F.row_number().over(here))
        .join(offsets, [*g, "_b"])
        .withColumn(out, (F.col("_n") + F.col("_r") - 1).cast("long"))
        .drop("_b", "_n", "_r")
    )


def key_at_rank(df: DataFrame, key: str, rank, tie: Sequence[str] = ()) -> DataFrame:
    """The place (one row, or none) that has `rank` rows before it: the key, or with ties the
    struct of key and ties.

    Reads only these columns: block counts find the block, and only that block is ordered.
    Cutting a table at a rank this way is a plain filter, so the wide rows are neither sorted nor
    moved. `rank` is a number or a scalar column. A null key stops the job, and so does a cut
    that would fall between rows equal in key and ties.
    """
    place = F.struct(key, *tie) if tie else F.col(key)
    keys = df.select(place.alias("_k"), F.shiftright(known_key(F.col(key)), KEY_BITS).alias("_b"))
    counts = keys.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    ends = counts.join(_before(counts, (), "_b", {"_n": "sum"}, WIDTH - KEY_BITS).withColumnRenamed("_n", "_o"), "_b")
    rank = rank if isinstance(rank, Column) else F.lit(rank)
    hit = ends.withColumn("_rank", rank).where("_o <= _rank and _rank < _o + _n")
    hit = hit.select("_b", "_o", "_rank")
    # `hit` is one row and selects the rows of at most 2**KEY_BITS keys.
    here = W.partitionBy("_b").orderBy("_k")
    at = keys.join(F.broadcast(hit), "_b").select(
        "_k", "_rank", (F.col("_o") + F.row_number().over(here) - 1).alias("_i"), (F.col("_o") + F.rank().over(here) - 1).alias("_first")
    )
    told = F.raise_error(F.lit("rows at the cut share their order key")).cast("boolean")
    unique = F.when(F.col("_first") < F.col("_rank"), told).otherwise(F.lit(True))
    return at.where("_i = _rank").where(unique).select(F.col("_k").alias(key))


def before(df: DataFrame, key: str, rank, tie: Sequence[str] = ()) -> Column:
    """True for the first `rank` rows in the order (key, *tie)."""
    cut = key_at_rank(df, key, rank, tie).scalar()
    return cut.isNull() | ((F.struct(key, *tie) if tie else F.col(key)) < cut)


def first_rows(df: DataFrame, key: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows in the order (key, *tie), as a filter."""
    return df.where(before(df, key, n, tie))


def running(
    df: DataFrame,
    group: Sequence[str],
    pos: str,
    specs: dict[str, tuple[Column, str]],
    bits: int = LINK_BITS,
    inclusive: bool = True,
) -> DataFrame:
    """Running sum / min / max / last-known value from the start of each group.

    `specs` maps an output name to (column, how). `pos` is a dense LONG position (gaps are
    fine, many rows on one position are not). A row sees everything before it, and itself if
    `inclusive`. One row per block, a 65,536th of the group, is linked in order, level by level;
    the rows themselves move once, on (group, block).
    """
    g = list(group)
    ins = {f"_in{i}": (out, how) for i, (out, (_, how)) in enumerate(specs.items())}
    tagged = df.withColumns({n: c for n, (c, _) in zip(ins, specs.values())}).withColumn(
        "_b", F.shiftright(F.col(pos), bits)
    )
    blocks = tagged.groupBy(*g, "_b").agg(
        *[
            (F.max_by(n, F.when(F.col(n).isNotNull(), F.col(pos))) if h == "last" else _local(h, F.col(n))).alias(n)
            for n, (_, h) in ins.items()
        ]
    )
    carry = _before(blocks, g, "_b", {n: h for n, (_, h) in ins.items()}, WIDTH - bits)
    carry = carry.withColumnsRenamed({n: "_c" + n for n in ins})
    here = W.partitionBy(*g, "_b").orderBy(pos).rowsBetween(_START, 0 if inclusive else -1)
    local = tagged.withColumns({"_l" + n: _local(h, F.col(n)).over(here) for n, (_, h) in ins.items()})
    joined = local.join(carry, [*g, "_b"]).withColumns(
        {out: _join(h, F.col("_c" + n), F.col("_l" + n)) for n, (out, h) in ins.items()}
    )
    return joined.drop("_b", *ins, *["_c" + n for n in ins], *["_l" + n for n in ins])


def asof_backward(left: DataFrame, right: DataFrame, group: Sequence[str], on: str, values: Sequence[str]) -> DataFrame:
    """For each left row the latest right `values` recorded at a strictly smaller `on`.

    Both sides are laid on one order and the last known values are carried forward, so there
    is no range join and no row pairing.
    """
    g = list(group)
    empty = {"_v_" + v: F.lit(None).cast(right.schema[v].dataType) for v in values}
    # On equal positions the left row comes first: it does not see a value recorded there.
    probe = left.withColumns({"_o": F.col(on) * 2, "_q": F.lit(True), **empty})
    marks = right.select(
        *g, (F.col(on) * 2 + 1).alias("_o"), F.lit(False).alias("_q"), *[F.col(v).alias("_v_" + v) for v in values]
    )
    both = probe.unionByName(marks, allowMissingColumns=True)
    filled = running(both, g, "_o", {v: (F.col("_v_" + v), "last") for v in values}, bits=LINK_BITS + 1)
    return filled.where("_q").select(*left.columns, *values)


def rolling(
    df: DataFrame,
    group: Sequence[str],
    pos: str,
    lookback: int,
    exprs: Callable[[Callable[[int, int], W]], dict[str, Column]],
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Fixed row frames over a dense position, for groups of any length.

    Each block also gets the last `lookback` rows of the block before it, so a frame reaching
    back up to `lookback` rows is complete inside its block and one long group spreads over
    many tasks. `exprs` receives a frame maker `f(start, end)` and returns the new columns.
    """
    size = 1 << bits
    if lookback >= size:
        raise ValueError(f"a frame of {lookback} rows needs blocks larger than {size}")
    g = list(group)
    own = F.shiftright(F.col(pos), bits)
    spill = F.col(pos) % size >= size - lookback
    homes = F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_home", F.explode_outer(homes))
    part = W.partitionBy(*g, "_home").orderBy(pos)
    made = exprs(lambda start, end: part.rowsBetween(start, end))
    return spread.withColumns(made).where(F.col("_home") == own).drop("_home")
