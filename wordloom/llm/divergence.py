"""Divergence of sources within a language, by hash-consed segment trees over term ids.

Texts are counted as bytes inside the tasks (whole texts, one dictionary per task, handed on before
it grows too large), so a frequent word costs one row per task and source. Terms in enough
documents of their language are kept: counting, keeping and joining share one shuffle. A kept term
hashes to a block, and its id there follows from falling count, which gathers the rare ones in
subtrees that are mostly zero.

Every block of term ids is a complete binary tree per group, its leaves the group's counts. Equal
subtrees, of one group or of several, share one node: a node is the pair of its children's nodes.
Two trees are walked together from the roots down, one level at a time for many pairs of groups at
once. A pair of nodes met again on its level, as are all zero subtrees, is only counted; its
descendants are visited and priced once. Leaf pairs give the price in both directions from two counts and the
groups' totals, in whole numbers; blocks add up to the value of the pair.

Groups are dealt to tiles of at most about `GROUPS` groups, and a task compares two tiles within one
block. Its memory is bounded by tile and block, whatever the number of terms, sources or documents.
The work over pairs of sources is what the result asks for; one row per pair and block is shuffled.

Defined cases: null text, language and source read as ''. A document counts once per row, with
repeated and null keys alike. Empty texts have no terms but make their group. A language without
kept terms prices every pair at 0. Equal values rank by item in UTF-8 order. An empty table gives an
empty table. Very long texts are counted like others; one text's dictionary must fit its task.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table

UNIT = 1_000_000_000  # probabilities are whole numbers of this
MIN_DOCS = 3
TOP = 200
LEAVES = 4096  # term ids of one block
GROUPS = 64  # groups of one tile
PAIRS = 256  # pairs of groups walked at a time
HELD = 400_000  # counted terms a task holds before it hands them on

# What is no letter becomes a space, A-Z become a-z, bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

GROUP, _GROUP = "", b""  # in place of a term: the row that stands for the group itself

_COUNTED = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) sums of a task; every group also has a row of its own."""
    times: dict[tuple[str, str], Counter] = {}
    texts: dict[tuple[str, str], Counter] = {}
    held = 0

    def out():
        for (lang, source), n in times.items():
            d, k = texts[lang, source], len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                    pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                    pa.array(list(map(d.__getitem__, n)), pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        times.clear()
        texts.clear()

    for batch in batches:
        for text, lang, source in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            group = lang, source
            if group not in times:
                times[group], texts[group] = Counter({_GROUP: 0}), Counter()
            n, d = times[group], texts[group]
            before = len(n)
            found = text.as_buffer().to_pybytes().translate(_FOLD).split()
            n.update(found)
            d.update(set(found))
            d[_GROUP] += 1
            held += len(n) - before
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, lang_n, head): how often each group uses each term that is in enough
    documents of its language, and how often the language does; `head` is set on one row of a term.
    Every group has a row with the term GROUP.
    """
    blank = F.lit("")
    read = docs.select(
        F.coalesce(F.col(f"`{text}`"), blank).cast("binary"), F.coalesce(F.col(f"`{lang}`"), blank), F.coalesce(F.col(f"`{source}`"), blank)
    ).toDF("text", "lang", "source")
    # Tasks have summed up already. What follows finds its rows together: one exchange for it all.
    dealt = read.mapInArrow(_count, _COUNTED).repartition("lang", "term")
    counted = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = W.partitionBy("lang", "term")
    whole = counted.select(
        "lang", "source", "term", "n", F.sum("n").over(every).alias("lang_n"), F.sum("docs").over(every).alias("docs"),
        (F.col("source") == F.min("source").over(every)).alias("head"),
    )
    return whole.where((F.col("docs") >= min_docs) | (F.col("term") == GROUP)).drop("docs")


def consed(counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Trees over the rows of `counts` (groups x leaves, a power of two).

    The values of the leaf nodes, the nodes of each level above as rows of (left, right) node
    numbers of the level below, and every group's root. Equal subtrees are one node.
    """
    leaves, at = np.unique(counts, return_inverse=True)
    at = at.reshape(counts.shape)
    levels = []
    width = len(leaves)
    while at.shape[1] > 1:
        nodes, at_next = np.unique(at[:, 0::2] * width + at[:, 1::2], return_inverse=True)
        levels.append(np.stack([nodes // width, nodes % width], axis=1))
        at, width = at_next.reshape(at.shape[0], -1), len(nodes)
    return levels, leaves, at[:, 0]


def leaf_pairs(levels: list[np.ndarray], n_leaves: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
    """Walk pairs of trees from their roots: (pair, left leaf, right leaf, times), pairs ascending.

    A pair of nodes is visited once per level and pair of trees; how often it was met rides along.
    """
    pair, a, b = np.arange(len(left)), left, right
    times = np.ones(len(left), np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        below = len(levels[depth - 1]) if depth else n_leaves
        nodes = levels[depth]
        # Both children of every pair, each packed into one number.
        met = np.concatenate([(pair * below + nodes[a, side]) * below + nodes[b, side] for side in (0, 1)])
        met, where = np.unique(met, return_inverse=True)
        total = np.zeros(len(met), np.int64)
        np.add.at(total, where, np.concatenate([times, times]))
        pair, a, b, times = met // (below * below), met // below % below, met % below, total
    return pair, a, b, times


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), exact for any size of count."""
    if len(counts) and counts.max() >= 2**62 // UNIT:
        return np.array([1 + UNIT * (int(c) + 1) // int(t) for c, t in zip(counts, totals)], np.int64)
    return 1 + UNIT * (counts + 1) // totals


def prices(counts: np.ndarray, totals: np.ndarray, left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The summed prices of the given pairs of groups over one block, in both directions.

    `counts` is groups x terms (`width` of them); `totals` holds each group's N + V.
    """
    full = 1 << max(0, (width - 1).bit_length())
    padded = np.full((len(counts), full), -1, np.int64)  # -1: no term, priced at nothing
    padded[:, :width] = counts
    levels, leaves, roots = consed(padded)
    there, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for lo in range(0, len(left), PAIRS):
        l, r = left[lo : lo + PAIRS], right[lo : lo + PAIRS]
        pair, a, b, times = leaf_pairs(levels, len(leaves), roots[l], roots[r])
        real = leaves[a] >= 0
        pair, a, b, times = pair[real], leaves[a[real]], leaves[b[real]], times[real]
        p, q = shares(a, totals[l][pair]), shares(b, totals[r][pair])
        gap = (p - q) * (p - q)
        np.add.at(there, lo + pair, gap // q * times)
        np.add.at(back, lo + pair, gap // p * times)
    return there, back


_PRICED = "lang string, source string, item string, value long"


def _compare(key: tuple, rows: pa.Table) -> pa.Table:
    """Price the pairs of groups of two tiles within one block of terms.

    Rows are counts (term, n, lang_n) or, with the term GROUP, groups (n: total, lang_n: how many
    terms the block holds, tile).
    """
    lang, _, one, other = (k.as_py() for k in key)
    n, lang_n, tiles = (rows[c].to_numpy() for c in ("n", "lang_n", "tile"))
    names, who = _numbered(rows["source"])
    terms, term = _numbered(rows["term"])
    head = term == (terms.index(GROUP) if GROUP in terms else -1)
    heads, body = np.flatnonzero(head), np.flatnonzero(~head)
    of = np.full(len(names), -1)
    of[who[heads]] = np.arange(len(heads))
    totals, tile, width = n[heads], tiles[heads], int(lang_n[heads[0]])
    # Ids follow falling count; terms that no group here uses come last, they are alike.
    often = np.zeros(len(terms), np.int64)
    often[term[body]] = lang_n[body]
    place = np.empty(len(terms), np.int64)
    place[np.lexsort((np.arange(len(terms)), -often))] = np.arange(len(terms))
    counts = np.zeros((len(heads), width), np.int64)
    counts[of[who[body]], place[term[body]]] = n[body]
    left, right = np.triu_indices(len(heads), 1)
    if one != other:  # pairs within a tile have a task of their own
        across = tile[left] != tile[right]
        left, right = left[across], right[across]
    there, back = prices(counts, totals, left, right, width)
    said = np.array([names[i] for i in who[heads]], object)
    return pa.table(
        {
            "lang": pa.array([lang] * (2 * len(left)), pa.string()),
            "source": pa.array(np.concatenate([said[left], said[right]]), pa.string()),
            "item": pa.array(np.concatenate([said[right], said[left]]), pa.string()),
            "value": pa.array(np.concatenate([there, back]), pa.int64()),
        }
    )


def _numbered(column: pa.ChunkedArray) -> tuple[list, np.ndarray]:
    """The distinct values of a column, and the number of each row's value."""
    made = column.combine_chunks().dictionary_encode()
    made = made if isinstance(made, pa.DictionaryArray) else made.combine_chunks()
    return made.dictionary.to_pylist(), made.indices.to_numpy()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, leaves: int = LEAVES, groups: int = GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair`, how far each other source of the
    language is from the group; part `term`, the terms the group uses most above its language."""
    known = stored(kept_counts(docs, min_docs), "kept-counts")
    own = F.col("term") != GROUP
    # One row per language: how many terms, occurrences, blocks and tiles it has.
    sizes = known.groupBy("lang").agg(
        F.count_if(own & F.col("head")).alias("v"), F.sum(F.when(own, F.col("n")).otherwise(0)).alias("all_n"), F.count_if(~own).alias("s")
    )
    sizes = stored(
        sizes.select("lang", "v", "all_n", F.ceil(F.col("v") / leaves).cast("int").alias("blocks"), F.ceil(F.col("s") / groups).cast("int").alias("tiles")),
        "languages",
    )
    totals = known.groupBy("lang", "source").agg(F.sum(F.when(own, F.col("n")).otherwise(0)).alias("own")).join(sizes, "lang")
    totals = totals.select(
        "lang", "source", (F.col("own") + F.col("v")).alias("total"), "v", "all_n", "tiles", "blocks",
        F.pmod(F.xxhash64("source"), "tiles").cast("int").alias("tile"),
    )
    totals = stored(totals, "groups")
    return _pairs(known.where(own), totals, sizes).unionByName(_terms(known.where(own), totals, top))


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(known: DataFrame, totals: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language, with the price over all kept terms."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    widths = known.where("head").join(sizes.select("lang", "blocks"), "lang").select("lang", block)
    widths = widths.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("width"))
    # How many terms a block holds comes with the groups, which are in every block of their language.
    heads = totals.where("v > 0").join(widths, "lang")
    heads = heads.select("lang", "block", "source", "tile", "tiles", F.lit(GROUP).alias("term"), F.col("total").alias("n"), F.col("width").alias("lang_n"))
    body = known.join(totals.select("lang", "source", "tile", "tiles", "blocks"), ["lang", "source"])
    body = body.select("lang", block, "source", "tile", "tiles", "term", "n", "lang_n")
    met = heads.unionByName(body).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.select(
        "lang", "block", F.least("tile", "with").alias("one"), F.greatest("tile", "with").alias("other"), "source", "tile", "term", "n", "lang_n"
    )
    priced = met.groupBy("lang", "block", "one", "other").applyInArrow(_compare, _PRICED)
    priced = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Without kept terms there is nothing to sum.
    bare = totals.where("v = 0").select("lang", "source")
    bare = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    return _ranked(priced.unionByName(bare.withColumn("value", F.lit(0).cast("long"))), "pair")


def _terms(known: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The kept terms that a group uses above its language, up to rank `top`."""

    def share(n: str, total: Column) -> Column:
        wide = F.lit(UNIT).cast("decimal(20,0)") * (F.col(n) + 1).cast("decimal(18,0)")
        return F.lit(1) + F.call_function("div", wide, total)

    joined = known.join(totals.select("lang", "source", "total", "v", "all_n"), ["lang", "source"])
    p, q = share("n", F.col("total").cast("decimal(20,0)")), share("lang_n", (F.col("all_n") + F.col("v")).cast("decimal(20,0)"))
    used = joined.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    priced = used.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    return _ranked(priced, "term").where(F.col("rank") <= top)


def op13_source_divergence_audit(spark, sf: str) -> DataFrame:
    """Every source of every language: its distance to the others, and its 200 most telling terms."""
    return divergence(table(spark, sf, "documents"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT k, lang, source,
         unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM d
),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT k) AS docs FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS all_n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n, kept.lang_n
      FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS own FROM x GROUP BY ALL),
p AS (SELECT x.lang, x.source, x.term, x.n, 1 + (1000000000::HUGEINT * (x.n + 1)) // (t.own + v) AS p,
             1 + (1000000000::HUGEINT * (x.lang_n + 1)) // (all_n + v) AS q
      FROM x JOIN t USING (lang, source) JOIN langs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT l.lang, l.source, r.source AS item, sum((l.p - r.p) * (l.p - r.p) // r.p) AS value
             FROM p l JOIN p r ON l.lang = r.lang AND l.term = r.term AND l.source <> r.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
