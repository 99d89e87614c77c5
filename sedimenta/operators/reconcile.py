"""Exact reconciliation of two tables whose cost follows their differences: invertible Bloom lookup tables.

Every row falls into three cells, one of each third of a small table of cells. A cell adds up how many rows it got and the 32-bit words of
their hashes; rows of one side count as 1, rows of the other as -1, so equal rows cancel out and only differences are left. A
cell that holds copies of one row only gives that row's hash away; taking it out of its other two cells may leave further such cells.
When none is left over, all differing rows are known by hash, and only these are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as fn
from . import parity
from .checkpoints import held

THIRDS = 3
WORDS = ("w0", "w1", "w2", "w3", "check")
#: Cells of a table, enough for some 40,000 differing rows.
CELLS = 3 * 2**14


def _halves(*hashes: Column) -> list[Column]:
    return [half for x in hashes for half in fn.hash_halves(x)]


def _words(high: Column, low: Column) -> list[Column]:
    """A row's hash as four words, and a word that the four decide."""
    return [*_halves(high, low), fn.hash_halves(F.xxhash64(high, low))[1]]


def _cells_of(high: Column, low: Column, cells: int) -> Column:
    third = cells // THIRDS
    return F.array(*[F.pmod(F.xxhash64(high, low, F.lit(j)), F.lit(third)) + F.lit(j * third) for j in range(THIRDS)])


def row_hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_high`` and ``_low``: 128 bits over ``columns``, NULLs and separators told apart."""
    digest = fn.row_digest(list(columns))
    return df.withColumns({"_high": F.xxhash64(digest), "_low": F.xxhash64(F.lit(1), digest)})


def _totals(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(w).alias(w) for w in WORDS])
    return found.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in ("n", *WORDS)]))


def _spread(items: DataFrame, cells: int) -> DataFrame:
    """Rows (_high, _low, n) as additions to their cells."""
    words = [(x * F.col("n")).alias(w) for w, x in zip(WORDS, _words(F.col("_high"), F.col("_low")))]
    return items.select(F.explode(_cells_of(F.col("_high"), F.col("_low"), cells)).alias("cell"), "n", *words)


def sketch(df: DataFrame, columns: Sequence[str], cells: int = CELLS, sign: int = 1) -> DataFrame:
    """The non-zero cells of a table's rows, whatever its size at most ``cells`` rows.

    Formed with map-side combination: a task sends one row per cell. A cell may get up to 2**31 rows.
    """
    return _totals(_spread(row_hashes(df, columns).select("_high", "_low", F.lit(sign).cast("bigint").alias("n")), cells))


def subtracted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells of the first table less those of the second. Both must have the same number of cells."""
    less = right.select("cell", *[(-F.col(c)).alias(c) for c in ("n", *WORDS)])
    return _totals(left.unionByName(less))


def given_away(cells: DataFrame, size: int) -> DataFrame:
    """(_high, _low, n) of each row that some cell holds alone, ``n`` times more on the first side than on the second."""
    copies = {w: F.expr(f"{w} DIV nullif(n, 0)") for w in WORDS}
    whole = reduce(lambda a, b: a & b, [(F.col(w) == copies[w] * F.col("n")) & copies[w].between(0, 2**32 - 1) for w in WORDS])
    word = {w: x for w, x in copies.items()}
    high, low = (F.shiftleft(word[a], 32).bitwiseOR(word[b]) for a, b in (("w0", "w1"), ("w2", "w3")))
    alone = cells.filter(F.coalesce(whole, F.lit(False))).select("cell", "n", high.alias("_high"), low.alias("_low"), word["check"].alias("check"))
    checked = (F.col("check") == _words(F.col("_high"), F.col("_low"))[-1]) & F.array_contains(_cells_of(F.col("_high"), F.col("_low"), size), F.col("cell"))
    return alone.filter(checked).select("_high", "_low", "n").distinct()


def peeled(cells: DataFrame, size: int) -> tuple[DataFrame, bool]:
    """(rows found, whether these are all): takes rows out of the cells until none is left or none holds a row alone.

    Every step works on at most ``size`` rows; there are about as many as the logarithm of that.
    """
    cells = held(cells)
    found: list[DataFrame] = []
    while True:
        alone = held(given_away(cells, size))
        if alone.isEmpty():
            break
        found.append(alone)
        taken = _spread(alone.select("_high", "_low", (-F.col("n")).alias("n")), size)
        cells = held(_totals(cells.unionByName(taken)))
    rows = reduce(DataFrame.unionByName, found) if found else _none(cells.sparkSession)
    # A row can turn up in two steps when a mistaken find was put right.
    rows = rows.groupBy("_high", "_low").agg(F.sum("n").alias("n")).filter("n <> 0")
    return rows, cells.isEmpty()


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "_high bigint, _low bigint, n bigint")


def row_hash_diff(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None, *,
                  cells: int = CELLS) -> DataFrame:
    """What ``parity.row_hash_diff`` gives, with a shuffle that follows the differences instead of the tables.

    Both tables are read twice: once for their cells, once for the rows whose hashes were found, which alone are counted. With
    more differing rows than the cells can tell (about 0.8 of their number) the whole tables are compared. Tables are compared
    as multisets, so repeated rows count.
    """
    if cells < THIRDS or cells % THIRDS:
        raise ValueError(f"the number of cells must be a multiple of {THIRDS}")
    columns = list(columns or left.columns)
    used = list(dict.fromkeys([*keys, *columns]))
    found, whole = peeled(subtracted(sketch(left, used, cells), sketch(right, used, cells)), cells)
    if not whole:
        return parity.row_hash_diff(left, right, keys, columns)
    hashes = found.select("_high", "_low")
    sides = [row_hashes(side.select(*used), used).join(hashes, ["_high", "_low"], "left_semi").select(*used) for side in (left, right)]
    return parity.row_hash_diff(*sides, keys, columns)
