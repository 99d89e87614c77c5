"""Column profiles that add up: mergeable sketches per batch, profiles of any set of batches, and renamed columns found by their values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of the sketches: 2**HLL registers, quantiles of rank error about 1.7 / KLL, 2**THETA kept hashes.
HLL, KLL, THETA = 14, 400, 12

_SKETCHED = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("row_count", T.LongType()), T.StructField("present", T.LongType()),
    T.StructField("least", T.StringType()), T.StructField("most", T.StringType()), T.StructField("distinct", T.BinaryType()),
    T.StructField("ranks", T.BinaryType()), T.StructField("hashes", T.BinaryType()),
])


def _sortable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def profile_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and per value of ``by``, such as a batch): counts and sketches of its values.

    One pass with map-side combination; a sketch has a fixed size, whatever the number of rows. ``ranks`` is there for
    numbers only. Values are told apart by their text. An empty table has no group where ``by`` is given.
    """
    names = [c for c in (columns or df.columns) if c not in by]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    parts = []
    for i, c in enumerate(names):
        kind = df.schema[c].dataType
        text = F.col(c).cast("string")
        aggregates += [F.count(F.col(c)).alias(f"n{i}"), F.hll_sketch_agg(text, HLL).alias(f"d{i}"), F.theta_sketch_agg(text, THETA).alias(f"h{i}")]
        least = most = ranks = F.lit(None)
        if _sortable(kind):
            aggregates += [F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"m{i}")]
            least, most = F.col(f"l{i}"), F.col(f"m{i}")
        if isinstance(kind, T.NumericType):
            number = F.col(c).cast("double")
            aggregates.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), KLL).alias(f"k{i}"))
            ranks = F.col(f"k{i}")
        parts.append(F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"n{i}").alias("present"), least.cast("string").alias("least"),
                              most.cast("string").alias("most"), F.col(f"d{i}").alias("distinct"), ranks.cast("binary").alias("ranks"), F.col(f"h{i}").alias("hashes")))
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*parts)))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several batches as those of all their rows. Least and greatest values are those of single batches' texts and are left out."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("present").alias("present"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"), F.theta_union_agg("hashes").alias("hashes"))


def profile_of(sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profiles as ``quality.profile`` gives them, with quantiles of numbers, from sketches alone."""
    rows, present = F.col("row_count"), F.col("present")

    def share(part: Column) -> Column:
        return F.round(part.cast("double") / F.nullif(rows, F.lit(0)).cast("double"), 6)

    ranked = F.col("ranks").isNotNull() & (F.coalesce(F.kll_sketch_get_n_double("ranks"), F.lit(0)) > 0)
    values = [F.when(ranked, F.kll_sketch_get_quantile_double("ranks", F.lit(float(q)))).alias(f"q{round(q * 100):02d}") for q in quantiles]
    return sketches.select(*by, "column_name", rows.alias("row_count"), (rows - present).alias("null_count"),
                           F.hll_sketch_estimate("distinct").alias("distinct_values"), share(rows - present).alias("null_rate"), share(present).alias("completeness"), *values)


# --- renamed columns ------------------------------------------------------------------------------


def value_overlap(known: DataFrame, arriving: DataFrame) -> DataFrame:
    """(known, arriving, overlap) of each column of one table of sketches with each of another: the estimated share of distinct values
    that both have among those that either has. One row per pair of columns; columns without values overlap with none."""
    a = known.filter("present > 0").select(F.col("column_name").alias("known"), F.col("hashes").alias("_a"))
    b = arriving.filter("present > 0").select(F.col("column_name").alias("arriving"), F.col("hashes").alias("_b"))
    either = F.theta_sketch_estimate(F.theta_union("_a", "_b", THETA)).cast("double")
    both = F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).cast("double")
    return a.crossJoin(b).select("known", "arriving", F.round(both / F.nullif(either, F.lit(0.0)), 4).alias("overlap"))


def renamed_columns(known: DataFrame, arriving: DataFrame, least: float = 0.5) -> dict[str, tuple[str, float]]:
    """Known column -> (arriving column, overlap) for columns that seem to have been renamed.

    ``known`` and ``arriving`` are sketches. Only columns that one side lacks are compared, and each is matched once at most, so that the
    sum of the overlaps of the matched pairs is the largest; pairs below ``least`` are never matched. The driver sees names and overlaps only.
    """
    names = [{r[0] for r in x.select("column_name").distinct().collect()} for x in (known, arriving)]  # columns of a schema
    gone, come = sorted(names[0] - names[1]), sorted(names[1] - names[0])
    if not gone or not come:
        return {}
    pairs = value_overlap(known.filter(F.col("column_name").isin(gone)), arriving.filter(F.col("column_name").isin(come))).filter(F.col("overlap") >= least)
    weight = {(r["known"], r["arriving"]): r["overlap"] for r in pairs.collect()}
    return {a: (b, weight[a, b]) for a, b in _assigned(weight).items()}


def _assigned(weight: dict[tuple[str, str], float]) -> dict[str, str]:
    """The matching of largest total weight, by the Hungarian method; schemas are small."""
    left, right = sorted({a for a, _ in weight}), sorted({b for _, b in weight})
    if not weight:
        return {}
    n, m = len(left), max(len(left), len(right))
    cost = [[-weight.get((a, right[j]), 0.0) if j < len(right) else 0.0 for j in range(m)] for a in left]
    of_row, of_column = [0.0] * n, [0.0] * m
    holder: list[int | None] = [None] * m  # row of each column
    for row in range(n):
        slack, through = [float("inf")] * m, [-1] * m
        done: list[int] = []
        here, at = row, -1
        while True:
            free = [j for j in range(m) if j not in done]
            for j in free:
                value = cost[here][j] - of_row[here] - of_column[j]
                if value < slack[j] - 1e-15:
                    slack[j], through[j] = value, at
            nearest = min(free, key=lambda j: slack[j])
            step = slack[nearest]
            of_row[row] += step
            for j in done:
                of_row[holder[j]] += step
                of_column[j] -= step
            for j in free:
                slack[j] -= step
            done.append(nearest)
            at = nearest
            if holder[nearest] is None:
                break
            here = holder[nearest]
        while at >= 0:  # hand the columns along the way on
            before = through[at]
            holder[at] = row if before < 0 else holder[before]
            at = before
    return {left[i]: right[j] for j, i in enumerate(holder) if i is not None and j < len(right) and (left[i], right[j]) in weight}
