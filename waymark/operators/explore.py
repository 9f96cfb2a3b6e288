"""Exploratory statistics over many columns at once."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.ordered import WHOLE, ColumnRows, bin_of, column_quantile_table, column_sketches, column_values, distinct_edges, ranked, running, sketch_shares
from waymark.operators.stability import binned_counts, edge_table, reference_edges
from waymark.operators.tables import columns_of, level_counts, modal_share, null_share, value_counts
from waymark.session import pinned, written

#: Sums that a pair of columns needs, and the edge of the tiles they are merged in.
MOMENTS, TILE = ("rows", "x", "squares", "products", "infinite"), 256


def target_balance(df: DataFrame, target: str) -> DataFrame:
    counts = value_counts(df, target)
    return counts.select(target, F.col("n").alias("count"), F.bround(F.col("share") * 100, 2).alias("pct_%"))


def missing_summary(df: DataFrame) -> DataFrame:
    """Percent missing per column, most first."""
    return null_share(df).select("variavel", F.bround(F.col("share") * 100, 2).alias("%_missing")).orderBy(F.desc("%_missing"), "variavel")


def missing_table(df: DataFrame) -> DataFrame:
    """Rows, missing rows and percent, for the columns that miss any."""
    return null_share(df).filter("nulos > 0").select(
        "variavel", F.col("linhas").alias("volumetria"), F.col("nulos").alias("total_nulos"), (F.col("share") * 100).alias("perc_nulos")
    ).orderBy(F.desc("perc_nulos"), "variavel")


def _log_gamma(a: Column) -> Column:
    """Stirling's series for a + 8, carried back to a > 0."""
    z = a + 8
    series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    return series - F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0.0), lambda held, i: held + F.ln(a + i))


def upper_gamma_share(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function as a column expression, for a > 0.

    Its series for small x, its continued fraction (by Lentz's method) for
    large x, each by as many terms as a needs to reach full precision.
    """
    steps = F.sequence(F.lit(1), (F.lit(200) + 20 * F.ceil(F.sqrt(a))).cast("int"))
    scale = F.exp(-x + a * F.ln(x) - _log_gamma(a))
    first = F.struct((1 / a).alias("term"), (1 / a).alias("total"))
    series = F.aggregate(steps, first, lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"), (s["total"] + s["term"] * x / (a + i)).alias("total")), lambda s: s["total"])

    def next_fraction(s: Column, i: Column) -> Column:
        top, low = -i * (i - a), x + 1 - a + 2 * i
        d = 1 / (top * s["d"] + low)
        c = low + top / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    start = 1 / (x + 1 - a)
    fraction = F.aggregate(steps, F.struct(F.lit(1e300).alias("c"), start.alias("d"), start.alias("h")), next_fraction, lambda s: s["h"])
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, F.greatest(1 - series * scale, F.lit(0.0))).otherwise(fraction * scale)


def chi2_table(df: DataFrame, columns: list[str], target: str, min_freq: int = 10, correction: bool = True) -> DataFrame:
    """Chi-square statistic of each categorical column against a 0/1 target, rare levels merged.

    Nulls are left out. A table of one degree of freedom gets the continuity
    correction unless it is switched off.
    """
    classes = level_counts(df, columns, [target]).filter(F.col("nivel").isNotNull() & F.col(target).isin(0, 1))
    cells = classes.groupBy("variavel", "nivel").agg(
        F.sum("n").alias("r"), F.sum(F.when(F.col(target) == 1, F.col("n")).otherwise(0)).alias("o1")
    )
    name = F.when(F.col("r") < min_freq, F.lit("OTHER")).otherwise(F.col("nivel"))
    merged = cells.groupBy("variavel", name.alias("nivel")).agg(F.sum("r").alias("r"), F.sum("o1").alias("o1"))
    merged, _ = pinned(merged)
    totals = merged.groupBy("variavel").agg(F.sum("r").alias("n"), F.sum("o1").alias("c1"), (F.count(F.lit(1)) - 1).alias("dof"))
    wide = merged.join(totals, "variavel").filter((F.col("dof") >= 1) & (F.col("c1") > 0) & (F.col("c1") < F.col("n")))

    def part(seen: Column, expected: Column) -> Column:
        gap = F.abs(seen - expected)
        gap = F.when(F.col("dof") == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap) if correction else gap
        return gap * gap / expected

    e1 = F.col("r") * F.col("c1") / F.col("n")
    both = part(F.col("o1"), e1) + part(F.col("r") - F.col("o1"), F.col("r") - e1)
    return wide.groupBy("variavel", "dof", "n").agg(F.sum(both).alias("chi2"))


def chi2_categorical(df: DataFrame, columns: list[str], target: str, min_freq: int = 10, correction: bool = True) -> DataFrame:
    """Chi-square test with p-values, strongest association first."""
    table = chi2_table(df, columns, target, min_freq, correction)
    p_value = upper_gamma_share(F.col("dof") / F.lit(2.0), F.col("chi2") / F.lit(2.0))
    return table.withColumn("p_value", p_value).orderBy("p_value", "variavel")


def correlation_pairs(df: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """Correlation of every pair of columns over the rows where both are present.

    Pearson: one co-moment matrix for all pairs. Spearman ranks the rows that
    each pair has in common, so it is a pass over the data for each pair.
    """
    if method == "spearman":
        found = pa.table({"var1": [a for a, _ in combinations(columns, 2)], "var2": [b for _, b in combinations(columns, 2)],
                          "corr": pa.array([rank_correlation(df, a, b).first()[0] for a, b in combinations(columns, 2)], pa.float64())})
    else:
        first, second = np.triu_indices(len(columns), 1)
        values, names = pearson(df, columns)[first, second], np.array(columns, dtype=object)
        found = pa.table({"var1": pa.array(names[first], pa.string()), "var2": pa.array(names[second], pa.string()), "corr": pa.array(values, mask=np.isnan(values))})
    return df.sparkSession.createDataFrame(found)


def _co_moments(shift: np.ndarray):
    """Sums over pairs of columns where both are present: rows, values, squares, products and rows with an infinite value, in tiles."""
    n = len(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: np.zeros((n, n)) for name in MOMENTS}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - shift if batch.num_rows else np.zeros((0, n))
            here, infinite = (~np.isnan(x)).astype(float), np.isinf(x)
            x[~np.isfinite(x)] = 0
            for name, part in zip(MOMENTS, (here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x, infinite.astype(float).T @ here)):
                sums[name] += part
        for i in range(0, n, TILE):
            for j in range(0, n, TILE):
                tile = {name: [sums[name][i: i + TILE, j: j + TILE].tobytes()] for name in MOMENTS}
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), **tile})
    return run


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = None
    for batch in batches:
        for parts in zip(*(batch.column(name).to_pylist() for name in MOMENTS)):
            found = [np.frombuffer(p) for p in parts]
            sums = found if sums is None else [a + b for a, b in zip(sums, found)]
    yield pa.RecordBatch.from_pydict({"i": pa.array([key[0].as_py()], pa.int32()), "j": pa.array([key[1].as_py()], pa.int32()), **{n: [s.tobytes()] for n, s in zip(MOMENTS, sums)}})


def pearson(df: DataFrame, columns: list[str]) -> np.ndarray:
    """The matrix of correlations, NaN where a pair has no rows in common or no variance.

    Two passes, however many columns: the means, by which values are shifted so
    that sums of squares lose no digits, and the co-moments. A task holds
    five numbers a pair of columns; tiles of 256 x 256 are summed by as many tasks.
    """
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{k}") for k, c in enumerate(columns)])
    infinite = [float("inf"), float("-inf")]
    means = clean.agg(*[F.avg(F.when(~F.col(c).isin(infinite), F.col(c))).alias(c) for c in clean.columns]).first()
    shift = np.array([m or 0.0 for m in means])
    schema = "i int, j int, " + ", ".join(f"{name} binary" for name in MOMENTS)
    tiles = clean.mapInArrow(_co_moments(shift), schema).groupBy("i", "j").applyInArrow(_summed, schema)
    n = len(columns)
    held = {name: np.zeros((n, n)) for name in MOMENTS}
    for r in tiles.toLocalIterator():
        i, j = r["i"], r["j"]
        shape = (min(TILE, n - i), min(TILE, n - j))
        for name in MOMENTS:
            held[name][i: i + TILE, j: j + TILE] = np.frombuffer(r[name]).reshape(shape)
    rows, x, squares, products, infinite_rows = (held[name] for name in MOMENTS)
    with np.errstate(divide="ignore", invalid="ignore"):
        variance = squares - x * x / rows
        found = (products - x * x.T / rows) / np.sqrt(variance * variance.T)
    # Sums of a column without variance leave the rounding errors of their terms.
    flat = variance <= 1e-13 * squares
    found[(rows == 0) | flat | flat.T | (infinite_rows + infinite_rows.T > 0)] = np.nan
    return np.clip(found, -1, 1)


def rank_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman's correlation with average ranks.

    Ranks belong to distinct values, so rows are reduced to distinct pairs
    first; their ranks come from running counts of each column's values.
    """
    both = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND NOT isnan(a) AND NOT isnan(b)")
    joint = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))

    def ranks(column: str) -> DataFrame:
        counts = joint.groupBy(F.lit(1).alias("k"), column).agg(F.sum("n").alias("m"))
        mid = F.col("m_to") - (F.col("m") - 1) / 2.0
        return running(counts, ["k"], column, ["m"]).select(column, mid.alias(f"r{column}"), F.col("m_sum").alias(f"total_{column}"))

    placed = joint.join(ranks("a"), "a").join(ranks("b"), "b")
    x, y = F.col("ra") - (F.col("total_a") + 1) / 2.0, F.col("rb") - (F.col("total_a") + 1) / 2.0
    n = F.col("n")
    return placed.agg(
        F.try_divide(F.sum(n * x * y), F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y))).alias("spearman")
    )


def strong_pairs(df: DataFrame, columns: list[str], method: str = "pearson", limit: float = 0.9) -> DataFrame:
    """Pairs whose absolute correlation reaches the limit, strongest first."""
    return correlation_pairs(df, columns, method).filter(F.abs("corr") >= limit).orderBy(F.desc(F.abs("corr")))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """Square matrix with one row and one column per variable."""
    columns = columns or columns_of(df, "numeric")
    value = {}
    for r in correlation_pairs(df, columns, method).collect():
        value[r["var1"], r["var2"]] = value[r["var2"], r["var1"]] = r["corr"]
    rows = [(a, *[1.0 if a == b else value[a, b] for b in columns]) for a in columns]
    return df.sparkSession.createDataFrame(rows, "variavel string, " + ", ".join(f"`{c}` double" for c in columns))


def vif(df: DataFrame, columns: list[str], max_vars: int = 5000) -> DataFrame:
    """Variance inflation factors with an intercept; missing and infinite values count as 0.

    Spark computes the correlations; the driver inverts the matrix. More than
    ``max_vars`` columns are an error, as they would not fit there.
    """
    if len(columns) > max_vars:
        raise ValueError(f"{len(columns)} columns are more than the {max_vars} whose matrix the driver inverts")
    infinite = [float("inf"), float("-inf")]
    clean = df.select(*[
        F.coalesce(F.when(~F.isnan(F.col(c).cast("double")) & ~F.col(c).cast("double").isin(infinite), F.col(c).cast("double")), F.lit(0.0)).alias(c)
        for c in columns
    ])
    matrix = np.nan_to_num(pearson(clean, columns), nan=0.0)
    np.fill_diagonal(matrix, 1.0)
    try:
        factors = np.diag(np.linalg.inv(matrix))
    except np.linalg.LinAlgError:
        factors = np.full(len(columns), np.inf)
    rows = [(c, float(v)) for c, v in zip(columns, factors)]
    return df.sparkSession.createDataFrame(rows, "variavel string, VIF double").orderBy(F.desc("VIF"))


def woe_bins(df: DataFrame, columns: list[str], target: str, n_bins: int = 10, method: str = "quantile", eps: float = 1e-6) -> DataFrame:
    """WoE and IV term of each bin (numeric) or level (text) of each column.

    Bins are numbers computed in the row; all columns are stacked and counted
    together. Nulls are in no bin and in no total.
    """
    numeric = [c for c in columns if c in columns_of(df, "numeric")]
    if method == "quantile":
        edges = _quantile_edges(df, numeric, n_bins)
        numbered = {c: bin_of(F.nanvl(F.col(c).cast("double"), F.lit(None)), e) for c, e in edges.items()}
    else:
        # Equal widths, right-closed: the lowest value belongs to the first bin.
        ends = reference_edges(df, numeric, n_bins) if numeric else {}
        numbered = {c: bin_of(F.nanvl(F.col(c).cast("double"), F.lit(None)), e) for c, e in ends.items()}
    parts = df.select(
        F.col(target).cast("int").alias("__y"),
        *[numbered[c].cast("string").alias(c) if c in numbered else F.col(c).cast("string").alias(c) for c in columns if c in numbered or c not in numeric],
    )
    kept = [c for c in parts.columns if c != "__y"]
    counts = parts.unpivot(["__y"], kept, "variavel", "bin").filter(F.col("bin").isNotNull()).groupBy("variavel", "bin").agg(
        F.count_if(F.col("__y") == 0).alias("neg"), F.count_if(F.col("__y") == 1).alias("pos")
    )
    counts, _ = pinned(counts)
    totals = counts.groupBy("variavel").agg(F.sum("neg").alias("N"), F.sum("pos").alias("P"))
    dist_neg, dist_pos = (F.col("neg") + eps) / (F.col("N") + eps), (F.col("pos") + eps) / (F.col("P") + eps)
    woe = F.ln(dist_pos / dist_neg)
    return counts.join(totals, "variavel").select(
        "variavel", "bin", "neg", "pos", (F.col("neg") + F.col("pos")).alias("tot"), dist_neg.alias("dist_neg"), dist_pos.alias("dist_pos"),
        woe.alias("woe"), ((dist_pos - dist_neg) * woe).alias("iv_bin"),
    )


def _quantile_edges(df: DataFrame, columns: list[str], n_bins: int) -> dict[str, list[float]]:
    """Quantile edges for min(n_bins, distinct values) bins per column, equal edges merged; one pass for all columns."""
    if not columns:
        return {}
    all_probs = {b: [i / b for i in range(b + 1)] for b in range(1, n_bins + 1)}
    shares = sorted({*sketch_shares(all_probs[n_bins]), *(i / (4 * n_bins) for i in range(4 * n_bins + 1))})
    sketches = column_sketches(df, columns, shares)
    columns = [c for c in columns if sketches[c]["n"]]
    # A sketch of as many values as bins proves as many distinct values; only the other columns are counted exactly.
    distinct = {c: len(set(sketches[c]["points"])) for c in columns}
    few = [c for c in columns if distinct[c] < n_bins]
    if few:
        exact = column_values(df, few).groupBy("variavel").agg(F.count_distinct("value").alias("d"))
        distinct.update({r["variavel"]: r["d"] for r in exact.collect()})
    probs = {c: all_probs[min(n_bins, distinct[c])] for c in columns}
    # The brackets of fewer bins were not asked of the sketch; such columns are looked at whole, and have few values.
    whole = [c for c in columns if distinct[c] < n_bins]
    table = column_quantile_table(df, [c for c in columns if c not in whole], probs, shares, sketches)
    if whole:
        table = table.unionByName(ranked(ColumnRows(df), {(c,): {p: WHOLE for p in probs[c]} for c in whole}))
    found: dict[str, list[float]] = {}
    for r in table.collect():
        found.setdefault(r["variavel"], []).append(r["quantile"])
    edges = {c: distinct_edges(v) for c, v in found.items()}
    return {c: e for c, e in edges.items() if len(e) > 1}


def optimal_bins(df: DataFrame, columns: list[str], target: str, fine: int = 10, eps: float = 1e-6) -> DataFrame:
    """Neighbouring quantile bins of numeric columns merged so that the event rate only rises or only falls, with the greatest information value.

    Spark counts the ``fine`` bins; a dynamic program over these counts, a few
    numbers a column on the driver, finds the cut. Returns variavel, grupo,
    primeiro and ultimo (the fine bins merged), neg, pos, woe and iv_bin. A
    column of one value is one bin.
    """
    counted: dict[str, list] = {}
    for r in woe_bins(df, columns, target, fine, eps=eps).select("variavel", F.col("bin").cast("int").alias("bin"), "neg", "pos").collect():
        counted.setdefault(r["variavel"], []).append((r["bin"], r["neg"], r["pos"]))
    rows = []
    for name, bins in counted.items():
        bins.sort()
        negatives, positives = (sum(b[i] for b in bins) for i in (1, 2))
        for k, (start, end) in enumerate(best_cut([b[1:] for b in bins], eps), 1):
            neg, pos = (sum(b[i] for b in bins[start:end]) for i in (1, 2))
            dist_neg, dist_pos = (neg + eps) / (negatives + eps), (pos + eps) / (positives + eps)
            woe = math.log(dist_pos / dist_neg)
            rows.append((name, k, bins[start][0], bins[end - 1][0], neg, pos, woe, (dist_pos - dist_neg) * woe))
    return df.sparkSession.createDataFrame(rows, "variavel string, grupo int, primeiro int, ultimo int, neg long, pos long, woe double, iv_bin double")


def best_cut(counts: list[tuple[int, int]], eps: float = 1e-6) -> list[tuple[int, int]]:
    """Ranges (start, end) of counted bins (negatives, positives) with strictly rising or strictly falling event rates and the greatest information value."""
    n = len(counts)
    to_here = [(0, 0)]
    for neg, pos in counts:
        to_here.append((to_here[-1][0] + neg, to_here[-1][1] + pos))
    negatives, positives = to_here[-1]

    def part(i: int, j: int) -> tuple[int, int]:
        return to_here[j][0] - to_here[i][0], to_here[j][1] - to_here[i][1]

    def value(i: int, j: int) -> float:
        neg, pos = part(i, j)
        dist_neg, dist_pos = (neg + eps) / (negatives + eps), (pos + eps) / (positives + eps)
        return (dist_pos - dist_neg) * math.log(dist_pos / dist_neg)

    found = []
    for sign in (1, -1):
        # best[i, j]: value and way of the bins before j whose last range begins at i.
        best: dict[tuple[int, int], tuple[float, list]] = {}
        for j in range(1, n + 1):
            for i in range(j):
                (neg, pos), own, ways = part(i, j), value(i, j), []
                for h in range(i):
                    if (h, i) in best:
                        left_neg, left_pos = part(h, i)
                        # Rates by cross multiplication of whole numbers.
                        if sign * (pos * (left_neg + left_pos) - left_pos * (neg + pos)) > 0:
                            ways.append((best[h, i][0] + own, [*best[h, i][1], (i, j)]))
                if i == 0:
                    ways.append((own, [(0, j)]))
                if ways:
                    best[i, j] = max(ways, key=lambda w: w[0])
        found += [best[i, n] for i in range(n) if (i, n) in best]
    return max(found, key=lambda w: w[0])[1]


def information_values(df: DataFrame, columns: list[str], target: str, **options) -> DataFrame:
    """Total IV per column, strongest first."""
    return woe_bins(df, columns, target, **options).groupBy("variavel").agg(F.sum("iv_bin").alias("IV")).orderBy(F.desc("IV"))


def near_constant(df: DataFrame, columns: list[str], share: float = 0.99) -> DataFrame:
    """Columns whose most frequent value reaches the given share of the rows."""
    return modal_share(df, columns).filter(F.col("frac_modal") >= share).select(
        "variavel", F.bround("frac_modal", 4).alias("frac_modal")).orderBy(F.desc("frac_modal"))


def histograms(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Rows in each of ``bins`` equal-width bins of every column, empty bins included."""
    edges = reference_edges(df, columns, bins)
    return edge_table(df, edges).join(binned_counts(df, edges), ["variavel", "bin"], "left").na.fill({"n": 0})


def level_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per level of each text column, most frequent first."""
    return level_counts(df, columns).filter(F.col("nivel").isNotNull()).orderBy("variavel", F.desc("n"), "nivel")


# ---- distance correlation -----------------------------------------------------------------

#: Points of a chunk, and the most chunks in the order of a column.
CHUNK_ROWS, CHUNKS = 16_384, 512


def distance_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Distance correlation of two columns over all rows, without forming pairs of rows.

    The sums of products of distances over all pairs split into sums over
    dominated rows: inside chunks of x and of y by a tree over ranks in the
    chunk's task, between them from totals of the chunks' grid. Each row is
    moved a fixed number of times; n log n is work inside tasks only.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    distinct = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    centre = points.agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.count(F.lit(1)).alias("n"), F.count_distinct("x", "y").alias("d")).first()
    n, d = centre["n"], centre["d"]
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([(None,)], "dcor double")
    moved = distinct.select(
        F.lit(1).alias("k"), (F.col("x") - centre["mx"]).alias("x"), (F.col("y") - centre["my"]).alias("y"), "w"
    )
    moved = written(moved, "points")
    sums_x, sums_y = _distance_sums(moved, "x"), _distance_sums(moved, "y")
    rows = moved.join(sums_x, "x").join(sums_y, "y").agg(
        F.sum(F.col("w") * F.col("a_x") * F.col("a_y")).alias("ab"), F.sum(F.col("w") * F.col("a_x") * F.col("a_x")).alias("aa"),
        F.sum(F.col("w") * F.col("a_y") * F.col("a_y")).alias("bb"), F.sum(F.col("w") * F.col("a_x")).alias("a"), F.sum(F.col("w") * F.col("a_y")).alias("b"),
        F.sum(F.col("w") * F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("w") * F.col("y") * F.col("y")).alias("yy"),
    ).first()
    cross = _cross_distances(moved, d)
    # Centred on the mean, the squared distances sum to 2 n times the squares.
    squares = {"xy": cross, "xx": 2.0 * n * rows["xx"], "yy": 2.0 * n * rows["yy"]}

    def covariance(product: float, row_product: float, all_a: float, all_b: float) -> float:
        return product / n**2 - 2.0 * row_product / n**3 + all_a * all_b / n**4

    cov = covariance(squares["xy"], rows["ab"], rows["a"], rows["b"])
    var_x = covariance(squares["xx"], rows["aa"], rows["a"], rows["a"])
    var_y = covariance(squares["yy"], rows["bb"], rows["b"], rows["b"])
    dcov, dx, dy = (math.sqrt(max(v, 0.0)) for v in (cov, var_x, var_y))
    value = dcov / math.sqrt(dx * dy) if dx > 0 and dy > 0 else 0.0
    return spark.createDataFrame([(value,)], "dcor double")


def _distance_sums(points: DataFrame, column: str) -> DataFrame:
    """Sum of distances from each distinct value of the column to all rows."""
    counts = points.groupBy("k", column).agg(F.sum("w").alias("n"))
    ranked = running(counts.withColumn("s", F.col("n") * F.col(column)), ["k"], column, ["n", "s"])
    v = F.col(column)
    below = v * F.col("n_to") - F.col("s_to")
    above = (F.col("s_sum") - F.col("s_to")) - v * (F.col("n_sum") - F.col("n_to"))
    return ranked.select(column, (below + above).alias(f"a_{column}"))


def _crossed(place: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum of |dx| |dy| over the pairs of rows of different places; x never falls from one place to the next.

    On each level of a binary tree over the places, a right-hand row needs totals
    of the left-hand rows of its block with smaller y, which are running totals in y.
    """
    up = np.argsort(y, kind="stable")
    place, x, y, w = place[up], x[up] - x.mean(), y[up] - y.mean(), w[up]
    sums, total = np.stack([w, w * x, w * y, w * x * y]), 0.0
    for level in range(int(place.max()).bit_length()):
        order = np.argsort(place >> (level + 1), kind="stable")  # by y within a block
        block, right, own = place[order] >> (level + 1), (place[order] >> level) & 1 == 1, sums[:, order]
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        ends = np.append(first[1:], len(block))
        to = np.cumsum(np.where(right, 0.0, own), axis=1)
        before = np.where(first > 0, to[:, first - 1], 0.0)
        # Left rows of smaller y less those of larger y; rows of equal y add nothing to either.
        lw, lx, ly, lxy = 2 * to - np.repeat(to[:, ends - 1] + before, ends - first, axis=1)
        rw, rx, ry, rxy = own
        total += float((rxy * lw - rx * ly - ry * lx + rw * lxy)[right].sum())
    return total


def _chunk_sum(places: str | None):
    def run(rows: pa.Table) -> pa.Table:
        x, y, w = (rows.column(c).to_numpy().astype(np.float64) for c in ("x", "y", "w"))
        if places is None:  # each row has a place of its own, in the order of x
            place = np.empty(len(x), dtype=np.int64)
            place[np.lexsort((y, x))] = np.arange(len(x))
        else:
            place = rows.column(places).to_numpy().astype(np.int64)
        return pa.table({"s": pa.array([_crossed(place, x, y, w)], pa.float64())})
    return run


def _cross_distances(points: DataFrame, distinct: int, chunk_rows: int = CHUNK_ROWS) -> float:
    """Sum over all ordered pairs of rows of |dx| |dy|.

    The points are cut into chunks in the order of x and again in the order of y.
    Pairs of one x chunk are summed by its task, further pairs of one y chunk by
    that one's; all others differ in both chunks, and totals of the cells of the
    grid of chunks are enough for them. Cuts may part equal values: their distance is 0 either way.
    """
    chunks = min(CHUNKS, -(-distinct // chunk_rows))
    for column, other in (("x", "y"), ("y", "x")):
        points = written(points.repartitionByRange(chunks, column, other).withColumn(f"of_{column}", F.spark_partition_id()), "chunks")
    in_x = points.select("of_x", "x", "y", "w").groupBy("of_x").applyInArrow(_chunk_sum(None), "s double")
    in_y = points.select("of_x", "of_y", "x", "y", "w").groupBy("of_y").applyInArrow(_chunk_sum("of_x"), "s double")
    near = in_x.unionByName(in_y).agg(F.sum("s")).first()[0]

    measures = {"w": F.col("w"), "x": F.col("w") * F.col("x"), "y": F.col("w") * F.col("y"), "xy": F.col("w") * F.col("x") * F.col("y")}
    cells = written(points.groupBy("of_x", "of_y").agg(*[F.sum(e).alias(f"c_{m}") for m, e in measures.items()]), "cells")
    grid = cells.select("of_x").distinct().crossJoin(cells.select("of_y").distinct())  # at most CHUNKS squared
    grid = grid.join(cells, ["of_x", "of_y"], "left").na.fill(0.0)
    left = Window.partitionBy("of_y").orderBy("of_x").rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("of_x").orderBy("of_y").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("of_x").orderBy("of_y").rowsBetween(1, Window.unboundedFollowing)
    grid = grid.withColumns({f"l_{m}": F.coalesce(F.sum(f"c_{m}").over(left), F.lit(0.0)) for m in measures})
    signed = grid.withColumns({f"s_{m}": F.coalesce(F.sum(f"l_{m}").over(below), F.lit(0.0)) - F.coalesce(F.sum(f"l_{m}").over(above), F.lit(0.0)) for m in measures})
    far = signed.agg(F.sum(F.expr("c_xy * s_w - c_x * s_y - c_y * s_x + c_w * s_xy"))).first()[0]
    return 2.0 * (near + far)


def distance_correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distance correlation of every pair of columns."""
    rows = [(a, a, 1.0) for a in columns]
    for a, b in combinations(columns, 2):
        value = distance_correlation(df, a, b).first()["dcor"]
        rows += [(a, b, value), (b, a, value)]
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, dcor double")
