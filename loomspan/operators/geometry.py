"""Entropy, fractal, recurrence and hull operators on windows of points."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.spectral import doubles


def cell(x, y, size: float) -> Column:
    return F.struct(F.floor(F.col(x) / size).alias("cx"), F.floor(F.col(y) / size).alias("cy"))


def entropy(df: DataFrame, keys: list[str], item, name: str, log=F.log2) -> DataFrame:
    """Shannon entropy of the items of each group (nulls are no items), by two counts."""
    counted = df.withColumn("_item", item if isinstance(item, Column) else F.col(item)).where(F.col("_item").isNotNull()).groupBy(*keys, "_item").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    p = F.col("_n") / F.sum("_n").over(w)
    return counted.withColumn("_p", p).groupBy(*keys).agg((F.sum(-F.col("_p") * log("_p")) + F.lit(0.0)).alias(name))


#: Sizes of boxes whose counts make a dimension.
BOXES = (4, 8, 16, 32, 64, 128, 256)


def box_dimension(points: DataFrame, keys: list[str], sizes=BOXES) -> DataFrame:
    """Box-counting dimension: slope of ln(cells hit) on ln(1/size); null for fewer than two points."""
    boxes = points.select(*keys, "x", "y", F.explode(F.array(*map(F.lit, sizes))).alias("e"))
    cells = boxes.groupBy(*keys, "e").agg(F.countDistinct(F.floor(F.col("x") / F.col("e")), F.floor(F.col("y") / F.col("e"))).alias("n"), F.count("*").alias("m"))
    return cells.groupBy(*keys).agg(F.when(F.max("m") >= 2, F.regr_slope(F.ln(F.col("n").cast("double")), F.ln(1.0 / F.col("e"))) + 0.0).alias("dimension"))


def grid_dimension(points: DataFrame, keys: list[str], grids=(4, 8, 16), least: int = 10) -> DataFrame:
    """Box-counting dimension on grids over the points' bounding box: null for fewer than `least` points, 0 for a flat box."""
    w = Window.partitionBy(*keys)
    box = points.withColumns({"_n": F.count("*").over(w), "_x": F.min("x").over(w), "_y": F.min("y").over(w), "_w": F.max("x").over(w) - F.min("x").over(w), "_h": F.max("y").over(w) - F.min("y").over(w)})
    at = lambda v, low, size: F.least(F.floor(F.try_divide(F.col(v) - F.col(low), F.col(size)) * F.col("s")), F.col("s") - 1)
    flat = (F.col("_w") <= 0) | (F.col("_h") <= 0)
    cells = box.select("*", F.explode(F.array(*map(F.lit, grids))).alias("s")).groupBy(*keys, "s").agg(F.countDistinct(at("x", "_x", "_w"), at("y", "_y", "_h")).alias("n"), F.max("_n").alias("m"), F.max(flat).alias("flat"))
    value = F.when(F.max("flat"), F.lit(0.0)).otherwise(F.regr_slope(F.ln(F.greatest("n", F.lit(1)).cast("double")), F.ln(F.col("s").cast("double"))) + 0.0)
    return cells.groupBy(*keys).agg(F.when(F.max("m") >= least, value).alias("dimension"))


def box_slope(x: str, y: str, of, sizes=BOXES) -> str:
    """box_dimension of the points that `of` lets through, as one aggregate in SQL."""
    at = [-math.log(e) for e in sizes]
    mid = sum(at) / len(at)
    spread = sum((a - mid) ** 2 for a in at)
    cells = lambda e: f"collect_set({of(f'struct(floor({x} / {e}), floor({y} / {e}))')})"
    terms = " + ".join(f"ln(CAST(size({cells(e)}) AS DOUBLE)) * {(a - mid) / spread!r}D" for e, a in zip(sizes, at, strict=True))
    return f"CASE WHEN count({of('1')}) >= 2 THEN {terms} END"


def with_recurrence(points: DataFrame, keys: list[str], order: list[str], item: Column, most: int = 2000) -> DataFrame:
    """points with _item and, on the rows that count, _c1, _c2, _c3: how often the row's item, its pair with the next and its triple occur in the group.

    Sequences of more than `most` items are thinned to evenly spaced ones, which is the measure's definition.
    """
    w, run = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*order)
    seq = points.withColumn("_item", item).withColumns({"_i": F.row_number().over(run) - 1, "_n": F.count("*").over(w)})
    j = F.ceil(F.col("_i") * F.lit(most - 1) / (F.col("_n") - 1))
    taken = F.floor(j * (F.col("_n") - 1) / F.lit(most - 1)) == F.col("_i")
    seq = seq.withColumn("_taken", (F.col("_n") <= most) | taken)
    thin = Window.partitionBy(*keys, "_taken").orderBy(*order)
    seq = seq.withColumns({"_b": F.lead("_item").over(thin), "_d": F.lead("_item", 2).over(thin)})
    grams = (("_c1", ["_item"]), ("_c2", ["_item", "_b"]), ("_c3", ["_item", "_b", "_d"]))
    return seq.withColumns({c: F.when(F.col("_taken") & F.col(g[-1]).isNotNull(), F.count("*").over(Window.partitionBy(*keys, "_taken", *g))) for c, g in grams}).drop("_i", "_n", "_b", "_d")


def recurrence_of(of=lambda value: value) -> tuple[str, str]:
    """(rate, determinism: diagonals of two and more) as aggregates, in SQL, of the rows of with_recurrence that `of` lets through.

    A row has its item's count, so the rows' sum of counts is the sum of squared counts: recurrences are that of items; those on diagonals twice that of pairs less that of triples. No matrix is made.
    """
    one, two, three = (f"coalesce(sum({of(c)}), 0)" for c in ("_c1", "_c2", "_c3"))
    n = f"CAST(count({of('_c1')}) AS DOUBLE)"
    return f"try_divide({one}, {n} * {n})", f"try_divide(2 * {two} - {three}, {one})"


def recurrence(points: DataFrame, keys: list[str], order: list[str], item: Column, most: int = 2000) -> DataFrame:
    """Recurrence rate and determinism of each group's sequence of items."""
    rate, determinism = recurrence_of()
    return with_recurrence(points, keys, order, item, most).groupBy(*keys).agg(F.expr(rate).alias("rate"), F.expr(determinism).alias("determinism"))


def ids(*keys: np.ndarray) -> np.ndarray:
    """A number for each row, the same for rows that agree in all keys."""
    out = np.zeros(len(keys[0]), np.int64)
    for k in keys:
        u = np.unique(k, return_inverse=True)[1]
        out = np.unique(out * (len(u) + 1) + u, return_inverse=True)[1]
    return out


def path_measures(of: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray, size: float, sizes=BOXES, most: int = 2000) -> list[np.ndarray]:
    """entropy(), box_dimension() and recurrence() of paths put together: path number and place of each point, and the points of each path."""
    total = lambda rows, weights=None: np.bincount(rows, weights, len(n))
    item = ids(of, np.floor(x / size), np.floor(y / size))
    entropy = total(of, -np.log2(np.bincount(item)[item] / n[of])) / n
    at = -np.log(sizes)
    hit = (total(of[np.unique(ids(of, np.floor(x / e), np.floor(y / e)), return_index=True)[1]]) for e in sizes)
    dimension = sum(np.log(h) * a for h, a in zip(hit, (at - at.mean()) / ((at - at.mean()) ** 2).sum(), strict=True))
    i, last = np.arange(len(of)) - (np.cumsum(n) - n)[of], np.maximum(n - 1, 1)[of]
    taken = (n[of] <= most) | (np.floor(np.ceil(i * (most - 1) / last) * last / (most - 1)) == i)
    of, item = of[taken], item[taken]
    sums = []  # of squared counts of items, pairs and triples
    for k in range(3):
        rows = np.flatnonzero(of[: len(of) - k] == of[k:])
        gram = ids(*(item[rows + j] for j in range(k + 1)))
        sums.append(total(of[rows], np.bincount(gram)[gram] if len(rows) else None))
    return [entropy, np.where(n >= 2, dimension, np.nan), sums[0] / total(of) ** 2.0, (2 * sums[1] - sums[2]) / sums[0]]


@F.pandas_udf(doubles("entropy", "dimension", "rate", "determinism"))
def scanpath(xs: pd.Series, ys: pd.Series, size: pd.Series) -> pd.DataFrame:
    """path_measures() of rows of coordinate arrays in time's order; null for an empty one."""
    n = xs.map(len).to_numpy()
    out, some = np.full((len(n), 4), np.nan), np.flatnonzero(n)
    if len(some):
        x, y = (np.concatenate([np.asarray(v, float) for v in a]) for a in (xs, ys))
        out[some] = np.column_stack(path_measures(np.repeat(np.arange(len(some)), n[some]), n[some], x, y, float(size.iloc[0])))
    return pd.DataFrame(out, columns=["entropy", "dimension", "rate", "determinism"])


def hull_measures(points: np.ndarray) -> tuple[float, float]:
    """Area and perimeter of the convex hull of (n, 2) points; 0, 0 where fewer than three points span it."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return 0.0, 0.0

    rows = [tuple(r) for r in p.tolist()]
    loop = convex_loop(rows)
    if len(loop) < 3:
        return 0.0, 0.0
    a = np.array(loop)
    b = np.roll(a, -1, 0)
    return abs(float((a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]).sum())) / 2, float(np.hypot(*(b - a).T).sum())


def convex_loop(rows: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Hull of sorted distinct points by two monotone chains, without collinear ones."""

    def chain(points):
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return chain(rows) + chain(reversed(rows))


@F.pandas_udf(doubles("area", "perimeter"))
def hull(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
    """Hull measures of rows of coordinate arrays."""
    out = [hull_measures(np.column_stack([x, y]).astype(float)) if len(x) else (0.0, 0.0) for x, y in zip(xs, ys, strict=True)]
    return pd.DataFrame(out, columns=["area", "perimeter"])
