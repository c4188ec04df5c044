"""Walk-forward evaluation: folds, metrics as ratios of sums, block bootstrap, information shares."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import percentiles


def walk_forward(dates: Sequence[str], least: int = 8, test: int = 3, step: int = 3) -> list[tuple[list[str], list[str]]]:
    """Expanding folds over whole dates: at least ``least`` to train on, then ``test`` to test on."""
    d = sorted(set(dates))
    return [(d[:i], d[i : i + test]) for i in range(least, len(d) - test + 1, step)]


def placebo(rows: DataFrame, target: str, lag: int, by: list[str], ts: str) -> DataFrame:
    """The target displaced by ``lag`` rows within each date: what a leak would still predict."""
    return rows.withColumn(target, F.lead(target, lag).over(Window.partitionBy(*by).orderBy(ts)))


def strided(rows: DataFrame, every: int, by: list[str], ts: str) -> DataFrame:
    """Every ``every``-th row of each fold, so that forward windows don't overlap."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(ts))
    return rows.withColumn("_n", n).where((F.col("_n") - 1) % every == 0).drop("_n")


#: Metrics as (numerator, denominator) of per-row terms of y and p.
RATIOS = {
    "r2": (lambda y, p: y * y - (y - p) * (y - p), lambda y, p: y * y),
    "hit": (lambda y, p: F.when((F.abs(y) > 1e-9) & (F.signum(y) * F.signum(p) > 0), 1.0).otherwise(0.0), lambda y,
    p: F.when((F.abs(y) > 1e-9) & (p != 0), 1.0).otherwise(0.0)),
    "gross_bps": (lambda y, p: y * F.signum(p), lambda y, p: F.when(p != 0, 1.0).otherwise(0.0)),
}


#: Ratios over rows that are classes already: of the calls of a class those that were right, and the other way round.
CLASS_RATIOS = {
    f"{name}_{kind}": (lambda y, p, k=k: ((y == k) & (p == k)).cast("double"),
    (lambda y, p, k=k: (p == k).cast("double")) if kind == "precision" else (lambda y, p, k=k: (y == k).cast("double")))
    for name, k in (("up", 1), ("down", -1)) for kind in ("precision", "recall")
}


def partial_sums(rows: DataFrame, by: list[str], y: str = "y", p: str = "p", of: dict = RATIOS) -> DataFrame:
    """Per-date sums of every ratio's terms: all that bootstrap draws need."""
    cols = [F.sum(f(F.col(y), F.col(p))).alias(f"{k}_{part}") for k, pair in of.items() for part, f in zip(("num", "den"), pair)]
    return rows.groupBy(*by).agg(*cols)


def _ratio(num: Column, den: Column) -> Column:
    """Null, not a number, where nothing is in the denominator."""
    return F.when(den > 0, num / den)


def ratios(sums: DataFrame, of: dict = RATIOS) -> DataFrame:
    return sums.agg(*[_ratio(F.sum(f"{k}_num"), F.sum(f"{k}_den")).alias(k) for k in of])


def bootstrap(sums: DataFrame, date: str, draws: int = 1000, seed: int = 0, level: float = 0.95, of: dict = RATIOS) -> DataFrame:
    """Percentile intervals from whole dates drawn with replacement: ``(metric, point, lo, hi)``.

    A draw is a weight for each date; the sums per date meet the weights in a join. The
    weights are drawn on the driver, for as many dates as there are (days, not rows). One date can't be
    resampled: its interval is null; so is that of a metric without a point."""
    spark = sums.sparkSession
    dates = [r[0] for r in sums.select(date).distinct().orderBy(date).collect()]
    picks = np.random.default_rng(seed).integers(0, len(dates), (draws if len(dates) > 1 else 0, max(1, len(dates))))
    weights = [(i, dates[j], int(n)) for i, row in enumerate(picks) for j, n in enumerate(np.bincount(row, minlength=len(dates))) if n]
    w = spark.createDataFrame(weights, f"draw int, {date} {sums.schema[date].dataType.simpleString()}, weight int")
    per = sums.join(F.broadcast(w),
        date).groupBy("draw").agg(*[_ratio(F.sum(F.col(f"{k}_num") * F.col("weight")), F.sum(F.col(f"{k}_den") * F.col("weight"))).alias(k)
        for k in of])
    tall = per.unpivot("draw", list(of), "metric", "value")
    q = (1 - level) / 2
    p = F.percentile("value", F.array(F.lit(q), F.lit(1 - q)))
    bounds = tall.groupBy("metric").agg(p.alias("p")).select("metric", F.col("p")[0].alias("lo"), F.col("p")[1].alias("hi"))
    point = ratios(sums, of).withColumn("_", F.lit(1)).unpivot("_", list(of), "metric", "point").drop("_")
    none = F.col("point").isNull()
    return point.join(bounds, "metric", "left").select("metric", "point", F.when(~none, F.col("lo")).alias("lo"),
        F.when(~none, F.col("hi")).alias("hi"))


def classes(values: Column, threshold: Column) -> Column:
    """-1, 0 or 1: the sign of what clears its row's threshold."""
    return F.when(F.abs(values) > threshold, F.signum(values)).otherwise(0).cast("int")


def as_classes(rows: DataFrame, y: str = "y", p: str = "p", threshold: str = "threshold", share: float | None = None) -> DataFrame:
    """Truth and prediction as classes by each row's threshold; with ``share``, the prediction by the cut at which
    that share of rows is called, so that two models are compared at equal coverage."""
    truth = classes(F.col(y), F.col(threshold))
    if share is None:
        return rows.withColumn("_y", truth).withColumn(p, classes(F.col(p), F.col(threshold))).withColumn(y, F.col("_y")).drop("_y")
    cut = percentiles(rows.withColumn("_abs", F.abs(p)), [], "_abs", [1 - share]).select(F.get("p", F.lit(0)).alias("_cut"))
    return rows.join(F.broadcast(cut), F.lit(True)).withColumn("_y", truth).withColumn(p, classes(F.col(p), F.col("_cut"))).withColumn(y,
        F.col("_y")).drop("_y", "_cut")


def intervals(rows: DataFrame, date: str = "date", share: float | None = None, draws: int = 1000, seed: int = 0) -> DataFrame:
    """Every reported metric with its interval: ``(family, metric, point, lo, hi)``.

    ``rows(date, y, p, threshold)``, pooled and strided. Families: returns, classes by the spread, and, with
    ``share``, classes at that coverage."""
    parts = [("returns", rows, RATIOS), ("classes", as_classes(rows), CLASS_RATIOS)]
    if share is not None:
        parts.append(("coverage", as_classes(rows, share=share), CLASS_RATIOS))
    out = None
    for name, df, of in parts:
        one = bootstrap(partial_sums(df, [date], of=of), date, draws, seed, of=of).select(F.lit(name).alias("family"), "metric", "point",
            "lo", "hi")
        out = one if out is None else out.unionByName(one)
    return out


def evaluate(rows: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """Of strided rows: n, R2 against no view, hit rate, correlation and both deviations (of the population).

    The correlation is null for two rows or fewer, or where nothing varies."""
    Y, P = F.col(y), F.col(p)
    parts = {k: (F.sum(RATIOS[k][0](Y, P)), F.sum(RATIOS[k][1](Y, P))) for k in ("r2", "hit")}
    out = rows.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), *[_ratio(*v).alias(k) for k, v in parts.items()], F.stddev_pop(p).alias("pred_std"),
        F.stddev_pop(y).alias("y_std"), F.covar_pop(y, p).alias("_cov"))
    fine = (F.col("n") > 2) & (F.col("pred_std") > 0) & (F.col("y_std") > 0)
    return out.withColumn("corr", F.when(fine, F.try_divide("_cov", F.col("pred_std") * F.col("y_std")))).select(*(by or []), "n", "r2",
        "hit", "corr", "pred_std", "y_std")


def edge_summary(rows: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """Trades taken and what they made before costs: in all, and by trade, which is the cost to break even at."""
    take = F.abs(F.col(p)) > 0
    out = rows.groupBy(*(by or [])).agg(F.count_if(take).alias("n_trades"),
        F.sum(F.when(take, F.signum(p) * F.col(y))).alias("gross_bps_total"))
    return out.withColumn("gross_bps_per_trade", F.try_divide("gross_bps_total", "n_trades"))


def spread_over(folds: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and deviation (of the population) of a metric over folds; folds without one are left out."""
    return folds.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def fold_rows(rows: DataFrame, train: Sequence[str], test: Sequence[str], horizon: int, share: float = 0.15, date: str = "date",
    ts: str = "ts_ns") -> DataFrame:
    """``part`` of each row of a fold: fit, val, test, or null for rows that the embargoes leave out.

    Of the training dates in time order the last ``horizon`` rows go, whose targets reach into the test; the
    newest ``share`` of the rest is for validation, with a gap of ``horizon`` rows before it. Places come
    from counts by date and a row number inside each date, so that no window holds a whole fold."""
    one = rows.where(F.col(date).isin(*train, *test))
    nth = F.row_number().over(Window.partitionBy(date).orderBy(ts))
    per = one.groupBy(date).agg(F.count("*").alias("_n")).where(F.col(date).isin(*train))
    before = F.sum("_n").over(Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1))  # a row a date
    base = per.select(F.col(date).alias("_d"), F.coalesce(before, F.lit(0)).alias("_base"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"))
    placed = one.withColumn("_nth", nth).join(F.broadcast(base), F.col(date) == F.col("_d"), "left").withColumn("_place",
        F.col("_base") + F.col("_nth"))
    kept = F.greatest(F.lit(0), F.col("_all") - horizon)
    n_val = F.bround(kept * share).cast("long")
    part = (F.when(F.col(date).isin(*test), "test").when(F.col("_place") > kept, None).when(F.col("_place") > kept - n_val, "val")
            .when(F.col("_place") <= kept - n_val - horizon, "fit"))
    return placed.withColumn("part", part).drop("_d", "_base", "_all", "_nth", "_place")


def last_dates(dates: Sequence[str], share: float = 0.3) -> tuple[list[str], list[str]]:
    """One holdout: the latest ``share`` of the dates, at least one, to test on; nothing to train on if there is one date."""
    d = sorted(set(dates))
    if len(d) < 2:
        return [], []
    n = max(1, round(len(d) * share))
    return d[:-n], d[-n:]


def class_report(rows: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and support of up and down, and the shares traded and movable."""
    Y, P = F.col(y), F.col(p)
    cols = []
    for name, k in (("up", 1), ("down", -1)):
        both = F.count_if((Y == k) & (P == k))
        cols += [F.try_divide(both, F.count_if(P == k)).alias(f"{name}_precision"),
            F.try_divide(both, F.count_if(Y == k)).alias(f"{name}_recall"), F.count_if(Y == k).alias(f"{name}_support")]
    return rows.agg(*cols, F.avg((P != 0).cast("double")).alias("traded_share"), F.avg((Y != 0).cast("double")).alias("movable_share"))


def coverage_cut(rows: DataFrame, p: str, share: float) -> DataFrame:
    """Rows whose prediction is above the (1 - share) quantile of its size."""
    cut = percentiles(rows.withColumn("_abs", F.abs(p)), [], "_abs", [1 - share]).select(F.get("p", F.lit(0)).alias("_cut"))
    return rows.join(F.broadcast(cut), F.abs(p) > F.col("_cut")).drop("_cut")


def islands(rows: DataFrame, by: list[str], ts: str, gap: int) -> DataFrame:
    """``stretch``: the number of the unbroken run that a row is in."""
    w = Window.partitionBy(*by).orderBy(ts)
    new = F.coalesce((F.col(ts) - F.lag(ts).over(w) > gap).cast("int"), F.lit(0))
    return rows.withColumn("_new", new).withColumn("stretch", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def ridge(rows: DataFrame, features: list[str], y: str, alpha: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge on standardized features by normal equations: weights in input units, and intercept.

    One aggregation gives the moments; the driver solves a system of as many rows as features.
    Nulls take the feature's median."""
    tall = rows.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], features, "_f", "_v")
    meds = {r["_f"]: r["p"][0] for r in percentiles(tall, ["_f"], "_v", [0.5]).collect()}
    full = rows.select(F.col(y).cast("double").alias("_y"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(float(meds.get(c) or 0.0))).alias(c) for c in features]).where("_y is not null")
    cols = [*features, "_y"]
    aggs = [F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
        *[F.sum(F.col(a) * F.col(b)).alias(f"p{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]]
    m = full.agg(*aggs).first()
    k, n = len(features), m["n"]
    mean = np.array([m[f"s{i}"] / n for i in range(k + 1)])
    cov = np.array([[m[f"p{min(i, j)}_{max(i, j)}"] / n - mean[i] * mean[j] for j in range(k + 1)] for i in range(k + 1)])
    scale = np.sqrt(np.maximum(np.diag(cov)[:k], 0))
    scale[scale == 0] = 1
    gram = cov[:k, :k] / np.outer(scale, scale) * n
    beta = np.linalg.solve(gram + alpha * np.eye(k), cov[:k, k] / scale * n) / scale
    return beta, float(mean[k] - beta @ mean[:k])


def min_rows(interval_ns: int, lags: int = 10) -> int:
    """The fitted rows that a date's estimate needs on a grid of ``interval_ns``."""
    return max(5000 // max(interval_ns // 1_000_000_000, 1), 20 * (2 * lags + 2))


SHARES = "n long, dropped long, alpha_a double, alpha_b double, lo double, hi double, gg double, resid_corr double, cond double"


def _lead(cov: np.ndarray, a: float, b: float) -> tuple[float, float]:
    """Bounds of the first venue's share of the variance of the common price's innovation.

    The common price moves by ``a`` times the first innovation plus ``b`` times the second. Told apart
    with the first venue first, the covariance that both share counts as the first one's; with the
    second first, as the other's."""
    s1, s2, s12 = cov[0, 0], cov[1, 1], cov[0, 1]
    total = a * a * s1 + 2 * a * b * s12 + b * b * s2
    first = (a * s1 + b * s12) ** 2 / s1 / total
    last = a * a * (s1 - s12 * s12 / s2) / total
    return tuple(sorted((min(1.0, max(0.0, first)), min(1.0, max(0.0, last)))))


def info_shares(panel: DataFrame, date: str = "date", lags: int = 10, least: int | None = 200, interval_ns: int | None = None,
    by: list[str] | None = None) -> DataFrame:
    """Price discovery of two venues by date: ``(*by, date,`` and ``SHARES)``.

    ``panel(*by, date, ts_ns, a, b)``: two log prices on a grid. Per date a vector error-correction
    model by least squares on the spread and ``lags`` lagged differences; ``lo`` and ``hi`` bound
    Hasbrouck's share of the first venue over both orders of the innovations, ``gg`` is the
    Gonzalo-Granger share. With ``interval_ns``, the grid's step, a row is fitted only if its step
    and each lagged one span exactly that, so that no window crosses a hole; ``dropped`` counts the others.
    Dates with fewer fitted rows than ``least`` (None: :func:`min_rows`) are left out, and those that have no
    estimate: too few rows for the parameters, no venue that corrects, or innovations that are one."""
    by = by or []
    need = min_rows(interval_ns or 1_000_000_000, lags) if least is None else least
    cols = [*by, date, *[c.split()[0] for c in SHARES.split(", ")]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts_ns")
        x, none = pdf[["a", "b"]].to_numpy(float), pd.DataFrame(columns=cols)
        if len(x) <= lags + 2:
            return none
        steps = np.diff(x, axis=0)
        y = steps[lags:]
        z = np.column_stack([np.ones(len(y)), (x[lags:-1, 0] - x[lags:-1, 1]),
            *[steps[lags - k : len(steps) - k] for k in range(1, lags + 1)]])
        rows = len(y)
        if interval_ns is not None:
            stretch = np.cumsum(np.r_[True, np.diff(pdf["ts_ns"].to_numpy(np.int64)) != interval_ns])
            whole = stretch[:rows] == stretch[lags + 1 :]
            y, z = y[whole], z[whole]
        if len(y) < need or len(y) <= z.shape[1]:
            return none
        beta, *_ = np.linalg.lstsq(z, y, rcond=None)
        cov = np.cov((y - z @ beta).T)
        speed = beta[1]
        # the common price: what no correction moves
        a, b = speed[1], -speed[0]
        if not abs(a + b) >= 1e-15 or not cov[0, 0] * cov[1, 1] - cov[0, 1] ** 2 > 0:
            return none
        corr = cov[0, 1] / np.sqrt(cov[0, 0] * cov[1, 1])
        return pd.DataFrame([(*[pdf[c].iloc[0] for c in by], pdf[date].iloc[0], len(y), rows - len(y), float(speed[0]), float(speed[1]),
            *_lead(cov, a, b), float(a / (a + b)), float(corr),
                              float(np.linalg.cond(z)))], columns=cols)

    keys = [*by, date]
    kinds = "".join(f"{c} {panel.schema[c].dataType.simpleString()}, " for c in keys)
    return panel.select(*keys, "ts_ns", "a", "b").groupBy(*keys).applyInPandas(run, kinds + SHARES)


def share_summary(shares: DataFrame, by: list[str]) -> DataFrame:
    """Over dates: mean and deviation (of the population) of the bounds' midpoint, mean width, and dates whose
    Gonzalo-Granger number is no share."""
    mid = (F.col("lo") + F.col("hi")) / 2
    return shares.groupBy(*by).agg(F.count("*").alias("n_dates"), F.avg(mid).alias("mid_mean"), F.stddev_pop(mid).alias("mid_std"),
        F.avg(F.col("hi") - F.col("lo")).alias("mean_width"),
                                   F.count_if(~F.col("gg").between(0, 1)).alias("gg_unusable"))


def permutation_importance(rows: DataFrame, predict, features: list[str], venue_of: dict[str, str | None], repeats: int = 5, seed: int = 0,
    y: str = "y") -> DataFrame:
    """``(venue, importance)``: how much R2 falls, over the features of a venue, when a feature's values are dealt anew.

    ``predict(df)`` adds ``p``. A feature is shuffled by pairing rows in their own order with rows in the order of
    a hash: one sort and one join by place for each feature and repeat."""
    from functools import reduce

    base = rows.withColumn("_row", F.monotonically_increasing_id())
    own = base.withColumn("_place", F.row_number().over(Window.orderBy("_row")))

    def score(df: DataFrame, name: str) -> DataFrame:
        err = F.sum((F.col(y) - F.col("p")) ** 2)
        # R2 against the mean, as a model's score is
        total = F.sum(F.col(y) ** 2) - F.sum(F.col(y)) ** 2 / F.count("*")
        return predict(df).agg((1 - err / total).alias("r2")).select(F.lit(name).alias("feature"), "r2")

    parts = []
    for i, f in enumerate(features):
        for r in range(repeats):
            order = Window.orderBy(F.xxhash64(F.lit(seed * 1_000_003 + i * 1009 + r), "_row"), "_row")
            dealt = base.select(F.col(f).alias("_dealt"), F.row_number().over(order).alias("_place"))
            parts.append(score(own.join(dealt, "_place").withColumn(f, F.col("_dealt")).drop("_dealt"), f))
    fallen = reduce(DataFrame.unionByName, parts).groupBy("feature").agg(F.avg("r2").alias("after"))
    whole = score(own, "*").select(F.col("r2").alias("before"))
    names = rows.sparkSession.createDataFrame([(f, v) for f, v in venue_of.items()], "feature string, venue string")
    met = fallen.join(F.broadcast(whole), F.lit(True)).join(F.broadcast(names), "feature").where("venue is not null")
    return met.groupBy("venue").agg(F.sum(F.col("before") - F.col("after")).alias("importance"))


#: Features whose effect on the target may only be upward.
UPWARD = ("_ofi", "_signed_vol")


class Boosted:
    """Regression trees boosted on histograms, with one-sided features and a place for missing values.

    Rows stay in Spark; each level of a tree is one aggregation of gradient sums by node, feature and bin, of
    which the driver sees at most nodes x features x bins rows. A split of an upward feature whose left
    side would be above its right is not taken, and children keep within the bounds that such splits set.
    """

    def __init__(self, features: list[str], rounds: int = 1000, rate: float = 0.03, depth: int = 4, least: int = 200, l2: float = 1.0,
        patience: int = 20, bins: int = 64,
                 upward: tuple[str, ...] = UPWARD) -> None:
        self.features, self.rounds, self.rate, self.depth, self.least, self.l2, self.patience, self.bins = features, rounds, rate, depth, least, l2, patience, bins
        self.sign = [any(u in f for u in upward) for f in features]
        self.cuts: list[list[float]] = []
        self.start = 0.0
        self.trees: list[dict[int, tuple]] = []

    def _binned(self, rows: DataFrame) -> DataFrame:
        def bin_of(i: int, f: str, cuts: list[float]) -> Column:
            x = F.col(f).cast("double")
            at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < x)) if cuts else F.lit(0)
            return F.when(x.isNull() | F.isnan(x), -1).otherwise(at).cast("int").alias(f"_b{i}")

        return rows.select("*", *[bin_of(i, f, cuts) for i, (f, cuts) in enumerate(zip(self.features, self.cuts))])

    def _leaf(self, tree: dict[int, tuple]) -> Column:
        """A row's value of one tree, as nested conditions."""
        def walk(node: int) -> Column:
            if tree[node][0] == "leaf":
                return F.lit(float(tree[node][1]))
            _, f, cut, missing_left = tree[node]
            b = F.col(f"_b{f}")
            return F.when((b == -1) & F.lit(missing_left) | (b >= 0) & (b <= cut), walk(2 * node + 1)).otherwise(walk(2 * node + 2))
        return walk(0)

    def fit(self, fit: DataFrame, val: DataFrame | None = None, y: str = "y") -> Boosted:
        from quaymark.operators.quantiles import percentiles as of

        tall = fit.select(*[F.col(f).cast("double").alias(f) for f in self.features]).unpivot([], self.features, "_f", "_v")
        cuts = {r["_f"]: sorted(set(r["p"])) for r in of(tall, ["_f"], "_v", [k / self.bins for k in range(1, self.bins)]).collect()}
        self.cuts = [cuts.get(f, []) for f in self.features]
        self.start = float(fit.agg(F.avg(y)).first()[0] or 0.0)
        train = self._binned(fit).withColumn("_p", F.lit(self.start)).persist()
        held = None if val is None else self._binned(val).withColumn("_p", F.lit(self.start)).persist()
        best, since = float("inf"), 0
        for n in range(self.rounds):
            tree = self._grow(train, y)
            self.trees.append(tree)
            step = F.col("_p") + self._leaf(tree)
            train, held = (None if df is None else df.withColumn("_p", step) for df in (train, held))
            if n % 10 == 9:  # short lineages: written, not only planned
                train, held = (None if df is None else df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()
                    for df in (train, held))
            if held is not None:
                loss = held.agg(F.avg((F.col(y) - F.col("_p")) ** 2)).first()[0]
                if loss < best - 1e-12:
                    best, since = loss, 0
                else:
                    since += 1
                    if since >= self.patience:
                        break
        return self

    def _grow(self, rows: DataFrame, y: str) -> dict[int, tuple]:
        tree: dict[int, tuple] = {0: ("leaf", 0.0)}
        bounds = {0: (-float("inf"), float("inf"))}
        open_, node = [0], F.lit(0)
        totals = rows.agg(F.sum(F.col(y) - F.col("_p")).alias("g"), F.count("*").alias("n")).first()
        stats = {0: (totals["g"] or 0.0, totals["n"])}
        value = lambda g, n: g / (n + self.l2)
        for _ in range(self.depth):
            if not open_:
                break
            tagged = rows.withColumn("_node", node).where(F.col("_node").isin(open_))
            stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_b{i}").alias("b")) for i in range(len(self.features))]))
            cells = tagged.select("_node", (F.col(y) - F.col("_p")).alias("_g"), stacked.alias("c")).groupBy("_node", "c.f",
                "c.b").agg(F.sum("_g").alias("g"), F.count("*").alias("n")).collect()
            table: dict[int, dict[int, dict[int, tuple]]] = {}
            for r in cells:
                table.setdefault(r["_node"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["n"])
            after = []
            for at in open_:
                g, n = stats[at]
                lo, hi = bounds[at]
                choice = None
                for f, by_bin in sorted(table.get(at, {}).items()):
                    miss = by_bin.get(-1, (0.0, 0))
                    lg = ln = 0.0
                    for b in sorted(k for k in by_bin if k >= 0)[:-1]:
                        lg, ln = lg + by_bin[b][0], ln + by_bin[b][1]
                        for left in (True, False) if miss[1] else (True,):
                            l = (lg + miss[0], ln + miss[1]) if left else (lg, ln)
                            r = (g - l[0], n - l[1])
                            if min(l[1], r[1]) < self.least:
                                continue
                            vl, vr = (min(hi, max(lo, value(*x))) for x in (l, r))
                            if self.sign[f] and vl > vr:
                                continue
                            gain = sum(2 * v * x[0] - v * v * (x[1] + self.l2) for v, x in ((vl, l), (vr, r)))
                            if choice is None or gain > choice[0]:
                                choice = (gain, f, b, left, l, r, vl, vr)
                v = min(hi, max(lo, value(g, n)))
                if choice is None or choice[0] <= 2 * v * g - v * v * (n + self.l2) + 1e-12:
                    continue
                _, f, b, left, l, r, vl, vr = choice
                tree[at] = ("split", f, b, left)
                middle = (vl + vr) / 2
                for side, (stat, val) in enumerate(((l, vl), (r, vr)), 1):
                    child = 2 * at + side
                    stats[child], tree[child] = stat, ("leaf", val * self.rate)
                    bounds[child] = bounds[at] if not self.sign[f] else ((lo, middle) if side == 1 else (middle, hi))
                    after.append(child)
            open_ = after
            node = self._node(tree)
        if tree[0][0] == "leaf":
            tree[0] = ("leaf", value(*stats[0]) * self.rate)
        return tree

    @staticmethod
    def _node(tree: dict[int, tuple]) -> Column:
        def walk(node: int) -> Column:
            if tree[node][0] == "leaf":
                return F.lit(node)
            _, f, cut, missing_left = tree[node]
            b = F.col(f"_b{f}")
            return F.when((b == -1) & F.lit(missing_left) | (b >= 0) & (b <= cut), walk(2 * node + 1)).otherwise(walk(2 * node + 2))
        return walk(0)

    def predict(self, rows: DataFrame, name: str = "p") -> DataFrame:
        out = self._binned(rows).withColumn(name, F.lit(self.start))
        for i in range(0, len(self.trees), 16):
            out = out.withColumn(name, sum((self._leaf(t) for t in self.trees[i : i + 16]), F.col(name)))
        return out.drop(*[f"_b{i}" for i in range(len(self.features))])


def linear(beta: np.ndarray, intercept: float, features: list[str], medians: dict[str, float], name: str = "p"):
    """A fitted ridge as a function that adds its prediction; nulls take the feature's median."""
    def predict(df: DataFrame) -> DataFrame:
        x = sum((F.coalesce(F.col(f).cast("double"), F.lit(float(medians.get(f) or 0.0))) * float(b) for f, b in zip(features, beta)),
            F.lit(float(intercept)))
        return df.withColumn(name, x)
    return predict


def fit_models(fit: DataFrame, val: DataFrame, features: list[str], y: str = "y", boosted: dict | None = None) -> dict:
    """The baselines and the trees of one fold, each a function that adds ``p``: no view, ridge on order-flow
    imbalance, ridge on all features, and boosted trees that stop by the validation rows."""
    out = {"zero": lambda df: df.withColumn("p", F.lit(0.0))}
    flow_only = [f for f in features if "_ofi" in f]
    tall = fit.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], features, "_f", "_v")
    meds = {r["_f"]: r["p"][0] for r in percentiles(tall, ["_f"], "_v", [0.5]).collect()}
    for name, cols in (("ridge_ofi", flow_only), ("ridge_all", features)):
        if cols:
            out[name] = linear(*ridge(fit, cols, y), cols, meds)
    out["gbt"] = Boosted(features, **(boosted or {})).fit(fit, val, y).predict
    return out


def evaluate_folds(rows: DataFrame, dates: Sequence[str], features: list[str], horizon: int, y: str = "y", least: int = 8, test: int = 3,
    step: int = 3, boosted: dict | None = None) -> DataFrame:
    """Out-of-sample rows of every fold and model, strided and pooled: ``(fold, model, date, ts_ns, y, p)``."""
    parts = []
    for i, (train, held) in enumerate(walk_forward(dates, least, test, step)):
        split = fold_rows(rows, train, held, horizon)
        models = fit_models(split.where("part = 'fit'"), split.where("part = 'val'"), features, y, boosted)
        tested = split.where("part = 'test'").withColumn("_all", F.lit(0))
        kept = strided(tested, horizon, ["_all"], "ts_ns").drop("_all")
        parts += [m(kept).select(F.lit(i).alias("fold"), F.lit(name).alias("model"), "date", "ts_ns", F.col(y).alias("y"), "p") for name,
            m in models.items()]
    if not parts:
        raise ValueError("too few dates for a fold")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
