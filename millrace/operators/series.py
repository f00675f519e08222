"""Series analytics on long rows ``(name, date, value)``, unique by name and date.

A series has one row per period, so a group here is bounded by the calendar and may be ordered by a
plain window or handed to one pandas call. Tables with raw rows are aggregated to series first.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.stats import ols
from millrace.operators.aggregate import cents
from millrace.operators.ordered import add_group_stats, top_per_key
from millrace.operators.windows import runs, series_window

# ---- profiling


def porosity(series: DataFrame, tolerance: int = 0) -> DataFrame:
    """Share of missing points, share in blocks longer than ``tolerance``, and Σ block² of those."""
    blocks = runs(series, F.col("value").isNull())
    long_block = F.when(F.col("length") > tolerance, F.col("length"))
    per_name = blocks.groupBy("name").agg(
        F.sum(long_block).alias("_adjusted"),
        F.sum(long_block * long_block).alias("_penalty"),
        F.max("length").alias("_longest"),
    )
    sized = series.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("missing"))
    joined = sized.join(per_name, "name", "left")
    return joined.select(
        "name",
        "n",
        (F.col("missing") / F.col("n")).alias("total"),
        (F.coalesce("_adjusted", F.lit(0)) / F.col("n")).alias("adjusted"),
        F.coalesce("_penalty", F.lit(0)).alias("penalty"),
        F.coalesce("_longest", F.lit(0)).alias("longest"),
    )


def eda_summary(series: DataFrame, today: Column) -> DataFrame:
    """Zeros count as missing here. Robustness = 2/(share+1) + 2/(longest zero run+1) + 2/(porosity+1)."""
    holes = porosity(series.withColumn("value", F.nullif(F.col("value"), F.lit(0.0))))
    span = series.groupBy("name").agg(
        F.count_if(F.col("value") == 0).alias("zeros"), F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )
    share = F.round(F.col("zeros") / F.col("n"), 6)
    joined = span.join(holes, "name").withColumns({"pct_missing": share, "consecutive_zeros": F.col("longest")})
    robust = 2 / (F.col("pct_missing") + 1) + 2 / (F.col("consecutive_zeros") + 1) + 2 / (F.col("adjusted") + 1)
    return joined.select(
        "name", "n", "zeros", "consecutive_zeros", "pct_missing", "start_date", "end_date",
        (F.datediff("end_date", today) / 365).alias("forecast_years"),
        F.col("adjusted").alias("porosity"),
        robust.alias("robustness"),
    )


# ---- transforms


def logmod(col: Column, base: float = math.e, constant: float = 1.0, always_add: bool = True) -> Column:
    """sign(x)·log(|x| + c); zero gives log(c). With ``always_add`` off, c is used for zeros only."""
    scale = math.log(base)
    size = F.abs(col) + constant if always_add else F.abs(col)
    return F.when(col != 0, F.signum(col) * F.ln(size) / scale).when(col == 0, F.lit(math.log(constant) / scale))


def minmax_scale(series: DataFrame, out: str = "scaled") -> DataFrame:
    """Per series to [0, 1]; null for a constant series."""
    stats = add_group_stats(series, ["name"], _low=F.min("value"), _high=F.max("value"))
    return stats.withColumn(out, F.try_divide(F.col("value") - F.col("_low"), F.col("_high") - F.col("_low"))).drop("_low", "_high")


def zscore_scale(series: DataFrame, out: str = "scaled") -> DataFrame:
    """Per series to mean 0 and population deviation 1."""
    stats = add_group_stats(series, ["name"], _mean=F.avg("value"), _sd=F.stddev_pop("value"))
    return stats.withColumn(out, F.try_divide(F.col("value") - F.col("_mean"), F.col("_sd"))).drop("_mean", "_sd")


def log_levels(series: DataFrame) -> DataFrame:
    """Natural log of series that are positive throughout; other series pass."""
    stats = add_group_stats(series, ["name"], _low=F.min("value"))
    return stats.withColumn("value", F.when(F.col("_low") > 0, F.ln("value")).otherwise(F.col("value"))).drop("_low")


def scalings(series: DataFrame) -> DataFrame:
    """K04, K05, K06 beside each other (``unit``, ``z``, ``level``), from one aggregate and one join back."""
    stats = add_group_stats(series, ["name"], _low=F.min("value"), _high=F.max("value"), _mean=F.avg("value"), _sd=F.stddev_pop("value"))
    scaled = stats.withColumns(
        {
            "unit": F.try_divide(F.col("value") - F.col("_low"), F.col("_high") - F.col("_low")),
            "z": F.try_divide(F.col("value") - F.col("_mean"), F.col("_sd")),
            "level": F.when(F.col("_low") > 0, F.ln("value")).otherwise(F.col("value")),
        }
    )
    return scaled.drop("_low", "_high", "_mean", "_sd")


def seasonal_dummies(df: DataFrame, date: str = "date") -> DataFrame:
    """Eleven month indicators; December is the base."""
    return df.withColumns({f"m{m}": (F.month(date) == m).cast("int") for m in range(1, 12)})


def difference(series: DataFrame, lag: int = 1, out: str = "diff") -> DataFrame:
    """x[t] − x[t−lag]."""
    return series.withColumn(out, F.col("value") - F.lag("value", lag).over(series_window()))


def invert_log_difference(series: DataFrame, change: str, start: Column, out: str = "level") -> DataFrame:
    """Levels from log changes: start · exp(running sum)."""
    window = series_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return series.withColumn(out, F.exp(F.sum(change).over(window) + F.ln(start)))


# ---- tests on single series (numpy on one series at a time)

KPSS_CRITICAL_5 = 0.463  # fixed value: level stationarity, 5 %


def kpss_statistic(x: np.ndarray) -> float:
    """Level-stationarity statistic with a Bartlett long-run variance of trunc(3·√n/13) lags."""
    n = len(x)
    e = x - x.mean()
    lags = int(3 * math.sqrt(n) / 13)
    variance = e @ e / n + sum(2 / n * (1 - s / (lags + 1)) * (e[s:] @ e[:-s]) for s in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / n**2 / variance) if variance > 0 else float("nan")


def difference_order(x: np.ndarray, most: int = 2) -> int:
    """Differences needed until the statistic stays below its critical value."""
    order = 0
    while order < most and len(x) > 3:
        stat = kpss_statistic(x)
        if math.isnan(stat) or stat <= KPSS_CRITICAL_5:
            break
        x, order = np.diff(x), order + 1
    return order


def stationarity(series: DataFrame) -> DataFrame:
    """Statistic of the level and order of differencing per series."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("date")["value"].dropna().to_numpy(float)
        stat = kpss_statistic(x) if len(x) > 3 else float("nan")
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "kpss": [stat], "order": [difference_order(x)]})

    return series.select("name", "date", "value").groupBy("name").applyInPandas(one, "name string, kpss double, order int")


def spectral_period(x: np.ndarray, longest: int = 60) -> int:
    """Dominant period: peak of the spectrum of an autoregression chosen by AIC (Yule–Walker fit)."""
    n = len(x)
    if n < 8 or np.ptp(x) == 0:
        return 1
    t = np.arange(n)
    e = x - np.polyval(np.polyfit(t, x, 1), t)
    most = min(n - 1, int(10 * math.log10(n)))
    acov = np.array([e[: n - k] @ e[k:] / n for k in range(most + 1)])
    if acov[0] <= 1e-12:
        return 1
    best, coefs, var = (n * math.log(acov[0]), np.empty(0), acov[0]), np.empty(0), acov[0]
    for order in range(1, most + 1):  # Levinson recursion
        reflection = (acov[order] - coefs @ acov[order - 1 : 0 : -1][: order - 1]) / var if order > 1 else acov[1] / var
        coefs = np.append(coefs - reflection * coefs[::-1], reflection)
        var *= 1 - reflection**2
        if var <= 0:
            break
        aic = n * math.log(var) + 2 * order
        if aic < best[0]:
            best = (aic, coefs.copy(), var)
    freq = np.linspace(0, 0.5, 500)
    lags = np.arange(1, len(best[1]) + 1)
    response = 1 - (np.exp(-2j * np.pi * np.outer(freq, lags)) @ best[1] if len(lags) else 0)
    spectrum = best[2] / np.abs(response * np.ones(500)) ** 2
    if spectrum.max() / acov[0] <= 1 + 1e-9:
        return 1
    at = int(spectrum.argmax())
    if at == 0:
        rising = np.flatnonzero(np.diff(spectrum) > 0)
        if len(rising) == 0:
            return 1
        at = int(rising[0] + spectrum[rising[0] :].argmax())
    period = int(math.floor(1 / freq[at] + 0.5)) if freq[at] > 0 else 1
    return 1 if period > longest else period


def dominant_period(series: DataFrame) -> DataFrame:
    """Dominant period per series, 1 when there is none or it exceeds 60."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("date")["value"].dropna().to_numpy(float)
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "period": [spectral_period(x)]})

    return series.select("name", "date", "value").groupBy("name").applyInPandas(one, "name string, period int")


# 5 % critical values of the unit-root tests by number of observations.
ADF_SIZES = (25, 50, 100, 250, 500)
PHI1_CRITICAL_5 = (5.18, 4.86, 4.71, 4.63, 4.61, 4.59)
TAU1_CRITICAL_5 = -1.95


def adf_statistics(x: np.ndarray, lags: int, drift: bool) -> tuple[float, float]:
    """(tau, phi1) of the augmented regression with the lag number of least BIC; phi1 is nan without drift."""
    dx = np.diff(x)
    start = lags  # the same rows for every candidate
    y = dx[start:]
    level = x[start:-1]
    ones = [np.ones(len(y))] if drift else []

    def design(p: int, with_level: bool = True) -> np.ndarray:
        cols = ([level] if with_level else []) + (ones if with_level else []) + [dx[start - k : len(dx) - k] for k in range(1, p + 1)]
        return np.column_stack(cols) if cols else np.empty((len(y), 0))

    def bic(p: int) -> float:
        m = design(p)
        return len(y) * math.log(max(ols(y, m)[1] / len(y), 1e-300)) + m.shape[1] * math.log(len(y))

    p = min(range(1, lags + 1), key=bic) if lags else 0
    m = design(p)
    beta, rss, inverse = ols(y, m)
    df = len(y) - m.shape[1]
    tau = float(beta[0] / math.sqrt(rss / df * inverse[0, 0]))
    if not drift:
        return tau, float("nan")
    limited = design(p, with_level=False)
    rss0 = ols(y, limited)[1] if limited.shape[1] else float(y @ y)
    return tau, float((rss0 - rss) / 2 / (rss / df))


def unit_root_statistics(series: DataFrame, lags: int = 0) -> DataFrame:
    """The statistics themselves, phi1 of the level and tau of the first difference, with at most ``lags`` lags."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("date")["value"].dropna().to_numpy(float)
        known = len(x) >= 3 * lags + 5 and np.ptp(x) > 0
        phi1, tau = (adf_statistics(x, lags, True)[1], adf_statistics(np.diff(x), lags, False)[0]) if known else (None, None)
        return pd.DataFrame([(pdf["name"].iloc[0], phi1, tau)], columns=["name", "phi1", "tau"])

    return series.select("name", "date", "value").groupBy("name").applyInPandas(one, "name string, phi1 double, tau double")


def unit_roots(series: DataFrame, lags: int = 12) -> DataFrame:
    """Level (with drift, phi1) and first difference (tau, one-sided) with verdicts."""
    schema = "name string, level_stat double, level_verdict string, diff_stat double, diff_verdict string"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("date")["value"].dropna().to_numpy(float)
        name = pdf["name"].iloc[0]
        if len(x) < 3 * lags + 5 or np.ptp(x) == 0:
            return pd.DataFrame([(name, None, "too short", None, "too short")], columns=["name", "level_stat", "level_verdict", "diff_stat", "diff_verdict"])
        phi1 = adf_statistics(x, lags, True)[1]
        tau = adf_statistics(np.diff(x), lags, False)[0]
        critical = PHI1_CRITICAL_5[int(np.searchsorted(ADF_SIZES, len(x)))]

        def verdict(ok: bool) -> str:
            return "Stationary" if ok else "Unit Root"

        return pd.DataFrame(
            [(name, round(phi1, 2), verdict(phi1 > critical), round(tau, 2), verdict(tau < TAU1_CRITICAL_5))],
            columns=["name", "level_stat", "level_verdict", "diff_stat", "diff_verdict"],
        )

    return series.select("name", "date", "value").groupBy("name").applyInPandas(one, schema)


# ---- resampling and selection


def resample(df: DataFrame, keys: Sequence[str], ts: str, unit: str, value: str) -> DataFrame:
    """Count, mean and sum per hour or day of raw rows."""
    return df.groupBy(*keys, F.date_trunc(unit, ts).alias(ts)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.sum(value).alias("total")
    )


def fill_grid(series: DataFrame, unit: str = "day", fill: float | None = None) -> DataFrame:
    """Every date between a series' first and last; missing values are null or ``fill``."""
    step = F.expr({"day": "interval 1 day", "month": "interval 1 month"}[unit])
    span = series.groupBy("name").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = span.select("name", F.explode(F.sequence("lo", "hi", step)).alias("date"))
    joined = spine.join(series.select("name", "date", "value"), ["name", "date"], "left")
    return joined if fill is None else joined.na.fill(fill, ["value"])


def split_by_date(series: DataFrame, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Training rows up to the cut and validation rows after it."""
    return series.where(F.col("date") <= cut), series.where(F.col("date") > cut)


def md5_draw(*parts: Column) -> Column:
    """A number from 0 to 2**32 − 1 from the first 8 hex digits of the md5 of the parts, joined by ``|``."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_by_hash(df: DataFrame, columns: Sequence[str], share: float = 0.8, seed: int = 0) -> DataFrame:
    """Repeatable random split by a digest of seed and key, which other systems can draw alike; ``part`` is train or test."""
    draw = md5_draw(F.lit(str(seed)), *[F.col(c) for c in columns]) / F.lit(float(1 << 32))
    return df.withColumn("part", F.when(draw < share, "train").otherwise("test"))


def select_series(series: DataFrame, start: Column, end: Column, min_coverage: float, expected: Column | None = None) -> DataFrame:
    """Series whose values cover at least ``min_coverage`` of the days between two dates."""
    inside = series.where((F.col("date") >= start) & (F.col("date") <= end) & F.col("value").isNotNull())
    wanted = F.datediff(end, start) + 1 if expected is None else expected
    covered = inside.groupBy("name").agg((F.count(F.lit(1)) / wanted).alias("coverage")).where(F.col("coverage") >= min_coverage)
    return inside.join(covered.select("name"), "name", "left_semi")


# ---- indicators


def technical_indicators(series: DataFrame, n: int = 14, roc: int = 10, sma: int = 12) -> DataFrame:
    """RSI, Williams %R, price rate of change and simple moving average, null until the frame is full."""
    w = series_window()
    step = F.col("value") - F.lag("value").over(w)
    frame, average = w.rowsBetween(-(n - 1), 0), w.rowsBetween(-(sma - 1), 0)
    base = series.select("*", F.row_number().over(w).alias("_rn"), F.greatest(step, F.lit(0.0)).alias("_up"), F.greatest(-step, F.lit(0.0)).alias("_down"))
    base = base.withColumns({"_up": F.when(F.col("_rn") > 1, F.col("_up")), "_down": F.when(F.col("_rn") > 1, F.col("_down"))})
    gain, loss = F.avg("_up").over(frame), F.avg("_down").over(frame)
    low, high = F.min("value").over(frame), F.max("value").over(frame)
    rsi = F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
    return base.select(
        "name", "date", "value",
        F.when(F.col("_rn") > n, rsi).alias("rsi"),
        F.when(F.col("_rn") >= n, F.try_divide(high - F.col("value"), high - low) * -100).alias("williams_r"),
        F.try_divide(F.col("value") - F.lag("value", roc).over(w), F.lag("value", roc).over(w)).alias("proc"),
        F.when(F.col("_rn") >= sma, F.avg("value").over(average)).alias("sma"),
    )


#: Rows of a series that one window of the exponential average holds.
SLICE = 256


def add_ema(series: DataFrame, column: str, n: int, out: str) -> DataFrame:
    """Exponential average with ratio 2/(n+1) of a column of ``(name, date, …)``, started at the mean of the first n values.

    Every step is an affine map of the value before it, and maps are put together in any grouping: a series is cut into
    slices, each slice is a window of its own, and the few slice ends of a series are folded in order. Null until n values
    are known; a value missing later leaves all that follow null, as the recursion would.
    """
    keep = 1 - 2 / (n + 1)
    whole = Window.partitionBy("name")
    value = F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double"))
    at = F.row_number().over(whole.orderBy("date"))
    numbered = series.withColumn("_x", value).withColumn("_at", at)
    first = F.min(F.when(F.col("_x").isNotNull(), F.col("_at"))).over(whole)
    placed = numbered.withColumn("_pos", F.col("_at") - first - (n - 1))
    seed = F.when(F.count(F.when(F.col("_pos").between(1 - n, 0), F.col("_x"))).over(whole) == n, F.sum(F.when(F.col("_pos").between(1 - n, 0), F.col("_x"))).over(whole) / n)
    term = F.when(F.col("_pos") == 0, seed).when(F.col("_pos") > 0, F.col("_x") * (1 - keep))
    placed = placed.withColumn("_z", term).withColumn("_slice", F.when(F.col("_pos") >= 0, F.floor(F.col("_pos") / SLICE)))
    inside = Window.partitionBy("name", "_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.pmod(F.col("_pos"), F.lit(SLICE))
    # NaN stands for what a missing value breaks, and passes through all sums
    term = F.coalesce(F.col("_z"), F.lit(math.nan)) * F.pow(F.lit(keep), -step)
    local = F.pow(F.lit(keep), step) * F.sum(term).over(inside)
    sliced = placed.withColumn("_local", F.when(F.col("_pos") >= 0, local)).withColumn("_step", step)
    ends = sliced.where(F.col("_step") == SLICE - 1).where("_pos >= 0").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("_slice", F.struct("_local").alias("end")))).alias("_ends"))
    none = F.array(F.lit(0.0))
    folded = F.aggregate("_ends", none, lambda held, end: F.array_append(held, F.element_at(held, -1) * keep**SLICE + end["end"]["_local"]))
    carried = sliced.join(ends.select("name", folded.alias("_carry")), "name", "left")
    before = F.when(F.col("_slice") == 0, F.lit(0.0)).otherwise(F.get("_carry", F.col("_slice").cast("int")))
    average = F.col("_local") + F.pow(F.lit(keep), F.col("_step") + 1) * before
    return carried.withColumn(out, F.when(~F.isnan(average), average)).select(*series.columns, out)


def macd(series: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Difference of two exponential averages and its own average."""
    both = add_ema(add_ema(series.select("name", "date", "value"), "value", fast, "_fast"), "value", slow, "_slow")
    line = both.select("name", "date", (F.col("_fast") - F.col("_slow")).alias("macd"))
    return add_ema(line, "macd", signal, "signal")


def window_trading(series: DataFrame, window: int, steps: int) -> DataFrame:
    """Expected prices ``steps`` periods ahead, each from the range and position of the one before.

    Only the last ``window`` values of a series are looked at; series with fewer have no forecast.
    """
    schema = "name string, step int, position double, forecast double, low double, high double"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        prices = pdf.sort_values("date")["value"].tolist()
        rows = []
        if len(prices) == window:
            for step in range(1, steps + 1):
                low, high = min(prices), max(prices)
                spread = (prices[-1] - low) / (high - low) if high > low else float("nan")
                position = spread + 0.1 if spread <= 0.8 else spread - 0.1
                price = (high - low) * position + low
                prices = [*prices[1:], price]
                rows.append((pdf["name"].iloc[0], step, position, price, min(prices), max(prices)))
        return pd.DataFrame(rows, columns=["name", "step", "position", "forecast", "low", "high"])

    known = series.select("name", "date", "value").where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    return top_per_key(known, ["name"], [F.desc("date")], window).groupBy("name").applyInPandas(one, schema)


def mean_price(col: str) -> Column:
    """Mean of two-decimal prices from an exact sum."""
    return F.sum(cents(col)).cast("double") / F.count(col)


def futures_spread(contracts: DataFrame, spot: DataFrame) -> DataFrame:
    """Monthly mean close by maturity against spot, and the log spread scaled to a year.

    ``contracts``: trade_date, expiry, close. ``spot``: trade_date, spot.
    """
    months = (F.year("expiry") - F.year("trade_date")) * 12 + F.month("expiry") - F.month("trade_date")
    joined = contracts.join(spot, "trade_date").withColumn("maturity", months).na.drop("any")
    monthly = joined.groupBy(F.trunc("trade_date", "month").alias("month"), "maturity").agg(
        mean_price("close").alias("futures"), mean_price("spot").alias("spot")
    )
    spread = (F.ln("futures") - F.ln("spot")) / F.ln("spot") * F.try_divide(F.lit(12.0), F.col("maturity"))
    return monthly.withColumn("excess_return", spread)


def net_length(weekly: DataFrame, long_col: str, short_col: str) -> DataFrame:
    """Change of long positions less change of short ones, per week."""
    w = series_window()
    change = {c: F.col(c) - F.lag(c).over(w) for c in (long_col, short_col)}
    return weekly.withColumn("net_length", change[long_col] - change[short_col])


# ---- accuracy and residuals


def accuracy(forecasts: DataFrame, horizons: Mapping[str, Column], start: Column, last_known: Column) -> DataFrame:
    """MAPE, RMSE, min/max accuracy and direction hit rates per series and horizon.

    ``forecasts``: name, date, actual, forecast. Directions are month on month and against the last
    known actual. Each row is repeated once per horizon it belongs to.
    """
    w = series_window()
    ends = F.array(*[F.struct(F.lit(k).alias("horizon"), end.alias("end")) for k, end in horizons.items()])
    stepped = forecasts.select(
        "*",
        (F.signum(F.col("forecast") - F.lag("forecast").over(w)) == F.signum(F.col("actual") - F.lag("actual").over(w))).alias("_mom"),
        F.when(
            F.lag("actual").over(w).isNotNull(),
            F.signum(F.col("forecast") - last_known) == F.signum(F.col("actual") - last_known),
        ).alias("_long"),
    ).withColumn("_h", F.explode(ends))  # after the windows, which must see each row once
    error = F.col("actual") - F.col("forecast")
    inside = stepped.where((F.col("date") >= start) & (F.col("date") <= F.col("_h.end")))
    return inside.groupBy("name", F.col("_h.horizon").alias("horizon")).agg(
        F.count(F.lit(1)).alias("periods"),
        F.avg(F.abs(F.try_divide(error, F.col("actual")))).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.try_divide(F.least("actual", "forecast"), F.greatest("actual", "forecast"))).alias("minmax_accuracy"),
        F.avg(F.col("_mom").cast("int")).alias("direction_mom"),
        F.avg(F.col("_long").cast("int")).alias("direction_long"),
    )


def chi2_tail_even(stat: Column, df: int) -> Column:
    """P(X² > stat) for an even number of degrees of freedom, in closed form."""
    if df % 2:
        raise ValueError("degrees of freedom must be even")
    half = stat / 2
    total = F.lit(0.0)
    for k in range(df // 2):
        total = total + F.pow(half, F.lit(float(k))) / math.factorial(k)
    return F.exp(-half) * total


def residual_tests(errors: DataFrame, lags: int = 20) -> DataFrame:
    """Jarque–Bera on the errors and Ljung–Box on their differences, with p-values.

    ``errors``: name, date, value. Lag products are window expressions summed per series.
    """
    moments = errors.groupBy("name").agg(
        F.count("value").alias("n"), F.skewness("value").alias("_skew"), F.kurtosis("value").alias("_kurt")
    )
    jb = F.col("n") / 6 * (F.col("_skew") ** 2 + F.col("_kurt") ** 2 / 4)
    diffs = difference(errors).where(F.col("diff").isNotNull())
    centred = add_group_stats(diffs, ["name"], _mean=F.avg("diff")).withColumn("_d", F.col("diff") - F.col("_mean"))
    w = series_window()
    products = centred.select("name", "_d", *[(F.col("_d") * F.lag("_d", k).over(w)).alias(f"_p{k}") for k in range(1, lags + 1)])
    sums = products.groupBy("name").agg(
        F.count("_d").alias("_m"), F.sum(F.col("_d") ** 2).alias("_ss"), *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, lags + 1)]
    )
    q = F.lit(0.0)
    for k in range(1, lags + 1):
        q = q + F.try_divide((F.col(f"_p{k}") / F.col("_ss")) ** 2, F.col("_m") - k)
    box = sums.select("name", (F.col("_m") * (F.col("_m") + 2) * q).alias("ljung_box"))
    out = moments.select("name", "n", jb.alias("jarque_bera")).join(box, "name")
    return out.select(
        "*", chi2_tail_even(F.col("jarque_bera"), 2).alias("jb_p"), chi2_tail_even(F.col("ljung_box"), lags).alias("lb_p")
    )
