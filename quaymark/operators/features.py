"""Grid-aligned point-in-time features and forward targets.

Bars are half-open to the left: bar t holds what came in (t - width, t]. Frames are counted in
rows of a gapless grid, and a window counts only when it is full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def bar(ts: str, width: int) -> Column:
    return F.expr(f"(({ts} + {width - 1}) div {width}) * {width}")


def grid(series: DataFrame, by: list[str], ts: str, width: int) -> DataFrame:
    """Every bar end from the first event's bar to the last's, for each ``by``."""
    ends = series.groupBy(*by).agg(F.min(bar(ts, width)).alias("lo"), F.max(bar(ts, width)).alias("hi"))
    return ends.select(*by, F.explode(F.sequence("lo", "hi", F.lit(width).cast("long"))).alias(ts))


def flow(trades: DataFrame, by: list[str], ts: str, width: int) -> DataFrame:
    """``trades(price, size, side)`` by bar: signed volume, volume, trades, notional and VWAP."""
    signed = F.when(F.col("side") == "bid", F.col("size")).otherwise(-F.col("size"))
    out = trades.groupBy(*by, bar(ts, width).alias(ts)).agg(F.sum(signed).alias("signed_vol"), F.sum("size").alias("volume"),
        F.count("*").alias("n_trades"), F.sum(F.col("price") * F.col("size")).alias("notional"))
    return out.withColumn("vwap", F.try_divide("notional", "volume"))


def ofi(quotes: DataFrame, by: list[str], ts: str, order: str, gap: int) -> DataFrame:
    """Level-1 order-flow imbalance of each quote; 0 on the first and across gaps of more than ``gap``."""
    w = Window.partitionBy(*by).orderBy(ts, order)
    lag = lambda c: F.lag(c).over(w)
    bid = F.when(F.col("bid") > lag("bid"), F.col("bid_sz")).when(F.col("bid") == lag("bid"),
        F.col("bid_sz") - lag("bid_sz")).otherwise(-lag("bid_sz"))
    ask = F.when(F.col("ask") < lag("ask"), F.col("ask_sz")).when(F.col("ask") == lag("ask"),
        F.col("ask_sz") - lag("ask_sz")).otherwise(-lag("ask_sz"))
    fresh = F.col(ts) - lag(ts) <= gap
    return quotes.withColumn("ofi", F.when(fresh, bid - ask).otherwise(F.lit(0)))


def rolling(col: str, over: WindowSpec, rows: int, live: str | None = None) -> Column:
    """Sum of the last ``rows`` rows: null unless there are so many, none is null, and all are live."""
    frame = over.rowsBetween(-(rows - 1), 0)
    full = F.count(col).over(frame) == rows
    if live:
        full &= F.coalesce(F.min(F.col(live).cast("int")).over(frame) == 1, F.lit(False)) & (F.count(live).over(frame) == rows)
    return F.when(full, F.sum(col).over(frame))


def at_offset(value: str, age: str, over: WindowSpec, k: int, max_age: int) -> Column:
    """The value ``k`` rows on (back, if negative), if it was no older than ``max_age`` there."""
    move = (lambda c: F.lead(c, k).over(over)) if k > 0 else (lambda c: F.lag(c, -k).over(over))
    return F.when(move(age) <= max_age, move(value))


def returns_bps(mid: str, age: str, over: WindowSpec, k: int, max_age: int) -> Column:
    """Trailing (k < 0) or forward (k > 0) return in basis points, both ends fresh."""
    now = F.when(F.col(age) <= max_age, F.col(mid))
    then = at_offset(mid, age, over, k, max_age)
    return (F.try_divide(now, then) - 1) * 1e4 if k < 0 else (F.try_divide(then, now) - 1) * 1e4


def imbalance(bid_sz: Column, ask_sz: Column) -> Column:
    return F.try_divide(bid_sz - ask_sz, bid_sz + ask_sz)


def microprice_dev(bid: Column, ask: Column, bid_sz: Column, ask_sz: Column) -> Column:
    """Size-weighted price over the mid, in basis points."""
    mid = (bid + ask) / 2
    micro = F.try_divide(bid * ask_sz + ask * bid_sz, bid_sz + ask_sz)
    return F.try_divide(micro - mid, mid) * 1e4


def dead_zone(ret: Column, spread_bps: Column, share: float = 0.5) -> Column:
    """-1, 0 or 1: whether a move clears a share of the spread; null where either is null."""
    cut = spread_bps * share
    return F.when(ret.isNull() | spread_bps.isNull(), None).when(ret > cut, 1).when(ret < -cut, -1).otherwise(0).cast("tinyint")


def clean(rows: DataFrame, target: str, ages: dict[str, float]) -> DataFrame:
    """Rows with a target whose ages are each null or within their tolerance."""
    cond = F.col(target).isNotNull()
    for c, most in ages.items():
        cond &= F.col(c).isNull() | (F.col(c) <= most)
    return rows.where(cond)


def funding_countdown(next_ts: Column, ts: Column) -> Column:
    return (next_ts - ts) / 1e9


def oi_change_bps(now: Column, before: Column) -> Column:
    return F.when(before > 0, (now / before - 1) * 1e4)


#: Windows in bars, and staleness that is accepted, in milliseconds.
FLOW_WINDOWS, RETURN_WINDOWS, HORIZONS = (5, 30, 300), (1, 5, 30, 300), (1, 5, 30)
MAX_AGE_MS, MAX_TAPE_AGE_MS = 5_000, 60_000
DEPTH_RUNGS = (5, 10)


def window_tolerance(bars: int, floor: int, bar: int, share: float = 0.10) -> int:
    """The age that the far end of a window of ``bars`` may have: a share of the window, at least ``floor``, in the unit of ``bar``."""
    return max(floor, int(bars * bar * share))


def captured(live: str, over: WindowSpec, rows: int) -> Column:
    """Whether the capture was live in every one of the last ``rows`` bars; null until there are so many or if one is unknown."""
    frame = over.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(live).over(frame) == rows, F.min(F.col(live).cast("int")).over(frame) == 1)


def flow_windows(cols: list[str], live: str, over: WindowSpec, windows: tuple[int, ...] = FLOW_WINDOWS) -> dict[str, Column]:
    """``{col}_{w}``: sums over full windows in which the capture was live throughout."""
    return {f"{c}_{w}": rolling(c, over, w, live) for w in windows for c in cols}


def trailing(mid: str, age: str, over: WindowSpec, bar: int, floor: int, windows: tuple[int, ...] = RETURN_WINDOWS) -> dict[str, Column]:
    """``ret_bps_{w}``: returns over trailing windows, the far end no staler than its window allows."""
    far = lambda w: at_offset(mid, age, over, -w, window_tolerance(w, floor, bar))
    return {f"ret_bps_{w}": (F.try_divide(F.col(mid), far(w)) - 1) * 1e4 for w in windows}


def targets(mid: str, spread_bps: str, age: str, over: WindowSpec, bar: int, floor: int, horizons: tuple[int, ...] = HORIZONS,
    prefix: str = "y") -> dict[str, Column]:
    """``{prefix}_ret_bps_{h}`` and its dead-zone class ``{prefix}_dz_{h}``: the only columns that look forward."""
    out = {}
    for h in horizons:
        ret = (F.try_divide(at_offset(mid, age, over, h, window_tolerance(h, floor, bar)), F.col(mid)) - 1) * 1e4
        out[f"{prefix}_ret_bps_{h}"] = ret
        out[f"{prefix}_dz_{h}"] = dead_zone(ret, F.col(spread_bps))
    return out


def depth_shape(columns: list[str], mid: Column, rungs: tuple[int, ...] = DEPTH_RUNGS) -> dict[str, Column]:
    """The book beyond its touch: imbalance at each rung, how far ten levels reach on each side, and their size.

    Dates whose quotes lack the depth columns get nulls, never zeros."""
    none = F.lit(None).cast("double")
    out = {}
    for n in rungs:
        out[f"depth_imb_{n}"] = imbalance(F.col(f"bid_depth_{n}"), F.col(f"ask_depth_{n}")) if f"bid_depth_{n}" in columns else none
    deep = "bid_px_10" in columns
    out["bid_span_bps"] = F.try_divide(mid - F.col("bid_px_10"), mid) * 1e4 if deep else none
    out["ask_span_bps"] = F.try_divide(F.col("ask_px_10") - mid, mid) * 1e4 if deep else none
    out["depth_10"] = F.col("bid_depth_10") + F.col("ask_depth_10") if deep else none
    return out


def liquidations(rows: DataFrame, by: list[str], ts: str, width: int) -> DataFrame:
    """Forced flow by bar, signed by the side of the forced order, and how many orders."""
    signed = F.when(F.col("side") == "bid", F.col("filled_size")).otherwise(-F.col("filled_size"))
    return rows.groupBy(*by, bar(ts, width).alias(ts)).agg(F.sum(signed).alias("liq_flow"), F.count("*").alias("n_liqs"))


def mark_basis(mark: Column, index: Column) -> Column:
    """The mark's premium over the index in basis points; null where the index is not positive."""
    return F.when(index > 0, (mark - index) / index * 1e4)


def basis_changes(basis: str, age: str, over: WindowSpec, bar: int, floor: int, windows: tuple[int, ...] = FLOW_WINDOWS) -> dict[str,
    Column]:
    return {f"basis_chg_{w}": F.col(basis) - at_offset(basis, age, over, -w, window_tolerance(w, floor, bar)) for w in windows}


def oi_changes(level: str, age: str, over: WindowSpec, bar: int, floor: int, windows: tuple[int, ...] = FLOW_WINDOWS) -> dict[str, Column]:
    """``oi_chg_bps_{w}``: open interest against what it was; the level itself is no feature."""
    return {f"oi_chg_bps_{w}": oi_change_bps(F.col(level), at_offset(level, age, over, -w, window_tolerance(w, floor, bar)))
        for w in windows}


def leg_prefix(exchange: Column | str) -> Column | str:
    """A venue's column prefix: its name alone, hyphens as underscores."""
    return exchange.replace("-", "_") if isinstance(exchange, str) else F.replace(exchange, F.lit("-"), F.lit("_"))


def legs(quotes: DataFrame, symbols: list[str]) -> list[tuple[str, str, str]]:
    """``(prefix, symbol, exchange)`` of every venue that quotes one of ``symbols``; fails if one quotes two of them.

    The driver sees one row for each venue and symbol."""
    found = sorted((r["exchange"], r["symbol"]) for r in quotes.where(F.col("symbol").isin(*symbols)).select("exchange",
        "symbol").distinct().collect())
    owner: dict[str, str] = {}
    out = []
    for exchange, symbol in found:
        prefix = leg_prefix(exchange)
        if prefix in owner:
            raise ValueError(f"{exchange} quotes {owner[prefix]} and {symbol}: both would be columns of {prefix}")
        owner[prefix] = symbol
        out.append((prefix, symbol, exchange))
    return sorted(out, key=lambda x: (symbols.index(x[1]), x[0]))


def feature_matrix(quotes: DataFrame, nbbo: DataFrame, trades: DataFrame, symbol: str, extra: tuple[str, ...] = (),
    bar_ns: int = 1_000_000_000,
                   marks: DataFrame | None = None, interest: DataFrame | None = None, forced: DataFrame | None = None,
                   max_age_ms: int = MAX_AGE_MS, max_tape_age_ms: int = MAX_TAPE_AGE_MS) -> DataFrame:
    """The features and targets of one instrument on its grid, one row per date and bar.

    ``quotes(date, exchange, symbol, ts_ns, arrival, bid, ask, bid_sz, ask_sz[, depth])``, ``nbbo(date, ts_ns, bid, ask,
    n_venues)``, ``trades(date, exchange, symbol, ts_ns, price, size, side)``; perpetual tapes ``marks``,
    ``interest`` and ``forced`` where there are any. The grid of a date spans the instrument's own quotes; symbols in
    ``extra`` add venues and nothing else. The consolidated book is the capture's clock: windows
    over flow need it to be fresh in every bar. Columns are those of :mod:`quaymark.operators.grammar`.
    """
    from functools import reduce

    from .asof import asof_join

    bar_ms = bar_ns // 1_000_000
    w = Window.partitionBy("date").orderBy("ts_ns")
    wanted = legs(quotes, [symbol, *extra])
    own = [x for x in wanted if x[1] == symbol]
    if not own:
        raise ValueError(f"no quotes of {symbol}: no grid and no target")
    anchor = quotes.where((F.col("symbol") == symbol) & F.col("exchange").isin(*[x[2] for x in own]))
    ends = anchor.groupBy("date").agg((F.expr(f"min(ts_ns) div {bar_ns}") * bar_ns).alias("lo"),
        (F.expr(f"max(ts_ns) div {bar_ns}") * bar_ns).alias("hi"))
    bars = ends.select("date", F.explode(F.sequence("lo", "hi", F.lit(bar_ns).cast("long"))).alias("ts_ns"))
    ms = lambda c: F.col(c) / 1e6

    def aligned(series: DataFrame, order: list[str], cols: dict[str, Column], age: str) -> DataFrame:
        shaped = series.select("date", "ts_ns", *order, *[v.cast("double").alias(k) for k, v in cols.items()])
        return asof_join(bars, shaped, ["date"], "ts_ns", order, list(cols), "_age").withColumn(age, ms("_age")).drop("_age")

    mid = lambda b, a: (F.col(b) + F.col(a)) / 2
    spread = lambda b, a: F.try_divide(F.col(a) - F.col(b), (F.col(b) + F.col(a)) / 2) * 1e4
    best = aligned(nbbo, [], {"nbbo_mid": mid("bid", "ask"), "nbbo_spread_bps": spread("bid", "ask"), "nbbo_n_venues": F.col("n_venues")},
        "nbbo_age_ms")
    best = best.withColumn("nbbo_n_venues", F.col("nbbo_n_venues").cast("long"))
    live = best.select("date", "ts_ns", (F.col("nbbo_age_ms") <= max_age_ms).alias("_live"))
    frames = [best]

    def named(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("date", "ts_ns")) -> DataFrame:
        return df.select(*keep, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keep])

    for prefix, sym, exchange in wanted:
        q = doubles_of(quotes.where((F.col("exchange") == exchange) & (F.col("symbol") == sym)))
        shape = {"mid": mid("bid", "ask"), "bid": F.col("bid"), "ask": F.col("ask"), "bid_sz": F.col("bid_sz"), "ask_sz": F.col("ask_sz"),
            "spread_bps": spread("bid", "ask"),
                 "imbalance": imbalance(F.col("bid_sz"), F.col("ask_sz")),
                 "micro_dev": F.try_divide(F.col("bid") * F.col("ask_sz") + F.col("ask") * F.col("bid_sz"),
                 F.col("bid_sz") + F.col("ask_sz")) - mid("bid", "ask"),
                 **depth_shape(q.columns, mid("bid", "ask"))}
        book = aligned(q, ["arrival"], shape, "age_ms")
        pressure = ofi(q, ["date"], "ts_ns", "arrival", max_age_ms * 1_000_000).groupBy("date",
            bar("ts_ns", bar_ns).alias("ts_ns")).agg(F.sum("ofi").cast("double").alias("ofi"))
        leg = book.join(pressure, ["date", "ts_ns"], "left").na.fill({"ofi": 0.0}).join(live, ["date", "ts_ns"])
        leg = leg.select("*", *[v.alias(k) for k, v in {**trailing("mid", "age_ms", w, bar_ms, max_age_ms),
            **flow_windows(["ofi"], "_live", w)}.items()],
                         *[v.alias(k) for k, v in targets("mid", "spread_bps", "age_ms", w, bar_ms, max_age_ms).items()]).drop("_live")
        ys = [c for c in leg.columns if c.startswith("y_")]
        frames.append(named(leg.drop(*ys), prefix).join(leg.select("date", "ts_ns", *[F.col(c).alias(f"y_{prefix}{c[1:]}") for c in ys]),
            ["date", "ts_ns"]))

    def venues(df: DataFrame) -> list[str]:
        return sorted(r[0] for r in df.where(F.col("symbol").isin(symbol, *extra)).select("exchange").distinct().collect())

    def one(df: DataFrame, exchange: str) -> DataFrame:
        return doubles_of(df.where((F.col("exchange") == exchange) & F.col("symbol").isin(symbol, *extra)))

    def summed(per_bar: DataFrame, cols: dict[str, str]) -> DataFrame:
        full = bars.join(per_bar, ["date", "ts_ns"], "left").join(live, ["date", "ts_ns"])
        full = full.select("date", "ts_ns", "_live", *[F.coalesce(F.col(c).cast(k), F.lit(0).cast(k)).alias(c) for c, k in cols.items()],
            *[c for c in per_bar.columns if c not in ("date", "ts_ns", *cols)])
        rolled = [c for c in cols if c != "n_trades"]
        return full.select("*", *[v.alias(k) for k, v in flow_windows(rolled, "_live", w).items()]).drop("_live")

    for exchange in venues(trades):
        tape = flow(one(trades, exchange), ["date"], "ts_ns", bar_ns).drop("notional")
        frames.append(named(summed(tape, {"signed_vol": "double", "volume": "double", "n_trades": "long"}), leg_prefix(exchange)))
    for exchange in venues(marks) if marks is not None else []:
        cols = {"basis_bps": mark_basis(F.col("mark_price"), F.col("index_price")), "funding_rate": F.col("funding_rate"),
            "_next": F.col("next_funding_ts_ns")}
        m = aligned(one(marks, exchange), [], cols, "mark_age_ms")
        m = m.select("*", ((F.col("_next") - F.col("ts_ns")) / 1e9).alias("funding_in_s"),
            *[v.alias(k) for k, v in basis_changes("basis_bps", "mark_age_ms", w, bar_ms, max_tape_age_ms).items()]).drop("_next")
        frames.append(named(m, leg_prefix(exchange)))
    for exchange in venues(interest) if interest is not None else []:
        o = aligned(one(interest, exchange), [], {"_level": F.col("open_interest")}, "oi_age_ms")
        o = o.select("*", *[v.alias(k) for k, v in oi_changes("_level", "oi_age_ms", w, bar_ms, max_tape_age_ms).items()]).drop("_level")
        frames.append(named(o, leg_prefix(exchange)))
    for exchange in venues(forced) if forced is not None else []:
        per = liquidations(one(forced, exchange), ["date"], "ts_ns", bar_ns)
        frames.append(named(summed(per, {"liq_flow": "double", "n_liqs": "long"}), leg_prefix(exchange)))
    y = best.select("date", "ts_ns", *[v.alias(k) for k,
        v in targets("nbbo_mid", "nbbo_spread_bps", "nbbo_age_ms", w, bar_ms, max_age_ms).items()])
    return reduce(lambda a, b: a.join(b, ["date", "ts_ns"], "left"), [*frames, y], bars)


def doubles_of(rows: DataFrame) -> DataFrame:
    """Prices and sizes as doubles; keys and times stay."""
    keep = {"date", "exchange", "symbol", "ts_ns", "arrival", "side"}
    return rows.select(*[F.col(c) if c in keep else F.col(c).cast("double").alias(c) for c in rows.columns])
