"""Queries over the log's own operators: projections, frames, chunks, clocks and plans, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.operators import metrics, silver
from quaymark.plans.market import BASE, H, SYMBOLS, query, quotes
from quaymark.sources import bronze, lake, venues, wire
from quaymark.streaming import gateway

DATE = "strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d')"


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")), "yyyy-MM-dd"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as decoded messages: one in a hundred has no exchange clock, one in a hundred no receive time."""
    q = dated(quotes(spark, sf))
    dataset = F.element_at(F.array(*[F.lit(x) for x in (*silver.LATENCY_DATASETS, "bbo")]), (F.col("k") % 7 + 1).cast("int"))
    return q.select(
        F.col("venue").alias("exchange"), F.col("symbol").alias("canonical_symbol"), "date", dataset.alias("dataset"),
        F.col("arrival").alias("offset"),
        F.when(F.col("k") == 3, 0).otherwise(F.col("ts_ns") - F.col("k") * 1_000_000).alias("exchange_ts_ns"),
        (F.col("ts_ns") + 500).alias("local_ts_ns"),
        F.when(F.col("k") != 7, F.col("ts_ns") + F.col("k")).alias("recv_ns"), F.col("k"), F.col("price"), F.col("size"), F.col("side"))


MESSAGES = f""", m AS (SELECT venue AS exchange, symbol AS canonical_symbol, {DATE} AS date,
  ['book_snapshots','book_deltas','trades','mark_price','open_interest','liquidations','bbo'][k % 7 + 1] AS dataset, arrival AS "offset",
  CASE WHEN k = 3 THEN 0 ELSE ts_ns - k * 1000000 END AS exchange_ts_ns, ts_ns + 500 AS local_ts_ns, CASE WHEN k <> 7 THEN ts_ns + k END AS recv_ns, k, price, size, side FROM q)
"""


@query(BASE + MESSAGES + """SELECT exchange, canonical_symbol, date, dataset, "offset", exchange_ts_ns, recv_ns - exchange_ts_ns AS exchange_to_recv_ns,
  local_ts_ns - exchange_ts_ns AS exchange_to_emit_ns FROM m WHERE exchange_ts_ns <> 0 AND recv_ns IS NOT NULL AND dataset <> 'bbo'""")
def latency_rows(spark, sf):
    return silver.latency(silver.built(messages(spark, sf)))


@query(BASE + MESSAGES + "SELECT dataset, count(*) AS n_rows FROM m WHERE dataset <> 'bbo' GROUP BY dataset")
def built_totals(spark, sf):
    return silver.totals(silver.built(messages(spark, sf)))


TAPE_SQL = 'SELECT exchange, canonical_symbol, date, coalesce(recv_ns, local_ts_ns) AS ts_ns, "offset", exchange_ts_ns, local_ts_ns, {cols} FROM m WHERE dataset = \'{name}\''


def _tape(spark: SparkSession, sf: str, name: str, **fields) -> DataFrame:
    """A tape from messages whose numbers are strings; its decimals as doubles, as research reads them."""
    m = messages(spark, sf).where(F.col("dataset") == name)
    m = m.drop("price", "size", "side").select("*") if not fields else m.select(*[c for c in m.columns if c not in fields],
        *[v.alias(k) for k, v in fields.items()])
    return silver.doubles(silver.tape(m, name))


def _text(col: str, unit: int = 1_000_000):
    """A whole number of millionths as a decimal string."""
    return F.concat(F.expr(f"{col} div {unit}").cast("string"), F.lit("."), F.lpad(F.expr(f"{col} % {unit}").cast("string"), 6, "0"))


@query(BASE + MESSAGES + TAPE_SQL.format(name="trades",
    cols="CAST(\"offset\" AS VARCHAR) AS trade_id, CAST(price AS DOUBLE) / 1000000 AS price, CAST(size AS DOUBLE) AS size, side"))
def tape_trades(spark, sf):
    return _tape(spark, sf, "trades", trade_id=F.col("offset").cast("string"), price=_text("price"), size=F.col("size").cast("string"),
        side=F.col("side"))


@query(BASE + MESSAGES + TAPE_SQL.format(name="mark_price", cols="""CAST(price AS DOUBLE) / 1000000 AS mark_price, CAST(price + k AS DOUBLE) / 1000000 AS index_price,
  CAST(price AS DOUBLE) / 1000000 AS est_settle_price, CAST(k AS DOUBLE) / 1000000 AS funding_rate, local_ts_ns + 1000 AS next_funding_ts_ns"""))
def tape_mark_price(spark, sf):
    return _tape(spark, sf, "mark_price", mark_price=_text("price"), index_price=_text("(price + k)"), est_settle_price=_text("price"),
        funding_rate=_text("k"),
                 next_funding_ts_ns=(F.col("local_ts_ns") + 1000).cast("string"))


@query(BASE + MESSAGES + TAPE_SQL.format(name="open_interest", cols="CAST(price AS DOUBLE) / 1000000 AS open_interest"))
def tape_open_interest(spark, sf):
    return _tape(spark, sf, "open_interest", open_interest=_text("price"))


@query(BASE + MESSAGES + TAPE_SQL.format(name="liquidations", cols="""side, CAST(price AS DOUBLE) / 1000000 AS price, CAST(price AS DOUBLE) / 1000000 AS avg_price, CAST(size AS DOUBLE) AS orig_size,
  CAST(k AS DOUBLE) AS filled_size, CASE WHEN k % 2 = 0 THEN 'FILLED' ELSE 'PARTIAL' END AS status"""))
def tape_liquidations(spark, sf):
    return _tape(spark, sf, "liquidations", side=F.col("side"), price=_text("price"), avg_price=_text("price"),
        orig_size=F.col("size").cast("string"), filled_size=F.col("k").cast("string"),
                 status=F.when(F.col("k") % 2 == 0, "FILLED").otherwise("PARTIAL"))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of the book fold: one in ten a snapshot, some with gaps, some broken, some one-sided."""
    q = dated(quotes(spark, sf))
    kind = F.when(F.col("k") == 95, "snapshot_crossed").when(F.col("k") == 96, "crossed_after_delta").when(F.col("k") == 97,
        "non_monotonic_seq")
    return q.select(
        F.col("venue").alias("exchange"), F.col("symbol").alias("canonical_symbol"), "date",
        F.when(F.col("k") % 10 == 0, "snap").otherwise("delta").alias("kind"), F.col("arrival").alias("offset"),
        F.col("arrival").alias("sequence"), F.expr("arrival div 1000").alias("epoch"), F.col("ts_ns").alias("exchange_ts_ns"),
        (F.col("k") % 4).alias("engine_ts_ns"), (F.col("ts_ns") + 500).alias("local_ts_ns"),
        F.when(F.col("k") != 7, F.col("ts_ns") - F.col("k") * 20_000_000_000).alias("local_recv_ts_ns"),
        F.when(F.col("k") != 11, F.col("bid")).alias("best_bid"),
        F.when(F.col("k") % 3 == 0, F.col("bid")).otherwise(F.col("ask")).alias("best_ask"),
        F.when(F.col("k") > 90, F.col("k") % 3).otherwise(0).alias("seq_gap"), kind.alias("invariant_kind"),
        F.col("size").alias("bid_sz"), F.col("k").alias("ask_sz"))


FACTS = f""", f AS (SELECT venue AS exchange, symbol AS canonical_symbol, {DATE} AS date, CASE WHEN k % 10 = 0 THEN 'snap' ELSE 'delta' END AS kind, arrival AS "offset", arrival AS sequence,
  arrival // 1000 AS epoch, ts_ns AS exchange_ts_ns, k % 4 AS engine_ts_ns, ts_ns + 500 AS local_ts_ns, CASE WHEN k <> 7 THEN ts_ns - k * 20000000000 END AS local_recv_ts_ns,
  CASE WHEN k <> 11 THEN bid END AS best_bid, CASE WHEN k % 3 = 0 THEN bid ELSE ask END AS best_ask, CASE WHEN k > 90 THEN k % 3 ELSE 0 END AS seq_gap,
  CASE k WHEN 95 THEN 'snapshot_crossed' WHEN 96 THEN 'crossed_after_delta' WHEN 97 THEN 'non_monotonic_seq' END AS invariant_kind, size AS bid_sz, k AS ask_sz FROM q)
"""


@query(BASE + FACTS + """SELECT exchange, canonical_symbol, date, kind, "offset", sequence, epoch, exchange_ts_ns, nullif(engine_ts_ns, 0) AS engine_ts_ns, local_ts_ns, local_recv_ts_ns, best_bid, best_ask, seq_gap,
  coalesce(invariant_kind IN ('snapshot_crossed', 'crossed_after_delta'), false) AS crossed, invariant_kind FROM f""")
def book_quality(spark, sf):
    return silver.book_quality(facts(spark, sf))


@query(BASE + FACTS + """SELECT exchange, canonical_symbol, date, coalesce(local_recv_ts_ns, local_ts_ns) AS ts_ns, best_bid, best_ask, bid_sz, ask_sz
  FROM f WHERE invariant_kind IS NULL AND best_bid IS NOT NULL AND best_ask IS NOT NULL""")
def quote_rows(spark, sf):
    return silver.quote_rows(facts(spark, sf))


@query(BASE + """, p AS (SELECT DISTINCT split_part(symbol, '-', 1) AS base FROM q), h AS (SELECT DISTINCT symbol FROM q WHERE k = 1)
SELECT base, base || '-USD' AS usd, base || '-USDT' AS usdt FROM p WHERE base || '-USD' IN (SELECT symbol FROM h) AND base || '-USDT' IN (SELECT symbol FROM h)""")
def both_legs(spark, sf):
    q = quotes(spark, sf)
    base = F.split("symbol", "-")[0]
    pairs = q.select(base.alias("base")).distinct().select("base", F.concat("base", F.lit("-USD")).alias("usd"),
        F.concat("base", F.lit("-USDT")).alias("usdt"))
    return silver.both_legs(pairs, q.where("k = 1").select("symbol"))


@query(BASE + """, l AS (SELECT * FROM q WHERE k % 5 = 0), s AS (SELECT * FROM q WHERE k % 5 <> 1)
SELECT l.symbol, l.venue, l.ts_ns, l.bid AS live_bid, s.bid, l.bid = s.bid AS agree FROM l ASOF LEFT JOIN s ON l.symbol = s.symbol AND l.venue = s.venue AND l.ts_ns >= s.ts_ns""")
def live_agreement(spark, sf):
    q = quotes(spark, sf)
    out = silver.agrees(q.where("k % 5 = 0"), q.where("k % 5 <> 1"), ["symbol", "venue"], "ts_ns", "arrival", ["bid"])
    return out.select("symbol", "venue", "ts_ns", "live_bid", "bid", "agree")


KINDS = ("snapshots", "deltas", "trades", "bbo", "liquidations", "mark_price", "open_interest")
_HEADS = {"snapshots": "md.book", "deltas": "md.book", "trades": "md.trades", "bbo": "md.bbo", "liquidations": "md.liquidations",
    "mark_price": "md.markprice", "open_interest": "md.openinterest"}


@query(BASE + "SELECT DISTINCT kind, CASE WHEN kind IN ('snapshots', 'deltas') THEN 'md.book' WHEN kind = 'mark_price' THEN 'md.markprice' WHEN kind = 'open_interest' THEN 'md.openinterest' ELSE 'md.' || kind END"
       " || '.' || venue || '.' || replace(symbol, '-', '_') || '-x' || CASE WHEN kind IN ('snapshots', 'deltas') THEN '.' || kind ELSE '' END AS topic"
       " FROM q, (SELECT unnest(['snapshots','deltas','trades','bbo','liquidations','mark_price','open_interest']) AS kind)")
def topics(spark, sf):
    q = quotes(spark, sf).select("venue", F.concat(F.replace("symbol", F.lit("-"), F.lit("_")), F.lit("/x")).alias("symbol")).distinct()
    one = [q.select(F.lit(k).alias("kind"), bronze.topic(k, F.col("venue"), F.col("symbol")).alias("topic")) for k in KINDS]
    out = one[0]
    for o in one[1:]:
        out = out.unionByName(o)
    return out


@query(BASE + """SELECT arrival, '{"t":"trade","exchange":"' || venue || '","price":' || price || CASE WHEN k % 2 = 0 THEN ',"size":' || size ELSE '' END || '}' AS value,
  CAST(ts_ns AS VARCHAR) AS recv_header, CAST(ts_ns - k AS VARCHAR) AS exchange_header FROM q""")
def encoded_messages(spark, sf):
    q = quotes(spark, sf).withColumn("exchange", F.col("venue")).withColumn("size", F.when(F.col("k") % 2 == 0, F.col("size")))
    out = bronze.encoded(q, "trade", ["exchange", "price", "size"]).withColumn("headers",
        bronze.latency_headers(F.col("ts_ns"), F.col("ts_ns") - F.col("k")))
    return out.select("arrival", F.col("value").cast("string").alias("value"),
        wire.header("local_recv_ts_ns").cast("string").alias("recv_header"),
        wire.header("exchange_ts_ns").cast("string").alias("exchange_header"))


def _lv(px: str, sz: str) -> str:
    return f"array(array({px}, {sz}))"


def _raw(spark: SparkSession, sf: str, body: str) -> DataFrame:
    """Events as raw frames; ``body`` is the frame as SQL."""
    q = quotes(spark, sf).withColumn("ms", F.expr("ts_ns div 1000000"))
    return q.select(F.col("arrival").alias("frame_id"), F.expr(f"to_json({body})").alias("raw"), (F.col("ts_ns") + 1).alias("recv_ns"))


def _flat(events: DataFrame) -> DataFrame:
    first = lambda c: F.get(c, F.lit(0))
    return events.select("frame_id", "symbol", "kind", "sequence", "exchange_ts_ns", "recv_ns", first("bids")["px"].alias("bid_px"),
        first("asks")["sz"].alias("ask_sz"), "engine_ts_ns", "trade_id", "price",
                         "size", "side", F.to_json("extra").alias("extra"))


@query(BASE + """SELECT arrival AS frame_id, symbol, CASE WHEN k % 3 = 0 THEN 'delta' ELSE 'trade' END AS kind, CASE WHEN k % 3 = 0 THEN arrival END AS sequence,
  (ts_ns // 1000000) * 1000000 AS exchange_ts_ns, ts_ns + 1 AS recv_ns, CASE WHEN k % 3 = 0 THEN CAST(bid AS VARCHAR) END AS bid_px, CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR) END AS ask_sz,
  CAST(NULL AS BIGINT) AS engine_ts_ns, CASE WHEN k % 3 = 1 THEN CAST(arrival AS VARCHAR) END AS trade_id, CASE WHEN k % 3 = 1 THEN CAST(price AS VARCHAR) END AS price,
  CASE WHEN k % 3 = 1 THEN CAST(size AS VARCHAR) END AS size, CASE WHEN k % 3 = 1 THEN CASE WHEN k % 2 = 0 THEN 'ask' ELSE 'bid' END END AS side,
  CASE WHEN k % 3 = 0 THEN '{"first":"' || (arrival - 2) || '"}' END AS extra FROM q WHERE k % 3 < 2""")
def frames_spot(spark, sf):
    depth = f"named_struct('e', 'depthUpdate', 's', symbol, 'E', ms, 'U', arrival - 2, 'u', arrival, 'b', {_lv('string(bid)', 'string(size)')}, 'a', {_lv('string(ask)', 'string(k)')})"
    trade = "named_struct('e', 'trade', 's', symbol, 't', arrival, 'p', string(price), 'q', string(size), 'T', ms, 'm', k % 2 = 0)"
    q = quotes(spark, sf).withColumn("ms", F.expr("ts_ns div 1000000"))
    raw = F.expr(f"case when k % 3 = 0 then to_json({depth}) when k % 3 = 1 then to_json({trade}) else '{{\"result\":null,\"id\":1}}' end")
    return _flat(venues.spot_events(q.select(F.col("arrival").alias("frame_id"), raw.alias("raw"), (F.col("ts_ns") + 1).alias("recv_ns"))))


@query(BASE + """SELECT arrival AS frame_id, symbol, ['delta','trade','liquidation','mark_price'][k % 5 + 1] AS kind, CASE WHEN k % 5 = 0 THEN arrival END AS sequence,
  (ts_ns // 1000000) * 1000000 AS exchange_ts_ns, ts_ns + 1 AS recv_ns, CASE WHEN k % 5 = 0 THEN CAST(bid AS VARCHAR) END AS bid_px, CASE WHEN k % 5 = 0 THEN CAST(k AS VARCHAR) END AS ask_sz,
  CAST(NULL AS BIGINT) AS engine_ts_ns, CASE WHEN k % 5 = 1 THEN CAST(arrival AS VARCHAR) END AS trade_id, CASE WHEN k % 5 > 0 THEN CAST(price AS VARCHAR) END AS price,
  CASE WHEN k % 5 IN (1, 2) THEN CAST(size AS VARCHAR) END AS size, CASE WHEN k % 5 = 1 THEN CASE WHEN k % 2 = 0 THEN 'ask' ELSE 'bid' END WHEN k % 5 = 2 THEN CASE WHEN k % 2 = 0 THEN 'ask' ELSE 'bid' END END AS side,
  CASE k % 5 WHEN 0 THEN '{"first":"' || (arrival - 2) || '","previous":"' || (arrival - 3) || '"}' WHEN 2 THEN '{"avg_price":"' || price || '","filled_size":"' || k || '","status":"FILLED"}'
    WHEN 3 THEN '{"index_price":"' || ask || '","est_settle_price":"' || bid || '","funding_rate":"0.0001","next_funding_ts_ns":"' || (ts_ns // 1000000 + 5) || '000000"}' END AS extra
  FROM q WHERE k % 5 < 4""")
def frames_futures(spark, sf):
    depth = f"named_struct('e', 'depthUpdate', 's', symbol, 'E', ms, 'U', arrival - 2, 'u', arrival, 'pu', arrival - 3, 'b', {_lv('string(bid)', 'string(size)')}, 'a', {_lv('string(ask)', 'string(k)')})"
    trade = "named_struct('e', 'aggTrade', 's', symbol, 'a', arrival, 'p', string(price), 'q', string(size), 'T', ms, 'm', k % 2 = 0)"
    forced = "named_struct('e', 'forceOrder', 'o', named_struct('s', symbol, 'S', if(k % 2 = 0, 'SELL', 'BUY'), 'p', string(price), 'ap', string(price), 'q', string(size), 'z', string(k), 'X', 'FILLED', 'T', ms))"
    mark = "named_struct('e', 'markPriceUpdate', 's', symbol, 'E', ms, 'p', string(price), 'i', string(ask), 'P', string(bid), 'r', '0.0001', 'T', ms + 5)"
    kinds = " ".join(f"when {i} then concat('{{\"stream\":\"x\",\"data\":', to_json({b}), '}}')" for i,
        b in enumerate((depth, trade, forced, mark)))
    q = quotes(spark, sf).withColumn("ms", F.expr("ts_ns div 1000000"))
    raw = F.expr(f"case k % 5 {kinds} else '{{\"id\":1}}' end")
    return _flat(venues.futures_events(q.select(F.col("arrival").alias("frame_id"), raw.alias("raw"),
        (F.col("ts_ns") + 1).alias("recv_ns"))))


@query(BASE + """SELECT arrival AS frame_id, symbol, CASE WHEN k % 3 = 2 THEN 'trade' WHEN k % 2 = 0 THEN 'snapshot' ELSE 'delta' END AS kind, arrival AS sequence, ts_ns AS exchange_ts_ns, ts_ns + 1 AS recv_ns,
  CASE WHEN k % 3 <> 2 THEN CAST(bid AS VARCHAR) END AS bid_px, CASE WHEN k % 3 <> 2 THEN CAST(k AS VARCHAR) END AS ask_sz, CASE WHEN k % 3 <> 2 THEN ts_ns - 1000 END AS engine_ts_ns,
  CASE WHEN k % 3 = 2 THEN CAST(arrival AS VARCHAR) END AS trade_id, CASE WHEN k % 3 = 2 THEN CAST(price AS VARCHAR) END AS price, CASE WHEN k % 3 = 2 THEN CAST(size AS VARCHAR) END AS size,
  CASE WHEN k % 3 = 2 THEN CASE WHEN k % 2 = 0 THEN 'ask' ELSE 'bid' END END AS side, CAST(NULL AS VARCHAR) AS extra FROM q""")
def frames_channels(spark, sf):
    at = lambda x: f"concat(date_format(timestamp_micros(({x}) div 1000), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), lpad(string(({x}) % 1000), 3, '0'), 'Z')"
    updates = (f"array(named_struct('side', 'bid', 'event_time', {at('ts_ns - 2000')}, 'price_level', string(bid), 'new_quantity', string(size)), "
               f"named_struct('side', 'offer', 'event_time', {at('ts_ns - 1000')}, 'price_level', string(ask), 'new_quantity', string(k)))")
    book = f"named_struct('channel', 'l2_data', 'timestamp', {at('ts_ns')}, 'sequence_num', arrival, 'events', array(named_struct('type', if(k % 2 = 0, 'snapshot', 'update'), 'product_id', symbol, 'updates', {updates})))"
    one = f"named_struct('trade_id', string(arrival), 'product_id', symbol, 'price', string(price), 'size', string(size), 'side', if(k % 2 = 0, 'BUY', 'SELL'), 'time', {at('ts_ns')})"
    trade = f"named_struct('channel', 'market_trades', 'timestamp', {at('ts_ns')}, 'sequence_num', arrival, 'events', array(named_struct('trades', array({one}))))"
    q = quotes(spark, sf)
    raw = F.expr(f"if(k % 3 = 2, to_json({trade}), to_json({book}))")
    return _flat(venues.channel_events(q.select(F.col("arrival").alias("frame_id"), raw.alias("raw"),
        (F.col("ts_ns") + 1).alias("recv_ns"))))


@query(BASE + """SELECT arrival AS frame_id, symbol, CASE WHEN k % 3 = 2 THEN 'trade' WHEN k % 2 = 0 THEN 'snapshot' ELSE 'delta' END AS kind, CAST(NULL AS BIGINT) AS sequence, (ts_ns // 1000) * 1000 AS exchange_ts_ns,
  ts_ns + 1 AS recv_ns, CASE WHEN k % 3 <> 2 THEN CAST(bid AS VARCHAR) END AS bid_px, CASE WHEN k % 3 <> 2 THEN CAST(k AS VARCHAR) END AS ask_sz, CAST(NULL AS BIGINT) AS engine_ts_ns,
  CASE WHEN k % 3 = 2 THEN CAST(arrival AS VARCHAR) END AS trade_id, CASE WHEN k % 3 = 2 THEN CAST(price AS VARCHAR) END AS price, CASE WHEN k % 3 = 2 THEN CAST(size AS VARCHAR) END AS size,
  CASE WHEN k % 3 = 2 THEN CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END END AS side, CASE WHEN k % 3 <> 2 THEN '{"checksum":"' || (arrival * 7) || '"}' END AS extra FROM q""")
def frames_books(spark, sf):
    at = "concat(date_format(timestamp_micros(ts_ns div 1000), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'Z')"
    book = (f"named_struct('channel', 'book', 'type', if(k % 2 = 0, 'snapshot', 'update'), 'data', array(named_struct('symbol', symbol, 'bids', array(named_struct('price', bid, 'qty', size)), "
            f"'asks', array(named_struct('price', ask, 'qty', k)), 'checksum', arrival * 7, 'timestamp', {at})))")
    trade = f"named_struct('channel', 'trade', 'type', 'update', 'data', array(named_struct('symbol', symbol, 'trade_id', arrival, 'price', price, 'qty', size, 'side', if(k % 2 = 0, 'buy', 'sell'), 'timestamp', {at})))"
    q = quotes(spark, sf)
    raw = F.expr(f"if(k % 3 = 2, to_json({trade}), to_json({book}))")
    return _flat(venues.book_events(q.select(F.col("arrival").alias("frame_id"), raw.alias("raw"), (F.col("ts_ns") + 1).alias("recv_ns"))))


SEQ = ", s AS (SELECT venue, arrival, row_number() OVER (PARTITION BY venue ORDER BY arrival) - CASE WHEN k = 50 THEN 2 ELSE 0 END + CASE WHEN arrival % 900 = 899 THEN 3 ELSE 0 END AS seq FROM q)"


@query(BASE + SEQ + """, h AS (SELECT *, max(seq) OVER (PARTITION BY venue ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM s),
g AS (SELECT *, coalesce(seq > high + 1, false) AS gap FROM h), en AS (SELECT *, coalesce(max(CAST(gap AS INTEGER)) OVER (PARTITION BY venue ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS ended FROM g)
SELECT venue, arrival, seq, CASE WHEN ended THEN 'void' WHEN gap THEN 'gap' WHEN seq <= high THEN 'repeat' ELSE 'ok' END AS verdict FROM en""")
def connection_sequence(spark, sf):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("venue").orderBy("arrival"))
    s = quotes(spark, sf).select("venue", "arrival",
        (n - F.when(F.col("k") == 50, 2).otherwise(0) + F.when(F.col("arrival") % 900 == 899, 3).otherwise(0)).cast("long").alias("seq"))
    return venues.sequence_check(s, ["venue"], "arrival", "seq")


@query("WITH RECURSIVE " + BASE[5:] + """, c AS (SELECT venue, row_number() OVER (PARTITION BY venue ORDER BY arrival) AS n, arrival, ts_ns // 3600000000000 - k % 5 AS now FROM q WHERE arrival % 50 = 0),
r AS (SELECT venue, n, arrival, now, greatest(0 + 1, now) AS epoch FROM c WHERE n = 1 UNION ALL SELECT c.venue, c.n, c.arrival, c.now, greatest(r.epoch + 1, c.now) FROM r JOIN c ON c.venue = r.venue AND c.n = r.n + 1)
SELECT venue, arrival, now, epoch FROM r""")
def connection_epochs(spark, sf):
    c = quotes(spark, sf).where("arrival % 50 = 0").select("venue", "arrival", (F.expr(f"ts_ns div {H}") - F.col("k") % 5).alias("now"))
    return venues.epochs(c, ["venue"], "arrival", "now")


@query(BASE + """, l AS (SELECT venue, lag(ts_ns - k * 20000000000) OVER (PARTITION BY venue ORDER BY arrival) - (ts_ns - k * 20000000000) AS s FROM q)
SELECT venue, count_if(s > 0) AS backward_steps, CAST(coalesce(max(CASE WHEN s > 0 THEN s END), 0) AS DOUBLE) / 1000000.0 AS worst_step_ms FROM l GROUP BY venue""")
def recv_clock(spark, sf):
    q = quotes(spark, sf).withColumn("recv", F.col("ts_ns") - F.col("k") * 20_000_000_000)
    return venues.recv_clock(q, ["venue"], "arrival", "recv")


@query(BASE + f""", g AS (SELECT symbol, venue, lag(ts_ns) OVER (PARTITION BY symbol, venue ORDER BY ts_ns) AS from_ns, ts_ns AS to_ns FROM q)
SELECT symbol, venue, from_ns, to_ns, to_ns - from_ns AS silent_ns FROM g WHERE to_ns - from_ns > {4 * H}""")
def feed_silences(spark, sf):
    return venues.silences(quotes(spark, sf), ["symbol", "venue"], "ts_ns", 4 * H)


def _sync_events(spark: SparkSession, sf: str, gap: int) -> DataFrame:
    """Each venue's day as a connection: deltas of two updates each, the snapshot in their midst, holes where k says so."""
    from pyspark.sql import Window

    q = dated(quotes(spark, sf))
    w = Window.partitionBy("venue", "symbol", "date").orderBy("arrival")
    n = F.row_number().over(w).cast("long")
    q = q.select(F.dense_rank().over(Window.partitionBy("venue", "symbol").orderBy("date")).cast("long").alias("connection"),
        F.concat("venue", F.lit(":"), "symbol").alias("symbol"), n.alias("n"), "k")
    snap = F.col("n") == 4
    last = F.col("n") * 2
    return q.select("connection", "symbol", F.col("n").alias("position"), F.when(snap, "snapshot").otherwise("delta").alias("kind"),
        F.when(snap, last - gap).otherwise(last).alias("sequence"),
                    F.when(~snap, last - 1 + F.when(F.col("k") < 3, 1).otherwise(0)).alias("first"),
                    F.when(~snap, last - 2 + F.when(F.col("k") > 97, 1).otherwise(0)).alias("previous"))


@query(None)
def sync_spot(spark, sf):
    return venues.sync(_sync_events(spark, sf, 3), most=500)


@query(None)
def sync_futures(spark, sf):
    return venues.sync(_sync_events(spark, sf, 2), futures=True)


def log_records(spark: SparkSession, sf: str) -> DataFrame:
    q = quotes(spark, sf)
    return q.select(F.concat(F.lit("md.trades."), "venue", F.lit("."), "symbol").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"), F.col("arrival").alias("offset"),
                    F.expr("ts_ns div 1000000").alias("timestamp_ms"), (F.col("size") * 1000).alias("size"),
                    (F.expr("ts_ns div 1000000") + F.col("k")).alias("poll_ms"))


@query(None)
def bronze_chunks(spark, sf):
    return bronze.chunks(log_records(spark, sf), most_bytes=200_000, most_ms=5 * 3_600_000)


RECORDS = ", r AS (SELECT 'md.trades.' || venue || '.' || symbol AS topic, CAST(user_id % 3 AS INTEGER) AS \"partition\", arrival AS \"offset\", ts_ns // 1000000 AS timestamp_ms FROM q)"


@query(BASE + RECORDS + """, c AS (SELECT topic, "partition", strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS date, min("offset") AS start_offset, max("offset") AS end_offset, count(*) AS n_records FROM r GROUP BY 1, 2, 3)
SELECT *, printf('%03d-%012d.parquet', "partition", start_offset) AS file FROM c""")
def log_manifest(spark, sf):
    return lake.manifest(log_records(spark, sf))


@query(BASE + RECORDS + f"SELECT topic, \"partition\", \"offset\", timestamp_ms FROM r WHERE timestamp_ms - (SELECT min(timestamp_ms) FROM r) < {240 * 3_600_000} ORDER BY timestamp_ms, \"offset\" LIMIT 2000")
def capture_window(spark, sf):
    return bronze.captured(log_records(spark, sf).select("topic", "partition", "offset", "timestamp_ms"), ["timestamp_ms", "offset"], 2000,
        240 * 3_600_000)


@query(BASE + RECORDS + """SELECT topic, "partition", "offset", greatest(0.0::DOUBLE, CAST(timestamp_ms - first_value(timestamp_ms) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS DOUBLE) / 1000.0::DOUBLE / 50.0::DOUBLE
  - CAST("offset" AS DOUBLE)) AS delay_sec FROM r""")
def replay_pace(spark, sf):
    r = log_records(spark, sf).withColumn("spent", F.col("offset").cast("double"))
    return bronze.paced(r, ["topic", "partition"], ["offset"], 50.0, "spent").select("topic", "partition", "offset", "delay_sec")


@query(BASE + RECORDS + """, p AS (SELECT topic, "partition", max("offset") + 5 AS high, max(CASE WHEN "offset" % 3 = 0 THEN "offset" END) AS consumed FROM r GROUP BY ALL)
SELECT topic, "partition", high, consumed, greatest(0, high - 1 - coalesce(consumed, -1)) AS lag FROM p""")
def consumer_lag(spark, sf):
    r = log_records(spark, sf)
    p = r.groupBy("topic", "partition").agg((F.max("offset") + 5).alias("high"),
        F.max(F.when(F.col("offset") % 3 == 0, F.col("offset"))).alias("consumed"))
    return gateway.lag(p)


_PLAN = """, k AS (SELECT CASE user_id % 5 WHEN 0 THEN 'md.status.' || venue WHEN 1 THEN 'md.trades.' || venue || '.' || symbol WHEN 2 THEN 'md.book.' || venue || '.' || symbol || '.snapshots'
  WHEN 3 THEN 'md.book.' || venue || '.' || symbol || '.deltas' ELSE 'md.bbo.' || venue || '.' || symbol END AS topic, CAST(user_id % 2 AS INTEGER) AS "partition", arrival, ts_ns FROM q),
p AS (SELECT topic, "partition", max(arrival) + 1 AS high, min(CASE WHEN ts_ns > 1705600000000000000 THEN arrival END) AS at_cutoff FROM k GROUP BY ALL),
c AS (SELECT *, CASE WHEN topic LIKE 'md.status.%' THEN 'status' WHEN topic LIKE 'md.trades.%' THEN 'trades' WHEN topic LIKE '%.snapshots' THEN 'snapshots' WHEN topic LIKE '%.deltas' THEN 'deltas' END AS kind FROM p),
s AS (SELECT *, CASE WHEN kind <> 'trades' AND at_cutoff IS NOT NULL AND at_cutoff < high THEN CASE WHEN kind = 'snapshots' THEN high - 1 ELSE at_cutoff END ELSE high END AS seek FROM c WHERE kind IS NOT NULL)
SELECT topic, "partition", high, at_cutoff, kind, seek, CASE WHEN kind IN ('snapshots', 'deltas') AND seek < high THEN high - 1 END AS drain_to FROM s"""


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    q = quotes(spark, sf)
    one, two = F.concat("venue", F.lit("")), F.concat("venue", F.lit("."), "symbol")
    by = F.col("user_id") % 5
    name = (F.when(by == 0, F.concat(F.lit("md.status."), one)).when(by == 1, F.concat(F.lit("md.trades."), two)).when(by == 2,
        F.concat(F.lit("md.book."), two, F.lit(".snapshots")))
            .when(by == 3, F.concat(F.lit("md.book."), two, F.lit(".deltas"))).otherwise(F.concat(F.lit("md.bbo."), two)))
    return q.select(name.alias("topic"), (F.col("user_id") % 2).cast("int").alias("partition"), F.col("arrival").alias("offset"), "ts_ns")


@query(BASE + _PLAN)
def warm_start_plan(spark, sf):
    recent = F.min(F.when(F.col("ts_ns") > 1_705_600_000_000_000_000, F.col("offset")))
    p = _positions(spark, sf).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("high"), recent.alias("at_cutoff"))
    return gateway.warm_start(p)


@query(BASE + """, p AS (SELECT venue, max(arrival) - 50 AS d FROM q GROUP BY venue), r AS (SELECT q.venue, min(arrival) AS seen FROM q JOIN p ON p.venue = q.venue AND arrival >= d GROUP BY q.venue)
SELECT venue AS topic, 0 AS "partition", arrival AS "offset" FROM q WHERE arrival >= (SELECT max(seen) FROM r)""")
def drain_gate(spark, sf):
    r = quotes(spark, sf).select(F.col("venue").alias("topic"), F.lit(0).alias("partition"), F.col("arrival").alias("offset"))
    plan = r.groupBy("topic", "partition").agg((F.max("offset") - 50).alias("drain_to"))
    return gateway.drained(r, plan, "offset").select("topic", "partition", "offset")


@query(BASE + "SELECT arrival, ['snap','delta','trade','status','bbo'][k % 5 + 1] AS t, ['book','book','broadcast','status','ignored'][k % 5 + 1] AS goes_to FROM q")
def message_route(spark, sf):
    tag = F.element_at(F.array(*[F.lit(x) for x in ("snap", "delta", "trade", "status", "bbo")]), (F.col("k") % 5 + 1).cast("int"))
    return gateway.route(quotes(spark, sf).select("arrival", tag.alias("t")))


@query(BASE + """, l AS (SELECT symbol, CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, cents // 100 AS px, arg_max(e.k, arrival) AS sz FROM q JOIN (SELECT event_id, cents, k FROM e) e ON e.event_id = arrival GROUP BY ALL)
SELECT symbol, count_if(side = 'bid') AS n_bids, count_if(side = 'ask') AS n_asks, CAST(max(px) FILTER (side = 'bid') AS VARCHAR) AS first_bid, CAST(min(px) FILTER (side = 'ask') AS VARCHAR) AS first_ask, 0::BIGINT AS exchange_ts_ns
FROM l WHERE sz > 0 GROUP BY symbol""")
def book_resnapshot(spark, sf):
    q = quotes(spark, sf).withColumn("px", F.expr("((price - 1000000000) div 2) div 100")).withColumn("side",
        F.when(F.col("user_id") % 2 == 0, "bid").otherwise("ask"))
    levels = q.groupBy("symbol", "side", "px").agg(F.max_by("k", "arrival").alias("sz")).where("sz > 0")
    levels = levels.select("symbol", F.lit(7).cast("long").alias("sequence"), F.lit(1).cast("long").alias("epoch"), "side",
        F.col("px").cast("string").alias("px"), F.col("sz").cast("string").alias("sz"))
    out = venues.resnapshots(levels, ["symbol"], 0)
    return out.select("symbol", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"),
        F.get("bids", F.lit(0))["px"].alias("first_bid"), F.get("asks", F.lit(0))["px"].alias("first_ask"), "exchange_ts_ns")


@query(BASE + f"""SELECT DISTINCT exchange, canonical_symbol FROM (SELECT unnest(['click','error']) AS exchange) a, (SELECT unnest({SYMBOLS}) AS canonical_symbol) b""")
def declared_partitions(spark, sf):
    text = "instruments:\n" + "".join(f"  {s}:\n    base: {s[:3]}\n    quote: {s[4:]}\n    venues:\n      - {{exchange: click, symbol: {s}}}\n      - {{exchange: error, symbol: {s}}}\n" for s in SYMBOLS)
    return bronze.declared(bronze.instruments(spark, text))


@query(BASE + MESSAGES + "SELECT DISTINCT dataset FROM m WHERE k > 90 INTERSECT SELECT unnest(['book_snapshots','book_deltas']) AS dataset")
def book_datasets_present(spark, sf):
    """The book datasets that a build finds: those of all that are there."""
    books = spark.createDataFrame([(d,) for d in silver.BOOK_DATASETS], "dataset string")
    return messages(spark, sf).where("k > 90").select("dataset").intersect(books)


@query(BASE + "SELECT DISTINCT venue, symbol, strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d') AS date FROM q")
def streams_seen(spark, sf):
    return dated(quotes(spark, sf)).select("venue", "symbol", "date").distinct()


_BOUNDS = [5.0, 10.0, 25.0, 50.0, 75.0]


@query(BASE + MESSAGES + f""", b AS (SELECT exchange, CAST(k AS DOUBLE) AS ms FROM m WHERE dataset <> 'bbo'), l AS (SELECT unnest([{", ".join(map(str, _BOUNDS))}, NULL])::DOUBLE AS le)
SELECT exchange, le, count_if(le IS NULL OR ms <= le) AS n FROM b, l GROUP BY ALL""")
def latency_histogram(spark, sf):
    """Messages by latency as a histogram with cumulative buckets."""
    rows = silver.built(messages(spark, sf)).select("exchange", F.col("k").cast("double").alias("ms"))
    return metrics.observed(rows, ["exchange"], "ms", _BOUNDS)


@query(BASE + "SELECT venue, ['book','book','broadcast','status','ignored'][k % 5 + 1] AS goes_to, count(*) AS n FROM q GROUP BY ALL")
def message_counters(spark, sf):
    """Messages by what the gateway does with them."""
    return message_route(spark, sf).join(quotes(spark, sf).select("arrival", "venue"), "arrival").groupBy("venue",
        "goes_to").agg(F.count("*").alias("n"))
