"""Oracle SQL (DuckDB dialect) over the driver tables, one text per query.

Rounding goes through DECIMAL(38,10) on both sides, so that the engines' different order of
summation cannot flip a digit. Windows are [start, end) and aligned to the epoch.
"""

ORACLES: dict[str, str] = {}


def rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def percent(new: str, base: str) -> str:
    return rounded(f"({new} - {base}) / nullif({base}, 0) * 100", 4)


_EVENTS = """
rows AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events
)"""

_OPEN = "(value * (1050 - k) / 1000)"

_TICKS = f"""{_EVENTS},
ticks AS (
  SELECT event_type AS symbol, value AS price, CAST(user_id AS DOUBLE) AS volume_24h,
         {percent('value', _OPEN)} AS change_pct, ts AS event_time, event_id, user_id, k
  FROM rows
)"""

_LINEITEM_TICKS = """
ticks AS (
  SELECT l_returnflag AS symbol, l_extendedprice AS price, l_discount AS change_pct,
         l_shipdate AS event_time
  FROM lineitem
)"""


def sliding(source: str, slide: str, copies: int) -> str:
    """Each row once per window it belongs to."""
    return f"""
windows AS (
  SELECT time_bucket(INTERVAL '{slide}', event_time, TIMESTAMP '1970-01-01')
           - i * INTERVAL '{slide}' AS window_start, t.*
  FROM {source} t, range({copies}) AS r(i)
)"""


def _moving_average(ticks: str, size: str, slide: str, copies: int, where: str = "") -> str:
    return f"""WITH {ticks}, {sliding('ticks', slide, copies)}
SELECT window_start, window_start + INTERVAL '{size}' AS window_end, symbol,
       {rounded('avg(price)', 2)} AS sma_5min, {rounded('max(price)', 2)} AS price_max,
       {rounded('min(price)', 2)} AS price_min,
       {rounded('stddev_samp(price)', 4)} AS volatility,
       {rounded('avg(change_pct)', 4)} AS change_avg
FROM windows {where} GROUP BY window_start, symbol"""


def _labelled(change: str) -> str:
    return f"""CASE WHEN {change} > 2 THEN '🚀 PUMP' WHEN {change} < -2 THEN '💥 DUMP'
                ELSE 'normal' END"""


def _pump_dump(size: str, slide: str, copies: int, judged: str = "change_avg") -> str:
    return f"""WITH {_TICKS}, {sliding('ticks', slide, copies)},
stats AS (
  SELECT window_start, window_start + INTERVAL '{size}' AS window_end, symbol,
         {rounded('avg(change_pct)', 4)} AS change_avg, max(price) AS high, min(price) AS low
  FROM windows GROUP BY window_start, symbol
)
SELECT window_start, window_end, symbol, change_avg, {rounded('high', 2)} AS price_max,
       {rounded('low', 2)} AS price_min, {_labelled(judged)} AS alerta
FROM stats"""


def _local(size: str) -> str:
    return f"""local_side AS (
  SELECT time_bucket(INTERVAL '{size}', event_time, TIMESTAMP '1970-01-01') AS window_start,
         symbol, {rounded('avg(price)', 2)} AS local_price
  FROM ticks GROUP BY 1, 2
)"""


def _global(size: str) -> str:
    return f"""quotes AS (
  SELECT event_type AS symbol, {_OPEN} AS price_usd, value * 1048576 AS market_cap,
         ts + INTERVAL '1 hour' AS event_time
  FROM rows
),
global_side AS (
  SELECT time_bucket(INTERVAL '{size}', event_time, TIMESTAMP '1970-01-01') AS window_start,
         symbol, {rounded('avg(price_usd)', 2)} AS global_price,
         {rounded('avg(market_cap)', 0)} AS market_cap
  FROM quotes GROUP BY 1, 2
)"""


def _deviation(size: str, where: str = "") -> str:
    return f"""WITH {_TICKS}, {_local(size)}, {_global(size)}
SELECT window_start, window_start + INTERVAL '{size}' AS window_end, symbol,
       local_price, global_price, market_cap,
       {percent('local_price', 'global_price')} AS deviation_pct
FROM local_side JOIN global_side USING (window_start, symbol) {where}"""


ORACLES["sma_volatility"] = _moving_average(_TICKS, "5 minutes", "1 minute", 5)
ORACLES["sma_volatility_wide"] = _moving_average(_TICKS, "1 hour", "12 minutes", 5)
ORACLES["sma_volatility_lineitem"] = _moving_average(_LINEITEM_TICKS, "7 days", "1 day", 7)
ORACLES["sma_volatility_panes"] = _moving_average(_TICKS, "1 hour", "1 minute", 60)
ORACLES["pump_dump"] = _pump_dump("2 minutes", "30 seconds", 4)
ORACLES["pump_dump_wide"] = _pump_dump("1 hour", "12 minutes", 5)
ORACLES["pump_dump_range"] = _pump_dump(
    "1 hour", "12 minutes", 5, f"({percent('high', 'low')})"
)
ORACLES["local_minute_price"] = f"""WITH {_TICKS}, {_local('1 minute')}
SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, symbol, local_price
FROM local_side"""
ORACLES["global_minute_price"] = f"""WITH {_TICKS}, {_global('1 minute')}
SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, symbol, global_price,
       market_cap
FROM global_side"""
ORACLES["price_deviation"] = _deviation("6 hours")
ORACLES["price_deviation_minute"] = _deviation("1 minute")

# --- parsing, normalization, enrichment ------------------------------------------------

_MILLIS = "(epoch_us(ts) // 1000)"
_RECORD = f"""('{{"symbol":"' || event_type || '","price":'
       || CASE WHEN k < 10 THEN '"n/a"' ELSE CAST(value AS VARCHAR) END
       || ',"volume_24h":' || user_id || ',"extra":true,"timestamp":' || {_MILLIS} || '}}')"""

ORACLES["change_24h"] = f"WITH {_TICKS} SELECT event_id, symbol, change_pct FROM ticks"
ORACLES["parse_ticks"] = f"""WITH {_EVENTS}
SELECT event_type AS symbol, value AS price, CAST(user_id AS DOUBLE) AS volume_24h,
       {_MILLIS} AS timestamp, make_timestamp({_MILLIS} * 1000) AS event_time
FROM rows WHERE k BETWEEN 10 AND 89"""
ORACLES["parse_rejects"] = f"""WITH {_EVENTS}
SELECT CASE WHEN k >= 90 THEN left({_RECORD}, 30) ELSE {_RECORD} END AS json,
       CASE WHEN k >= 90 THEN 'symbol,price' ELSE 'price' END AS missing
FROM rows WHERE k NOT BETWEEN 10 AND 89"""
_GOOD_TICKER = "event_type <> 'signup' AND k BETWEEN 10 AND 89"
ORACLES["route_messages"] = f"""WITH {_EVENTS}
SELECT event_type AS symbol, value AS price, CAST(user_id AS DOUBLE) AS volume_24h,
       {percent('value', _OPEN)} AS change_pct, {_MILLIS} AS timestamp,
       lower(event_type) || '-ticker' AS topic
FROM rows WHERE {_GOOD_TICKER}"""
ORACLES["route_rejects"] = f"""WITH {_EVENTS}
SELECT missing, count(*) AS messages
FROM (SELECT CASE WHEN k >= 90 THEN 'stream'
                  WHEN k < 10 AND event_type <> 'signup' THEN 'price' END AS missing FROM rows)
WHERE missing IS NOT NULL GROUP BY missing"""
_CANDLES = f"""{_EVENTS},
candles AS (
  SELECT date_trunc('hour', ts) AS hour, event_type AS symbol,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, CAST(sum(user_id) AS DOUBLE) AS volume,
         count(*) >= 2 AS closed
  FROM rows GROUP BY 1, 2
)"""
ORACLES["normalize_kline"] = f"""WITH {_CANDLES}
SELECT symbol, open, high, low, close, volume, closed, epoch_ms(hour) AS timestamp,
       'crypto-klines' AS topic, CAST(hour AS TIMESTAMP) AS event_time
FROM candles"""
ORACLES["closed_klines"] = f"""WITH {_CANDLES}
SELECT symbol, close, volume, epoch_ms(hour) AS timestamp FROM candles WHERE closed"""
ORACLES["explode_snapshot"] = f"""WITH {_EVENTS},
latest AS (
  SELECT date_trunc('hour', ts) AS hour, event_type AS coin,
         arg_max(value, (ts, event_id)) AS value, arg_max(k, (ts, event_id)) AS k
  FROM rows WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2
)
SELECT upper(coin) || 'USD' AS symbol, coin, value AS price_usd,
       CASE WHEN k >= 50 THEN value * 1e6 ELSE 0 END AS market_cap,
       CAST(CASE WHEN k >= 50 THEN k ELSE 0 END AS DOUBLE) AS volume_24h,
       CAST(0 AS DOUBLE) AS change_24h, epoch_ms(hour) AS timestamp,
       'coingecko-market' AS topic
FROM latest"""
ORACLES["sentiment_document"] = f"""WITH {_EVENTS}
SELECT k AS value, event_type AS classification,
       CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, {_MILLIS} AS timestamp_ms,
       'feargreed-index' AS topic, CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time
FROM rows WHERE k < 90"""
ORACLES["sentiment_rejects"] = f"""WITH {_EVENTS}
SELECT '{{"data":[]}}' AS json, 'value,classification,timestamp' AS missing,
       count(*) AS documents
FROM rows WHERE k >= 90"""
ORACLES["classify_sentiment"] = f"""WITH {_EVENTS}
SELECT event_id, k AS value,
       CASE WHEN k <= 24 THEN 'Extreme Fear' WHEN k <= 49 THEN 'Fear'
            WHEN k <= 74 THEN 'Greed' ELSE 'Extreme Greed' END AS band
FROM rows"""
ORACLES["topic_name"] = "SELECT event_id, lower(event_type) || '-ticker' AS topic FROM events"
ORACLES["encode_publish"] = """
SELECT lower(event_type) || '-ticker' AS topic, event_type AS key,
       '{"symbol":"' || event_type || '","event_id":' || event_id || ',"user_id":' || user_id
         || '}' AS value
FROM events"""
ORACLES["enrich_partition"] = """
SELECT event_id, event_type AS symbol, ts AS event_time, CAST(ts AS DATE) AS fecha,
       event_type AS par
FROM events"""

# --- history ---------------------------------------------------------------------------

ORACLES["history_scan"] = f"""
SELECT event_type AS par, CAST(ts AS DATE) AS fecha, count(*) AS ticks,
       {rounded('avg(value)', 2)} AS price_avg
FROM events GROUP BY 1, 2"""
ORACLES["history_pruned_scan"] = """
SELECT event_id, event_type AS par, CAST(ts AS DATE) AS fecha, value AS price
FROM events
WHERE event_type = 'purchase' AND value > 20
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"""

ORACLES["text_messages_scan"] = ORACLES["route_rejects"]
ORACLES["snapshot_documents_scan"] = (
    f"SELECT * EXCLUDE (timestamp) FROM ({ORACLES['explode_snapshot']})"
)
ORACLES["sentiment_documents_scan"] = f"""WITH {_EVENTS},
hourly AS (
  SELECT arg_max(event_type, (ts, event_id)) AS event_type, arg_max(k, (ts, event_id)) AS k,
         arg_max(ts, (ts, event_id)) AS ts
  FROM rows GROUP BY date_trunc('hour', ts)
)
SELECT k AS value, event_type AS classification, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp
FROM hourly WHERE k < 90"""
ORACLES["failed_polls"] = f"""
SELECT * FROM ({ORACLES['explode_snapshot']}) WHERE timestamp // 3600000 % 4 <> 0"""
ORACLES["poll_time"] = f"""
SELECT symbol, price_usd, true AS is_now FROM ({ORACLES['explode_snapshot']})"""
ORACLES["arrival_time"] = "SELECT event_id, event_type AS par, true AS is_now FROM events"

# --- counters, gauges, series ----------------------------------------------------------

ORACLES["message_counts"] = f"""WITH {_CANDLES}
SELECT lower(event_type) || '-ticker' AS topic, count(*) AS messages
FROM rows WHERE {_GOOD_TICKER} GROUP BY 1
UNION ALL SELECT 'crypto-klines', count(*) FROM candles"""
ORACLES["ok_error_counts"] = """
SELECT count(*) FILTER (event_type <> 'error') AS ok,
       count(*) FILTER (event_type = 'error') AS failed
FROM events"""
ORACLES["last_value"] = f"""WITH {_TICKS}
SELECT symbol, arg_max(price, (event_time, event_id)) AS price,
       arg_max(change_pct, (event_time, event_id)) AS change_pct,
       arg_max(volume_24h, (event_time, event_id)) AS volume_24h
FROM ticks GROUP BY symbol"""


def _ceil(us: str, width: int) -> str:
    return f"(({us} + {width} - 1) // {width} * {width})"


def _seconds(n: int) -> int:
    return n * 1_000_000


def _counter(every: int, restart: bool = True) -> str:
    day = f", (cell - 1) // {_seconds(86400)}" if restart else ""
    return f"""
scrapes AS (
  SELECT lower(event_type) || '-ticker' AS topic, {_ceil('epoch_us(ts)', _seconds(every))} AS cell,
         count(*) AS n
  FROM events GROUP BY 1, 2
),
counter AS (
  SELECT topic, cell,
         CAST(sum(n) OVER (PARTITION BY topic{day} ORDER BY cell) AS DOUBLE) AS value
  FROM scrapes
)"""


def _rate(window: int, step: int, extrapolate: bool = True) -> str:
    w, s = _seconds(window), _seconds(step)
    head = f"(first_us - (step_us - {w}))"
    stretch = f"""(span
      + least(CASE WHEN {head} < 1.1 * gap THEN {head} ELSE gap / 2 END,
              CASE WHEN increase > 0 AND first_value >= 0
                   THEN span * first_value / increase END)
      + CASE WHEN step_us - last_us < 1.1 * gap THEN step_us - last_us ELSE gap / 2 END) / span"""
    return f"""
drops AS (
  SELECT *, CASE WHEN value < lag(value) OVER series THEN lag(value) OVER series ELSE 0 END
              AS lost
  FROM counter WINDOW series AS (PARTITION BY topic ORDER BY cell)
),
seen AS (
  SELECT *, unnest(range({_ceil('cell', s)}, cell + {w}, {s})) AS step_us FROM drops
),
steps AS (
  SELECT topic, step_us, count(*) AS n, min(cell) AS first_us, max(cell) AS last_us,
         arg_min(value, cell) AS first_value,
         arg_max(value, cell) - arg_min(value, cell) + sum(lost) - arg_min(lost, cell)
           AS increase
  FROM seen GROUP BY topic, step_us HAVING count(*) >= 2
),
spans AS (
  SELECT *, CAST(last_us - first_us AS DOUBLE) AS span,
         CAST(last_us - first_us AS DOUBLE) / (n - 1) AS gap
  FROM steps
),
rates AS (
  SELECT topic, make_timestamp(step_us) AS eval_ts,
         increase * {stretch if extrapolate else '1'} / {window} AS rate
  FROM spans
)"""


def _rate_query(every: int, window: int, step: int, extrapolate: bool = True) -> str:
    return f"""WITH {_counter(every)}, {_rate(window, step, extrapolate)}
SELECT topic, eval_ts, {rounded('rate', 8)} AS rate FROM rates"""


ORACLES["message_counter"] = f"""WITH {_counter(600)}
SELECT 'pipeline_mensajes_publicados_total' AS metric, topic, make_timestamp(cell) AS ts, value
FROM counter"""
ORACLES["message_counter_running"] = f"""WITH {_counter(15, restart=False)}
SELECT topic, make_timestamp(cell) AS ts, value FROM counter"""

ORACLES["poll_counters"] = f"""WITH scrapes AS (
  SELECT CASE WHEN event_type <> 'error' THEN 'coingecko_peticiones_ok_total'
              ELSE 'coingecko_peticiones_error_total' END AS metric,
         {_ceil('epoch_us(ts)', _seconds(600))} AS cell, count(*) AS n
  FROM events GROUP BY 1, 2
)
SELECT metric, make_timestamp(cell) AS ts,
       CAST(sum(n) OVER (PARTITION BY metric, (cell - 1) // {_seconds(86400)} ORDER BY cell)
            AS DOUBLE) AS value
FROM scrapes"""

_SAMPLES = f"""{_TICKS},
samples AS (
  SELECT 'crypto_precio_actual' AS metric, symbol AS par, event_time AS ts, price AS value
  FROM ticks
  UNION ALL SELECT 'crypto_variacion_24h_pct', symbol, event_time, change_pct FROM ticks
  UNION ALL SELECT 'crypto_volumen_24h', symbol, event_time, volume_24h FROM ticks
)"""
ORACLES["metric_samples"] = f"WITH {_SAMPLES} SELECT * FROM samples"
ORACLES["metric_select"] = f"""WITH {_SAMPLES}
SELECT * FROM samples WHERE metric = 'crypto_precio_actual' AND par = 'purchase'"""
ORACLES["metric_select_all"] = f"""WITH {_SAMPLES}
SELECT par, ts, value FROM samples WHERE metric = 'crypto_variacion_24h_pct'"""
ORACLES["metric_select_unequal"] = """
SELECT event_type AS name, ts, value FROM events WHERE event_type <> 'signup'"""


def _held(source: str, keys: str, step: int, lookback: int) -> str:
    s, l = _seconds(step), _seconds(lookback)
    return f"""
cells AS (
  SELECT {keys}, {_ceil('epoch_us(ts)', s)} AS cell, max(epoch_us(ts)) AS us,
         arg_max(value, ts) AS value
  FROM {source} WHERE value IS NOT NULL GROUP BY ALL
),
held AS (
  SELECT *, least(coalesce(lead(cell) OVER (PARTITION BY {keys} ORDER BY cell) - {s},
                           9223372036854775807),
                  (us + {l}) // {s} * {s}) AS until
  FROM cells
)"""


def _gridded(step: int) -> str:
    return f"unnest(range(cell, until + 1, {_seconds(step)}))"


ORACLES["metric_grid"] = f"""WITH {_held('events', 'event_type', 15, 300)}
SELECT event_type AS par, make_timestamp({_gridded(15)}) AS eval_ts, value FROM held"""
ORACLES["metric_rate"] = _rate_query(600, 10800, 3600)
ORACLES["metric_rate_plain"] = _rate_query(600, 10800, 3600, extrapolate=False)
ORACLES["metric_rate_minute"] = _rate_query(15, 60, 15)
ORACLES["metric_rate_avg"] = f"""WITH {_counter(600)}, {_rate(10800, 3600)}
SELECT eval_ts, {rounded('100 - avg(rate) * 100', 6)} AS value FROM rates GROUP BY eval_ts"""
ORACLES["metric_container_cpu"] = f"""WITH {_counter(600)}, {_rate(10800, 3600)}
SELECT topic AS name, eval_ts, {rounded('rate * 100', 6)} AS value FROM rates"""
ORACLES["metric_container_memory"] = f"""WITH {_held('events', 'event_type', 300, 3600)}
SELECT event_type AS name, make_timestamp({_gridded(300)}) AS eval_ts,
       {rounded('value / 1024 / 1024', 9)} AS value
FROM held WHERE event_type <> 'signup'"""
ORACLES["metric_diff"] = f"""WITH {_EVENTS},
sides AS (SELECT *, k >= 50 AS total FROM rows),
{_held('sides', 'event_type, total', 900, 3600)},
grid AS (SELECT event_type AS par, total, {_gridded(900)} AS step_us, value FROM held)
SELECT par, make_timestamp(step_us) AS eval_ts, {rounded('a.value - b.value', 4)} AS value
FROM (SELECT * FROM grid WHERE total) a JOIN (SELECT * FROM grid WHERE NOT total) b
  USING (par, step_us)"""

# --- alerts ----------------------------------------------------------------------------

_RULES = """
rules(rule, severity, metric, par, above, below, hold) AS (
  VALUES ('Dump', 'critical', 'crypto_variacion_24h_pct', 'view', NULL, -3.0, 60000000),
         ('Pump', 'warning', 'crypto_variacion_24h_pct', 'purchase', 3.0, NULL, 360000000),
         ('Cheap', 'info', 'crypto_precio_actual', NULL, NULL, 10.0, 7200000000)
)"""
_APPLIES = """h.metric = r.metric AND (r.par IS NULL OR h.par = r.par)
  AND (h.value > r.above OR h.value < r.below)"""


def _sustained(step: int, lookback: int) -> str:
    s = _seconds(step)
    return f"""{_SAMPLES}, {_RULES}, {_held('samples', 'metric, par', step, lookback)},
spans AS (
  SELECT r.rule, r.severity, r.hold, h.par, h.cell, h.until
  FROM held h JOIN rules r ON {_APPLIES}
),
marked AS (
  SELECT *, coalesce(cell > lag(until) OVER (PARTITION BY rule, par ORDER BY cell) + {s}, true)
              AS starts
  FROM spans
),
numbered AS (
  SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY rule, par ORDER BY cell) AS run
  FROM marked
),
runs AS (
  SELECT rule, severity, par, min(cell) AS pending, max(until) AS until,
         min(cell) + {_ceil('hold', s)} AS fires
  FROM numbered GROUP BY rule, severity, par, hold, run
),
alerts AS (
  SELECT rule, severity, par, make_timestamp(pending) AS pending_at,
         CASE WHEN fires <= until THEN make_timestamp(fires) END AS firing_at,
         make_timestamp(until + {s}) AS resolved_at
  FROM runs
)"""


ORACLES["threshold"] = f"""WITH {_SAMPLES}, {_RULES}
SELECT r.rule, r.severity, h.metric, h.par, h.ts, h.value
FROM samples h JOIN rules r ON {_APPLIES}"""
ORACLES["sustained_alerts"] = f"WITH {_sustained(15, 300)} SELECT * FROM alerts"
ORACLES["sustained_alerts_wide"] = f"WITH {_sustained(60, 10800)} SELECT * FROM alerts"


def _silence(limit: str) -> str:
    return f"""
SELECT event_type AS symbol, ts AS silent_from, following AS silent_until
FROM (SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS following FROM events)
WHERE following - ts > INTERVAL '{limit}'"""


ORACLES["feed_silence"] = _silence("1 hour")
ORACLES["feed_silence_minute"] = _silence("30 seconds")

ORACLES["alert_texts"] = f"""WITH {_sustained(15, 300)},
texts(rule, summary, description) AS (
  VALUES ('Dump', 'views fall', 'views are down by more than 3 percent'),
         ('Pump', 'purchases rise', 'purchases are up by more than 3 percent'),
         ('Cheap', 'cheap', 'less than ten')
),
changes AS (
  SELECT rule, par, 'pending' AS state, pending_at AS changed FROM alerts
  UNION ALL SELECT rule, par, 'firing', firing_at FROM alerts WHERE firing_at IS NOT NULL
  UNION ALL SELECT rule, par, 'resolved', resolved_at FROM alerts
)
SELECT rule, par, state, changed AS "at", summary, description FROM changes JOIN texts USING (rule)"""
_LOOK = "(SELECT max(ts) + INTERVAL '2 hours' FROM events)"
ORACLES["feed_silence_open"] = f"""{_silence('1 hour')}
UNION ALL SELECT event_type, max(ts), NULL FROM events GROUP BY event_type
HAVING {_LOOK} - max(ts) > INTERVAL '1 hour'"""
ORACLES["producer_up"] = f"""WITH alive AS (
  SELECT DISTINCT {_ceil('epoch_us(ts)', _seconds(60))} AS us FROM events
),
gaps AS (
  SELECT epoch_us(ts) AS since, epoch_us(lead(ts) OVER (ORDER BY ts)) AS next FROM events
),
dead AS (
  SELECT unnest(range((since + {_seconds(600)}) // 60000000 * 60000000 + 60000000,
                      coalesce(next - 1, epoch_us({_LOOK})) + 1, 60000000)) AS us
  FROM gaps
  WHERE coalesce(next, epoch_us({_LOOK})) - since > {_seconds(600)}
)
SELECT 'up' AS metric, 'crypto-producer' AS job, make_timestamp(us) AS ts,
       CAST(v AS DOUBLE) AS value
FROM (SELECT us, 1 AS v FROM alive UNION ALL SELECT us, 0 FROM dead)"""

# --- streams: what append mode has emitted lies behind the watermark ---------------------


def _behind(delay: str, where: str = "true") -> str:
    return f"""(SELECT date_trunc('millisecond', max(ts)) - INTERVAL '{delay}'
                FROM events WHERE {where})"""


def _emitted(full: str, watermark: str) -> str:
    return f"SELECT * FROM ({full}) WHERE window_end <= {watermark}"


ORACLES["stream_sma_append"] = _emitted(ORACLES["sma_volatility_wide"], _behind("2 minutes"))
ORACLES["stream_sma_complete"] = ORACLES["sma_volatility_wide"]
ORACLES["stream_pump_dump"] = _emitted(ORACLES["pump_dump"], _behind("1 minute"))
ORACLES["stream_sma_panes"] = ORACLES["stream_sma_append"]
ORACLES["stream_pump_dump_panes"] = ORACLES["stream_pump_dump"]
ORACLES["stream_grid"] = ORACLES["metric_grid"]
ORACLES["stream_rate"] = ORACLES["metric_rate"]
# Window and step behind the last rates, the watermark of the last query.
ORACLES["stream_rate_avg"] = f"""WITH means AS ({ORACLES["metric_rate_avg"]})
SELECT * FROM means WHERE eval_ts <= (SELECT max(eval_ts) - INTERVAL '4 hours' FROM means)"""
ORACLES["stream_metric_diff"] = ORACLES["metric_diff"]
ORACLES["stream_history_table"] = f"""WITH {_EVENTS}
SELECT event_type AS par, CAST(ts AS DATE) AS fecha, count(*) AS ticks,
       CAST(sum(user_id) AS DOUBLE) AS volume, max(value) AS price_max
FROM rows WHERE k BETWEEN 10 AND 89 GROUP BY ALL"""
ORACLES["stream_lagging_feeds"] = """
SELECT event_type AS feed, ts AS silent_from, ts + INTERVAL '1 hour' AS silent_after
FROM (SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS following FROM events)
WHERE following IS NULL OR following - ts > INTERVAL '1 hour'"""
ORACLES["stream_deviation"] = _emitted(ORACLES["price_deviation"], _behind("2 minutes"))
ORACLES["stream_deviation_max"] = _emitted(
    ORACLES["price_deviation"], f"({_behind('2 minutes')} + INTERVAL '1 hour')"
)
_FIRST_WAVE = _behind("10 days", "value >= 10")
ORACLES["stream_late_data"] = _emitted(
    _moving_average(
        _TICKS, "1 hour", "12 minutes", 5,
        f"WHERE price >= 10 OR window_start + INTERVAL '1 hour' > {_FIRST_WAVE}",
    ),
    f"greatest({_FIRST_WAVE}, {_behind('10 days')})",
)
ORACLES["stream_message_counts"] = """
SELECT lower(event_type) || '-ticker' AS topic, count(*) AS messages FROM events GROUP BY 1"""
# Delivered are the steps the first query's watermark has passed; the second one's watermark is
# the latest of them. A run that ends with its series' last delivered value is still open, unless
# the value's reach lies behind that too.
ORACLES["stream_alerts"] = f"""WITH {_SAMPLES}, {_RULES},
delivered AS (
  SELECT * FROM samples
  WHERE metric IN (SELECT metric FROM rules)
    AND {_ceil('epoch_us(ts)', _seconds(60))} < epoch_us({_behind('1 minute')})
),
{_held('delivered', 'metric, par', 60, 10800)},
spans AS (
  SELECT r.rule, r.severity, r.hold, h.par, h.cell, h.until,
         h.cell = (SELECT max(cell) FROM held l WHERE l.metric = h.metric AND l.par = h.par)
           AND h.until + 60001000 >= (SELECT max(cell) FROM held) AS undecided
  FROM held h JOIN rules r ON {_APPLIES}
),
marked AS (
  SELECT *, coalesce(cell > lag(until) OVER (PARTITION BY rule, par ORDER BY cell) + 60000000,
                     true) AS starts
  FROM spans
),
numbered AS (
  SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY rule, par ORDER BY cell) AS run
  FROM marked
),
runs AS (
  SELECT rule, severity, par, min(cell) AS pending, min(cell) + {_ceil('hold', _seconds(60))}
           AS fires,
         max(until) AS until, max(cell) - 60000000 AS known, bool_or(undecided) AS undecided
  FROM numbered GROUP BY rule, severity, par, hold, run
),
changes AS (
  SELECT rule, severity, par, pending, 'pending' AS state, pending AS changed FROM runs
  UNION ALL SELECT rule, severity, par, pending, 'firing', fires FROM runs
            WHERE fires <= CASE WHEN undecided THEN known ELSE until END
  UNION ALL SELECT rule, severity, par, pending, 'resolved', until + 60000000 FROM runs
            WHERE NOT undecided
)
SELECT rule, severity, par, state, make_timestamp(changed) AS "at",
       make_timestamp(pending) AS pending_at
FROM changes"""
ORACLES["stream_silence"] = f"""
SELECT event_type AS symbol, ts AS silent_from, ts + INTERVAL '1 hour' AS silent_after
FROM (SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS following FROM events)
WHERE (following IS NULL OR following - ts > INTERVAL '1 hour')
  AND ts + INTERVAL '1 hour' <= {_behind('1 minute')}"""
ORACLES["stream_producer_down"] = f"""
SELECT event_type AS symbol, ts AS silent_from, ts + INTERVAL '1 hour' AS silent_after
FROM (SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS following FROM events)
WHERE following IS NULL OR following - ts > INTERVAL '1 hour'"""
ORACLES["stream_processing_time"] = "SELECT event_id, event_type AS symbol FROM events"
ORACLES["stream_console"] = "SELECT count(*) AS rows FROM events"
ORACLES["stream_run_any"] = f"""WITH {_EVENTS}
SELECT event_type AS symbol, value AS price, NULL AS missing FROM rows WHERE k BETWEEN 10 AND 89
UNION ALL
SELECT NULL, NULL, CASE WHEN k >= 90 THEN 'symbol,price,timestamp' ELSE 'price' END
FROM rows WHERE k NOT BETWEEN 10 AND 89"""
ORACLES["stream_parquet_sink"] = f"""WITH {_TICKS}
SELECT event_id, symbol AS par, CAST(event_time AS DATE) AS fecha, price, change_pct
FROM ticks"""
ORACLES["stream_publish"] = f"""WITH {_EVENTS}
SELECT lower(event_type) || '-ticker' AS topic, event_type AS key, {_MILLIS} AS timestamp,
       value AS price, '' AS missing
FROM rows WHERE {_GOOD_TICKER}
UNION ALL
SELECT NULL, NULL, NULL, NULL, CASE WHEN k >= 90 THEN 'stream' ELSE 'price' END
FROM rows WHERE k >= 90 OR (k < 10 AND event_type <> 'signup')"""
ORACLES["stream_job_history"] = f"""WITH {_CANDLES},
quotes AS (
  SELECT DISTINCT date_trunc('hour', ts) AS hour, upper(event_type) || 'USD' AS par
  FROM rows WHERE event_type IN ('view', 'purchase')
)
SELECT 'tickers' AS feed, event_type AS par, CAST(ts AS DATE) AS fecha, count(*) AS messages
FROM rows WHERE {_GOOD_TICKER} GROUP BY ALL
UNION ALL SELECT 'klines', symbol, CAST(hour AS DATE), count(*)
          FROM candles WHERE closed GROUP BY ALL
UNION ALL SELECT 'coingecko', par, CAST(hour AS DATE), count(*) FROM quotes GROUP BY ALL
UNION ALL SELECT 'feargreed', NULL, CAST(ts AS DATE), count(*)
          FROM rows WHERE k < 90 GROUP BY ALL"""
