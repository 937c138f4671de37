"""Names and limits that existing feeds, tables and dashboards rely on."""

# --- fixed values: message topics -------------------------------------------
TICKER_TOPICS = ("btcusdt-ticker", "ethusdt-ticker")
KLINE_TOPIC = "crypto-klines"
MARKET_TOPIC = "coingecko-market"
SENTIMENT_TOPIC = "feargreed-index"
SENTIMENT_KEY = "FNG"

# --- fixed values: markers inside the stream name of a raw exchange message --
TICKER_MARKER = "miniTicker"
KLINE_MARKER = "kline"

# --- fixed values: coin id of the global feed -> trading symbol --------------
COIN_SYMBOLS = {"bitcoin": "BTCUSDT", "ethereum": "ETHUSDT"}

# --- fixed values: history directories and their partition columns -----------
HISTORY = {
    "tickers": ("par", "fecha"),
    "klines": ("par", "fecha"),
    "coingecko": ("par", "fecha"),
    "feargreed": ("fecha",),
}

# --- fixed values: labels and limits of the pump-and-dump indicator ----------
PUMP = "🚀 PUMP"
DUMP = "💥 DUMP"
NORMAL = "normal"
MOVE_LIMIT_PCT = 2.0

# --- fixed values: sentiment bands (inclusive upper bound, name) -------------
SENTIMENT_BANDS = ((24, "Extreme Fear"), (49, "Fear"), (74, "Greed"))
SENTIMENT_TOP = "Extreme Greed"

# --- fixed values: price columns of the published deviation table ------------
LOCAL_PRICE = "binance_price"
GLOBAL_PRICE = "coingecko_price"

# --- fixed values: metric names ----------------------------------------------
PRICE_NOW = "crypto_precio_actual"
CHANGE_24H = "crypto_variacion_24h_pct"
VOLUME_24H = "crypto_volumen_24h"
MESSAGES_TOTAL = "pipeline_mensajes_publicados_total"
MARKET_CAP = "coingecko_market_cap_usd"
MARKET_VOLUME = "coingecko_volumen_24h_usd"
MARKET_PRICE = "coingecko_precio_usd"
POLLS_OK = "coingecko_peticiones_ok_total"
POLLS_FAILED = "coingecko_peticiones_error_total"
SENTIMENT_INDEX = "crypto_fear_greed_index"
UP = "up"
PRODUCER = "crypto-producer"
CONTAINER_CPU = "container_cpu_usage_seconds_total"
CONTAINER_MEMORY = "container_memory_usage_bytes"
NODE_CPU = "node_cpu_seconds_total"
NODE_MEMORY_TOTAL = "node_memory_MemTotal_bytes"
NODE_MEMORY_AVAILABLE = "node_memory_MemAvailable_bytes"

# --- fixed values: evaluation of rules and panels ----------------------------
EVALUATE_EVERY = "15 seconds"
LOOKBACK = "5 minutes"
RATE_WINDOW = "1 minute"
SILENCE_LIMIT = "30 seconds"
