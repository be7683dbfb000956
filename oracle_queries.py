"""DuckDB SQL for every query of the catalog, on the same parquet tables."""

from __future__ import annotations


def _round(x: str, digits: int = 2) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    x = f"CAST({x} AS DOUBLE)"
    return f"(sign({x}) * floor(abs({x}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale} + CAST(0 AS DOUBLE))"


def _ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _pct(new: str, old: str) -> str:
    return f"({_ratio(f'({new}) - ({old})', old)} * CAST(100 AS DOUBLE))"


def _money(x: str) -> str:
    return f"CAST(CAST(ROUND({x}, 2) AS DECIMAL(18,2)) AS DOUBLE)"


PRICES = """
prices AS (
  SELECT l_suppkey AS constituent_id, CAST(l_shipdate AS DATE) AS date,
         CAST(MAX(CASE WHEN rn_a = 1 THEN px END) AS DECIMAL(18,2)) AS open_price,
         MAX(px) AS high_price, MIN(px) AS low_price,
         CAST(MAX(CASE WHEN rn_d = 1 THEN px END) AS DECIMAL(18,2)) AS close_price,
         CAST(SUM(qty) AS BIGINT) AS volume
  FROM (SELECT l_suppkey, l_shipdate,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS px, CAST(l_quantity AS BIGINT) AS qty,
               ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                 ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS rn_a,
               ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                 ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
                          l_extendedprice DESC, l_quantity DESC) AS rn_d
        FROM lineitem) x
  GROUP BY l_suppkey, CAST(l_shipdate AS DATE))"""

CONSTITUENTS = """
constituents AS (
  SELECT s_suppkey AS id, s_name AS ticker, UPPER(s_name) AS name, n_name AS sector, r_name AS industry,
         CASE WHEN s_acctbal >= 5000 THEN 'Large' WHEN s_acctbal >= 0 THEN 'Mid' ELSE 'Small' END AS market_cap
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

HOLDINGS = """
holdings AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS etf_upload_id, s_suppkey AS constituent_id,
         CAST(CAST(1 + s_suppkey % 9 AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(9,4)) AS DECIMAL(9,4)) AS weight
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT CAST(6 AS BIGINT), s_suppkey,
         CAST(CAST(1 + s_suppkey % 5 AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(9,4)) AS DECIMAL(9,4))
  FROM supplier WHERE s_acctbal > 0)"""

UPLOADS = """
uploads AS (
  SELECT h.etf_upload_id AS id, COALESCE(LOWER(r_name), 'positive_balance') || '_etf.csv' AS filename,
         CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(h.etf_upload_id AS INTEGER)) AS VARCHAR) AS uploaded_at,
         CAST(h.total_weight AS DOUBLE) AS total_weight, h.num_constituents, h.etf_upload_id <> 6 AS is_active
  FROM (SELECT etf_upload_id, SUM(weight) AS total_weight, COUNT(*) AS num_constituents
        FROM holdings GROUP BY etf_upload_id) h
  LEFT JOIN region ON r_regionkey + 1 = h.etf_upload_id)"""

SERIES = """
series AS (
  SELECT etf_upload_id, date, CAST(ROUND(SUM(weight * close_price), 2) AS DECIMAL(18,2)) AS price,
         COUNT(*) AS present
  FROM holdings JOIN prices USING (constituent_id) GROUP BY etf_upload_id, date)"""

VALUED = """
valued AS (
  SELECT h.etf_upload_id, c.ticker, c.name AS company_name, c.sector, h.weight, p.close_price,
         h.weight * p.close_price AS value, p.volume, p.date
  FROM holdings h JOIN constituents c ON c.id = h.constituent_id
  JOIN prices p ON p.constituent_id = c.id
  WHERE p.date = (SELECT MAX(date) FROM prices))"""

QUOTES = """
quotes AS (
  SELECT l_suppkey AS constituent_id, CAST(l_shipdate AS DATE) AS date,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))) AS high,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS low,
         CASE WHEN CAST(l_tax AS DECIMAL(4,2)) = 0 THEN NULL
              WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS close,
         l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS px, CAST(l_quantity AS BIGINT) AS qty
  FROM lineitem)"""

TICKS = """
ticks AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
         CAST(value AS DECIMAL(18,2)) AS close, event_id % 5 AS file
  FROM events),
loaded AS (SELECT * FROM ticks WHERE date < DATE '2024-01-06'),
landing AS (SELECT * FROM ticks WHERE date >= DATE '2024-01-04'),
wms AS (SELECT ticker, MAX(date) AS wm FROM loaded GROUP BY ticker),
newest AS (SELECT ticker, file, MAX(date) AS newest FROM landing WHERE close > 0 GROUP BY ticker, file),
floors AS (
  SELECT n.ticker, n.file,
         GREATEST(MAX(newest) OVER (PARTITION BY n.ticker ORDER BY n.file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), wm) AS floor
  FROM newest n LEFT JOIN wms USING (ticker)),
validated AS (
  SELECT l.*, CASE WHEN close IS NULL THEN 'null_close' WHEN close <= 0 THEN 'non_positive_close'
                   WHEN date <= floor THEN 'at_or_below_watermark' END AS issue0
  FROM landing l LEFT JOIN floors f ON f.ticker = l.ticker AND f.file = l.file),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, date, file, issue0 IS NULL ORDER BY event_id DESC) AS rn FROM validated),
labelled AS (
  SELECT ticker, date, file, event_id, close,
         COALESCE(issue0, CASE WHEN rn > 1 THEN 'duplicate' END,
                  CASE WHEN ticker NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) THEN 'unknown_ticker' END) AS issue
  FROM ranked)"""

FILES = """
files AS (
  SELECT DISTINCT CAST(ts AS DATE) AS date, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-06' THEN 'processed' ELSE 'pending' END AS state
  FROM events)"""

WEIGHTS = """
weight_rows AS (
  SELECT LOWER(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey // 1500 AS VARCHAR) || '_etf.csv' AS file,
         CASE WHEN NOT bal BETWEEN 8900 AND 9100 THEN 'Supplier#' || LPAD(CAST(c_custkey // 14 AS VARCHAR), 9, '0') END AS name,
         CASE WHEN bal > 9700 THEN 'pending' WHEN bal > 9400 THEN NULL
              WHEN bal > 9100 OR bal < -700 THEN CAST(bal AS VARCHAR)
              ELSE CAST(CAST(ABS(bal) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,6)) AS VARCHAR) END AS weight_text
  FROM (SELECT *, CAST(c_acctbal AS DECIMAL(18,2)) AS bal FROM customer) c),
weighed AS (SELECT *, TRY_CAST(weight_text AS DECIMAL(18,8)) AS w FROM weight_rows)"""

PAIRS = """
paired AS (
  SELECT a.constituent_id AS key_a, b.constituent_id AS key_b, a.date, a.close_price AS price_a, b.close_price AS price_b
  FROM prices a JOIN prices b ON b.constituent_id = a.constituent_id + 1 AND b.date = a.date)"""

RETURNS = f"""
lagged AS (
  SELECT *, LAG(close_price) OVER (PARTITION BY constituent_id ORDER BY date) AS prev_close FROM prices),
returns AS (
  SELECT *, {_pct('close_price', 'prev_close')} AS r FROM lagged WHERE prev_close IS NOT NULL)"""

CALENDAR_RULE = """
  EXTRACT(ISODOW FROM date) < 6
  AND strftime(date, '%m-%d') NOT IN ('01-01', '07-04', '12-25')
  AND strftime(date, '%m-%d') <> CASE WHEN EXTRACT(YEAR FROM date) >= 2020 THEN '01-20' ELSE '01-21' END
  AND strftime(date, '%m-%d') <> CASE WHEN EXTRACT(YEAR FROM date) = 2019 THEN '11-28' ELSE '11-26' END"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_OHLC = """CAST(open_price AS DOUBLE) AS open_price, CAST(high_price AS DOUBLE) AS high_price,
  CAST(low_price AS DOUBLE) AS low_price, CAST(close_price AS DOUBLE) AS close_price, volume"""
_BAR = f"constituent_id, date, {_OHLC}"
_MEAN_CLOSE = _ratio("SUM(close_price)", "COUNT(close_price)")
_TRUNC_VOLUME = "CAST(TRUNC(SUM(volume) / COUNT(volume)) AS BIGINT)"
_MARKET = (PRICES, CONSTITUENTS)
_ETF = (PRICES, HOLDINGS, SERIES)

_WIDE = ", ".join(f"MAX(CASE WHEN etf_upload_id = {i} THEN CAST(price AS DOUBLE) END) AS \"ETF{i}\"" for i in range(1, 7))


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY constituent_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _moving(n: int) -> str:
    return _round(_ratio(f"SUM(close_price) {_frame(n)}", f"COUNT(close_price) {_frame(n)}"))


_LAG = "LAG(close_price) OVER (PARTITION BY constituent_id ORDER BY date)"

_RULES = """
by_name AS (
  SELECT file, name, COUNT(*) AS n FROM weighed WHERE name IS NOT NULL OR weight_text IS NOT NULL GROUP BY file, name),
stats AS (
  SELECT file, COUNT(*) AS n, COUNT(*) FILTER (WHERE name IS NULL) AS null_name,
         COUNT(*) FILTER (WHERE weight_text IS NULL) AS null_weight,
         COUNT(*) FILTER (WHERE weight_text IS NOT NULL AND w IS NULL) AS text_weight,
         COUNT(*) FILTER (WHERE w < 0) AS neg, COUNT(*) FILTER (WHERE w > 1) AS over_one,
         COUNT(*) FILTER (WHERE w = 0) AS zero, COALESCE(SUM(w), 0) AS total
  FROM weighed WHERE name IS NOT NULL OR weight_text IS NOT NULL GROUP BY file),
named AS (
  SELECT file, SUM(CASE WHEN name IS NOT NULL THEN n - 1 ELSE 0 END) AS dup,
         COUNT(*) FILTER (WHERE name IS NOT NULL AND name NOT IN (SELECT s_name FROM supplier)) AS unknown
  FROM by_name GROUP BY file),
rules AS (
  SELECT file, 2 AS rule_order, 'null_name' AS rule, 'error' AS severity, null_name AS n FROM stats
  UNION ALL SELECT file, 3, 'duplicate_name', 'error', dup FROM named
  UNION ALL SELECT file, 4, 'null_weight', 'error', null_weight FROM stats
  UNION ALL SELECT file, 5, 'non_numeric_weight', 'error', text_weight FROM stats
  UNION ALL SELECT file, 6, 'negative_weight', 'error', neg FROM stats
  UNION ALL SELECT file, 7, 'weight_over_one', 'error', over_one FROM stats
  UNION ALL SELECT file, 8, 'all_zero', 'error', CASE WHEN zero = n THEN n ELSE 0 END FROM stats
  UNION ALL SELECT file, 9, 'total_not_positive', 'error', CASE WHEN total <= 0 THEN n ELSE 0 END FROM stats
  UNION ALL SELECT file, 10, 'sum_not_one', 'warning', CASE WHEN total > 0 AND ABS(total - 1) > 0.01 THEN n ELSE 0 END FROM stats
  UNION ALL SELECT file, 11, 'unknown_ticker', 'error', unknown FROM named
  UNION ALL SELECT file, 12, 'too_many_holdings', 'error', CASE WHEN n > 1000 THEN n ELSE 0 END FROM stats)"""

_COMPOSITE = """
composite AS (
  SELECT date, 'ETF' || CAST(etf_upload_id AS VARCHAR) AS ticker, MIN(open_price) AS open, MAX(high_price) AS high,
         MIN(low_price) AS low, MAX(close_price) AS close, CAST(SUM(volume) AS BIGINT) AS volume
  FROM prices JOIN holdings USING (constituent_id) GROUP BY date, etf_upload_id)"""

_RANGE_ENDS = """
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY etf_upload_id ORDER BY date DESC) AS back FROM series),
spans(range, days) AS (VALUES ('1W', 7), ('1M', 30), ('3M', 90), ('ALL', NULL)),
ends AS (
  SELECT etf_upload_id, range, COUNT(*) AS days, ARG_MIN(price, date) AS a, ARG_MAX(price, date) AS b
  FROM placed JOIN spans ON spans.days IS NULL OR back <= spans.days GROUP BY etf_upload_id, range)"""

ORACLE: dict[str, str] = {
    "scan_prices": _with(PRICES) + f"SELECT {_BAR} FROM prices",
    "scan_constituents": _with(CONSTITUENTS) + "SELECT * FROM constituents",
    "scan_weights": _with(WEIGHTS) + "SELECT file, name, weight_text, CAST(w AS DOUBLE) AS weight FROM weighed",
    "pivot_close": _with(*_ETF) + f"SELECT date, {_WIDE} FROM series GROUP BY date",
    "wide_to_long": _with(*_ETF)
    + "SELECT date, 'ETF' || CAST(etf_upload_id AS VARCHAR) AS ticker, CAST(price AS DOUBLE) AS close FROM series",
    "vendor_slice": _with(*_MARKET) + f"""SELECT {_BAR} FROM prices JOIN constituents ON id = constituent_id
      WHERE industry = 'ASIA' AND date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""",
    "vendor_wide_to_long": _with(PRICES, HOLDINGS, _COMPOSITE) + """SELECT date, ticker, CAST(open AS DOUBLE) AS open,
      CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume FROM composite""",
    "feed_first_n_days": _with(PRICES, """
      last AS (SELECT MAX(date) AS d FROM prices WHERE date < DATE '2000-01-01'),
      days AS (SELECT DISTINCT date FROM prices, last WHERE date > d ORDER BY date LIMIT 5)""")
    + f"SELECT {_BAR} FROM prices WHERE date IN (SELECT date FROM days)",
    "etf_series": _with(*_ETF) + "SELECT etf_upload_id, date, CAST(price AS DOUBLE) AS price FROM series",
    "etf_series_complete": _with(*_ETF) + """SELECT g.etf_upload_id, g.date, CAST(CASE WHEN present = held THEN price END AS DOUBLE) AS price
      FROM (SELECT h.etf_upload_id, held, d.date FROM (SELECT etf_upload_id, COUNT(*) AS held FROM holdings GROUP BY 1) h
            CROSS JOIN (SELECT DISTINCT date FROM prices) d) g
      LEFT JOIN series s ON s.etf_upload_id = g.etf_upload_id AND s.date = g.date""",
    "holdings": _with(*_MARKET, HOLDINGS, VALUED) + f"""SELECT etf_upload_id, ticker AS name, company_name, sector,
      CAST(weight AS DOUBLE) AS weight, CAST(close_price AS DOUBLE) AS latest_price, {_money('value')} AS holding_value,
      volume, date AS price_date FROM valued""",
    "holdings_total": _with(*_MARKET, HOLDINGS, VALUED) + """SELECT etf_upload_id, COUNT(*) AS num_holdings,
      CAST(SUM(weight) AS DOUBLE) AS total_weight FROM valued GROUP BY 1""",
    "top_holdings": _with(*_MARKET, HOLDINGS, VALUED) + f"""SELECT etf_upload_id, ticker AS name, CAST(weight AS DOUBLE) AS weight,
      CAST(close_price AS DOUBLE) AS latest_price, {_money('value')} AS holding_value, rank
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY etf_upload_id ORDER BY value DESC, ticker) AS rank FROM valued) x WHERE rank <= 5""",
    "best_worst_days": _with(*_ETF, f"""
      daily AS (SELECT etf_upload_id, date, price, LAG(price) OVER (PARTITION BY etf_upload_id ORDER BY date) AS prev_price FROM series),
      rets AS (SELECT *, {_round(_pct('price', 'prev_price'))} AS return_pct FROM daily),
      sided AS (
        SELECT *, 'best' AS side, ROW_NUMBER() OVER (PARTITION BY etf_upload_id ORDER BY return_pct DESC, date) AS place FROM rets WHERE return_pct IS NOT NULL
        UNION ALL
        SELECT *, 'worst', ROW_NUMBER() OVER (PARTITION BY etf_upload_id ORDER BY return_pct, date) FROM rets WHERE return_pct IS NOT NULL)""")
    + """SELECT etf_upload_id, side, place, date, CAST(price AS DOUBLE) AS etf_price, CAST(prev_price AS DOUBLE) AS prev_price, return_pct
      FROM sided WHERE place <= 5""",
    "etf_compare": _with(*_ETF, UPLOADS, """
      span AS (SELECT etf_upload_id, MIN(date) AS first_date, MAX(date) AS last_date FROM holdings JOIN prices USING (constituent_id) GROUP BY 1),
      starts AS (SELECT h.etf_upload_id, CAST(ROUND(SUM(weight * close_price), 2) AS DECIMAL(18,2)) AS v FROM span s JOIN holdings h USING (etf_upload_id)
                 JOIN prices p ON p.constituent_id = h.constituent_id AND p.date = s.first_date GROUP BY 1),
      stops AS (SELECT h.etf_upload_id, CAST(ROUND(SUM(weight * close_price), 2) AS DECIMAL(18,2)) AS v FROM span s JOIN holdings h USING (etf_upload_id)
                JOIN prices p ON p.constituent_id = h.constituent_id AND p.date = s.last_date GROUP BY 1)""")
    + f"""SELECT u.id, u.filename, CAST(a.v AS DOUBLE) AS start_price, CAST(b.v AS DOUBLE) AS end_price,
      {_round('b.v - a.v')} AS absolute_return, {_round(_pct('b.v', 'a.v'))} AS return_pct,
      CASE WHEN b.v > a.v THEN 'POSITIVE' WHEN b.v < a.v THEN 'NEGATIVE' ELSE 'FLAT' END AS performance
      FROM starts a JOIN stops b USING (etf_upload_id) JOIN uploads u ON u.id = a.etf_upload_id""",
    "sector_exposure": _with(CONSTITUENTS, HOLDINGS) + """SELECT etf_upload_id, sector, COUNT(*) AS num_holdings,
      CAST(CAST(ROUND(SUM(weight), 4) AS DECIMAL(18,4)) AS DOUBLE) AS total_weight,
      CAST(CAST(ROUND(SUM(weight) * 100, 2) AS DECIMAL(18,2)) AS DOUBLE) AS weight_pct,
      CAST(CAST(ROUND(SUM(weight) * 100, 2) AS DECIMAL(18,2)) AS VARCHAR) || '%' AS weight_label
      FROM holdings JOIN constituents ON id = constituent_id GROUP BY etf_upload_id, sector""",
    "portfolio_list": _with(HOLDINGS, UPLOADS) + "SELECT * FROM uploads ORDER BY uploaded_at DESC, id DESC",
    "active_portfolio": _with(HOLDINGS, UPLOADS) + "SELECT * FROM uploads WHERE is_active ORDER BY uploaded_at DESC, id DESC LIMIT 1",
    "trailing_change": _with(*_ETF, _RANGE_ENDS) + f"""SELECT etf_upload_id, range, days, CAST(a AS DOUBLE) AS first_price,
      CAST(b AS DOUBLE) AS last_price, {_round('b - a')} AS change,
      {_round(f"CASE WHEN a > 0 THEN {_pct('b', 'a')} ELSE 0 END")} AS pct_change, b >= a AS is_positive FROM ends""",
    "price_summary": _with(*_MARKET) + f"""SELECT ticker, name AS company_name, sector, industry, COUNT(*) AS trading_days,
      {_round('MIN(close_price)')} AS min_price, {_round('MAX(close_price)')} AS max_price, {_round(_MEAN_CLOSE)} AS avg_price,
      {_round('MAX(close_price) - MIN(close_price)')} AS price_range,
      {_round(f"{_ratio('MAX(close_price) - MIN(close_price)', 'MIN(close_price)')} * CAST(100 AS DOUBLE)")} AS range_pct,
      {_TRUNC_VOLUME} AS avg_volume
      FROM prices JOIN constituents ON id = constituent_id GROUP BY ticker, name, sector, industry HAVING COUNT(*) > 0""",
    "moving_average": _with(PRICES) + f"""SELECT constituent_id, date, CAST(close_price AS DOUBLE) AS price, {_moving(5)} AS moving_avg,
      {_round(f'close_price - {_LAG}')} AS daily_change, {_round(_pct('close_price', _LAG))} AS daily_return_pct FROM prices""",
    "moving_averages_5_20": _with(PRICES) + f"""SELECT constituent_id, date, CAST(close_price AS DOUBLE) AS close_price,
      {_moving(5)} AS ma_5, {_moving(20)} AS ma_20 FROM prices""",
    "daily_returns": _with(PRICES, RETURNS)
    + f"SELECT {_BAR}, CAST(prev_close AS DOUBLE) AS prev_close, {_round('r')} AS daily_return FROM returns",
    "volatility": _with(*_MARKET, RETURNS, f"rounded AS (SELECT constituent_id, {_round('r')} AS d FROM returns)") + f"""SELECT ticker,
      {_round('STDDEV_SAMP(d)', 4)} AS volatility, {_round(_ratio('SUM(CAST(d AS DECIMAL(18,2)))', 'COUNT(d)'), 4)} AS avg_daily_return,
      MIN(d) AS worst_day_pct, MAX(d) AS best_day_pct, COUNT(d) AS trading_days
      FROM rounded JOIN constituents ON id = constituent_id GROUP BY ticker""",
    "performance_ranking": _with(*_MARKET, """
      ends AS (SELECT constituent_id, ARG_MIN(close_price, date) AS a, ARG_MAX(close_price, date) AS b FROM prices GROUP BY 1)""")
    + f"""SELECT ticker, CAST(a AS DOUBLE) AS first_price, CAST(b AS DOUBLE) AS last_price, total_return_pct,
      ROW_NUMBER() OVER (ORDER BY total_return_pct DESC NULLS LAST, constituent_id) AS rank
      FROM (SELECT *, {_round(_pct('b', 'a'))} AS total_return_pct FROM ends) e JOIN constituents ON id = constituent_id""",
    "volume_leaders": _with(*_MARKET) + f"""SELECT ticker, name AS company_name, sector, {_TRUNC_VOLUME} AS avg_volume,
      MAX(volume) AS max_volume, MIN(volume) AS min_volume
      FROM prices JOIN constituents ON id = constituent_id WHERE volume IS NOT NULL
      GROUP BY ticker, name, sector ORDER BY avg_volume DESC, ticker LIMIT 10""",
    "volume_spikes": _with(PRICES, f"""
      means AS (SELECT *, {_ratio(f'SUM(volume) {_frame(20)}', f'COUNT(volume) {_frame(20)}')} AS vol_ma_20 FROM prices),
      ratios AS (SELECT *, {_round(_ratio('volume', 'vol_ma_20'))} AS vol_ratio FROM means)""")
    + "SELECT date, constituent_id, volume, CAST(close_price AS DOUBLE) AS close, vol_ma_20, vol_ratio FROM ratios WHERE vol_ratio > 2",
    "sector_stats": _with(*_MARKET, RETURNS) + f"""SELECT sector, COUNT(DISTINCT constituent_id) AS num_tickers,
      {_round('AVG(r)', 4)} AS avg_daily_return, {_round('STDDEV_SAMP(r)', 4)} AS avg_volatility,
      {_round(_ratio('SUM(volume)', 'COUNT(volume)'), 0)} AS avg_daily_volume, CAST(SUM(volume) AS DOUBLE) AS total_volume
      FROM returns JOIN constituents ON id = constituent_id GROUP BY sector""",
    "sector_snapshot": _with(*_MARKET) + f"""SELECT sector, COUNT(*) AS ticker_count, {_round(_MEAN_CLOSE)} AS avg_price
      FROM prices JOIN constituents ON id = constituent_id WHERE date = (SELECT MAX(date) FROM prices) GROUP BY sector""",
    "paired_prices": _with(PRICES, PAIRS)
    + "SELECT key_a, key_b, date, CAST(price_a AS DOUBLE) AS price_a, CAST(price_b AS DOUBLE) AS price_b FROM paired",
    "price_correlation": _with(PRICES, PAIRS) + f"""SELECT key_a, key_b, COUNT(*) AS common_days,
      {_round('COVAR_POP(CAST(price_a AS DOUBLE), CAST(price_b AS DOUBLE)) / NULLIF(STDDEV_POP(CAST(price_a AS DOUBLE)) * STDDEV_POP(CAST(price_b AS DOUBLE)), 0)', 4)} AS corr
      FROM paired GROUP BY key_a, key_b""",
    "ohlcv_tail": _with(PRICES) + """SELECT constituent_id, date, CAST(open_price AS DOUBLE) AS open, CAST(high_price AS DOUBLE) AS high,
      CAST(low_price AS DOUBLE) AS low, CAST(close_price AS DOUBLE) AS close, volume
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY constituent_id ORDER BY date DESC) AS back FROM prices) x WHERE back <= 60""",
    "latest_state": _with(*_MARKET) + """SELECT ticker, date, CAST(close_price AS DOUBLE) AS close, volume
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY constituent_id ORDER BY date DESC) AS back FROM prices) x
      JOIN constituents ON id = constituent_id WHERE back = 1""",
    "latest_date_rows": _with(PRICES) + f"SELECT {_BAR} FROM prices WHERE date = (SELECT MAX(date) FROM prices)",
    "format_volume": _with(*_MARKET, """
      means AS (SELECT constituent_id, CAST(TRUNC(SUM(volume * 12345) / COUNT(volume)) AS BIGINT) AS v FROM prices GROUP BY 1)""")
    + """SELECT ticker, v AS avg_volume,
      CASE WHEN v >= 1000000 THEN CAST(((v + 50000) // 100000) // 10 AS VARCHAR) || '.' || CAST(((v + 50000) // 100000) % 10 AS VARCHAR) || 'M'
           WHEN v >= 1000 THEN CAST((v + 500) // 1000 AS VARCHAR) || 'K' ELSE CAST(v AS VARCHAR) END AS volume_label
      FROM means JOIN constituents ON id = constituent_id""",
    "quality_prices": _with(QUOTES, """
      first_pass AS (SELECT *, CASE WHEN close IS NULL THEN 'null_close' WHEN close < 0 THEN 'negative_close' END AS bad FROM quotes),
      ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY constituent_id, date, bad IS NULL
                   ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, px DESC, qty DESC) AS rn FROM first_pass)""")
    + """SELECT constituent_id, date, l_orderkey, l_linenumber, l_partkey, CAST(px AS DOUBLE) AS px, qty, CAST(high AS DOUBLE) AS high,
      CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, COALESCE(bad, CASE WHEN rn > 1 THEN 'duplicate' END) AS issue,
      COALESCE(low > close OR high < close, FALSE) AS ohlc_mismatch FROM ranked""",
    "dedup_last": """SELECT l_suppkey AS constituent_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS px, CAST(l_quantity AS BIGINT) AS qty,
      l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
              ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) x WHERE rn = 1""",
    "ohlc_report": _with(QUOTES) + """SELECT constituent_id, date, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
      l_orderkey, l_linenumber, l_partkey, CAST(px AS DOUBLE) AS px, qty FROM quotes WHERE low > close OR high < close""",
    "unknown_tickers": _with(WEIGHTS) + """SELECT name AS ticker, COUNT(*) AS rows FROM weight_rows
      WHERE name IS NOT NULL AND name NOT IN (SELECT s_name FROM supplier) GROUP BY name""",
    "quality_weights": _with(WEIGHTS, _RULES) + """SELECT file, CAST(rule_order AS BIGINT) AS rule_order, rule, severity, CAST(n AS BIGINT) AS rows,
      COALESCE(rule_order = MIN(CASE WHEN severity = 'error' THEN rule_order END) OVER (PARTITION BY file), FALSE) AS is_first
      FROM rules WHERE n > 0""",
    "trading_calendar": f"""SELECT date FROM (
      SELECT CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT MIN(l_shipdate) AS a, MAX(l_shipdate) AS b FROM lineitem) e) d WHERE {CALENDAR_RULE}""",
    "gap_report": _with(PRICES) + f"""SELECT constituent_id, date FROM (
      SELECT constituent_id, CAST(UNNEST(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT constituent_id, MIN(date) AS a, MAX(date) AS b FROM prices GROUP BY 1) s) d
      WHERE {CALENDAR_RULE} AND NOT EXISTS (SELECT 1 FROM prices p WHERE p.constituent_id = d.constituent_id AND p.date = d.date)""",
    "high_watermark": _with(PRICES) + "SELECT constituent_id, MAX(date) AS wm FROM prices GROUP BY constituent_id",
    "admit_new_rows": _with(TICKS)
    + "SELECT ticker, file, event_id, date, CAST(close AS DOUBLE) AS close FROM validated WHERE issue0 IS NULL",
    "landing_labels": _with(TICKS)
    + "SELECT ticker, date, file, event_id, CAST(close AS DOUBLE) AS close, issue FROM labelled",
    "append_new": _with(TICKS) + """SELECT ticker, date, file, event_id, CAST(close AS DOUBLE) AS close FROM labelled l
      WHERE issue IS NULL AND NOT EXISTS (SELECT 1 FROM loaded t WHERE t.ticker = l.ticker AND t.date = l.date)""",
    "incremental_summary": _with(TICKS, """
      per_file AS (SELECT file, COUNT(*) AS n, COUNT(*) FILTER (WHERE issue IS NULL OR issue IN ('duplicate', 'unknown_ticker')) AS passed,
                          COUNT(*) FILTER (WHERE issue IS NULL) AS inserted,
                          MAX(CASE WHEN issue IS NULL OR issue IN ('duplicate', 'unknown_ticker') THEN date END) AS newest
                   FROM labelled GROUP BY file)""")
    + """SELECT COUNT(*) FILTER (WHERE passed > 0) AS files_processed, COUNT(*) FILTER (WHERE passed = 0) AS files_skipped,
      CAST(SUM(inserted) AS BIGINT) AS rows_inserted, CAST(SUM(n - inserted) AS BIGINT) AS rows_dropped,
      GREATEST(MAX(newest), (SELECT MAX(wm) FROM wms)) AS new_watermark FROM per_file""",
    "upsert_constituents": _with(CONSTITUENTS, """
      incoming AS (
        SELECT 'Supplier#' || LPAD(CAST(c_custkey // 14 AS VARCHAR), 9, '0') AS ticker, c_name, c_mktsegment,
               'nation ' || CAST(c_nationkey AS VARCHAR) AS industry,
               ROW_NUMBER() OVER (PARTITION BY c_custkey // 14 ORDER BY c_custkey DESC) AS rn FROM customer),
      last AS (SELECT * FROM incoming WHERE rn = 1)""")
    + """SELECT c.id, c.ticker, CASE WHEN l.ticker IS NULL THEN c.name ELSE l.c_name END AS name,
      CASE WHEN l.ticker IS NULL THEN c.sector ELSE l.c_mktsegment END AS sector,
      CASE WHEN l.ticker IS NULL THEN c.industry ELSE l.industry END AS industry,
      CASE WHEN l.ticker IS NULL THEN c.market_cap END AS market_cap
      FROM constituents c LEFT JOIN last l USING (ticker)
      UNION ALL
      SELECT (SELECT MAX(id) FROM constituents) + ROW_NUMBER() OVER (ORDER BY l.ticker), l.ticker, l.c_name, l.c_mktsegment, l.industry, NULL
      FROM last l WHERE l.ticker NOT IN (SELECT ticker FROM constituents)""",
    "portfolio_headers": _with(WEIGHTS) + """SELECT file, CAST(CAST(COALESCE(SUM(w), 0) AS DECIMAL(28,8)) AS DOUBLE) AS total_weight, COUNT(*) AS num_constituents
      FROM weighed GROUP BY file""",
    "load_portfolios": _with(WEIGHTS, """
      known AS (SELECT w.*, s_suppkey AS constituent_id FROM weighed w LEFT JOIN supplier ON s_name = name),
      faults AS (
        SELECT file FROM known WHERE weight_text IS NOT NULL AND w IS NULL
        UNION SELECT file FROM known WHERE constituent_id IS NOT NULL AND weight_text IS NULL
        UNION SELECT file FROM known WHERE constituent_id IS NOT NULL GROUP BY file, name HAVING COUNT(*) > 1),
      good AS (SELECT DISTINCT file FROM known WHERE file NOT IN (SELECT file FROM faults) AND file NOT LIKE 'building%'),
      ids AS (SELECT file, ROW_NUMBER() OVER (ORDER BY file) + (SELECT MAX(c_custkey // 1500 * 25 + c_nationkey) + 100 FROM customer WHERE c_mktsegment = 'BUILDING') AS etf_upload_id FROM good)""")
    + """SELECT CAST(etf_upload_id AS BIGINT) AS etf_upload_id, constituent_id, CAST(w AS DOUBLE) AS weight
      FROM known JOIN ids USING (file) WHERE constituent_id IS NOT NULL""",
    "db_stats": _with(*_MARKET, HOLDINGS, UPLOADS) + """SELECT (SELECT COUNT(*) FROM constituents) AS total_constituents,
      (SELECT COUNT(DISTINCT sector) FROM constituents) AS total_sectors, (SELECT COUNT(*) FROM prices) AS total_price_records,
      (SELECT MIN(date) FROM prices) AS earliest_date, (SELECT MAX(date) FROM prices) AS latest_date,
      (SELECT COUNT(DISTINCT date) FROM prices) AS trading_days, (SELECT COUNT(*) FROM uploads) AS total_etf_uploads,
      (SELECT COUNT(*) FROM holdings) AS total_holdings""",
    "profile": _with(PRICES) + """SELECT COUNT(*) AS rows, COUNT(DISTINCT date) AS days, MIN(date) AS first_date, MAX(date) AS last_date,
      COUNT(DISTINCT constituent_id) AS tickers FROM prices""",
    "watermarks": _with(*_MARKET) + """SELECT ticker, sector, MIN(date) AS earliest_date, MAX(date) AS latest_date, COUNT(*) AS record_count
      FROM prices JOIN constituents ON id = constituent_id GROUP BY ticker, sector""",
    "lagging_tickers": _with(*_MARKET) + """SELECT ticker, MAX(date) AS latest_date FROM prices JOIN constituents ON id = constituent_id
      GROUP BY ticker HAVING MAX(date) < (SELECT MAX(date) FROM prices)""",
    "landing_status": _with(FILES) + """SELECT COUNT(*) FILTER (WHERE state = 'pending') AS pending_files,
      COUNT(*) FILTER (WHERE state = 'processed') AS processed_files FROM files""",
    "ingest_status": _with(PRICES, FILES, "latest AS (SELECT constituent_id, MAX(date) AS d FROM prices GROUP BY 1)") + """SELECT
      (SELECT COUNT(*) FROM files WHERE state = 'pending') = 0 AS pipeline_healthy, MAX(date) AS high_watermark, MIN(date) AS min_date,
      COUNT(*) AS total_records, COUNT(DISTINCT constituent_id) AS total_tickers, COUNT(DISTINCT date) AS total_trading_days,
      (SELECT COUNT(*) FROM files WHERE state = 'pending') AS pending_files, (SELECT COUNT(*) FROM files WHERE state = 'processed') AS processed_files,
      (SELECT COUNT(*) FROM latest WHERE d < (SELECT MAX(date) FROM prices)) AS lagging_tickers,
      'Data is current through ' || CAST(MAX(date) AS VARCHAR) || '.' AS freshness_note FROM prices""",
    "rows_by_version": _with(PRICES, "months AS (SELECT *, month(date) % 3 AS third FROM prices)") + """SELECT CAST(v AS BIGINT) AS version, COUNT(*) AS rows,
      MIN(date) AS first_date, MAX(date) AS last_date
      FROM months, (SELECT unnest([1, 2, 3, 4]) AS v)
      WHERE third = 0 OR (third = 1 AND (v >= 3 OR (v = 2 AND day(date) <= 10))) OR (third = 2 AND v = 4) GROUP BY v""",
    "rows_by_load": _with(PRICES) + """SELECT 'p' || CAST(month(date) % 3 AS VARCHAR) AS load_id, COUNT(*) AS rows, CAST(SUM(volume) AS BIGINT) AS volume
      FROM prices GROUP BY month(date) % 3""",
    "possibly_stored": _with(PRICES, "old AS (SELECT constituent_id, MIN(date) AS first, MAX(date) AS last FROM prices "
                             "WHERE month(date) % 3 = 0 OR (month(date) % 3 = 1 AND day(date) <= 10) GROUP BY constituent_id)") + """SELECT constituent_id,
      CAST(date + 7 AS DATE) AS date FROM prices JOIN old USING (constituent_id) WHERE date + 7 BETWEEN first AND last""",
}
# The same answers from kept summaries, packed series, backward reads and changes.
ORACLE |= {f"kept_{name}": ORACLE[name] for name in ("watermarks", "lagging_tickers", "latest_state", "ingest_status")}
ORACLE |= {kept: ORACLE[plain] for kept, plain in (
    ("packed_correlation", "price_correlation"), ("newest_candles", "ohlcv_tail"), ("maintained_averages", "moving_average"),
    ("maintained_series", "etf_series"))}
