"""DuckDB SQL of the same results, built independently: recursion where Spark scans, ASOF JOIN where it sweeps."""

from __future__ import annotations

BARS = """
px AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS p, count(*) AS v
       FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY ALL),
wx AS (SELECT symbol, d, CAST(v AS DOUBLE) AS volume,
              100e0 * exp(0.05e0 * sum(p / m - 1) OVER (PARTITION BY symbol ORDER BY d)) AS close
       FROM (SELECT *, avg(p) OVER (PARTITION BY symbol) AS m FROM px)),
ox AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY d), close) AS open FROM wx),
bars AS (SELECT symbol, d, open, greatest(open, close) * 1.01e0 AS high, least(open, close) * 0.99e0 AS low, close, volume FROM ox)"""
WEEKS = """
weeks AS (SELECT symbol, CAST(date_trunc('week', d) AS DATE) AS week_start, arg_min(open, d) AS open, max(high) AS high, min(low) AS low,
                 arg_max(close, d) AS close, sum(volume) AS volume FROM bars GROUP BY ALL)"""
ACTIONS = """
actions AS (SELECT symbol, d, close,
    CASE WHEN d = min(d) OVER (PARTITION BY symbol, date_trunc('month', d)) AND
              ((symbol = '2-HIGH' AND date_trunc('month', d) = DATE '1997-06-01') OR (symbol = '3-MEDIUM' AND date_trunc('month', d) = DATE '1999-03-01'))
         THEN 2e0 WHEN day(d) = 13 THEN NULL ELSE 1e0 END AS split_factor,
    CASE WHEN d = min(d) OVER (PARTITION BY symbol, date_trunc('quarter', d)) THEN 0.5e0 ELSE 0e0 END AS div_cash FROM bars),
factors AS (SELECT a.*, coalesce((SELECT exp(sum(ln(s.split_factor))) FROM actions s
            WHERE s.symbol = a.symbol AND s.d > a.d AND s.split_factor IS NOT NULL AND s.split_factor <> 1), 1e0) AS adjust FROM actions a)"""
SERIES = """
sx AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice) / 1000 AS dollar, avg(l_tax) * 100 AS vix, avg(l_discount) * 100 AS ten,
              avg(l_quantity) / 5 AS two, (avg(l_discount) + avg(l_tax)) * 50 AS funds, CAST(count(*) AS DOUBLE) AS addresses, sum(l_quantity) AS transactions
       FROM lineitem WHERE dayofweek(CAST(l_shipdate AS DATE)) BETWEEN 1 AND 5 GROUP BY 1),
series AS (SELECT *, 15000000e0 + 10 * sum(addresses) OVER (ORDER BY d) AS supply FROM sx)"""
VINTAGES = """
vx AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS obs, greatest(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS rs, sum(l_quantity) AS q
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
vintages AS (SELECT obs, rs, coalesce(lead(rs) OVER w - 1, DATE '9999-12-31') AS re, sum(q) OVER w AS value FROM vx WINDOW w AS (PARTITION BY obs ORDER BY rs))"""
INTEREST = """
ix AS (SELECT o_orderpriority AS term, CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL),
iw AS (SELECT term, d, n, DATE '1995-01-02' + CAST(k * 420 AS INTEGER) AS window_start FROM ix,
       (SELECT unnest(generate_series(0, 40)) AS k) WHERE (d - DATE '1995-01-02') // 7 >= k * 60 AND (d - DATE '1995-01-02') // 7 < k * 60 + 80
       UNION ALL SELECT term, d, n, DATE '1995-01-02' FROM ix WHERE d < DATE '1995-01-02'),
interest AS (SELECT term, window_start, d, CAST(round_even(100e0 * n / max(n) OVER (PARTITION BY term, window_start), 0) AS BIGINT) AS interest FROM iw)"""


def rsi_cte(name: str, source: str, order: str, period: int = 14) -> str:
    """Wilder's recursion row by row."""
    k = period
    return f"""
{name}_n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) - 1 AS i,
             greatest(close - lag(close) OVER (PARTITION BY symbol ORDER BY {order}), 0e0) AS up,
             greatest(lag(close) OVER (PARTITION BY symbol ORDER BY {order}) - close, 0e0) AS down FROM {source}),
{name}_r AS (SELECT symbol, i, 0e0 AS g, 0e0 AS l FROM {name}_n WHERE i = 0
             UNION ALL SELECT n.symbol, n.i, (r.g * {k - 1} + n.up) / {k}, (r.l * {k - 1} + n.down) / {k}
             FROM {name}_r r JOIN {name}_n n ON n.symbol = r.symbol AND n.i = r.i + 1),
{name} AS (SELECT n.symbol, n.{order}, n.close, n.i, r.g AS avg_gain, r.l AS avg_loss,
           CASE WHEN n.i < {k} THEN NULL WHEN r.g = 0 AND r.l = 0 THEN 0e0 WHEN r.l = 0 THEN 100e0 ELSE 100e0 * (1 - 1 / (1 + r.g / r.l)) END AS rsi
           FROM {name}_n n JOIN {name}_r r ON r.symbol = n.symbol AND r.i = n.i)"""


def trend_cte(start: float = 40, end: float = 70) -> str:
    """The latch, as a recursion."""
    return f"""
tn AS (SELECT symbol, week_start, rsi, row_number() OVER (PARTITION BY symbol ORDER BY week_start) - 1 AS k FROM weekly_rsi WHERE rsi IS NOT NULL),
tr AS (SELECT symbol, k, week_start, rsi, FALSE AS in_trend FROM tn WHERE k = 0
       UNION ALL SELECT n.symbol, n.k, n.week_start, n.rsi, CASE WHEN r.rsi <= {start} THEN TRUE WHEN r.rsi >= {end} THEN FALSE ELSE r.in_trend END
       FROM tr r JOIN tn n ON n.symbol = r.symbol AND n.k = r.k + 1)"""


DAILY_RSI = rsi_cte("daily_rsi", "bars", "d")
WEEKLY_RSI = rsi_cte("weekly_rsi", "weeks", "week_start")

RETURNS = """
dw AS (SELECT symbol, CAST(date_trunc('week', d) AS DATE) AS week_start, sum(div_cash / adjust) AS div_adj FROM factors WHERE div_cash > 0 GROUP BY ALL),
rx AS (SELECT w.symbol, w.week_start, w.close, coalesce(dw.div_adj, 0e0) AS div_adj, lag(w.close) OVER (PARTITION BY w.symbol ORDER BY w.week_start) AS prev,
              row_number() OVER (PARTITION BY w.symbol ORDER BY w.week_start) - 1 AS i
       FROM weeks w LEFT JOIN dw ON dw.symbol = w.symbol AND dw.week_start = w.week_start),
rz AS (SELECT rx.*, s.funds AS annual_pct, ln((close + div_adj) / prev) AS log_return FROM rx ASOF LEFT JOIN series s ON rx.week_start >= s.d),
returns AS (SELECT symbol, week_start, close, div_adj, close / prev - 1 AS price_simple_return, ln(close / prev) AS price_log_return,
              (close + div_adj) / prev - 1 AS simple_return, log_return, annual_pct, pow(1 + annual_pct / 100, 7e0 / 365) - 1 AS rf_week,
              (close + div_adj) / prev - 1 - (pow(1 + annual_pct / 100, 7e0 / 365) - 1) AS excess_return,
              log_return - ln(pow(1 + annual_pct / 100, 7e0 / 365)) AS excess_log_return,
              CASE WHEN i >= 26 THEN stddev_samp(log_return) OVER (PARTITION BY symbol ORDER BY week_start ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) * sqrt(52e0) END AS realized_vol_26w
            FROM rz)"""

MOMENTUM = """
mx AS (SELECT *, count(*) OVER w AS n, sum(excess_log_return) OVER w AS s FROM returns WHERE excess_log_return IS NOT NULL
       WINDOW w AS (PARTITION BY symbol ORDER BY week_start ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)),
momentum AS (SELECT symbol, week_start, s AS formation, CAST(sign(s) AS INTEGER) AS signal, realized_vol_26w,
                    CASE WHEN s = 0 THEN 0e0 WHEN realized_vol_26w > 0 THEN sign(s) * 0.1e0 / realized_vol_26w END AS position FROM mx WHERE n = 52)"""

WEIGHTS = """
bx AS (SELECT m.*, b.include_capped, m.symbol = '1-URGENT' AS is_capped FROM momentum m, (VALUES (TRUE), (FALSE)) b(include_capped)
       WHERE (b.include_capped OR m.symbol <> '1-URGENT') AND m.signal <> 0 AND m.realized_vol_26w > 0),
bw AS (SELECT *, signal / realized_vol_26w / sum(1 / realized_vol_26w) OVER (PARTITION BY week_start, include_capped) AS w FROM bx),
bc AS (SELECT *, sum(CASE WHEN is_capped THEN greatest(abs(w) - 0.2e0, 0) ELSE 0e0 END) OVER (PARTITION BY week_start, include_capped) AS freed,
              sum(CASE WHEN is_capped THEN 0e0 ELSE abs(w) END) OVER (PARTITION BY week_start, include_capped) AS other FROM bw),
weights AS (SELECT symbol, week_start, include_capped,
                   CASE WHEN is_capped THEN sign(w) * least(abs(w), 0.2e0) WHEN other > 0 THEN w * (1 + freed / other) ELSE w END AS weight FROM bc)"""


def query(select: str, *ctes: str) -> str:
    return ("WITH RECURSIVE " + ",".join(ctes) + "\n" if ctes else "") + select


def r(x: str, name: str | None = None) -> str:
    """Rounded to six decimals, without a negative zero."""
    return f"round({x}, 6) + 0e0 AS {name or x}"
