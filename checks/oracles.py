"""The registered queries once more as SQL over the same tables.

Written with one plain window per ticker, without chunks, carried values or
folds, so that it shares no technique with the Spark side.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def rnd(expr: str, places: int = 2) -> str:
    """Half up on the number as written: through its text, as a decimal."""
    return f"(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {places})::DOUBLE + 0.0::DOUBLE)"


def q(text: str) -> str:
    """`A AS b` lists are easier to read without quotes: quote the cased names here."""
    for name in ("Date", "Open", "High", "Low", "Close", "Volume"):
        text = text.replace(f"[{name}]", f'"{name}"')
    return text


H = q("""h AS (
  SELECT event_type AS ticker, date_trunc('hour', ts) AS [Date],
         arg_min(value, ts) AS [Open], max(value) AS [High], min(value) AS [Low],
         arg_max(value, ts) AS [Close], count(*) AS [Volume]
  FROM events GROUP BY 1, 2)""")

K = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
DB = q(f"""db AS (
  SELECT p_brand AS ticker, l_shipdate AS [Date],
         arg_min(l_extendedprice, {K}) AS [Open], max(l_extendedprice) AS [High],
         min(l_extendedprice) AS [Low], arg_max(l_extendedprice, {K}) AS [Close],
         CAST(sum(l_quantity) AS BIGINT) AS [Volume],
         arg_max(l_discount, {K}) AS dividend_yield
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""")

H3 = H + q(""", h3 AS (SELECT ticker, [Date], round(3000 + [Close], 2) AS [Close] FROM h)""")

FUND = """fund AS (
  SELECT ticker, ticker AS company_name, sector,
         CASE WHEN n % 5 <> 0 THEN round(size, 4) END AS per,
         CASE WHEN n % 7 <> 0 THEN round(price / 1000, 4) END AS pbr,
         CASE WHEN n % 3 <> 0 THEN round(size / 100, 4) END AS roe,
         CAST(round(total * 100) AS BIGINT) AS market_cap,
         CAST((n * 7) % 101 AS DOUBLE) AS fundamental_score
  FROM (SELECT p_brand AS ticker, min(p_type) AS sector, avg(p_size) AS size,
               avg(p_retailprice) AS price, sum(p_retailprice) AS total,
               CAST(split_part(p_brand, '#', 2) AS INT) AS n
        FROM part GROUP BY p_brand))"""

TIER = """CASE WHEN {0} >= 0.04 THEN '高配当(4%+)' WHEN {0} >= 0.02 THEN '中配当(2-4%)'
 WHEN {0} > 0 THEN '低配当(<2%)' ELSE '無配当' END"""


def frame(n: int) -> str:
    return q(f"(PARTITION BY ticker ORDER BY [Date] ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")


W = q("(PARTITION BY ticker ORDER BY [Date])")


CENTS = q("CAST(round([Close] * 100) AS BIGINT) AS m")  # the test prices have two places


def mean(n: int, full: bool = False, places: int | None = 2) -> str:
    """Mean of the whole cents `m` over the last n rows; two places by whole numbers only."""
    total, rows = f"sum(m) OVER {frame(n)}", f"count(m) OVER {frame(n)}"
    if places == 2:
        value = f"((2 * {total} + {rows}) // (2 * {rows}))::DOUBLE / 100.0::DOUBLE"
    else:
        value = f"{total}::DOUBLE / 100.0::DOUBLE / {rows}"
        value = value if places is None else rnd(value, places)
    return f"CASE WHEN {rows} >= {n if full else 1} THEN {value} END"


def chain(source: str, sma=(5, 20, 50, 200), cross=(20, 50), full=False, band_round=True,
          floor: float | None = 0.001, rounded=True, keep="", rsi_bars=14, band_bars=20) -> str:
    """CTEs `ind` (indicators) over bars `source`."""
    show = rnd if rounded else (lambda e, p=2: f"({e})")
    means = sorted({*sma, *cross, band_bars})
    smas = ", ".join(f"{mean(n, full, 2 if rounded else None)} AS s{n}" for n in means)
    a, b = cross
    f14, bands = frame(rsi_bars), frame(band_bars)
    if floor is None:
        rsi = ("CASE WHEN l14 = 0 AND g14 > 0 THEN 100.0::DOUBLE "
               "ELSE 100 - 100 / (1 + (g14 / 100.0::DOUBLE) / nullif(l14 / 100.0::DOUBLE, 0)) END")
    else:
        rsi = (f"100 - 100 / (1 + (g14 / 100.0::DOUBLE / n14) / "
               f"(CASE WHEN l14 = 0 THEN {floor}::DOUBLE ELSE l14 / 100.0::DOUBLE / n14 END))")
    rsi = show(rsi)
    if full:
        rsi = f"CASE WHEN n14 = {rsi_bars} THEN {rsi} END"
    std = f"CASE WHEN n20 >= {band_bars if full else 1} THEN sd END"
    if band_round:
        std = rnd(std)
    return q(f"""m0 AS (SELECT *, {CENTS} FROM {source}),
m1 AS (SELECT *, m - lag(m) OVER {W} AS d, lag([Close]) OVER {W} AS pc FROM m0),
m2 AS (SELECT *, {smas},
  sum(CASE WHEN d > 0 THEN d ELSE 0 END) OVER {f14} AS g14,
  sum(CASE WHEN d < 0 THEN -d ELSE 0 END) OVER {f14} AS l14,
  count(*) OVER {f14} AS n14, count(m) OVER {bands} AS n20,
  stddev_samp([Close]) OVER {bands} AS sd FROM m1),
m3 AS (SELECT *, lag(s{a}) OVER {W} AS pa, lag(s{b}) OVER {W} AS pb, {std} AS bsd FROM m2),
ind AS (SELECT ticker, [Date], [Close], {keep}
  {", ".join(f"s{n} AS sma_{n}" for n in sma)},
  coalesce(s{a} > s{b} AND pa <= pb, false) AS golden_cross,
  coalesce(s{a} < s{b} AND pa >= pb, false) AS dead_cross,
  {rsi} AS rsi_{rsi_bars},
  {show(f"s{band_bars} + 2 * bsd")} AS bb_upper, {show(f"s{band_bars} - 2 * bsd")} AS bb_lower,
  {show("([Close] - pc) * 100 / nullif(pc, 0)")} AS daily_return_pct FROM m3)""")


DECISION = q("""CASE WHEN golden_cross THEN 'BUY' WHEN dead_cross THEN 'SELL'
 WHEN rsi_14 < 30 THEN 'OVERSOLD' WHEN rsi_14 > 70 THEN 'OVERBOUGHT'
 WHEN [Close] < bb_lower THEN 'BUY_BB' WHEN [Close] > bb_upper THEN 'SELL_BB' ELSE 'HOLD' END""")
STRENGTH = """CASE WHEN decision IN ('BUY', 'SELL') THEN 8
 WHEN decision IN ('OVERSOLD', 'OVERBOUGHT') THEN 7
 WHEN decision IN ('BUY_BB', 'SELL_BB') THEN 6 ELSE 3 END"""
OHLV = '"Open", "High", "Low", "Volume",'
DEC = f"dec AS (SELECT *, {DECISION} AS decision FROM ind), dst AS (SELECT *, {STRENGTH} AS decision_strength FROM dec)"


def oracle(name: str, text: str) -> None:
    ORACLES[name] = q(text)


# Bars and sources

oracle("bars_hourly", f"WITH {H} SELECT * FROM h")
oracle("bars_daily", f"WITH {DB} SELECT * FROM db")
oracle("trailing_period", f"""WITH {DB} SELECT ticker, [Date], [Close] FROM db
 WHERE [Date] >= (SELECT max([Date]) FROM db) - INTERVAL 730 DAY""")
oracle("ticker_universe", f"WITH {H} SELECT * FROM h WHERE ticker IN ('click', 'purchase')")
oracle("ticker_universe_table", f"""WITH {DB}, {FUND} SELECT ticker, [Date], [Close] FROM db
 WHERE ticker IN (SELECT ticker FROM fund WHERE fundamental_score >= 50)""")
oracle("missing_tickers", """SELECT doc_id AS ticker FROM documents
 WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
oracle("dedup_bars", """SELECT event_type AS ticker, date_trunc('hour', ts) AS [Date], ts, event_id, value
 FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts) = 1""")
oracle("union_sources", f"""WITH {H}, {DB} SELECT ticker, [Date], [Close], [Volume], NULL::DOUBLE AS dividend_yield FROM h
 UNION ALL SELECT ticker, [Date], [Close], NULL::BIGINT, dividend_yield FROM db""")
oracle("fundamental_defaults", f"""WITH {FUND} SELECT ticker, coalesce(per, 0.0::DOUBLE) AS pe_ratio,
 coalesce(roe, 0.0::DOUBLE) AS dividend_yield, CASE WHEN pbr IS NOT NULL THEN sector ELSE 'Unknown' END AS sector,
 0.0::DOUBLE AS market_cap, ticker AS company_name FROM fund""")
oracle("describe_tickers", f"""WITH {DB}, {FUND} SELECT db.ticker, db.[Date], db.[Close],
 CASE WHEN per IS NOT NULL THEN lower(db.ticker) ELSE db.ticker END AS company_name,
 CASE WHEN per IS NOT NULL THEN sector ELSE 'Unknown' END AS sector
 FROM db LEFT JOIN fund ON db.ticker = fund.ticker""")

# Indicators

M = "m0 AS (SELECT *, " + CENTS + " FROM {0})"


def averages(source: str, periods, full=False, places: int | None = 2) -> str:
    columns = ", ".join(f"{mean(n, full, places)} AS sma_{n}" for n in periods)
    return f"{M.format(source)} SELECT ticker, [Date], [Close], {columns} FROM m0"


oracle("sma_partial", f"WITH {H}, {averages('h', (5, 20, 50, 200))}")
oracle("sma_full", f"WITH {DB}, {averages('db', (5, 25, 75), full=True)}")
oracle("sma_unrounded", f"WITH {H}, {averages('h', (20, 50), full=True, places=6)}")
PART = chain("h")
FULL = chain("h", full=True, band_round=False)
oracle("cross_signals", f"WITH {H}, {PART} SELECT ticker, [Date], sma_20, sma_50, golden_cross, dead_cross FROM ind")
oracle("cross_signals_full", f"WITH {H}, {FULL} SELECT ticker, [Date], golden_cross, dead_cross FROM ind")
oracle("cross_fallback", f"""WITH {H}, {M.format('h')}, a AS (
 SELECT ticker, [Date], [Close], {mean(25)} AS sma_25, {mean(75)} AS sma_75 FROM m0),
 b AS (SELECT *, lag(sma_25) OVER {W} AS pa, lag(sma_75) OVER {W} AS pb FROM a)
 SELECT ticker, [Date], [Close], sma_25, sma_75,
 CASE WHEN sma_25 > sma_75 AND pa <= pb THEN 'BUY' ELSE 'HOLD' END AS decision,
 0.5::DOUBLE AS confidence FROM b""")
oracle("rsi_partial", f"WITH {H}, {PART} SELECT ticker, [Date], rsi_14 FROM ind")
oracle("rsi_full", f"WITH {H}, {FULL} SELECT ticker, [Date], rsi_14 FROM ind")
UNG = chain("h", full=True, band_round=False, floor=None, rounded=False)
oracle("rsi_unguarded", f"WITH {H}, {UNG} SELECT ticker, [Date], {rnd('rsi_14', 6)} AS rsi_14 FROM ind")
oracle("bollinger_partial", f"WITH {H}, {PART} SELECT ticker, [Date], bb_upper, bb_lower FROM ind")
oracle("bollinger_full", f"WITH {H}, {FULL} SELECT ticker, [Date], bb_upper, bb_lower FROM ind")
OTHER = chain("h", sma=(3, 10), cross=(3, 10), full=True, band_round=False, rsi_bars=7, band_bars=12)
oracle("other_periods", f"""WITH {H}, {OTHER}
 SELECT ticker, [Date], sma_3, sma_10, golden_cross, dead_cross, rsi_7, bb_upper, bb_lower FROM ind""")
oracle("daily_returns", f"WITH {H}, {PART} SELECT ticker, [Date], daily_return_pct FROM ind")
oracle("returns", f"""WITH {DB} SELECT ticker, [Date], """ + ", ".join(
    rnd(f"[Close] / nullif(lag([Close], {k}) OVER {W}, 0) - 1", 6) + f" AS return_{k}" for k in (1, 5, 20)) + " FROM db")
oracle("forward_label", f"""WITH {DB} SELECT ticker, [Date], [Close],
 CAST(lead([Close], 20) OVER {W} / nullif([Close], 0) - 1 >= 0.03 AS INT) AS label FROM db""")

# Decisions

oracle("dividend_tiers", f"""SELECT l_discount, {TIER.format('l_discount')} AS dividend_category, count(*) AS n
 FROM lineitem GROUP BY 1, 2""")
oracle("dividend_tier_last", f"""WITH {DB}, l AS (SELECT ticker, arg_max(dividend_yield, [Date]) AS y FROM db GROUP BY 1)
 SELECT db.ticker, [Date], dividend_yield, {TIER.format('y')} AS dividend_category FROM db JOIN l ON db.ticker = l.ticker""")
oracle("evaluated_bars", f"WITH {H}, {chain('h', keep=OHLV)}, {DEC} SELECT * FROM dst")
oracle("evaluated_bars_full", f"""WITH {DB}, {chain('db', full=True, band_round=False, keep=OHLV + ' dividend_yield,')}, {DEC}
 SELECT *, {TIER.format('dividend_yield')} AS dividend_category FROM dst""")
oracle("decision_distribution", f"WITH {H}, {PART}, {DEC} SELECT decision, count(*) AS count FROM dst GROUP BY 1")
oracle("latest_signals_top20", f"""WITH {H}, {PART}, {DEC} SELECT ticker, [Date], [Close], sma_20, sma_50, rsi_14, decision, decision_strength
 FROM dst ORDER BY [Date] DESC, ticker LIMIT 20""")

# Snapshots and reports

LAST = q("QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY [Date] DESC) = 1")
oracle("latest_snapshot", f"WITH {H}, {chain('h', keep=OHLV)}, {DEC} SELECT * FROM dst {LAST}")
oracle("serving_table", f"""WITH {H}, {PART}, {DEC}
 SELECT ticker, [Date], [Close], decision, decision_strength, 1 AS n FROM dst {LAST}""")
oracle("latest_bars", f"WITH {DB} SELECT * FROM db {LAST}")
oracle("ticker_history", f"WITH {H} SELECT * FROM h WHERE ticker = 'purchase' ORDER BY [Date]")
oracle("newest_three", f"WITH {H} SELECT * FROM h ORDER BY [Date] DESC, ticker LIMIT 3")
oracle("serving_view", f"""WITH {DB}, {FUND}, {chain('db')}, {DEC}, latest AS (SELECT * FROM dst {LAST})
 SELECT row_number() OVER (ORDER BY l.ticker) AS id, l.ticker, company_name AS "companyName",
 CAST(l.[Date] AS DATE) AS "decisionDate", decision AS "decisionType", 0.5::DOUBLE AS confidence,
 CAST(l.[Close] AS DECIMAL(18, 2)) AS "closePrice", rsi_14 AS rsi14, fundamental_score AS "fundamentalScore"
 FROM latest l JOIN fund ON l.ticker = fund.ticker""")
oracle("dividend_ranking", f"""WITH {DB}, latest AS (SELECT ticker, dividend_yield FROM db {LAST})
 SELECT ticker, dividend_yield, CAST(dense_rank() OVER (ORDER BY dividend_yield DESC) AS INT) AS dividend_rank FROM latest""")
oracle("quality_report", f"""WITH {DB}, {FUND} SELECT db.ticker, company_name, sector, count(*) AS row_count,
 min([Date]) AS first_date, max([Date]) AS last_date,
 ((2 * sum(CAST(round([Close] * 100) AS BIGINT)) + count([Close])) // (2 * count([Close])))::DOUBLE / 100.0::DOUBLE AS avg_close,
 {rnd('max(dividend_yield) * 100')} AS div_yield_pct
 FROM db JOIN fund ON db.ticker = fund.ticker GROUP BY 1, 2, 3 ORDER BY 1""")
oracle("export_summary", f"""WITH {DB} SELECT count(*) AS row_count, count(DISTINCT ticker) AS ticker_count,
 min([Date]) AS first_date, max([Date]) AS last_date FROM db""")
oracle("ticker_spans", f"""WITH {H} SELECT ticker, count(*) AS rows, min([Date]) AS start_date, max([Date]) AS end_date,
 ticker || '_T' AS safe_ticker FROM h GROUP BY 1""")
oracle("safe_values", f"""WITH {FUND} SELECT ticker,
 CASE WHEN per IS NULL THEN 0.0::DOUBLE ELSE {rnd('per')} END AS per,
 CASE WHEN pbr IS NULL THEN 0.0::DOUBLE ELSE {rnd('pbr')} END AS pbr,
 {rnd('least(greatest(coalesce(roe, 0.1), 0), 0.25)', 4)} AS roe,
 CASE WHEN per IS NOT NULL THEN sector ELSE 'Unknown' END AS sector FROM fund""")

# Positions: one recursive step per bar


def fold(holding: int) -> str:
    leave = f"(f.ep IS NOT NULL AND (f.h + 1 >= {holding} OR (b.decision = 'HOLD' AND f.h + 1 >= 3)))"
    free = f"({leave} OR f.ep IS NULL)"
    return f"""{H3},
sig AS (SELECT *, CASE WHEN [Close] < lag([Close]) OVER {W} THEN 'BUY' ELSE 'HOLD' END AS decision FROM h3),
b AS (SELECT *, row_number() OVER {W} AS i, count(*) OVER (PARTITION BY ticker) AS n FROM sig),
f AS (
  SELECT ticker, i, n, [Date], [Close], decision, 1e6::DOUBLE AS cap,
         CASE WHEN decision = 'BUY' THEN [Close] END AS ep,
         CASE WHEN decision = 'BUY' THEN [Date] END AS ed, 0::BIGINT AS h,
         NULL::DOUBLE AS xp, NULL::TIMESTAMP AS xd, NULL::BIGINT AS xh, NULL::DOUBLE AS xcap
  FROM b WHERE i = 1
  UNION ALL
  SELECT b.ticker, b.i, b.n, b.[Date], b.[Close], b.decision,
         CASE WHEN {leave} THEN f.cap * (b.[Close] / f.ep) - f.cap * 0.001::DOUBLE ELSE f.cap END,
         CASE WHEN {free} THEN CASE WHEN b.decision = 'BUY' THEN b.[Close] END ELSE f.ep END,
         CASE WHEN {free} THEN CASE WHEN b.decision = 'BUY' THEN b.[Date] END ELSE f.ed END,
         CASE WHEN {free} THEN 0 ELSE f.h + 1 END,
         CASE WHEN {leave} THEN f.ep END, CASE WHEN {leave} THEN f.ed END,
         CASE WHEN {leave} THEN f.h + 1 END, CASE WHEN {leave} THEN f.cap END
  FROM f JOIN b ON b.ticker = f.ticker AND b.i = f.i + 1),
tr AS (
  SELECT ticker, xd AS entry_date, xp AS entry_price, [Date] AS exit_date, [Close] AS exit_price,
         xh AS holding_days, ([Close] - xp) * (xcap / xp) AS pnl, ([Close] - xp) / xp * 100 AS pnl_pct,
         CASE WHEN xh >= {holding} THEN 'holding_period' ELSE 'decision_change' END AS exit_reason
  FROM f WHERE xp IS NOT NULL
  UNION ALL
  SELECT ticker, ed, ep, [Date], [Close], h, 0.0, ([Close] - ep) / ep * 100, 'end_of_data'
  FROM f WHERE i = n AND ep IS NOT NULL),
val AS (SELECT *, CASE WHEN ep IS NULL THEN cap ELSE cap * ([Close] / ep) END AS v FROM f),
eq AS (SELECT *, {rnd('v')} AS pv FROM val),
dd AS (SELECT *, max(pv) OVER (PARTITION BY ticker ORDER BY i) AS peak,
       pv / lag(pv) OVER (PARTITION BY ticker ORDER BY i) - 1 AS r FROM eq),
dr AS (SELECT *, (pv - peak) / peak AS d FROM dd),
runs AS (SELECT *, i - max(CASE WHEN d >= 0 THEN i END) OVER (PARTITION BY ticker ORDER BY i) AS run FROM dr)"""


TRADES = f"""SELECT ticker, entry_date, entry_price, exit_date, exit_price, holding_days,
 {rnd('pnl')} AS pnl, {rnd('pnl_pct', 4)} AS pnl_pct, exit_reason FROM tr"""
oracle("position_trades", f"WITH RECURSIVE {fold(20)} {TRADES}")
oracle("position_trades_hold5", f"WITH RECURSIVE {fold(5)} {TRADES}")
oracle("equity_curve", f"""WITH RECURSIVE {fold(5)} SELECT ticker, [Date] AS date, pv AS portfolio_value, [Close] AS close,
 decision, ep IS NOT NULL AS in_position FROM eq""")
oracle("drawdown_runs", f"""WITH RECURSIVE {fold(5)} SELECT ticker, [Date] AS date, pv AS portfolio_value, peak,
 {rnd('d', 6)} AS drawdown, run AS drawdown_run FROM runs""")
METRICS = f""", e AS (SELECT ticker, strftime(min([Date]), '%Y-%m-%d') AS start_date,
  strftime(max([Date]), '%Y-%m-%d') AS end_date, arg_max(v, i) AS fin, count(*) AS n,
  avg(r) AS mr, stddev_samp(r) AS sr, count(r) AS nr, abs(min(d)) * 100 AS mdd, max(run) AS longest
  FROM runs GROUP BY ticker),
t AS (SELECT ticker, count(*) AS total, count(*) FILTER (pnl_pct > 0) AS wins,
  count(*) FILTER (pnl_pct <= 0) AS losses, sum(pnl_pct) FILTER (pnl_pct > 0) AS gained,
  sum(pnl_pct) FILTER (pnl_pct <= 0) AS given, avg(holding_days) AS held FROM tr GROUP BY ticker)
SELECT e.ticker, start_date, end_date, 1e6::DOUBLE AS initial_capital, {rnd('fin')} AS final_capital,
 {rnd('(fin / 1e6 - 1) * 100')} AS total_return_pct,
 {rnd('(pow(fin / 1e6, 1 / greatest(n / 252.0::DOUBLE, 0.01)) - 1) * 100')} AS annualized_return_pct,
 CASE WHEN nr > 1 AND sr > 0 THEN {rnd('mr / sr * sqrt(252.0::DOUBLE)', 3)} ELSE 0.0 END AS sharpe_ratio,
 {rnd('mdd')} AS max_drawdown_pct, longest AS max_drawdown_duration_days,
 coalesce(total, 0) AS total_trades, coalesce(wins, 0) AS winning_trades, coalesce(losses, 0) AS losing_trades,
 {rnd('coalesce(wins, 0) * 100.0 / greatest(coalesce(total, 0), 1)', 1)} AS win_rate_pct,
 {rnd('coalesce(gained / nullif(wins, 0), 0.0)')} AS avg_win_pct, {rnd('coalesce(given / nullif(losses, 0), 0.0)')} AS avg_loss_pct,
 {rnd('coalesce(gained, 0) / nullif(CASE WHEN losses > 0 THEN abs(given) ELSE 0.001 END, 0)')} AS profit_factor,
 {rnd('coalesce(held, 0.0)', 1)} AS avg_holding_days
FROM e LEFT JOIN t ON e.ticker = t.ticker"""
oracle("backtest_metrics", f"WITH RECURSIVE {fold(20)}{METRICS}")
oracle("backtest_metrics_hold5", f"WITH RECURSIVE {fold(5)}{METRICS}")

# Strategies

GRID = {
    "RSI(50)": "rsi < 50",
    "RSI(40)": "rsi < 40",
    "SMA_Cross(20,50)": "f20 > f50",
    "SMA_Cross(5,20)": "f5 > f20",
    "Hold": None,
}


def whole_mean(n: int) -> str:
    """Mean over n full rows times 10,000, so that means compare as whole numbers."""
    return f"CASE WHEN count(m) OVER {frame(n)} = {n} THEN sum(m) OVER {frame(n)} * {100 // n} END"


def strategy_rows(names, source: str = "h3") -> str:
    parts = []
    for name in names:
        rule = GRID[name]
        position = "1" if rule is None else f"coalesce(lag(CAST(coalesce({rule}, false) AS INT)) OVER {W}, 0)"
        parts.append(f"SELECT ticker, [Date], dr, '{name}' AS strategy, {position} AS position FROM sg")
    f14 = frame(14)
    return f"""sm0 AS (SELECT *, {CENTS} FROM {source}),
sm1 AS (SELECT *, m - lag(m) OVER {W} AS d, [Close] / nullif(lag([Close]) OVER {W}, 0) - 1 AS dr FROM sm0),
sm2 AS (SELECT *, sum(greatest(coalesce(d, 0), 0)) OVER {f14} AS g, sum(greatest(coalesce(-d, 0), 0)) OVER {f14} AS l,
  count(*) OVER {f14} AS c, {whole_mean(5)} AS f5, {whole_mean(20)} AS f20, {whole_mean(50)} AS f50 FROM sm1),
sg AS (SELECT *, CASE WHEN c < 14 THEN NULL WHEN l = 0 AND g > 0 THEN 100
  ELSE 100 - 100 / (1 + (g / 100.0::DOUBLE) / nullif(l / 100.0::DOUBLE, 0)) END AS rsi FROM sm2),
st AS (SELECT *, dr * position AS sr FROM ({" UNION ALL ".join(parts)}) WHERE dr IS NOT NULL),
cu AS (SELECT *, product(1 + sr) OVER (PARTITION BY ticker, strategy ORDER BY [Date]) AS cumulative,
  product(1 + dr) OVER (PARTITION BY ticker, strategy ORDER BY [Date]) AS base_cumulative FROM st)"""


def curve_of(name: str) -> str:
    return f"""WITH {H3}, {strategy_rows([name])} SELECT ticker, strategy, [Date], CAST(position AS INT) AS position,
 {rnd('sr', 6)} AS strategy_return, {rnd('cumulative', 6)} AS cumulative, {rnd('base_cumulative', 6)} AS base_cumulative FROM cu"""


def metrics_of(names) -> str:
    def safe(e: str) -> str:
        return f"CASE WHEN ({e}) IS NULL OR isnan({e}) OR isinf({e}) THEN 0.0::DOUBLE ELSE {rnd(e)} END"

    return f"""WITH {H3}, {strategy_rows(names)},
pk AS (SELECT *, cumulative / greatest(1.0, max(cumulative) OVER (PARTITION BY ticker, strategy ORDER BY [Date])) - 1 AS dd FROM cu),
ag AS (SELECT ticker, strategy, avg(sr) AS a, stddev_samp(sr) AS s, count(*) AS n, arg_max(cumulative, [Date]) AS e,
  min(dd) AS mdd, count(*) FILTER (sr > 0) AS up, count(*) FILTER (sr <> 0) AS mv FROM pk GROUP BY 1, 2)
SELECT ticker, strategy, {safe('a / nullif(s, 0) * sqrt(252.0::DOUBLE)')} AS sharpe_ratio,
 {safe('(pow(e, 252.0::DOUBLE / n) - 1) * 100')} AS cagr_pct, {safe('least(mdd, 0) * 100')} AS max_drawdown_pct,
 {safe('up * 100.0::DOUBLE / nullif(mv, 0)')} AS win_rate_pct, {safe('s * sqrt(252.0::DOUBLE) * 100')} AS volatility_pct FROM ag"""


oracle("strategy_rsi", curve_of("RSI(50)"))
oracle("strategy_sma_cross", curve_of("SMA_Cross(20,50)"))
oracle("strategy_buy_hold", curve_of("Hold"))
oracle("strategy_metrics", metrics_of(["RSI(50)"]))
oracle("strategy_grid", metrics_of(list(GRID)))
oracle("base_vs_strategy_curve", f"""WITH {H3}, {strategy_rows(['RSI(50)'])},
bz AS (SELECT h3.ticker, h3.[Date], h3.[Close] / nullif(lag(h3.[Close]) OVER (PARTITION BY h3.ticker ORDER BY h3.[Date]), 0) - 1 AS r
  FROM h3 JOIN h ON h.ticker = h3.ticker AND h.[Date] = h3.[Date] WHERE h.[Volume] >= 2),
bc AS (SELECT ticker, [Date], product(1 + r) OVER {W} AS base FROM bz WHERE r IS NOT NULL)
SELECT cu.ticker, cu.[Date], {rnd('cumulative', 6)} AS cumulative, {rnd('bc.base', 6)} AS base
FROM cu ASOF LEFT JOIN bc ON cu.ticker = bc.ticker AND cu.[Date] >= bc.[Date]""")

# Messages

NAME = "CASE WHEN h.ticker <> 'click' THEN upper(h.ticker) ELSE h.ticker END"
SECTOR = "CASE WHEN h.ticker <> 'click' THEN 'Web' ELSE 'Unknown' END"
PART_OF = q("CAST(floor(epoch(h.[Date]) / (3600 * 250)) AS BIGINT)")
oracle("message_build", f"""WITH {H} SELECT h.ticker, {NAME} AS company_name, {SECTOR} AS sector, count(*) AS bars,
 count(*) AS rows, min(h.[Date]) AS start_date, max(h.[Date]) AS end_date FROM h GROUP BY h.ticker, {PART_OF}""")
FLAT = f"""WITH {H}, hi AS (SELECT ticker, max([High]) AS per FROM h WHERE ticker <> 'view' GROUP BY 1)
 SELECT h.ticker, h.[Date], [Open], [High], [Low], [Close], [Volume], per, {NAME} AS company_name, {SECTOR} AS sector
 FROM h LEFT JOIN hi ON h.ticker = hi.ticker"""
oracle("message_flatten", FLAT)
oracle("message_stream", FLAT)
# Beside the error its id gives it, a message fails if the event's own value is not above 0.
ZERO = "CASE WHEN value <= 0 THEN 'invalid_close' END"
CODES = f"""CASE event_id % 11 WHEN 1 THEN concat_ws('|', {ZERO}, 'high_below_low')
 WHEN 2 THEN 'invalid_close' WHEN 3 THEN 'invalid_close' WHEN 4 THEN 'missing_field|invalid_close'
 WHEN 5 THEN concat_ws('|', {ZERO}, 'type_error') WHEN 6 THEN concat_ws('|', {ZERO}, 'negative_volume')
 WHEN 7 THEN concat_ws('|', 'missing_field', {ZERO}) WHEN 8 THEN 'missing_ticker' WHEN 9 THEN 'missing_ohlcv'
 WHEN 10 THEN 'broken_json' ELSE concat_ws('|', {ZERO}) END"""
oracle("envelope_fields", f"""WITH {H} SELECT h.ticker, 'yfinance' AS source, '1.0' AS schema_version,
 TIMESTAMP '2024-01-02 03:04:05' AS published_at FROM h GROUP BY h.ticker, {PART_OF}""")
oracle("zone_times", "SELECT event_id, ts AS utc, ts + INTERVAL 9 HOUR AS tokyo FROM events")
oracle("message_more_fields", f"""WITH {H}, x AS (
 SELECT ticker, max([High]) AS beta, min([Low]) AS per FROM h GROUP BY 1)
 SELECT h.ticker, [Date], [Close], [Close] * 2 AS adjusted, per, beta FROM h JOIN x ON h.ticker = x.ticker""")
oracle("message_other_fields", f"""WITH {H}, x AS (
 SELECT ticker, max([High]) AS beta, min([Low]) AS per FROM h GROUP BY 1)
 SELECT h.ticker, [Date], [Close], [Volume] + 0.5::DOUBLE AS [Volume], [Volume] + 1 AS "Trades", per, beta,
 'X' || length(h.ticker) AS exchange, [Close] * 2 AS adjusted FROM h JOIN x ON h.ticker = x.ticker""")
oracle("message_rejects", f"""SELECT code, count(*) AS n FROM (
 SELECT unnest(string_split(codes, '|')) AS code FROM (SELECT {CODES} AS codes FROM events) WHERE codes <> '') GROUP BY 1""")
oracle("message_validation", f"""SELECT event_id, codes = '' AS is_valid,
 CASE WHEN codes = '' THEN 0 ELSE len(string_split(codes, '|')) END::BIGINT AS n_errors, codes
 FROM (SELECT event_id, {CODES} AS codes FROM events)""")
oracle("message_stats", f"""WITH c AS (SELECT count(*) AS received, count(*) FILTER (({CODES}) = '') AS valid FROM events)
 SELECT received, valid, received - valid AS invalid,
 printf('%.1f%%', valid * 100.0::DOUBLE / greatest(received, 1)) AS validation_rate FROM c""")
oracle("publish_stats", """WITH c AS (SELECT count(*) AS n, count(*) FILTER (event_id % 11 <> 10) AS sent FROM events)
 SELECT sent AS messages_sent, n - sent AS errors,
 printf('%.1f%%', sent * 100.0::DOUBLE / greatest(n, 1)) AS success_rate FROM c""")
oracle("json_props", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
 coalesce(json_extract_string(props, '$.missing'), 'none') AS missing FROM events""")

oracle("bar_stream", f"WITH {H} SELECT * FROM h")
oracle("stream_dedup", f"""WITH {H} SELECT *, 1 AS message FROM h
 WHERE [Date] < (SELECT max([Date]) - INTERVAL 2 DAY FROM h)""")
oracle("position_stream", f"""WITH RECURSIVE {fold(20)} SELECT * FROM ({TRADES}) t
 WHERE exit_reason <> 'end_of_data' AND exit_date < (SELECT max([Date]) - INTERVAL 1 HOUR FROM h)""")
oracle("evaluation_stream", f"WITH {H}, {PART}, {DEC} SELECT * FROM dst")
oracle("history_export", f"WITH {H} SELECT *, ticker AS safe_ticker FROM h")
oracle("csv_export", f"WITH {H} SELECT * FROM h")

# Features

F75 = chain("db", sma=(5, 25, 75), cross=(25, 75), keep='"Volume", dividend_yield,')
ROUND = {"sma_25_above_75", "close_above_sma25"}
FEATURE_SQL = {
    "sma_5_ratio": "sma_5 / nullif([Close], 0) - 1",
    "sma_25_ratio": "sma_25 / nullif([Close], 0) - 1",
    "sma_75_ratio": "sma_75 / nullif([Close], 0) - 1",
    "sma_25_above_75": "CAST(coalesce(sma_25 > sma_75, false) AS INT)",
    "close_above_sma25": "CAST(coalesce([Close] > sma_25, false) AS INT)",
    "rsi_14": "rsi_14 / 100",
    "bb_width": "(bb_upper - bb_lower) / nullif([Close], 0)",
    "bb_position": "([Close] - bb_lower) / nullif(bb_upper - bb_lower, 0)",
    "fundamental_score": "fundamental_score / 100",
    "per_norm": "least(greatest(coalesce(per, 15) / 50, 0), 1)",
    "pbr_norm": "least(greatest(coalesce(pbr, 1.5) / 10, 0), 1)",
    "roe_norm": "least(greatest(coalesce(roe, 0.1), 0), 0.5) / 0.5",
    "dividend_yield": "coalesce(dividend_yield, 0) * 100",
    "volume_ma_ratio": "[Volume] / nullif(vm, 0)",
    "return_5d": "[Close] / nullif(c5, 0) - 1",
    "return_20d": "[Close] / nullif(c20, 0) - 1",
    "volatility_20d": "CASE WHEN nv = 20 THEN vol END",
}
FEATURES = f"""{DB}, {FUND}, {F75},
fa AS (SELECT ind.*, per, pbr, roe, fundamental_score,
  [Close] / nullif(lag([Close]) OVER wt, 0) - 1 AS r1, lag([Close], 5) OVER wt AS c5, lag([Close], 20) OVER wt AS c20,
  sum([Volume]) OVER w20 / count([Volume]) OVER w20 AS vm,
  CAST(lead([Close], 20) OVER wt / nullif([Close], 0) - 1 >= 0.03 AS INT) AS label
  FROM ind JOIN fund ON ind.ticker = fund.ticker
  WINDOW wt AS (PARTITION BY ind.ticker ORDER BY [Date]),
         w20 AS (PARTITION BY ind.ticker ORDER BY [Date] ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
fb AS (SELECT *, stddev_samp(r1) OVER {frame(20)} AS vol, count(r1) OVER {frame(20)} AS nv FROM fa),
fc AS (SELECT ticker, [Date], {", ".join(f"{e} AS {n}" for n, e in FEATURE_SQL.items())}, label FROM fb),
fm AS (SELECT * FROM fc WHERE label IS NOT NULL AND {" AND ".join(f"{n} IS NOT NULL" for n in FEATURE_SQL)})"""
oracle("feature_matrix", f"""WITH {FEATURES} SELECT ticker, [Date], label,
 {", ".join(n if n in ROUND else rnd(n, 5) + f" AS {n}" for n in FEATURE_SQL)} FROM fm""")
oracle("label_distribution", f"WITH {FEATURES} SELECT label, count(*) AS count FROM fm GROUP BY 1")
SPLIT = f"""{FEATURES}, sp AS (SELECT ticker, [Date], label,
 row_number() OVER (ORDER BY [Date], ticker) <= floor(0.8 * (SELECT count(*) FROM fm)) AS is_train FROM fm)"""
oracle("train_test_split", f"WITH {SPLIT} SELECT * FROM sp")
oracle("class_weight", f"""WITH {SPLIT}, c AS (SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives
 FROM sp WHERE is_train) SELECT negatives, positives, {rnd('negatives / greatest(positives, 1)::DOUBLE', 6)} AS scale_pos_weight FROM c""")

# Classification

SCORED = """sc AS (SELECT doc_id, quality AS label, least(n_chars, 5000) / 5000.0::DOUBLE AS score FROM labels JOIN documents USING (doc_id)),
cf AS (SELECT count(*) FILTER (label = 1 AND score >= 0.2) AS tp, count(*) FILTER (label <> 1 AND score >= 0.2) AS fp,
 count(*) FILTER (label = 1 AND score < 0.2) AS fn, count(*) FILTER (label <> 1 AND score < 0.2) AS tn FROM sc)"""


def share(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0.0::DOUBLE)"


def f1(p: str, r: str) -> str:
    return f"coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0.0::DOUBLE)"


oracle("classification_metrics", f"""WITH {SCORED}, p AS (SELECT *, {share('tp', 'tp + fp')} AS pr, {share('tp', 'tp + fn')} AS rc FROM cf)
 SELECT tp, fp, fn, tn, {rnd(share('tp + tn', 'tp + fp + fn + tn'), 4)} AS accuracy, {rnd('pr', 4)} AS precision,
 {rnd('rc', 4)} AS recall, {rnd(f1('pr', 'rc'), 4)} AS f1 FROM p""")
oracle("classification_report", f"""WITH {SCORED},
k AS (SELECT 'HOLD' AS class, {share('tn', 'tn + fn')} AS p, {share('tn', 'tn + fp')} AS r, tn + fp AS s FROM cf
 UNION ALL SELECT 'BUY', {share('tp', 'tp + fp')}, {share('tp', 'tp + fn')}, tp + fn FROM cf),
j AS (SELECT *, {f1('p', 'r')} AS f FROM k),
a AS (SELECT class, p, r, f, s FROM j
 UNION ALL SELECT 'accuracy', x, x, x, n FROM (SELECT {share('tp + tn', 'tp + fp + fn + tn')} AS x, tp + fp + fn + tn AS n FROM cf)
 UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(s) AS BIGINT) FROM j
 UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), CAST(sum(s) AS BIGINT) FROM j)
SELECT class, {rnd('p', 4)} AS precision, {rnd('r', 4)} AS recall, {rnd('f', 4)} AS f1, s AS support FROM a""")
oracle("auc_rank_sum", f"""WITH {SCORED}, rk AS (SELECT label, score,
 rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM sc),
n AS (SELECT sum(r) FILTER (label = 1) AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS g FROM rk)
SELECT {rnd('(s - p * (p + 1) / 2.0::DOUBLE) / (p * g::DOUBLE)', 6)} AS auc FROM n""")
