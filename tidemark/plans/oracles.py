"""The registered queries again, in SQL for another engine, as the check on their results.

`CTES` holds named building blocks; a query lists only its final SELECT, and `compose`
puts the blocks it refers to in front. The SQL states what each operator means, not how
the Spark version computes it.
"""

from __future__ import annotations

import re

from tidemark.functions.normal import TAIL_BOTTOM, TAIL_TOP

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def compose(sql: str) -> str:
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(CTES[name])
    blocks = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    return (f"WITH RECURSIVE {', '.join(blocks)} " if blocks else "") + sql


# --- panels --------------------------------------------------------------------------------

UNIT_PRICE = (
    "CAST(SUM(CAST(floor(l_extendedprice * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE)"
    " / 100.0::DOUBLE / SUM(l_quantity)"
)

cte("v_lines", """
SELECT lineitem.*, replace(p_brand, '#', '.') AS ticker, replace(p_brand, '#', '') AS symbol,
  CAST(l_shipdate AS DATE) AS date
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
cte("v_spot", f"SELECT symbol, date, {UNIT_PRICE} AS close FROM v_lines GROUP BY ALL")
cte("v_market", f"""
SELECT 'SPX' AS symbol, CAST(l_shipdate AS DATE) AS date, {UNIT_PRICE} AS close FROM lineitem GROUP BY ALL
""")
cte("v_sessions", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem")
cte("v_universe", "SELECT DISTINCT date, ticker FROM v_lines")
cte("v_names", """
SELECT DISTINCT ticker, ticker AS stock_symbol, replace(ticker, '.', '') AS option_symbol,
  replace(ticker, '.', '-') AS yahoo_symbol FROM v_universe
""")
cte("v_quotes", """
SELECT replace(ticker, '.', '-') AS yahoo_symbol, date,
  (min(l_extendedprice / l_quantity) + max(l_extendedprice / l_quantity)) / 2.0::DOUBLE AS yahoo_close,
  coalesce(max(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09::DOUBLE THEN l_discount END), 0.0::DOUBLE) AS dividend,
  coalesce(max(CASE WHEN l_returnflag = 'A' AND l_quantity >= 49.0::DOUBLE AND l_tax >= 0.07::DOUBLE
    THEN 1.0::DOUBLE + l_discount * 10.0::DOUBLE END), 0.0::DOUBLE) AS split
FROM v_lines GROUP BY ALL
""")
cte("v_actions", """
SELECT option_symbol AS symbol, date, 'split' AS action, split AS value
FROM v_quotes JOIN v_names USING (yahoo_symbol) WHERE split > 0
UNION ALL
SELECT option_symbol, date, 'dividend', dividend
FROM v_quotes JOIN v_names USING (yahoo_symbol) WHERE dividend > 0
""")
cte("v_constituents", """
SELECT replace(p_brand, '#', '.') AS ticker, p_type AS sector, sub AS sub_industry FROM (
  SELECT p_brand, p_type, max(p_type) OVER (PARTITION BY p_brand) AS sub,
    row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn
  FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL))
WHERE rn = 1
""")
cte("v_brand_sectors", "SELECT replace(ticker, '.', '') AS symbol, sector FROM v_constituents")
cte("v_chain_spot", """
SELECT symbol, date,
  round(100.0::DOUBLE * avg(close) OVER w / avg(close) OVER (PARTITION BY symbol), 2) AS underlying
FROM (SELECT symbol, date, close FROM v_spot UNION ALL SELECT symbol, date, close FROM v_market)
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
""")
cte("v_legs", """
SELECT *, date_diff('day', date, expiration) AS dte FROM (
  SELECT symbol, date, underlying, j, "right",
    (floor(underlying / 5.0::DOUBLE) * 5 + 5 * k)::DOUBLE AS strike,
    CAST(m + CAST(((5 - isodow(m) + 7) % 7) + 14 AS INTEGER) AS DATE) AS expiration
  FROM (SELECT s.*, j, CAST(date_trunc('month', date) + to_months(CAST(j AS INTEGER)) AS DATE) AS m
        FROM v_chain_spot s, range(0, 5) t(j)),
    range(-4, 5) u(k), (VALUES ('C'), ('P')) r("right"))
WHERE expiration > date AND strike > 0
""")
cte("v_priced", """
SELECT *, 0.02::DOUBLE * fair + 0.01::DOUBLE AS half,
  underlying - floor(underlying) >= 0.06::DOUBLE AS quoted
FROM (
  SELECT *, 0.5::DOUBLE + 0.5::DOUBLE * x / (1.0::DOUBLE + abs(x)) AS dc,
    greatest(CASE WHEN "right" = 'C' THEN underlying - strike ELSE strike - underlying END, 0.0::DOUBLE)
      + 0.4::DOUBLE * underlying * width / (1.0::DOUBLE + abs(x)) AS fair
  FROM (
    SELECT *, (underlying / strike - 1.0::DOUBLE) / width AS x FROM (
      SELECT *, vol * root AS width FROM (
        SELECT *, sqrt(dte::DOUBLE / 365.0::DOUBLE) AS root, abs(strike / underlying - 1.0::DOUBLE) AS gap,
          0.2::DOUBLE + 0.01::DOUBLE * j::DOUBLE + 0.1::DOUBLE * abs(strike / underlying - 1.0::DOUBLE)
            + 0.05::DOUBLE * (underlying / 100.0::DOUBLE) AS vol
        FROM v_legs))))
""")
cte("v_chain", """
SELECT date, symbol, expiration, strike, "right", bid, ask, (bid + ask) / 2.0::DOUBLE AS mid,
  CASE WHEN gap <= 0.18::DOUBLE THEN vol END AS iv,
  CASE WHEN "right" = 'C' THEN dc ELSE dc - 1.0::DOUBLE END AS delta,
  0.4::DOUBLE / (underlying * width * (1.0::DOUBLE + abs(x))) AS gamma,
  -fair / (2.0::DOUBLE * dte::DOUBLE) AS theta,
  0.4::DOUBLE * underlying * root * (1.0::DOUBLE - (2.0::DOUBLE * dc - 1.0::DOUBLE) * (2.0::DOUBLE * dc - 1.0::DOUBLE)) / 100.0::DOUBLE AS vega,
  underlying, (dte * 10)::BIGINT AS volume
FROM (SELECT *, CASE WHEN quoted THEN greatest(fair - half, 0.0::DOUBLE) ELSE 0.0::DOUBLE END AS bid,
        CASE WHEN quoted THEN fair + half ELSE 0.0::DOUBLE END AS ask FROM v_priced)
""")
cte("v_vendor", """
SELECT symbol, strftime(expiration, '%Y-%m-%d') AS expiration, strike,
  CASE WHEN "right" = 'C' THEN 'CALL' ELSE 'PUT' END AS "right", bid, ask, volume, delta, gamma, theta,
  vega * 100.0::DOUBLE AS vega, coalesce(iv, 0.5::DOUBLE) AS implied_vol,
  CASE WHEN iv IS NULL THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS iv_error,
  date + INTERVAL 16 HOUR AS stamp, underlying AS underlying_price
FROM v_chain
""")
cte("v_bars", """
SELECT symbol, CAST(stamp AS DATE) AS date, expiration, strike, "right", volume, delta, theta, vega,
  implied_vol, iv_error, underlying_price, n,
  fair * (0.9::DOUBLE + 0.02::DOUBLE * n::DOUBLE) AS bid,
  fair * (1.0::DOUBLE + 0.02::DOUBLE * n::DOUBLE) AS ask,
  stamp - INTERVAL 3 MINUTE + n * INTERVAL 1 MINUTE AS bar_stamp,
  stamp - INTERVAL 1 MINUTE AS spot_stamp
FROM (SELECT *, abs(theta) * 2.0::DOUBLE * date_diff('day', CAST(stamp AS DATE), CAST(expiration AS DATE))::DOUBLE AS fair
      FROM v_vendor WHERE ask = 0), (VALUES (1), (2)) t(n)
""")
cte("v_returns", f"""
SELECT symbol, date, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS pnl_per_vega, dollar_vega
FROM (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, {UNIT_PRICE} AS close,
        sum(l_quantity) AS dollar_vega FROM lineitem GROUP BY ALL)
""")
cte("v_market_returns", """
SELECT date, ln(close / lag(close) OVER (ORDER BY date)) AS pnl_per_vega FROM v_market
""")
cte("v_supplier_sectors", """
SELECT CAST(s_suppkey AS VARCHAR) AS symbol, r_name AS sector
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
cte("v_bounds", """
SELECT CAST(min(o_orderdate) AS DATE) AS start_date,
  CAST(max(o_orderdate) AS DATE) AS end_date FROM orders
""")
cte("v_closures", """
SELECT (arg_max(date, (o_totalprice, date))) AS date
FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders) GROUP BY year(date)
""")
cte("v_calendar", """
SELECT CAST(d AS DATE) AS date
FROM v_bounds, generate_series(start_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY) t(d)
WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (SELECT date FROM v_closures)
""")

# --- realized vol and features ---------------------------------------------------------------

cte("v_closes", """
SELECT s.symbol, s.date, s.close, coalesce(a.value, 1.0::DOUBLE) AS split_ratio
FROM v_spot s LEFT JOIN (SELECT symbol, date, min(value) AS value FROM v_actions WHERE action = 'split' GROUP BY ALL) a
  ON a.symbol = s.symbol AND a.date = s.date
""")


def rv_sql(closes: str) -> str:
    trail = lambda n: (
        f"CASE WHEN count(sq) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) = {n}"
        f" THEN sqrt(avg(sq) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) * 252) END"
    )
    ahead = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 60 FOLLOWING)"
    return f"""
SELECT date, symbol, sqrt(sq * 252) AS rv_1, {trail(5)} AS rv_5, {trail(22)} AS rv_22,
  CASE WHEN count(sq) OVER {ahead} = 60 THEN sqrt(avg(sq) OVER {ahead} * 252) END AS rv_fwd
FROM (SELECT *, power(ln(close * split_ratio / lag(close) OVER (PARTITION BY symbol ORDER BY date)), 2) AS sq
      FROM {closes} WHERE close >= 1)
"""


cte("v_rv", rv_sql("v_closes"))
cte("v_market_closes", "SELECT symbol, date, close, 1.0::DOUBLE AS split_ratio FROM v_market")
cte("v_market_rv", rv_sql("v_market_closes"))


def features_sql(closes: str, market: str, beta: int, idio: int, gap: int, sigma: int) -> str:
    w = lambda n: f"(PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING)"
    return f"""
SELECT date, symbol, ret, beta, idio_vol,
  CASE WHEN count(gap) OVER {w(gap)} = {gap} THEN avg(gap) OVER {w(gap)} END AS gap_freq
FROM (
  SELECT *, CASE WHEN count(resid) OVER {w(idio)} = {idio} THEN stddev_samp(resid) OVER {w(idio)} * sqrt(252) END AS idio_vol,
    CAST(abs(ret) > 3 * lag(sigma) OVER (PARTITION BY symbol ORDER BY date) AS INTEGER)::DOUBLE AS gap
  FROM (
    SELECT *, ret - beta * market_return AS resid,
      CASE WHEN count(ret) OVER {w(sigma)} = {sigma} THEN stddev_samp(ret) OVER {w(sigma)} END AS sigma
    FROM (
      SELECT *, CASE WHEN count(ret * market_return) OVER {w(beta)} = {beta} AND count(market_return) OVER {w(beta)} = {beta}
        THEN covar_samp(ret, market_return) OVER {w(beta)} / var_samp(market_return) OVER {w(beta)} END AS beta
      FROM (SELECT symbol, date, ln(close * split_ratio / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS ret
            FROM {closes})
      JOIN {market} USING (date))))
"""


cte("v_market_move", "SELECT date, ln(close / lag(close) OVER (ORDER BY date)) AS market_return FROM v_market")
cte("v_features", features_sql("v_closes", "v_market_move", 250, 60, 250, 60))

oracle("realized_vol", """
SELECT date, symbol, round(rv_1, 6) AS rv_1, round(rv_5, 6) AS rv_5, round(rv_22, 6) AS rv_22, round(rv_fwd, 6) AS rv_fwd
FROM (SELECT * FROM v_rv UNION ALL SELECT * FROM v_market_rv)
""")
oracle("stock_features", """
SELECT date, symbol, round(ret, 6) AS ret, round(beta, 6) AS beta, round(idio_vol, 6) AS idio_vol, round(gap_freq, 6) AS gap_freq
FROM v_features
""")
oracle("spot_from_chain", """
SELECT c.date, c.symbol, c.close, coalesce(a.value, 1.0::DOUBLE) AS split_ratio
FROM (SELECT date, symbol, min(underlying) AS close FROM v_chain WHERE underlying > 0 GROUP BY ALL) c
LEFT JOIN (SELECT symbol, date, min(value) AS value FROM v_actions WHERE action = 'split' GROUP BY ALL) a
  ON a.symbol = c.symbol AND a.date = c.date
""")
oracle("market_return", "SELECT date, round(market_return, 9) AS market_return FROM v_market_move")

# --- surface ---------------------------------------------------------------------------------

cte("v_pillars", """
SELECT date, symbol, expiration, dte, (call_iv + put_iv) / 2 AS atm_iv FROM (
  SELECT date, symbol, expiration, dte, max(CASE WHEN "right" = 'C' THEN iv END) AS call_iv,
    max(CASE WHEN "right" = 'P' THEN iv END) AS put_iv
  FROM (SELECT *, date_diff('day', date, expiration) AS dte,
          row_number() OVER (PARTITION BY date, symbol, expiration, "right" ORDER BY abs(abs(delta) - 0.5::DOUBLE), strike) AS rn
        FROM v_chain
        WHERE iv IS NOT NULL AND bid > 0 AND ask > bid AND abs(delta) BETWEEN 0.25::DOUBLE AND 0.75::DOUBLE
          AND date_diff('day', date, expiration) BETWEEN 7 AND 400)
  WHERE rn = 1 GROUP BY ALL)
WHERE call_iv IS NOT NULL AND put_iv IS NOT NULL
""")


def tenor_sql(tenor: int, extrapolate: bool) -> str:
    flat_low = "first_iv" if extrapolate else "NULL"
    flat_high = "last_iv" if extrapolate else "NULL"
    return f"""CASE WHEN n = 1 THEN CASE WHEN {str(extrapolate).upper()} OR t_lo_{tenor} = t_hi_{tenor} THEN first_iv END
    WHEN t_lo_{tenor} IS NULL THEN {flat_low} WHEN t_hi_{tenor} IS NULL THEN {flat_high}
    WHEN t_lo_{tenor} = t_hi_{tenor} THEN sqrt(v_lo_{tenor} / {tenor})
    ELSE sqrt((v_lo_{tenor} + (v_hi_{tenor} - v_lo_{tenor}) * ({tenor} - t_lo_{tenor}) / (t_hi_{tenor} - t_lo_{tenor})) / {tenor}) END"""


def surface_sql(tenors: tuple[int, ...], extrapolate: bool = False) -> str:
    brackets = ", ".join(
        f"max(dte) FILTER (dte <= {t}) AS t_lo_{t}, min(dte) FILTER (dte >= {t}) AS t_hi_{t},"
        f" arg_max(atm_iv * atm_iv * dte, dte) FILTER (dte <= {t}) AS v_lo_{t},"
        f" arg_min(atm_iv * atm_iv * dte, dte) FILTER (dte >= {t}) AS v_hi_{t}"
        for t in tenors
    )
    columns = ", ".join(f"{tenor_sql(t, extrapolate)} AS iv{t}" for t in tenors)
    return f"""
SELECT date, symbol, {columns} FROM (
  SELECT date, symbol, count(*) AS n, arg_min(atm_iv, dte) AS first_iv, arg_max(atm_iv, dte) AS last_iv, {brackets}
  FROM v_pillars GROUP BY date, symbol)
"""


cte("v_surface", surface_sql((30, 60, 90)))
oracle("atm_pillars", "SELECT date, symbol, expiration, dte::INTEGER AS dte, round(atm_iv, 9) AS atm_iv FROM v_pillars")
oracle("surface", """
SELECT date, symbol, round(iv30, 9) AS iv30, round(iv60, 9) AS iv60, round(iv90, 9) AS iv90 FROM v_surface
""")
oracle("surface_extrapolated", f"""
SELECT date, symbol, round(iv10, 9) AS iv10, round(iv180, 9) AS iv180 FROM ({surface_sql((10, 180), True)})
""")

# --- straddle --------------------------------------------------------------------------------

cte("v_near", """
SELECT * FROM (SELECT *, date_diff('day', date, expiration) AS dte FROM v_chain)
WHERE dte <= 130 AND abs(strike / underlying - 1.0::DOUBLE) <= 0.30::DOUBLE
""")
cte("v_picks", """
SELECT date, symbol, expiration, strike FROM (
  SELECT *, row_number() OVER (PARTITION BY date, symbol ORDER BY abs(dte - 60), dte DESC, gap, strike) AS rn
  FROM (SELECT *, abs(strike / spot - 1.0::DOUBLE) AS gap FROM (
        SELECT date, symbol, expiration, strike, dte, count(DISTINCT "right") AS rights, arg_min(underlying, "right") AS spot
        FROM v_near WHERE bid > 0 AND ask > bid AND dte BETWEEN 25 AND 120
          AND day(expiration) BETWEEN 15 AND 21 AND isodow(expiration) IN (4, 5) GROUP BY ALL))
  WHERE rights = 2 AND gap <= 0.10::DOUBLE)
WHERE rn = 1
""")
cte("v_marks", """
SELECT date, symbol, expiration, strike, sum(mid) AS mid, sum(bid) AS bid, sum(ask) AS ask, sum(delta) AS delta,
  sum(vega) AS vega, sum(theta) AS theta, arg_min(underlying, "right") AS underlying
FROM v_near WHERE ask > 0 AND bid >= 0 AND ask >= bid GROUP BY ALL HAVING count(*) >= 2
""")
cte("v_numbered", "SELECT date, row_number() OVER (ORDER BY date) AS pos FROM v_sessions")
cte("v_entries", """
SELECT p.symbol, n.pos, p.date, p.expiration, p.strike FROM v_picks p JOIN v_numbered n USING (date)
""")
cte("v_held_days", """
SELECT e.symbol, e.pos AS entry_pos, e.expiration, e.strike, n.pos, n.date, m.mid, m.underlying,
  max(CASE WHEN m.mid IS NOT NULL THEN n.pos END) OVER (PARTITION BY e.symbol, e.pos ORDER BY n.pos) AS last_marked
FROM v_entries e
JOIN v_numbered n ON n.pos >= e.pos AND n.date <= e.expiration + INTERVAL 30 DAY
LEFT JOIN v_marks m ON m.symbol = e.symbol AND m.date = n.date AND m.expiration = e.expiration AND m.strike = e.strike
""")
cte("v_exits", """
SELECT symbol, entry_pos, min(pos) AS exit_pos, arg_min(kind, pos) AS exit_kind FROM (
  SELECT *, CASE
      WHEN mid IS NOT NULL AND (date_diff('day', date, expiration) <= 20
        OR abs(strike / underlying - 1.0::DOUBLE) > 0.15::DOUBLE) THEN 'roll'
      WHEN mid IS NULL AND (pos - last_marked > 5 OR date_diff('day', date, expiration) <= 0) THEN 'forced_close' END AS kind
  FROM v_held_days WHERE pos > entry_pos)
WHERE kind IS NOT NULL GROUP BY ALL
""")
cte("v_links", """
SELECT e.*, x.exit_pos, x.exit_kind, nx.pos AS next_pos
FROM v_entries e LEFT JOIN v_exits x ON x.symbol = e.symbol AND x.entry_pos = e.pos
ASOF LEFT JOIN (SELECT symbol, pos FROM v_entries) nx
  ON nx.symbol = e.symbol AND x.exit_pos + CASE WHEN x.exit_kind = 'forced_close' THEN 1 ELSE 0 END <= nx.pos
""")
cte("v_taken", """
SELECT * FROM (SELECT l.* FROM v_links l JOIN (SELECT symbol, min(pos) AS pos FROM v_entries GROUP BY symbol) f
                 ON l.symbol = f.symbol AND l.pos = f.pos)
UNION ALL
SELECT l.* FROM v_taken t JOIN v_links l ON l.symbol = t.symbol AND l.pos = t.next_pos
""")
cte("v_day_spot", """
SELECT symbol, date, arg_min(underlying, (expiration, strike, "right")) AS day_spot FROM v_near GROUP BY ALL
""")
cte("v_unit_days", """
SELECT t.symbol, t.pos AS entry_pos, t.expiration, t.strike, t.exit_pos, t.exit_kind, t.next_pos, n.pos, n.date,
  m.mid, m.bid, m.ask, m.delta, m.vega, m.theta, coalesce(m.underlying, CASE WHEN m.mid IS NULL THEN s.day_spot END) AS seen,
  first_value(m.vega) OVER unit * 100 AS held_vega,
  last_value(m.mid IGNORE NULLS) OVER past AS last_mid,
  last_value(coalesce(m.underlying, s.day_spot) IGNORE NULLS) OVER past AS last_spot,
  last_value(-m.delta * 100 IGNORE NULLS) OVER past AS shares
FROM v_taken t
JOIN v_numbered n ON n.pos BETWEEN t.pos AND coalesce(t.exit_pos, (SELECT max(pos) FROM v_numbered))
LEFT JOIN v_marks m ON m.symbol = t.symbol AND m.date = n.date AND m.expiration = t.expiration AND m.strike = t.strike
LEFT JOIN v_day_spot s ON s.symbol = t.symbol AND s.date = n.date
WINDOW unit AS (PARTITION BY t.symbol, t.pos ORDER BY n.pos),
  past AS (PARTITION BY t.symbol, t.pos ORDER BY n.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
cte("v_old", """
SELECT *, CASE WHEN pos = exit_pos AND exit_kind = 'forced_close' THEN 'forced_close'
    WHEN pos = exit_pos AND next_pos = pos THEN 'roll'
    WHEN pos = exit_pos THEN 'roll_failed_closed' ELSE '' END AS event,
  coalesce(seen, last_spot) AS spot
FROM v_unit_days WHERE pos > entry_pos
""")
cte("v_new", "SELECT * FROM v_unit_days WHERE pos = entry_pos")
cte("v_day_rows", """
SELECT coalesce(o.symbol, n.symbol) AS symbol, coalesce(o.date, n.date) AS date,
  CASE WHEN o.mid IS NOT NULL THEN (o.mid - o.last_mid) * 100 ELSE 0 END AS option_pnl,
  coalesce(o.shares * (o.spot - o.last_spot), 0) AS hedge_pnl,
  CASE WHEN o.event IN ('roll', 'roll_failed_closed') THEN 0.5 * (o.ask - o.bid) * 100 ELSE 0 END
    + coalesce(0.5 * (n.ask - n.bid) * 100, 0) AS option_cost,
  0.005 * CASE WHEN n.symbol IS NOT NULL THEN abs(-n.delta * 100 - coalesce(o.shares, 0))
    WHEN o.event <> '' THEN abs(o.shares)
    WHEN o.mid IS NOT NULL THEN abs(-o.delta * 100 - o.shares) ELSE 0 END AS hedge_cost,
  CASE WHEN n.symbol IS NOT NULL THEN n.vega * 100 WHEN o.event <> '' THEN 0
    WHEN o.mid IS NOT NULL THEN o.vega * 100 ELSE o.held_vega END AS dollar_vega,
  CASE WHEN n.symbol IS NOT NULL THEN n.theta * 100 WHEN o.event = '' AND o.mid IS NOT NULL THEN o.theta * 100 ELSE 0 END AS dollar_theta,
  CASE WHEN n.symbol IS NOT NULL THEN 0.5 * (n.ask - n.bid) * 100
    WHEN o.event = '' AND o.mid IS NOT NULL THEN 0.5 * (o.ask - o.bid) * 100 ELSE 0 END AS exit_cost,
  CASE WHEN n.symbol IS NOT NULL THEN n.mid WHEN o.event = 'roll_failed_closed' THEN NULL ELSE coalesce(o.mid, o.last_mid) END AS mid,
  CASE WHEN n.symbol IS NOT NULL THEN n.seen WHEN o.event = 'roll_failed_closed' THEN NULL ELSE o.spot END AS underlying,
  CASE WHEN n.symbol IS NOT NULL THEN date_diff('day', n.date, n.expiration)
    WHEN o.event = 'roll_failed_closed' THEN NULL ELSE date_diff('day', o.date, o.expiration) END AS dte,
  CASE WHEN n.symbol IS NOT NULL THEN n.held_vega WHEN o.event = '' THEN o.held_vega END AS inception_vega,
  CASE WHEN o.symbol IS NULL THEN 'open' ELSE o.event END AS event
FROM v_old o FULL JOIN v_new n ON o.symbol = n.symbol AND o.date = n.date
""")
cte("v_path", """
SELECT date, symbol, CASE WHEN entry_vega > 0 THEN (option_pnl + hedge_pnl) / entry_vega END AS pnl_per_vega,
  CASE WHEN entry_vega > 0 THEN (option_cost + hedge_cost) / entry_vega END AS cost_per_vega,
  CASE WHEN inception_vega > 0 THEN exit_cost / inception_vega END AS exit_cost_per_vega,
  dollar_vega, entry_vega, dollar_theta, mid, underlying, dte, event
FROM (SELECT *, lag(inception_vega) OVER (PARTITION BY symbol ORDER BY date) AS entry_vega FROM v_day_rows)
""")
oracle("straddle_select", "SELECT date, symbol, expiration, strike FROM v_picks")
oracle("straddle_mark", """
SELECT date, symbol, expiration, strike, round(mid, 6) AS mid, round(bid, 6) AS bid, round(ask, 6) AS ask,
  round(delta, 6) AS delta, round(vega, 6) AS vega, round(theta, 6) AS theta, underlying,
  round(0.5 * (ask - bid) * 100, 6) AS half_spread FROM v_marks
""")
oracle("straddle_exits", """
SELECT e.symbol, e.date, e.expiration, e.strike, e.pos::INTEGER AS pos, x.exit_pos::DOUBLE AS exit_pos, x.exit_kind
FROM v_entries e LEFT JOIN v_exits x ON x.symbol = e.symbol AND x.entry_pos = e.pos
""")
oracle("straddle_path", """
SELECT date, symbol, round(pnl_per_vega, 6) AS pnl_per_vega, round(cost_per_vega, 6) AS cost_per_vega,
  round(exit_cost_per_vega, 6) AS exit_cost_per_vega, round(dollar_vega, 6) AS dollar_vega,
  round(entry_vega, 6) AS entry_vega, round(dollar_theta, 6) AS dollar_theta, round(mid, 6) AS mid,
  round(underlying, 6) AS underlying, dte::DOUBLE AS dte, event FROM v_path
""")
oracle("near_money_chain", """
SELECT date, symbol, expiration, strike, "right", dte::INTEGER AS dte, mid AS mid FROM v_near
""")

# --- normal distribution and pricing ----------------------------------------------------------


def polynomial_sql(x: str, coefficients: tuple[float, ...]) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def cdf_sql(x: str) -> str:
    a = f"abs({x})"
    weight = f"exp(-{a} * {a} / 2.0::DOUBLE)"
    tail = f"{weight} * {polynomial_sql(a, TAIL_TOP)} / {polynomial_sql(a, TAIL_BOTTOM)}"
    return f"(CASE WHEN {x} > 0 THEN 1.0::DOUBLE - {tail} ELSE {tail} END)"


def priced_sql(source: str, sigma: str, rate: str, keep: str) -> str:
    """`source` has spot, strike, tau, is_call; adds d1, d2, n1, n2 (cdf) and disc."""
    return f"""
SELECT *, {cdf_sql('d1')} AS n1, {cdf_sql('d2')} AS n2, {cdf_sql('(-d1)')} AS m1, {cdf_sql('(-d2)')} AS m2,
  exp(-d1 * d1 / 2.0::DOUBLE) / sqrt(2.0::DOUBLE * pi()) AS density, exp(-({rate}) * tau) AS disc
FROM (SELECT *, d1 - sigma * sqrt(tau) AS d2 FROM (
  SELECT *, (ln(spot / strike) + ({rate} + 0.5::DOUBLE * sigma * sigma) * tau) / (sigma * sqrt(tau)) AS d1
  FROM (SELECT {keep}, {sigma} AS sigma FROM {source})))
"""


cte("v_bs_in", """
SELECT date, symbol, expiration, strike, "right", underlying AS spot, iv, "right" = 'C' AS is_call,
  date_diff('day', date, expiration)::DOUBLE / 365.0::DOUBLE AS tau FROM v_chain
""")
cte("v_bs", priced_sql("v_bs_in", "CASE WHEN iv > 0 THEN iv END", "0.03::DOUBLE", "*"))
oracle("reprice_chain", """
SELECT date, symbol, expiration, strike, "right",
  round(CASE WHEN iv IS NULL THEN NULL WHEN is_call THEN spot * n1 - strike * disc * n2 ELSE strike * disc * m2 - spot * m1 END, 6) AS bs_price,
  round(CASE WHEN iv IS NULL THEN NULL WHEN is_call THEN n1 ELSE n1 - 1 END, 6) AS bs_delta,
  round(density / (spot * iv * sqrt(tau)), 6) AS bs_gamma,
  round(spot * density * sqrt(tau), 6) AS bs_vega,
  round(CASE WHEN iv IS NULL THEN NULL ELSE (-spot * density * iv / (2 * sqrt(tau))
    + CASE WHEN is_call THEN -0.03::DOUBLE * strike * disc * n2 ELSE 0.03::DOUBLE * strike * disc * m2 END) / 365.0::DOUBLE END, 6) AS bs_theta
FROM v_bs
""")
cte("v_bs_low", priced_sql("(SELECT * FROM v_bs_in WHERE iv > 0)", "iv", "0.04::DOUBLE", "*"))
cte("v_bs_high", priced_sql("(SELECT * FROM v_bs_in WHERE iv > 0)", "iv + 0.01::DOUBLE", "0.04::DOUBLE", "*"))
PRICE = "CASE WHEN {0}.is_call THEN {0}.spot * {0}.n1 - {0}.strike * {0}.disc * {0}.n2 ELSE {0}.strike * {0}.disc * {0}.m2 - {0}.spot * {0}.m1 END"
oracle("vega_residuals", f"""
SELECT date, symbol, expiration, strike, "right", round(c.vega, 6) AS vega,
  round({PRICE.format('h')} - {PRICE.format('l')}, 6) AS move
FROM v_bs_low l JOIN v_bs_high h USING (date, symbol, expiration, strike, "right")
JOIN v_chain c USING (date, symbol, expiration, strike, "right")
""")

# --- canonical rows --------------------------------------------------------------------------

oracle("canonical_chain", """
SELECT CAST(stamp AS DATE) AS date, symbol, CAST(expiration AS DATE) AS expiration, strike,
  CASE WHEN "right" = 'CALL' THEN 'C' ELSE 'P' END AS "right", bid AS bid, ask AS ask,
  (bid + ask) / 2.0::DOUBLE AS mid,
  CASE WHEN abs(iv_error) <= 1 AND implied_vol > 0 THEN implied_vol END AS iv,
  delta AS delta, gamma AS gamma, theta AS theta, vega * 0.01::DOUBLE AS vega,
  underlying_price AS underlying, volume, implied_vol AS implied_vol, iv_error,
  0.1::DOUBLE AS rho, 0.2::DOUBLE AS epsilon, 0.3::DOUBLE AS lambda, 0::BIGINT AS bid_size,
  strftime(stamp, '%Y-%m-%d %H:%M:%S') AS "timestamp", strftime(stamp, '%Y-%m-%d %H:%M:%S') AS underlying_timestamp
FROM v_vendor
""")
cte("v_clean_vendor", """
SELECT symbol, year(date) AS year, strike, "right", underlying_price AS spot, vega, implied_vol, dte::DOUBLE / 365.0::DOUBLE AS tau,
  "right" = 'CALL' AS is_call,
  row_number() OVER (PARTITION BY symbol, year(date) ORDER BY date, expiration, strike, "right") AS rn
FROM (SELECT *, CAST(stamp AS DATE) AS date, date_diff('day', CAST(stamp AS DATE), CAST(expiration AS DATE)) AS dte FROM v_vendor)
WHERE bid > 0 AND abs(iv_error) <= 0.01::DOUBLE AND implied_vol BETWEEN 0.05::DOUBLE AND 2 AND dte BETWEEN 10 AND 365
  AND abs(delta) BETWEEN 0.2::DOUBLE AND 0.8::DOUBLE AND vega > 0
""")
cte("v_sample_low", priced_sql("v_clean_vendor", "implied_vol", "0.04::DOUBLE", "*"))
cte("v_sample_high", priced_sql("v_clean_vendor", "implied_vol + 0.01::DOUBLE", "0.04::DOUBLE", "*"))
oracle("vega_scale", f"""
SELECT symbol, year::INTEGER AS year, coalesce(sampled, 0)::BIGINT AS sampled, round(share, 6) AS share,
  CASE WHEN sampled >= 20 AND share >= 2.0::DOUBLE / 3 THEN 0.01::DOUBLE WHEN sampled >= 20 AND share <= 1.0::DOUBLE / 3 THEN 1.0::DOUBLE END AS scale,
  CASE WHEN coalesce(sampled, 0) < 20 THEN 'too_few' WHEN share < 2.0::DOUBLE / 3 AND share > 1.0::DOUBLE / 3 THEN 'ambiguous' ELSE 'ok' END AS status
FROM (SELECT DISTINCT symbol, year(stamp) AS year FROM v_vendor)
LEFT JOIN (
  SELECT symbol, year, count(*) AS sampled, avg((abs(move - vega * 0.01::DOUBLE) < abs(move - vega))::INTEGER) AS share
  FROM (SELECT l.symbol, l.year, l.vega, {PRICE.format('h')} - {PRICE.format('l')} AS move
        FROM v_sample_low l JOIN v_sample_high h ON h.symbol = l.symbol AND h.year = l.year AND h.rn = l.rn)
  GROUP BY ALL) USING (symbol, year)
""")
oracle("open_interest", """
SELECT date, symbol, expiration, strike, "right", oi FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, replace(p_brand, '#', '') AS symbol, CAST(o_orderdate AS DATE) + 30 AS expiration,
    floor(p_retailprice / 10.0::DOUBLE) * 10.0::DOUBLE AS strike, CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS "right",
    CAST(l_quantity AS BIGINT) AS oi,
    row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE), p_brand, floor(p_retailprice / 10.0::DOUBLE), l_linestatus = 'O'
      ORDER BY o_orderkey DESC, CAST(l_quantity AS BIGINT) DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
WHERE rn = 1
""")
oracle("canonical_stock", """
SELECT date, replace(ticker, '.', '') AS symbol, min(l_extendedprice / l_quantity) AS open,
  max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
  CASE WHEN max(l_linestatus) = 'F' AND min(l_discount) = 0 THEN 0.0::DOUBLE ELSE max(l_extendedprice / l_quantity) END AS close,
  CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS count, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created
FROM v_lines GROUP BY date, ticker, l_shipdate
""")

# --- names, calendar, universe ------------------------------------------------------------------

oracle("symbol_map", "SELECT * FROM v_names")
oracle("universe_symbols", """
SELECT DISTINCT 'option' AS asset, replace(CASE WHEN ticker = 'Brand.7' THEN 'Brand.77' ELSE ticker END, '.', '') AS symbol
FROM v_universe WHERE ticker NOT IN ('Brand.9')
UNION ALL SELECT DISTINCT 'yahoo', replace(ticker, '.', '-') FROM v_universe
UNION ALL SELECT DISTINCT 'stock', ticker FROM v_universe
""")
oracle("windowed_prices", "SELECT date, symbol, close FROM v_spot WHERE date BETWEEN DATE '1994-06-01' AND DATE '1996-05-31'")
oracle("calendar", "SELECT date FROM v_calendar")
oracle("year_windows", """
SELECT y::INTEGER AS year, greatest(start_date, make_date(y, 1, 1)) AS "start", least(end_date, make_date(y, 12, 31)) AS "end"
FROM v_bounds, range(year(start_date), year(end_date) + 1) t(y)
""")
cte("v_changes", """
SELECT date AS effective_date, ticker, CASE WHEN l_returnflag = 'A' THEN 'Added' ELSE 'Removed' END AS action,
  l_linestatus AS security, l_returnflag AS reason
FROM v_lines WHERE l_returnflag IN ('A', 'R') AND l_tax <> 0
""")
oracle("constituent_changes", """
SELECT effective_date, ticker, action, security, reason, count(*) AS n FROM v_changes GROUP BY ALL
""")
oracle("current_constituents", """
SELECT DISTINCT replace(p_brand, '#', '.') AS ticker FROM part
""")
cte("v_kept", """
SELECT ticker, effective_date, max(action) AS action FROM v_changes
WHERE effective_date > (SELECT max(date) FROM v_calendar) OR effective_date IN (SELECT date FROM v_calendar)
GROUP BY ALL
""")
cte("v_today", "SELECT DISTINCT replace(p_brand, '#', '.') AS ticker FROM part")
oracle("universe", """
SELECT g.date, g.ticker, replace(g.ticker, '.', '') AS symbol
FROM (SELECT date, ticker FROM v_calendar, (SELECT ticker FROM v_kept UNION SELECT ticker FROM v_today)) g
ASOF LEFT JOIN v_kept k ON k.ticker = g.ticker AND g.date < k.effective_date
WHERE CASE WHEN k.action IS NULL THEN g.ticker IN (SELECT ticker FROM v_today) ELSE k.action = 'Removed' END
""")

# --- reference data ------------------------------------------------------------------------------

cte("v_earnings", """
SELECT symbol, CAST(ts AS DATE) AS date,
  CASE WHEN hour(ts) + minute(ts) / 60.0::DOUBLE >= 16 THEN 'amc' WHEN hour(ts) + minute(ts) / 60.0::DOUBLE < 9.5::DOUBLE THEN 'bmo' ELSE 'unknown' END AS session,
  ts AS announced_at, floor(value)::DOUBLE AS eps_estimate, value AS reported_eps, value - floor(value) AS surprise_pct
FROM (SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, ts, value,
        row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
""")
oracle("earnings", "SELECT * FROM v_earnings")
oracle("session_classes", """
SELECT session, count(*) AS n FROM (
  SELECT CASE WHEN hour(ts) + minute(ts) / 60.0::DOUBLE >= 16 THEN 'amc' WHEN hour(ts) + minute(ts) / 60.0::DOUBLE < 9.5::DOUBLE THEN 'bmo' ELSE 'unknown' END AS session
  FROM events) GROUP BY session
""")
oracle("corporate_actions", "SELECT symbol, date, action, value FROM v_actions")
oracle("tidy_prices", """
SELECT yahoo_symbol, date, yahoo_close, dividend, split FROM v_quotes
""")
oracle("rates", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, min(o_totalprice / 100.0::DOUBLE) AS rate
FROM orders GROUP BY ALL
""")
oracle("store_accumulate", """
SELECT date, symbol, rate * CASE WHEN symbol IN ('1-URGENT', '2-HIGH') THEN 2 ELSE 1 END AS rate FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, min(o_totalprice / 100.0::DOUBLE) AS rate FROM orders GROUP BY ALL)
""")
oracle("yields", """
SELECT date, tenor, min(close / 100.0::DOUBLE) AS "yield" FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS close,
    CASE o_orderpriority WHEN '1-URGENT' THEN '13w' WHEN '2-HIGH' THEN '5y' WHEN '3-MEDIUM' THEN '10y' WHEN '5-LOW' THEN '30y' END AS tenor
  FROM orders WHERE o_orderstatus <> 'P')
WHERE tenor IS NOT NULL GROUP BY ALL
""")
oracle("indices", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS symbol, min(o_totalprice) AS open, max(o_totalprice) AS high,
  min(o_totalprice) AS low, max(o_totalprice) AS close FROM orders GROUP BY ALL
""")
oracle("sectors", "SELECT ticker, replace(ticker, '.', '') AS symbol, sector, sub_industry FROM v_constituents")

# --- quality and repair --------------------------------------------------------------------------

cte("v_checks", """
SELECT n.year::INTEGER AS year, n.symbol, n.theta_days, coalesce(c.overlap_days, 0) AS overlap_days,
  round(c.return_correlation, 6) AS return_correlation, round(c.median_return_difference, 6) AS median_return_difference,
  c.action_gap_days::DOUBLE AS action_gap_days,
  CASE WHEN coalesce(c.overlap_days, 0) < 20 THEN 'thin_overlap' WHEN c.median_return_difference <= 0.001::DOUBLE THEN 'ok'
    WHEN c.median_return_difference >= 0.005::DOUBLE THEN 'wrong_instrument' ELSE 'suspect' END AS status
FROM (SELECT year(date) AS year, symbol, count(*) AS theta_days FROM v_spot GROUP BY ALL) n
LEFT JOIN (
  SELECT year, symbol, count(*) AS overlap_days, corr(a, b) AS return_correlation, median(abs(a - b)) AS median_return_difference,
    count(*) FILTER (abs(a - b) > 0.05::DOUBLE) AS action_gap_days
  FROM (SELECT s.symbol, year(s.date) AS year, ln(s.close) - lag(ln(s.close)) OVER w AS a,
          ln(q.yahoo_close) - lag(ln(q.yahoo_close)) OVER w AS b
        FROM v_spot s JOIN v_names n ON n.option_symbol = s.symbol
        JOIN v_quotes q ON q.yahoo_symbol = n.yahoo_symbol AND q.date = s.date
        WINDOW w AS (PARTITION BY s.symbol, year(s.date) ORDER BY s.date))
  WHERE abs(a) < 0.3::DOUBLE AND abs(b) < 0.3::DOUBLE GROUP BY ALL) c
ON c.year = n.year AND c.symbol = n.symbol
""")
oracle("symbology_check", "SELECT * FROM v_checks")
oracle("symbology_status", "SELECT year, status, count(*) AS symbols FROM v_checks GROUP BY ALL")
oracle("stored_spots", """
SELECT symbol, date, median(underlying) AS theta_spot FROM v_chain WHERE underlying > 0 GROUP BY ALL
""")
cte("v_unquoted", """
SELECT symbol, date, quoted FROM (
  SELECT symbol, date, avg((ask > 0)::INTEGER) AS quoted FROM v_chain
  WHERE underlying > 0 AND abs(strike / underlying - 1.0::DOUBLE) <= 0.02::DOUBLE
    AND date_diff('day', date, expiration) BETWEEN 7 AND 60 GROUP BY ALL)
WHERE quoted < 0.5::DOUBLE
""")
oracle("unquoted_sessions", "SELECT symbol, date, quoted FROM v_unquoted")
oracle("repair_tasks", """
SELECT DISTINCT c.symbol, c.date, c.expiration FROM v_chain c JOIN v_unquoted u ON u.symbol = c.symbol AND u.date = c.date
""")
cte("v_patch", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date, expiration, strike, "right" ORDER BY bar_stamp DESC) AS rn FROM v_bars)
WHERE rn = 1 AND ask > 0
""")
oracle("repair_patch", """
SELECT date, symbol, CAST(expiration AS DATE) AS expiration, strike, CASE WHEN "right" = 'CALL' THEN 'C' ELSE 'P' END AS "right",
  bid AS bid_new, ask AS ask_new, CASE WHEN abs(iv_error) <= 1 AND implied_vol > 0 THEN implied_vol END AS iv_new,
  vega * 0.01::DOUBLE AS vega_new, underlying_price AS underlying_new, spot_stamp AS underlying_timestamp_new
FROM v_patch
""")
oracle("repaired_chain", """
SELECT c.date, c.symbol, c.expiration, c.strike, c."right", CASE WHEN p.ask IS NOT NULL THEN p.bid ELSE c.bid END AS bid,
  CASE WHEN p.ask IS NOT NULL THEN p.ask ELSE c.ask END AS ask,
  (CASE WHEN p.ask IS NOT NULL THEN p.bid ELSE c.bid END + CASE WHEN p.ask IS NOT NULL THEN p.ask ELSE c.ask END) / 2 AS mid,
  CASE WHEN p.ask IS NOT NULL THEN CASE WHEN abs(p.iv_error) <= 1 AND p.implied_vol > 0 THEN p.implied_vol END ELSE c.iv END AS iv,
  CASE WHEN p.ask IS NULL THEN c.gamma END AS gamma, CASE WHEN p.ask IS NOT NULL THEN p.vega * 0.01::DOUBLE ELSE c.vega END AS vega
FROM v_chain c LEFT JOIN v_patch p ON p.symbol = c.symbol AND p.date = c.date AND CAST(p.expiration AS DATE) = c.expiration
  AND p.strike = c.strike AND p."right" = CASE WHEN c."right" = 'C' THEN 'CALL' ELSE 'PUT' END
""")

# --- risk model ------------------------------------------------------------------------------------

SPEC_WINDOW, SPEC_FLOOR = 250, 120


def trailing(expr: str, keys: str, n: int = SPEC_WINDOW) -> str:
    return f"{expr} OVER (PARTITION BY {keys} ORDER BY date ROWS {n - 1} PRECEDING)"


cte("v_factors", f"""
SELECT date, 'market' AS factor, pnl_per_vega AS ret FROM v_market_returns WHERE pnl_per_vega IS NOT NULL
UNION ALL
SELECT date, sector, raw - raw_mean - beta * (market - market_mean) FROM (
  SELECT date, sector, raw, market, {trailing('count(raw)', 'sector')} AS n, {trailing('avg(raw)', 'sector')} AS raw_mean,
    {trailing('avg(market)', 'sector')} AS market_mean,
    {trailing('covar_samp(raw, market)', 'sector')} / {trailing('var_samp(market)', 'sector')} AS beta
  FROM (SELECT r.date, s.sector, sum(pnl_per_vega * dollar_vega) / sum(dollar_vega) AS raw
        FROM v_returns r JOIN v_supplier_sectors s USING (symbol)
        WHERE pnl_per_vega IS NOT NULL AND dollar_vega > 0 GROUP BY ALL)
  JOIN (SELECT date, pnl_per_vega AS market FROM v_market_returns WHERE pnl_per_vega IS NOT NULL) USING (date))
WHERE n >= {SPEC_FLOOR}
""")
# two regressors by partialling out: regress the second on the first, then the target on what is left
cte("v_loading_moments", f"""
SELECT date, symbol, sector, {trailing('count(y)', 'symbol')} AS n, {trailing('var_samp(y)', 'symbol')} AS vy,
  {trailing('covar_samp(y, m)', 'symbol')} / {trailing('var_samp(m)', 'symbol')} AS ym,
  {trailing('covar_samp(s, m)', 'symbol')} / {trailing('var_samp(m)', 'symbol')} AS sm,
  {trailing('covar_samp(y, m)', 'symbol')} AS cym, {trailing('covar_samp(y, s)', 'symbol')} AS cys,
  {trailing('covar_samp(s, m)', 'symbol')} AS csm, {trailing('var_samp(s)', 'symbol')} AS vs
FROM (
  SELECT r.date, r.symbol, g.sector, r.pnl_per_vega AS y, m.ret AS m, f.ret AS s
  FROM v_returns r LEFT JOIN v_supplier_sectors g USING (symbol)
  JOIN (SELECT date, ret FROM v_factors WHERE factor = 'market') m ON m.date = r.date
  LEFT JOIN v_factors f ON f.date = r.date AND f.factor = g.sector
  WHERE r.pnl_per_vega IS NOT NULL AND (g.sector IS NULL OR f.ret IS NOT NULL))
""")
cte("v_fits", f"""
SELECT date, symbol, sector, CASE WHEN sector IS NULL THEN ym ELSE ym - b2 * sm END AS b1, b2,
  sqrt(CASE WHEN sector IS NULL THEN (vy - ym * cym) * (n - 1) / (n - 2)
    ELSE (vy - ym * cym - b2 * (cys - ym * csm)) * (n - 1) / (n - 3) END) AS idio_vol
FROM (SELECT *, (cys - ym * csm) / (vs - sm * csm) AS b2 FROM v_loading_moments WHERE n >= {SPEC_FLOOR})
""")
cte("v_dense", """
SELECT date, factor, coalesce(ret, 0.0::DOUBLE) AS ret
FROM (SELECT DISTINCT date FROM v_factors) CROSS JOIN (SELECT DISTINCT factor FROM v_factors) LEFT JOIN v_factors USING (date, factor)
""")
cte("v_sample_cov", f"""
SELECT date, factor_1, factor_2, n, cov FROM (
  SELECT a.date AS date, a.factor AS factor_1, b.factor AS factor_2,
    count(*) OVER w AS n, covar_samp(a.ret, b.ret) OVER w AS cov
  FROM v_dense a JOIN v_dense b ON a.date = b.date
  WINDOW w AS (PARTITION BY a.factor, b.factor ORDER BY a.date ROWS {SPEC_WINDOW - 1} PRECEDING))
WHERE n >= {SPEC_FLOOR}
""")
cte("v_shrink", """
SELECT date, mu, least(square / n, delta) / delta AS rho FROM (
  SELECT date, mu, max(n) AS n, sum(cov * cov) AS square,
    sum((cov - CASE WHEN factor_1 = factor_2 THEN mu ELSE 0 END) * (cov - CASE WHEN factor_1 = factor_2 THEN mu ELSE 0 END)) AS delta
  FROM v_sample_cov JOIN (SELECT date, avg(cov) AS mu FROM v_sample_cov WHERE factor_1 = factor_2 GROUP BY date) USING (date)
  GROUP BY ALL)
""")
oracle("sector_means", """
SELECT r.date, s.sector, round(sum(pnl_per_vega * dollar_vega) / sum(dollar_vega), 6) AS raw
FROM v_returns r JOIN v_supplier_sectors s USING (symbol) WHERE pnl_per_vega IS NOT NULL AND dollar_vega > 0 GROUP BY ALL
""")
oracle("factor_returns", "SELECT date, factor, round(ret, 6) AS ret FROM v_factors")
oracle("factor_loadings", """
SELECT date, symbol, 'market' AS factor, round(b1, 6) AS loading FROM v_fits
UNION ALL SELECT date, symbol, sector, round(b2, 6) FROM v_fits WHERE sector IS NOT NULL
""")
oracle("idio_vol", "SELECT date, symbol, round(idio_vol, 6) AS idio_vol FROM v_fits")
oracle("factor_covariances", """
SELECT date, factor_1, factor_2, round((1 - rho) * cov + CASE WHEN factor_1 = factor_2 THEN rho * mu ELSE 0 END, 6) AS covariance
FROM v_sample_cov JOIN v_shrink USING (date)
""")
oracle("sample_covariances", "SELECT date, factor_1, factor_2, round(cov, 6) AS covariance FROM v_sample_cov")
oracle("dense_factors", "SELECT date, factor, round(ret, 6) AS ret FROM v_dense")

# --- least squares in sums -------------------------------------------------------------------------


def solve3_sql(rows: str, keep: str) -> str:
    """Three slopes and a constant from centred sums c11..c33, c1y..c3y, cyy, means m1..m3, my."""
    return f"""
SELECT {keep}, b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, cyy - b1 * c1y - b2 * c2y - b3 * c3y AS rss FROM (
  SELECT *, (c2y - e23 * b3 - c12 / c11 * c1y) / d22 AS b2,
    (c1y - c12 * ((c2y - e23 * b3 - c12 / c11 * c1y) / d22) - c13 * b3) / c11 AS b1
  FROM (
    SELECT *, (f3 - e23 / d22 * f2) / (e33 - e23 / d22 * e23) AS b3 FROM (
      SELECT *, c22 - c12 / c11 * c12 AS d22, c23 - c12 / c11 * c13 AS e23, c33 - c13 / c11 * c13 AS e33,
        c2y - c12 / c11 * c1y AS f2, c3y - c13 / c11 * c1y AS f3
      FROM ({rows}))))
"""


SUMS = "s1 s2 s3 sy s11 s12 s13 s22 s23 s33 s1y s2y s3y syy".split()
CENTRED = ", ".join(
    [f"s{i} / n AS m{i}" for i in "123y"]
    + [f"s{i}{j} - s{i} * s{j} / n AS c{i}{j}" for i, j in ("11", "12", "13", "22", "23", "33", "1y", "2y", "3y", "yy")]
)


def sums_sql(x1: str, x2: str, x3: str, y: str, when: str = "TRUE") -> str:
    v = {"1": x1, "2": x2, "3": x3, "y": y}
    parts = [f"count(*) FILTER ({when}) AS n"]
    for s in SUMS:
        parts.append(f"sum({' * '.join(v[i] for i in s[1:])}) FILTER ({when}) AS {s}")
    return ", ".join(parts)


# --- forecast ----------------------------------------------------------------------------------------

FIT_ROWS = 1000
cte("v_har_rows", """
SELECT date, symbol, in_fit, ln(rv_1) AS x1, ln(rv_5) AS x2, ln(rv_22) AS x3, CASE WHEN rv_fwd > 0 THEN ln(rv_fwd * rv_fwd) END AS y
FROM (SELECT *, TRUE AS in_fit FROM v_rv UNION ALL SELECT *, FALSE FROM v_market_rv)
WHERE rv_1 > 0 AND rv_5 > 0 AND rv_22 > 0
""")
cte("v_har_sessions", """
SELECT date, row_number() OVER (ORDER BY date) AS pos,
  date = min(date) OVER (PARTITION BY date_trunc('month', date)) AS refit FROM (SELECT DISTINCT date FROM v_har_rows)
""")
cte("v_har_daily", f"""
SELECT date, {sums_sql('x1', 'x2', 'x3', 'y', 'in_fit AND y IS NOT NULL')} FROM v_har_rows GROUP BY date
""")
cte("v_har_train", f"""
SELECT r.date, sum(d.n) AS n, {', '.join(f'sum(d.{s}) AS {s}' for s in SUMS)}
FROM (SELECT * FROM v_har_sessions WHERE refit AND pos > 60) r
JOIN v_har_sessions p ON p.pos <= r.pos - 60 JOIN v_har_daily d ON d.date = p.date
GROUP BY r.date HAVING sum(d.n) >= {FIT_ROWS}
""")
cte("v_har_fits", solve3_sql(f"SELECT date, n, {CENTRED} FROM v_har_train", "date, n"))
cte("v_forecast", """
SELECT r.date, r.symbol, sqrt(exp(b0 + b1 * x1 + b2 * x2 + b3 * x3 + rss / n / 2)) AS rv_fcst
FROM v_har_rows r ASOF JOIN v_har_fits f ON r.date >= f.date
""")
oracle("refit_dates", "SELECT min(date) AS date FROM v_calendar GROUP BY date_trunc('month', date)")
oracle("har_coefficients", """
SELECT date, n::BIGINT AS rows, round(b0, 5) AS const, round(rss / n, 5) AS residual_var, round(b1, 5) AS b_rv_1,
  round(b2, 5) AS b_rv_5, round(b3, 5) AS b_rv_22 FROM v_har_fits
""")
oracle("latest_fit", """
SELECT date, n::BIGINT AS rows, round(b0, 5) AS const, round(rss / n, 5) AS residual_var, round(b1, 5) AS b_rv_1,
  round(b2, 5) AS b_rv_5, round(b3, 5) AS b_rv_22 FROM v_har_fits WHERE date = (SELECT max(date) FROM v_har_fits)
""")
oracle("har_forecast", "SELECT date, symbol, round(rv_fcst, 6) AS rv_fcst FROM v_forecast")

# --- signals -------------------------------------------------------------------------------------------

MIN_NAMES = 8
cte("v_vrp", """
SELECT s.date, s.symbol, ln(iv60) - ln(rv_fcst) AS vrp FROM v_surface s JOIN v_forecast f ON f.date = s.date AND f.symbol = s.symbol
WHERE iv60 > 0 AND rv_fcst > 0
""")
cte("v_vrp_frame", """
SELECT v.date, v.symbol, v.vrp, f.beta * coalesce(m.vrp, avg(v.vrp) OVER (PARTITION BY v.date)) AS x1,
  median(v.vrp) OVER (PARTITION BY v.date, g.sector) AS x2, f.idio_vol AS x3
FROM v_vrp v LEFT JOIN v_features f ON f.date = v.date AND f.symbol = v.symbol
LEFT JOIN v_brand_sectors g ON g.symbol = v.symbol LEFT JOIN v_vrp m ON m.date = v.date AND m.symbol = 'SPX'
WHERE v.symbol <> 'SPX'
""")
cte("v_vrp_clean", "SELECT * FROM v_vrp_frame WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL")
cte("v_vrp_sums", f"SELECT date, {sums_sql('x1', 'x2', 'x3', 'vrp')} FROM v_vrp_clean GROUP BY date HAVING count(*) >= {MIN_NAMES}")
cte("v_vrp_fits", solve3_sql(f"SELECT date, n, {CENTRED} FROM v_vrp_sums", "date, n"))
cte("v_residuals", """
SELECT c.date, c.symbol, vrp - (b0 + b1 * x1 + b2 * x2 + b3 * x3) AS residual FROM v_vrp_clean c JOIN v_vrp_fits f ON f.date = c.date
""")
CLIP = "least(greatest({0}, -3), 3)"
cte("v_vrp_score", f"""
SELECT date, symbol, {CLIP.format('(smooth - avg(smooth) OVER d) / stddev_samp(smooth) OVER d')} AS score
FROM (SELECT date, symbol, avg(residual) OVER (PARTITION BY symbol ORDER BY date ROWS 4 PRECEDING) AS smooth FROM v_residuals)
WINDOW d AS (PARTITION BY date)
""")
cte("v_iv_score", f"""
SELECT date, symbol, {CLIP.format('(level - mean) / std')} AS score FROM (
  SELECT date, symbol, level, count(level) OVER w AS n, avg(level) OVER w AS mean, stddev_samp(level) OVER w AS std
  FROM (SELECT date, symbol, ln(iv60) AS level FROM v_surface WHERE symbol <> 'SPX' AND iv60 > 0)
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 249 PRECEDING))
WHERE n >= 120 AND std > 0
""")
cte("v_momentum", f"""
SELECT date, symbol, {CLIP.format('-(past - avg(past) OVER d) / stddev_samp(past) OVER d')} AS score
FROM (SELECT *, count(*) OVER (PARTITION BY date) AS names FROM (
  SELECT date, symbol, CASE WHEN count(pnl_per_vega) OVER w >= 63 THEN sum(pnl_per_vega) OVER w END AS past
  FROM v_returns
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 146 PRECEDING AND 21 PRECEDING)) WHERE past IS NOT NULL)
WHERE names >= {MIN_NAMES}
WINDOW d AS (PARTITION BY date)
""")
cte("v_signals", """
SELECT date, symbol, 'vrp' AS signal, score FROM v_vrp_score
UNION ALL SELECT date, symbol, 'iv_zscore', score FROM v_iv_score
UNION ALL SELECT date, symbol, 'momentum', score FROM v_momentum
""")
oracle("variance_premium", "SELECT date, symbol, round(vrp, 6) AS vrp FROM v_vrp")
oracle("sector_medians", """
SELECT v.date, g.sector, round(median(v.vrp), 6) AS sector_median
FROM v_vrp v LEFT JOIN v_brand_sectors g ON g.symbol = v.symbol WHERE v.symbol <> 'SPX' GROUP BY v.date, g.sector
""")
oracle("vrp_residuals", "SELECT date, symbol, round(residual, 6) AS residual FROM v_residuals")
oracle("signal_vrp", "SELECT date, symbol, round(score, 6) AS score FROM v_vrp_score")
oracle("signal_iv_zscore", "SELECT date, symbol, round(score, 6) AS score FROM v_iv_score")
oracle("signal_momentum", "SELECT date, symbol, round(score, 6) AS score FROM v_momentum")
oracle("signals", "SELECT date, symbol, signal, round(score, 5) AS score FROM v_signals")
oracle("signal_summary", """
SELECT signal, count(*) AS rows, min(date) AS first, max(date) AS last FROM v_signals GROUP BY signal
""")

# --- the store -----------------------------------------------------------------------------------------

oracle("store_round_trip", """
SELECT date, symbol, close, year(date)::INTEGER AS year, NULL::DOUBLE AS volume FROM v_spot
""")
oracle("store_pending", """
SELECT y::INTEGER AS year FROM v_bounds, range(year(start_date) - 1, year(end_date) + 3) t(y)
WHERE y NOT IN (SELECT year(date) FROM v_spot)
""")
oracle("price_union", """
SELECT symbol, source, count(*) AS days, round(sum(close), 2) AS total FROM (
  SELECT symbol, 'trades' AS source, close FROM v_spot UNION ALL SELECT symbol, 'market', close FROM v_market)
GROUP BY ALL
""")


oracle("stored_window", """
SELECT date, symbol, close, year(date)::INTEGER AS year FROM v_spot WHERE date BETWEEN DATE '1994-06-01' AND DATE '1996-05-31'
""")
oracle("bucketed_premium", "SELECT date, symbol, round(vrp, 6) AS vrp FROM v_vrp")
NO_EXTRAS = "charm vomma veta vera speed zomma color ultima d1 d2 dual_delta dual_gamma open high low close".split()
NO_COUNTS = "count bid_exchange bid_condition ask_size ask_exchange ask_condition".split()
cte("v_ingested", f"""
WITH landed AS (SELECT *, year(CAST(stamp AS DATE)) - CAST(CAST(stamp AS DATE) = min(CAST(stamp AS DATE)) OVER (PARTITION BY symbol, year(stamp)) AS INTEGER) AS year
  FROM v_vendor)
SELECT CAST(stamp AS DATE) AS date, symbol, CAST(expiration AS DATE) AS expiration, strike,
  CASE WHEN "right" = 'CALL' THEN 'C' ELSE 'P' END AS "right", bid, ask, (bid + ask) / 2.0::DOUBLE AS mid,
  CASE WHEN abs(iv_error) <= 1 AND implied_vol > 0 THEN implied_vol END AS iv, delta, gamma, theta, vega * 0.01::DOUBLE AS vega,
  underlying_price AS underlying, volume, implied_vol, iv_error, 0.1::DOUBLE AS rho, 0.2::DOUBLE AS epsilon, 0.3::DOUBLE AS lambda,
  CASE WHEN year >= 1996 THEN strike / 2 END AS vanna, {", ".join(f"NULL::DOUBLE AS {c}" for c in NO_EXTRAS)},
  {", ".join(f"NULL::BIGINT AS {c}" for c in NO_COUNTS)}, 0::BIGINT AS bid_size,
  strftime(stamp, '%Y-%m-%d %H:%M:%S') AS "timestamp", strftime(stamp, '%Y-%m-%d %H:%M:%S') AS underlying_timestamp, year::INTEGER AS year
FROM landed
""")
_SUMS = (
    "strike bid ask mid iv delta gamma theta vega underlying volume implied_vol iv_error rho epsilon lambda vanna bid_size".split()
    + NO_EXTRAS + NO_COUNTS
)
_ENDS = ["expiration", '"right"', '"timestamp"', "underlying_timestamp"]
oracle("ingested_chain", f"""
SELECT symbol, year, date, count(*) AS n, {", ".join(f'round(sum("{c}"::DOUBLE), 3) AS "{c}"' for c in _SUMS)},
  count(iv) AS n_iv, count(vanna) AS n_vanna,
  {", ".join(f"min({c}) AS first_{c.strip(chr(34))}, max({c}) AS last_{c.strip(chr(34))}" for c in _ENDS)}
FROM v_ingested GROUP BY symbol, year, date
""")
oracle("pending_paths", """
SELECT date, symbol, round(pnl_per_vega, 6) AS pnl_per_vega, round(cost_per_vega, 6) AS cost_per_vega,
  round(exit_cost_per_vega, 6) AS exit_cost_per_vega, round(dollar_vega, 6) AS dollar_vega,
  round(CASE WHEN symbol LIKE '%1' THEN -entry_vega ELSE entry_vega END, 6) AS entry_vega, round(dollar_theta, 6) AS dollar_theta,
  round(mid, 6) AS mid, round(underlying, 6) AS underlying, dte::DOUBLE AS dte, event FROM v_path
""")
oracle("har_instalments", ORACLES["har_coefficients"])
oracle("migrated_tables", """
SELECT 'universe' AS "table", replace(ticker, '.', '') AS symbol, year(date)::INTEGER AS year, count(*) AS n FROM v_universe GROUP BY ALL
UNION ALL SELECT 'calendar', '', year(date)::INTEGER, count(*) FROM (SELECT DISTINCT date FROM v_universe) GROUP BY ALL
UNION ALL SELECT 'rates', symbol, year(date)::INTEGER, count(*) FROM (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol FROM orders) GROUP BY ALL
""")
oracle("session_window", """
SELECT date, year(date) < 1995 AS has_prices FROM v_calendar WHERE date BETWEEN DATE '1994-06-01' AND DATE '1996-05-31'
""")
oracle("write_order", """
SELECT date, symbol, row_number() OVER (ORDER BY date, symbol) - 1 AS place FROM (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol FROM orders)
""")


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLES.items()}
