"""The panel's input tables in SQL, for the equivalents that DuckDB runs."""

from __future__ import annotations

BARS = """bars AS (
SELECT user_id, trade_date, series, o, h, l, c, volume, turnover,
       concat('INE', lpad(CAST(user_id AS VARCHAR), 4, '0'), '01',
              CASE WHEN day(trade_date) <= 10 THEN '01' WHEN day(trade_date) <= 20 THEN '02' ELSE '03' END, '0') AS isin,
       concat('SYM', CAST(user_id AS VARCHAR)) AS symbol,
       lag(c) OVER (PARTITION BY user_id ORDER BY trade_date)
         * CASE WHEN user_id % 17 = 0 AND day(trade_date) = 15 THEN 1.02::DOUBLE ELSE 1.0::DOUBLE END AS prev_close
FROM (SELECT user_id, CAST(ts AS DATE) AS trade_date,
             CASE user_id % 5 WHEN 0 THEN 'BE' WHEN 1 THEN 'SM' ELSE 'EQ' END AS series,
             min_by(value, ts) AS o, max(value) AS h, min(value) AS l, max_by(value, ts) AS c,
             CAST(count(*) AS BIGINT) AS volume, sum(value) AS turnover
      FROM events WHERE event_type IN ('view', 'click', 'error')
      GROUP BY user_id, CAST(ts AS DATE), CASE user_id % 5 WHEN 0 THEN 'BE' WHEN 1 THEN 'SM' ELSE 'EQ' END) b)"""

ACTIONS = """actions AS (
SELECT event_id, user_id, concat('SYM', CAST(user_id AS VARCHAR)) AS symbol, CAST(ts AS DATE) AS ex_date,
       CASE WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'SPECIAL_DIVIDEND'
            WHEN event_type = 'purchase' THEN 'DIVIDEND'
            WHEN event_id % 3 = 0 THEN 'BONUS' WHEN event_id % 3 = 1 THEN 'SPLIT' ELSE 'RIGHTS' END AS type,
       CAST(CASE WHEN event_type = 'signup' AND event_id % 3 = 1 THEN 10 ELSE 1 + event_id % 3 END AS BIGINT) AS ratio_num,
       CAST(1 + event_id % 5 AS BIGINT) AS ratio_den,
       value / 2 AS sub_price, value * 0.01::DOUBLE AS div_amount, ts AS learned_at
FROM events WHERE event_type IN ('signup', 'purchase') AND event_id % 7 = 3)"""

PRICED = """anchored AS (
SELECT a.*, (SELECT max_by(b.c, b.trade_date) FROM bars b WHERE b.user_id = a.user_id AND b.trade_date < a.ex_date) AS anchor
FROM actions a),
formed AS (
SELECT *, CASE type
  WHEN 'BONUS' THEN ratio_den::DOUBLE / (ratio_den + ratio_num)
  WHEN 'SPLIT' THEN ratio_den::DOUBLE / ratio_num
  WHEN 'RIGHTS' THEN CASE WHEN sub_price >= 0 AND anchor > 0 THEN CASE WHEN sub_price > anchor THEN 1.0::DOUBLE
       ELSE (1 + (ratio_num::DOUBLE / ratio_den) * sub_price / anchor) / (1 + ratio_num::DOUBLE / ratio_den) END END
  WHEN 'SPECIAL_DIVIDEND' THEN CASE WHEN anchor > 0 AND div_amount >= 0 AND div_amount < anchor THEN (anchor - div_amount) / anchor END
  ELSE 1.0::DOUBLE END AS f
FROM anchored),
priced AS (
SELECT event_id, user_id, symbol, ex_date, type, ratio_num, ratio_den, sub_price, div_amount, learned_at, anchor,
  CASE WHEN f BETWEEN 1e-6 AND 1000 THEN f END AS factor_price,
  CASE WHEN f BETWEEN 1e-6 AND 1000 THEN CASE type WHEN 'BONUS' THEN (ratio_den + ratio_num)::DOUBLE / ratio_den
       WHEN 'SPLIT' THEN ratio_num::DOUBLE / ratio_den ELSE 1.0::DOUBLE END END AS factor_vol,
  CASE WHEN type = 'DIVIDEND' THEN 'not_applicable'
       WHEN type IN ('RIGHTS', 'SPECIAL_DIVIDEND') AND anchor IS NULL THEN 'needs_anchor'
       WHEN type = 'RIGHTS' AND anchor > 0 AND sub_price > anchor THEN 'skipped_s_gt_p'
       WHEN f BETWEEN 1e-6 AND 1000 THEN 'computed' ELSE 'unresolved' END AS state
FROM formed)"""

EDGED = """live AS (
SELECT p.*, CASE WHEN type = 'DIVIDEND' THEN
         CASE WHEN div_amount >= 0 AND anchor > 0 AND div_amount < anchor THEN (anchor - div_amount) / anchor ELSE 1.0::DOUBLE END
       ELSE coalesce(factor_price, 1.0::DOUBLE) END AS factor_tr
FROM priced p JOIN (SELECT user_id, max(trade_date) AS edge FROM bars GROUP BY user_id) e USING (user_id)
WHERE state IN ('computed', 'not_applicable', 'skipped_s_gt_p') AND ex_date <= edge),
gold AS (
SELECT b.*,
  coalesce((SELECT product(x.factor_price) FROM live x WHERE x.user_id = b.user_id AND x.ex_date > b.trade_date), 1.0::DOUBLE) AS cum_factor,
  coalesce((SELECT product(x.factor_vol) FROM live x WHERE x.user_id = b.user_id AND x.ex_date > b.trade_date), 1.0::DOUBLE) AS cum_factor_vol,
  coalesce((SELECT product(x.factor_tr) FROM live x WHERE x.user_id = b.user_id AND x.ex_date > b.trade_date), 1.0::DOUBLE) AS cum_factor_tr
FROM bars b)"""

PART_BARS = """part_bars AS (
SELECT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS trade_date,
       CASE l_returnflag WHEN 'A' THEN 'EQ' WHEN 'N' THEN 'BE' ELSE 'SM' END AS series,
       max(l_extendedprice / l_quantity) AS h, min(l_extendedprice / l_quantity) AS l,
       sum(l_extendedprice) / sum(l_quantity) AS c,
       CAST(sum(l_quantity) AS BIGINT) AS volume, sum(l_extendedprice) AS turnover
FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE), l_returnflag)"""

PURPOSES = """purposes AS (
SELECT o_orderkey, CAST(1 + o_orderkey % 10 AS BIGINT) AS face_value, CAST(o_orderkey % 12 AS BIGINT) AS tmpl,
  CASE o_orderkey % 12
    WHEN 0 THEN concat('Bonus ', 1 + o_orderkey % 4, ':', 1 + o_orderkey % 3)
    WHEN 1 THEN concat('Rights ', 1 + o_orderkey % 4, ':', 1 + o_orderkey % 7, ' @ Premium Rs ', o_orderkey % 50, '/-')
    WHEN 2 THEN concat('Face Value Split (Sub-Division) - From Rs 10/- Per Share To Rs ', 1 + o_orderkey % 5, '/- Per Share')
    WHEN 3 THEN concat('Dividend - Rs ', 1 + o_orderkey % 9, ' Per Share')
    WHEN 4 THEN concat('Interim Dividend - Re 0.', 1 + o_orderkey % 9, ' Per Share')
    WHEN 5 THEN concat('Annual General Meeting/Dividend - Rs ', 1 + o_orderkey % 9, ' Per Share/Special Dividend - Rs ', 1 + o_orderkey % 6, ' Per Share')
    WHEN 6 THEN concat('Scheme Of Arrangement - Bonus Ncrps ', 1 + o_orderkey % 4, ':1')
    WHEN 7 THEN 'Demerger'
    WHEN 8 THEN 'Annual General Meeting'
    WHEN 9 THEN concat('Annual General Meetingdividend - Rs ', 1 + o_orderkey % 9, ' Per Share')
    WHEN 10 THEN concat('Interim Dividend - Rs 8 Per Share Special Dividend - Rs ', 1 + o_orderkey % 60, ' Per Share')
    ELSE 'Buy Back' END AS purpose
FROM orders)"""

SWITCHES = """daily AS (
SELECT * FROM bars WHERE substr(isin, 8, 2) = '01'
QUALIFY row_number() OVER (PARTITION BY symbol, trade_date ORDER BY (series = 'EQ') DESC, volume DESC NULLS LAST, series) = 1),
lagged AS (
SELECT *, lag(isin) OVER w AS old_isin, lag(c) OVER w AS prior_close, lag(trade_date) OVER w AS prior_date
FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)),
switched AS (
SELECT symbol, old_isin, isin AS new_isin, trade_date AS switch_date, prior_date, prior_close, prev_close, c AS close
FROM lagged WHERE old_isin <> isin AND date_diff('day', prior_date, trade_date) <= 10),
judged AS (
SELECT *, CASE WHEN prior_close <> 0 THEN abs((prev_close - prior_close) / prior_close) END AS gap,
  CASE WHEN prior_close <> 0 AND abs((prev_close - prior_close) / prior_close) <= 0.001 THEN 'accepted' ELSE 'rejected_gap' END AS status
FROM switched)"""

SPANS = """seen AS (
SELECT isin, symbol, min(trade_date) AS first_seen, max(trade_date) AS last_seen, CAST(count(*) AS BIGINT) AS bars
FROM bars GROUP BY isin, symbol)"""


def with_tables(*tables: str) -> str:
    """The WITH clause of some tables; a later one may use an earlier one. RECURSIVE is harmless where nothing recurs."""
    return "WITH RECURSIVE " + ",\n".join(tables) + "\n"


E_ = with_tables(BARS)
EA = with_tables(BARS, ACTIONS)
EAP = with_tables(BARS, ACTIONS, PRICED)
GOLD = with_tables(BARS, ACTIONS, PRICED, EDGED)
L_ = with_tables(PART_BARS)
P_ = with_tables(PURPOSES)
LINKS = with_tables(BARS, ACTIONS, SWITCHES, SPANS)
