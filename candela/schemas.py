"""Fixed values of the domain: event types, states, thresholds, canonical columns."""

from __future__ import annotations

# Event types by what they do to prices.
PRICE_ADJUSTING = ("BONUS", "SPLIT", "FACE_VALUE_CHANGE", "RIGHTS", "SPECIAL_DIVIDEND", "RETURN_OF_CAPITAL")
DIVIDEND_TYPES = ("DIVIDEND", "INTERIM_DIVIDEND", "SPECIAL_DIVIDEND")
ORDINARY_DIVIDENDS = ("DIVIDEND", "INTERIM_DIVIDEND")
NEEDS_EXTERNAL = ("DEMERGER", "SPINOFF", "CAPITAL_REDUCTION", "REDEMPTION")
NON_ADJUSTING = ("AGM", "EGM", "INTEREST_PAYMENT", "BUYBACK", "NO_ADJUST", "BONUS_PREFERENCE", "SCHEME_OF_ARRANGEMENT")
# States of a factor, and those whose factors enter the panel.
STATES = ("pending", "computed", "not_applicable", "skipped_s_gt_p", "needs_anchor", "unresolved")
MULTIPLYING_STATES = ("computed", "not_applicable", "skipped_s_gt_p")
RETRY_STATES = ("pending", "needs_anchor")
# Thresholds.
FACTOR_LOW, FACTOR_HIGH = 1e-6, 1000.0
PREV_CLOSE_TOLERANCE = 0.005
CONTINUITY_TOLERANCE = 0.001
JUMP, JUMP_FLOOR = 0.25, 5.0
ADJACENT_DAYS, PRIOR_DAYS, STEM_DAYS, STALE_DAYS = 7, 10, 120, 90
ROWCOUNT_SIGMA, ROWCOUNT_FLOOR, ADV_WINDOW = 4.0, 1000, 20
MAX_CHAIN = 20
# Series that the panel and the universe take.
PANEL_SERIES = ("EQ", "BE", "BZ", "T2T", "SM", "ST")
UNIVERSE_SERIES = ("EQ", "SM", "ST")

#: Canonical bar columns in order.
BAR_SCHEMA = (
    "trade_date date, isin string, symbol string, series string, o double, h double, l double, c double, "
    "last_price double, prev_close double, volume bigint, turnover double, trades bigint, instrument_type string"
)
EVENT_SCHEMA = (
    "event_uid string, isin string, symbol string, ex_date date, type string, component_ix int, ratio_num decimal(24,8), "
    "ratio_den decimal(24,8), premium decimal(24,8), sub_price decimal(24,8), div_amount decimal(20,6), is_special boolean, "
    "parsed_ok boolean, confidence string, review_reason string, raw_text string, learned_at timestamp"
)
FINDING_SCHEMA = "check_name string, severity string, isin string, symbol string, detail string, metrics string"
EOD_COLUMNS = ("o", "h", "l", "c", "last_price", "prev_close", "volume", "turnover", "trades", "deliv_qty")
