"""Adjustment factors of corporate actions, as Column expressions.

Each function gives a struct of factor_price, factor_vol (double) and state. A
factor that cannot be formed has state ``unresolved`` and NULL values, and
never multiplies.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candela.schemas import FACTOR_HIGH, FACTOR_LOW, NEEDS_EXTERNAL, NON_ADJUSTING, ORDINARY_DIVIDENDS


def _number(c) -> Column:
    return c.cast("double") if isinstance(c, Column) else F.lit(c).cast("double")


def made(price: Column, volume: Column, valid: Column, state: str = "computed") -> Column:
    """The factor where it is valid and within the envelope, else unresolved."""
    inside = valid & price.between(FACTOR_LOW, FACTOR_HIGH)
    keep = lambda c: F.when(inside, c)
    return F.struct(
        keep(price).alias("factor_price"),
        keep(volume).alias("factor_vol"),
        F.when(inside, state).otherwise("unresolved").alias("state"),
    )


def neutral(state: str) -> Column:
    return F.struct(F.lit(1.0).alias("factor_price"), F.lit(1.0).alias("factor_vol"), F.lit(state).alias("state"))


def share_count(before, after) -> Column:
    before, after = _number(before), _number(after)
    return made(F.try_divide(before, after), F.try_divide(after, before), F.coalesce((before > 0) & (after > 0), F.lit(False)))


def bonus(new, held) -> Column:
    new, held = _number(new), _number(held)
    whole = held + new
    valid = F.coalesce((new > 0) & (held > 0), F.lit(False))
    return made(F.try_divide(held, whole), F.try_divide(whole, held), valid)


def split(old_value, new_value) -> Column:
    """By face values; a consolidation gives a factor above 1."""
    return share_count(new_value, old_value)


def _cash_out(price: Column, base: Column, cash: Column, valid: Column) -> Column:
    return made(F.try_divide(price, base), F.lit(1.0), F.coalesce(valid & (cash >= 0), F.lit(False)))


def cash(price, amount) -> Column:
    price, amount = _number(price), _number(amount)
    return _cash_out(price - amount, price, amount, (price > 0) & (amount < price))


def abnormal_cash(price, regular, special) -> Column:
    """Special cash on a day that also pays a regular dividend."""
    price, regular, special = _number(price), _number(regular), _number(special)
    base = price - regular
    return _cash_out(base - special, base, special, (price > 0) & (regular >= 0) & (base > 0) & (special < base))


def total_return(price, amount) -> Column:
    return cash(price, amount)


def rights(new, held, subscription, price) -> Column:
    """Theoretical ex-rights price; neutral where the offer is above the market."""
    new, held, subscription, price = (_number(c) for c in (new, held, subscription, price))
    per_share = F.try_divide(new, held)
    value = (1 + F.try_divide(per_share * subscription, price)) / (1 + per_share)
    valid = F.coalesce((new > 0) & (held > 0) & (subscription >= 0) & (price > 0), F.lit(False))
    return F.when(valid & (subscription > price), neutral("skipped_s_gt_p")).otherwise(made(value, F.lit(1.0), valid))


def spinoff(price, child_price, children_per_share) -> Column:
    price, child, per_share = _number(price), _number(child_price), _number(children_per_share)
    worth = child * per_share
    valid = F.coalesce((price > 0) & (child >= 0) & (per_share > 0) & (worth < price), F.lit(False))
    return made(1 - F.try_divide(worth, price), F.lit(1.0), valid)


def multi_spinoff(price, legs: Column) -> Column:
    """Several children; legs is an array of structs (child_price, per_share)."""
    price = _number(price)
    worth = F.aggregate(legs, F.lit(0.0), lambda total, leg: total + leg["child_price"] * leg["per_share"])
    sound = F.forall(legs, lambda leg: (leg["child_price"] >= 0) & (leg["per_share"] > 0))
    valid = F.coalesce((price > 0) & sound & (worth < price), F.lit(False))
    return made(1 - F.try_divide(worth, price), F.lit(1.0), valid)


def dispatch(
    type_: Column, num: Column, den: Column, subscription: Column, amount: Column, anchor: Column, same_day_regular: Column | None = None
) -> Column:
    """The factor of an event by its type; cash and rights wait for an anchor price."""
    special = cash(anchor, amount)
    if same_day_regular is not None:
        special = F.when(same_day_regular > 0, abnormal_cash(anchor, same_day_regular, amount)).otherwise(special)
    no_anchor = anchor.isNull()
    waiting = F.struct(
        F.lit(None).cast("double").alias("factor_price"), F.lit(None).cast("double").alias("factor_vol"), F.lit("needs_anchor").alias("state")
    )
    open_ = F.struct(F.lit(1.0).alias("factor_price"), F.lit(1.0).alias("factor_vol"), F.lit("unresolved").alias("state"))
    return (
        F.when(type_ == "BONUS", bonus(num, den))
        .when(type_.isin("SPLIT", "FACE_VALUE_CHANGE"), split(num, den))
        .when(type_.isin("RIGHTS", "SPECIAL_DIVIDEND", "RETURN_OF_CAPITAL") & no_anchor, waiting)
        .when(type_ == "RIGHTS", rights(num, den, subscription, anchor))
        .when(type_.isin("SPECIAL_DIVIDEND", "RETURN_OF_CAPITAL"), special)
        .when(type_.isin(*ORDINARY_DIVIDENDS, *NON_ADJUSTING), neutral("not_applicable"))
        .when(type_.isin(*NEEDS_EXTERNAL), open_)
        .otherwise(open_)
    )


def reinvested(type_: Column, factor_price: Column, amount: Column, anchor: Column) -> Column:
    """The total-return factor: ordinary dividends are reinvested, all else as in the price factor."""
    usable = (amount >= 0) & (anchor > 0) & (amount < anchor)
    ordinary = F.when(usable, (anchor - amount) / anchor).otherwise(1.0)
    return F.when(type_.isin(*ORDINARY_DIVIDENDS), ordinary).otherwise(F.coalesce(factor_price, F.lit(1.0)))


