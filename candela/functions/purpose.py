"""The announcement parser: free text to typed components, as Column expressions.

A text is cut into clauses. A clause is read once, into tokens: numbers, words
and signs. Each token has a concept, which a dictionary of words gives, and a
concept is one character; so a clause becomes a short string of concepts, its
*shape*. Rules are patterns over shapes, written with concept names: ``BONUS
NUMBER COLON NUMBER``. The first rule that matches decides, and the length of
what stands before a number in the shape is that number's place among the
tokens. Everything stays in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.scalars import clean, number_token
from candela.schemas import NEEDS_EXTERNAL, PRICE_ADJUSTING

# The words of the announcements by concept, misspellings of the feed included.
WORDS = {
    "DIVIDEND": "dividend divdend divdends dividned divident dividen div",
    "SPECIAL": "special",
    "INTERIM": "interim",
    "SHORT_INTERIM": "int",
    "FINAL": "final",
    "ANNUAL": "annual",
    "EXEMPT": "exempt",
    "BONUS": "bonus",
    "RIGHTS": "right rights",
    "ISSUE": "issue",
    "SPLIT": "split division subdivision consolidation",
    "FROM": "from",
    "TO": "to",
    "OF": "of",
    "ON": "on",
    "AT": "at",
    "IN": "in",
    "PER": "per",
    "UNIT": "unit units",
    "SHARE": "share shares",
    "MONEY": "rs re inr ₹",
    "PREFERRED": "ncrps ncrp ccps",
    "CONVERTIBLE": "ccd",
    "PREFERENCE": "preference",
    "PREF": "pref",
    "BOND": "debenture debentures bond bonds",
    "NCD": "ncd ncds",
    "PARTLY": "partly",
    "PAID": "paid",
    "PREMIUM": "premium prem prm",
    "WARRANT": "warrant warrants",
    "CAPITAL": "capital",
    "CAPTIAL": "captial capial",
    "REDUCTION": "reduction",
    "REDEMPTION": "redemption redeem redeemed redeemable redeeming",
    "RETURN": "return retun retrun retrn retn retuurn returrn",
    "REPAYMENT": "repayment",
    "REPAID": "repaid",
    "PAYMENT": "payment",
    "AMOUNT": "amount",
    "PRINCIPAL": "principal",
    "SHAREHOLDER": "shareholder",
    "LOAN": "loan",
    "SPV": "spv",
    "LEVEL": "level",
    "DEBT": "debt",
    "AMORTISATION": "amortisation amortization",
    "INTEREST": "interest interst",
    "NTEREST": "nterest intrest",
    "TREASURY": "treasury trasury tresury",
    "OTHER": "other",
    "INCOME": "income",
    "TAX": "tax",
    "REFUND": "refund",
    "COUPON": "coupon",
    "SPIN": "spin",
    "OFF": "off",
    "SPINOFF": "spinoff",
    "DE": "de",
    "DEMERGER": "demerger",
    "MERGER": "merger",
    "SCHEME": "scheme",
    "ARRANGEMENT": "arrangement",
    "AMALGAMATION": "amalgamation",
    "BUY": "buy",
    "BACK": "back",
    "BUYBACK": "buyback",
    "GENERAL": "general",
    "MEETING": "meeting meetin meetng meet meting metin metng met",
    "AGM": "agm",
    "EGM": "egm eogm",
    "COURT": "court",
    "CONVENED": "convened",
    "POSTAL": "postal",
    "BALLOT": "ballot",
    "BOARD": "board",
    "FINANCIAL": "financial",
    "RESULT": "result results",
    "CHANGE": "change",
    "NAME": "name symbol",
    "LISTING": "listing",
    "RECORD": "record",
    "DATE": "date",
    "BOOK": "book",
    "CLOSURE": "closure",
    "NIL": "nil",
    "OPEN": "open",
    "OFFER": "offer",
    "VOLUNTARY": "voluntary",
    "DELISTING": "delisting",
    "SUSPENSION": "suspension",
    "DASH": "-",
    "COLON": ":",
    "COMMA": ",",
    "DOT": ".",
    "EACH": "@",
}
#: Concepts of tokens that no word list has.
OPEN_CONCEPTS = ("NUMBER", "WORD", "SIGN")
#: One character for each concept; what they are plays no part.
CODES = {name: chr(0x4E00 + k) for k, name in enumerate((*WORDS, *OPEN_CONCEPTS))}
#: A number with thousands commas and maybe '/-', an abbreviation with dots, a word, or a sign.
TOKEN = r"\d[\d,]*(?:\.\d+)?(?:/-)?|(?<![a-z\d])\.\d+|[a-z](?:\.[a-z])+|[a-z]+|[^\sa-z\d]"


def shape(pattern: str) -> str:
    """The regular expression over shapes that a pattern over concept names stands for."""
    return re.sub(r"[A-Z]\w*", lambda m: CODES[m[0]], pattern).replace(" ", "")


RATIO = "NUMBER COLON NUMBER"
LED = "(?:ISSUE|OF)? [DASH COLON COMMA DOT]*"  # what may stand between a label and its ratio
PAPER = "(?:PREFERRED|CONVERTIBLE|(?:PREFERENCE|PREF DOT?) SHARE)"
PRICE = "MONEY DOT? NUMBER"
INCOME = "[TREASURY OTHER] INCOME"
#: What a clause is, by its shape, in order: the first that matches decides.
RULES = {
    "preferred": f"[BONUS ISSUE RIGHTS] DASH? OF? NUMBER? {PAPER}",
    "preferred_word": "PREFERRED|PREFERENCE SHARE",
    "split": f"SPLIT [^NUMBER]* FROM {PRICE} [^NUMBER]* TO {PRICE}",
    "bonus_debt": "BONUS .{0,8} [BOND NCD]",
    "bonus": f"BONUS {LED} {RATIO}",
    "bonus_word": "BONUS",
    "rights": f"RIGHTS {LED} {RATIO}",
    "capital_reduction": "CAPITAL REDUCTION|REDUCTION OF CAPITAL",
    "redemption": "REDEMPTION",
    "capital_return": (
        "[RETURN REPAYMENT REPAID] [OF ON] [CAPITAL CAPTIAL SPV DEBT]|CAPITAL REPAYMENT|REPAYMENT OF [SHAREHOLDER PRINCIPAL LOAN]"
        "|PRINCIPAL [^NUMBER DASH COLON COMMA DOT EACH SIGN]? [PAYMENT REPAYMENT]|AMORTISATION|SPV LEVEL? DEBT|SPV LOAN|NCD"
    ),
    "unit_income": f"^(?=.*(?:{INCOME}|INTEREST)).* PER UNIT",
    "dividend": "DIVIDEND",
    "spinoff": "SPINOFF|SPIN DASH? OFF",
    "demerger": "DEMERGER|DE DASH? MERGER",
    "scheme": "SCHEME OF ARRANGEMENT|AMALGAMATION|MERGER",
    "buyback": "BUYBACK|BUY DASH? BACK",
    "agm": "ANNUAL GENERAL MEETING|AGM",
    "egm": "GENERAL MEETING|EGM|COURT CONVENED MEETING|POSTAL BALLOT",
    "interest": f"INTEREST|NTEREST|COUPON|{INCOME}|INCOME TAX REFUND",
    "information": (
        "^(?:BOARD MEETING|FINANCIAL? RESULT|CHANGE IN NAME|LISTING|RECORD DATE|BOOK CLOSURE|NIL|OPEN OFFER"
        "|VOLUNTARY? DELISTING|SUSPENSION|SPLIT OF SHARE)"
    ),
    "unknown": "",
}
#: A rule of its own: the total that leads a distribution's list of parts.
NEUTRAL = "headline"
# Types and review reasons by rule; those with a function of their own are not here.
TYPES = {
    "preferred": "BONUS_PREFERENCE",
    "preferred_word": "BONUS_PREFERENCE",
    "split": "SPLIT",
    "bonus_debt": "SCHEME_OF_ARRANGEMENT",
    "bonus": "BONUS",
    "bonus_word": "BONUS",
    "rights": "RIGHTS",
    "capital_reduction": "CAPITAL_REDUCTION",
    "redemption": "REDEMPTION",
    "capital_return": "RETURN_OF_CAPITAL",
    "unit_income": "INTEREST_PAYMENT",
    "spinoff": "SPINOFF",
    "demerger": "DEMERGER",
    "scheme": "SCHEME_OF_ARRANGEMENT",
    "buyback": "BUYBACK",
    "agm": "AGM",
    "egm": "EGM",
    "interest": "INTEREST_PAYMENT",
    "information": "NO_ADJUST",
    "unknown": "UNKNOWN",
    NEUTRAL: "NO_ADJUST",
}
REASONS = {
    "needs_external_price": ("bonus_debt", "capital_reduction", "redemption", "spinoff", "demerger", "scheme"),
    "ambiguous_ratio": ("preferred_word", "bonus_word"),
    "unparsed_pattern": ("unknown",),
}
#: Where the first number of a ratio or pair stands: what is before it, by rule; the second is two tokens on.
BEFORE_RATIO = {
    "preferred": f"[BONUS ISSUE RIGHTS] DASH? OF? NUMBER? {PAPER}",
    "bonus": f"BONUS {LED}",
    "rights": f"RIGHTS {LED}",
}
BEFORE_SPLIT = "SPLIT [^NUMBER]* FROM MONEY DOT?"
BETWEEN_SPLIT = f"{BEFORE_SPLIT} NUMBER [^NUMBER]* TO MONEY DOT?"
BEFORE_PREMIUM = f"RIGHTS {LED} {RATIO} (?:PARTLY PAID)? EACH? AT? PREMIUM OF? (?:MONEY DOT?)?"
UNCLEAR = "PARTLY PAID|WARRANT"
#: The first kind that soon precedes a dividend.
KIND = "(SPECIAL INTERIM|INTERIM SPECIAL|[SPECIAL INTERIM SHORT_INTERIM FINAL ANNUAL EXEMPT])(?=.{0,3} DIVIDEND)"

SEPARATOR = r"(?i)[\s-]*(?:/|&|\band\b)[\s-]*"
GUARD = "\u0001"  # stands for '/-' while clauses are cut


def split_clauses(purpose: Column) -> Column:
    """Array of clauses: cut at '/', '&' and 'and', without spaces and dashes at their ends; '/-' is still guarded.

    A clause also ends where the next is written onto a meeting's name, and
    where a payment's label follows a 'per share' or 'per unit'; a dividend
    written onto its kind is a word of its own.
    """
    text = F.replace(clean(purpose), F.lit("/-"), F.lit(GUARD))
    text = F.regexp_replace(text, r"(?i)\b(general meeting)(?=[a-z])", "$1/")
    text = F.regexp_replace(text, r"(?i)\b(interim|final|special|annual)(?=dividend\b)", "$1 ")
    text = F.regexp_replace(text, r"(?i)\bper\s+(share|sh|unit)\s+(?=(?:special|interim|final|dividend)\b)", "Per $1/")
    return F.array_remove(F.split(F.regexp_replace(text, "^[ -]+|[ -]+$", ""), SEPARATOR), "")


def unguarded(clause: Column) -> Column:
    return F.replace(clause, F.lit(GUARD), F.lit("/-"))


def tokens_of(clause: Column) -> Column:
    return F.regexp_extract_all(F.lower(clause), F.lit(f"({TOKEN})"), 1)


def shape_of(tokens: Column) -> Column:
    """The concepts of the tokens, as one string."""
    known = {word: CODES[name] for name, words in WORDS.items() for word in words.split()}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    is_number = lambda t: t.rlike(r"^\.?\d")
    plain = lambda t: F.when(F.length(t) > 1, F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    other = lambda t: F.when(t.rlike("^[a-z]"), CODES["WORD"]).otherwise(CODES["SIGN"])
    concept = lambda t: F.when(is_number(t), CODES["NUMBER"]).otherwise(F.coalesce(F.try_element_at(table, plain(t)), other(t)))
    return F.concat_ws("", F.transform(tokens, concept))


def number_after(tokens: Column, code: Column, before: str, more: int = 0) -> Column:
    """The number that follows the pattern ``before`` in a shape (and then ``more`` tokens on); NULL where none does."""
    led = F.regexp_extract(code, f"^(.*?(?:{shape(before)})){CODES['NUMBER']}", 1)
    found = code.rlike(f"(?:{shape(before)}){CODES['NUMBER']}")
    return F.when(found, number_token(F.get(tokens, F.length(led) + more)))


def find_amount(tokens: Column, code: Column) -> Column:
    """The clause's amount: with a currency first; a bare number only where the clause has no ratio."""
    bare = F.when(~code.contains(CODES["COLON"]), number_after(tokens, code, ""))
    return F.when(code.rlike(shape(PRICE)), number_after(tokens, code, "MONEY DOT?")).otherwise(bare)


def rule_of(code: Column) -> Column:
    """The name of the first rule that a shape matches."""
    found = F.lit("unknown")
    for name in reversed([n for n in RULES if n != "unknown"]):
        found = F.when(code.rlike(shape(RULES[name])), name).otherwise(found)
    return found


def _by_rule(rule: Column, values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(rule == name, value).otherwise(out)
    return out


def numbers(rule: Column, tokens: Column, code: Column) -> Column:
    """What the rule reads: first and second number of a ratio or pair, premium, amount, and the dividend's kind."""
    first = {name: number_after(tokens, code, before) for name, before in BEFORE_RATIO.items()}
    second = {name: number_after(tokens, code, before, 2) for name, before in BEFORE_RATIO.items()}
    with_ratio = code.rlike(shape(f"{BEFORE_RATIO['preferred']} {RATIO}"))
    first["preferred"], second["preferred"] = F.when(with_ratio, first["preferred"]), F.when(with_ratio, second["preferred"])
    first["split"] = number_after(tokens, code, BEFORE_SPLIT)
    second["split"] = number_after(tokens, code, BETWEEN_SPLIT)
    return F.struct(
        _by_rule(rule, first).cast("decimal(24,8)").alias("num"),
        _by_rule(rule, second).cast("decimal(24,8)").alias("den"),
        _by_rule(rule, {"rights": number_after(tokens, code, BEFORE_PREMIUM)}).cast("decimal(24,8)").alias("premium"),
        F.when(rule.isin("capital_return", "dividend"), find_amount(tokens, code)).cast("decimal(24,8)").alias("amount"),
        F.when(rule == "dividend", F.regexp_extract(code, shape(KIND), 1)).alias("kind"),
        ((rule == "rights") & code.rlike(shape(UNCLEAR))).alias("unclear"),
    )


def component(rule: Column, read: Column, face_value: Column) -> dict[str, Column]:
    """The component's fields, from its rule and the numbers that the rule has read."""
    num, den, premium, amount = (read[x] for x in ("num", "den", "premium", "amount"))
    paid = F.coalesce(amount > 0, F.lit(False))
    special, interim = read["kind"].contains(CODES["SPECIAL"]), read["kind"].contains(CODES["INTERIM"])
    paired = F.coalesce((num > 0) & (den > 0), F.lit(False))
    priced = F.coalesce((num != 0) & (den > 0) & premium.isNotNull() & (face_value > 0), F.lit(False))

    type_ = F.when(paid & special, "SPECIAL_DIVIDEND").when(paid & interim, "INTERIM_DIVIDEND").otherwise("DIVIDEND")
    type_ = F.when(rule == "dividend", type_).otherwise(_by_rule(rule, {n: F.lit(t) for n, t in TYPES.items()}))
    reason = F.lit(None)
    for value, rules in REASONS.items():
        reason = F.when(rule.isin(*rules), value).otherwise(reason)
    reason = F.when((rule == "bonus") & ~paired, "ambiguous_ratio").otherwise(reason)
    reason = F.when((rule == "split") & (~paired | (num == den)), "ambiguous_ratio").otherwise(reason)
    reason = F.when((rule == "rights") & read["unclear"], "unparsed_pattern").when((rule == "rights") & ~priced, "ambiguous_ratio").otherwise(reason)
    reason = F.when((rule == "capital_return") & ~paid, "unparsed_pattern").when((rule == "dividend") & ~paid, "ambiguous_ratio").otherwise(reason)
    keeps = rule.isin("preferred", "rights") | paired
    cash = rule.isin("capital_return", "dividend") & paid
    return {
        "type": type_,
        "ratio_num": F.when(keeps, num),
        "ratio_den": F.when(keeps, den),
        "premium": premium,
        "sub_price": F.when((rule == "rights") & priced & ~read["unclear"], face_value + premium).cast("decimal(24,8)"),
        "div_amount": F.when(cash, amount).cast("decimal(20,6)"),
        "is_special": cash & ((rule == "capital_return") | F.coalesce(special, F.lit(False))),
        "parsed_ok": reason.isNull(),
        "confidence": F.when(reason.isNotNull(), "low").when(rule == "capital_return", "medium").otherwise("high"),
        "review_reason": reason.cast("string"),
    }


def severity(type_: Column, parsed_ok: Column, reason: Column) -> Column:
    """How urgent a component's review is."""
    return (
        F.when(reason.eqNullSafe(F.lit("needs_external_price")), "high")
        .when(type_.isin(*PRICE_ADJUSTING) & ~parsed_ok, "high")
        .when(type_.isin(*NEEDS_EXTERNAL), "high")
        .when(type_ == "UNKNOWN", "medium")
        .otherwise("low")
    )


def parse(texts: DataFrame, purpose: str = "purpose", face_value: str = "face_value") -> DataFrame:
    """A row for each component: the input's columns, component_ix, raw_text, the component's fields and severity.

    The total that leads a distribution's list of parts is neutralised, so
    that it does not count twice. Texts without clauses give no rows.
    """
    cut = texts.withColumn("_clauses", split_clauses(F.coalesce(F.col(purpose), F.lit(""))))
    read = cut.withColumn("_tokens", F.transform("_clauses", lambda c: tokens_of(unguarded(c))))
    read = read.withColumn("_shapes", F.transform("_tokens", shape_of))
    whole = F.lower(clean(F.col(purpose)))
    headed = whole.rlike(r"^distribution\b") & whole.rlike(r"\b(?:consist|consists|consisting|comprises|comprising)\b")
    pairs = F.arrays_zip("_tokens", "_shapes")
    later = F.slice(pairs, 2, F.greatest(F.size(pairs) - 1, F.lit(0)))
    headed = headed & (F.size("_clauses") >= 2) & F.exists(later, lambda x: _pays(x["_tokens"], x["_shapes"]))
    read = read.withColumn("_headed", F.coalesce(headed, F.lit(False)))
    # outer, then filtered: for a plain explode the optimizer would compute the clauses twice to drop empty lists early
    each = read.select(
        *texts.columns, "_headed", F.posexplode_outer(F.arrays_zip("_clauses", "_tokens", "_shapes")).alias("component_ix", "_part")
    ).filter("_part is not null")
    each = each.select(
        *texts.columns,
        "component_ix",
        unguarded(F.col("_part._clauses")).alias("raw_text"),
        F.col("_part._tokens").alias("_tokens"),
        F.col("_part._shapes").alias("_shape"),
        ((F.col("component_ix") == 0) & F.col("_headed")).alias("_first"),
    )
    each = each.withColumn("_rule", F.when(F.col("_first"), NEUTRAL).otherwise(rule_of(F.col("_shape"))))
    each = each.withColumn("_read", numbers(F.col("_rule"), F.col("_tokens"), F.col("_shape")))
    fields = component(F.col("_rule"), F.col("_read"), F.col(face_value).cast("decimal(24,8)"))
    typed = each.select(*texts.columns, "component_ix", "raw_text", *[v.alias(k) for k, v in fields.items()])
    return typed.withColumn("severity", severity(F.col("type"), F.col("parsed_ok"), F.col("review_reason")))


def _pays(tokens: Column, code: Column) -> Column:
    """Whether a clause is a payment whose amount is known."""
    paying = code.rlike(shape(RULES["capital_return"])) | (code.rlike(shape(RULES["dividend"])) & ~code.rlike(shape(RULES["unit_income"])))
    return paying & F.coalesce(find_amount(tokens, code) > 0, F.lit(False))
