"""Scalar functions and the announcement parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions import purpose, scalars
from candela.plans import analogs
from candela.plans.analogs import table
from candela.plans.registry import query
from candela.plans.sql_tables import E_, P_


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders""")
def scl_flexible_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from texts of several shapes."""
    day = F.col("o_orderdate").cast("date")
    short = (F.year(day) >= 2000) & (F.col("o_orderkey") % 3 == 0)
    text = (
        F.when(short, F.date_format(day, "dd-MMM-yy"))
        .when(F.col("o_orderkey") % 3 == 1, F.upper(F.date_format(day, "d-MMM-yyyy")))
        .otherwise(F.concat(F.lit(" "), F.lower(F.date_format(day, "dd/MMM/yyyy"))))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.flexible_dmy(text).alias("parsed"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN round(o_totalprice, 2) END AS f, CASE WHEN o_orderkey % 4 < 2 THEN CAST(trunc(round(o_totalprice, 2)) AS BIGINT) END AS i FROM orders""")
def scl_lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from texts with marks for missing values."""
    text = (
        F.when(F.col("o_orderkey") % 4 < 2, F.concat(F.lit(" "), F.format_string("%.2f", "o_totalprice")))
        .when(F.col("o_orderkey") % 4 == 2, " - ")
        .otherwise("n/a")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.to_float(text).alias("f"), scalars.to_int(text).alias("i"))


@query(E_ + """SELECT user_id, trade_date, coalesce(CASE WHEN user_id % 3 > 0 AND prev_close > 0 THEN (o = h AND h = l AND l = c) OR abs((c - prev_close) / prev_close) * 100 >= CAST(5 * (user_id % 3) AS DOUBLE) - 0.05
ELSE o = h AND h = l AND l = c END, false) AS hit FROM bars""")
def scl_circuit_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a bar ended at its band."""
    band = F.when(F.col("user_id") % 3 > 0, F.concat((5 * (F.col("user_id") % 3)).cast("string"), F.lit("%"))).otherwise("No Band")
    flag = scalars.circuit_flag(*[F.col(c) for c in ("o", "h", "l", "c", "prev_close")], band)
    return analogs.bars(spark, sf_dir).select("user_id", "trade_date", flag.alias("hit"))


@query("""SELECT o_orderkey, md5(concat_ws('|', printf('%.6f', o_totalprice), CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE printf('%.6f', o_totalprice / 8) END, o_custkey)) AS row_hash FROM orders""")
def scl_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row hashes with six places and nothing for NULL."""
    half = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 8)
    row = scalars.row_hash(scalars.six_places(F.col("o_totalprice")), scalars.six_places(half), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", row.alias("row_hash"))


@query(P_ + """SELECT o_orderkey, md5(concat_ws('|', concat('INE', o_orderkey), '2024-01-02', 'X', tmpl, regexp_replace(regexp_replace(lower(purpose), '\\s+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g'))) AS uid FROM purposes""")
def scl_event_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event identifiers from their parts."""
    isin = F.concat(F.lit("INE"), F.col("o_orderkey").cast("string"))
    uid = scalars.event_uid(isin, F.lit("2024-01-02").cast("date"), F.lit("X"), F.col("tmpl"), F.col("purpose"))
    return analogs.purposes(spark, sf_dir).select("o_orderkey", uid.alias("uid"))


@query(E_ + """SELECT DISTINCT isin, series, CASE WHEN series IN ('EQ', 'BE', 'SM') THEN series END AS flag, CASE WHEN isin LIKE 'INF%' THEN 'ETF_MF' ELSE 'EQUITY' END AS kind,
substr(isin, 8, 2) AS type_digits, substr(isin, 1, 9) AS stem FROM bars""")
def scl_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series and identifier classes."""
    isin, series = F.col("isin"), F.col("series")
    return analogs.bars(spark, sf_dir).select("isin", "series").distinct().select(
        "isin",
        "series",
        scalars.classify_series(series).alias("flag"),
        scalars.classify_isin(isin).alias("kind"),
        scalars.security_type(isin).alias("type_digits"),
        scalars.stem(isin).alias("stem"),
    )


@query(P_ + """SELECT o_orderkey, upper(purpose) AS key, purpose AS cleaned, CAST(CASE WHEN tmpl IN (0, 1) THEN o_orderkey * 1.0 END AS DOUBLE) AS number FROM purposes""")
def scl_text_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, cleaned texts and number tokens from texts with odd spacing and signs."""
    odd = F.concat(F.lit("  "), F.replace(F.col("purpose"), F.lit(" "), F.lit("   ")), F.lit("  "))
    odd = F.replace(odd, F.lit("-"), F.lit("–"))
    token = F.when(F.col("tmpl").isin(0, 1), F.concat(F.format_number(F.col("o_orderkey"), 0), F.lit("/-"))).otherwise("x1")
    cleaned = scalars.clean(odd)
    return analogs.purposes(spark, sf_dir).select(
        "o_orderkey", scalars.normalise_key(cleaned).alias("key"), cleaned.alias("cleaned"), scalars.number_token(token).cast("double").alias("number")
    )


@query("""SELECT event_id, CAST(isodow(ts) AS INTEGER) AS weekday, CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS local_day FROM events""")
def scl_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO weekdays, and dates in the market's time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", (F.weekday("ts") + 1).alias("weekday"), local.cast("date").alias("local_day")
    )


@query("""SELECT o_orderkey, nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(left(o_orderpriority, 1), '5') AS differs FROM orders""")
def scl_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inequality in which NULL equals NULL."""
    a = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    b = F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("5"))
    return table(spark, sf_dir, "orders").select("o_orderkey", (~a.eqNullSafe(b)).alias("differs"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'derived' ELSE 'filed' END AS label FROM orders""")
def scl_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by prefix."""
    c = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(c.startswith("1") | c.startswith("2"), "derived").otherwise("filed").alias("label"))


@query(E_ + """SELECT user_id, trade_date, round(c / nullif(o, 0), 8) AS implied, round(100 * (h - l) / nullif(l, 0), 6) AS range_pct, left(dayname(trade_date), 3) AS weekday,
round(least(greatest(c / nullif(o, 0), 0.5), 2.0), 8) AS clamped FROM bars""")
def scl_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios that survive a zero, and a few formats."""
    implied = F.try_divide("c", "o")
    return analogs.bars(spark, sf_dir).select(
        "user_id",
        "trade_date",
        F.round(implied, 8).alias("implied"),
        F.round(100 * F.try_divide(F.col("h") - F.col("l"), F.col("l")), 6).alias("range_pct"),
        F.date_format("trade_date", "E").alias("weekday"),
        F.round(F.least(F.greatest(implied, F.lit(0.5)), F.lit(2.0)), 8).alias("clamped"),
    )


# ---------------------------------------------------------------- the parser

#: What the texts say, by template; one row for each component.
PARTS = P_ + """, parts AS (
SELECT o_orderkey, face_value, tmpl, 0 AS component_ix, CASE tmpl WHEN 0 THEN 'BONUS' WHEN 1 THEN 'RIGHTS' WHEN 2 THEN 'SPLIT' WHEN 3 THEN 'DIVIDEND' WHEN 4 THEN 'INTERIM_DIVIDEND'
  WHEN 5 THEN 'AGM' WHEN 6 THEN 'BONUS_PREFERENCE' WHEN 7 THEN 'DEMERGER' WHEN 8 THEN 'AGM' WHEN 9 THEN 'AGM' WHEN 10 THEN 'INTERIM_DIVIDEND' ELSE 'BUYBACK' END AS type FROM purposes
UNION ALL SELECT o_orderkey, face_value, tmpl, 1, CASE tmpl WHEN 10 THEN 'SPECIAL_DIVIDEND' ELSE 'DIVIDEND' END FROM purposes WHERE tmpl IN (5, 9, 10)
UNION ALL SELECT o_orderkey, face_value, tmpl, 2, 'SPECIAL_DIVIDEND' FROM purposes WHERE tmpl = 5),
typed AS (SELECT *,
  CAST(CASE type WHEN 'BONUS' THEN 1 + o_orderkey % 4 WHEN 'RIGHTS' THEN 1 + o_orderkey % 4 WHEN 'SPLIT' THEN 10 WHEN 'BONUS_PREFERENCE' THEN 1 + o_orderkey % 4 END AS DOUBLE) AS ratio_num,
  CAST(CASE type WHEN 'BONUS' THEN 1 + o_orderkey % 3 WHEN 'RIGHTS' THEN 1 + o_orderkey % 7 WHEN 'SPLIT' THEN 1 + o_orderkey % 5 WHEN 'BONUS_PREFERENCE' THEN 1 END AS DOUBLE) AS ratio_den,
  CAST(CASE WHEN type = 'RIGHTS' THEN face_value + o_orderkey % 50 END AS DOUBLE) AS sub_price,
  CAST(CASE WHEN tmpl IN (3, 5, 9) AND type = 'DIVIDEND' THEN 1 + o_orderkey % 9 WHEN tmpl = 4 THEN (1 + o_orderkey % 9) / 10.0
    WHEN tmpl = 5 AND component_ix = 2 THEN 1 + o_orderkey % 6 WHEN tmpl = 10 AND component_ix = 0 THEN 8 WHEN tmpl = 10 THEN 1 + o_orderkey % 60 END AS DOUBLE) AS div_amount,
  type <> 'DEMERGER' AS parsed_ok, CASE WHEN type = 'DEMERGER' THEN 'needs_external_price' END AS review_reason,
  CASE WHEN type = 'DEMERGER' THEN 'high' ELSE 'low' END AS severity FROM parts)
"""


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purpose.parse(analogs.purposes(spark, sf_dir))


#: A component's own part of the text.
RAW = """CASE WHEN tmpl IN (5, 9) AND component_ix = 0 THEN 'Annual General Meeting'
  WHEN tmpl = 5 AND component_ix = 1 THEN concat('Dividend - Rs ', 1 + o_orderkey % 9, ' Per Share') WHEN tmpl = 5 THEN concat('Special Dividend - Rs ', 1 + o_orderkey % 6, ' Per Share')
  WHEN tmpl = 9 THEN concat('dividend - Rs ', 1 + o_orderkey % 9, ' Per Share')
  WHEN tmpl = 10 AND component_ix = 0 THEN 'Interim Dividend - Rs 8 Per Share' WHEN tmpl = 10 THEN concat('Special Dividend - Rs ', 1 + o_orderkey % 60, ' Per Share') ELSE purpose END"""


@query(PARTS + f"SELECT o_orderkey, component_ix, {RAW} AS raw_text FROM typed JOIN (SELECT o_orderkey, purpose FROM purposes) USING (o_orderkey)")
def txt_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clauses of each text."""
    return parsed(spark, sf_dir).select("o_orderkey", "component_ix", "raw_text")


@query(PARTS + "SELECT o_orderkey, component_ix, type, round(ratio_num, 6) AS ratio_num, round(ratio_den, 6) AS ratio_den, round(sub_price, 6) AS sub_price, round(div_amount, 6) AS div_amount FROM typed")
def txt_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, ratios and amounts."""
    numbers = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("ratio_num", "ratio_den", "sub_price", "div_amount")]
    return parsed(spark, sf_dir).select("o_orderkey", "component_ix", "type", *numbers)


@query(PARTS + "SELECT o_orderkey, component_ix, type, review_reason, severity FROM typed WHERE NOT parsed_ok")
def txt_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes to review, and how urgent it is."""
    return parsed(spark, sf_dir).filter("not parsed_ok").select("o_orderkey", "component_ix", "type", "review_reason", "severity")


@query(P_ + """SELECT trim(regexp_replace(regexp_replace(purpose, '\\d+(\\.\\d+)?', '#', 'g'), '\\s+', ' ', 'g')) AS template, CAST(count(*) AS BIGINT) AS n FROM purposes GROUP BY 1""")
def txt_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each template occurs."""
    return analogs.purposes(spark, sf_dir).groupBy(scalars.template(F.col("purpose")).alias("template")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH base AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 12 = 0)
SELECT o_orderkey, 0 AS component_ix, 'NO_ADJUST' AS type, CAST(NULL AS DOUBLE) AS div_amount, true AS parsed_ok FROM base
UNION ALL SELECT o_orderkey, 1, 'INTEREST_PAYMENT', NULL, true FROM base
UNION ALL SELECT o_orderkey, 2, 'RETURN_OF_CAPITAL', round((o_orderkey % 13 + 1) / 100.0, 4), true FROM base""")
def txt_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A distribution's leading total does not count beside its parts."""
    base = table(spark, sf_dir, "orders").filter("o_orderkey % 12 = 0")
    amount = lambda k: F.format_string("%.4f", (F.col("o_orderkey") % k + 1) / 100.0)
    text = F.concat(
        F.lit("Distribution - Rs "), amount(97), F.lit(" Per Unit Consists Of Dividend Re "), amount(7),
        F.lit(" Per Unit/ Interest - Re "), amount(11), F.lit(" Per Unit/ Return Of Capital - Re "), amount(13), F.lit(" Per Unit"),
    )
    out = purpose.parse(base.select("o_orderkey", text.alias("purpose"), F.lit(None).cast("int").alias("face_value")))
    return out.select("o_orderkey", "component_ix", "type", F.col("div_amount").cast("double").alias("div_amount"), "parsed_ok")


@query(PARTS + f"""SELECT o_orderkey, face_value, tmpl, component_ix, {RAW} AS raw_text, type, round(ratio_num, 6) AS ratio_num, round(ratio_den, 6) AS ratio_den,
CAST(CASE WHEN type = 'RIGHTS' THEN o_orderkey % 50 END AS DOUBLE) AS premium, round(sub_price, 6) AS sub_price, round(div_amount, 6) AS div_amount,
type = 'SPECIAL_DIVIDEND' AS is_special, parsed_ok, CASE WHEN parsed_ok THEN 'high' ELSE 'low' END AS confidence, review_reason, severity
FROM typed JOIN (SELECT o_orderkey, purpose FROM purposes) USING (o_orderkey)""")
def txt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the parser gives."""
    out = parsed(spark, sf_dir).drop("purpose")
    return out.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("ratio_num", "ratio_den", "premium", "sub_price", "div_amount")})


@query(PARTS + "SELECT type, severity, CAST(count(*) AS BIGINT) AS n FROM typed GROUP BY type, severity")
def txt_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components by type and severity."""
    return parsed(spark, sf_dir).groupBy("type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(PARTS + """SELECT CAST(count(*) AS BIGINT) AS events, CAST(count(*) FILTER (WHERE NOT parsed_ok) AS BIGINT) AS reviews,
CAST(count(*) FILTER (WHERE type IN ('BONUS', 'SPLIT', 'RIGHTS', 'SPECIAL_DIVIDEND')) AS BIGINT) AS adjusting FROM typed""")
def ing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one load of announcements would store."""
    from candela.operators.ingest import events_and_reviews

    rows = analogs.purposes(spark, sf_dir).select(
        F.col("o_orderkey").alias("ca_raw_id"),
        F.concat(F.lit("INE"), F.col("o_orderkey").cast("string")).alias("isin"),
        F.lit("2024-01-02").cast("date").alias("ex_date"),
        "purpose",
        "face_value",
    )
    events, reviews = events_and_reviews(rows)
    adjusting = F.count_if(F.col("type").isin("BONUS", "SPLIT", "RIGHTS", "SPECIAL_DIVIDEND"))
    zero = F.lit(0).cast("bigint")
    stored = events.agg(F.count(F.lit(1)).alias("events"), zero.alias("reviews"), adjusting.alias("adjusting"))
    queued = reviews.agg(zero.alias("events"), F.count(F.lit(1)).alias("reviews"), zero.alias("adjusting"))
    return stored.unionByName(queued).agg(*[F.sum(c).alias(c) for c in ("events", "reviews", "adjusting")])


@query(PARTS + """, old AS (SELECT o_orderkey, component_ix, type, CASE WHEN o_orderkey % 20 = 0 THEN ratio_num + 1 ELSE ratio_num END AS rn FROM typed WHERE o_orderkey % 30 <> 3)
SELECT CAST(count(*) FILTER (WHERE o.o_orderkey IS NULL) AS BIGINT) AS newly_parsed, CAST(count(*) FILTER (WHERE n.o_orderkey IS NULL) AS BIGINT) AS superseded,
CAST(count(*) FILTER (WHERE o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL AND o.rn IS DISTINCT FROM n.ratio_num) AS BIGINT) AS changed
FROM old o FULL JOIN (SELECT * FROM typed WHERE o_orderkey % 30 <> 6) n ON o.o_orderkey = n.o_orderkey AND o.component_ix = n.component_ix""")
def ing_reparse_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live events against a fresh parse of the same announcements."""
    from candela.operators.ingest import reparse_diff

    fresh = parsed(spark, sf_dir)
    key = F.col("o_orderkey")
    live = fresh.filter(key % 30 != 3).withColumn("ratio_num", F.when(key % 20 == 0, F.col("ratio_num") + 1).otherwise(F.col("ratio_num")).cast("decimal(24,8)"))
    diff = reparse_diff(live, fresh.filter(key % 30 != 6), ["o_orderkey", "component_ix"])
    return diff.agg(
        F.count_if(F.col("change") == "newly_parsed").alias("newly_parsed"),
        F.count_if(F.col("change") == "superseded").alias("superseded"),
        F.count_if(F.col("change") == "changed").alias("changed"),
    )


@query(P_ + "SELECT o_orderkey, CAST(1 AS BIGINT) AS n FROM purposes WHERE o_orderkey % 3 = 0 AND tmpl NOT IN (5, 9, 10)")
def txt_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without clauses have no components; those of one clause have one."""
    texts = analogs.purposes(spark, sf_dir).filter("tmpl not in (5, 9, 10)")
    blank = texts.withColumn("purpose", F.when(F.col("o_orderkey") % 3 == 0, F.col("purpose")).when(F.col("o_orderkey") % 3 == 1, " / - & "))
    return purpose.parse(blank).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
