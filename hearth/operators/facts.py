"""POS enrichment and facts.

The line table is the largest input; everything here keeps it on its own
partitioning: rule lookups are broadcast hash joins against small, size-checked
tables, and the one large join (lines x receipts) is an equi join on the
receipt key, which has no hot values (one receipt = one key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, nonempty, not_cancelled, shift_of
from hearth.plans.joins import broadcast_if_small
from hearth.sources.periods import DATE, PERIOD, within

LINE_KEY = ["business_location_id", "account_reference", "line_id"]
RECEIPT_KEY = ["business_location_id", "account_reference"]

# Payment code -> tender bucket.
CARD_CODES = ["LSPAY_ADYEN_TERMINAL_API_LOCAL", "LSPAY_ADYEN_TAP_TO_PAY"]


def _payload(raw, *fields):
    """Parse the JSON payload once and expose the requested text fields."""
    schema = "struct<" + ",".join(f"{f}:string" for f in fields) + ">"
    return F.from_json(raw, schema)


# Payload fields the views read, and the typed columns the loader promotes them
# to (so a report does not re-parse JSON on every line; ``raw`` stays as is).
LINE_PAYLOAD = {"staffName": "p_staff_name", "staffId": "p_staff_id", "voidReason": "p_void_reason",
                "discountName": "p_discount_name"}
PROMOTED = tuple(LINE_PAYLOAD.values())


def line_payload(df: DataFrame) -> "F.Column":
    """Struct ``staffName, staffId, voidReason, discountName`` of a line: the
    promoted columns when the table has them, else parsed from ``raw``."""
    if all(c in df.columns for c in PROMOTED):
        return F.struct(*[F.col(c).alias(k) for k, c in LINE_PAYLOAD.items()])
    return _payload(F.col("raw"), *LINE_PAYLOAD)


def active_rules(rules: DataFrame, dimension: str) -> DataFrame:
    return rules.filter((F.col("dimension") == dimension) & F.col("active"))


def wet_dry_rules(rules: DataFrame) -> DataFrame:
    return broadcast_if_small(
        active_rules(rules, "wet_dry")
        .filter(F.col("match_type") == "accounting_group")
        .select(F.col("match_value").alias("_wd_group"), F.col("category").alias("_wd_cat")), basis=rules)


def with_wet_dry(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """Left join on accounting group; unmatched -> 'other'. Like the source view,
    two active rules for one group would repeat the line (see check_rules_unique)."""
    r = wet_dry_rules(rules)
    return (lines.join(r, lines["accounting_group_name"] == r["_wd_group"], "left")
                 .withColumn("wet_dry", F.coalesce(F.col("_wd_cat"), F.lit("other")))
                 .drop("_wd_group", "_wd_cat"))


def line_wet_dry(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """(line) -> wet_dry."""
    return with_wet_dry(lines.select(*LINE_KEY, "accounting_group_name"), rules).select(*LINE_KEY, "wet_dry")


def check_rules_unique(rules: DataFrame) -> DataFrame:
    """Rule pairs that would fan out the wet/dry join: (dimension, match_value) seen twice."""
    return (rules.filter(F.col("active"))
                 .groupBy("dimension", "match_type", "match_value").count()
                 .filter(F.col("count") > 1))


def name_category_table(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """The ILIKE part of the rules folded per distinct item name: (name,
    categories). A small dimension the nightly load can store, so reports do
    not rescan the line table for its names."""
    r = active_rules(rules, "item_category")
    like = broadcast_if_small(r.filter(F.col("match_type") == "name_like").select("match_value", "category"),
                              basis=rules)
    names = lines.select(F.col("name").alias("_n")).where(F.col("_n").isNotNull()).distinct()
    return (names.join(like, F.expr("_n ILIKE match_value")).select("_n", "category")
                 .groupBy("_n").agg(F.collect_set("category").alias("_c__n")))


def category_lookups(names_from: DataFrame, rules: DataFrame, name_table: DataFrame | None = None):
    """Three small lookups (group -> cats, sku -> cats, name -> cats).

    The ILIKE rules are evaluated once per *distinct item name* (a menu-sized
    set, read from ``names_from`` -- the plain line table or the catalogue, one
    column), not once per line, and the result is folded into one array per name.
    """
    lines = names_from
    r = active_rules(rules, "item_category")

    def fold(df, key):
        return df.groupBy(key).agg(F.collect_set("category").alias(f"_c_{key}"))

    grp = fold(r.filter(F.col("match_type") == "accounting_group")
                .select(F.col("match_value").alias("_g"), "category"), "_g")
    sku = fold(r.filter(F.col("match_type") == "sku")
                .select(F.col("match_value").alias("_s"), "category"), "_s")
    nm = name_table if name_table is not None else name_category_table(lines, rules)
    # group and sku lookups are folds of the rule table (never more rows than it)
    return broadcast_if_small(grp, basis=rules), broadcast_if_small(sku, basis=rules), broadcast_if_small(nm)


def with_categories(lines: DataFrame, rules: DataFrame, lookups=None) -> DataFrame:
    """Adds ``categories``: the distinct item categories a line matches
    (group OR sku OR name ILIKE), without shuffling the lines. ``lookups`` from
    ``category_lookups`` can be shared by several uses in one query."""
    grp, sku, nm = lookups or category_lookups(lines, rules)
    empty = F.array().cast("array<string>")
    out = (lines.join(grp, lines["accounting_group_name"] == grp["_g"], "left")
                .join(sku, lines["sku"] == sku["_s"], "left")
                .join(nm, lines["name"] == nm["_n"], "left"))
    cats = F.array_distinct(F.concat(F.coalesce("_c__g", empty), F.coalesce("_c__s", empty),
                                     F.coalesce("_c__n", empty)))
    return out.withColumn("categories", cats).drop("_g", "_s", "_n", "_c__g", "_c__s", "_c__n")


def line_item_category(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (line, category) matched."""
    lc = with_categories(lines.select(*LINE_KEY, "accounting_group_name", "sku", "name"), rules,
                         category_lookups(lines, rules))
    return lc.select(*LINE_KEY, F.explode("categories").alias("category"))


def fact_lines(lines: DataFrame, sales: DataFrame, sites: DataFrame, rules: DataFrame,
               keep=("raw", "time_of_sale") + PROMOTED, dates=None, receipt_cols=()) -> DataFrame:
    """Every line of a non-cancelled receipt with site, London date, shift, wet/dry.

    ``dates`` (first, last or None) reads only the stored partitions of these business
    dates on both sides of the join; ``receipt_cols`` are receipt columns to carry along."""
    if dates is not None:
        lines, sales = within(lines, *dates), within(sales, *dates)
    sa = (sales.filter(not_cancelled("cancelled"))
               .select(*RECEIPT_KEY, "time_closed", *receipt_cols))
    st = broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites)
    j = lines.drop(DATE, PERIOD).join(sa, RECEIPT_KEY).join(st, "business_location_id", "left")
    j = with_wet_dry(j, rules)
    extra = [c for c in keep if c in lines.columns]
    return j.select(
        "business_location_id", "site", "account_reference", "line_id", "sku", "name",
        "quantity",
        F.col("net_without_tax").alias("net_ex_vat"),
        F.col("net_with_tax").alias("net_inc_vat"),
        "unit_cost_price", "accounting_group_name", "wet_dry", "time_closed",
        business_date("time_closed").alias("business_date"),
        shift_of("time_of_sale", "time_closed").alias("shift"),
        "discount_amount", "menu_list_price",
        *extra, *receipt_cols,
    )


def tender_group(code) -> "F.Column":
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c.isin(*CARD_CODES), F.lit("Card"))
             .when(c == "CASH", F.lit("Cash"))
             .when(c == "IKGIFT", F.lit("Gift card"))
             .when(c == "OA", F.lit("Online"))
             .when(c == "IKDEBT", F.lit("Invoice"))
             .otherwise(F.lit("Other")))


def fact_payments(payments: DataFrame, sales: DataFrame, sites: DataFrame) -> DataFrame:
    """Payments of non-cancelled receipts with site, date, shift (by close time)
    and tender bucket."""
    sa = sales.filter(not_cancelled("cancelled")).select(*RECEIPT_KEY, "time_closed")
    st = broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites)
    j = payments.join(sa, RECEIPT_KEY).join(st, "business_location_id", "left")
    return j.select(
        "business_location_id", "site", "account_reference", "payment_uuid",
        "net_with_tax", "tip", "surcharge", "time_closed",
        business_date("time_closed").alias("business_date"),
        shift_of("time_closed").alias("shift"),
        "code", F.col("description").alias("payment_method"),
        tender_group("code").alias("tender_group"),
    )


def report_lines(lines: DataFrame, sales: DataFrame, sites: DataFrame, rules: DataFrame, lookups=None,
                 dates=None, receipt_cols=()) -> DataFrame:
    """Fact line + first matching category alphabetically + who rang it.

    ``array_min`` over the line's category set replaces the correlated
    ORDER BY .. LIMIT 1: no sort and no second pass over the lines.
    """
    fl = fact_lines(lines, sales, sites, rules, dates=dates, receipt_cols=receipt_cols)
    fl = with_categories(fl, rules, lookups or category_lookups(lines, rules))
    return (fl.withColumn("_p", line_payload(fl))
              .withColumn("item_category", F.array_min("categories"))
              .withColumn("line_staff", F.col("_p.staffName"))
              .withColumn("line_staff_id", nonempty(F.col("_p.staffId")).try_cast("long"))
              .withColumn("void_reason", F.col("_p.voidReason"))
              .withColumn("discount_name", F.col("_p.discountName"))
              .drop("_p"))


def void_lines(lines: DataFrame, sales: DataFrame, sites: DataFrame) -> DataFrame:
    """Lines carrying a void reason, values negated to read positive."""
    sa = sales.filter(not_cancelled("cancelled")).select(*RECEIPT_KEY, "time_closed")
    st = broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites)
    l = lines.withColumn("_p", line_payload(lines)).filter(F.coalesce(F.col("_p.voidReason"), F.lit("")) != "")
    j = l.join(sa, RECEIPT_KEY).join(st, "business_location_id", "left")
    return j.select(
        "business_location_id", "site", "account_reference", "line_id", "sku", "name",
        F.col("_p.voidReason").alias("void_reason"),
        F.coalesce(nonempty(F.col("_p.staffName")), F.lit("(unknown)")).alias("staff_name"),
        (-F.col("net_without_tax")).alias("voided_value"),
        (-F.col("quantity")).alias("voided_qty"),
        business_date("time_closed").alias("business_date"),
        shift_of("time_of_sale", "time_closed").alias("shift"),
    )


def dominant_ringer(lines: DataFrame, staff_col: str, value_col: str) -> DataFrame:
    """Per receipt, the server who rang the most value (ties -> name).

    Rows with a NULL or empty server are ignored; callers pre-filter voids as
    their rule requires. Two aggregations, both keyed on the receipt: the
    per-(receipt, server) sum and then a ``min`` over a (value-is-not-null,
    -value, name) struct, which is "ORDER BY value DESC NULLS FIRST, name" as an
    aggregate -- no window sort. When the input is already hash-partitioned by
    the receipt key (it is, after the lines x receipts join) neither step
    shuffles; the receipt key has no hot values.
    """
    st = F.col(staff_col)
    l = lines.filter(st.isNotNull() & (st != ""))
    per = l.groupBy(*RECEIPT_KEY, st.alias("_staff")).agg(F.sum(value_col).alias("_v"))
    best = per.groupBy(*RECEIPT_KEY).agg(
        F.min(F.struct(F.col("_v").isNotNull().alias("a"), (-F.col("_v")).alias("b"),
                       F.col("_staff").alias("staff"))).alias("_w"),
        F.sum("_v").alias("receipt_value"))
    return best.select(*RECEIPT_KEY, F.col("_w.staff").alias("ringer"), "receipt_value")


def line_staff(rl: DataFrame) -> DataFrame:
    """Report line + who rang it ('' -> NULL)."""
    return rl.withColumn("line_staff", nonempty(F.col("line_staff")))
