"""Leakage (V07) and staff views.

Receipt-level facts (tips, line totals, the dominant ringer) are pre-aggregated
per receipt before they meet the receipt table: every such join is on the
receipt key, which has no hot values. The (site, staff, day) spines are folded
with one groupBy over stacked per-key aggregates instead of DISTINCT + outer
joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, nonempty, not_cancelled, shift_of
from hearth.operators.facts import RECEIPT_KEY, dominant_ringer, line_payload
from hearth.operators.scorecard import _fold
from hearth.plans.joins import broadcast_if_small
from hearth.sources.reference_data import NON_PERSON_OWNERS

# Categories that count as an upsell, and the specials switch.
UPSELL_CATEGORIES = ["desserts", "cocktails", "241 cocktails", "loaded chips", "croquettes", "poppadoms"]
SPECIALS_SWITCH = "2026-08-01"
LEGACY_SPECIALS = ["loaded chips", "croquettes", "railway chicken curry"]
# Generic logins that are never matched against review text.
GENERIC_LOGINS = ["Manager", "Bar", "Floor", "Staff", "Team", "Host", "Server", "Kitchen", "Chef", "Duty",
                  "Waiter", "Waitress", "Admin", "Trainee"]


def _site(sites):
    return broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites)


def _person_owner():
    return ~F.coalesce(F.col("owner_name"), F.lit("")).isin(*NON_PERSON_OWNERS)


def receipt_tips(payments: DataFrame) -> DataFrame:
    """Tips summed per receipt (the correlated SUM of the source, decorrelated)."""
    return payments.groupBy(*RECEIPT_KEY).agg(F.sum("tip").alias("receipt_tips"))


def leakage_lines(lines: DataFrame, sales: DataFrame, sites: DataFrame) -> DataFrame:
    """Void and discount lines in one relation, with the authoriser
    (``staff_name``) and the attributed server (dominant ringer -> owner ->
    line staff -> '(unknown)').

    One pass over the lines: each line explodes into 0, 1 or 2 leakage rows.
    The ringer rule here skips void lines and does not look at cancellation.
    """
    l = (lines.withColumn("_p", line_payload(lines))
              .withColumn("_staff", nonempty(F.col("_p.staffName")))
              .withColumn("_void", F.coalesce(F.col("_p.voidReason"), F.lit("")) != ""))
    prim = dominant_ringer(l.filter(~F.col("_void")), "_staff", "net_without_tax").select(*RECEIPT_KEY, "ringer")
    is_disc = F.coalesce(F.col("discount_amount"), F.lit(0)) != 0
    kinds = F.filter(F.array(F.when(F.col("_void"), F.lit("Void")), F.when(is_disc, F.lit("Discount"))),
                     lambda x: x.isNotNull())
    cand = l.filter(F.col("_void") | is_disc).withColumn("leakage_type", F.explode(kinds))
    sa = sales.filter(not_cancelled()).select(*RECEIPT_KEY, "time_closed", "owner_name")
    j = cand.join(sa, RECEIPT_KEY).join(_site(sites), "business_location_id", "left") \
            .join(prim, RECEIPT_KEY, "left")
    void = F.col("leakage_type") == "Void"
    return j.select(
        "business_location_id", "site", "account_reference", "line_id", "name", "leakage_type",
        F.when(void, F.col("_p.voidReason"))
         .otherwise(F.coalesce(nonempty(F.col("_p.discountName")), F.lit("(unnamed)"))).alias("reason"),
        F.coalesce(F.col("_staff"), F.lit("(unknown)")).alias("staff_name"),
        F.coalesce(F.col("ringer"), nonempty(F.col("owner_name")), F.col("_staff"), F.lit("(unknown)"))
         .alias("attributed_staff"),
        F.when(void, -F.col("net_without_tax")).otherwise(F.col("discount_amount")).alias("amount"),
        business_date("time_closed").alias("business_date"),
        shift_of("time_of_sale", "time_closed").alias("shift"),
        F.coalesce(F.col("time_of_sale"), F.col("time_closed")).alias("tx_time"),
    )


def staff_day(sales: DataFrame, payments: DataFrame, sites: DataFrame, report_lines: DataFrame,
              specials_switch: str = SPECIALS_SWITCH) -> DataFrame:
    """Per (site, receipt owner, day): receipts, covers, tips, sales, upsells."""
    rec = (sales.filter(not_cancelled() & _person_owner())
                .join(_site(sites), "business_location_id")
                .join(receipt_tips(payments), RECEIPT_KEY, "left")
                .select(*RECEIPT_KEY, "site", F.col("owner_name").alias("staff"),
                        business_date("time_closed").alias("business_date"),
                        F.coalesce(F.col("nb_covers"), F.lit(0)).alias("covers"),
                        F.coalesce(F.col("receipt_tips"), F.lit(0)).alias("tips")))
    ic = F.col("item_category")
    d = F.col("business_date")
    sw = F.lit(specials_switch).cast("date")
    special = ((d >= sw) & (ic == "monthly specials")) | ((d < sw) & ic.isin(*LEGACY_SPECIALS))
    q = lambda cond: F.sum(F.when(cond, F.col("quantity")))
    lines = report_lines.groupBy(*RECEIPT_KEY).agg(
        F.sum("net_ex_vat").alias("sales_exvat"),
        q(ic == "desserts").alias("dessert_qty"),
        q(ic.isin("cocktails", "241 cocktails")).alias("cocktail_qty"),
        q(special).alias("special_qty"),
        q(F.col("wet_dry") == "wet").alias("drink_qty"),
        # for the scorecard (V25): same receipts, so no second pass over the lines
        q(ic == "poppadoms").alias("poppadom_qty"),
        q(ic == "241 cocktails").alias("c241_qty"))
    z = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    return (rec.join(lines, RECEIPT_KEY, "left")
               .groupBy("business_location_id", "site", "staff", "business_date")
               .agg(F.count(F.lit(1)).alias("receipts"), F.sum("covers").cast("long").alias("covers"),
                    F.sum("tips").alias("tips"), z("sales_exvat").alias("sales_exvat"),
                    z("dessert_qty").alias("dessert_qty"), z("cocktail_qty").alias("cocktail_qty"),
                    z("special_qty").alias("special_qty"), z("drink_qty").alias("drink_qty"),
                    F.sum("poppadom_qty").alias("_poppadom_qty"), F.sum("c241_qty").alias("_c241_qty")))


def staff_names(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Staff id -> MIN(name) over receipt owners and line servers (numeric ids only)."""
    owner_id = F.col("p_owner_id") if "p_owner_id" in sales.columns else F.get_json_object("raw", "$.ownerId")
    o = sales.select(owner_id.alias("sid"), F.col("owner_name").alias("name")) \
             .filter(F.col("sid").rlike("^[0-9]+$") & F.col("name").isNotNull())
    l = lines.select(line_payload(lines).alias("_p")).select(F.col("_p.staffId").alias("sid"), F.col("_p.staffName").alias("name")) \
             .filter(F.col("sid").rlike("^[0-9]+$") & nonempty(F.col("name")).isNotNull())
    return (o.unionByName(l).groupBy(F.col("sid").cast("long").alias("staff_id"))
             .agg(F.min("name").alias("name")))


def merge_staff_names(current: DataFrame, batch: DataFrame) -> DataFrame:
    """V23 kept with the load: the least name per id of what is stored and what a batch
    of receipts and lines adds (``staff_names`` of the batch). MIN over both is MIN
    over all rows ever loaded, so reports read this small table and scan no lines."""
    return current.unionByName(batch).groupBy("staff_id").agg(F.min("name").alias("name"))


def staff_hours_day(shifts: DataFrame, sites: DataFrame, names: DataFrame) -> DataFrame:
    """Clocked hours per (site, staff id, day); open shifts add nothing."""
    nm = broadcast_if_small(names)
    micros = F.unix_micros(F.col("clock_out")) - F.unix_micros(F.col("clock_in"))
    return (shifts.filter(F.col("clock_in").isNotNull())
                  .join(_site(sites), "business_location_id")
                  .join(nm, "staff_id", "left")
                  .groupBy("business_location_id", "site", "staff_id",
                           F.coalesce(F.col("name"), F.concat(F.lit("#"), F.col("staff_id").cast("string")))
                            .alias("staff"),
                           business_date("clock_in").alias("business_date"))
                  .agg((F.sum(F.when(F.col("clock_out").isNotNull(), micros)) / 3.6e9).alias("hours")))


def staff_scorecard_day(staff_day_df: DataFrame, sales: DataFrame, sites: DataFrame,
                        hours_day: DataFrame) -> DataFrame:
    """V22 + poppadom / 2-4-1 counts, dwell minutes, turns and hours.

    Hours join on the staff *name*, as in the source: two ids sharing a name
    repeat the row."""
    person = sales.filter(not_cancelled() & _person_owner())
    # poppadom / 2-4-1 counts come from the staff-day pass (same receipts); like
    # the source's join on the owner name, a NULL owner gets none
    known = F.col("staff").isNotNull()
    d = (staff_day_df.withColumn("poppadom_qty", F.when(known, F.col("_poppadom_qty")))
                     .withColumn("c241_qty", F.when(known, F.col("_c241_qty")))
                     .drop("_poppadom_qty", "_c241_qty"))
    secs = (F.unix_micros("time_closed") - F.unix_micros("time_opening"))
    turn = (person.filter(F.col("time_opening").isNotNull() & F.col("time_closed").isNotNull())
            .join(_site(sites), "business_location_id")
            .groupBy("business_location_id", F.col("owner_name").alias("staff"),
                     business_date("time_closed").alias("business_date"))
            .agg((F.sum(secs) / 6e7).alias("dwell_min"), F.count(F.lit(1)).alias("turn_receipts")))
    hrs = hours_day.select("business_location_id", "staff", "business_date", "hours")
    k = ["business_location_id", "staff", "business_date"]
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (d.join(turn, k, "left").join(hrs, k, "left")
            .select("business_location_id", "site", "staff", "business_date", "covers", "receipts", "tips",
                    "sales_exvat", "dessert_qty", "special_qty",
                    z("poppadom_qty").alias("poppadom_qty"), z("c241_qty").alias("c241_qty"),
                    z("dwell_min").alias("dwell_min"), z("turn_receipts").alias("turn_receipts"),
                    z("hours").alias("hours")))


LEAGUE_METRICS = ["sales_exvat", "tips", "covers", "dessert_qty", "special_qty", "poppadom_qty", "c241_qty"]


def staff_league_month(scorecard_day: DataFrame, metrics=LEAGUE_METRICS) -> DataFrame:
    """Monthly rank-of-ranks: rank servers inside their site on each
    metric (1 = most), sum the positions, lowest sum wins."""
    m = (scorecard_day.filter(F.col("staff").isNotNull())
         .groupBy("business_location_id", "site", "staff",
                  F.to_date(F.date_trunc("month", "business_date")).alias("month"))
         .agg(*[F.sum(c).alias(c) for c in metrics]))
    part = Window.partitionBy("business_location_id", "month")
    for c in metrics:
        m = m.withColumn(f"rank_{c}", F.rank().over(part.orderBy(F.col(c).desc_nulls_last())).cast("long"))
    m = m.withColumn("rank_sum", sum(F.col(f"rank_{c}") for c in metrics))
    return m.withColumn("league_rank", F.rank().over(part.orderBy(F.col("rank_sum").asc())).cast("long"))


def staff_reviews_month(scorecard_day: DataFrame, reviews: DataFrame) -> DataFrame:
    """5-star reviews naming a server (whole word, any case), per month.

    Instead of testing every (server, review) pair of a site with a regex, the
    review text is tokenised on non-word characters (letters of any script are
    word characters, so "Jos" is not found in "José") and the tokens are equi
    joined with the server names -- the same word-boundary rule, linear in the
    text size, and no pair blow-up on a busy site.
    """
    staff = (scorecard_day.filter(F.col("staff").isNotNull() & ~F.col("staff").isin(*GENERIC_LOGINS))
             .select("business_location_id", "site", "staff").distinct()
             .withColumn("nm", F.regexp_replace("staff", "[^a-zA-Z]", ""))
             .filter(F.length("nm") >= 3)
             .withColumn("tok", F.lower("nm")))
    tokens = (reviews.filter((F.col("rating") >= 5) & (F.coalesce(F.col("review_text"), F.lit("")) != ""))
              .select("business_location_id", "review_month", "review_hash",
                      F.explode(F.split(F.lower("review_text"), r"[^\p{L}\p{N}_]+")).alias("tok")))
    # the (small) name list is broadcast, so review tokens are matched map-side
    # and common words never meet in one shuffle partition
    hits = tokens.join(broadcast_if_small(staff), ["business_location_id", "tok"])
    return (hits.select("business_location_id", "site", "staff", "review_month", "review_hash").distinct()
                .groupBy("business_location_id", "site", "staff", F.col("review_month").alias("mth"))
                .agg(F.count(F.lit(1)).alias("reviews")))


def staff_eotw_day(line_staff: DataFrame, payments: DataFrame, hours_day: DataFrame, sites: DataFrame) -> DataFrame:
    """Employee-of-the-week day rows: what each server rang, plus covers,
    sales and tips of the receipts where they were the dominant ringer,
    attributed voids and clocked hours. ``line_staff`` are the report lines (V09) with
    ``owner_name`` and ``nb_covers`` of their receipts.

    One aggregate per receipt and server, over one pass of lines and receipts, feeds the
    server's sums, the receipt's dominant ringer (V08, all lines) and the ringer that
    voids go to (V07, lines that are not void): the receipt's fold keeps both, and its
    void sums by server, which are as few as its servers."""
    ic, staff, net = F.col("item_category"), F.col("line_staff"), F.col("net_ex_vat")
    void = F.coalesce(F.col("void_reason"), F.lit("")) != ""
    day = ["business_location_id", "staff", "business_date"]
    per = line_staff.groupBy(*RECEIPT_KEY, "business_date", "owner_name", "nb_covers", "line_staff").agg(
        F.sum(net).alias("net"),
        F.sum(F.when(F.col("wet_dry") == "wet", net)).alias("wet_sales"),
        F.sum(F.when(ic.isin(*UPSELL_CATEGORIES), F.col("quantity"))).alias("upsell_items"),
        F.sum(F.when(~void, net)).alias("kept"), F.bool_or(~void).alias("has_kept"),
        F.sum(F.when(void, -net)).alias("void"), F.bool_or(void).alias("has_void"))
    ls = per.filter(staff.isNotNull()).groupBy("business_location_id", staff.alias("staff"), "business_date").agg(
        F.sum("net").alias("line_sales"), F.sum("wet_sales").alias("wet_sales"), F.sum("upsell_items").alias("upsell_items"))

    def ringer(value: str, condition):
        # "ORDER BY value DESC NULLS FIRST, name" as an aggregate, as in dominant_ringer
        return F.min(F.when(staff.isNotNull() & condition, F.struct(
            F.col(value).isNotNull().alias("a"), (-F.col(value)).alias("b"), staff.alias("staff"))))["staff"]

    receipts = per.groupBy(*RECEIPT_KEY, "business_date", "owner_name", "nb_covers").agg(
        ringer("net", F.lit(True)).alias("ringer"), F.sum(F.when(staff.isNotNull(), F.col("net"))).alias("receipt_value"),
        ringer("kept", F.col("has_kept")).alias("kept_ringer"),
        F.collect_list(F.when(F.col("has_void"), F.struct(staff.alias("staff"), F.col("void").alias("void")))).alias("voids"))
    pday = (receipts.filter(F.col("ringer").isNotNull()).join(receipt_tips(payments), RECEIPT_KEY, "left")
                .groupBy("business_location_id", F.col("ringer").alias("staff"), "business_date")
                .agg(F.sum(F.coalesce(F.col("nb_covers"), F.lit(0))).cast("long").alias("p_covers"),
                     F.sum("receipt_value").alias("p_sales"),
                     F.sum(F.coalesce(F.col("receipt_tips"), F.lit(0))).alias("p_tips")))
    vd = (receipts.filter(F.size("voids") > 0)
                  .select("business_location_id", "business_date", "kept_ringer", "owner_name", F.inline("voids"))
                  .groupBy("business_location_id", F.coalesce("kept_ringer", nonempty(F.col("owner_name")), "staff",
                                                              F.lit("(unknown)")).alias("staff"), "business_date")
                  .agg(F.sum("void").alias("void_value")))
    hrs = hours_day.groupBy(*day).agg(F.sum("hours").alias("hours"))
    d = _fold([ls, pday, vd, hrs], day).join(_site(sites), "business_location_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return d.select("business_location_id", "site", "staff", "business_date",
                    z("line_sales"), z("wet_sales"), z("upsell_items"), z("p_covers"), z("p_sales"),
                    z("p_tips"), z("void_value"), z("hours"))
