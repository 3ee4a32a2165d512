"""Online orders: webhook orders (V54-V56), POS online receipts (V57-V58) and
the reconciliation of the two feeds (V59)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, clean_site_label, local_time, not_cancelled
from hearth.plans.joins import broadcast_if_small

# Receipt owners that mark online orders, a UK postcode at the end
# of the table text (delivery), and the payment code left out of gross.
ONLINE_OWNERS = ["Order Anywhere", "Online Order"]
POSTCODE_END = "(?i)[A-Z]{1,2}[0-9][0-9A-Z]? *[0-9][A-Z]{2}$"
EXCLUDED_PAYMENT = "IKCLIFT"
VAT = 1.20


def _pounds(c: str):
    return (F.col(c).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def orders_view(orders: DataFrame, site_map: DataFrame) -> DataFrame:
    """Pounds, channel from the order type, validity, London date and week;
    the venue name stands in when the venue is not mapped to a site."""
    m = broadcast_if_small(site_map.select("venue_id", "site_name", "business_location_id"), basis=site_map)
    t = F.col("order_type")
    channel = (F.when(t.ilike("%deliver%"), F.lit("Delivery"))
                .when(t.ilike("%pickup%") | t.ilike("%collect%"), F.lit("Pickup"))
                .otherwise(F.lit("Dine-in")))
    local = local_time("created_at")
    return orders.join(m, "venue_id", "left").select(
        "order_id", "venue_id", F.coalesce(F.col("site_name"), F.col("venue_name")).alias("site"),
        "business_location_id", "code", "order_type", channel.alias("channel"), "status", "is_refunded",
        (~F.col("status").isin("rejected", "canceled")).alias("is_valid"),
        "created_at", F.to_date(local).alias("order_date"),
        F.to_date(F.date_trunc("week", local)).alias("order_week"),
        _pounds("total_pence").alias("gross_total"), _pounds("tip_pence").alias("tip"),
        _pounds("delivery_fee_pence").alias("delivery_fee"), _pounds("discount_pence").alias("discount"),
        _pounds("net_sales_pence").alias("net_sales"),
        (F.coalesce(F.col("refund_total_pence"), F.lit(0)).cast("decimal(18,0)") * F.lit(Decimal("0.01")))
         .cast("decimal(20,2)").alias("refund"),
        "covers", "customer_email", "marketing_consent")


def _order_aggs(channels: bool):
    ch = F.col("channel")
    net = F.col("net_sales")
    aggs = [
        F.count(F.lit(1)).alias("orders"),
        F.sum(net).alias("net_sales"),
        F.sum("gross_total").alias("gross_sales"),
        (F.sum(net).cast("double") / VAT).alias("net_sales_ex_vat"),
        (F.sum(net).cast("double") / F.count(net)).alias("aov"),
        F.sum("tip").alias("tips"), F.sum("delivery_fee").alias("delivery_fees"),
        F.sum("discount").alias("discounts"), F.sum("refund").alias("refunds"),
        F.count_if(ch == "Pickup").alias("pickup_orders"),
        F.count_if(ch == "Delivery").alias("delivery_orders"),
        F.count_if(ch == "Dine-in").alias("dinein_orders"),
    ]
    if channels:
        aggs += [F.sum(F.when(ch == c, net)).alias(f"{n}_net_sales")
                 for c, n in (("Pickup", "pickup"), ("Delivery", "delivery"), ("Dine-in", "dinein"))]
    return aggs


def orders_daily(view: DataFrame) -> DataFrame:
    """Valid orders per site-day: count, net/gross, ex-VAT, AOV, channel split."""
    return view.filter(F.col("is_valid")).groupBy("site", "business_location_id", "order_date") \
               .agg(*_order_aggs(True))


def orders_weekly(view: DataFrame) -> DataFrame:
    """The same per ISO week."""
    return view.filter(F.col("is_valid")).groupBy("site", "business_location_id", "order_week") \
               .agg(*_order_aggs(False))


def pos_online_receipts(sales: DataFrame, payments: DataFrame, sites: DataFrame) -> DataFrame:
    """Online receipts in the POS feed (online owner labels, table text not
    naming a table; a NULL table text drops out), delivery when the table text
    ends in a UK postcode, gross without the excluded payment code."""
    s = sales.filter(not_cancelled() & F.col("owner_name").isin(*ONLINE_OWNERS)
                     & ~F.col("table_name").ilike("%Table%"))
    st = broadcast_if_small(sites.select("business_location_id", clean_site_label(F.col("nickname")).alias("site")), basis=sites)
    j = s.join(payments.select("business_location_id", "account_reference", "code", "net_with_tax"),
               ["business_location_id", "account_reference"]).join(st, "business_location_id")
    channel = F.when(F.col("table_name").rlike(POSTCODE_END), F.lit("Delivery")).otherwise(F.lit("Collection"))
    return j.groupBy("business_location_id", "site", "account_reference",
                     business_date("time_closed").alias("order_date"), "table_name", channel.alias("channel")) \
            .agg(F.sum(F.when(F.coalesce(F.col("code"), F.lit("")) != EXCLUDED_PAYMENT, F.col("net_with_tax")))
                  .alias("gross_sales"))


def pos_online_daily(receipts: DataFrame) -> DataFrame:
    """POS online receipts per site-day."""
    g, ch = F.col("gross_sales"), F.col("channel")
    return receipts.groupBy("business_location_id", "site", "order_date").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(g).alias("gross_sales"),
        (F.sum(g).cast("double") / VAT).alias("net_sales_ex_vat"),
        (F.sum(g).cast("double") / F.count(g)).alias("aov_gross"),
        F.count_if(ch == "Collection").alias("collection_orders"),
        F.count_if(ch == "Delivery").alias("delivery_orders"),
        F.sum(F.when(ch == "Collection", g)).alias("collection_gross"),
        F.sum(F.when(ch == "Delivery", g)).alias("delivery_gross"))


def feed_reconciliation(webhook_daily: DataFrame, pos_daily: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Daily gross from the POS against the webhook feed per (site, day);
    ``matched`` when both exist and agree within ``tolerance`` pounds."""
    w = webhook_daily.filter(F.col("business_location_id").isNotNull()).select(
        "business_location_id", F.col("order_date").alias("d"), F.col("gross_sales").alias("webhook_gross"))
    p = pos_daily.select("business_location_id", F.col("order_date").alias("d"), F.col("gross_sales").alias("pos_gross"))
    j = w.join(p, ["business_location_id", "d"], "full_outer")
    diff = F.col("pos_gross") - F.col("webhook_gross")
    return j.select("business_location_id", F.col("d").alias("order_date"), "pos_gross", "webhook_gross",
                    diff.alias("diff"), F.coalesce(F.abs(diff) < tolerance, F.lit(False)).alias("matched"))


def feed_match_rate(reconciliation: DataFrame) -> DataFrame:
    """Per site, the days of either feed and the share that agrees."""
    hit = F.count(F.when(F.col("matched"), 1))
    return reconciliation.groupBy("business_location_id").agg(
        F.count(F.lit(1)).alias("days"), hit.alias("days_matched"), F.round(100.0 * hit / F.count(F.lit(1)), 1).alias("match_pct"))
