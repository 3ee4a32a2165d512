"""Reviews, labour, online orders and manager-form views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.plans.joins import broadcast_if_small
from hearth.sources.reference_data import ASPECTS


# ------------------------------------------------------------------ reviews
def sentiment_overview_view(overview: DataFrame, site_map: DataFrame) -> DataFrame:
    """Overview rows with site keys, the sentiment and mentions of six aspects, and
    positive / negative review % (NULL without reviews)."""
    m = broadcast_if_small(site_map.select("sentiment_label", F.col("nickname").alias("site"), "business_location_id"), basis=site_map)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    pct = lambda a, b: F.when(F.col("reviews") > 0,
                              F.round(100.0 * (z(a) + z(b)) / F.col("reviews").cast("double"), 1))
    return overview.join(m, "sentiment_label", "left").select(
        "period_start", "grain", "site", "business_location_id", "sentiment_label", "reviews", "rating",
        "competitor_rating", "star5", "star4", "star3", "star2", "star1", "nps", "critical",
        *[f"{a}_sentiment" for a in ASPECTS], *[f"{a}_mentions" for a in ASPECTS],
        pct("star5", "star4").alias("positive_pct"), pct("star1", "star2").alias("negative_pct"))


def sentiment_reviews_view(reviews: DataFrame, site_map: DataFrame) -> DataFrame:
    """One row per review with site keys, month bucket and negative flag (<= 3)."""
    m = broadcast_if_small(site_map.select("sentiment_label", F.col("nickname").alias("site"), "business_location_id"), basis=site_map)
    return reviews.join(m, "sentiment_label", "left").select(
        "review_date", F.to_date(F.date_trunc("month", "review_date")).alias("review_month"),
        "site", "business_location_id", "sentiment_label", "source", "rating", "reviewer", "review_text",
        (F.col("rating") <= 3).alias("is_negative"), "review_hash")


def sentiment_site_month(overview_v: DataFrame, cashoff: DataFrame) -> DataFrame:
    """Monthly rating / NPS next to cash-off sales and covers of the same site label."""
    cash = (cashoff.groupBy("site", F.to_date(F.date_trunc("month", "business_date")).alias("period_start"))
            .agg(F.sum("total_sales").alias("cashoff_sales"), F.sum("covers").alias("cashoff_covers")))
    o = overview_v.filter(F.col("grain") == "month")
    return o.join(cash, ["site", "period_start"], "left").select(
        "period_start", "site", "business_location_id", "reviews", "rating", "nps", "positive_pct",
        "negative_pct", "cashoff_sales", "cashoff_covers")


# ------------------------------------------------------------------- labour
def labour_last_night(daily: DataFrame, site_map: DataFrame) -> DataFrame:
    """Latest day per core branch with variances, labour % (NULL without
    sales), RAG status and the over-plan flag."""
    core = site_map.filter(F.col("is_core")).select("branch_id", F.col("site_name").alias("_map_name"))
    d = daily.join(broadcast_if_small(core), "branch_id", "left_semi")
    latest = d.groupBy("branch_id").agg(F.max("biz_date").alias("biz_date"))
    d = d.join(latest, ["branch_id", "biz_date"])
    sales, pctc = F.col("sales"), F.col("percentage")
    col, pcol = F.col("col"), F.col("planned_col")
    rag = (F.when(sales.isNull() | (sales == 0), F.lit("N/A"))
            .when(pctc > 30, F.lit("RED")).when(pctc >= 27, F.lit("AMBER")).otherwise(F.lit("GREEN")))
    over = F.when((pcol > 0) & ((col - pcol) / pcol > 0.05), F.lit(True)).otherwise(F.lit(False))
    return d.select(
        "site_name", "biz_date", "sales", "orders", col.alias("labour_cost"), pcol.alias("planned_labour_cost"),
        F.round(col - pcol, 2).alias("labour_cost_var"), "hours", "planned_hours",
        F.round(F.col("hours") - F.col("planned_hours"), 2).alias("hours_var"),
        F.when(sales > 0, pctc).alias("labour_pct"), F.col("planned_percentage").alias("planned_labour_pct"),
        "splh", "oplh", rag.alias("labour_pct_rag"), over.alias("over_plan_flag"))


def labour_last_night_breakdown(breakdown: DataFrame, site_map: DataFrame) -> DataFrame:
    """Every category row of each core branch's latest date."""
    core = site_map.filter(F.col("is_core")).select("branch_id", "site_name")
    b = breakdown.join(broadcast_if_small(core), "branch_id")
    latest = b.groupBy("branch_id").agg(F.max("biz_date").alias("biz_date"))
    return b.join(latest, ["branch_id", "biz_date"]).select(
        "site_name", "biz_date", "category", F.col("value").alias("actual"), F.col("planned_value").alias("planned"))


# ------------------------------------------------------------ manager forms
def manager_report_last_night(reports: DataFrame, as_of) -> DataFrame:
    """The forms for the day before ``as_of``."""
    d = F.date_sub(F.lit(as_of).cast("date"), 1)
    return reports.filter(F.col("business_date") == d).select(
        "site", F.col("manager_name").alias("manager"), "positive_highlights",
        F.col("stockout_detail").alias("stockouts"), F.col("equipment_detail").alias("equipment"),
        "customer_comments", "incidents", "further_comments")
