"""Named queries over the test tables, each with its DuckDB oracle twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``. Every
query reads whole tables through the adapter; date-range parameters span the
whole data, and ``as_of`` dates sit at the end of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators import facts as V
from hearth.operators import staff as ST
from hearth.plans.oracle import with_prelude
from hearth.sources.store import stored_warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_BODY: dict[str, str] = {}
ORACLE: dict[str, str] = {}

# Parameters: the full order period, and the "today" of order- and event-based reports.
START = "1995-01-01 00:00:00"
END = "2002-01-01 00:00:00"
AS_OF_ORDERS = "2001-08-01"
AS_OF_EVENTS = "2024-01-31"


class Ctx:
    """Warehouse plus the shared derived relations, built lazily once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.w = stored_warehouse(spark, sf_dir)
        self.spark = spark

    @cached_property
    def fact_lines(self) -> DataFrame:
        w = self.w
        return V.fact_lines(w.sales_lines, w.sales, w.sites, w.category_rules)

    @cached_property
    def cat_lookups(self):
        return V.category_lookups(self.w.sales_lines, self.w.category_rules,
                                  name_table=self.w.item_name_categories)

    @cached_property
    def lines_with_cats(self) -> DataFrame:
        return V.with_categories(self.fact_lines, self.w.category_rules, self.cat_lookups)

    def fact_lines_on(self, first, last=None) -> DataFrame:
        """V03 of some business dates: reads their partitions only."""
        w = self.w
        return V.fact_lines(w.sales_lines, w.sales, w.sites, w.category_rules, dates=(first, last))

    def lines_with_cats_on(self, first, last=None) -> DataFrame:
        return V.with_categories(self.fact_lines_on(first, last), self.w.category_rules, self.cat_lookups)

    @cached_property
    def line_staff_receipts(self) -> DataFrame:
        """V09 with the owner and the covers of the receipt."""
        w = self.w
        return V.line_staff(V.report_lines(w.sales_lines, w.sales, w.sites, w.category_rules, self.cat_lookups,
                                           receipt_cols=("owner_name", "nb_covers")))

    @cached_property
    def report_lines(self) -> DataFrame:
        w = self.w
        return V.report_lines(w.sales_lines, w.sales, w.sites, w.category_rules, self.cat_lookups)

    @cached_property
    def line_staff(self) -> DataFrame:
        """Report lines with the ringer ('' -> NULL)."""
        return V.line_staff(self.report_lines)

    @cached_property
    def fact_payments(self) -> DataFrame:
        w = self.w
        return V.fact_payments(w.payments, w.sales, w.sites)

    @cached_property
    def void_lines(self) -> DataFrame:
        w = self.w
        return V.void_lines(w.sales_lines, w.sales, w.sites)

    @cached_property
    def dish_day(self) -> DataFrame:
        from hearth.operators.baskets import kitchen_dish_day
        return kitchen_dish_day(self.report_lines, self.w.peazi_order_lines)

    @cached_property
    def sentiment_overview_v(self) -> DataFrame:
        from hearth.operators.feeds import sentiment_overview_view
        return sentiment_overview_view(self.w.sentiment_overview, self.w.sentiment_site_map)

    @cached_property
    def reviews_v(self) -> DataFrame:
        from hearth.operators.feeds import sentiment_reviews_view
        return sentiment_reviews_view(self.w.sentiment_reviews, self.w.sentiment_site_map)

    @cached_property
    def online_orders_v(self) -> DataFrame:
        from hearth.operators.online import orders_view
        return orders_view(self.w.storekit_orders, self.w.storekit_site_map)

    @cached_property
    def pos_online(self) -> DataFrame:
        from hearth.operators.online import pos_online_receipts
        return pos_online_receipts(self.w.sales, self.w.payments, self.w.sites)

    @cached_property
    def leakage(self) -> DataFrame:
        return ST.leakage_lines(self.w.sales_lines, self.w.sales, self.w.sites)

    @cached_property
    def staff_day(self) -> DataFrame:
        return ST.staff_day(self.w.sales, self.w.payments, self.w.sites, self.report_lines)

    @cached_property
    def staff_names(self) -> DataFrame:
        """The dimension kept with the load; no report scans the lines for names."""
        return self.w.staff_names

    @cached_property
    def hours_day(self) -> DataFrame:
        return ST.staff_hours_day(self.w.staff_shifts, self.w.sites, self.staff_names)

    @cached_property
    def scorecard_day(self) -> DataFrame:
        return ST.staff_scorecard_day(self.staff_day, self.w.sales, self.w.sites, self.hours_day)


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Ctx], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Ctx(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if oracle is not None:
            ORACLE_BODY[name] = oracle
        return fn
    return deco


def dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# --------------------------------------------------------------------- loaders
# Importing the query modules fills QUERIES / ORACLE.
def load_all():
    from hearth.plans import q_facts  # noqa: F401
    for mod in ("q_scorecard", "q_menu", "q_staff", "q_drinks", "q_bookings", "q_feeds", "q_online", "q_alerts",
                "q_reports", "q_sources", "q_merge"):
        try:
            __import__(f"hearth.plans.{mod}")
        except ModuleNotFoundError as e:  # modules land incrementally
            if e.name != f"hearth.plans.{mod}":
                raise
    # oracle texts are completed once every module has added its shared views
    for k, body in ORACLE_BODY.items():
        if k not in ORACLE:
            ORACLE[k] = with_prelude(body)
    return QUERIES, ORACLE
