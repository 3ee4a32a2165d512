"""Adapter: the driver's TPC-H-style parquet tables -> warehouse tables.

Five regions play the five sites, orders are receipts, lineitems are receipt
lines, events are staff shifts and order webhooks, documents are reviews.
Every derived attribute is a deterministic function of the source keys so the
DuckDB twin in ``hearth.plans.oracle`` produces identical rows.

All joins here are equi joins on keys; the only broadcasts are the fixed
25-row nation and 5-row region dimensions. ``customer`` and ``part`` grow with
the data, so they are joined without a hint and AQE decides at run time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, utc_wallclock_to_instant
from hearth.sources import reference_data as R
from hearth.sources.periods import DATE, PERIOD


# How the event test table plays the online-order webhook.
ONLINE_EVENT_MAP = [("signup", "order.created"), ("view", "order.accepted"), ("click", "order.ready_for_pickup"),
                    ("purchase", "order.completed"), ("error", "order.refund.created")]
ONLINE_ORDER_TYPES = ["Pickup", "Delivery", "Dine-in", "Collection"]


def _arr(values):
    return F.array(*[F.lit(v) for v in values])


def _pick(values, idx):
    """values[idx] for a 0-based integer column (NULL index -> NULL)."""
    return F.when(idx.isNotNull(), F.element_at(_arr(values), (idx + 1).cast("int")))


def _add_minutes(ts, minutes):
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def _add_seconds(ts, seconds):
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def item_name(partkey, p_name, p_type):
    """Menu name of a part: some spirits carry a measure ('25ml'/'50ml', a few
    '0% 25ml'), and modifiers are '.'-prefixed."""
    spirit = p_type.isin("LARGE", "MEDIUM") & (partkey % 11 == 0)
    measure = (F.when(partkey % 33 == 0, F.lit(" 0% 25ml")).when(partkey % 22 == 0, F.lit(" 50ml"))
                .otherwise(F.lit(" 25ml")))
    base = F.concat(p_name, F.when(spirit, measure).otherwise(F.lit("")))
    return F.when(partkey % 29 == 0, F.concat(F.lit("."), base)).otherwise(base)


def dec(c, p=14, s=4):
    return c.cast(f"decimal({p},{s})")


class Warehouse:
    """Lazily built warehouse tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # intermediate results shared by several tables go through ``stage``;
        # the stored warehouse writes them once instead of recomputing per table
        self.stage = lambda name, df: df
        # tables derived of other tables read them through ``stored``, and rows that meet
        # receipts are ``dealt`` out by account reference before: the stored warehouse gives
        # its stored copies and deals rows as their buckets are
        self.stored = lambda name: getattr(self, name)
        self.dealt = lambda df: df
        # rows of an input table that are ``spread`` before costly steps are in even parts,
        # however few row groups the input has; the stored warehouse sets their number
        self.spread = lambda df, table, *cols: df

    def src(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ dimensions
    @cached_property
    def sites(self) -> DataFrame:
        r = self.src("region")
        return r.select(
            (F.lit(1000) + r.r_regionkey).cast("long").alias("business_location_id"),
            r.r_name.alias("business_name"),
            F.concat(F.lit("Tap "), r.r_name,
                     F.when(r.r_regionkey == 0, F.lit(".")).otherwise(F.lit(""))).alias("nickname"),
            F.lit(True).alias("active"),
        )

    @cached_property
    def category_rules(self) -> DataFrame:
        return R.category_rules(self.spark)

    @cached_property
    def _order_site(self) -> DataFrame:
        """orderkey -> location, via customer and the 25-row nation table."""
        o = self.src("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                      "o_orderpriority", "o_orderstatus")
        c = self.src("customer").select("c_custkey", "c_nationkey")
        n = self.src("nation").select("n_nationkey", "n_regionkey")
        return self.stage("order_site", o.join(c, o.o_custkey == c.c_custkey)
                 .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
                 .select(o["*"], (F.lit(1000) + n.n_regionkey).cast("long").alias("business_location_id")))

    # ------------------------------------------------------------- receipts
    @cached_property
    def sales(self) -> DataFrame:
        return self._receipts.drop("o_orderkey")

    @cached_property
    def _receipts(self) -> DataFrame:
        o = self._order_site
        k = o.o_orderkey
        closed_utc = _add_minutes(o.o_orderdate, (k * 37) % 1440)
        owner = (F.when(k % 11 == 0, F.lit("Order Anywhere"))
                  .when(k % 13 == 0, F.lit(None).cast("string"))
                  .when(k % 37 == 0, F.lit("Head Office"))
                  .otherwise(_pick(R.STAFF_NAMES, o.o_custkey % 12)))
        owner_id = (F.when(k % 29 == 0, F.lit("web"))
                     .otherwise((F.lit(500) + o.o_custkey % 12).cast("string")))
        table = (F.when(k % 11 == 0,
                        F.when(k % 2 == 0, F.lit("Robin T. ZZ1 4QQ"))
                         .otherwise(F.concat(F.lit("Order 8G"), (k % 10).cast("string"))))
                  .when(k % 19 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("Upper Deck, Table "), (k % 20 + 1).cast("string"))))
        return self.stage("receipts", o.select(
            "o_orderkey",
            "business_location_id",
            k.cast("string").alias("account_reference"),
            k.cast("string").alias("receipt_id"),
            F.when(k % 50 != 0,
                   utc_wallclock_to_instant(_add_minutes(closed_utc, -(F.lit(30) + k % 90)))
                   ).alias("time_opening"),
            utc_wallclock_to_instant(closed_utc).alias("time_closed"),
            F.when(k % 7 != 0, k % 23 == 0).alias("cancelled"),
            (k % 11 != 0).alias("dine_in"),
            F.when(k % 41 != 0, (k % 6).cast("int")).alias("nb_covers"),
            table.alias("table_name"),
            owner.alias("owner_name"),
            F.concat(F.lit("Till "), (k % 3 + 1).cast("string")).alias("device_name"),
            F.to_json(F.struct(owner_id.alias("ownerId"))).alias("raw"),
            owner_id.alias("p_owner_id"),
        ))

    @cached_property
    def sales_lines(self) -> DataFrame:
        li = self.src("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                         "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                         "l_returnflag")
        p = self.src("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
        s = self.stored("sales")
        stored = [c for c in (DATE, PERIOD) if c in s.columns]
        s = s.select("business_location_id", "account_reference", "time_closed", *stored)
        # the part first and the receipt last, over narrow rows: what is derived of both
        # (payload, names, amounts) is built after the last shuffle. The order key goes as
        # the account reference, which is that key as text
        sold = (li.join(p, li.l_partkey == p.p_partkey)
                  .withColumn("account_reference", li.l_orderkey.cast("string")).drop("l_orderkey"))
        j = (self.dealt(sold).join(s, "account_reference")
                 .withColumn("l_orderkey", F.col("account_reference").cast("long")))
        is_void = (j.l_returnflag == "R") & j.l_linenumber.isin(4, 7)
        sign = F.when(is_void, F.lit(-1)).otherwise(F.lit(1))
        ep = dec(j.l_extendedprice, 12, 2)
        disc = dec(j.l_discount, 4, 2)
        net_ex = dec(sign * ep * (F.lit(1) - disc))
        net_inc = dec(net_ex * (F.lit(1) + dec(j.l_tax, 4, 2)))
        group = (F.when(j.p_type == "PROMO", F.lit("Misc"))
                  .when(j.p_type.isin("LARGE", "MEDIUM"), F.lit("Alcoholic Drinks"))
                  .when(j.p_type == "ECONOMY", F.lit("Non-Alcoholic Drinks"))
                  .otherwise(F.lit("Food")))
        group_id = (F.when(j.p_type == "PROMO", F.lit(4))
                     .when(j.p_type.isin("LARGE", "MEDIUM"), F.lit(1))
                     .when(j.p_type == "ECONOMY", F.lit(2))
                     .otherwise(F.lit(3))).cast("long")
        staff_idx = (j.l_suppkey + j.l_linenumber) % 12
        no_staff = j.l_suppkey % 10 == 0
        staff_name = F.when(no_staff, F.lit("")).otherwise(_pick(R.STAFF_NAMES, staff_idx))
        staff_id = F.when(no_staff, F.lit("")).otherwise((F.lit(500) + staff_idx).cast("string"))
        void_reason = (F.when(is_void, F.when(j.l_orderkey % 2 == 0, F.lit("Wrong item"))
                                        .otherwise(F.lit("Customer left")))
                        .when(j.l_orderkey % 97 == 0, F.lit("")))
        discount_name = F.when((j.l_discount > 0.08) & (j.l_suppkey % 2 == 0), F.lit("Staff 50%"))
        raw = F.to_json(F.struct(staff_name.alias("staffName"), staff_id.alias("staffId"),
                                 void_reason.alias("voidReason"), discount_name.alias("discountName")))
        return j.select(
            "business_location_id",
            "account_reference",
            F.concat_ws("-", j.l_linenumber.cast("string"), j.l_partkey.cast("string"),
                        j.l_suppkey.cast("string")).alias("line_id"),
            j.l_partkey.cast("string").alias("sku"),
            item_name(j.p_partkey, j.p_name, j.p_type).alias("name"),
            dec(sign * j.l_quantity, 14, 3).alias("quantity"),
            net_inc.alias("net_with_tax"),
            net_ex.alias("net_without_tax"),
            F.when(j.l_partkey % 19 == 0, dec(F.lit(0))).otherwise(dec(j.p_retailprice, 14, 2))
             .cast("decimal(14,4)").alias("menu_list_price"),
            dec(dec(j.p_retailprice, 12, 2) * F.lit(0.35).cast("decimal(3,2)")).alias("unit_cost_price"),
            dec(net_inc - net_ex).alias("tax_amount"),
            F.when(j.l_discount > 0.08, dec(ep * disc))
             .when(j.l_discount < 0.02, F.lit(None).cast("decimal(14,4)"))
             .otherwise(dec(F.lit(0))).alias("discount_amount"),
            group_id.alias("accounting_group_id"),
            group.alias("accounting_group_name"),
            F.when(group.contains("Drinks"), F.lit("Bar")).otherwise(F.lit("Kitchen")).alias("revenue_center"),
            F.when(j.l_partkey % 17 != 0,
                   j.time_closed - F.make_dt_interval(F.lit(0), F.lit(0), (j.l_linenumber * 10).cast("int"), F.lit(0))
                   ).alias("time_of_sale"),
            raw.alias("raw"),
            staff_name.alias("p_staff_name"),
            staff_id.alias("p_staff_id"),
            void_reason.alias("p_void_reason"),
            discount_name.alias("p_discount_name"),
            *stored,
        )

    @cached_property
    def payments(self) -> DataFrame:
        o = self._order_site
        k = o.o_orderkey
        o = o.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(k % 4 == 0, F.lit(2)).otherwise(F.lit(1)))))
        total = dec(o.o_totalprice, 14, 2)
        code_idx = (o.o_custkey + o.n) % 7
        return o.select(
            "business_location_id",
            k.cast("string").alias("account_reference"),
            F.when(o.n == 1, k.cast("string")).otherwise(F.concat(k.cast("string"), F.lit("-b")))
             .alias("payment_uuid"),
            _pick(R.PAYMENT_CODES, code_idx).alias("code"),
            _pick(R.PAYMENT_DESCRIPTIONS, code_idx).alias("description"),
            code_idx.cast("long").alias("payment_method_id"),
            dec(F.when(k % 4 == 0, total * F.lit(0.5).cast("decimal(2,1)")).otherwise(total)).alias("net_with_tax"),
            dec(F.when(o.n == 1, total * (o.o_custkey % 5).cast("decimal(2,0)") * F.lit(0.01).cast("decimal(3,2)"))
                 .otherwise(F.lit(0))).alias("tip"),
            F.when(o.o_custkey % 9 == 0, dec(F.lit(1.5))).alias("surcharge"),
            F.lit("PAYMENT").alias("type"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Catalogue per site: every part a site has rung up (distinct site x part
        from the lines), with the part's menu attributes."""
        p = self.src("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
        li = self.src("lineitem").select("l_orderkey", "l_partkey")
        r = self._receipts.select("o_orderkey", "business_location_id")
        sold = li.join(r, li.l_orderkey == r.o_orderkey).select("business_location_id", "l_partkey").distinct()
        j = sold.join(p, sold.l_partkey == p.p_partkey)
        group = (F.when(j.p_type == "PROMO", F.lit("Misc"))
                  .when(j.p_type.isin("LARGE", "MEDIUM"), F.lit("Alcoholic Drinks"))
                  .when(j.p_type == "ECONOMY", F.lit("Non-Alcoholic Drinks"))
                  .otherwise(F.lit("Food")))
        return j.select(
            "business_location_id",
            j.p_partkey.alias("item_id"),
            j.p_partkey.cast("string").alias("sku"),
            item_name(j.p_partkey, j.p_name, j.p_type).alias("name"),
            j.p_name.alias("docket_name"),
            group.alias("accounting_group_name"),
            dec(dec(j.p_retailprice, 12, 2) * F.lit(0.35).cast("decimal(3,2)")).alias("cost_price"),
            F.lit("ITEM").alias("item_type"),
            (j.p_partkey % 13 != 0).alias("active"),
        )

    @cached_property
    def staff_shifts(self) -> DataFrame:
        e = self.src("events").select("event_id", "ts", "user_id", "event_type", "value")
        start = utc_wallclock_to_instant(e.ts)
        return e.select(
            (F.lit(1000) + e.user_id % 5).cast("long").alias("business_location_id"),
            e.event_id.cast("string").alias("shift_uuid"),
            (F.lit(500) + e.user_id % 12).cast("long").alias("staff_id"),
            start.alias("clock_in"),
            F.when(e.event_type != "error", _add_seconds(start, F.round(e.value * 60))).alias("clock_out"),
            utc_wallclock_to_instant(F.date_trunc("day", e.ts).cast("timestamp_ntz")).alias("date_in_utc"),
        )

    @cached_property
    def cashoff_daily(self) -> DataFrame:
        """Manager cash-off sheet per (site spelling, London date)."""
        o = self._order_site
        d = business_date(utc_wallclock_to_instant(_add_minutes(o.o_orderdate, (o.o_orderkey * 37) % 1440)))
        total = dec(o.o_totalprice, 14, 2)

        def by(prio):
            return F.sum(F.when(o.o_orderpriority == prio, total))

        agg = (o.groupBy("business_location_id", d.alias("business_date"))
                .agg(F.sum(total).alias("total_sales"),
                     by("4-NOT SPECIFIED").alias("card_sales"),
                     by("5-LOW").alias("online_orders"),
                     by("1-URGENT").alias("uber_eats"),
                     by("2-HIGH").alias("just_eat"),
                     by("3-MEDIUM").alias("deliveroo"),
                     F.count(F.lit(1)).alias("n")))
        s = self.sites
        spelled = F.when(F.dayofmonth(agg.business_date) % 2 == 0, s.nickname) \
                   .otherwise(F.concat(s.business_name, F.lit(".")))
        m2 = lambda c: c.cast("decimal(14,2)")
        return agg.join(F.broadcast(s), "business_location_id").select(
            spelled.alias("site"),
            "business_date",
            m2(agg.total_sales).alias("total_sales"),
            m2(agg.card_sales).alias("card_sales"),
            m2(agg.online_orders).alias("online_orders"),
            m2(agg.uber_eats).alias("uber_eats"),
            m2(agg.just_eat).alias("just_eat"),
            m2(agg.deliveroo).alias("deliveroo"),
            F.lit(None).cast("decimal(14,2)").alias("petty_cash"),
            m2(agg.total_sales * F.lit(0.1).cast("decimal(2,1)")).alias("expected_cash"),
            m2(agg.total_sales * F.lit(0.1).cast("decimal(2,1)") + (agg.n % 7 - 3)).alias("actual_cash"),
            F.lit(None).cast("decimal(14,2)").alias("cash_variance"),
            m2(agg.n * F.lit(2)).alias("card_tips"),
            m2(agg.n % 5).alias("cash_tips"),
            F.when(agg.business_location_id == 1002, m2(agg.n)).alias("service_charge"),
            m2(agg.n * 2).alias("covers"),
            m2(agg.n * F.lit(12.5).cast("decimal(3,1)")).alias("wage_cost"),
        )

    # ------------------------------------------------------------- site maps
    @cached_property
    def ft_site_map(self) -> DataFrame:
        """Booking-system site codes; locations filled by name containment."""
        from hearth.operators.merge import fill_location_ids
        r = self.src("region")
        raw = r.select((F.lit(2000) + r.r_regionkey).cast("int").alias("ft_site_code"),
                       r.r_name.alias("site_name"),
                       F.lit(None).cast("long").alias("business_location_id"),
                       F.lit(True).alias("is_core"))
        extra = self.spark.createDataFrame([(2099, "AFRICA (Darts)", None, True)],
                                           "ft_site_code int, site_name string, business_location_id long, is_core boolean")
        return fill_location_ids(raw.unionByName(extra), self.sites, only_null=False)

    @cached_property
    def storekit_site_map(self) -> DataFrame:
        from hearth.operators.merge import fill_location_ids
        r = self.src("region")
        raw = r.select((F.lit(7000) + r.r_regionkey).cast("long").alias("venue_id"),
                       F.lower(r.r_name).alias("site_name"),
                       F.lit(None).cast("long").alias("business_location_id"),
                       F.lit(True).alias("is_core"))
        return fill_location_ids(raw, self.sites, only_null=False)

    @cached_property
    def nory_site_map(self) -> DataFrame:
        r = self.src("region")
        return r.select(F.concat(F.lit("branch-"), r.r_regionkey.cast("string")).alias("branch_id"),
                        r.r_name.alias("site_name"),
                        (F.lit(1000) + r.r_regionkey).cast("long").alias("business_location_id"),
                        (r.r_regionkey != 4).alias("is_core"))

    @cached_property
    def sentiment_site_map(self) -> DataFrame:
        r = self.src("region")
        return r.select(F.concat(F.lit("The "), r.r_name, F.lit(" Kitchen")).alias("sentiment_label"),
                        (F.lit(1000) + r.r_regionkey).cast("long").alias("business_location_id"),
                        F.concat(r.r_name, F.lit(".")).alias("nickname"))

    # -------------------------------------------------------------- bookings
    @cached_property
    def bookings(self) -> DataFrame:
        o = self._order_site
        k = o.o_orderkey
        m = self.ft_site_map.select(F.col("ft_site_code").alias("_code"),
                                    F.col("site_name").alias("_sn"),
                                    F.col("business_location_id").alias("_bl"))
        code = F.when(k % 40 == 0, F.lit(2099)).otherwise((o.business_location_id - 1000 + 2000).cast("int"))
        o = o.withColumn("ft_site_code", code).join(F.broadcast(m), F.col("ft_site_code") == m._code, "left")
        status_code = F.when(k % 53 != 0, (k % 6 + 1).cast("int"))
        chan_code = _pick([1, 2, 5, 103], k % 4).cast("int")
        iface_code = F.when(chan_code == 103, ((F.floor(k / 4) % 8) + 1).cast("int"))
        secs = ((k * 53) % 50400 + 36000).cast("int")
        bdate = F.to_date(o.o_orderdate)
        guests = (k % 8 + 1).cast("int")
        created_ntz = (F.date_sub(bdate, (k % 4).cast("int")).cast("timestamp_ntz")
                       + F.make_dt_interval(F.lit(0), F.lit(9), F.lit(0), F.lit(0)))
        raw_created = F.when(k % 2 == 0, F.date_format(created_ntz, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        return o.select(
            "ft_site_code",
            k.cast("string").alias("booking_ref_no"),
            F.concat(F.lit("BK"), k.cast("string")).alias("booking_code"),
            F.col("_bl").alias("business_location_id"),
            F.col("_sn").alias("site_name"),
            bdate.alias("booking_date"),
            secs.alias("booking_time_secs"),
            F.when(k % 17 != 0, (k % 90 + 60).cast("int")).alias("duration_mins"),
            guests.alias("guest_count"),
            status_code.alias("status_code"),
            _pick(["Booked", "Confirmed", "Cancelled", "Show", "NoShow", "Complete"], status_code - 1).alias("status"),
            chan_code.alias("sale_channel_code"),
            F.create_map(*[F.lit(x) for kv in [(1, "Web"), (2, "Phone"), (5, "Walk-in"), (103, "Third-party")] for x in kv])
             [chan_code].alias("sale_channel"),
            iface_code.alias("interface_type_code"),
            F.create_map(*[F.lit(x) for kv in [(1, "Google"), (2, "Zomato"), (3, "FTWaiting"), (4, "Swiggy"),
                                               (5, "EasyDinner"), (7, "RezControl"), (8, "SquareMeal")] for x in kv])
             [iface_code].alias("interface_type"),
            F.concat(F.lit("T"), (k % 30).cast("string")).alias("table_no"),
            (o.o_custkey % 3 == 0).alias("is_reward_member"),
            F.when(o.o_custkey % 7 != 0, (o.o_custkey % 5).cast("int")).alias("visits"),
            dec(dec(o.o_totalprice, 14, 2) * F.lit(0.1).cast("decimal(2,1)"), 18, 6).alias("total_amount"),
            dec(F.when(guests > 6, F.lit(10)).otherwise(F.lit(0)), 18, 6).alias("deposit"),
            F.when(k % 31 != 0, utc_wallclock_to_instant(created_ntz)).alias("created_on"),
            F.to_json(F.struct(raw_created.alias("CreatedOn"))).alias("raw"),
        )

    # ---------------------------------------------------------------- labour
    @cached_property
    def _labour_base(self) -> DataFrame:
        o = self._order_site
        d = business_date(utc_wallclock_to_instant(_add_minutes(o.o_orderdate, (o.o_orderkey * 37) % 1440)))
        return (o.groupBy("business_location_id", d.alias("biz_date"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(dec(o.o_totalprice, 14, 2)).alias("s")))

    @cached_property
    def nory_labour_daily(self) -> DataFrame:
        b = self._labour_base
        n = b.n
        hours = dec(n * F.lit(0.5).cast("decimal(2,1)"), 18, 6)
        planned = dec(hours * (F.lit(0.90).cast("decimal(3,2)")
                               + (F.dayofmonth(b.biz_date) % 5).cast("decimal(2,0)") * F.lit(0.05).cast("decimal(3,2)")), 18, 6)
        rate = F.lit(11.5).cast("decimal(3,1)")
        return b.select(
            F.concat(F.lit("branch-"), (b.business_location_id - 1000).cast("string")).alias("branch_id"),
            "biz_date",
            F.col("business_location_id").alias("_bl"),
            dec(hours * rate, 18, 6).alias("col"),
            dec(planned * rate, 18, 6).alias("planned_col"),
            hours.alias("hours"),
            planned.alias("planned_hours"),
            dec(F.when(b.business_location_id == 1003, F.lit(0)).otherwise(b.s), 18, 6).alias("sales"),
            n.cast("int").alias("orders"),
            dec((n * 7) % 45 + 10, 18, 6).alias("percentage"),
            dec(F.lit(28), 18, 6).alias("planned_percentage"),
            dec(n % 50 + 20, 18, 6).alias("splh"),
            dec(F.lit(2), 18, 6).alias("oplh"),
        ).join(F.broadcast(self.nory_site_map.select("branch_id", "site_name")), "branch_id").drop("_bl")

    @cached_property
    def nory_labour_breakdown(self) -> DataFrame:
        d = self.nory_labour_daily
        cats = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(sh).cast("decimal(2,1)").alias("share"))
                         for c, sh in (("FOH", 0.5), ("BOH", 0.3), ("Management", 0.2))])
        e = d.select("branch_id", "biz_date", "col", "planned_col", "orders", F.explode(cats).alias("c"))
        e = e.filter((F.col("c.category") != "Management") | (F.col("orders") % 3 != 0))
        return e.select("branch_id", "biz_date", F.col("c.category").alias("category"),
                        dec(F.col("col") * F.col("c.share"), 18, 6).alias("value"),
                        dec(F.col("planned_col") * F.col("c.share"), 18, 6).alias("planned_value"))

    # ---------------------------------------------------------- market lines
    @cached_property
    def market_lines_raw(self) -> DataFrame:
        """Landed market-stall order lines (one row per sold line, duplicates by plu)."""
        li = self.src("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                         "l_extendedprice", "l_discount", "l_linestatus")
        p = self.src("part").select("p_partkey", "p_name", "p_retailprice")
        r = self.stored("sales").select("account_reference", "time_closed")
        sold = (li.join(p, li.l_partkey == p.p_partkey)
                  .withColumn("account_reference", li.l_orderkey.cast("string")).drop("l_orderkey"))
        j = self.dealt(sold).join(r, "account_reference")
        plu = j.l_partkey % 50
        total = dec(j.l_extendedprice, 14, 2)
        commission = dec(total * F.lit(0.1).cast("decimal(2,1)"), 14, 2)
        return j.select(
            F.lit("Market").alias("site"),
            j.account_reference.alias("order_number"),
            F.when(plu != 0, plu.cast("int")).alias("plu"),
            # arrival order inside an order: line number, then part, then supplier
            (j.l_linenumber.cast("long") * 10**15 + j.l_partkey * 10**7 + j.l_suppkey).alias("seq"),
            j.time_closed.alias("order_time"),
            F.when(plu == 2, F.lit("Tip")).otherwise(j.p_name).alias("name"),
            F.when(j.l_linenumber != 6, dec(j.l_quantity, 14, 3)).alias("quantity"),
            dec(j.p_retailprice, 14, 2).alias("price"),
            total.alias("total"),
            dec(total * dec(j.l_discount, 4, 2), 14, 2).alias("discount_amount"),
            dec(F.lit(0), 14, 2).alias("tip"),
            F.lit(None).cast("decimal(14,2)").alias("charge"),
            commission.alias("commission"),
            dec(total - commission, 14, 2).alias("payout"),
            F.when(j.l_suppkey % 2 == 0, F.lit("card")).otherwise(F.lit("cash")).alias("payment_method"),
            F.array(F.lit("Market"), F.concat(F.lit("Stall "), (j.l_suppkey % 3).cast("string"))).alias("reporting_labels"),
        )

    @cached_property
    def peazi_order_lines(self) -> DataFrame:
        from hearth.sources.feeds import merge_order_lines
        return merge_order_lines(self.market_lines_raw)

    # --------------------------------------------------------------- reviews
    @cached_property
    def sentiment_reviews(self) -> DataFrame:
        d = self.src("documents").select("doc_id", "text", "source")
        r = self.src("region").select("r_regionkey", "r_name")
        j = d.join(F.broadcast(r), (d.doc_id % 5) == r.r_regionkey)
        k = j.doc_id
        label = F.when(k % 37 == 0, F.lit("The Outpost Kitchen")) \
                 .otherwise(F.concat(F.lit("The "), j.r_name, F.lit(" Kitchen")))
        rdate = F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int"))
        text = F.when(k % 3 == 0, F.concat(j.text, F.lit(" Thanks "), _pick(R.STAFF_NAMES, F.floor(k / 3) % 12),
                                           F.lit("!"))).otherwise(j.text)
        reviewer = F.when(k % 6 != 0, F.concat(F.lit("user"), (k % 50).cast("string")))
        rating = dec(F.floor(k / 5) % 5 + 1, 3, 1)
        from hearth.sources.feeds import review_hash
        return j.select(
            review_hash(label, j.source, rdate, reviewer, text).alias("review_hash"),
            label.alias("sentiment_label"),
            j.source.alias("source"),
            rdate.alias("review_date"),
            rating.alias("rating"),
            text.alias("review_text"),
            reviewer.alias("reviewer"),
            F.concat(F.lit("reviews_"), j.source, F.lit(".csv")).alias("source_file"),
        )

    @cached_property
    def sentiment_overview(self) -> DataFrame:
        """Vendor overview rows: month grain and day grain per label. A review mentions the
        aspects that the length of its text points at; an aspect's sentiment is the share
        of the five stars its mentions have, to 2 dp, cut."""
        rv = self.sentiment_reviews
        spoken = lambda i: F.length("review_text") % (i + 2) == 0
        star = lambda n: F.sum(F.when(F.col("rating") == n, 1).otherwise(0)).cast("int")

        def agg(period, grain):
            g = rv.groupBy("sentiment_label", period.alias("period_start")).agg(
                F.count(F.lit(1)).cast("int").alias("reviews"), F.sum("rating").alias("_sum"),
                star(5).alias("star5"), star(4).alias("star4"), star(3).alias("star3"),
                star(2).alias("star2"), star(1).alias("star1"),
                *[F.count_if(spoken(i)).cast("int").alias(f"{a}_mentions") for i, a in enumerate(R.ASPECTS)],
                *[F.sum(F.when(spoken(i), F.col("rating"))).cast("long").alias(f"_{a}") for i, a in enumerate(R.ASPECTS)])
            # average rating to 2 dp, half up, in exact integer arithmetic
            r100 = F.expr("(200 * CAST(_sum AS BIGINT) + reviews) div (2 * reviews)")
            return g.select(
                "sentiment_label", "period_start", F.lit(grain).alias("grain"), "reviews",
                (r100.cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(3,2)").alias("rating"),
                F.lit(None).cast("decimal(3,2)").alias("competitor_rating"),
                "star5", "star4", "star3", "star2", "star1",
                dec(F.col("star5") - F.col("star1") - F.col("star2"), 6, 2).alias("nps"),
                (F.col("star1") + F.col("star2")).alias("critical"),
                *[(F.expr(f"(20 * _{a}) div nullif({a}_mentions, 0)").cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)"))
                  .cast("decimal(3,2)").alias(f"{a}_sentiment") for a in R.ASPECTS],
                *[f"{a}_mentions" for a in R.ASPECTS])
        month = agg(F.to_date(F.date_trunc("month", "review_date")), "month")
        day = agg(F.col("review_date"), "day")
        return month.unionByName(day)

    # --------------------------------------------------------- manager report
    @cached_property
    def manager_daily_report(self) -> DataFrame:
        b = self._labour_base
        s = self.sites
        j = b.join(F.broadcast(s), "business_location_id")
        n = j.n
        return j.select(
            j.business_name.alias("site"),
            F.col("biz_date").alias("business_date"),
            _pick(R.STAFF_NAMES, n % 12).alias("manager_name"),
            F.concat(F.lit("Served "), n.cast("string"), F.lit(" tables")).alias("positive_highlights"),
            F.when(n % 4 == 0, F.lit("Ran out of naan")).alias("stockout_detail"),
            F.when(n % 5 == 0, F.lit("Glasswasher down")).alias("equipment_detail"),
            F.lit(None).cast("string").alias("customer_comments"),
            F.when(n % 9 == 0, F.lit("Minor burn, first aid given")).alias("incidents"),
            F.lit(None).cast("string").alias("further_comments"),
        )

    # ------------------------------------------------------- online webhooks
    @cached_property
    def webhook_deliveries(self) -> DataFrame:
        """Landed webhook deliveries (at-least-once): one per event, every tenth
        delivered twice, a few without a delivery id. ``body`` is the payload as
        received: bare order for order.created, envelope for everything else."""
        e = self.spread(self.src("events").select("event_id", "ts", "user_id", "event_type", "value"), "events", "event_id")
        k, u = F.col("event_id"), F.col("user_id")
        # columns of their own, so that the payload's branches do not work them out again
        e = e.select("*",
                     F.when(k % 50 == 7, F.lit("store.updated"))
                      .otherwise(F.create_map(*[F.lit(x) for kv in ONLINE_EVENT_MAP for x in kv])[e.event_type]).alias("_etype"),
                     _pick(ONLINE_ORDER_TYPES, u % 4).alias("_otype"))
        etype, otype = e["_etype"], e["_otype"]
        oid = F.concat(F.lit("ord_"), F.floor(k / 4).cast("string"))
        venue = F.struct((F.lit(7000) + u % 6).cast("long").alias("id"),
                         F.concat(F.lit("Venue "), (u % 6).cast("string")).alias("name"),
                         F.concat(F.lit("venue-"), (u % 6).cast("string")).alias("slug"))
        order = F.struct(
            oid.alias("id"), F.concat(F.lit("C"), k.cast("string")).alias("code"), otype.alias("orderType"),
            (k % 2 == 0).alias("asap"),
            F.date_format(e.ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("createdAt"),
            F.lit(None).cast("string").alias("deliveryTime"),
            F.round(e.value * 100, 2).alias("total"), ((u % 4) * 50).alias("tip"),
            F.when(otype == "Delivery", F.lit(250)).alias("deliveryFee"),
            F.when(k % 5 == 0, F.lit(100)).otherwise(F.lit(0)).alias("discountTotal"),
            venue.alias("venue"),
            F.struct(F.concat(F.lit("Guest"), u.cast("string")).alias("firstName"),
                     F.concat(F.lit("g"), u.cast("string"), F.lit("@example.com")).alias("email"),
                     (u % 2 == 0).alias("marketingConsent")).alias("customer"),
            F.struct(F.when(otype == "Dine-in", (u % 4 + 1).cast("int")).alias("covers")).alias("table"),
            F.array(F.struct(F.lit("Curry").alias("name"), (u % 3 + 1).alias("qty"))).alias("items"))
        slim = F.struct(
            F.struct(oid.alias("id")).alias("order"),
            F.when(k % 3 != 0, F.struct(venue["id"].alias("id"), venue["name"].alias("name"))).alias("venue"),
            F.when(etype == "order.refund.created", F.struct(F.round(e.value * 50).cast("long").alias("amount")))
             .alias("refund"))
        body = (F.when(etype == "order.created", F.to_json(order))
                 .when(etype == "order.accepted", F.to_json(F.struct(etype.alias("event"), order.alias("data"))))
                 .otherwise(F.to_json(F.struct(etype.alias("event"), slim.alias("data")))))
        svix = F.when(k % 30 == 0, F.lit("")).otherwise(F.concat(F.lit("msg_"), k.cast("string")))
        once = e.select((k * 2).alias("seq"), utc_wallclock_to_instant(e.ts).alias("received_at"),
                        svix.alias("svix_id"), body.alias("body"),
                        F.when(k % 10 == 0, _arr([0, 1])).otherwise(_arr([0])).alias("_copies"))
        again = F.col("_copy") == 1
        sent = once.select("seq", "received_at", "svix_id", "body", F.explode("_copies").alias("_copy"))
        return self.stage("webhook_deliveries", sent.select(
            (F.col("seq") + F.col("_copy")).alias("seq"),
            F.when(again, F.col("received_at") + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col("received_at")).alias("received_at"),
            "svix_id", "body"))

    @cached_property
    def storekit_orders(self) -> DataFrame:
        from hearth.sources.feeds import normalise_events
        from hearth.streaming.orders import fold_deliveries, with_net_sales
        # parse every delivery once; de-duplication reads the ids of the parsed copy apart
        ev = self.stage("webhook_events", normalise_events(self.webhook_deliveries))
        return with_net_sales(fold_deliveries(ev))

    # ------------------------------------------------- drinks reference rows
    def _drink_parts(self, p_type: str, mod: int, rem: int) -> DataFrame:
        p = self.src("part").select("p_partkey", "p_name", "p_type", "p_size")
        return p.filter((p.p_type == p_type) & (p.p_partkey % mod == rem))

    @cached_property
    def keg_ref(self) -> DataFrame:
        p = self._drink_parts("LARGE", 7, 0)
        return p.select(p.p_partkey.cast("string").alias("sku"),
                        F.concat(F.lit("Keg "), (p.p_partkey % 3).cast("string")).alias("keg_name"),
                        F.lit(30).alias("keg_litres"),
                        F.when(p.p_size % 2 == 0, F.lit(568)).otherwise(F.lit(284)).alias("serve_ml"))

    @cached_property
    def packaged_ref(self) -> DataFrame:
        p = self._drink_parts("MEDIUM", 7, 0)
        return p.select(p.p_partkey.cast("string").alias("sku"),
                        F.concat(F.lit("Bottle "), p.p_name).alias("product"))

    @cached_property
    def cocktail_bom(self) -> DataFrame:
        p = self._drink_parts("LARGE", 5, 1)
        a = p.select(p.p_partkey.cast("string").alias("sku"),
                     F.concat(F.lit("Spirit "), (p.p_partkey % 4).cast("string")).alias("spirit"),
                     F.lit(25).cast("decimal(6,2)").alias("ml"))
        b = p.select(p.p_partkey.cast("string").alias("sku"),
                     F.concat(F.lit("Spirit "), ((p.p_partkey + 1) % 4).cast("string")).alias("spirit"),
                     F.lit(12.5).cast("decimal(6,2)").alias("ml"))
        return a.unionByName(b)

    @cached_property
    def cocktail_ref(self) -> DataFrame:
        p = self._drink_parts("LARGE", 5, 1)
        return p.select(p.p_partkey.cast("string").alias("sku"),
                        F.concat(p.p_name, F.lit(" cocktail")).alias("cocktail_name"),
                        (p.p_size % 3 == 0).alias("is_spritz"))

    @cached_property
    def wine_ref(self) -> DataFrame:
        p = self._drink_parts("MEDIUM", 5, 2)
        return p.select(p.p_partkey.cast("string").alias("sku"),
                        F.concat(F.lit("Wine "), (p.p_partkey % 3).cast("string")).alias("wine_name"),
                        _pick([125, 175, 250, 750], p.p_partkey % 4).alias("ml"))

    # ------------------------------------------------------ landed raw feeds
    @staticmethod
    def _iso(ts, micros: bool = False):
        from hearth.functions.semantics import local_time
        fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'" if micros else "yyyy-MM-dd'T'HH:mm:ss'Z'"
        return F.date_format(local_time(ts, "UTC"), fmt)

    @cached_property
    def receipt_docs(self) -> DataFrame:
        """Receipt payloads as the POS returns them, one JSON document per
        receipt with its lines and payments nested; key spellings alternate
        and a few payloads lack the account reference."""
        key = ["business_location_id", "account_reference"]
        l = self.stored("sales_lines")
        odd = F.split(l.line_id, "-").getItem(0).cast("int") % 2 == 1
        disc = l.discount_amount.cast("string")
        line = F.struct(
            l.line_id.alias("id"), l.sku.alias("sku"), l["name"].alias("name"),
            l.quantity.cast("string").alias("quantity"),
            l.net_with_tax.cast("string").alias("totalNetAmountWithTax"),
            l.net_without_tax.cast("string").alias("totalNetAmountWithoutTax"),
            l.menu_list_price.cast("string").alias("menuListPrice"),
            l.unit_cost_price.cast("string").alias("unitCostPrice"),
            l.tax_amount.cast("string").alias("taxAmount"),
            F.when(~odd, disc).alias("totalDiscountAmount"), F.when(odd, disc).alias("discountAmount"),
            F.struct(F.when(~odd, l.accounting_group_id).alias("accountingGroupId"),
                     F.when(odd, l.accounting_group_id).alias("id"),
                     l.accounting_group_name.alias("name")).alias("accountingGroup"),
            l.revenue_center.alias("revenueCenter"), self._iso(l.time_of_sale).alias("timeOfSale"),
            l.p_staff_id.alias("staffId"), l.p_staff_name.alias("staffName"),
            l.p_void_reason.alias("voidReason"), l.p_discount_name.alias("discountName"))
        lines = l.groupBy(*key).agg(F.collect_list(line).alias("salesLines"))
        p = self.stored("payments")
        second = p.payment_uuid.endswith("-b")
        pay = F.struct(F.when(~second, p.payment_uuid).alias("uuid"),
                       F.when(second, p.payment_uuid).alias("externalReference"),
                       p.code.alias("code"), p.description.alias("description"),
                       p.payment_method_id.cast("string").alias("paymentMethodId"),
                       p.net_with_tax.cast("string").alias("netAmountWithTax"), p.tip.cast("string").alias("tip"),
                       p.surcharge.cast("string").alias("surcharge"), p["type"].alias("type"))
        pays = p.groupBy(*key).agg(F.collect_list(pay).alias("payments"))
        s = self.stored("sales").join(lines, key, "left").join(pays, key, "left")
        k = s.account_reference.cast("long")
        opening, closed = self._iso(s.time_opening), self._iso(s.time_closed)
        doc = lambda ref: F.to_json(F.struct(
            ref.alias("accountReference"), s.receipt_id.alias("receiptId"),
            F.when(k % 2 == 0, opening).alias("timeOfOpening"), F.when(k % 2 == 1, opening).alias("timeofOpening"),
            F.when(k % 3 != 0, closed).alias("timeClosed"), F.when(k % 3 == 0, closed).alias("timeofCloseAndPaid"),
            s.cancelled.alias("cancelled"), s.dine_in.alias("dineIn"), s.nb_covers.cast("string").alias("nbCovers"),
            s.table_name.alias("tableName"), s.owner_name.alias("ownerName"), s.p_owner_id.alias("ownerId"),
            s.device_name.alias("deviceName"), F.col("salesLines"), F.col("payments")))
        good = s.select("business_location_id", doc(s.account_reference).alias("doc"))
        junk = s.filter(k % 997 == 0).select("business_location_id", doc(F.lit(None).cast("string")).alias("doc"))
        return good.unionByName(junk)

    @cached_property
    def shift_docs(self) -> DataFrame:
        """Shift payloads with their clock events (a late duplicate CLOCK_IN and
        a BREAK among them); a few lack the uuid."""
        e = self.src("events").select("event_id", "ts", "user_id", "event_type", "value")
        start = utc_wallclock_to_instant(e.ts)
        out = _add_seconds(start, F.round(e.value * 60))
        ev = F.array(
            F.struct(F.lit("CLOCK_IN").alias("eventType"), self._iso(start, True).alias("timestamp")),
            F.struct(F.lit("BREAK").alias("eventType"), self._iso(start, True).alias("timestamp")),
            F.struct(F.lit("CLOCK_IN").alias("eventType"),
                     self._iso(_add_seconds(start, F.lit(3600)), True).alias("timestamp")),
            F.struct(F.lit("CLOCK_OUT").alias("eventType"),
                     F.when(e.event_type != "error", self._iso(out, True)).alias("timestamp")))
        doc = F.to_json(F.struct(F.when(e.event_id % 41 != 0, e.event_id.cast("string")).alias("uuid"),
                                 (F.lit(500) + e.user_id % 12).cast("string").alias("staffId"),
                                 self._iso(utc_wallclock_to_instant(F.date_trunc("day", e.ts).cast("timestamp_ntz")))
                                 .alias("dateInUTC"),
                                 ev.alias("events")))
        return e.select((F.lit(1000) + e.user_id % 5).cast("long").alias("business_location_id"), doc.alias("doc"))

    @cached_property
    def booking_docs(self) -> DataFrame:
        """Booking payloads per (site code, date) with alternate key spellings,
        start/end times for some and a Duration in seconds for others."""
        b = self.bookings
        k = b.booking_ref_no.cast("long")
        se = k % 4 == 0
        dur = b.duration_mins
        doc = F.to_json(F.struct(
            F.when(k % 2 == 0, b.booking_ref_no).alias("BookingRefNo"),
            F.when(k % 2 == 1, b.booking_ref_no).alias("BookingRef"),
            b.booking_code.alias("BookingCode"),
            F.when(k % 3 != 0, b.status_code).alias("BookingStatusCode"),
            F.when(k % 3 == 0, b.status_code).alias("StatusCode"),
            b.sale_channel_code.alias("SaleChannelCode"), b.interface_type_code.alias("InterfaceTypeCode"),
            F.when(~se, b.booking_time_secs).alias("BookingTime"),
            F.when(se, b.booking_time_secs).alias("BookingStartTime"),
            F.when(se & dur.isNotNull(), b.booking_time_secs + dur * 60).alias("BookingEndTime"),
            F.when(~se, F.when(k % 5 == 0, dur * 60).otherwise(dur)).alias("Duration"),
            F.when(k % 2 == 0, b.guest_count).alias("GuestCount"), F.when(k % 2 == 1, b.guest_count).alias("Covers"),
            b.table_no.alias("TableNo"),
            F.when(b.is_reward_member, F.lit("1")).otherwise(F.lit("0")).alias("IsRewardMember"),
            b.visits.alias("Visits"), b.total_amount.cast("string").alias("TotalAmount"),
            b.deposit.cast("string").alias("Deposit"), self._iso(b.created_on).alias("CreatedOn")))
        return b.select(F.col("ft_site_code").alias("site_code"), F.col("booking_date").alias("the_date"),
                        doc.alias("doc"))

    @cached_property
    def item_pages(self) -> DataFrame:
        """Catalogue pages of ~50 items per site in every wrapper shape the item
        endpoint uses (bare list, _embedded, content, data, results), plus the
        first item of each page alone as a single-object page."""
        it = self.items
        page = F.floor(it.item_id / 50)
        item = F.struct(it.item_id.alias("id"), it.sku.alias("sku"), it["name"].alias("name"),
                        it.docket_name.alias("docketName"),
                        F.struct(it.accounting_group_name.alias("name")).alias("accountingGroup"),
                        it.cost_price.cast("string").alias("costPrice"), it.item_type.alias("itemType"),
                        it.active.alias("active"))
        g = (it.groupBy("business_location_id", page.alias("page"))
               .agg(F.sort_array(F.collect_list(item)).alias("items")))
        shape = g.page % 5
        rest = F.slice("items", F.lit(2), F.size("items"))
        doc = (F.when(shape == 0, F.to_json(rest))
                .when(shape == 1, F.to_json(F.struct(F.struct(rest.alias("itemList")).alias("_embedded"))))
                .when(shape == 2, F.to_json(F.struct(rest.alias("content"))))
                .when(shape == 3, F.to_json(F.struct(rest.alias("data"))))
                .otherwise(F.to_json(F.struct(rest.alias("results")))))
        single = F.to_json(F.element_at("items", 1))
        a = g.select("business_location_id", doc.alias("doc"))
        b = g.select("business_location_id", single.alias("doc"))
        return a.unionByName(b)

    @cached_property
    def business_docs(self) -> DataFrame:
        """Business payloads: our business with every site as a location (the id
        under a different key per site), and another business to be filtered."""
        s = self.sites
        bl = s.business_location_id
        loc = F.struct(
            F.when(bl % 3 == 0, bl.cast("string")).alias("blId"),
            F.when(bl % 3 == 1, bl).alias("businessLocationId"),
            F.when(bl % 3 == 2, bl.cast("string")).alias("id"),
            s.nickname.alias("blName"))
        locs = s.agg(F.sort_array(F.collect_list(loc)).alias("locs"))
        ours = locs.select(F.to_json(F.struct(F.lit("1").alias("businessId"), F.lit("Group").alias("businessName"),
                                              F.col("locs").alias("businessLocations"))).alias("doc"))
        other = locs.select(F.to_json(F.struct(F.lit("2").alias("businessId"),
                                               F.col("locs").alias("businessLocations"))).alias("doc"))
        return ours.unionByName(other)

    @cached_property
    def cashoff_sheet(self) -> DataFrame:
        """Cash-off form rows as sheet cells (text as typed: pound signs,
        thousands commas, US dates), with an earlier, superseded row for some days."""
        c = self.cashoff_daily
        money = lambda x: F.when(x.isNotNull(), F.concat(F.lit("£"), F.format_number(x, 2)))
        d = F.date_format(c.business_date, "M/d/yyyy")
        cells = F.array(d, money(c.total_sales), money(c.card_sales), money(c.online_orders), money(c.uber_eats),
                        money(c.just_eat), money(c.deliveroo), money(c.petty_cash), money(c.expected_cash),
                        money(c.actual_cash), money(c.card_tips), money(c.cash_tips), money(c.service_charge),
                        c.covers.cast("string"))
        ordinal = F.datediff(c.business_date, F.lit("1990-01-01")) * 2 + 1
        good = c.select("site", ordinal.alias("ordinal"), cells.alias("cells"))
        stale = c.filter(F.dayofmonth(c.business_date) % 4 == 0).select(
            "site", (ordinal - 1).alias("ordinal"), F.array(d, F.lit("£1.00")).alias("cells"))
        return good.unionByName(stale)

    @cached_property
    def manager_sheet(self) -> DataFrame:
        """Manager form rows as cells, plus rows for an unknown site."""
        m = self.manager_daily_report
        cells = F.array(F.date_format(m.business_date, "M/d/yyyy 23:15:00"), m.site,
                        F.date_format(m.business_date, "M/d/yyyy"), m.manager_name, m.positive_highlights,
                        m.stockout_detail, m.equipment_detail, m.customer_comments, m.incidents, m.further_comments)
        ordinal = F.datediff(m.business_date, F.lit("1990-01-01")) * 10 + F.length(m.site)
        good = m.select(ordinal.alias("ordinal"), cells.alias("cells"))
        unknown = m.filter(F.dayofmonth(m.business_date) == 1).select(
            (ordinal + 5).alias("ordinal"),
            F.array(F.lit(""), F.lit("Nowhere"), F.date_format(m.business_date, "M/d/yyyy")).alias("cells"))
        return good.unionByName(unknown)

    @cached_property
    def item_name_categories(self) -> DataFrame:
        """Name -> item categories (the ILIKE rules over every distinct line
        name), maintained with the load so reports need not rescan the lines."""
        from hearth.operators.facts import name_category_table
        return name_category_table(self.stored("sales_lines"), self.category_rules)

    @cached_property
    def staff_names(self) -> DataFrame:
        """Staff id -> least name, maintained with the load (see
        ``staff.merge_staff_names``) so reports need not rescan the lines."""
        from hearth.operators.staff import staff_names
        return staff_names(self.stored("sales"), self.stored("sales_lines"))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)
