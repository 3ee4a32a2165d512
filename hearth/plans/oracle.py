"""DuckDB twin of the test-data adapter, as a WITH prelude for oracle SQL.

Each warehouse table (and each shared view) is one CTE. ``with_prelude(body)``
prepends only the CTEs the body refers to, in dependency order. The text is
plain DuckDB SQL over the driver's pre-registered views (orders, lineitem, ...).
"""

from __future__ import annotations

import re

from hearth.sources import reference_data as R


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def lon(ts: str) -> str:
    """London wall-clock of a naive-UTC timestamp expression."""
    return f"timezone('Europe/London', timezone('UTC', {ts}))"


def bdate(ts: str) -> str:
    return f"CAST({lon(ts)} AS DATE)"


def shift(ts: str) -> str:
    h = f"EXTRACT(HOUR FROM {lon(ts)})"
    return (f"CASE WHEN {h} BETWEEN 12 AND 16 THEN 'Lunch (12-5)' "
            f"WHEN {h} BETWEEN 17 AND 21 THEN 'Dinner (5-10)' ELSE 'Other' END")


def site_key(x: str) -> str:
    return f"replace(regexp_replace(lower({x}), '[^a-z]', '', 'g'), 'tap', '')"


def site_label(x: str) -> str:
    """A site's short label: no 'Tap ' in front, no dots behind."""
    return f"regexp_replace(rtrim({x}, '.'), '^Tap ', '')"


def round_div(num: str, den: str, digits: int, scale: int = 4) -> str:
    """Exact round(num / den, digits), half away from zero, for an integer ``den``
    and a ``num`` with at most ``scale`` decimals, in integer arithmetic."""
    a = f"abs(CAST(({num}) * {10 ** scale} AS HUGEINT)) * {10 ** digits}"
    b = f"CAST(({den}) AS HUGEINT) * {10 ** scale}"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign({num}) * "
            f"CAST((2 * {a} + {b}) // (2 * {b}) AS DOUBLE) / {10 ** digits} END)")


def item_name(k: str, name: str, typ: str) -> str:
    base = (f"({name} || CASE WHEN {typ} IN ('LARGE', 'MEDIUM') AND {k} % 11 = 0 THEN "
            f"(CASE WHEN {k} % 33 = 0 THEN ' 0% 25ml' WHEN {k} % 22 = 0 THEN ' 50ml' ELSE ' 25ml' END) ELSE '' END)")
    return f"(CASE WHEN {k} % 29 = 0 THEN '.' || {base} ELSE {base} END)"


STAFF = _list(R.STAFF_NAMES)
CODES = _list(R.PAYMENT_CODES)
DESCS = _list(R.PAYMENT_DESCRIPTIONS)

_rules_rows = ",\n    ".join(
    f"({i}, '{d}', '{c}', '{t}', '{v}', {p}, {str(a).upper()})" for (i, d, c, t, v, p, a) in R.CATEGORY_RULES)

CLOSED = "(o.o_orderdate + to_minutes(CAST((o.o_orderkey * 37) % 1440 AS INTEGER)))"

TABLES: dict[str, str] = {}

TABLES["sites"] = """
  SELECT CAST(1000 + r_regionkey AS BIGINT) AS business_location_id,
         r_name AS business_name,
         'Tap ' || r_name || CASE WHEN r_regionkey = 0 THEN '.' ELSE '' END AS nickname,
         TRUE AS active
  FROM region"""

TABLES["category_rules"] = f"""
  SELECT * FROM (VALUES
    {_rules_rows}
  ) t(id, dimension, category, match_type, match_value, priority, active)"""

TABLES["order_site"] = """
  SELECT o.*, CAST(1000 + n.n_regionkey AS BIGINT) AS business_location_id
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey"""

TABLES["receipts"] = f"""
  SELECT o.o_orderkey,
         o.business_location_id,
         CAST(o.o_orderkey AS VARCHAR) AS account_reference,
         CAST(o.o_orderkey AS VARCHAR) AS receipt_id,
         CASE WHEN o.o_orderkey % 50 <> 0
              THEN {CLOSED} - to_minutes(CAST(30 + o.o_orderkey % 90 AS INTEGER)) END AS time_opening,
         {CLOSED} AS time_closed,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_orderkey % 23 = 0 END AS cancelled,
         o.o_orderkey % 11 <> 0 AS dine_in,
         CASE WHEN o.o_orderkey % 41 <> 0 THEN CAST(o.o_orderkey % 6 AS INTEGER) END AS nb_covers,
         CASE WHEN o.o_orderkey % 11 = 0 THEN
                   CASE WHEN o.o_orderkey % 2 = 0 THEN 'Robin T. ZZ1 4QQ'
                        ELSE 'Order 8G' || CAST(o.o_orderkey % 10 AS VARCHAR) END
              WHEN o.o_orderkey % 19 = 0 THEN NULL
              ELSE 'Upper Deck, Table ' || CAST(o.o_orderkey % 20 + 1 AS VARCHAR) END AS table_name,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 'Order Anywhere'
              WHEN o.o_orderkey % 13 = 0 THEN NULL
              WHEN o.o_orderkey % 37 = 0 THEN 'Head Office'
              ELSE {STAFF}[o.o_custkey % 12 + 1] END AS owner_name,
         'Till ' || CAST(o.o_orderkey % 3 + 1 AS VARCHAR) AS device_name,
         CAST(json_object('ownerId', CASE WHEN o.o_orderkey % 29 = 0 THEN 'web'
                                           ELSE CAST(500 + o.o_custkey % 12 AS VARCHAR) END) AS VARCHAR) AS raw
  FROM order_site o"""

TABLES["sales"] = """
  SELECT * EXCLUDE (o_orderkey), raw->>'ownerId' AS p_owner_id FROM receipts"""

TABLES["lines_base"] = f"""
  SELECT s.business_location_id,
         s.account_reference,
         CAST(l.l_linenumber AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS line_id,
         CAST(l.l_partkey AS VARCHAR) AS sku,
         {item_name('l.l_partkey', 'p.p_name', 'p.p_type')} AS name,
         CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber IN (4, 7) THEN -1 ELSE 1 END * l.l_quantity AS DECIMAL(14,3)) AS quantity,
         CAST(CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber IN (4, 7) THEN -1 ELSE 1 END
                   * CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(14,4))
              * (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DECIMAL(14,4)) AS net_with_tax,
         CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber IN (4, 7) THEN -1 ELSE 1 END
              * CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(14,4)) AS net_without_tax,
         CAST(CASE WHEN l.l_partkey % 19 = 0 THEN 0 ELSE CAST(p.p_retailprice AS DECIMAL(14,2)) END AS DECIMAL(14,4)) AS menu_list_price,
         CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(0.35 AS DECIMAL(3,2)) AS DECIMAL(14,4)) AS unit_cost_price,
         CAST(NULL AS DECIMAL(14,4)) AS tax_amount,
         CASE WHEN l.l_discount > 0.08 THEN CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(14,4))
              WHEN l.l_discount < 0.02 THEN NULL
              ELSE CAST(0 AS DECIMAL(14,4)) END AS discount_amount,
         CAST(CASE WHEN p.p_type = 'PROMO' THEN 4 WHEN p.p_type IN ('LARGE', 'MEDIUM') THEN 1
                   WHEN p.p_type = 'ECONOMY' THEN 2 ELSE 3 END AS BIGINT) AS accounting_group_id,
         CASE WHEN p.p_type = 'PROMO' THEN 'Misc' WHEN p.p_type IN ('LARGE', 'MEDIUM') THEN 'Alcoholic Drinks'
              WHEN p.p_type = 'ECONOMY' THEN 'Non-Alcoholic Drinks' ELSE 'Food' END AS accounting_group_name,
         CASE WHEN p.p_type IN ('LARGE', 'MEDIUM', 'ECONOMY') THEN 'Bar' ELSE 'Kitchen' END AS revenue_center,
         CASE WHEN l.l_partkey % 17 <> 0 THEN s.time_closed - to_minutes(CAST(l.l_linenumber * 10 AS INTEGER)) END AS time_of_sale,
         CAST(json_object(
             'staffName', CASE WHEN l.l_suppkey % 10 = 0 THEN '' ELSE {STAFF}[(l.l_suppkey + l.l_linenumber) % 12 + 1] END,
             'staffId', CASE WHEN l.l_suppkey % 10 = 0 THEN '' ELSE CAST(500 + (l.l_suppkey + l.l_linenumber) % 12 AS VARCHAR) END,
             'voidReason', CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber IN (4, 7)
                                THEN CASE WHEN l.l_orderkey % 2 = 0 THEN 'Wrong item' ELSE 'Customer left' END
                                WHEN l.l_orderkey % 97 = 0 THEN '' END,
             'discountName', CASE WHEN l.l_discount > 0.08 AND l.l_suppkey % 2 = 0 THEN 'Staff 50%' END
         ) AS VARCHAR) AS raw
  FROM lineitem l
  JOIN receipts s ON s.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey"""

TABLES["sales_lines"] = """
  SELECT * REPLACE (CAST(net_with_tax - net_without_tax AS DECIMAL(14,4)) AS tax_amount),
         raw->>'staffName' AS p_staff_name, raw->>'staffId' AS p_staff_id,
         raw->>'voidReason' AS p_void_reason, raw->>'discountName' AS p_discount_name
  FROM lines_base"""

TABLES["payments"] = f"""
  SELECT o.business_location_id,
         CAST(o.o_orderkey AS VARCHAR) AS account_reference,
         CASE WHEN g.n = 1 THEN CAST(o.o_orderkey AS VARCHAR) ELSE CAST(o.o_orderkey AS VARCHAR) || '-b' END AS payment_uuid,
         {CODES}[(o.o_custkey + g.n) % 7 + 1] AS code,
         {DESCS}[(o.o_custkey + g.n) % 7 + 1] AS description,
         CAST((o.o_custkey + g.n) % 7 AS BIGINT) AS payment_method_id,
         CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN CAST(o.o_totalprice AS DECIMAL(14,2)) * CAST(0.5 AS DECIMAL(2,1))
                   ELSE CAST(o.o_totalprice AS DECIMAL(14,2)) END AS DECIMAL(14,4)) AS net_with_tax,
         CAST(CASE WHEN g.n = 1 THEN CAST(o.o_totalprice AS DECIMAL(14,2)) * CAST(o.o_custkey % 5 AS DECIMAL(2,0)) * CAST(0.01 AS DECIMAL(3,2))
                   ELSE 0 END AS DECIMAL(14,4)) AS tip,
         CASE WHEN o.o_custkey % 9 = 0 THEN CAST(1.5 AS DECIMAL(14,4)) END AS surcharge,
         'PAYMENT' AS type
  FROM order_site o
  JOIN (SELECT 1 AS n UNION ALL SELECT 2) g ON g.n = 1 OR o.o_orderkey % 4 = 0"""

TABLES["items"] = f"""
  SELECT s.business_location_id,
         p.p_partkey AS item_id,
         CAST(p.p_partkey AS VARCHAR) AS sku,
         {item_name('p.p_partkey', 'p.p_name', 'p.p_type')} AS name,
         p.p_name AS docket_name,
         CASE WHEN p.p_type = 'PROMO' THEN 'Misc' WHEN p.p_type IN ('LARGE', 'MEDIUM') THEN 'Alcoholic Drinks'
              WHEN p.p_type = 'ECONOMY' THEN 'Non-Alcoholic Drinks' ELSE 'Food' END AS accounting_group_name,
         CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(0.35 AS DECIMAL(3,2)) AS DECIMAL(14,4)) AS cost_price,
         'ITEM' AS item_type,
         p.p_partkey % 13 <> 0 AS active
  FROM (SELECT DISTINCT r.business_location_id, l.l_partkey
        FROM lineitem l JOIN receipts r ON r.o_orderkey = l.l_orderkey) s
  JOIN part p ON p.p_partkey = s.l_partkey"""

TABLES["staff_shifts"] = """
  SELECT CAST(1000 + user_id % 5 AS BIGINT) AS business_location_id,
         CAST(event_id AS VARCHAR) AS shift_uuid,
         CAST(500 + user_id % 12 AS BIGINT) AS staff_id,
         ts AS clock_in,
         CASE WHEN event_type <> 'error' THEN ts + to_microseconds(CAST(round(value * 60) AS BIGINT) * 1000000) END AS clock_out,
         date_trunc('day', ts) AS date_in_utc
  FROM events"""

TABLES["cashoff_agg"] = f"""
  SELECT o.business_location_id,
         {bdate(CLOSED)} AS business_date,
         SUM(CAST(o.o_totalprice AS DECIMAL(14,2))) AS total_sales,
         SUM(CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS card_sales,
         SUM(CASE WHEN o.o_orderpriority = '5-LOW' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS online_orders,
         SUM(CASE WHEN o.o_orderpriority = '1-URGENT' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS uber_eats,
         SUM(CASE WHEN o.o_orderpriority = '2-HIGH' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS just_eat,
         SUM(CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS deliveroo,
         COUNT(*) AS n
  FROM order_site o
  GROUP BY 1, 2"""

TABLES["cashoff_daily"] = """
  SELECT CASE WHEN day(a.business_date) % 2 = 0 THEN s.nickname ELSE s.business_name || '.' END AS site,
         a.business_date,
         CAST(a.total_sales AS DECIMAL(14,2)) AS total_sales,
         CAST(a.card_sales AS DECIMAL(14,2)) AS card_sales,
         CAST(a.online_orders AS DECIMAL(14,2)) AS online_orders,
         CAST(a.uber_eats AS DECIMAL(14,2)) AS uber_eats,
         CAST(a.just_eat AS DECIMAL(14,2)) AS just_eat,
         CAST(a.deliveroo AS DECIMAL(14,2)) AS deliveroo,
         CAST(NULL AS DECIMAL(14,2)) AS petty_cash,
         CAST(a.total_sales * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,2)) AS expected_cash,
         CAST(a.total_sales * CAST(0.1 AS DECIMAL(2,1)) + (a.n % 7 - 3) AS DECIMAL(14,2)) AS actual_cash,
         CAST(NULL AS DECIMAL(14,2)) AS cash_variance,
         CAST(a.n * 2 AS DECIMAL(14,2)) AS card_tips,
         CAST(a.n % 5 AS DECIMAL(14,2)) AS cash_tips,
         CASE WHEN a.business_location_id = 1002 THEN CAST(a.n AS DECIMAL(14,2)) END AS service_charge,
         CAST(a.n * 2 AS DECIMAL(14,2)) AS covers,
         CAST(a.n * CAST(12.5 AS DECIMAL(3,1)) AS DECIMAL(14,2)) AS wage_cost
  FROM cashoff_agg a JOIN sites s ON s.business_location_id = a.business_location_id"""

TABLES["ft_raw"] = """
  SELECT CAST(2000 + r_regionkey AS INTEGER) AS ft_site_code, r_name AS site_name,
         CAST(NULL AS BIGINT) AS business_location_id, TRUE AS is_core FROM region
  UNION ALL SELECT 2099, 'AFRICA (Darts)', NULL, TRUE"""

TABLES["ft_site_map"] = """
  SELECT m.ft_site_code, m.site_name,
         COALESCE((SELECT MIN(s.business_location_id) FROM sites s
                   WHERE s.nickname ILIKE '%' || m.site_name || '%'), m.business_location_id) AS business_location_id,
         m.is_core
  FROM ft_raw m"""

TABLES["storekit_site_map"] = """
  SELECT m.venue_id, m.site_name,
         (SELECT MIN(s.business_location_id) FROM sites s WHERE s.nickname ILIKE '%' || m.site_name || '%')
           AS business_location_id,
         TRUE AS is_core
  FROM (SELECT CAST(7000 + r_regionkey AS BIGINT) AS venue_id, lower(r_name) AS site_name FROM region) m"""

TABLES["nory_site_map"] = """
  SELECT 'branch-' || CAST(r_regionkey AS VARCHAR) AS branch_id, r_name AS site_name,
         CAST(1000 + r_regionkey AS BIGINT) AS business_location_id, r_regionkey <> 4 AS is_core
  FROM region"""

TABLES["sentiment_site_map"] = """
  SELECT 'The ' || r_name || ' Kitchen' AS sentiment_label, CAST(1000 + r_regionkey AS BIGINT) AS business_location_id,
         r_name || '.' AS nickname
  FROM region"""

TABLES["bookings"] = f"""
  SELECT b.ft_site_code, CAST(b.k AS VARCHAR) AS booking_ref_no, 'BK' || CAST(b.k AS VARCHAR) AS booking_code,
         m.business_location_id, m.site_name, b.booking_date,
         CAST((b.k * 53) % 50400 + 36000 AS INTEGER) AS booking_time_secs,
         CASE WHEN b.k % 17 <> 0 THEN CAST(b.k % 90 + 60 AS INTEGER) END AS duration_mins,
         CAST(b.k % 8 + 1 AS INTEGER) AS guest_count,
         b.status_code,
         CASE b.status_code WHEN 1 THEN 'Booked' WHEN 2 THEN 'Confirmed' WHEN 3 THEN 'Cancelled' WHEN 4 THEN 'Show'
                            WHEN 5 THEN 'NoShow' WHEN 6 THEN 'Complete' END AS status,
         b.chan AS sale_channel_code,
         CASE b.chan WHEN 1 THEN 'Web' WHEN 2 THEN 'Phone' WHEN 5 THEN 'Walk-in' WHEN 103 THEN 'Third-party' END AS sale_channel,
         b.iface AS interface_type_code,
         CASE b.iface WHEN 1 THEN 'Google' WHEN 2 THEN 'Zomato' WHEN 3 THEN 'FTWaiting' WHEN 4 THEN 'Swiggy'
                      WHEN 5 THEN 'EasyDinner' WHEN 7 THEN 'RezControl' WHEN 8 THEN 'SquareMeal' END AS interface_type,
         'T' || CAST(b.k % 30 AS VARCHAR) AS table_no,
         b.o_custkey % 3 = 0 AS is_reward_member,
         CASE WHEN b.o_custkey % 7 <> 0 THEN CAST(b.o_custkey % 5 AS INTEGER) END AS visits,
         CAST(CAST(b.o_totalprice AS DECIMAL(14,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,6)) AS total_amount,
         CAST(CASE WHEN b.k % 8 + 1 > 6 THEN 10 ELSE 0 END AS DECIMAL(18,6)) AS deposit,
         CASE WHEN b.k % 31 <> 0 THEN b.created END AS created_on,
         CAST(json_object('CreatedOn', CASE WHEN b.k % 2 = 0 THEN strftime(b.created, '%Y-%m-%dT%H:%M:%SZ') END) AS VARCHAR) AS raw
  FROM (
      SELECT o.o_orderkey AS k, o.o_custkey, o.o_totalprice,
             CASE WHEN o.o_orderkey % 40 = 0 THEN 2099 ELSE CAST(o.business_location_id - 1000 + 2000 AS INTEGER) END AS ft_site_code,
             CAST(o.o_orderdate AS DATE) AS booking_date,
             CASE WHEN o.o_orderkey % 53 <> 0 THEN CAST(o.o_orderkey % 6 + 1 AS INTEGER) END AS status_code,
             CAST([1, 2, 5, 103][o.o_orderkey % 4 + 1] AS INTEGER) AS chan,
             CASE WHEN [1, 2, 5, 103][o.o_orderkey % 4 + 1] = 103 THEN CAST((o.o_orderkey // 4) % 8 + 1 AS INTEGER) END AS iface,
             CAST(CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 4 AS INTEGER) AS TIMESTAMP) + INTERVAL 9 HOUR AS created
      FROM order_site o) b
  LEFT JOIN ft_site_map m ON m.ft_site_code = b.ft_site_code"""

TABLES["labour_base"] = f"""
  SELECT o.business_location_id, {bdate(CLOSED)} AS biz_date, COUNT(*) AS n,
         SUM(CAST(o.o_totalprice AS DECIMAL(14,2))) AS s
  FROM order_site o GROUP BY 1, 2"""

TABLES["nory_labour_daily"] = """
  SELECT x.branch_id, x.biz_date,
         CAST(x.hours * CAST(11.5 AS DECIMAL(3,1)) AS DECIMAL(18,6)) AS col,
         CAST(x.planned_hours * CAST(11.5 AS DECIMAL(3,1)) AS DECIMAL(18,6)) AS planned_col,
         x.hours, x.planned_hours, x.sales, x.orders, x.percentage, x.planned_percentage, x.splh, x.oplh,
         m.site_name
  FROM (
      SELECT 'branch-' || CAST(b.business_location_id - 1000 AS VARCHAR) AS branch_id, b.biz_date,
             CAST(b.n * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,6)) AS hours,
             CAST(CAST(b.n * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,6))
                  * (CAST(0.90 AS DECIMAL(3,2)) + CAST(day(b.biz_date) % 5 AS DECIMAL(2,0)) * CAST(0.05 AS DECIMAL(3,2)))
                  AS DECIMAL(18,6)) AS planned_hours,
             CAST(CASE WHEN b.business_location_id = 1003 THEN 0 ELSE b.s END AS DECIMAL(18,6)) AS sales,
             CAST(b.n AS INTEGER) AS orders,
             CAST((b.n * 7) % 45 + 10 AS DECIMAL(18,6)) AS percentage,
             CAST(28 AS DECIMAL(18,6)) AS planned_percentage,
             CAST(b.n % 50 + 20 AS DECIMAL(18,6)) AS splh,
             CAST(2 AS DECIMAL(18,6)) AS oplh
      FROM labour_base b) x
  JOIN nory_site_map m ON m.branch_id = x.branch_id"""

TABLES["nory_labour_breakdown"] = """
  SELECT d.branch_id, d.biz_date, c.category,
         CAST(d.col * c.share AS DECIMAL(18,6)) AS value,
         CAST(d.planned_col * c.share AS DECIMAL(18,6)) AS planned_value
  FROM nory_labour_daily d
  CROSS JOIN (SELECT * FROM (VALUES ('FOH', CAST(0.5 AS DECIMAL(2,1))), ('BOH', CAST(0.3 AS DECIMAL(2,1))),
                                    ('Management', CAST(0.2 AS DECIMAL(2,1)))) t(category, share)) c
  WHERE c.category <> 'Management' OR d.orders % 3 <> 0"""

TABLES["market_lines_raw"] = """
  SELECT 'Market' AS site, CAST(l.l_orderkey AS VARCHAR) AS order_number,
         CASE WHEN l.l_partkey % 50 <> 0 THEN CAST(l.l_partkey % 50 AS INTEGER) END AS plu,
         CAST(l.l_linenumber AS BIGINT) * 1000000000000000 + l.l_partkey * 10000000 + l.l_suppkey AS seq,
         r.time_closed AS order_time,
         CASE WHEN l.l_partkey % 50 = 2 THEN 'Tip' ELSE p.p_name END AS name,
         CASE WHEN l.l_linenumber <> 6 THEN CAST(l.l_quantity AS DECIMAL(14,3)) END AS quantity,
         CAST(p.p_retailprice AS DECIMAL(14,2)) AS price,
         CAST(l.l_extendedprice AS DECIMAL(14,2)) AS total,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS discount_amount,
         CAST(0 AS DECIMAL(14,2)) AS tip,
         CAST(NULL AS DECIMAL(14,2)) AS charge,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,2)) AS commission,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2))
              - CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS payout,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 'card' ELSE 'cash' END AS payment_method,
         ['Market', 'Stall ' || CAST(l.l_suppkey % 3 AS VARCHAR)] AS reporting_labels
  FROM lineitem l
  JOIN receipts r ON r.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey"""

TABLES["peazi_order_lines"] = """
  SELECT site, order_number, CAST(COALESCE(plu, 0) AS INTEGER) AS plu,
         arg_min_null(order_time, seq) AS order_time, arg_min_null(name, seq) AS name,
         CAST(SUM(COALESCE(quantity, 0)) AS DECIMAL(14,3)) AS quantity,
         arg_min_null(price, seq) AS price,
         CAST(SUM(COALESCE(total, 0)) AS DECIMAL(14,2)) AS total,
         CAST(SUM(COALESCE(discount_amount, 0)) AS DECIMAL(14,2)) AS discount_amount,
         CAST(SUM(COALESCE(tip, 0)) AS DECIMAL(14,2)) AS tip,
         CAST(SUM(COALESCE(charge, 0)) AS DECIMAL(14,2)) AS charge,
         CAST(SUM(COALESCE(commission, 0)) AS DECIMAL(14,2)) AS commission,
         CAST(SUM(COALESCE(payout, 0)) AS DECIMAL(14,2)) AS payout,
         arg_min_null(payment_method, seq) AS payment_method,
         array_to_string(arg_min_null(reporting_labels, seq), ',') AS reporting_labels
  FROM market_lines_raw GROUP BY 1, 2, 3"""

TABLES["reviews_base"] = f"""
  SELECT CASE WHEN d.doc_id % 37 = 0 THEN 'The Outpost Kitchen' ELSE 'The ' || r.r_name || ' Kitchen' END AS label,
         d.source,
         DATE '2024-01-01' + CAST(d.doc_id % 90 AS INTEGER) AS rdate,
         CASE WHEN d.doc_id % 6 <> 0 THEN 'user' || CAST(d.doc_id % 50 AS VARCHAR) END AS reviewer,
         CASE WHEN d.doc_id % 3 = 0 THEN d.text || ' Thanks ' || {STAFF}[(d.doc_id // 3) % 12 + 1] || '!'
              ELSE d.text END AS text,
         CAST((d.doc_id // 5) % 5 + 1 AS DECIMAL(3,1)) AS rating
  FROM documents d JOIN region r ON r.r_regionkey = d.doc_id % 5"""

TABLES["sentiment_reviews"] = """
  SELECT sha256(concat_ws('|', COALESCE(label, ''), COALESCE(source, ''), COALESCE(CAST(rdate AS VARCHAR), ''),
                          COALESCE(reviewer, ''), COALESCE(text, ''))) AS review_hash,
         label AS sentiment_label, source, rdate AS review_date, rating, text AS review_text, reviewer,
         'reviews_' || source || '.csv' AS source_file
  FROM reviews_base"""

TABLES["sentiment_overview"] = f"""
  SELECT sentiment_label, period_start, grain, reviews,
         CAST(CAST((200 * s + reviews) // (2 * reviews) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS rating,
         CAST(NULL AS DECIMAL(3,2)) AS competitor_rating,
         star5, star4, star3, star2, star1,
         CAST(star5 - star1 - star2 AS DECIMAL(6,2)) AS nps,
         star1 + star2 AS critical,
         {', '.join(f"CAST(CAST(20 * {a}_stars // {a}_mentions AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS {a}_sentiment, {a}_mentions" for a in R.ASPECTS)}
  FROM (
      SELECT sentiment_label, p AS period_start, grain, CAST(COUNT(*) AS INTEGER) AS reviews,
             CAST(SUM(rating) AS BIGINT) AS s,
             CAST(SUM(CASE WHEN rating = 5 THEN 1 ELSE 0 END) AS INTEGER) AS star5,
             CAST(SUM(CASE WHEN rating = 4 THEN 1 ELSE 0 END) AS INTEGER) AS star4,
             CAST(SUM(CASE WHEN rating = 3 THEN 1 ELSE 0 END) AS INTEGER) AS star3,
             CAST(SUM(CASE WHEN rating = 2 THEN 1 ELSE 0 END) AS INTEGER) AS star2,
             CAST(SUM(CASE WHEN rating = 1 THEN 1 ELSE 0 END) AS INTEGER) AS star1,
             {', '.join(f"CAST(count(*) FILTER (length(review_text) % {i + 2} = 0) AS INTEGER) AS {a}_mentions, "
                        f"CAST(SUM(rating) FILTER (length(review_text) % {i + 2} = 0) AS BIGINT) AS {a}_stars"
                        for i, a in enumerate(R.ASPECTS))}
      FROM (SELECT *, CAST(date_trunc('month', review_date) AS DATE) AS p, 'month' AS grain FROM sentiment_reviews
            UNION ALL
            SELECT *, review_date AS p, 'day' AS grain FROM sentiment_reviews) u
      GROUP BY sentiment_label, p, grain) g"""

TABLES["manager_daily_report"] = f"""
  SELECT s.business_name AS site, b.biz_date AS business_date,
         {STAFF}[b.n % 12 + 1] AS manager_name,
         'Served ' || CAST(b.n AS VARCHAR) || ' tables' AS positive_highlights,
         CASE WHEN b.n % 4 = 0 THEN 'Ran out of naan' END AS stockout_detail,
         CASE WHEN b.n % 5 = 0 THEN 'Glasswasher down' END AS equipment_detail,
         CAST(NULL AS VARCHAR) AS customer_comments,
         CASE WHEN b.n % 9 = 0 THEN 'Minor burn, first aid given' END AS incidents,
         CAST(NULL AS VARCHAR) AS further_comments
  FROM labour_base b JOIN sites s ON s.business_location_id = b.business_location_id"""

TABLES["keg_ref"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, 'Keg ' || CAST(p_partkey % 3 AS VARCHAR) AS keg_name, 30 AS keg_litres,
         CASE WHEN p_size % 2 = 0 THEN 568 ELSE 284 END AS serve_ml
  FROM part WHERE p_type = 'LARGE' AND p_partkey % 7 = 0"""

TABLES["packaged_ref"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, 'Bottle ' || p_name AS product
  FROM part WHERE p_type = 'MEDIUM' AND p_partkey % 7 = 0"""

TABLES["cocktail_bom"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, 'Spirit ' || CAST(p_partkey % 4 AS VARCHAR) AS spirit,
         CAST(25 AS DECIMAL(6,2)) AS ml
  FROM part WHERE p_type = 'LARGE' AND p_partkey % 5 = 1
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), 'Spirit ' || CAST((p_partkey + 1) % 4 AS VARCHAR), CAST(12.5 AS DECIMAL(6,2))
  FROM part WHERE p_type = 'LARGE' AND p_partkey % 5 = 1"""

TABLES["cocktail_ref"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name || ' cocktail' AS cocktail_name, p_size % 3 = 0 AS is_spritz
  FROM part WHERE p_type = 'LARGE' AND p_partkey % 5 = 1"""

TABLES["wine_ref"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, 'Wine ' || CAST(p_partkey % 3 AS VARCHAR) AS wine_name,
         [125, 175, 250, 750][p_partkey % 4 + 1] AS ml
  FROM part WHERE p_type = 'MEDIUM' AND p_partkey % 5 = 2"""

# ---------------------------------------------------------------- shared views
# Every report oracle starts from these two relations: receipts that count, and
# their lines with everything that is read out of the payload.
TABLES["live_sales"] = f"""
  SELECT sales.*, sites.nickname AS site_label, {bdate('sales.time_closed')} AS trading_day
  FROM sales LEFT JOIN sites USING (business_location_id)
  WHERE sales.cancelled IS DISTINCT FROM TRUE"""

TABLES["rung"] = f"""
  SELECT sales_lines.*, live_sales.time_closed, live_sales.trading_day, live_sales.site_label,
         live_sales.owner_name AS opener,
         {shift('COALESCE(sales_lines.time_of_sale, live_sales.time_closed)')} AS daypart,
         NULLIF(sales_lines.raw->>'staffName', '') AS ringer,
         NULLIF(sales_lines.raw->>'voidReason', '') AS void_why,
         NULLIF(sales_lines.raw->>'discountName', '') AS discount_why
  FROM sales_lines JOIN live_sales USING (business_location_id, account_reference)"""

TABLES["v_fact_lines"] = """
  SELECT * EXCLUDE (liquid), COALESCE(liquid, 'other') AS wet_dry
  FROM (SELECT business_location_id, account_reference, line_id, site_label AS site, trading_day AS business_date,
               daypart AS shift, time_closed, time_of_sale, accounting_group_name, sku, name, quantity,
               net_without_tax AS net_ex_vat, net_with_tax AS net_inc_vat, unit_cost_price, menu_list_price,
               discount_amount, raw
        FROM rung)
  LEFT JOIN (SELECT match_value AS accounting_group_name, min(category) AS liquid FROM category_rules
             WHERE active AND dimension = 'wet_dry' AND match_type = 'accounting_group' GROUP BY ALL)
  USING (accounting_group_name)"""

TABLES["item_rules"] = """
  SELECT match_type, match_value, category FROM category_rules WHERE active AND dimension = 'item_category'"""

TABLES["v_line_item_category"] = """
  SELECT business_location_id, account_reference, line_id, category
  FROM sales_lines JOIN item_rules ON match_value = accounting_group_name
  WHERE match_type = 'accounting_group'
  UNION
  SELECT business_location_id, account_reference, line_id, category
  FROM sales_lines JOIN item_rules ON match_value = sku WHERE match_type = 'sku'
  UNION
  SELECT business_location_id, account_reference, line_id, category
  FROM sales_lines JOIN (SELECT n.name, category FROM (SELECT DISTINCT name FROM sales_lines) AS n
                         JOIN item_rules ON match_type = 'name_like' AND n.name ILIKE match_value) USING (name)"""

TABLES["v_report_lines"] = """
  SELECT v_fact_lines.*, tags[1] AS item_category, raw->>'staffName' AS line_staff,
         TRY_CAST(raw->>'staffId' AS BIGINT) AS line_staff_id, raw->>'voidReason' AS void_reason,
         raw->>'discountName' AS discount_name
  FROM v_fact_lines
  LEFT JOIN (SELECT business_location_id, account_reference, line_id, list_sort(list(category)) AS tags
             FROM v_line_item_category GROUP BY ALL) USING (business_location_id, account_reference, line_id)"""

TABLES["tenders"] = """
  SELECT * FROM (VALUES ('LSPAY_ADYEN_TERMINAL_API_LOCAL', 'Card'), ('LSPAY_ADYEN_TAP_TO_PAY', 'Card'), ('CASH', 'Cash'),
                        ('IKGIFT', 'Gift card'), ('OA', 'Online'), ('IKDEBT', 'Invoice')) AS t(code, tender_group)"""

TABLES["v_fact_payments"] = f"""
  SELECT business_location_id, account_reference, payment_uuid, live_sales.site_label AS site, live_sales.time_closed,
         live_sales.trading_day AS business_date, {shift('live_sales.time_closed')} AS shift,
         payments.net_with_tax, payments.tip, payments.surcharge, code, payments.description AS payment_method,
         COALESCE(tenders.tender_group, 'Other') AS tender_group
  FROM payments JOIN live_sales USING (business_location_id, account_reference) LEFT JOIN tenders USING (code)"""

TABLES["v_void_lines"] = """
  SELECT business_location_id, account_reference, line_id, site_label AS site, trading_day AS business_date,
         daypart AS shift, sku, name, void_why AS void_reason, COALESCE(ringer, '(unknown)') AS staff_name,
         0 - net_without_tax AS voided_value, 0 - quantity AS voided_qty
  FROM rung WHERE void_why IS NOT NULL"""


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _refs(text: str) -> set[str]:
    return {w for w in _WORD.findall(text) if w in TABLES}


def with_prelude(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) needs, dependencies first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str):
        if name in seen:
            return
        seen.add(name)
        for dep in sorted(_refs(TABLES[name]) - {name}):
            visit(dep)
        order.append(name)

    # CTEs declared inside the body shadow prelude names
    local = set(re.findall(r"(?:WITH|,)\s*([A-Za-z_][A-Za-z0-9_]*)\s+AS\s*\(", body, flags=re.I))
    for n in sorted(_refs(body) - local):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n]}\n)" for n in order)
    b = body.strip()
    if re.match(r"^WITH\s", b, flags=re.I):
        return f"WITH {ctes},\n{b[4:].lstrip()}"
    return f"WITH {ctes}\n{b}"
