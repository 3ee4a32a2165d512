"""Literal reference tables (rule seeds and site maps) as small DataFrames.

These are configuration rows, not data: they enter every operator as an input
DataFrame so the operators only hold formulas. Their size is fixed by the
business (tens of rows), which is what makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Aspects that reviews are scored on, in the order of the overview's columns.
ASPECTS = ["food", "service", "ambience", "cleanliness", "drinks", "cost"]

# Category rules used with the test tables.
# (id, dimension, category, match_type, match_value, priority, active)
CATEGORY_RULES = [
    (1, "wet_dry", "wet", "accounting_group", "Alcoholic Drinks", 10, True),
    (2, "wet_dry", "wet", "accounting_group", "Non-Alcoholic Drinks", 10, True),
    (3, "wet_dry", "dry", "accounting_group", "Food", 10, True),
    (4, "item_category", "poppadoms", "name_like", "%ring%", 50, True),
    (5, "item_category", "desserts", "name_like", "%plate%", 50, True),
    (6, "item_category", "cocktails", "name_like", "%rod%", 50, True),
    (7, "item_category", "241 cocktails", "name_like", "%red rod%", 40, True),
    (8, "item_category", "loaded chips", "name_like", ".cold%", 30, True),
    (9, "item_category", "croquettes", "name_like", "%gizmo%", 30, True),
    (10, "item_category", "monthly specials", "sku", "7", 30, True),
    (11, "item_category", "monthly specials", "sku", "11", 30, True),
    (12, "item_category", "soft drinks", "accounting_group", "Non-Alcoholic Drinks", 60, True),
    (13, "item_category", "desserts", "name_like", "%gear%", 50, False),
    (14, "item_category", "lunch menu", "name_like", "%BLUE BOLT%", 30, True),
]
CATEGORY_RULES_SCHEMA = ("id long, dimension string, category string, match_type string, "
                         "match_value string, priority int, active boolean")

# Accounting groups and the payment tender codes of the test data.
ACCOUNTING_GROUPS = ["Alcoholic Drinks", "Food", "Misc", "Non-Alcoholic Drinks"]
PAYMENT_CODES = ["LSPAY_ADYEN_TERMINAL_API_LOCAL", "LSPAY_ADYEN_TAP_TO_PAY", "CASH", "IKGIFT",
                 "OA", "IKDEBT", "IKCLIFT"]
PAYMENT_DESCRIPTIONS = ["Card terminal", "Tap to pay", "Cash", "Gift card", "Order Anywhere",
                        "Account", "Click and collect"]

# Staff first names used for receipt owners and line servers
# (index i has staff id 500 + i; 'Manager' is a shared login).
STAFF_NAMES = ["Amara", "Ben", "Chloe", "Dev", "Ella", "Farid", "Grace", "Hugo", "Isla",
               "Jai", "Kofi", "Manager"]

# Receipt owners that are not people.
NON_PERSON_OWNERS = ["Order Anywhere", "Head Office"]


def category_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_RULES, CATEGORY_RULES_SCHEMA)


def accounting_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, g, None) for g in ACCOUNTING_GROUPS],
                                 "accounting_group_id long, name string, business_location_id long")
