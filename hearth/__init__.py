"""hearth: hospitality analytics on PySpark.

Warehouse tables (receipts, lines, payments, shifts, bookings, labour, online
orders, reviews, manager forms) are plain DataFrames; every report is a pure
function ``DataFrame... -> DataFrame`` built from Spark built-ins so Catalyst
plans it end to end.
"""

from hearth.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
