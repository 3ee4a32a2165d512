"""Keyed merges and table maintenance.

Stock Spark has no MERGE for plain parquet, so a merge is expressed as
"union the current and incoming rows, pick one winner per key": a single
hash aggregation keyed on the table key (``max_by`` over a (source, ordinal)
struct), which shuffles once and combines map-side. Writing the result to a
new version folder (``write_version``) keeps every merge idempotent: applying
the same batch twice yields the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.plans.joins import broadcast_if_small


def _winner(df: DataFrame, keys: list[str], order: Column, last: bool = True) -> DataFrame:
    cols = [c for c in df.columns if c not in keys and not c.startswith("_m_")]
    pick = F.max_by if last else F.min_by
    best = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in cols]), order).alias("_w"))
    return best.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in cols])


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], ordinal: str | None = None,
           keep_current: tuple[str, ...] = ()) -> DataFrame:
    """Full-row upsert, incoming wins; inside the incoming batch the row with
    the highest ``ordinal`` (arrival order, any orderable type) wins. Columns in ``keep_current`` are
    never overwritten for a key that already exists (e.g. order status)."""
    inc = incoming.withColumn("_m_src", F.lit(1)).withColumn(
        "_m_ord", F.col(ordinal) if ordinal else F.lit(0).cast("long"))
    if ordinal and ordinal not in current.columns:
        inc = inc.drop(ordinal)
    cur = current.withColumn("_m_src", F.lit(0)).withColumn("_m_ord", F.lit(None).cast(inc.schema["_m_ord"].dataType))
    u = cur.unionByName(inc, allowMissingColumns=True)
    if not keep_current:
        return _winner(u, keys, F.struct("_m_src", "_m_ord"))
    kept = (current.select(*keys, *[F.col(c).alias(f"_m_keep_{c}") for c in keep_current])
                   .withColumn("_m_had", F.lit(True)))
    w = _winner(u, keys, F.struct("_m_src", "_m_ord")).join(kept, keys, "left")
    for c in keep_current:
        w = w.withColumn(c, F.when(F.col("_m_had"), F.col(f"_m_keep_{c}")).otherwise(F.col(c)))
    return w.drop("_m_had", *[f"_m_keep_{c}" for c in keep_current])


def insert_new(current: DataFrame, incoming: DataFrame, keys: list[str], ordinal: str | None = None) -> DataFrame:
    """Insert-if-absent; existing rows win, first arrival wins inside the batch."""
    fresh = incoming.join(current.select(*keys), keys, "left_anti")
    if ordinal:
        fresh = _winner(fresh.withColumn("_m_o", F.col(ordinal)), keys, F.col("_m_o"), last=False)
        if ordinal not in current.columns:
            fresh = fresh.drop(ordinal)
    else:
        fresh = fresh.dropDuplicates(keys)
    return current.unionByName(fresh, allowMissingColumns=True)


def merge_sites(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """business_name new-else-old; nickname old-else-new."""
    c = current.alias("c")
    n = incoming.alias("n")
    j = c.join(n, "business_location_id", "full_outer")
    return j.select(
        "business_location_id",
        F.coalesce(F.col("n.business_name"), F.col("c.business_name")).alias("business_name"),
        F.coalesce(F.col("c.nickname"), F.col("n.nickname")).alias("nickname"),
        F.coalesce(F.col("c.active"), F.col("n.active"), F.lit(True)).alias("active"),
    )


def advance_watermark(state: DataFrame, batch_max: DataFrame, keys=("business_location_id", "resource")) -> DataFrame:
    """New watermark = GREATEST(old, new), NULLs ignored; new keys are added."""
    k = list(keys)
    j = state.alias("s").join(batch_max.alias("b"), k, "full_outer")
    return j.select(*k, F.greatest(F.col("s.last_watermark"), F.col("b.last_watermark")).alias("last_watermark"))


def net_sales_pence(total="total_pence", tip="tip_pence", fee="delivery_fee_pence") -> Column:
    """Generated column total - tip - delivery, NULL as 0."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return z(total) - z(tip) - z(fee)


def fill_location_ids(site_map: DataFrame, sites: DataFrame, only_null: bool = True,
                      name_col: str = "site_name") -> DataFrame:
    """Resolve ``business_location_id`` by containment
    (``nickname ILIKE '%' || site_name || '%'``); several matches -> smallest id.

    ``only_null`` fills missing ids only (run-time flavour); otherwise a match
    replaces the stored id (migration flavour). Both sides are site dimensions;
    the nested-loop join is over a size-checked broadcast of the site table.
    """
    st = broadcast_if_small(sites.select(F.col("business_location_id").alias("_bl"), F.col("nickname").alias("_nn")), basis=sites)
    # one match per distinct name: a key that is the same however often it is computed
    hits = (site_map.select(F.col(name_col).alias("_name")).distinct()
                    .join(st, F.expr("_nn ILIKE concat('%', _name, '%')"))
                    .groupBy("_name").agg(F.min("_bl").alias("_found")))
    j = site_map.join(hits, F.col(name_col) == F.col("_name"), "left")
    if only_null:
        new = F.coalesce(F.col("business_location_id"), F.col("_found"))
    else:
        new = F.coalesce(F.col("_found"), F.col("business_location_id"))
    return j.withColumn("business_location_id", new.cast("long")).select(*site_map.columns)


def new_files(files: DataFrame, log: DataFrame, force: bool = False) -> DataFrame:
    """Files whose (name, sha256) is not in the load log (all when forced)."""
    if force:
        return files
    return files.join(log.select("filename", "sha256"), ["filename", "sha256"], "left_anti")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove rows matching ``predicate`` (NULL predicate keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns where ``predicate`` holds."""
    hit = F.coalesce(predicate, F.lit(False))
    for c, v in assignments.items():
        df = df.withColumn(c, F.when(hit, v).otherwise(F.col(c)))
    return df


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key check as data: one row per key with NULL parts or more than
    one row (``kind`` = 'null_key' / 'duplicate')."""
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    nulls = df.filter(null_any).groupBy(*keys).count().withColumn("kind", F.lit("null_key"))
    dups = (df.filter(~null_any).groupBy(*keys).count().filter(F.col("count") > 1)
              .withColumn("kind", F.lit("duplicate")))
    return nulls.unionByName(dups).select(*keys, F.col("count").alias("rows"), "kind")


def write_version(df: DataFrame, root: str, version: int, partition_by: tuple[str, ...] = (),
                  mode: str = "errorifexists") -> str:
    """K09 sink: write one immutable table version (``root/v=<n>``); a replace-all
    reload is simply the next version. Returns the path written."""
    path = f"{root.rstrip('/')}/v={version}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
