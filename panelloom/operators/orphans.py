"""References to records that don't exist: missing, deleted or loaded only later."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import UNICODE_SPACE, strip
from panelloom.plans.skew import HOT_SHARE


@dataclass(frozen=True)
class Reference:
    """A column whose values are keys of another table.

    key and parent_key are the keys as compared, null where blank; time is the instant of a reference (null: never
    late), parent_loaded and parent_removed when a parent row was loaded and removed.
    """

    table_name: str
    column_name: str
    rows: DataFrame
    row_id: str
    key: Column
    time: Column
    parents: DataFrame
    parent_key: Column
    parent_loaded: Column
    parent_removed: Column


def plain_key(c: str, *, fold: bool) -> Column:
    """A key without outer white space, in lower case if fold; null if blank."""
    s = F.nullif(strip(F.col(c), UNICODE_SPACE), F.lit(""))
    return F.lower(s) if fold else s


def orphan_rows(refs: list[Reference]) -> DataFrame:
    """(table_name, column_name, row_id, kind, period_month) of each row whose reference has no valid target.

    kind: missing (no parent row has the key), else deleted (all that have it are removed), else late (no unremoved
    one was loaded at or before the reference). All references go through one plan: distinct keys, counted map-side,
    against the parents' distinct keys; what is left without a match, or with a match that came after the key's first
    reference, is joined back to the rows. Both sides of the first join are unique; at the second, keys that hold 1/64
    of all references (at most 64) are broadcast, so that their rows stay where they are.
    Blank keys are no references, repeated rows give one result each, empty tables give no rows; period_month is null
    where the reference has no time, and such a reference is never late.
    """
    names = [F.struct(F.lit(r.table_name).alias("table_name"), F.lit(r.column_name).alias("column_name")) for r in refs]
    rows = reduce(
        DataFrame.unionByName,
        [r.rows.select(F.lit(i).alias("_ref"), F.col(r.row_id).cast("bigint").alias("row_id"), r.key.alias("_key"), r.time.alias("_time")).where("_key is not null") for i, r in enumerate(refs)],
    )
    held = reduce(
        DataFrame.unionByName,
        [r.parents.select(F.lit(i).alias("_ref"), r.parent_key.alias("_key"), r.parent_loaded.alias("_loaded"), r.parent_removed.alias("_removed")).where("_key is not null") for i, r in enumerate(refs)],
    )
    unremoved = F.when(F.col("_removed").isNull(), F.col("_loaded"))
    parents = held.groupBy("_ref", "_key").agg(F.count_if(F.col("_removed").isNull()).alias("_live"), F.min(unremoved).alias("_first"))
    wanted = rows.groupBy("_ref", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_time").alias("_from"))
    kind = F.when(F.col("_live").isNull(), "missing").when(F.col("_live") == 0, "deleted").when(F.col("_first") > F.col("_from"), "late")
    dangling = wanted.join(parents, ["_ref", "_key"], "left").select("_ref", "_key", "_n", "_first", kind.alias("kind")).where("kind is not null")
    total = F.broadcast(rows.agg(F.count(F.lit(1)).alias("_total")))  # one row
    shares = dangling.join(total).withColumn("_hot", F.col("_n") * HOT_SHARE >= F.col("_total")).drop("_n", "_total")
    hot = F.broadcast(shares.where("_hot").drop("_hot"))  # at most HOT_SHARE rows
    cold = rows.join(hot.select("_ref", "_key"), ["_ref", "_key"], "left_anti").join(shares.where("not _hot").drop("_hot"), ["_ref", "_key"])
    marked = cold.unionByName(rows.join(hot, ["_ref", "_key"])).where("kind <> 'late' or _first > _time")
    name = F.element_at(F.array(*names), F.col("_ref") + 1)
    return marked.select(name["table_name"].alias("table_name"), name["column_name"].alias("column_name"), "row_id", "kind", F.date_format("_time", "yyyy-MM").alias("period_month"))


def orphan_counts(refs: list[Reference]) -> DataFrame:
    """Orphans per table, column, kind and month."""
    return orphan_rows(refs).groupBy("table_name", "column_name", "kind", "period_month").agg(F.count(F.lit(1)).alias("orphans"))


def panel_references(crosswalk: DataFrame, master: DataFrame, clusters: DataFrame) -> list[Reference]:
    """The three references of the linked panel."""
    ids = ["psidbrokerid", "responseid", "y0_responseid", "y1_responseid", "y2_responseid"]
    respondent = F.coalesce(*[plain_key(c, fold=False) for c in ids])
    loaded, removed = F.col("loaded_at"), F.col("removed_at")
    return [
        Reference("crosswalk", "original_id", crosswalk, "row_id", plain_key("original_id", fold=True), loaded, master, plain_key("psidbrokerid", fold=True), loaded, removed),
        Reference("linked_master", "y2_hidbrokerpanelid", master, "row_id", plain_key("y2_hidbrokerpanelid", fold=True), F.col("y2_linked_at"), crosswalk, plain_key("hidbrokerpanelid", fold=True), loaded, removed),
        Reference("clusters", "respondent_id", clusters, "row_id", plain_key("respondent_id", fold=False), loaded, master, respondent, loaded, removed),
    ]
