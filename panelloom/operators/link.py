"""Linking a follow-up wave into a wide master: ranked deduplication, crosswalk, update of known rows, append of new ones.

Rows keep their order by an ordinal column of each input; nothing is sorted before a sink asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions import fieldmeta
from panelloom.functions.fieldmeta import Dictionary
from panelloom.functions.scalars import fold_id, text, to_number
from panelloom.operators.rules import quoted
from panelloom.plans.skew import lookup
from panelloom.session import shared_checkpoints

# Names of the crosswalk's columns, of the columns that a follow-up needs and of the audit columns.
CROSSWALK = ("ID March 2026", "HIDBrokerPanelId", "ORIGINAL ID")
NEEDED = ("BrokerPanelId", "Finished", "Progress", "RecordedDate", "ResponseId")
RULE = "highest Finished, then Progress, then RecordedDate, then ResponseId"
STATUSES = {"linked_existing_master": "Linked to an existing master row", "crosswalk_original_missing_master": "Crosswalk ID not in the master", "no_crosswalk": "Not in the crosswalk"}


def ranking(df: DataFrame, ordinal: str | None = None) -> Column:
    """What ranks a person's responses, the best one highest; missing and unreadable values rank as -1.

    Full ties go to the later row, or, without an ordinal, are broken by a hash of the whole row.
    """
    number = lambda c: F.coalesce(to_number(c), F.lit(-1.0))
    last = F.col(quoted(ordinal)).cast("bigint") if ordinal else F.xxhash64(*map(F.col, map(quoted, df.columns)))
    return F.struct(*[number(c).alias(c) for c in ("Finished", "Progress", "RecordedDate")], text("ResponseId").alias("ResponseId"), last.alias("last"))


def require_followup(df: DataFrame) -> None:
    """The columns that linking needs are there and every response names its person."""
    missing = sorted(set(NEEDED) - set(df.columns))
    if missing:
        raise ValueError(f"The follow-up is missing columns: {', '.join(missing)}")
    if df.where(fold_id("BrokerPanelId") == "").limit(1).count():
        raise ValueError("The follow-up has blank BrokerPanelId values.")


def deduplicate(df: DataFrame, ordinal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the best response of each person with _current_id, the decisions).

    Of full ties the later row (by ordinal) wins. A decision per dropped response: broker_panel_id, kept_response_id,
    dropped_response_id, rule, and for their order _current_id and _ranking, the lowest first. Null ids are one blank
    person. The best response is found by an aggregation that starts before the shuffle, and is brought to the others by
    lookup: no task sorts or holds a person's rows, however many there are.
    """
    ranked = df.withColumns({"_current_id": fold_id("BrokerPanelId"), "_ranking": ranking(df, ordinal)})
    row = F.struct(*map(F.col, map(quoted, df.columns)))
    kept = ranked.groupBy("_current_id").agg(F.max_by(row, "_ranking").alias("_row")).select("_row.*", "_current_id").select(*map(quoted, df.columns), "_current_id")
    held = F.struct(F.col("ResponseId").alias("kept"), F.col("BrokerPanelId").alias("panel"), "_ranking")
    best = ranked.groupBy("_current_id").agg(F.max_by(held, "_ranking").alias("_best"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows")
    decided = lookup(ranked.select("_current_id", "_ranking", "ResponseId"), best, ["_current_id"], "inner")
    shown = [F.col("_best.panel").alias("broker_panel_id"), F.col("_best.kept").alias("kept_response_id"), F.col("ResponseId").alias("dropped_response_id"), F.lit(RULE).alias("rule"), "_current_id", "_ranking"]
    decisions = decided.where("_ranking < _best._ranking").select(*shown)
    if not ordinal:  # equal rows: all but one of them are dropped
        equal = decided.where("_ranking = _best._ranking").select(*shown)
        equal = equal.groupBy(*equal.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        decisions = decisions.unionByName(equal.withColumn("_i", F.explode(F.sequence(F.lit(2), F.col("_n").cast("int")))).drop("_n", "_i"))
    return kept, decisions


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and rows of each key that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_crosswalk(df: DataFrame) -> None:
    """The crosswalk has its three columns, each filled and unique (stripped, in their own case), by one counting of values.

    Current ids that are the same when folded are an error too: they would make one response match two rows.
    """
    if tuple(df.columns) != CROSSWALK:
        raise ValueError(f"Unexpected crosswalk columns: {df.columns}")
    cells = [text(c) for c in CROSSWALK] + [fold_id(CROSSWALK[0])]
    long = df.select(F.posexplode(F.array(*cells)).alias("i", "v")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    bad = {r["i"]: r["bad"] for r in long.groupBy("i").agg(F.max((F.col("v") == "") | (F.col("n") > 1)).alias("bad")).collect()}
    for i, c in enumerate(CROSSWALK):
        if bad.get(i):
            raise ValueError(f"A crosswalk column is blank or duplicated: {c}")
    if bad.get(len(CROSSWALK)):
        raise ValueError("The crosswalk has several rows with the same ID.")


def attach_crosswalk(followup: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """followup (with _current_id) and its crosswalk ids: _hid and _original_id, '' where there is none.

    Both sides' keys are unique: the follow-up's by its deduplication, the crosswalk's by check_crosswalk. No side is
    broadcast by hint: a crosswalk grows with the panel, and the optimizer broadcasts it while it is small.
    """
    x = crosswalk.select(fold_id(CROSSWALK[0]).alias("_current_id"), text(CROSSWALK[1]).alias("_hid"), fold_id(CROSSWALK[2]).alias("_original_id"), text(CROSSWALK[2]).alias("_original"))
    blank = F.lit("")
    return followup.join(x, "_current_id", "left").withColumns({c: F.coalesce(c, blank) for c in ("_hid", "_original_id", "_original")})


def with_status(linked: DataFrame, master_keys: DataFrame) -> DataFrame:
    """linked with _status: no_crosswalk, crosswalk_original_missing_master or linked_existing_master."""
    keys = master_keys.select(F.col("_original_id").alias("_at")).where("_at <> ''").distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_original_id") == "", "no_crosswalk").when(F.col("_known"), "linked_existing_master").otherwise("crosswalk_original_missing_master")
    return linked.join(keys, _spread(F.col("_original_id"), F.col("_current_id")) == F.col("_at"), "left").withColumn("_status", status).drop("_known", "_at")


def _spread(key: Column, *row: Column) -> Column:
    """A key to join by: a blank one matches nothing, but lies where its row's hash says, not all in one task."""
    return F.when(key != "", key).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*row).cast("string")))


def target_names(columns: list[str], master: list[str], prefix: str = "Y2_") -> dict[str, str]:
    """Follow-up column -> its name in the master."""
    names = {c: prefix + c for c in columns}
    if any(len(n) > 64 for n in names.values()):
        raise ValueError("A prefixed variable name is longer than 64 characters.")
    taken = sorted(set(names.values()) & set(master))
    if taken:
        raise ValueError(f"Target columns already exist: {taken[:10]}")
    return names


def link(master: DataFrame, followup: DataFrame, crosswalk: DataFrame, *, prefix: str = "Y2_", ordinal: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(linked master, duplicate decisions, the follow-up's statuses).

    Known people's rows get the follow-up's values in prefixed columns and four audit columns; people without a master row
    are appended, with PSIDBrokerID set to their original id where the crosswalk has one. Output columns _part (0 master,
    1 appended) and _order give the rows' order and are dropped by the sink. Blank ids never match. ordinal names a
    column of both inputs that counts their rows; without it, order is not defined. Errors: see the checks.
    The deduplicated follow-up with its statuses is checkpointed: it is checked, counted and read by both parts.
    """
    shared_checkpoints(master.sparkSession)
    require_followup(followup)
    if "PSIDBrokerID" not in master.columns:
        raise ValueError("The master is missing PSIDBrokerID.")
    check_crosswalk(crosswalk)
    kept, decisions = deduplicate(followup, ordinal)
    master_cols = [c for c in master.columns if c != ordinal]
    follow_cols = [c for c in followup.columns if c != ordinal]
    names = target_names(follow_cols, master_cols, prefix)
    keyed = master.withColumn("_original_id", fold_id("PSIDBrokerID"))
    state = with_status(attach_crosswalk(kept, crosswalk), keyed).checkpoint()
    # One job for both: an original id that several people link to, and one that several master rows have.
    count = lambda df, n: df.where("_original_id <> ''").groupBy("_original_id").agg(F.count(F.lit(1)).alias(n))
    twice = count(state, "f").join(count(keyed, "m"), "_original_id", "left").where("f > 1 or m > 1").orderBy("_original_id").limit(10).collect()
    if several := [r["_original_id"] for r in twice if (r["m"] or 0) > 1]:
        raise ValueError("The crosswalk maps to duplicated master IDs: " + ", ".join(several))
    if twice:
        raise ValueError("Follow-up IDs are missing or duplicated after the merge.")

    order = F.col(ordinal).cast("bigint") if ordinal else F.lit(0).cast("bigint")
    audit = {
        f"{prefix}HIDBrokerPanelId": F.nullif("_hid", F.lit("")),
        f"{prefix}crosswalk_original_id": F.nullif("_original", F.lit("")),
        f"{prefix}crosswalk_status": F.col("_status"),
    }
    incoming = state.select("_original_id", "_status", "_original", "_current_id", *[F.col(quoted(c)).alias(n) for c, n in names.items()], *[e.alias(n) for n, e in audit.items() if n not in names.values()])
    added = [n for n in incoming.columns if not n.startswith("_")]
    matched = incoming.where("_status = 'linked_existing_master'").select("_original_id", *map(F.col, map(quoted, added)))
    source = "linked_merge_record_source"
    matched = matched.withColumnRenamed("_original_id", "_at")
    rest = [F.col(quoted(c)) for c in master.columns]
    base = keyed.withColumn("_order", order).join(matched, _spread(F.col("_original_id"), *rest) == F.col("_at"), "left")
    known = base.select(*[F.col(quoted(c)) for c in master_cols], *[F.col(quoted(n)) for n in added], F.lit("existing_master").alias(source), F.lit(0).alias("_part"), "_order", F.lit("").alias("_key"))
    fresh = incoming.where("_status <> 'linked_existing_master'").select(
        *[(F.nullif("_original", F.lit("")) if f.name == "PSIDBrokerID" else F.lit(None)).cast(f.dataType).alias(f.name) for f in master.schema.fields if f.name != ordinal],
        *[F.col(quoted(n)) for n in added],
        F.lit("y2_only_appended").alias(source),
        F.lit(1).alias("_part"),
        F.lit(0).cast("bigint").alias("_order"),
        F.col("_current_id").alias("_key"),
    )
    return known.unionByName(fresh), decisions, state.groupBy("_status").count().withColumnRenamed("_status", "status")


def ordered(linked: DataFrame) -> DataFrame:
    """The linked master in its order, without the order's columns."""
    return linked.orderBy("_part", "_order", "_key").drop("_part", "_order", "_key")


def preserved(master: DataFrame, linked: DataFrame, ordinal: str | None = None) -> int:
    """Rows of the master that the linked master lost or changed, and the other way round; 0 if it is preserved."""
    cols = [c for c in master.columns if c != ordinal]
    before = master.select(*map(quoted, cols))
    after = linked.where("_part = 0").select(*map(quoted, cols))
    return before.exceptAll(after).count() + after.exceptAll(before).count()


def check_linked(linked: DataFrame, column: str = "Y2_BrokerPanelId") -> None:
    """Each follow-up id is in the output once."""
    n, distinct = linked.where(F.col(quoted(column)).isNotNull()).agg(F.count(F.lit(1)), F.count_distinct(fold_id(column))).first()
    if n != distinct:
        raise ValueError("Follow-up IDs are missing or duplicated after the merge.")


def linked_dictionary(master: DataFrame, followup: DataFrame, names: dict[str, str], prefix: str = "Y2_") -> Dictionary:
    """Labels of a linked master: the master's, the follow-up's with "[Y2 2026] " in front (255 characters), the audit's."""
    ours, theirs = fieldmeta.read(master), fieldmeta.read(followup)
    labels = {c: ours.labels.get(c) or c for c in master.columns}
    labels |= {n: ("[Y2 2026] " + (theirs.labels.get(c) or c))[:255] for c, n in names.items()}
    labels |= {
        f"{prefix}HIDBrokerPanelId": "Panel ID of the crosswalk",
        f"{prefix}crosswalk_original_id": "Original ID of the crosswalk",
        f"{prefix}crosswalk_status": "Status of the crosswalk link",
        "linked_merge_record_source": "Source of the record",
    }
    moved = theirs.renamed(names)
    return Dictionary(labels, ours.values | moved.values, ours.formats | moved.formats)
