"""Best representative of each duplicate group.

Records of a group are compared by trust (finished), completeness (progress) and recency (recorded). The skyline of
undominated records is resolved by the lexicographic policy finished, progress, recorded, id. For every other field the
records that fill it have a skyline of their own, the first dominance layer of those records, which gives the field's
value in the same way: a record that leaves the field blank never hides a filled value that it dominates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import UNICODE_SPACE, strip

# Spellings of yes and no.
YES, NO = ("1", "1.0", "true", "yes", "y", "t"), ("0", "0.0", "false", "no", "n", "f")


def finished_rank(c: str) -> Column:
    """1 for yes, 0 for no, null for blank or unreadable."""
    s = F.lower(strip(F.col(c), UNICODE_SPACE))
    return F.when(s.isin(*YES), 1).when(s.isin(*NO), 0)


def progress_number(c: str) -> Column:
    """The number of a text, a percent sign ignored; null for blank or unreadable."""
    s = strip(F.regexp_replace(strip(F.col(c), UNICODE_SPACE), "%$", ""), UNICODE_SPACE)
    return F.when(s.rlike(r"^[+-]?([0-9]{1,300}(\.[0-9]*)?|\.[0-9]+)$"), s.try_cast("double"))


def recorded_second(c: str) -> Column:
    """Seconds since 1970 (UTC unless an offset is written); a bare number counts days since 1899-12-30; null if unreadable."""
    s = strip(F.col(c), UNICODE_SPACE)
    serial = F.when(s.rlike(r"^[0-9]{1,7}(\.[0-9]*)?$"), F.round(s.try_cast("double") * 86400).cast("bigint") - F.lit(2_209_161_600))
    plain = F.regexp_replace(F.regexp_replace(s, r"(:[0-9]{1,2})\.[0-9]+", "$1"), r"(?<=[0-9])[Tt](?=[0-9])", " ")
    zone = F.regexp_extract(plain, r"(?:[0-9]) ?([Zz]|[+-][0-9]{2}:?[0-9]{2}|[+-][0-9]{2}|UTC|GMT)$", 1)
    local = F.when(plain.rlike(":"), F.regexp_replace(plain, r"(?<=[0-9]) ?([Zz]|[+-][0-9]{2}:?[0-9]{2}|[+-][0-9]{2}|UTC|GMT)$", "")).otherwise(plain)
    offset = F.when(
        zone.rlike("^[+-]"),
        F.when(zone.startswith("-"), -1).otherwise(1) * (F.substring(zone, 2, 2).try_cast("int") * 3600 + F.coalesce(F.regexp_extract(zone, r"^.[0-9]{2}:?([0-9]{2})$", 1).try_cast("int"), F.lit(0)) * 60),
    ).otherwise(0)
    when = lambda shape, pattern: F.when(local.rlike(shape), F.unix_micros(F.try_to_timestamp(F.concat(local, F.lit(" +0000")), F.lit(pattern + " Z"))))
    date = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    named = r"[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}"
    clock = r" [0-9]{1,2}:[0-9]{1,2}"
    micros = F.coalesce(
        when(f"^{date}{clock}:[0-9]{{1,2}}$", "y-M-d H:m:s"),
        when(f"^{date}{clock}$", "y-M-d H:m"),
        when(f"^{date}$", "y-M-d"),
        when(f"^{named}{clock}:[0-9]{{1,2}}$", "d-MMM-y H:m:s"),
        when(f"^{named}{clock}$", "d-MMM-y H:m"),
        when(f"^{named}$", "d-MMM-y"),
    )
    return F.coalesce(serial, F.floor(micros / 1_000_000) - offset)


def survivors(records: DataFrame, *, group: str, record: str, finished: str, progress: str, recorded: str, fill: Sequence[str], values: bool = True) -> DataFrame:
    """One row per group of two or more records: _group, _size, the best record's id and, per field of fill, a struct.

    Columns: _group (the group's key, trimmed and in lower case), _size, `record`, and for each field f of fill the
    struct f(value, source): the value of the best record that fills it and that record's id, null if none does.
    With values=False value is null, and the fields' texts are not shuffled; else they are shuffled once, to join the
    records that were found to give some.
    Records rank by finished, progress, recorded, then id by code point, highest first; blank and unreadable values rank
    below all others; a null id ranks below all ids. Rows with a blank key form no group; records delivered again count
    each; of records that agree in all that ranks the greatest text is taken; an empty table gives no rows.

    A group of any size is first reduced, map-side, to the best record per finished, progress and field; the skyline is
    found among those cells by a running maximum, so no task holds a group.
    """
    key = F.lower(strip(F.col(group), UNICODE_SPACE))
    value = lambda c: F.col(c).cast("string")
    filled = lambda c: strip(value(c), UNICODE_SPACE) != ""
    low = lambda c, least: F.coalesce(c, F.lit(least))
    # What ranks, null below all else; an id has a sign in front, so that a null one can be told and joined.
    policy = {
        "_a": low(finished_rank(finished), -1),
        "_b": low(progress_number(progress), float("-inf")),
        "_t": low(recorded_second(recorded), -(1 << 62)),
        "_id": F.coalesce(F.concat(F.lit("="), F.col(record).cast("string")), F.lit("")),
    }
    place = [e.alias(n) for n, e in policy.items()]
    ranked = records.select(key.alias("_group"), *place, *[filled(c).alias(f"_f{i}") for i, c in enumerate(fill)]).where("_group <> ''")
    # Cells: (group, finished, progress), each with its latest record per field.
    best = [F.max(F.struct("_t", "_id")).alias("_c_0")]
    best += [F.max(F.when(F.col(f"_f{i}"), F.struct("_t", "_id"))).alias(f"_c_{i + 1}") for i in range(len(fill))]
    cells = ranked.groupBy("_group", "_a", "_b").agg(F.count(F.lit(1)).alias("_n"), *best)
    # One row per cell and field; dominated cells are those that a cell at least as finished and complete beats in time.
    # Groups of one record are left out first.
    sizes = cells.groupBy("_group").agg(F.sum("_n").alias("_size")).where("_size >= 2")
    lines = F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"_c_{i}._t").alias("_t"), F.col(f"_c_{i}._id").alias("_id")) for i in range(len(fill) + 1)])
    long = cells.join(sizes, "_group").select("_group", "_size", "_a", "_b", F.inline(lines)).where("_id is not null")
    above = Window.partitionBy("_group", "field").orderBy(F.desc("_b"), F.desc("_a")).rowsBetween(Window.unboundedPreceding, -1)
    # In this order a cell can only be dominated by one before it: by any at least as finished and as late, and since
    # no two cells agree in both finished and progress, one of them is strictly better.
    over = lambda a: F.max(F.when(F.col("_a") >= a, F.col("_t"))).over(above)
    beaten = F.when(F.col("_a") == 1, over(1)).when(F.col("_a") == 0, over(0)).otherwise(over(-1))
    skyline = long.withColumn("_beaten", beaten).where("_beaten is null or _beaten < _t")
    top = skyline.groupBy("_group", "_size", "field").agg(F.max(F.struct(*policy)).alias("p"))
    source = F.when(F.col("p._id") != "", F.expr("substring(p._id, 2)"))
    if not values:
        return top.groupBy("_group", "_size").agg(
            F.max(F.when(F.col("field") == 0, source)).alias(record),
            *[F.max(F.when(F.col("field") == i + 1, F.struct(F.lit(None).cast("string").alias("value"), source.alias("source")))).alias(c) for i, c in enumerate(fill)],
        )
    # The values are read once more: each record that gives some brings them to its group.
    wanted = top.groupBy("_group", "p", "_size").agg(F.collect_list("field").alias("_fields")).select("_group", "_size", "p.*", "_fields")
    given = records.select(key.alias("_group"), *place, *[F.when(filled(c), value(c)).alias(f"_v{i}") for i, c in enumerate(fill)]).where("_group <> ''")
    joined = given.join(wanted, ["_group", *policy])
    holds = lambda i: F.array_contains("_fields", i)
    source = F.when(F.col("_id") != "", F.expr("substring(_id, 2)"))
    return joined.groupBy("_group").agg(
        F.max("_size").alias("_size"),
        F.max(F.when(holds(0), source)).alias(record),
        *[F.max(F.when(holds(i + 1) & F.col(f"_v{i}").isNotNull(), F.struct(F.col(f"_v{i}").alias("value"), source.alias("source")))).alias(c) for i, c in enumerate(fill)],
    )
