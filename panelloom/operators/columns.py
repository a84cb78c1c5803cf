"""Schema comparison and column-mapping proposals over header relations (ordinal, name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.scalars import squashed_name

# Prefixes of the survey's metadata fields.
METADATA_PREFIXES = (
    "StartDate", "EndDate", "Status", "IPAddress", "Progress", "Duration", "Finished", "RecordedDate", "ResponseId", "Recipient",
    "ExternalReference", "LocationLatitude", "LocationLongitude", "DistributionChannel", "UserLanguage", "BrokerPanelId", "PSIDBrokerID", "Case",
)
# Confidence and reason of a proposal, in order of precedence.
PROPOSALS = {
    "high": "Master has both Y0_ and Y1_ versions; likely year-2 target.",
    "medium": "Master has Y1_ version; likely year-2 target.",
    "already_exists": "Y2_ version already exists in master.",
    "exact_match": "Column already exists in master without wave prefix.",
    "loose_name_match": "No exact match, but normalized name matches a master column.",
    "unknown": "No exact, Y0/Y1/Y2, or loose normalized match found.",
}


def header_table(spark: SparkSession, headers: list[str]) -> DataFrame:
    """(idx, name) of headers, counted from 1."""
    return spark.createDataFrame(list(enumerate(headers, start=1)), "idx int, name string")


def family(c: Column | str) -> Column:
    """wave_column, raw_survey_question, free_text_response, survey_metadata or other."""
    n = F.col(c) if isinstance(c, str) else c
    metadata = F.lit(False)
    for p in METADATA_PREFIXES:
        metadata |= n.startswith(p)
    return (
        F.when(n.rlike("^Y[012]_"), "wave_column")
        .when(n.rlike(r"(?U)\AQ\d+(_\d+)?\z"), "raw_survey_question")
        .when(n.endswith("_TEXT"), "free_text_response")
        .when(metadata, "survey_metadata")
        .otherwise("other")
    )


def _last(headers: DataFrame) -> DataFrame:
    """One row per name; a repeated name has its last place."""
    return headers.groupBy("name").agg(F.max("idx").alias("last"))


def in_both(followup: DataFrame, master: DataFrame) -> DataFrame:
    """(column, followup_index, master_index, column_family) of the follow-up's names that the master has."""
    joined = followup.select("name").distinct().join(_last(followup), "name").join(_last(master).withColumnRenamed("last", "theirs"), "name")
    return joined.select(F.col("name").alias("column"), F.col("last").alias("followup_index"), F.col("theirs").alias("master_index"), family("name").alias("column_family"))


def only_in(left: DataFrame, right: DataFrame, index: str) -> DataFrame:
    """(column, index, column_family) of the names that only left has."""
    return _last(left).join(right.select("name").distinct(), "name", "left_anti").select(F.col("name").alias("column"), F.col("last").alias(index), family("name").alias("column_family"))


def propose(followup: DataFrame, master: DataFrame) -> DataFrame:
    """A mapping proposal per follow-up column, by the master's names with and without wave prefix; ten columns.

    A name that equals several master names when simplified takes the last of them.
    """
    names = master.select("name").distinct()
    df = followup
    for flag, prefix in (("exists_exact_in_master", ""), ("y0_exists_in_master", "Y0_"), ("y1_exists_in_master", "Y1_"), ("y2_exists_in_master", "Y2_")):
        known = names.select(F.col("name").alias("_m"), F.lit(True).alias(flag))
        df = df.join(known, F.concat(F.lit(prefix), F.col("name")) == F.col("_m"), "left").drop("_m").withColumn(flag, F.coalesce(flag, F.lit(False)))
    loose = master.groupBy(squashed_name("name").alias("_s")).agg(F.max_by("name", "idx").alias("_loose"))
    df = df.join(loose, squashed_name("name") == F.col("_s"), "left").drop("_s")
    exact, y0, y1, y2 = map(F.col, ("exists_exact_in_master", "y0_exists_in_master", "y1_exists_in_master", "y2_exists_in_master"))
    confidence = (
        F.when(y0 & y1 & ~y2, "high")
        .when(y1 & ~y2, "medium")
        .when(y2, "already_exists")
        .when(exact, "exact_match")
        .when(F.coalesce(F.col("_loose") != "", F.lit(False)), "loose_name_match")
        .otherwise("unknown")
    )
    df = df.withColumn("confidence", confidence)
    c = F.col("confidence")
    target = F.when(c.isin("high", "medium", "already_exists"), F.concat(F.lit("Y2_"), F.col("name"))).when(c == "exact_match", F.col("name")).when(c == "loose_name_match", F.col("_loose")).otherwise("")
    reason = F.create_map(*[F.lit(x) for kv in PROPOSALS.items() for x in kv])[c]
    return df.select(
        F.col("idx").alias("followup_column_index"),
        F.col("name").alias("followup_column"),
        family("name").alias("column_family"),
        exact,
        y0,
        y1,
        y2,
        target.alias("proposed_target_column"),
        "confidence",
        reason.alias("reason"),
    )


def summary(mappings: DataFrame) -> DataFrame:
    """(total, by_confidence, by_column_family) as rows (kind, name, n) by one grouping-sets aggregation; missing is ''."""
    m = mappings.select(F.coalesce("confidence", F.lit("")).alias("confidence"), F.coalesce("column_family", F.lit("")).alias("column_family"))
    grouped = m.groupingSets([[m.confidence], [m.column_family], []], m.confidence, m.column_family).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 1, "confidence").when(F.col("g") == 2, "column_family").otherwise("total")
    return grouped.select(kind.alias("kind"), F.coalesce(F.when(F.col("g") == 1, F.col("confidence")).when(F.col("g") == 2, F.col("column_family")), F.lit("")).alias("name"), "n")
