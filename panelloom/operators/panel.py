"""Wide to long: numeric wave-prefixed columns become one row per respondent and wave, with audited exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import to_number
from panelloom.operators import clusters
from panelloom.operators.clusters import ExportConfig
from panelloom.operators.link import duplicated
from panelloom.operators.rules import non_numeric_columns, quoted
from panelloom.plans.skew import checked_lookup

#: The reasons of an exclusion, and their names in the keys of the report.
REASONS = {"blank": "blank_cluster", "code": "cluster_code", "missing": "missing_cluster_assignment"}


def wave_columns(columns: list[str], waves: dict[str, str], exclude: list[str] | tuple[str, ...] = ()) -> dict[str, dict[str, str]]:
    """stem -> wave -> column, for the columns that begin with a wave's prefix; stems in alphabetical order."""
    found: dict[str, dict[str, str]] = {}
    for wave, prefix in waves.items():
        for c in columns:
            stem = c[len(prefix) :]
            if c.startswith(prefix) and stem and stem not in exclude:
                found.setdefault(stem, {})[wave] = c
    return dict(sorted(found.items()))


def numeric_stems(df: DataFrame, waves: dict[str, str], exclude: list[str] | tuple[str, ...] = ()) -> tuple[dict[str, dict[str, str]], list[str]]:
    """(numeric stems with their columns, the other stems); a stem is numeric if all non-blank values of all waves are.

    Columns without values count as numeric. Non-numeric columns are found in one pass by unpivoting.
    """
    stems = wave_columns(df.columns, waves, exclude)
    bad = non_numeric_columns(df, [c for by in stems.values() for c in by.values()], stripped=True)
    numeric = {s: by for s, by in stems.items() if not bad & set(by.values())}
    return numeric, [s for s in stems if s not in numeric]


def long_panel(df: DataFrame, stems: dict[str, dict[str, str]], waves: dict[str, str], *, keep: list[str], wave_column: str = "wave") -> DataFrame:
    """One row per row of df and wave: keep, _wave (its index), the wave and a double per stem; one scan, no union."""
    def cell(stem: str, wave: str):
        column = stems[stem].get(wave)
        return (to_number(column) if column else F.lit(None).cast("double")).alias(stem)

    lines = [F.struct(F.lit(i).alias("_wave"), F.lit(w).alias(wave_column), *[cell(s, w) for s in stems]) for i, w in enumerate(waves)]
    return df.select(*map(quoted, keep), F.inline(F.array(*lines)))


def drop_empty(panel: DataFrame, stems: list[str]) -> DataFrame:
    """Rows with at least one value."""
    return panel.where(F.coalesce(*[F.col(quoted(s)) for s in stems]).isNotNull())


def with_reason(panel: DataFrame, given: DataFrame, cfg: ExportConfig) -> DataFrame:
    """panel with its assignment and _reason: blank, code or missing, null for a row that stays.

    given has one row per respondent, of whom one may have a large share of the panel's rows.
    """
    joined = checked_lookup(panel, given, ["respondent_id"])
    code, label = F.col(quoted(cfg.code_column)), F.col(quoted(cfg.label_column))
    lacks = F.coalesce(code == "", F.lit(True)) | F.coalesce(label == "", F.lit(True))
    reason = F.when(F.col("_code") == "", "blank").when(~F.col("_code").isin(cfg.included), "code").when(lacks, "missing")
    return joined.withColumn("_reason", reason)


def exclusion_counts(reasoned: DataFrame) -> DataFrame:
    """(reason, code, rows, respondents) of the excluded rows; code is '' but for reason code."""
    code = F.when(F.col("_reason") == "code", F.col("_code")).otherwise("")
    return reasoned.where("_reason is not null").groupBy(F.col("_reason").alias("reason"), code.alias("code")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("respondent_id").alias("respondents"))


def output(reasoned: DataFrame, cfg: ExportConfig, stems: list[str]) -> DataFrame:
    """The analysis-ready rows: distinct, columns in their fixed order, with _wave and _order for the sink."""
    cols = ["respondent_id", cfg.code_column, cfg.label_column, cfg.wave_column, *stems]
    return reasoned.where("_reason is null").groupBy(*map(quoted, cols)).agg(F.min("_wave").alias("_wave"), F.min("_order").alias("_order"))


def check_panel(out: DataFrame, cfg: ExportConfig) -> None:
    """No blank respondent and no respondent twice in a wave."""
    if out.where("respondent_id = ''").limit(1).count():
        raise ValueError("The export made rows with a blank respondent_id.")
    twice = duplicated(out, ["respondent_id", cfg.wave_column]).orderBy("respondent_id", cfg.wave_column).limit(10).collect()
    if twice:
        raise ValueError("The export made duplicate rows of respondent and wave: " + ", ".join(f"{r[0]}/{r[1]}" for r in twice))


def wave_counts(out: DataFrame, cfg: ExportConfig) -> dict[str, int]:
    """Rows by wave, in the waves' order."""
    return {r[1]: r[2] for r in out.groupBy("_wave", cfg.wave_column).count().orderBy("_wave").collect()}


def export(master: DataFrame, given: DataFrame, cfg: ExportConfig, *, ordinal: str | None = None) -> tuple[DataFrame, dict]:
    """(analysis-ready rows with _wave and _order, report) of a linked master and its assignments.

    The order of steps has meaning: eligible rows are counted after rows without values are dropped and before the
    cluster filter.
    """
    clusters.require_columns(master, cfg)
    marked = clusters.identified(master, cfg)
    clusters.check_codes(marked, cfg)
    given = clusters.read_assignments(given, cfg)
    clusters.check_assignments(given, cfg)
    clusters.check_against_source(given, marked, cfg)
    stems, other = numeric_stems(master.drop(ordinal) if ordinal else master, cfg.waves, cfg.exclude_stems)
    if not stems:
        raise ValueError("No numeric wave-prefixed column is eligible for the export.")
    clash = sorted(set(stems) & {*cfg.metadata, clusters.RESERVED})
    if clash:
        raise ValueError("Value columns conflict with the export's metadata: " + ", ".join(clash))
    placed = marked.withColumn("_order", F.col(ordinal).cast("bigint") if ordinal else F.lit(0).cast("bigint"))
    panel = long_panel(placed, stems, cfg.waves, keep=["respondent_id", "_code", "_order"], wave_column=cfg.wave_column)
    if cfg.drop_all_missing:
        panel = drop_empty(panel, list(stems))
    if panel.where("respondent_id = ''").limit(1).count():
        raise ValueError("The export made rows with a blank respondent_id.")
    eligible, people = panel.agg(F.count(F.lit(1)), F.count_distinct("respondent_id")).first()
    reasoned = with_reason(panel, given, cfg)
    out = output(reasoned, cfg, list(stems))
    check_panel(out, cfg)
    gone = exclusion_counts(reasoned).collect()
    total = lambda reason, what: sum(r[what] for r in gone if r["reason"] == reason)
    rows, distinct = out.agg(F.count(F.lit(1)), F.count_distinct("respondent_id")).first()
    excluded_people = reasoned.where("_reason is not null").agg(F.count_distinct("respondent_id")).first()[0]
    counts = {
        "linked_master_rows": master.count(),
        "analysis_eligible_rows_before_cluster_filter": eligible,
        "analysis_eligible_respondents_before_cluster_filter": people,
        "analysis_ready_rows": rows,
        "distinct_respondent_id": distinct,
        "wave_counts": wave_counts(out, cfg),
        "dv_columns": len(stems),
        "excluded_unclustered_rows": sum(r["rows"] for r in gone),
        "excluded_unclustered_respondents": excluded_people,
        **{f"excluded_{name}_{what}": total(reason, what) for reason, name in REASONS.items() for what in ("rows", "respondents")},
        "excluded_cluster_code_row_counts": {r["code"]: r["rows"] for r in sorted(gone, key=lambda r: r["code"]) if r["reason"] == "code"},
        "excluded_cluster_code_respondent_counts": {r["code"]: r["respondents"] for r in sorted(gone, key=lambda r: r["code"]) if r["reason"] == "code"},
        "duplicate_respondent_wave_rows": 0,
    }
    return out, {"method": "long analysis-ready export from linked master", "counts": counts, "dv_columns": list(stems), "excluded_non_numeric_stems": other}


def wide_from_events(events: DataFrame, waves: dict[str, tuple[str, str]], kinds: list[str], *, user: str = "user_id", kind: str = "event_type", value: str = "value", ts: str = "ts") -> DataFrame:
    """A wide frame of an event table: the largest value per user, wave (a span of time) and kind, one aggregation."""
    cells = [F.max(F.when((F.col(ts) >= F.lit(a).cast("timestamp_ntz")) & (F.col(ts) < F.lit(b).cast("timestamp_ntz")) & (F.col(kind) == k), F.col(value))).alias(f"{w}_{k}") for w, (a, b) in waves.items() for k in kinds]
    return events.groupBy(user).agg(*cells)
