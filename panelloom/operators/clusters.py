"""Labeled cluster assignments with the provenance of their ids, and the checks of an assignment table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import cluster_code, first_filled, first_filled_source, normal_code, text
from panelloom.operators.link import duplicated
from panelloom.operators.rules import quoted

#: Fixed value: a name that the export uses itself.
RESERVED = "_cluster_source_code"


@dataclass
class ExportConfig:
    """Parameters of the assignments and of the long export (schema_version 2)."""

    id_sources: list[str]
    source_column: str
    labels: dict[str, str]
    included: list[str]
    waves: dict[str, str]
    join_column: str = "respondent_id"
    code_column: str = "cluster_code"
    label_column: str = "cluster_label"
    wave_column: str = "wave"
    exclude_stems: list[str] = field(default_factory=list)
    drop_all_missing: bool = True

    @property
    def metadata(self) -> list[str]:
        """The output's columns before the values."""
        return ["respondent_id", self.code_column, self.label_column, self.wave_column]


def _filled(x: object) -> bool:
    return isinstance(x, str) and bool(x.strip())


def _strings(payload: dict, key: str, *, empty: bool = False) -> list[str]:
    got = payload.get(key, [] if empty else None)
    if not isinstance(got, list) or not (got or empty) or not all(map(_filled, got)):
        raise ValueError(f"{key} is no list of filled strings.")
    return got


def read_config(payload: dict) -> ExportConfig:
    """The parameters, or an error that names what is wrong with them."""
    if payload.get("schema_version") != 2:
        raise ValueError("An export config has schema_version 2.")
    for key in ("cluster_source_column", "cluster_code_column", "cluster_label_column", "wave_column", "cluster_join_column"):
        if key in payload and not _filled(payload[key]) or key == "cluster_source_column" and key not in payload:
            raise ValueError(f"{key} is no filled string.")
    if "respondent_id_source_columns" in payload:
        ids = _strings(payload, "respondent_id_source_columns")
    elif _filled(payload.get("respondent_id_source_column")):
        ids = [payload["respondent_id_source_column"]]
    else:
        raise ValueError("The config needs respondent_id_source_columns or respondent_id_source_column.")
    raw = payload.get("cluster_labels")
    if not isinstance(raw, dict) or not raw or not all(_filled(k) and _filled(v) for k, v in raw.items()):
        raise ValueError("cluster_labels maps codes to labels, none of them blank.")
    labels: dict[str, str] = {}
    for k, v in raw.items():
        if v != v.strip():
            raise ValueError("A cluster label has outer white space.")
        if normal_code(k) in labels:
            raise ValueError(f"A cluster code is duplicated after normalization: {normal_code(k)}")
        if v in labels.values():
            raise ValueError("Two cluster codes have the same label.")
        labels[normal_code(k)] = v
    included = [normal_code(c) for c in _strings(payload, "included_cluster_codes")]
    if len(set(included)) != len(included):
        raise ValueError("included_cluster_codes has duplicates after normalization.")
    if missing := sorted(set(included) - set(labels)):
        raise ValueError("Included cluster codes have no label: " + ", ".join(missing))
    if payload.get("missing_cluster_policy") != "exclude":
        raise ValueError("missing_cluster_policy is 'exclude'.")
    waves = payload.get("waves")
    if not isinstance(waves, dict) or not waves:
        raise ValueError("The config needs waves.")
    prefixes: dict[str, str] = {}
    for w, spec in waves.items():
        if not _filled(w):
            raise ValueError("A wave's name is blank.")
        if not isinstance(spec, dict):
            raise ValueError(f"Wave {w} is no object.")
        if not _filled(spec.get("prefix")):
            raise ValueError(f"Wave {w} needs a prefix.")
        if spec["prefix"] in prefixes.values():
            raise ValueError(f"A wave's prefix is duplicated: {spec['prefix']}")
        prefixes[w] = spec["prefix"]
    cfg = ExportConfig(
        ids,
        payload["cluster_source_column"],
        labels,
        included,
        prefixes,
        payload.get("cluster_join_column", "respondent_id"),
        payload.get("cluster_code_column", "cluster_code"),
        payload.get("cluster_label_column", "cluster_label"),
        payload.get("wave_column", "wave"),
        _strings(payload, "exclude_stems", empty=True),
        bool(payload.get("drop_all_missing_rows", True)),
    )
    if len(set(cfg.metadata)) != len(cfg.metadata):
        raise ValueError("The metadata columns' names are not distinct.")
    if RESERVED in cfg.metadata:
        raise ValueError(f"A metadata column uses a reserved name: {RESERVED}")
    return cfg


def load_config(path: str | Path) -> ExportConfig:
    """read_config of a JSON file."""
    return read_config(json.loads(Path(path).read_text(encoding="utf-8")))


def require_columns(df: DataFrame, cfg: ExportConfig) -> None:
    """The linked master has the columns that the config names."""
    missing = [c for c in cfg.id_sources if c not in df.columns]
    if missing:
        raise ValueError("The linked master is missing respondent ID source columns: " + ", ".join(missing))
    if cfg.source_column not in df.columns:
        raise ValueError(f"The linked master is missing its cluster source column: {cfg.source_column}")


def identified(df: DataFrame, cfg: ExportConfig) -> DataFrame:
    """df with respondent_id, _id_source and _code (the normalized cluster code)."""
    return df.withColumns({"respondent_id": first_filled(cfg.id_sources), "_id_source": first_filled_source(cfg.id_sources), "_code": cluster_code(cfg.source_column)})


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """The label of a code; null for a code without one."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), code)


def check_codes(marked: DataFrame, cfg: ExportConfig) -> None:
    """No unknown code, and no respondent with several codes (a blank one counts as a code)."""
    unknown = marked.where((F.col("_code") != "") & ~F.col("_code").isin(list(cfg.labels))).select("_code").distinct().orderBy("_code").limit(50).collect()
    if unknown:
        raise ValueError("The cluster source has unknown codes: " + ", ".join(r[0] for r in unknown))
    several = conflicts(marked).orderBy("respondent_id").limit(10).collect()
    if several:
        raise ValueError("The linked master has conflicting cluster codes for respondents: " + ", ".join(r["respondent_id"] for r in several))


def conflicts(marked: DataFrame) -> DataFrame:
    """(respondent_id, codes) of respondents with more than one code."""
    return marked.where("respondent_id <> ''").groupBy("respondent_id").agg(F.count_distinct("_code").alias("codes")).where("codes > 1")


def assignments(marked: DataFrame, cfg: ExportConfig) -> DataFrame:
    """(respondent_id, code, label) of the rows with an included code and an id."""
    rows = marked.where(F.col("_code").isin(cfg.included) & (F.col("respondent_id") != ""))
    return rows.select("respondent_id", F.col("_code").alias(cfg.code_column), label_of(F.col("_code"), cfg.labels).alias(cfg.label_column))


def assignment_counts(marked: DataFrame, cfg: ExportConfig) -> dict:
    """The counts of the assignments' report, by one aggregation per kind."""
    usable, included = F.col("respondent_id") != "", F.col("_code").isin(cfg.included)
    excluded = (F.col("_code") != "") & ~included
    row = marked.agg(F.count(F.lit(1)), F.count_if(usable), F.count_if(included & usable), F.count_if(included & ~usable), F.count_if(F.col("_code") == ""), F.count_if(excluded)).first()
    names = ("linked_master_rows", "rows_with_respondent_id", "included_cluster_assignments", "included_rows_missing_respondent_id", "blank_cluster_code_rows", "excluded_cluster_code_rows")
    by = lambda cond, c: marked.where(cond).groupBy(c).count()
    # The most frequent source first; equally frequent ones come as the config names them, the order of priority.
    sources = sorted(by(included & usable, "_id_source").collect(), key=lambda r: (-r["count"], cfg.id_sources.index(r[0])))
    return dict(zip(names, row, strict=True)) | {
        "included_respondent_id_source_counts": {r[0]: r[1] for r in sources},
        "included_cluster_code_counts": {r[0]: r[1] for r in by(included & usable, "_code").orderBy("_code").collect()},
        "excluded_cluster_code_counts": {r[0]: r[1] for r in by(excluded, "_code").orderBy("_code").collect()},
    }


def read_assignments(df: DataFrame, cfg: ExportConfig) -> DataFrame:
    """A stored assignment table, normalized: respondent_id, code, label."""
    need = [cfg.join_column, cfg.code_column, cfg.label_column]
    missing = sorted(set(need) - set(df.columns))
    if missing:
        raise ValueError(f"The cluster assignments are missing columns: {', '.join(missing)}")
    return df.select(text(cfg.join_column).alias("respondent_id"), cluster_code(cfg.code_column).alias(cfg.code_column), text(cfg.label_column).alias(cfg.label_column))


def check_assignments(given: DataFrame, cfg: ExportConfig) -> None:
    """No blank cell, no respondent twice, only included codes, each with its label."""
    row = given.agg(*[F.count_if(F.col(quoted(c)) == "") for c in given.columns]).first()
    for c, n in zip(given.columns, row, strict=True):
        if n:
            raise ValueError(f"The cluster assignments have blank {c} values.")
    twice = duplicated(given, ["respondent_id"]).orderBy("respondent_id").limit(10).collect()
    if twice:
        raise ValueError("The cluster assignments have duplicate respondents: " + ", ".join(r[0] for r in twice))
    code, label = F.col(quoted(cfg.code_column)), F.col(quoted(cfg.label_column))
    odd = given.where(~code.isin(cfg.included)).select(code).distinct().orderBy(code).limit(50).collect()
    if odd:
        raise ValueError("The cluster assignments have excluded or unknown codes: " + ", ".join(r[0] for r in odd))
    wrong = given.where(~label.eqNullSafe(label_of(code, cfg.labels))).orderBy("respondent_id").limit(10).collect()
    if wrong:
        raise ValueError("The cluster assignments have labels that don't match the config: " + ", ".join(f"{r[1]}:{r[2]}" for r in wrong))


def check_against_source(given: DataFrame, marked: DataFrame, cfg: ExportConfig) -> None:
    """Every assigned respondent is in the linked master, with the same code."""
    source = marked.where("respondent_id <> ''").select("respondent_id", "_code").distinct()
    joined = given.join(source, "respondent_id", "left")
    absent = joined.where("_code is null").orderBy("respondent_id").limit(10).collect()
    if absent:
        raise ValueError("The cluster assignments have respondents that aren't in the linked master: " + ", ".join(r["respondent_id"] for r in absent))
    other = joined.where(F.col(quoted(cfg.code_column)) != F.col("_code")).orderBy("respondent_id").limit(10).collect()
    if other:
        raise ValueError("The cluster assignments don't match the linked master: " + ", ".join(f"{r['respondent_id']}:{r[cfg.code_column]}!={r['_code']}" for r in other))
