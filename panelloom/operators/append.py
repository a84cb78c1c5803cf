"""Rough append of a follow-up to a master: renamed by a reviewed mapping, schemas widened, gaps filled with ''."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import strip
from panelloom.operators.rules import quoted


def is_metadata(c: Column) -> Column:
    """Whether a ResponseId marks one of the two header-like lines of a survey export."""
    s = strip(c)
    return F.coalesce((s == "Response ID") | s.startswith('{"ImportId"'), F.lit(False))


def drop_metadata(df: DataFrame, *, required: bool = True) -> DataFrame:
    """df without its header-like rows; a missing ResponseId is an error, or, if not required, nothing is dropped."""
    if "ResponseId" not in df.columns:
        if required:
            raise ValueError("The input is missing its required column: ResponseId")
        return df
    return df.where(~is_metadata(F.col("ResponseId")))


def mapping_of(rows: list[dict]) -> dict[str, str]:
    """Follow-up column -> target of reviewed mapping rows; of repeated sources the last target wins, at the first place.

    A blank BrokerPanelId maps to Y2_BrokerPanelId; other blank targets map nothing.
    """
    out: dict[str, str] = {}
    for r in rows:
        source, target = (r.get("followup_column") or "").strip(), (r.get("proposed_target_column") or "").strip()
        if source == "BrokerPanelId" and not target:
            target = "Y2_BrokerPanelId"
        if source and target:
            out[source] = target
    return out


def append(master: DataFrame, followup: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """(master and mapped follow-up rows, the columns that the follow-up adds), all as text with '' for missing.

    The output has the master's columns, then each new target once; of several sources of one target the last wins.
    """
    followup = drop_metadata(followup, required=False)
    used = {s: t for s, t in mapping.items() if s in followup.columns}
    new = list(dict.fromkeys(t for t in used.values() if t not in master.columns))
    source_of = {t: s for s, t in used.items()}
    cell = lambda c: F.coalesce(F.col(quoted(c)).cast("string"), F.lit(""))
    first = master.select(*[cell(c).alias(c) for c in master.columns], *[F.lit("").alias(c) for c in new])
    second = followup.select(*[(cell(source_of[c]) if c in source_of else F.lit("")).alias(c) for c in [*master.columns, *new]])
    return first.unionByName(second), new
