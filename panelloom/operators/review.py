"""Review documents of mapping proposals: Markdown and JSON, rendered on the driver from the (small) proposal rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from datetime import datetime, timezone

# Sections of the review (title, field, value) and summary lines (text, confidence).
SECTIONS = (
    ("High Confidence Y2 Targets", "confidence", "high"),
    ("Medium Confidence Y2 Targets", "confidence", "medium"),
    ("Exact Master Matches", "confidence", "exact_match"),
    ("Loose Name Matches", "confidence", "loose_name_match"),
    ("Already Existing Y2 Targets", "confidence", "already_exists"),
    ("Unknown Mappings", "confidence", "unknown"),
    ("Survey Metadata Columns", "column_family", "survey_metadata"),
    ("Free Text Columns", "column_family", "free_text_response"),
)
LINES = (
    ("High-confidence Y2 targets", "high"),
    ("Medium-confidence Y2 targets", "medium"),
    ("Exact master matches", "exact_match"),
    ("Loose name matches", "loose_name_match"),
    ("Already-existing Y2 targets", "already_exists"),
    ("Unknown mappings", "unknown"),
)
HEAD = ("| # | Follow-up column | Family | Proposed target | Master signals | Reason |", "|---:|---|---|---|---|---|")
SIGNALS = (("exact", "exists_exact_in_master"), ("Y0", "y0_exists_in_master"), ("Y1", "y1_exists_in_master"), ("Y2", "y2_exists_in_master"))


def cell(value: object) -> str:
    """A value as a Markdown cell."""
    shown = "" if value is None else {True: "yes", False: "no"}[value] if isinstance(value, bool) else str(value)
    return " ".join(shown.replace("|", "\\|").splitlines()) if shown else ""


def truth(value: object) -> bool:
    """A flag, also one that was read back from a text file."""
    return value is True or (isinstance(value, str) and value.strip().lower() in ("true", "yes", "1"))


def _count(rows: list[dict], key: str) -> dict[str, int]:
    return dict(sorted(Counter(str(r.get(key, "")) for r in rows).items()))


def summarize(rows: list[dict]) -> dict:
    """total, by_confidence and by_column_family, sorted by name."""
    return {"total": len(rows), "by_confidence": _count(rows, "confidence"), "by_column_family": _count(rows, "column_family")}


def select_rows(rows: Iterable[dict], **wanted: str) -> list[dict]:
    """Rows whose fields equal all the wanted values."""
    return [r for r in rows if all(r.get(k) == v for k, v in wanted.items())]


def _table(rows: list[dict]) -> list[str]:
    if not rows:
        return ["_None._"]
    out = list(HEAD)
    for r in rows:
        signals = ", ".join(f"{name}: {'yes' if truth(r.get(key)) else 'no'}" for name, key in SIGNALS)
        cells = [r.get("followup_column_index"), r.get("followup_column"), r.get("column_family"), r.get("proposed_target_column") or "_blank_", signals, r.get("reason")]
        out.append("| " + " | ".join(map(cell, cells)) + " |")
    return out


def markdown(rows: list[dict]) -> str:
    """The review as a Markdown text."""
    counts = summarize(rows)
    listed = lambda d: [f"- {cell(k)}: {n}" for k, n in d.items()] or ["- none"]
    blocks = [
        ["# Y2 Mapping Review"],
        ["Generated from `possible_y2_mappings.csv`.", "This is a review artifact only; it does not modify source data."],
        ["## Summary"],
        [f"- Total follow-up columns reviewed: {len(rows)}", *[f"- {t}: {counts['by_confidence'].get(c, 0)}" for t, c in LINES]],
        ["## Counts By Confidence"],
        listed(counts["by_confidence"]),
        ["## Counts By Column Family"],
        listed(counts["by_column_family"]),
    ]
    for title, key, value in SECTIONS:
        blocks += [[f"## {title}"], _table(select_rows(rows, **{key: value}))]
    return "\n\n".join("\n".join(b) for b in blocks) + "\n"


def as_json(rows: list[dict], source_file: str, now: datetime | None = None) -> dict:
    """The review as data: every mapping waits for its approval. now is the clock, for repeatable results."""
    return {
        "version": "1",
        "generated_at": (now or datetime.now(timezone.utc)).isoformat(),
        "source_file": source_file,
        "summary": summarize(rows),
        "mappings": [{**r, "approved": None} for r in rows],
    }
