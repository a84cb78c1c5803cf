"""The pipeline of a follow-up wave: raw file to aligned dataset, comparison with a trusted one, link into the master.

Stages hand over by files, where the comparison gates the link, and each stage plans one lazy DataFrame from its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions import fieldmeta
from panelloom.functions.fieldmeta import Dictionary
from panelloom.functions.scalars import excel_serial, text
from panelloom.operators import append, diff, link, rules
from panelloom.operators.rules import quoted
from panelloom.sources import files, sav

#: Rows of the production inputs: master, follow-up, follow-up after deduplication.
EXPECTED = (9523, 1635, 1627)


def _expect(what: str, wanted: int | None, found: int) -> None:
    if wanted is not None and wanted != found:
        raise ValueError(f"Expected {wanted} {what}, found {found}.")


def derive(raw: DataFrame, program: dict, *, enforce_expected: bool = True) -> tuple[DataFrame, dict[str, str], Dictionary, list[str]]:
    """(derived dataset, header -> variable name, value labels, columns left as text) of a raw text table with _ord."""
    expected = (program.get("expected") or {}) if enforce_expected else {}
    headers = [c for c in raw.columns if c != files.ORDINAL]
    rows = append.drop_metadata(raw)
    names = dict(zip(headers, rules.spss_names(headers), strict=True))
    # Rows count from 0 after the metadata lines, as the messages do.
    renamed = rows.select(*[F.col(quoted(h)).alias(n) for h, n in names.items()], files.ORDINAL)
    coerced, left = rules.coerce_columns(renamed, names)
    _expect("input rows", expected.get("input_rows"), rows.count() if expected.get("input_rows") is not None else 0)
    _expect("input columns", expected.get("input_columns"), len(headers))
    rules.check_sources(coerced, program, files.ORDINAL)
    derived, labels = rules.apply_program(coerced, program)
    _expect("output columns", expected.get("output_columns"), len(derived.columns) - 1)
    key = (program.get("expected") or {}).get("id_column", "ResponseId")
    n, blank, distinct = derived.agg(F.count(F.lit(1)), F.count_if(text(key) == ""), F.count_distinct(text(key))).first()
    if blank or distinct != n:
        raise ValueError(f"{key} values must be populated and unique.")
    return derived, names, labels, left


def align(df: DataFrame, program: dict) -> DataFrame:
    """df with its date texts as day numbers and its blank columns as missing numbers, as a system file holds them."""
    alignment = program.get("sav_alignment") or {}
    blank = [c for c in alignment.get("empty_numeric_columns", []) if c in df.columns]
    if blank:
        held = df.agg(*[F.count_if(text(F.col(quoted(c))) != "") for c in blank]).first()
        for c, n in zip(blank, held, strict=True):
            if n:
                raise ValueError(f"Expected {c} to contain only blank values.")
    dates = [c for c in alignment.get("date_columns", []) if c in df.columns]
    return df.withColumns({**{c: excel_serial(c) for c in dates}, **{c: F.lit(None).cast("double") for c in blank}})


def transform(spark: SparkSession, input_csv, master_sav, config, output_csv, output_sav, report_json=None, *, enforce_expected: bool = True) -> dict:
    """Raw follow-up file to derived CSV and system file, with a report."""
    program = rules.load_program(config)
    raw = files.read_text_table(spark, input_csv)
    derived, names, labels, left = derive(raw, program, enforce_expected=enforce_expected)
    with open(master_sav, "rb") as f:
        if not sav.read_dictionary(f).variables:
            raise ValueError("The master has no columns.")
    ordered = derived.orderBy(files.ORDINAL).drop(files.ORDINAL)
    rows = files.write_table(ordered, output_csv)
    alignment = program.get("sav_alignment") or {}
    aligned = align(derived, program).orderBy(files.ORDINAL).drop(files.ORDINAL)
    formats = {f.name: "F8.2" for f in aligned.schema.fields if isinstance(f.dataType, T.DoubleType)} | {c: "F18.12" for c in alignment.get("date_columns", []) if c in aligned.columns}
    dictionary = Dictionary({n: h for h, n in names.items()}, labels.values, formats)
    sav.write_sav(fieldmeta.attach(aligned, dictionary), output_sav)
    # The keys of the reports are what their readers look for.
    report = {
        "input_csv": str(input_csv),
        "master_sav": str(master_sav),
        "config": str(config),
        "input_rows": rows,
        "input_columns": len(names),
        "derived_columns": len(derived.columns) - 1 - len(names),
        "output_rows": rows,
        "output_columns": len(derived.columns) - 1,
        "rejected_numeric_columns": left,
        **_written(output_csv, output_sav),
    }
    if report_json:
        files.write_json(report_json, report)
    return report


def _written(output_csv, output_sav) -> dict:
    """Paths and fingerprints of a stage's two files."""
    paths = {"output_csv": output_csv, "output_sav": output_sav}
    return {k: str(p) for k, p in paths.items()} | {f"{k}_sha256": files.sha256(p) for k, p in paths.items()}


def validate(spark: SparkSession, candidate_sav, oracle_sav, report_json=None, *, key: str = "ResponseId", tolerance: float = diff.TOLERANCE) -> dict:
    """The comparison of two system files; its report is written before a difference raises an error."""
    paths = {"candidate_sav": candidate_sav, "oracle_sav": oracle_sav}
    given = {k: str(p) for k, p in paths.items()} | {k.replace("_sav", "_sha256"): files.sha256(p) for k, p in paths.items()}
    report = given | diff.compare(sav.read_sav(spark, candidate_sav), sav.read_sav(spark, oracle_sav), key, tolerance=tolerance)
    if report_json:
        files.write_json(report_json, report)
    if report["issues"]:
        raise ValueError(f"The transformation differs from its oracle: {len(report['issues'])} issue(s). See {report_json or 'the report'}.")
    return report


def build_linked(spark: SparkSession, master_sav, followup_sav, crosswalk_xlsx, output_csv, output_sav, report_json=None, *, expected: tuple[int, int, int] | None = None) -> dict:
    """Master, follow-up and crosswalk to the linked master as CSV and system file, with a report."""
    at = files.ORDINAL
    master, followup = sav.read_sav(spark, master_sav, ordinal=at), sav.read_sav(spark, followup_sav, ordinal=at)
    crosswalk = files.read_crosswalk(spark, crosswalk_xlsx)
    sizes = master.count(), followup.count()
    if expected:
        _expect("master rows", expected[0], sizes[0])
        _expect("follow-up rows", expected[1], sizes[1])
    linked, decisions, statuses = link.link(master, followup, crosswalk, ordinal=at)
    dropped = [r.asDict() for r in decisions.orderBy("_current_id", "_ranking").drop("_current_id", "_ranking").collect()]
    if expected:
        _expect("deduplicated follow-up rows", expected[2], sizes[1] - len(dropped))
    if link.preserved(master, linked, at):
        raise ValueError("The merge changed existing master rows.")
    link.check_linked(linked)
    by = {r["status"]: r["count"] for r in statuses.collect()}
    names = link.target_names([c for c in followup.columns if c != at], [c for c in master.columns if c != at])
    out = fieldmeta.attach(link.ordered(linked), link.linked_dictionary(master.drop(at), followup.drop(at), names))
    rows = files.write_table(out, output_csv)
    sav.write_sav(out, output_sav)
    report = {
        "method": "wide linked merge using respondent crosswalk",
        "inputs": {str(p): files.sha256(p) for p in (master_sav, followup_sav, crosswalk_xlsx)},
        "counts": {
            "master_rows": sizes[0],
            "raw_followup_rows": sizes[1],
            "duplicate_followup_rows_removed": len(dropped),
            "deduplicated_followup_rows": sizes[1] - len(dropped),
            "linked_to_existing_master": by.get("linked_existing_master", 0),
            "crosswalk_original_missing_master": by.get("crosswalk_original_missing_master", 0),
            "no_crosswalk": by.get("no_crosswalk", 0),
            "new_rows_appended": sum(n for s, n in by.items() if s != "linked_existing_master"),
            "output_rows": rows,
            "master_columns": len(master.columns) - 1,
            "y2_columns_added": len(names),
            "output_columns": len(out.columns),
        },
        "deduplication_decisions": dropped,
        "outputs": [str(output_csv), str(output_sav)],
        **{k: v for k, v in _written(output_csv, output_sav).items() if k.endswith("sha256")},
    }
    if report_json:
        files.write_json(report_json, report)
    return report
