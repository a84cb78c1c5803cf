"""Command line of the survey pipeline: python -m panelloom.cli COMMAND --option value."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions import fieldmeta
from panelloom.operators import append, clusters, columns, diff, link, panel, review, syntax
from panelloom.operators.rules import quoted
from panelloom.plans import wave
from panelloom.session import case_sensitive, get_spark
from panelloom.sources import files, sav

# Columns of the review artifacts.
BOTH, FOLLOWUP_ONLY, MASTER_ONLY = ("column", "followup_index", "master_index", "column_family"), ("column", "followup_index", "column_family"), ("column", "master_index", "column_family")
METADATA = ("source_file", "source_line", "label_type", "variable", "value", "label")
DIAGNOSTICS = ("source_file", "source_line", "severity", "code", "message", "statement")
CONFLICTS = ("severity", "code", "label_type", "variable", "value", "labels", "sources", "message")


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def _columns(spark: SparkSession, followup: Path, master: Path, out: Path) -> dict:
    ours, theirs = files.read_headers(followup), files.clean_headers(files.read_headers(master, encoding="latin-1"))
    a, b = columns.header_table(spark, ours), columns.header_table(spark, theirs)
    got = {
        "both": _rows(columns.in_both(a, b).orderBy("followup_index")),
        "followup": _rows(columns.only_in(a, b, "followup_index").orderBy("followup_index")),
        "master": _rows(columns.only_in(b, a, "master_index").orderBy("master_index")),
        "proposals": _rows(columns.propose(a, b).orderBy("followup_column_index")),
    }
    files.write_rows(out / "columns_in_both.csv", got["both"], BOTH)
    files.write_rows(out / "columns_only_in_followup.csv", got["followup"], FOLLOWUP_ONLY)
    files.write_rows(out / "columns_only_in_master.csv", got["master"], MASTER_ONLY)
    files.write_rows(out / "possible_y2_mappings.csv", got["proposals"], files.MAPPING_FIELDS)
    body = [
        "Column Comparison Summary", "=" * 80, f"Follow-up CSV: {followup}", f"Master CSV:    {master}", "",
        f"Follow-up columns: {len(ours)}", f"Master columns:    {len(theirs)}", "",
        f"Exact columns in both:       {len(got['both'])}", f"Columns only in follow-up:   {len(got['followup'])}",
        f"Columns only in master:      {len(got['master'])}", f"Possible Y2 mappings:        {len(got['proposals'])}",
    ]
    files.write_text(out / "column_comparison_summary.txt", "\n".join(body))
    return got | {"summary": "\n".join(body), "sizes": (len(ours), len(theirs))}


def _mappings(rows: list[dict], source: Path, out: Path) -> dict:
    files.write_text(out / "y2_mapping_review.md", review.markdown(rows))
    files.write_json(out / "y2_mappings.json", review.as_json(rows, str(source)))
    return review.summarize(rows)


def _labels(spark: SparkSession, paths: list[Path], out: Path) -> dict:
    result = syntax.parsed(syntax.read_files(spark, [str(p) for p in paths])).cache()
    ordered = result.orderBy("file_no", "position")
    rows, notes = _rows(syntax.metadata_rows(ordered)), _rows(syntax.diagnostics(ordered))
    found = _rows(syntax.conflicts(syntax.metadata_rows(result)).orderBy("label_type", "variable", "value"))
    result.unpersist()
    files.write_rows(out / "spss_metadata_rows.csv", rows, METADATA)
    files.write_rows(out / "spss_metadata_diagnostics.csv", notes, DIAGNOSTICS)
    files.write_rows(out / "spss_metadata_conflicts.csv", found, CONFLICTS)
    count = lambda k, v, of: sum(r[k] == v for r in of)
    counts = {
        "metadata_rows": len(rows), "variable_labels": count("label_type", "variable_label", rows), "value_labels": count("label_type", "value_label", rows),
        "diagnostics": len(notes), "conflicts": len(found), "conflict_warnings": count("severity", "warning", found), "duplicate_info": count("severity", "info", found),
    }
    codes = sorted({r["code"] for r in found})
    body = [
        "SPSS Metadata Extraction Summary", "=" * 80, "Syntax files:", *[f"- {p}" for p in paths], "",
        f"Metadata rows:   {counts['metadata_rows']}", f"Variable labels: {counts['variable_labels']}", f"Value labels:    {counts['value_labels']}",
        f"Diagnostics:     {counts['diagnostics']}", f"Conflict rows:   {counts['conflicts']}", f"Conflict warnings: {counts['conflict_warnings']}",
        f"Duplicate info:    {counts['duplicate_info']}", "", "Conflict codes:", *([f"- {c}: {count('code', c, found)}" for c in codes] or ["- none"]), "",
        "Generated files:", *[f"- {out / n}" for n in ("spss_metadata_rows.csv", "spss_metadata_diagnostics.csv", "spss_metadata_conflicts.csv", "spss_metadata_summary.txt")],
    ]
    files.write_text(out / "spss_metadata_summary.txt", "\n".join(body))
    return counts | {"summary": "\n".join(body)}


def compare_columns(spark, a):
    print(_columns(spark, a.followup_csv, a.master_csv, a.output_dir)["summary"])


def mapping_review(spark, a):
    rows = files.read_mapping(a.mappings_csv)
    summary = _mappings(rows, a.mappings_csv, a.output_dir)
    print(f"Mapping rows: {summary['total']}", *[f"- {k}: {n}" for k, n in summary["by_confidence"].items()], f"Output dir: {a.output_dir}", sep="\n")


def extract_spss_metadata(spark, a):
    print(_labels(spark, a.syntax_file, a.output_dir)["summary"])


def build_review_bundle(spark, a):
    out = a.output_dir
    cols = _columns(spark, a.followup_csv, a.master_csv, out / "column_comparison")
    total = _mappings(cols["proposals"], out / "column_comparison" / "possible_y2_mappings.csv", out / "mapping_review")["total"]
    labels = _labels(spark, a.syntax_file, out / "spss_metadata")
    body = [
        "# Review Bundle", "", "## Inputs", "", f"- Follow-up CSV: `{a.followup_csv}`", f"- Master CSV: `{a.master_csv}`", *[f"- SPSS syntax: `{p}`" for p in a.syntax_file], "",
        "## Column Comparison", "", f"- Follow-up columns: {cols['sizes'][0]}", f"- Master columns: {cols['sizes'][1]}", f"- Exact columns in both: {len(cols['both'])}",
        f"- Columns only in follow-up: {len(cols['followup'])}", f"- Columns only in master: {len(cols['master'])}", f"- Possible Y2 mappings: {total}", "",
        "## SPSS Metadata", "", f"- Metadata rows: {labels['metadata_rows']}", f"- Variable labels: {labels['variable_labels']}", f"- Value labels: {labels['value_labels']}",
        f"- Diagnostics: {labels['diagnostics']}", f"- Conflict rows: {labels['conflicts']}", f"- Conflict warnings: {labels['conflict_warnings']}", f"- Duplicate info: {labels['duplicate_info']}", "",
        "All files of this bundle are for review; none is merged data.", "",
    ]
    files.write_text(out / "review_bundle_summary.md", "\n".join(body))
    print(f"Review bundle: {out}")


def rough_merge_followup(spark, a):
    rows = files.read_mapping(a.mappings_csv, required=("followup_column", "proposed_target_column"))
    mapping = append.mapping_of(rows)
    master = files.read_text_table(spark, a.master_csv, encoding=a.master_encoding)
    followup = files.read_text_table(spark, a.followup_csv)
    merged, new = append.append(master, followup, mapping)
    at = files.ORDINAL
    # The ordinal is text after the append; the follow-up's rows come after the master's.
    part = F.when(F.col(quoted(at)) == "", 1).otherwise(0)
    n = files.write_table(merged.withColumn("_part", part).orderBy("_part", F.col(quoted(at)).try_cast("bigint")).drop("_part", at), a.output_csv, bom=False, newline="\r\n")
    unmapped = [r.get("followup_column", "") for r in rows if r.get("followup_column", "") not in mapping]
    print(f"Output rows: {n}", f"New columns added: {len(new)}", *[f"- {c}" for c in new], f"Unmapped follow-up columns: {len(unmapped)}", f"Output CSV: {a.output_csv}", sep="\n")


def transform_wave(spark, a):
    report = wave.transform(spark, a.input_csv, a.master_sav, a.config, a.output_csv, a.output_sav, a.report_json, enforce_expected=not a.any_size)
    print(f"Rows: {report['output_rows']}", f"Output columns: {report['output_columns']}", f"Output SAV: {a.output_sav}", sep="\n")


def validate_transform(spark, a):
    report = wave.validate(spark, a.candidate_sav, a.oracle_sav, a.report_json)
    print(f"The datasets agree: {report['rows']} rows, {report['columns']} columns.")


def build_linked_master(spark, a):
    report = wave.build_linked(spark, a.master_sav, a.followup_sav, a.crosswalk_xlsx, a.output_csv, a.output_sav, a.report_json, expected=None if a.any_size else wave.EXPECTED)
    print(f"Output rows: {report['counts']['output_rows']}", f"Output columns: {report['counts']['output_columns']}", sep="\n")


def build_y2_master(spark, a):
    out = a.output_dir
    wave.transform(spark, a.input_csv, a.master_sav, a.config, out / "followup_transformed.csv", out / "followup_transformed.sav", out / "transform_report.json", enforce_expected=not a.any_size)
    wave.validate(spark, out / "followup_transformed.sav", a.oracle_sav, out / "validation_report.json")
    report = wave.build_linked(spark, a.master_sav, out / "followup_transformed.sav", a.crosswalk_xlsx, out / "linked_master.csv", out / "linked_master.sav", out / "linked_report.json", expected=None if a.any_size else wave.EXPECTED)
    print(f"Output rows: {report['counts']['output_rows']}", f"Output dir: {out}", sep="\n")


def build_cluster_assignments(spark, a):
    cfg = clusters.load_config(a.config)
    master = files.read_text_table(spark, a.linked_master_csv)
    clusters.require_columns(master, cfg)
    marked = clusters.identified(master, cfg)
    clusters.check_codes(marked, cfg)
    given = clusters.assignments(marked.orderBy("respondent_id", files.ORDINAL), cfg)
    clusters.check_assignments(given, cfg)
    named = given.withColumnRenamed("respondent_id", cfg.join_column)
    n = files.write_table(named.orderBy(quoted(cfg.join_column)), a.output_csv)
    if a.report_json:
        files.write_json(
            a.report_json,
            {
                "method": "labeled cluster assignments from linked master",
                "inputs": {str(p): files.sha256(p) for p in (a.linked_master_csv, a.config)},
                "config": {"respondent_id_source_columns": cfg.id_sources, "cluster_source_column": cfg.source_column, "cluster_code_column": cfg.code_column, "cluster_label_column": cfg.label_column, "included_cluster_codes": sorted(cfg.included), "cluster_labels": cfg.labels},
                "counts": clusters.assignment_counts(marked, cfg),
                "output_csv": str(a.output_csv),
                "output_csv_sha256": files.sha256(a.output_csv),
            },
        )
    print(f"Included cluster assignments: {n}", f"Output CSV: {a.output_csv}", sep="\n")


def export_analysis_ready(spark, a):
    cfg = clusters.load_config(a.config)
    master = files.read_text_table(spark, a.linked_master_csv)
    given = files.read_text_table(spark, a.clusters_csv, ordinal=False)
    out, report = panel.export(master, given, cfg, ordinal=files.ORDINAL)
    files.write_table(out.orderBy("_wave", "_order").drop("_wave", "_order"), a.output_csv, bom=False, number=files.fourteen_digits)
    if a.report_json:
        report |= {"inputs": {str(p): files.sha256(p) for p in (a.linked_master_csv, a.clusters_csv, a.config)}, "output_csv": str(a.output_csv), "output_csv_sha256": files.sha256(a.output_csv)}
        report["config"] = {"respondent_id_source_columns": cfg.id_sources, "cluster_source_column": cfg.source_column, "cluster_code_column": cfg.code_column, "cluster_label_column": cfg.label_column, "included_cluster_codes": sorted(cfg.included), "missing_cluster_policy": "exclude", "wave_column": cfg.wave_column, "waves": list(cfg.waves)}
        files.write_json(a.report_json, report)
    print(f"Analysis-ready rows: {report['counts']['analysis_ready_rows']}", f"DV columns: {len(report['dv_columns'])}", f"Output CSV: {a.output_csv}", sep="\n")


#: Commands: function, its required options, optional ones; an option that ends in "+" is repeated.
COMMANDS = {
    "build-review-bundle": (build_review_bundle, ("followup-csv", "master-csv", "syntax-file+", "output-dir"), ()),
    "extract-spss-metadata": (extract_spss_metadata, ("syntax-file+", "output-dir"), ()),
    "mapping-review": (mapping_review, ("mappings-csv", "output-dir"), ()),
    "compare-columns": (compare_columns, ("followup-csv", "master-csv", "output-dir"), ()),
    "rough-merge-followup": (rough_merge_followup, ("master-csv", "followup-csv", "mappings-csv", "output-csv"), ()),
    "transform-wave": (transform_wave, ("input-csv", "master-sav", "config", "output-csv", "output-sav", "report-json"), ()),
    "validate-transform": (validate_transform, ("candidate-sav", "oracle-sav", "report-json"), ()),
    "build-linked-master": (build_linked_master, ("master-sav", "followup-sav", "crosswalk-xlsx", "output-csv", "output-sav", "report-json"), ()),
    "build-y2-master": (build_y2_master, ("input-csv", "master-sav", "crosswalk-xlsx", "oracle-sav", "config", "output-dir"), ()),
    "build-cluster-assignments": (build_cluster_assignments, ("linked-master-csv", "config", "output-csv"), ("report-json",)),
    "export-analysis-ready": (export_analysis_ready, ("linked-master-csv", "clusters-csv", "config", "output-csv"), ("report-json",)),
}


def parser() -> argparse.ArgumentParser:
    """The argument parser of all commands."""
    top = argparse.ArgumentParser(prog="panelloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    for name, (_, needed, free) in COMMANDS.items():
        p = sub.add_parser(name)
        for o in needed:
            p.add_argument("--" + o.rstrip("+"), required=True, type=Path, **({"action": "append"} if o.endswith("+") else {}))
        for o in free:
            p.add_argument("--" + o, type=Path)
        if name == "rough-merge-followup":
            p.add_argument("--master-encoding", default="latin-1")
        if name in ("transform-wave", "build-linked-master", "build-y2-master"):
            p.add_argument("--any-size", action="store_true", help="accept other numbers of rows and columns than declared")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; an error of the data or the files gives its message and 1."""
    a = parser().parse_args(argv)
    missing = [p for k, v in vars(a).items() if k.split("_")[-1] in ("csv", "sav", "xlsx", "file", "config") and not k.startswith("output") for p in (v if isinstance(v, list) else [v]) if isinstance(p, Path) and not p.is_file()]
    if missing:
        print(f"Error: no such file: {missing[0]}", file=sys.stderr)
        return 2
    spark = spark or get_spark()
    case_sensitive(spark)
    try:
        COMMANDS[a.command][0](spark, a)
    except ValueError as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
