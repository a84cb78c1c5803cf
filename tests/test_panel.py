import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.operators import clusters, panel

CONFIG = {
    "schema_version": 2,
    "respondent_id_source_columns": ["Member", "Reply"],
    "cluster_source_column": "segment",
    "cluster_labels": {"1": "One", "2": "Two", "3": "Three", "6": "Six"},
    "included_cluster_codes": ["1", "2", "3"],
    "missing_cluster_policy": "exclude",
    "waves": {"Spring": {"prefix": "s_"}, "Summer": {"prefix": "u_"}, "Fall": {"prefix": "f_"}},
    "exclude_stems": ["Reply"],
}
CFG = clusters.read_config(CONFIG)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"schema_version": 1}, "schema_version"),
        ({"respondent_id_source_columns": []}, "respondent_id_source_columns"),
        ({"respondent_id_source_columns": None, "respondent_id_source_column": " "}, "respondent_id"),
        ({"cluster_labels": {}}, "cluster_labels"),
        ({"cluster_labels": {"1": "One ", "2": "b", "3": "c"}}, "white space"),
        ({"cluster_labels": {"1": "a", "1.0": "b"}}, "duplicated after"),
        ({"cluster_labels": {"1": "a", "2": "a", "3": "c"}}, "same label"),
        ({"included_cluster_codes": ["1", "1.0"]}, "duplicates"),
        ({"included_cluster_codes": ["9"]}, "no label"),
        ({"missing_cluster_policy": "keep"}, "missing_cluster_policy"),
        ({"waves": {}}, "waves"),
        ({"waves": {"a": {"prefix": "x"}, "b": {"prefix": "x"}}}, "duplicated"),
        ({"waves": {"a": {}}}, "prefix"),
        ({"exclude_stems": [""]}, "exclude_stems"),
        ({"wave_column": "cluster_code"}, "distinct"),
        ({"wave_column": "_cluster_source_code"}, "reserved"),
    ],
)
def test_bad_configs(change, message):
    with pytest.raises(ValueError, match=message):
        clusters.read_config(json.loads(json.dumps(CONFIG | change)))


def marked(spark, *data):
    return clusters.identified(spark.createDataFrame(list(data), "Member string, Reply string, segment string"), CFG)


def test_assignments(spark):
    m = marked(spark, ("P1", "R1", "1.0"), ("", "R2", "2"), ("P3", "R3", "6.0"), ("P4", "R4", ""), ("", "", "1"))
    clusters.check_codes(m, CFG)
    assert rows(clusters.assignments(m, CFG)) == [("P1", "1", "One"), ("R2", "2", "Two")]
    counts = clusters.assignment_counts(m, CFG)
    assert counts["included_rows_missing_respondent_id"] == counts["blank_cluster_code_rows"] == 1
    assert counts["excluded_cluster_code_counts"] == {"6": 1}
    assert counts["included_respondent_id_source_counts"] == {"Member": 1, "Reply": 1}


def test_code_checks(spark):
    with pytest.raises(ValueError, match="conflicting cluster codes.*R1"):
        clusters.check_codes(marked(spark, (None, "R1", "1"), (None, "R1", "6")), CFG)
    with pytest.raises(ValueError, match="conflicting"):
        clusters.check_codes(marked(spark, (None, "R1", "1"), (None, "R1", "")), CFG)
    with pytest.raises(ValueError, match="unknown codes: 9"):
        clusters.check_codes(marked(spark, (None, "R1", "9")), CFG)


def wide(spark):
    data = [("P1", "1", "1.2345678901234567", "", "3", "a", "b", "c"), ("P2", "2", "5", "-6", "7", "", "", ""), ("P3", "3", "", "", "9", "x", "", ""), ("P4", "3", "8", "", "", "", "", "y")]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "Member string, segment string, s_score string, u_score string, f_score string, s_notes string, u_notes string, f_notes string, _ord long").withColumn("Reply", F.lit(""))


def assigned(spark, *data):
    return spark.createDataFrame(list(data), "respondent_id string, cluster_code string, cluster_label string")


def test_export(spark):
    out, report = panel.export(wide(spark), assigned(spark, ("P1", "1", "One"), ("P2", "2.0", "Two"), ("P3", "3", "Three"), ("P4", "3", "Three")), CFG, ordinal="_ord")
    assert report["counts"]["wave_counts"] == {"Spring": 3, "Summer": 1, "Fall": 3}
    assert (report["dv_columns"], report["excluded_non_numeric_stems"]) == (["score"], ["notes"])
    got = [tuple(r)[:5] for r in out.orderBy("_wave", "_order").collect()]
    assert got[0] == ("P1", "1", "One", "Spring", 1.2345678901234567) and got[-1] == ("P3", "3", "Three", "Fall", 9.0)


def test_exclusions(spark):
    data = [(f"P{i}", c, "1", "2", "3", i) for i, c in enumerate(["1", "2", "6", ""], start=1)]
    df = spark.createDataFrame(data, "Member string, segment string, s_a string, u_a string, f_a string, _ord long").withColumn("Reply", F.lit(""))
    _, report = panel.export(df, assigned(spark, ("P1", "1", "One")), CFG, ordinal="_ord")
    c = report["counts"]
    assert (c["analysis_eligible_respondents_before_cluster_filter"], c["excluded_unclustered_rows"], c["excluded_unclustered_respondents"], c["analysis_ready_rows"]) == (4, 9, 3, 3)
    assert [(c[f"excluded_{k}_rows"], c[f"excluded_{k}_respondents"]) for k in ("blank_cluster", "cluster_code", "missing_cluster_assignment")] == [(3, 1)] * 3
    assert (c["excluded_cluster_code_row_counts"], c["excluded_cluster_code_respondent_counts"]) == ({"6": 3}, {"6": 1})


@pytest.mark.parametrize(
    ("given", "message"),
    [
        ([("P1", "1", "Wrong")], "don't match the config"),
        ([("P1", "2", "Two")], "P1:2!=1"),
        ([("P1", "1", "One"), ("P1 ", "1", "One")], "duplicate respondents: P1"),
        ([("P1", "6", "Six")], "excluded or unknown codes: 6"),
        ([("P9", "1", "One")], "aren't in the linked master: P9"),
        ([("", "1", "One")], "blank respondent_id"),
    ],
)
def test_export_rejections(spark, given, message):
    with pytest.raises(ValueError, match=message):
        panel.export(wide(spark), assigned(spark, *given), CFG, ordinal="_ord")


def test_export_without_values_or_with_clashes(spark):
    with pytest.raises(ValueError, match="No numeric"):
        panel.export(wide(spark).drop("s_score", "u_score", "f_score"), assigned(spark, ("P1", "1", "One")), CFG, ordinal="_ord")
    with pytest.raises(ValueError, match="conflict"):
        panel.export(wide(spark).withColumn("s_wave", F.lit("1")), assigned(spark, ("P1", "1", "One")), CFG, ordinal="_ord")


def test_blank_columns_are_numeric_and_nan_is_not(spark):
    df = spark.createDataFrame([("", "nan", "inf"), (" ", "1", "2")], "s_a string, s_b string, s_c string")
    good, bad = panel.numeric_stems(df, {"Spring": "s_"})
    assert (list(good), bad) == (["a", "c"], ["b"])
