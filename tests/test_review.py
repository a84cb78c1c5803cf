from datetime import datetime, timezone

from conftest import rows

from panelloom.operators import append, columns, review, syntax


def test_families(spark):
    names = ["Y0_Q1", "Q1", "Q23_1", "Q9_6_TEXT", "StartDate", "ResponseId", "Other", "Q1x", "Duration (in seconds)"]
    got = [r[0] for r in columns.header_table(spark, names).orderBy("idx").select(columns.family("name")).collect()]
    assert got == ["wave_column", "raw_survey_question", "raw_survey_question", "free_text_response", "survey_metadata", "survey_metadata", "other", "other", "survey_metadata"]


def test_comparison(spark):
    a, b = columns.header_table(spark, ["StartDate", "Q1", "Q2"]), columns.header_table(spark, ["Case", "StartDate", "Q1", "Y0_Q1", "Y1_Q1"])
    assert rows(columns.in_both(a, b), "followup_index") == [("StartDate", 1, 2, "survey_metadata"), ("Q1", 2, 3, "raw_survey_question")]
    assert rows(columns.only_in(a, b, "i")) == [("Q2", 3, "raw_survey_question")]
    assert [r[0] for r in rows(columns.only_in(b, a, "i"), "i")] == ["Case", "Y0_Q1", "Y1_Q1"]


def test_proposals(spark):
    a = columns.header_table(spark, ["Q1", "IPAddress", "RecipientEmail", "Duration (in seconds)", "BrokerPanelId", "Q7"])
    b = columns.header_table(spark, ["Y0_Q1", "Y1_Q1", "Y1_IPAddress", "RecipientEmail", "Durationinseconds", "durationInSeconds", "PSIDBrokerID", "Y2_Q7", "Y1_Q7"])
    got = [(r["followup_column"], r["proposed_target_column"], r["confidence"]) for r in columns.propose(a, b).orderBy("followup_column_index").collect()]
    assert got == [
        ("Q1", "Y2_Q1", "high"), ("IPAddress", "Y2_IPAddress", "medium"), ("RecipientEmail", "RecipientEmail", "exact_match"),
        ("Duration (in seconds)", "durationInSeconds", "loose_name_match"), ("BrokerPanelId", "", "unknown"), ("Q7", "Y2_Q7", "already_exists"),
    ]


def test_markdown_and_json():
    data = [
        {"followup_column_index": 1, "followup_column": "Q1|x\ny", "column_family": "free_text_response", "exists_exact_in_master": False, "y0_exists_in_master": "True", "y1_exists_in_master": True, "y2_exists_in_master": None, "proposed_target_column": "", "confidence": "high", "reason": None},
        {"followup_column": "b", "confidence": "unknown", "column_family": "other"},
    ]
    text = review.markdown(data)
    assert "| 1 | Q1\\|x y | free_text_response | _blank_ | exact: no, Y0: yes, Y1: yes, Y2: no |  |" in text
    assert text.count("_None._") == 5 and "- high: 1" in text
    got = review.as_json(data, "f.csv", datetime(2026, 1, 1, tzinfo=timezone.utc))
    assert (got["version"], got["summary"]["total"], got["mappings"][0]["approved"], got["generated_at"][:10]) == ("1", 2, None, "2026-01-01")


def test_statements():
    text = "VALUE LABELS Q1\n 1 'Yes. ok'\n 2 'No''s'.\n\nCOMPUTE x = 0.5 + -.5.\nrecode a (.5=1). tail"
    assert list(syntax.statements(text)) == [(1, "VALUE LABELS Q1\n 1 'Yes. ok'\n 2 'No''s'."), (5, "COMPUTE x = 0.5 + -.5."), (6, "recode a (.5=1)."), (6, "tail")]
    assert list(syntax.statements("")) == list(syntax.statements(" \n")) == []
    long = "A '" + "x." * 50_000 + "'."
    assert list(syntax.statements(long)) == [(1, long)]


def test_labels():
    assert syntax.variable_label("Variable LABELS A 'it''s a. label'.") == ("A", "it's a. label")
    assert syntax.variable_label("VARIABLE LABELS A ''.") == ("A", "")
    assert syntax.variable_label("VARIABLE LABELS A 'x' B 'y'.") is None
    assert syntax.value_labels("Value labesl B 1 'x' -1.5 'y' /C 'k' 'z'.") == [("B", "1", "x"), ("B", "-1.5", "y"), ("C", "k", "z")]
    assert syntax.value_labels("VALUE LABELS B 1 x 2 'y'.") == [("B", "2", "y")]
    assert syntax.value_labels("VALUE LABELS B.") == []
    assert syntax.value_labels("RECODE B.") is None


def test_diagnostics(spark):
    text = "VARIABLE LABELS bad.\nVALUE LABELS X.\n* comment.\nRECODE a (1=2).\nVALUE LABELS Y 1 'a'\nopen"
    files = spark.createDataFrame([(0, "f", text), (1, "g", ""), (2, "h", None)], "file_no int, source_file string, text string")
    result = syntax.parsed(files)
    assert [r["code"] for r in syntax.diagnostics(result.orderBy("position")).collect()] == ["MALFORMED_VARIABLE_LABELS", "MALFORMED_VALUE_LABELS"]
    assert rows(syntax.metadata_rows(result)) == [("f", "5", "value_label", "Y", "1", "a")]


def test_conflicts(spark):
    data = [("f", "2", "value_label", "A", "1", "x"), ("f", "10", "value_label", "A", "1", "y"), ("f", "1", "variable_label", "B", "9", "z"), ("g", None, "variable_label", "B", "", "z"), ("f", "1", "value_label", "C", "1", "x"), ("f", "1", "other", "C", "1", "x")]
    df = spark.createDataFrame(data, "source_file string, source_line string, label_type string, variable string, value string, label string")
    got = rows(syntax.conflicts(df), "label_type")
    assert [r[:2] + r[5:] for r in got] == [
        ("warning", "CONFLICTING_VALUE_LABEL", "x || y", "f:10 ; f:2", "Variable A value 1 has conflicting value labels."),
        ("info", "DUPLICATE_VARIABLE_LABEL", "z", "f:1 ; g", "Variable B has duplicate identical variable labels."),
    ]


def test_append(spark):
    master = spark.createDataFrame([("1", "old")], "Case string, Y1_Q1 string")
    follow = spark.createDataFrame([("Response ID", "B", "Name"), ('{"ImportId":"x"}', "b", "n"), ("R-123", "B-123", "Bob"), (None, None, None)], "ResponseId string, BrokerPanelId string, Name string")
    mapping = append.mapping_of([{"followup_column": "Name", "proposed_target_column": "X"}, {"followup_column": "BrokerPanelId", "proposed_target_column": ""}, {"followup_column": " Name ", "proposed_target_column": "Y1_Q1"}, {"followup_column": "", "proposed_target_column": "q"}])
    out, new = append.append(master, follow, mapping)
    assert (mapping, new, out.columns) == ({"Name": "Y1_Q1", "BrokerPanelId": "Y2_BrokerPanelId"}, ["Y2_BrokerPanelId"], ["Case", "Y1_Q1", "Y2_BrokerPanelId"])
    assert rows(out) == [("", "", ""), ("", "Bob", "B-123"), ("1", "old", "")]
