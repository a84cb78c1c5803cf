import pytest
from conftest import rows

from panelloom.operators import link


def followup(spark, *data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "BrokerPanelId string, Finished double, Progress double, RecordedDate double, ResponseId string, Q1 double, _ord long")


def crosswalk(spark, *data):
    return spark.createDataFrame(list(data), "`ID March 2026` string, HIDBrokerPanelId string, `ORIGINAL ID` string")


def master(spark, *data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "PSIDBrokerID string, Base double, _ord long")


FOLLOW = [("current-1", 0.0, 50.0, 1.0, "drop", 1.0), ("current-1", 1.0, 100.0, 2.0, "linked", 2.0), ("current-2", 1.0, 100.0, 3.0, "new", 3.0)]


def test_link_and_append(spark):
    m = master(spark, ("original-1", 10.0), ("original-2", 20.0))
    out, decisions, statuses = link.link(m, followup(spark, *FOLLOW), crosswalk(spark, ("current-1", "hid-1", "original-1")), ordinal="_ord")
    got = link.ordered(out).collect()
    assert [(r["PSIDBrokerID"], r["Base"], r["Y2_ResponseId"], r["Y2_Q1"], r["linked_merge_record_source"]) for r in got] == [
        ("original-1", 10.0, "linked", 2.0, "existing_master"),
        ("original-2", 20.0, None, None, "existing_master"),
        (None, None, "new", 3.0, "y2_only_appended"),
    ]
    assert rows(statuses) == [("linked_existing_master", 1), ("no_crosswalk", 1)]
    assert rows(decisions.select("kept_response_id", "dropped_response_id")) == [("linked", "drop")]
    assert link.preserved(m, out, "_ord") == 0
    link.check_linked(out)


def test_original_missing_in_the_master(spark):
    out, _, statuses = link.link(master(spark, ("x", 1.0)), followup(spark, FOLLOW[2]), crosswalk(spark, ("CURRENT-2 ", "h", "Gone")), ordinal="_ord")
    assert rows(statuses) == [("crosswalk_original_missing_master", 1)]
    assert [r["PSIDBrokerID"] for r in link.ordered(out).collect()] == ["x", "Gone"]


def test_ties_go_to_the_later_row_and_unreadable_ranks_last(spark):
    f = spark.createDataFrame([("A", "1", "x", None, "r", 0), (" a", "1", "", "", "r", 1), ("a", "0", "99", "9", "z", 2)], "BrokerPanelId string, Finished string, Progress string, RecordedDate string, ResponseId string, _ord long")
    kept, decisions = link.deduplicate(f, "_ord")
    assert rows(kept.select("_ord", "_current_id")) == [(1, "a")]
    assert decisions.count() == 2


@pytest.mark.parametrize(
    ("data", "message"),
    [((("a", "h", "o"), ("a", "i", "p")), "duplicated"), ((("", "h", "o"),), "blank"), ((("current-1", "h", "o"), ("Current-1", "i", "p")), "several rows")],
)
def test_bad_crosswalks(spark, data, message):
    with pytest.raises(ValueError, match=message):
        link.link(master(spark, ("o", 1.0)), followup(spark, *FOLLOW), crosswalk(spark, *data), ordinal="_ord")


def test_duplicated_master_keys(spark):
    cross = crosswalk(spark, ("current-1", "h", "o"))
    with pytest.raises(ValueError, match="duplicated master IDs: o"):
        link.link(master(spark, ("o", 1.0), ("O ", 2.0)), followup(spark, *FOLLOW), cross, ordinal="_ord")
    out, _, _ = link.link(master(spark, ("q", 1.0), ("q", 2.0), ("", 3.0), (None, 4.0)), followup(spark, *FOLLOW), cross, ordinal="_ord")
    assert out.count() == 6


def test_blank_and_missing_columns(spark):
    with pytest.raises(ValueError, match="blank BrokerPanelId"):
        link.require_followup(followup(spark, (" ", 1.0, 1.0, 1.0, "r", 1.0)))
    with pytest.raises(ValueError, match="missing columns: Finished"):
        link.require_followup(followup(spark, *FOLLOW).drop("Finished"))
    with pytest.raises(ValueError, match="64"):
        link.target_names(["x" * 62], [])
    with pytest.raises(ValueError, match="exist"):
        link.target_names(["x"], ["Y2_x"])


def test_a_person_of_half_the_rows(spark):
    data = [("A" if i % 2 else f"p{i}", 1.0, float(i % 10), float(i % 7), f"r{i:03}", 1.0) for i in range(200)]
    f = followup(spark, *data)
    kept, decisions = link.deduplicate(f, "_ord")
    best = max((r for r in data if r[0] == "A"), key=lambda r: r[1:5])
    assert kept.count() == 101 and [r["ResponseId"] for r in kept.where("_current_id = 'a'").collect()] == [best[4]]
    assert decisions.count() == 99 and {r["kept_response_id"] for r in decisions.collect()} == {best[4]}
    order = [r["dropped_response_id"] for r in decisions.orderBy("_current_id", "_ranking").collect()]
    assert order == [r[4] for r in sorted((r for r in data if r[0] == "A"), key=lambda r: r[1:5])][:-1]
    assert "Window" not in decisions._jdf.queryExecution().toString()


def test_equal_rows_without_an_ordinal(spark):
    f = spark.createDataFrame([("a", 1.0, 1.0, 1.0, "r")] * 3 + [("b", 1.0, 1.0, 1.0, "s")], "BrokerPanelId string, Finished double, Progress double, RecordedDate double, ResponseId string")
    kept, decisions = link.deduplicate(f)
    assert (kept.count(), rows(decisions.select("kept_response_id", "dropped_response_id"))) == (2, [("r", "r"), ("r", "r")])
