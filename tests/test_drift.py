import json
from datetime import datetime

from conftest import rows

from panelloom.operators import drift

SCHEMA = "record_id bigint, feed string, file_id bigint, exported_at timestamp_ntz, payload string, extra string"


def files(spark, *contents):
    """contents: (feed, day, list of payload dicts)."""
    data, n = [], 0
    for file_id, (feed, day, payloads) in enumerate(contents, start=1):
        for p in payloads:
            data.append((n, feed, file_id, datetime(2025, 1, day), p if isinstance(p, str) or p is None else json.dumps(p), "x"))
            n += 1
    return spark.createDataFrame(data, SCHEMA)


def base(i, **more):
    return {"name": f"Q{i}", "flag": i % 3 == 0, "conf": ["high", "low", "none"][i % 3]} | more


def test_each_kind_of_change(spark):
    one = [base(i, old=f"v{i}", gone=i, num=i) for i in range(12)]
    two = [{"name": f"Q{i}", "flag": i % 3 == 0, "certainty": ["high", "low", "none"][i % 3], "old": f"v{i}", "num": str(i), "fresh": f"w{i * 7}"} for i in range(12)]
    got = rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, two))))
    assert got == [(2, "", "fresh", "added"), (2, "conf", "certainty", "renamed"), (2, "gone", "", "removed"), (2, "num", "num", "type_changed")]


def test_same_type_but_other_values_is_no_rename(spark):
    one = [base(i, flag2=i % 2 == 0) for i in range(20)]
    two = [base(i, approved=(i // 2) % 2 == 0) for i in range(20)]
    assert rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, two)))) == [(2, "", "approved", "added"), (2, "flag2", "", "removed")]


def test_rename_with_another_type_is_two_changes(spark):
    one, two = [base(i, n=i) for i in range(9)], [base(i, m=str(i)) for i in range(9)]
    assert rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, two)))) == [(2, "", "m", "added"), (2, "n", "", "removed")]


def test_order_feeds_and_days(spark):
    three = [base(i) for i in range(5)], [base(i, x=i) for i in range(5)], [base(i) for i in range(5)]
    df = files(spark, ("a", 3, three[2]), ("a", 1, three[0]), ("a", 2, three[1]), ("b", 1, three[1]), (None, 4, three[0]))
    assert rows(drift.schema_changes(df)) == [(1, "x", "", "removed"), (3, "", "x", "added")]
    near = drift.neighbours(drift.schemas(df.na.fill("", ["feed"])))
    assert rows(near.select("feed", "file_id", "prev_file")) == [("a", 1, 3), ("a", 3, 2)]


def test_integers_and_decimals_are_told_apart(spark):
    df = files(spark, ("a", 1, ['{"k":"a","n":1}', '{"k":"b","n":2}']), ("a", 2, ['{"k":"a","n":1.0}', '{"k":"b","n":2.0}']))
    assert rows(drift.schema_changes(df)) == [(2, "n", "n", "type_changed")]


def test_nulls_bad_payloads_and_empty_tables(spark):
    df = files(spark, ("a", 1, [base(1), None, "broken", "[1]", '"t"', base(1)]), ("a", 2, [base(1, n=None), "{}"]))
    assert rows(drift.schema_changes(df)) == [(2, "", "n", "added")]
    assert drift.schema_changes(df.limit(0)).count() == 0


def test_unify(spark):
    layout = spark.createDataFrame([(i, f"Q{i}", ["high", "low", "none"][i % 3], i % 3 == 0) for i in range(12)], "idx int, name string, confidence string, in_master boolean")
    a = [{"idx": i, "name": f"Q{i}", "confidence": ["high", "low", "none"][i % 3], "in_master": True} for i in range(6)]
    b = [{"position": float(i), "fu": [f"Q{i}"], "match_level": ["high", "low", "none"][i % 3], "inMaster": 1, "owner": "me"} for i in range(6)]
    got = drift.unify(files(spark, ("a", 1, a), ("a", 2, b)), layout).orderBy("record_id").collect()
    assert [tuple(r)[3:] for r in got[6:8]] == [(0, "Q0", "high", True, '{"owner":"me"}'), (1, "Q1", "low", True, '{"owner":"me"}')]
    assert [r["name"] for r in got[:6]] == [f"Q{i}" for i in range(6)]


def test_unify_keeps_the_rest_of_lists_and_objects(spark):
    layout = spark.createDataFrame(
        [(i, f"Q{i}", ["raw", "meta"][i % 2], ["high", "low", "none"][i % 3], f"because {i}") for i in range(12)], "idx int, followup_column string, column_family string, confidence string, reason string"
    )
    a = [{"idx": i, "followup_column": {"name": f"Q{i}", "family": ["raw", "meta"][i % 2]}, "reason": [f"because {i}", ["high", "low", "none"][i % 3]]} for i in range(6)]
    b = [{"idx": i, "followup_column": f"Q{i}", "column_family": ["a", "b"], "confidence": {"label": "high", "score": 0.95}, "reason": ["because 1", "unheard of", "low"]} for i in range(6)]
    c = [{"idx": "n/a", "followup_column": {"name": f"Q{i}", "family": "raw"}, "column_family": "meta", "confidence": "low", "reason": []} for i in range(6)]
    got = [tuple(r)[3:] for r in drift.unify(files(spark, ("a", 1, a), ("a", 2, b), ("b", 1, c)), layout).orderBy("record_id").collect()]
    assert got[1] == (1, "Q1", "meta", "low", "because 1", "{}")
    assert got[6][:5] == (0, "Q0", "a_b", "high", "because 1")
    assert {k: json.loads(v) for k, v in json.loads(got[6][5]).items()} == {"confidence": {"score": "0.95"}, "reason": ["unheard of", "low"]}
    assert got[12][:5] == (None, "Q0", "meta", "low", None)
    assert json.loads(got[12][5]) == {"idx": "n/a", "followup_column": '{"family":"raw"}'}


def test_changes_of_null_feeds_and_of_files_without_fields(spark):
    old, new = [base(i, conf=f"{i}c") for i in range(9)], [base(i, conf=f"{i}c", x=i) | {"q": f"{i}"} for i in range(9)]
    names = ("conf", "flag", "name")
    df = files(spark, (None, 1, old), (None, 2, new), ("a", 1, old), ("a", 2, ["{}", "broken"]), ("a", 3, old), ("b", 1, ["{}"]), ("b", 2, [None]))
    want = [(2, "", "q", "added"), (2, "", "x", "added"), *[(4, n, "", "removed") for n in names], *[(5, "", n, "added") for n in names]]
    assert rows(drift.schema_changes(df)) == sorted(want)
    one = [base(i, was=f"v{i}", conf=f"{i}c") for i in range(9)]
    two = [base(i, now=f"v{i}", conf=f"{i}c") for i in range(9)]
    assert rows(drift.schema_changes(files(spark, (None, 1, one), (None, 2, two)))) == [(2, "was", "now", "renamed")]


def test_unify_of_a_null_feed(spark):
    layout = spark.createDataFrame([(i, f"Q{i}") for i in range(12)], "idx int, name string")
    got = drift.unify(files(spark, (None, 1, [{"idx": 3, "name": "Q3"}])), layout).collect()
    assert [tuple(r)[3:] for r in got] == [(3, "Q3", "{}")]


def test_names_with_any_signs(spark):
    odd = ("it's", "a.b", "x['y']", "$", "*", 'say "x"', "")
    one = [{n: f"{k}-{i}" for k, n in enumerate(odd)} | {"old's": f"v{i}"} for i in range(9)]
    two = [{n: f"{k}-{i}" for k, n in enumerate(odd)} | {"new.[0]": f"v{i}"} for i in range(9)]
    df = files(spark, ("a", 1, one), ("a", 2, two))
    assert rows(drift.schema_changes(df)) == [(2, "old's", "new.[0]", "renamed")]
    layout = spark.createDataFrame([(f"0-{i}", f"v{i}") for i in range(9)], "`it's` string, other string")
    got = [r.asDict() for r in drift.unify(df, layout).where("file_id = 2").collect()]
    assert {(r["it's"], r["other"]) for r in got} == {(f"0-{i}", f"v{i}") for i in range(9)}
    assert set(json.loads(got[0]["extras"])) == set(odd) - {"it's"}


def test_renames_of_long_files(spark):
    """Beyond 4,096 rows the sketches estimate: a rename is found, a field of other values isn't taken for one."""
    one = [{"key": f"k{i}", "n": i % 7, "a": f"a{i * 7919 % 5000}", "b": f"b{i % 50}"} for i in range(10_000)]
    two = [{"key": f"k{i}", "n": i % 7, "aa": f"a{i * 7919 % 5000}", "c": f"b{(i // 3) % 50}"} for i in range(500, 10_500)]
    assert rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, two)))) == [(2, "", "c", "added"), (2, "a", "aa", "renamed"), (2, "b", "", "removed")]


def test_renames_beside_keys_that_change_their_form(spark):
    """All fields that identify rows become objects or lists; their parts still identify rows."""
    one = [{"key": f"k{i}", "flag": i % 3 == 0, "conf": ["high", "low", "none"][i % 3], "level": ["low", "none", "high"][i // 4]} for i in range(12)]
    two = [{"key": {"id": f"k{i}", "kind": "q"}, "flag": i % 3 == 0, "certainty": ["high", "low", "none"][i % 3], "grade": ["low", "none", "high"][i // 4]} for i in range(12)]
    changes = [(2, "conf", "certainty", "renamed"), (2, "key", "key", "type_changed"), (2, "level", "grade", "renamed")]
    assert rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, two)))) == changes
    listed = [r | {"key": [f"k{i}", "q"]} for i, r in enumerate(two)]
    assert rows(drift.schema_changes(files(spark, ("a", 1, one), ("a", 2, listed)))) == changes
