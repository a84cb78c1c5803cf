from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from panelloom.operators import orphans
from panelloom.operators.orphans import Reference, plain_key
from panelloom.plans import skew


def day(n):
    return datetime(2025, 1, n) if n else None


def reference(spark, child, parent):
    c = spark.createDataFrame([(i, k, day(t), "x") for i, (k, t) in enumerate(child)], "row_id bigint, fk string, at timestamp_ntz, kind string")
    p = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in parent], "pk string, loaded timestamp_ntz, removed timestamp_ntz")
    return Reference("t", "fk", c, "row_id", plain_key("fk", fold=True), F.col("at"), p, plain_key("pk", fold=True), F.col("loaded"), F.col("removed"))


def test_kinds(spark):
    child = [("A ", 5), ("b", 5), ("c", 5), ("d", 5), ("d", 9), (" ", 5), (None, 5), ("zz", None), ("d", None), ("e", 5)]
    parent = [("a", 4, None), ("B", 1, 2), ("b", 3, 4), ("D　", 7, None), (None, 1, None), ("", 1, None), ("e", 9, None), ("e", 1, 2)]
    got = rows(orphans.orphan_rows([reference(spark, child, parent)]).select("row_id", "kind", "period_month"))
    assert got == [(1, "deleted", "2025-01"), (2, "missing", "2025-01"), (3, "late", "2025-01"), (7, "missing", None), (9, "late", "2025-01")]


def test_hot_key_and_counts(spark):
    child = [("hot", 5)] * 300 + [(f"k{i}", 5) for i in range(200)]
    ref = reference(spark, child, [(f"k{i}", 1, None) for i in range(100)])
    assert rows(orphans.orphan_counts([ref, ref])) == [("t", "fk", "missing", "2025-01", 800)]


def test_empty(spark):
    ref = reference(spark, [("a", 1)], [("a", 1, None)])
    assert orphans.orphan_rows([ref]).count() == 0
    empty = Reference(**{**ref.__dict__, "rows": ref.rows.limit(0), "parents": ref.parents.limit(0)})
    assert orphans.orphan_rows([empty]).count() == 0
    bare = Reference(**{**ref.__dict__, "parents": ref.parents.limit(0)})
    assert rows(orphans.orphan_rows([bare]).select("kind")) == [("missing",)]


def test_lookups_agree_with_a_plain_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(100)] + [(None, 1)], "k string, v int")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(50)], "k string, w int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = rows(left.join(right, "k", how))
        assert rows(skew.lookup(left, right, ["k"], how)) == want
        assert rows(skew.checked_lookup(left, right, ["k"], how, most=10)) == want
        assert rows(skew.checked_lookup(left, right, ["k"], how)) == want
    assert rows(skew.hot_keys(left, ["k"])) == [("hot",)]
