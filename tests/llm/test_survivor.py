import random
from datetime import datetime, timezone

from panelloom.llm import survivor

SCHEMA = "brokerpanelid string, responseid string, finished string, progress string, recordeddate string, q1 string, txt string, _group int"


def survive(spark, data):
    df = spark.createDataFrame([(*r, 7) for r in data], SCHEMA)
    out = survivor.survivors(df, group="brokerpanelid", record="responseid", finished="finished", progress="progress", recorded="recordeddate", fill=("q1", "txt"))
    return {r["_group"]: (r["_size"], r["responseid"], r["q1"] and tuple(r["q1"]), r["txt"] and tuple(r["txt"])) for r in out.collect()}


def test_policy_and_fill(spark):
    got = survive(
        spark,
        [
            ("A ", "r1", "1", "100%", "2026-01-02 03:04:05", " ", None),
            ("a", "r2", "yes", "100", "46024.5", "2", ""),
            ("a", "r3", "0", "100.0", "2026-05-01 00:00:00", "3", "text"),
            ("a", "r4", "?", "n/a", "####", "4", "low"),
            ("b", "r5", "1", "1", None, "1", "x"),
            (" ", "r6", "1", "1", None, "1", "x"),
            (None, "r7", "1", "1", None, "1", "x"),
            (" ", "r8", "1", "1", None, "1", "x"),
        ],
    )
    assert got == {"a": (4, "r2", ("2", "r2"), ("text", "r3"))}


def test_ties_and_nothing_filled(spark):
    got = survive(spark, [("k", "r1", "1", "50", "2026-1-2 3:4:5", None, ""), ("K", "r2", "TRUE", " 50 %", "2026-01-02T03:04:05Z", "　", None), ("k", None, "1", "50", "2026-01-02 03:04:05", None, None)])
    assert got == {"k": (3, "r2", None, None)}


def test_against_brute_force(spark):
    random.seed(3)
    data = [
        (random.choice("xyz"), f"r{i:03}", random.choice(["1", "0", "?", None]), random.choice(["100", "50", "7", ""]), random.choice(["2026-01-01 00:00:00", "2026-01-01 00:00:01", "46050", None]), random.choice(["1", "", None]), random.choice(["t", " ", None]))
        for i in range(300)
    ]
    when = {"2026-01-01 00:00:00": 1767225600, "2026-01-01 00:00:01": 1767225601, "46050": 46050 * 86400 - 2209161600, None: -(1 << 62)}
    rank = lambda r: ({"1": 1, "0": 0}.get(r[2], -1), float(r[3] or "-inf"), when[r[4]], r[1])
    for key, (n, best, q1, txt) in survive(spark, data).items():
        own = sorted((r for r in data if r[0] == key), key=rank, reverse=True)
        first = lambda i: next((r[1] for r in own if (r[i] or "").strip()), None)
        assert (n, best, q1 and q1[1], txt and txt[1]) == (len(own), own[0][1], first(5), first(6))


def test_instants(spark):
    spellings = ["2026-03-05 12:00:00", "46086.5", "2026-03-05T12:00:00Z", "2026-03-05T07:00:00-05:00", "5-Mar-2026 12:00:00", "2026-3-5 12:0:0", "2026-03-05 12:00", "2026-03-05T12:00:00.900+0000"]
    df = spark.createDataFrame([(x,) for x in spellings], "c string")
    want = int(datetime(2026, 3, 5, 12, tzinfo=timezone.utc).timestamp())
    assert [r[0] for r in df.select(survivor.recorded_second("c")).collect()] == [want] * len(spellings)
    odd = spark.createDataFrame([(x,) for x in ("", None, "####", "pending", "2026-13-45 00:00:00", "x 2026-03-05")], "c string")
    assert [r[0] for r in odd.select(survivor.recorded_second("c")).collect()] == [None] * 6


def test_without_values(spark):
    df = spark.createDataFrame([("k", "r1", "1", "50", None, "1", "x", 7), ("k", "r2", "1", "60", None, " ", "y", 7)], SCHEMA)
    out = survivor.survivors(df, group="brokerpanelid", record="responseid", finished="finished", progress="progress", recorded="recordeddate", fill=("q1", "txt"), values=False)
    assert [(tuple(r["q1"]), tuple(r["txt"])) for r in out.collect()] == [((None, "r1"), (None, "r2"))]


def test_values_of_records_delivered_again_and_of_null_ids(spark):
    got = survive(spark, [("k", "r1", "1", "50", None, "1", "old"), ("k", "r1", "1", "60", None, " ", "x"), ("k", "r1", "1", "60", None, " ", "y"), ("n", None, "1", "1", None, "5", None), ("n", None, "0", "1", None, "6", "low")])
    assert got == {"k": (3, "r1", ("1", "r1"), ("y", "r1")), "n": (2, None, ("5", None), ("low", None))}


def test_empty(spark):
    assert survive(spark, [("a", "r", "1", "1", "", "", "")]) == {}
