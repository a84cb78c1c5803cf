import random
import time
from itertools import product

import pytest
from pyspark.sql import functions as F

from panelloom.llm import mixing


def best(patterns, quotas, repeats):
    """(tokens placed, cost) of the best routing, by trying all whole amounts of tiny inputs."""
    edges = [(p, k, s) for p in patterns for s in p for k in range(1, repeats[s] + 1)]
    top = (-1, 0)
    for amounts in product(*[range(patterns[p] + 1) for p, _, _ in edges]):
        by_use, by_source = {}, {}
        for (p, k, s), x in zip(edges, amounts, strict=True):
            by_use[p, k] = by_use.get((p, k), 0) + x
            by_source[s] = by_source.get(s, 0) + x
        if all(x <= patterns[p] for (p, _), x in by_use.items()) and all(x <= quotas[s] for s, x in by_source.items()):
            top = max(top, (sum(amounts), -sum(x * (k - 1) for (_, k, _), x in zip(edges, amounts, strict=True))))
    return top


def test_flow_is_the_cheapest_that_places_most():
    random.seed(4)
    for _ in range(25):
        patterns = {("a",): random.randint(0, 2), ("a", "b"): random.randint(1, 3)}
        quotas, repeats = {"a": random.randint(0, 5), "b": random.randint(0, 4)}, {"a": random.randint(1, 2), "b": 1}
        flows = mixing.route(patterns, quotas, repeats)
        assert (sum(f[3] for f in flows), -sum(f[3] * (f[1] - 1) for f in flows)) == best(patterns, quotas, repeats)


def test_flow_of_three_sources():
    """Tokens move on from a source to another one so that a third is filled."""
    random.seed(6)
    for _ in range(12):
        patterns = {("a", "b"): random.randint(1, 2), ("b", "c"): random.randint(1, 2), ("a",): random.randint(0, 1)}
        quotas, repeats = {"a": random.randint(0, 3), "b": random.randint(0, 2), "c": random.randint(0, 3)}, {"a": 1, "b": 1, "c": random.randint(1, 2)}
        flows = mixing.route(patterns, quotas, repeats)
        assert (sum(f[3] for f in flows), -sum(f[3] * (f[1] - 1) for f in flows)) == best(patterns, quotas, repeats)
        assert all(s in p and k <= repeats[s] for p, k, s, _ in flows)


def test_flow_of_many_patterns():
    rng = random.Random(8)
    names = [f"s{i:02}" for i in range(24)]
    patterns = {tuple(sorted(rng.sample(names, rng.randint(1, 6)))): rng.randint(1, 10**6) for _ in range(20_000)}
    total = sum(patterns.values())
    quotas = {s: int(total * w) for s, w in zip(names, (0.3, 0.2, *[0.5 / 22] * 22), strict=True)}
    repeats = {s: 1 + i % 4 for i, s in enumerate(names)}
    began = time.perf_counter()
    flows = mixing.route(patterns, quotas, repeats)
    assert time.perf_counter() - began < 10
    got, used = dict.fromkeys(names, 0), {}
    for p, k, s, n in flows:
        assert s in p and k <= repeats[s]
        got[s] += n
        used[p, k] = used.get((p, k), 0) + n
    assert all(got[s] <= quotas[s] for s in names) and all(n <= patterns[p] for (p, _), n in used.items())
    assert [s for s in names[1:] if got[s] < quotas[s]] == []


SIZED = "doc_id bigint, sources array<string>, tokens bigint"


def run(spark, sized, targets):
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    sel, shares = mixing.mix(spark.createDataFrame(sized, SIZED), t)
    return sel.collect(), {r["source"]: r for r in shares.collect()}


def test_shares_repeats_and_shortfalls(spark):
    sized = [(i, ["big"], 10) for i in range(800)] + [(1000 + i, ["small"], 10) for i in range(50)] + [(2000 + i, ["tiny"], 5) for i in range(4)] + [(3000, None, 130), (3001, ["other"], 50), (3002, ["big"], 0), (3003, ["big"], None)]
    sel, shares = run(spark, sized, [("big", 0.7, 1), ("small", 0.2, 4), ("tiny", 0.05, 3), ("absent", 0.05, 9)])
    total = 8000 + 500 + 20 + 180
    assert abs(shares["big"]["selected_tokens"] - 0.7 * total) <= 10 and abs(shares["small"]["selected_tokens"] - 0.2 * total) <= 20
    assert (shares["tiny"]["selected_tokens"], shares["tiny"]["shortfall_tokens"]) == (60, round(0.05 * total) - 60)
    assert (shares["absent"]["available_tokens"], shares["absent"]["selected_tokens"], shares["absent"]["reached_share"]) == (0, 0, 0.0)
    uses = {r["doc_id"]: r["uses"] for r in sel}
    assert max(uses[i] for i in uses if i < 1000) == 1 and {uses[i] for i in range(1000, 1050)} <= {3, 4} and set(uses) <= set(range(800)) | set(range(1000, 1050)) | set(range(2000, 2004))
    assert sum(r["uses"] * r["tokens"] for r in sel if r["source"] == "big") == shares["big"]["selected_tokens"]


def test_overlapping_sources_share_a_document_once(spark):
    sized = [(i, ["a", "b"], 10) for i in range(100)]
    sel, shares = run(spark, sized, [("a", 0.5, 1), ("b", 0.5, 1)])
    assert len({r["doc_id"] for r in sel}) == len(sel) == 100
    assert shares["a"]["selected_tokens"] == shares["b"]["selected_tokens"] == 500


def test_same_seed_same_selection_and_clashing_columns(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit(1).alias("tokens"), F.lit(2).alias("uses"))
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    one, two = (sorted(map(tuple, mixing.mix_documents(df, t)[0].collect())) for _ in range(2))
    assert one == two and one


@pytest.mark.parametrize("targets", [[], [(None, 0.5, 1)], [("a", None, None)], [("a", -1.0, -1)]])
def test_empty_and_null_targets(spark, targets):
    sel, _ = run(spark, [(1, ["a"], 5)], targets)
    assert sel == []


def test_no_documents(spark):
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    sel, shares = mixing.mix(spark.createDataFrame([], SIZED), t)
    assert sel.count() == 0 and shares.first()["selected_tokens"] == 0
