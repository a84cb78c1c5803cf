from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st

from panelloom.plans.matching import best_matching


def brute(w, least):
    n, m = len(w), len(w[0])
    best = 0.0
    for p in permutations(range(max(n, m)), n):
        best = max(best, sum(max(0.0, w[i][j] - least) for i, j in enumerate(p) if j < m))
    return best


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(1, 4), st.data())
def test_best_matching_reaches_the_best_total(n, m, data):
    w = [[data.draw(st.sampled_from([0.0, 0.2, 0.5, 0.7, 0.9, 1.0])) for _ in range(m)] for _ in range(n)]
    pairs = best_matching(w, 0.4)
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
    assert all(w[i][j] >= 0.4 for i, j in pairs)
    assert abs(sum(w[i][j] - 0.4 for i, j in pairs) - brute(w, 0.4)) < 1e-9


def test_no_rows_or_columns():
    assert best_matching([], 0.5) == []
    assert best_matching([[], []], 0.5) == []
