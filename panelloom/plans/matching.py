"""Maximum-weight bipartite matching for small matrices (columns of two schemas)."""

from __future__ import annotations

from collections.abc import Sequence


def best_matching(weights: Sequence[Sequence[float]], least: float) -> list[tuple[int, int]]:
    """Pairs (row, column) of the matching with the largest total of (weight - least); pairs under `least` stay out.

    The Hungarian method with potentials over a square matrix padded with zeros; O(n^3) for n columns of a schema.
    Ties go to the lower row and column.
    """
    rows, cols = len(weights), max((len(w) for w in weights), default=0)
    n = max(rows, cols)
    if not n or not cols:
        return []
    gain = [[0.0] * n for _ in range(n)]
    for i, line in enumerate(weights):
        for j, w in enumerate(line):
            gain[i][j] = max(0.0, w - least)
    # Shortest augmenting paths on costs -gain, with a virtual column 0.
    u, v, owner = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        slack, seen, back = [float("inf")] * (n + 1), [False] * (n + 1), [0] * (n + 1)
        while owner[at]:
            seen[at] = True
            row, step, nxt = owner[at], float("inf"), 0
            for j in range(1, n + 1):
                if seen[j]:
                    continue
                reduced = -gain[row - 1][j - 1] - u[row] - v[j]
                if reduced < slack[j] - 1e-12:
                    slack[j], back[j] = reduced, at
                if slack[j] < step - 1e-12:
                    step, nxt = slack[j], j
            for j in range(n + 1):
                if seen[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    slack[j] -= step
            at = nxt
        while at:
            owner[at] = owner[back[at]]
            at = back[at]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, n + 1)]
    return sorted((i, j) for i, j in pairs if i < rows and j < len(weights[i]) and weights[i][j] >= least)
