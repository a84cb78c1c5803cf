"""Mixing sources to target weights.

Documents are aggregated by membership pattern (the set of sources that hold them). A min-cost flow routes the patterns'
tokens to the sources' quotas; each further use of a pattern costs more than the one before, so a document is repeated
only where a quota needs it. The flow's amounts are then cut from each pattern's documents in a seeded order.
"""

from __future__ import annotations

import itertools
from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.tokens import TOKENIZERS, VOCABULARY, token_counts
from panelloom.plans.skew import checked_lookup
from panelloom.session import shared_checkpoints

#: Buckets of the seeded order per pattern: positions are exact, and no task sees more than a bucket of a pattern.
BUCKETS = 1 << 14


def _first(amounts: np.ndarray, most: int) -> np.ndarray:
    """The amounts from the first on, up to `most` in all."""
    before = np.cumsum(amounts) - amounts
    return np.clip(most - before, 0, amounts)


class Routes:
    """Flow from uses of patterns to sources: a row per use of a pattern, a column per source, whole tokens.

    Only the sources are nodes of the residual graph: a step from one to another moves tokens that came from any rows
    that both admit, so its room is one sum over the rows, and a search costs the square of the number of sources,
    however many patterns there are.
    """

    def __init__(self, quotas: list[int]):
        n = len(quotas)
        self.spare = np.array(quotas, dtype=np.int64)
        self.admits, self.flow = np.zeros((0, n), dtype=bool), np.zeros((0, n), dtype=np.int64)
        self.room = np.zeros((n, n), dtype=np.int64)

    def offer(self, admits: np.ndarray, tokens: np.ndarray) -> None:
        """Send what can be sent of further rows' tokens; earlier rows keep their totals."""
        begin = len(self.admits)
        self.admits = np.concatenate([self.admits, admits])
        self.flow = np.concatenate([self.flow, np.zeros(admits.shape, dtype=np.int64)])
        left = tokens.astype(np.int64)
        while (path := self._path(left, admits)) is not None:
            steps = list(itertools.pairwise(path))
            open_rows = left * admits[:, path[0]]
            most = int(min([open_rows.sum(), self.spare[path[-1]], *(self.room[a, b] for a, b in steps)]))
            for a, b in steps:
                self._move(slice(None), a, b, _first(self.flow[:, a] * self.admits[:, b], most))
            taken = _first(open_rows, most)
            left -= taken
            self.flow[begin:, path[0]] += taken
            self.room[path[0]] += taken @ admits
            self.spare[path[-1]] -= most

    def _move(self, rows: slice, a: int, b: int, amount: np.ndarray) -> None:
        self.flow[rows, a] -= amount
        self.flow[rows, b] += amount
        change = amount @ self.admits[rows]
        self.room[a] -= change
        self.room[b] += change

    def _path(self, left: np.ndarray, admits: np.ndarray) -> list[int] | None:
        """The shortest way from rows with tokens left to a source with spare quota, as sources."""
        starts = np.flatnonzero(left @ admits).tolist()
        back: dict[int, int | None] = dict.fromkeys(starts)
        queue = deque(starts)
        while queue:
            at = queue.popleft()
            if self.spare[at] > 0:
                path: list[int] = []
                node: int | None = at
                while node is not None:
                    path.append(node)
                    node = back[node]
                return path[::-1]
            for to in np.flatnonzero(self.room[at] > 0).tolist():
                if to not in back:
                    back[to] = at
                    queue.append(to)
        return None


def route(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: dict[str, int]) -> list[tuple[tuple[str, ...], int, str, int]]:
    """(pattern, use, source, tokens) of the cheapest flow that fills the quotas as far as possible.

    The k-th use of a pattern has its tokens as room and costs k - 1; a source takes at most its max_repeats uses. The
    costs lie on the uses only, so the cheapest largest flow comes by offering the first uses, then the second ones, and
    so on, each by shortest augmenting paths that leave the totals of the uses before as they are.
    """
    names = sorted(quotas)
    place = {s: i for i, s in enumerate(names)}
    keys = sorted(p for p in patterns if patterns[p] > 0 and p)
    admits = np.zeros((len(keys), len(names)), dtype=bool)
    for i, p in enumerate(keys):
        admits[i, [place[s] for s in p]] = True
    limits = np.array([repeats[s] for s in names], dtype=np.int64)
    tokens = np.array([patterns[p] for p in keys], dtype=np.int64)
    g = Routes([max(0, quotas[s]) for s in names])
    owners: list[tuple[int, int]] = []
    for k in range(1, int(limits.max(initial=0)) + 1):
        allowed = admits & (limits >= k)
        rows = np.flatnonzero(allowed.any(1))
        if not len(rows) or not (g.spare > 0).any():
            break
        g.offer(allowed[rows], tokens[rows])
        owners += [(int(i), k) for i in rows]
    at, to = np.nonzero(g.flow)
    return [(keys[owners[r][0]], owners[r][1], names[s], int(g.flow[r, s])) for r, s in zip(at.tolist(), to.tolist(), strict=True)]


def mix(sized: DataFrame, targets: DataFrame, *, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(selection, shares) for sized (doc_id, sources array<string>, tokens) and targets (source, target_share, max_repeats).

    selection: doc_id, source, uses, tokens (of one use), one row per document and source it is used for.
    shares: source, target_share, max_repeats, available_tokens, quota_tokens, selected_tokens, reached_share (of the
    total of all documents), shortfall_tokens, one row per target source, also for sources without documents.
    The size is the tokens of all documents, those of unlisted or null sources included. A quota beyond a source's
    documents times max_repeats is a shortfall, which is not given to others. Amounts are met to within half a document
    at each end. Documents without tokens, and max_repeats or shares that are null or negative (taken as 0), select
    nothing; of repeated target rows the highest share counts. targets is a small parameter table (one row per source).
    """
    spark = sized.sparkSession
    wanted = targets.where("source is not null").groupBy("source").agg(F.max(F.struct(F.coalesce("target_share", F.lit(0.0)), F.coalesce("max_repeats", F.lit(0)))).alias("t")).collect()
    share = {r[0]: max(0.0, r[1][0]) for r in wanted}
    repeats = {r[0]: max(0, r[1][1]) for r in wanted}
    listed = F.array(*[F.lit(s) for s in sorted(share)]).cast("array<string>")
    pattern = F.array_sort(F.array_intersect(F.coalesce("sources", F.array().cast("array<string>")), listed))
    bucket = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 50)  # the upper 14 bits: the order is the hash's
    docs = sized.select("doc_id", pattern.alias("pattern"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"), bucket.alias("bucket"), F.xxhash64("doc_id", F.lit(seed)).alias("h"))

    # One bounded table serves all that follows: tokens by pattern and bucket.
    histogram = docs.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("tokens"))
    # One row per set of listed sources that some document has: a summary, at most 2^sources rows of a parameter table.
    sums = histogram.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).collect()
    total = sum(r["tokens"] for r in sums)
    patterns = {tuple(r["pattern"]): r["tokens"] for r in sums if r["pattern"] and r["tokens"]}
    quotas = {s: round(x * total) for s, x in share.items()}
    flows = route(patterns, quotas, repeats)

    # Each use of a pattern is cut into stretches of its seeded order, one per source. A use that goes on where the one
    # before ended needs no other order: every stretch begins at 0.
    stretches: dict[tuple[str, ...], list[tuple[str, int, int]]] = {}
    at: dict[tuple[tuple[str, ...], int], int] = {}
    for p, k, s, tokens in flows:
        begin = at.get((p, k), 0)
        stretches.setdefault(p, []).append((s, begin, begin + tokens))
        at[p, k] = begin + tokens
    cuts = spark.createDataFrame([(list(p), c) for p, c in stretches.items()], "pattern array<string>, cuts array<struct<source:string,begin:bigint,until:bigint>>")

    from pyspark.sql import Window

    order = Window.partitionBy("pattern").orderBy("bucket")
    starts = histogram.select("pattern", "bucket", (F.sum("tokens").over(order) - F.col("tokens")).alias("start"))
    within = Window.partitionBy("pattern", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    useful = docs.where("tokens > 0 and size(pattern) > 0")
    placed = useful.withColumn("run", F.sum("tokens").over(within)).join(starts, ["pattern", "bucket"])
    # Twice the middle of the document's own stretch, in whole numbers.
    placed = placed.withColumn("mid2", 2 * (F.col("start") + F.col("run")) - F.col("tokens"))
    # One row per pattern: broadcast if few, else by lookup, as a pattern may hold a third of the documents.
    chosen = checked_lookup(placed, cuts, ["pattern"], "inner").select("doc_id", "tokens", "mid2", F.inline("cuts")).where("mid2 >= 2 * begin and mid2 < 2 * until")
    selection = chosen.groupBy("doc_id", "source").agg(F.count(F.lit(1)).cast("int").alias("uses"), F.max("tokens").alias("tokens"))

    have = {s: sum(t for p, t in patterns.items() if s in p) for s in share}
    plan = spark.createDataFrame(
        [(s, share[s], repeats[s], have[s], quotas[s]) for s in sorted(share)], "source string, target_share double, max_repeats int, available_tokens bigint, quota_tokens bigint"
    )
    got = selection.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("selected_tokens"))
    shares = plan.join(got, "source", "left").withColumn("selected_tokens", F.coalesce("selected_tokens", F.lit(0).cast("bigint")))
    shares = shares.withColumns(
        {
            "reached_share": F.col("selected_tokens") / F.lit(float(max(1, total))),
            "shortfall_tokens": F.greatest(F.lit(0).cast("bigint"), F.col("quota_tokens") - F.col("selected_tokens")),
        }
    )
    return selection, shares


def mix_documents(documents: DataFrame, targets: DataFrame, *, seed: int = 17, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """mix over documents (doc_id, text, source), sized in tokens of a public vocabulary."""
    shared_checkpoints(documents.sparkSession)
    sized = token_counts(documents, keep=("source",), tokenizers=tokenizers, vocabulary=vocabulary)
    sized = sized.select("doc_id", F.when(F.col("source").isNotNull(), F.array("source")).alias("sources"), "tokens").checkpoint()
    return mix(sized, targets, seed=seed)
