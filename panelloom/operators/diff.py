"""Keyed comparison of two datasets, cell by cell under a tolerance, and of their labels and formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions import fieldmeta
from panelloom.functions.scalars import text
from panelloom.operators.rules import quoted

TOLERANCE = 1e-12
EXAMPLES = 5


def cells_differ(a: Column, b: Column, numeric: bool, tolerance: float = TOLERANCE) -> Column:
    """Numbers differ by more than the tolerance (missing equals missing only); anything else differs as text, null as ''."""
    if numeric:
        return ~F.coalesce(a.eqNullSafe(b) | (F.abs(a - b) <= tolerance), F.lit(False))
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return as_text(a) != as_text(b)


def value_mismatches(candidate: DataFrame, oracle: DataFrame, key: str, columns: list[str] | None = None, *, tolerance: float = TOLERANCE) -> DataFrame:
    """(column, mismatches, response_ids) of each shared column whose cells differ for a key in both tables.

    Rows are joined by key; the cells that differ are unpivoted, so columns without differences cost no rows. example_ids
    are the first five keys in order. Keys must be unique; null keys match nothing.
    """
    shared = columns or [c for c in oracle.columns if c in candidate.columns and c != key]
    number = lambda df, c: isinstance(df.schema[c].dataType, T.NumericType)
    a = candidate.select(F.col(quoted(key)).alias("_k"), *[F.col(quoted(c)).alias(f"a{i}") for i, c in enumerate(shared)])
    b = oracle.select(F.col(quoted(key)).alias("_k"), *[F.col(quoted(c)).alias(f"b{i}") for i, c in enumerate(shared)])
    wrong = F.array(*[F.when(cells_differ(F.col(f"a{i}"), F.col(f"b{i}"), number(candidate, c) and number(oracle, c), tolerance), F.lit(c)) for i, c in enumerate(shared)])
    long = a.join(b, "_k").select("_k", F.explode(F.array_compact(wrong)).alias("column"))
    # The five least keys per column by a bounded buffer: ranks are cut before the shuffle.
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("column").orderBy("_k"))
    first = long.withColumn("r", rank).where(F.col("r") <= EXAMPLES).groupBy("column").agg(F.array_sort(F.collect_list("_k")).alias("response_ids"))
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("mismatches")).join(first, "column")


def id_set_difference(candidate: DataFrame, oracle: DataFrame, key: str) -> DataFrame:
    """(id, side) of the distinct keys that only one table has: candidate_only or oracle_only."""
    a = candidate.select(F.col(quoted(key)).alias("id")).distinct()
    b = oracle.select(F.col(quoted(key)).alias("id")).distinct()
    return a.join(b, "id", "left_anti").withColumn("side", F.lit("candidate_only")).unionByName(b.join(a, "id", "left_anti").withColumn("side", F.lit("oracle_only")))


def compare(candidate: DataFrame, oracle: DataFrame, key: str, *, tolerance: float = TOLERANCE) -> dict:
    """The report of a comparison: sizes and a list of issues, each with its code.

    Codes: COLUMN_MISMATCH, MISSING_ID_COLUMN, INVALID_IDS, ID_SET_MISMATCH, VALUE_MISMATCH, VARIABLE_LABEL_MISMATCH,
    VALUE_LABEL_MISMATCH, VARIABLE_FORMAT_MISMATCH (the first letter of the format only).
    """
    issues: list[dict] = []
    if candidate.columns != oracle.columns:
        issues.append(
            {
                "code": "COLUMN_MISMATCH",
                "missing": [c for c in oracle.columns if c not in candidate.columns],
                "unexpected": [c for c in candidate.columns if c not in oracle.columns],
                "order_matches": set(candidate.columns) != set(oracle.columns),
            }
        )
    rows: dict[str, int] = {}
    if key not in candidate.columns or key not in oracle.columns:
        issues.append({"code": "MISSING_ID_COLUMN", "column": key})
        rows = {"candidate": candidate.count(), "oracle": oracle.count()}
    else:
        valid = True
        for name, df in (("candidate", candidate), ("oracle", oracle)):
            k = text(F.col(quoted(key)))
            n, blank, distinct = df.agg(F.count(F.lit(1)), F.count_if(k == ""), F.count_distinct(k)).first()
            rows[name] = n
            if blank or distinct != n:
                valid = False
                issues.append({"code": "INVALID_IDS", "dataset": name, "blank": blank, "duplicated": n - distinct})
        if valid:
            only = id_set_difference(candidate, oracle, key).groupBy("side").count().collect()
            if only:
                issues.append({"code": "ID_SET_MISMATCH"} | {r["side"]: r["count"] for r in only})
            else:
                found = {r["column"]: r for r in value_mismatches(candidate, oracle, key, tolerance=tolerance).collect()}
                for c in oracle.columns:
                    if c in found:
                        issues.append({"code": "VALUE_MISMATCH", "column": c, "count": found[c]["mismatches"], "response_ids": [str(k) for k in found[c]["response_ids"]]})
    ours, theirs = fieldmeta.read(candidate), fieldmeta.read(oracle)
    for c in (c for c in oracle.columns if c in candidate.columns):
        for code, x, y in (
            ("VARIABLE_LABEL_MISMATCH", ours.labels.get(c) or "", theirs.labels.get(c) or ""),
            ("VALUE_LABEL_MISMATCH", ours.values.get(c) or {}, theirs.values.get(c) or {}),
            ("VARIABLE_FORMAT_MISMATCH", (ours.formats.get(c) or "")[:1], (theirs.formats.get(c) or "")[:1]),
        ):
            if x != y:
                issues.append({"code": code, "column": c, "candidate": x, "oracle": y})
    return {"key": key, "tolerance": tolerance, "rows": rows.get("oracle", 0), "columns": len(oracle.columns), "candidate_rows": rows.get("candidate", 0), "candidate_columns": len(candidate.columns), "passed": not issues, "issues": issues}
