"""Labels in statistical syntax files: statements, variable and value labels, diagnostics and conflicts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.scalars import source_place

# The second word of a label command; the typo occurs in real files.
VALUE_WORDS = ("labels", "labesl")
# A statement runs to a period outside of single quotes that is no decimal point; '' inside quotes is a quote.
_STATEMENT = re.compile(r"(?s)(?=\S)(?:'(?:[^']|'')*(?:'|\Z)|(?<=[\d\-+\s(=])\.(?=\d)|[^'.])*\.?")
_TOKEN = re.compile(r"(?:'(?:[^']|'')*(?:'|\Z)|[^\s'])+")
ROWS = "file_no int, source_file string, source_line int, position int, kind string, label_type string, variable string, value string, label string, severity string, code string, message string, statement string"


def statements(text: str) -> Iterator[tuple[int, str]]:
    """(line of its first character, statement); what follows the last period comes as a statement of its own."""
    line, at = 1, 0
    for m in _STATEMENT.finditer(text):
        line += text.count("\n", at, m.start())
        at = m.start()
        yield line, m.group().strip()


def _bare(token: str) -> str:
    return token.removesuffix(".")


def _label(token: str) -> str | None:
    """A quoted token's text, None if it isn't quoted."""
    t = _bare(token)
    return t[1:-1].replace("''", "'") if len(t) > 1 and t[0] == t[-1] == "'" else None


def _command(statement: str) -> tuple[str, str]:
    """(variable, value or '', body) of a label command."""
    first, second, *rest = [*statement.split(None, 2), "", ""]
    kind = "variable" if (first.lower(), second.lower()) == ("variable", "labels") else "value" if first.lower() == "value" and second.lower() in VALUE_WORDS else ""
    return kind, rest[0]


def variable_label(statement: str) -> tuple[str, str] | None:
    """(variable, label) of a VARIABLE LABELS statement with one definition."""
    kind, body = _command(statement)
    tokens = _TOKEN.findall(body)
    if kind != "variable" or len(tokens) != 2 or _label(tokens[1]) is None:
        return None
    return _bare(tokens[0]), _label(tokens[1])


def value_labels(statement: str) -> list[tuple[str, str, str]] | None:
    """(variable, value, label) definitions of a VALUE LABELS statement; None if it is none, [] if it has none."""
    kind, body = _command(statement)
    if kind != "value" or not body:
        return None
    tokens = _TOKEN.findall(body)
    out: list[tuple[str, str, str]] = []
    variable, rest = _bare(tokens[0]) if tokens else "", tokens[1:]
    while len(rest) > 1:
        code, label = _bare(rest[0]), _label(rest[1])
        if code.startswith("/"):  # another variable's labels follow
            variable, rest = _bare(code[1:]), rest[1:]
        elif label is None:
            rest = rest[1:]
        else:
            plain = _label(code)
            out.append((variable, code if plain is None else plain, label))
            rest = rest[2:]
    return out


def parse(text: str) -> Iterator[dict]:
    """Label rows (kind row) and diagnostics (kind diagnostic) of a syntax text, in order."""
    for line, s in statements(text):
        one, many = variable_label(s), value_labels(s)
        if one is not None:
            yield {"source_line": line, "kind": "row", "label_type": "variable_label", "variable": one[0], "value": "", "label": one[1]}
        elif many:
            for v, code, label in many:
                yield {"source_line": line, "kind": "row", "label_type": "value_label", "variable": v, "value": code, "label": label}
        else:
            kind = _command(s)[0]
            if many is None and not s.endswith("."):
                code, message = "INCOMPLETE_STATEMENT", "SPSS statement does not end with a period."
            elif kind:
                code, message = f"MALFORMED_{kind.upper()}_LABELS", f"{kind.upper()} LABELS statement could not be parsed."
            else:
                continue  # other commands have no labels
            yield {"source_line": line, "kind": "diagnostic", "severity": "warning", "code": code, "message": message, "statement": s}


def parsed(files: DataFrame) -> DataFrame:
    """Label rows and diagnostics of (file_no, source_file, text); a file is parsed whole by one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for pdf in batches:
            rows = [r | {"file_no": n, "source_file": f, "position": i} for n, f, t in zip(pdf.file_no, pdf.source_file, pdf.text, strict=True) for i, r in enumerate(parse(t or ""))]
            # Plain objects: a string column in chunks isn't taken over to Spark.
            yield pd.DataFrame(rows, columns=names).astype(object).astype({"file_no": "int32", "source_line": "int32", "position": "int32"})

    return files.select("file_no", "source_file", "text").mapInPandas(run, ROWS)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_no, source_file, text) of syntax files, numbered in the order given; a byte-order mark is dropped."""
    order = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "file_no int, source_file string")
    # A path is matched by what it ends with: Spark names files as URIs.
    text = spark.read.text(paths, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("text"), F.url_decode(F.col("_metadata.file_path")).alias("_uri"))
    absolute = F.regexp_replace(F.col("_uri"), "^file:/+", "/")
    import os

    full = spark.createDataFrame([(p, os.path.abspath(p)) for p in paths], "source_file string, _full string")
    return text.join(full, absolute == F.col("_full")).join(order, "source_file").select("file_no", "source_file", "text")


def metadata_rows(result: DataFrame) -> DataFrame:
    """The label rows of parsed, in six text columns."""
    return result.where("kind = 'row'").select("source_file", F.col("source_line").cast("string").alias("source_line"), "label_type", "variable", "value", "label")


def diagnostics(result: DataFrame) -> DataFrame:
    """The diagnostics of parsed, in six text columns."""
    return result.where("kind = 'diagnostic'").select("source_file", F.col("source_line").cast("string").alias("source_line"), "severity", "code", "message", "statement")


def conflicts(rows: DataFrame) -> DataFrame:
    """Labels that are given twice (info) or differently (warning) for the same variable, or variable and value.

    Columns: severity, code, label_type, variable, value, labels, sources, message. Null cells count as ''.
    """
    cell = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    known = rows.select(*map(cell, ("source_file", "source_line", "label_type", "variable", "value", "label"))).where(F.col("label_type").isin("variable_label", "value_label"))
    keyed = known.withColumn("value", F.when(F.col("label_type") == "value_label", F.col("value")).otherwise(""))
    sets = keyed.groupBy("label_type", "variable", "value").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("label")).alias("l"), F.array_sort(F.collect_set(source_place("source_file", "source_line"))).alias("s")).where("n > 1")
    same = F.size("l") == 1
    of_value = F.col("label_type") == "value_label"
    subject = F.concat(F.lit("Variable "), F.col("variable"), F.when(of_value, F.concat(F.lit(" value "), F.col("value"))).otherwise(""))
    what = F.when(of_value, "value labels.").otherwise("variable labels.")
    return sets.select(
        F.when(same, "info").otherwise("warning").alias("severity"),
        F.concat(F.when(same, "DUPLICATE_").otherwise("CONFLICTING_"), F.upper("label_type")).alias("code"),
        "label_type",
        "variable",
        "value",
        F.array_join("l", " || ").alias("labels"),
        F.array_join("s", " ; ").alias("sources"),
        F.concat(subject, F.when(same, " has duplicate identical ").otherwise(" has conflicting "), what).alias("message"),
    )
