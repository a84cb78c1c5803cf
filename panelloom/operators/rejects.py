"""Rows that fail to parse: valid lines are loaded, broken ones are set aside with the reason and the broken field.

Each file's header becomes one anchored pattern for a whole row (types included). Lines that miss it meet the
header's prefix patterns, one field longer each, and the first that misses names the broken field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import UNICODE_SPACE, strip
from panelloom.plans.skew import checked_lookup

#: Patterns of a field's value without outer blanks.
VALUE_RULES = {
    "ResponseId": r"R_[A-Za-z0-9]{15}",
    "Q1": r"(?:0*[1-5](?:\.0+)?)?",
    "Progress": r"0*(?:100|[1-9]?[0-9])(?:\.0+)?",
}
_BLANK = "".join(f"\\x{{{ord(c):x}}}" for c in UNICODE_SPACE)


def _any_field(sep: Column) -> Column:
    """A field free of quotes and separators, or quoted with inner quotes doubled; possessive, so linear and without recursion."""
    return F.concat(F.lit('(?:"(?:[^"]++|"")*+"|[^"'), sep, F.lit("]*+)"))


def _typed_field(rule: str, sep: Column) -> Column:
    """A field whose value follows a rule; a separator that is a blank, as a tab, is none of an unquoted field's blanks."""
    inner = f"[{_BLANK}]*{rule}[{_BLANK}]*"
    bare = F.concat(F.lit(f"[{_BLANK}&&[^"), sep, F.lit("]]*"))
    return F.concat(F.lit(f'(?:"{inner}"|'), bare, F.lit(rule), bare, F.lit(")"))


def _join(parts: Column, sep: Column) -> Column:
    return F.call_function("array_join", parts, sep)


def _file(lines: DataFrame) -> DataFrame:
    """Lines with _file, which is never null: "=" and the file's name, '' for lines of no file."""
    return lines.withColumn("_file", F.coalesce(F.concat(F.lit("="), F.col("file_name")), F.lit("")))


def headers(lines: DataFrame) -> DataFrame:
    """(_file, _sep, _header, _names, _typed, _row): each file's header (line_no 1), its fields' patterns and its row's."""
    first = _file(lines).where("line_no = 1").groupBy("_file").agg(F.min_by(F.struct("sep", "raw_line"), "record_id").alias("h"))
    sep = F.coalesce(F.nullif(F.col("h.sep"), F.lit("")), F.lit(","))
    bare = F.regexp_replace(F.coalesce("h.raw_line", F.lit("")), r"^(?:\x{feff}|ï»¿)", "")
    out = first.select("_file", F.regexp_replace(sep, r"([^A-Za-z0-9\s])", r"\\$1").alias("_sep"), bare.alias("_header"))
    out = out.withColumn("_names", F.transform(fields(F.col("_header"), F.col("_sep")), lambda x: strip(x, UNICODE_SPACE)))

    def typed(n: Column) -> Column:
        kind = _any_field(F.col("_sep"))
        for name, rule in VALUE_RULES.items():
            kind = F.when(n == name, _typed_field(rule, F.col("_sep"))).otherwise(kind)
        return kind

    out = out.withColumn("_typed", F.transform("_names", typed))
    return out.withColumn("_row", F.concat(F.lit(r"\A"), _join(F.col("_typed"), F.col("_sep")), F.lit(r"\z")))


def fields(line: Column, sep: Column) -> Column:
    """The unquoted fields of a line whose quoting is right."""
    raw = F.regexp_extract_all(F.concat(F.regexp_replace(sep, r"^\\", ""), line), F.concat(sep, F.lit("("), _any_field(sep), F.lit(")")), F.lit(1))
    return F.transform(raw, lambda x: F.when(x.startswith('"'), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def examine(lines: DataFrame) -> DataFrame:
    """record_id, file_name, line_no, is_data, reason, broken_field, names and fields of each line.

    reason is null for a valid line, else the first that applies of quoting, column_count and invalid_value;
    broken_field is the header's name of the first field that doesn't match ('' beyond the header's fields).
    is_data is false for headers (repeated ones too, however quoted), import-metadata lines, blank and null lines, which
    have no reason. Lines of a file without a header, and lines of no file, are checked for quoting only and have names
    null. sep is one character, a comma if null. An empty table gives no rows; further columns are ignored.

    Headers are broadcast if their number and size are proved small; else files that hold many lines get theirs by
    broadcast and all others by a shuffle.
    """
    head = headers(lines)
    data = _file(lines).select("record_id", "file_name", "line_no", "raw_line", "sep", "_file")
    df = checked_lookup(data, head, ["_file"], size=F.octet_length("_row") * 2)
    raw, sep = F.col("raw_line"), F.coalesce("_sep", F.regexp_replace(F.coalesce(F.nullif("sep", F.lit("")), F.lit(",")), r"([^A-Za-z0-9\s])", r"\\$1"))
    one = _any_field(sep)
    # regexp_instr keeps the last compiled pattern, rlike compiles a non-constant one for each row.
    matches = lambda pattern: F.regexp_instr(raw, pattern) > 0
    df = df.withColumn("_ok", F.when(F.col("_row").isNotNull(), matches(F.col("_row"))).otherwise(False))
    df = df.withColumn("_quoted", F.when(F.col("_ok"), True).otherwise(matches(F.concat(F.lit(r"\A"), one, F.lit("(?:"), sep, one, F.lit(r")*+\z")))))
    df = df.withColumn("_fields", F.when(F.col("_quoted"), fields(raw, sep)))
    names = F.col("_names")
    at = F.array_position(names, F.lit("ResponseId")).cast("int")
    rid = F.when(at > 0, strip(F.get("_fields", at - 1), UNICODE_SPACE))
    trimmed = F.transform("_fields", lambda x: strip(x, UNICODE_SPACE))
    headline = (F.col("line_no") == 1) | F.coalesce(F.when(~F.col("_ok"), trimmed == names), F.lit(False)) | F.coalesce(raw == F.col("_header"), F.lit(False))
    meta = F.coalesce((rid == "Response ID") | rid.startswith('{"ImportId"'), F.lit(False))
    blank = F.coalesce(strip(raw, UNICODE_SPACE) == "", F.lit(True))
    df = df.withColumn("is_data", ~(F.coalesce(headline, F.lit(False)) | blank | F.when(F.col("_ok"), False).otherwise(meta)))
    reason = (
        F.when(~F.col("is_data") | F.col("_ok"), F.lit(None).cast("string"))
        .when(~F.col("_quoted"), "quoting")
        .when(names.isNull(), F.lit(None).cast("string"))
        .when(F.size("_fields") != F.size(names), "column_count")
        .otherwise("invalid_value")
    )
    df = df.withColumn("reason", reason)
    upto = lambda k: F.concat(F.lit(r"\A"), _join(F.slice("_typed", F.lit(1), k), F.col("_sep")), F.lit("(?="), F.col("_sep"), F.lit(r"|\z)"))
    first = F.get(F.filter(F.sequence(F.lit(1), F.size(names)), lambda k: ~matches(upto(k))), F.lit(0))
    broken = F.when(F.col("reason").isNotNull(), F.coalesce(F.get(names, first - 1), F.lit("")))
    return df.select("record_id", "file_name", "line_no", "is_data", "reason", broken.alias("broken_field"), names.alias("names"), F.col("_fields").alias("fields"))


def rejected(lines: DataFrame) -> DataFrame:
    """(record_id, reason, broken_field) of the lines that fail; see examine."""
    return examine(lines).where("reason is not null").select("record_id", "reason", "broken_field")


#: Fields of a follow-up export that get a column of their own.
KNOWN = ("ResponseId", "BrokerPanelId", "StartDate", "EndDate", "RecordedDate", "Status", "Progress", "Duration (in seconds)", "Finished", "Q1", "Q2", "Q9_6_TEXT")


def loaded(lines: DataFrame, known: tuple[str, ...] = KNOWN) -> DataFrame:
    """The valid lines as responses: record_id, file_name, line_no, a text column for each known field and extras.

    A field that a file lacks is null; a header's further fields go to extras as a JSON text, sorted by name. Of two
    fields with the same name the first counts. Column names are in lower case with blanks as underscores. The fields of
    a file without a header have numbers for names ("1", "2", ...), so all of them are in extras: every line is here, in
    rejected, or no data.
    """
    ok = examine(lines).where("is_data and reason is null")
    numbers = F.transform("fields", lambda _, i: (i + 1).cast("string"))
    ok = ok.withColumn("names", F.coalesce("names", numbers))
    value = lambda n: F.get("fields", F.array_position("names", n).cast("int") - 1)
    place = lambda n: F.when(F.array_position("names", F.lit(n)) > 0, strip(value(F.lit(n)), UNICODE_SPACE) if n in VALUE_RULES else value(F.lit(n)))
    more = F.array_sort(F.array_except(F.array_distinct("names"), F.array(*map(F.lit, known))))
    extras = F.to_json(F.map_from_arrays(more, F.transform(more, value)))
    slug = lambda n: n.lower().replace(" ", "_").replace("(", "").replace(")", "")
    return ok.select("record_id", "file_name", "line_no", *[place(n).alias(slug(n)) for n in known], extras.alias("extras"))
