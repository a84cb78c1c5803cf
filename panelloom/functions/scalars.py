"""Scalar functions as Catalyst expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of Unicode's White_Space property.
UNICODE_SPACE = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
# What Python's str.strip removes, that is the above and four separators.
PY_SPACE = UNICODE_SPACE + "\x1c\x1d\x1e\x1f"

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"


def strip(c: Column | str, chars: str = PY_SPACE) -> Column:
    """Text without outer white space; null stays null."""
    return F.btrim(_col(c), F.lit(chars))


def text(c: Column | str) -> Column:
    """Stripped text with '' for null (identifiers of the export, which keep their case)."""
    return F.coalesce(strip(_col(c).cast("string")), F.lit(""))


# Letters whose case folding isn't their lower case, by rule: those that fold to one letter, and to several. Capital sigma
# is folded here as well (its lower case depends on its place), and Cherokee folds to its capitals.
_LETTERS = [c for c in map(chr, [*range(128, 0xD800), *range(0xE000, 0x20000)]) if c.casefold() != c.lower() or c in "Σİ"]
_ONE = [c for c in _LETTERS if len(c.casefold()) == 1 and not "Ꭰ" <= c <= "ᏽ" and not "ꭰ" <= c <= "ꮿ"]
_MORE = [c for c in _LETTERS if len(c.casefold()) > 1]
_CHEROKEE = ("".join(map(chr, [*range(0xAB70, 0xABC0), *range(0x13F8, 0x13FE)])), "".join(map(chr, range(0x13A0, 0x13F6))))


def casefold(c: Column) -> Column:
    """Full case folding as Python's, in the JVM; only texts beyond ASCII take the long way."""
    one = F.translate(c, "".join(_ONE), "".join(x.casefold() for x in _ONE))
    table = F.create_map(*[F.lit(x) for m in _MORE for x in (m, m.casefold())])
    more = F.when(one.rlike("[" + "".join(_MORE) + "]"), F.array_join(F.transform(F.split(one, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")).otherwise(one)
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), F.lower(c)).otherwise(F.translate(F.lower(more), *_CHEROKEE))


def fold_id(c: Column | str) -> Column:
    """Stripped, case-folded identifier with '' for null (identifiers of the linking stage)."""
    return casefold(text(c))


def to_number(c: Column | str) -> Column:
    """Double of a text as a strict parser reads it, else null.

    Outer white space is ignored; infinities are accepted by name only; "nan", "1d", "1_000" and numbers beyond the
    double range are null. NaN never results.
    """
    s = strip(_col(c).cast("string"))
    parsed = F.when(s.rlike(NUMBER), s.try_cast("double"))
    named = F.when(s.rlike(INFINITE), F.when(s.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    return F.coalesce(F.when(F.abs(parsed) < F.lit(float("inf")), parsed), named)


def first_filled(columns: Sequence[str]) -> Column:
    """The first non-blank stripped value in order of priority, '' if there is none."""
    return F.coalesce(*[F.nullif(strip(_col(c)), F.lit("")) for c in columns], F.lit(""))


def first_filled_source(columns: Sequence[str]) -> Column:
    """The name of the column that supplies first_filled, '' if there is none."""
    return F.coalesce(*[F.when(text(c) != "", F.lit(c)) for c in columns], F.lit(""))


def normal_code(value: str | None) -> str:
    """A category code in its plain form: 1.0, 01 and +1 become 1; text that is no number stays as it is."""
    s = (value or "").strip()
    try:
        number = Decimal(s)
    except InvalidOperation:
        return s
    if not number.is_finite():
        return str(number)
    plain = format(number.normalize(), "f")
    return plain.rstrip("0").rstrip(".") if "." in plain else plain


# Decimal digits of all scripts beyond ASCII, by rule, and their values.
_DIGITS = [c for c in map(chr, range(128, 0x20000)) if unicodedata.decimal(c, None) is not None]
_DIGIT_VALUES = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then of a value that is computed once, however often then names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def cluster_code(c: Column | str) -> Column:
    """normal_code as a column, by text operations in the JVM.

    Numbers of more than 28 digits keep them all, where normal_code rounds; exponents of more than four digits make no number.
    """
    usual = r"^[+]?([1-9][0-9]{0,17})(\.0*)?$"
    s = text(c)
    return F.when(s == "", "").when(s.rlike(usual), F.regexp_extract(s, usual, 1)).otherwise(_let(s, _unusual_code))


def _unusual_code(s: Column) -> Column:
    ascii_digits = F.when(s.rlike(r"^[\x00-\x7F]*$"), s).otherwise(F.translate(s, "".join(_DIGITS), _DIGIT_VALUES))
    return _let(F.replace(ascii_digits, F.lit("_"), F.lit("")), lambda plain: F.coalesce(_special_code(plain), s))


def _special_code(plain: Column) -> Column:
    """A number in its plain form, or the name of what is no finite one; null for other texts."""
    sign = F.when(plain.startswith("-"), "-").otherwise("")
    part = lambda i: F.regexp_extract(plain, r"^[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]{1,4}))?$", i)
    exponent = F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(0))
    number = _let(F.struct(F.concat(part(1), part(2)).alias("digits"), (F.length(part(1)) + exponent).alias("point")), _placed)
    quiet = F.lower(F.regexp_extract(plain, r"(?i)^[+-]?(s?)nan([0-9]*)$", 1))
    return (
        F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,4})?$"), F.concat(sign, number))
        .when(plain.rlike(INFINITE), F.concat(sign, F.lit("Infinity")))
        .when(plain.rlike(r"(?i)^[+-]?s?nan[0-9]*$"), F.concat(sign, quiet, F.lit("NaN"), F.ltrim(F.regexp_extract(plain, r"([0-9]*)$", 1), F.lit("0"))))
    )


def _placed(x: Column) -> Column:
    """Digits with a point after so many of them, without zeros that say nothing."""
    short = F.ltrim(x["digits"], F.lit("0"))
    known = F.struct(F.rtrim(short, F.lit("0")).alias("held"), (x["point"] - F.length(x["digits"]) + F.length(short)).alias("point"))

    def shown(k: Column) -> Column:
        held, point = k["held"], k["point"]
        return (
            F.when(held == "", "0")
            .when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), held))
            .when(point >= F.length(held), F.concat(held, F.repeat(F.lit("0"), point - F.length(held))))
            .otherwise(F.concat(F.substr(held, F.lit(1), point), F.lit("."), F.substr(held, point + 1)))
        )

    return _let(known, shown)


def squashed_name(c: Column | str) -> Column:
    """A column name in lower case, letters and digits only."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")


def excel_serial(c: Column | str) -> Column:
    """Days since 1899-12-30 of a text yyyy-M-d H:m:s as a double; blank is null, other texts raise an error."""
    filled = F.nullif(strip(_col(c)), F.lit(""))
    # unix_micros needs an instant: both sides are read in the session's zone, so the zone cancels out with UTC.
    micros = F.unix_micros(F.to_timestamp(filled, "yyyy-M-d H:m:s")) - F.unix_micros(F.expr("TIMESTAMP'1899-12-30 00:00:00'"))
    return micros / F.lit(86_400_000_000.0)


def source_place(file: Column | str, line: Column | str) -> Column:
    """file:line, file, "line N" or "unknown source", by what is known."""
    f, n = text(file), text(line)
    return (
        F.when((f != "") & (n != ""), F.concat(f, F.lit(":"), n))
        .when(f != "", f)
        .when(n != "", F.concat(F.lit("line "), n))
        .otherwise("unknown source")
    )


def _col(c: Column | str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c
