"""Readers and writers of survey files: text tables, headers, mappings, workbooks, JSON and fingerprints.

Tables are read by Spark, a crosswalk's workbook by one task as a stream; headers, mappings and programs, which are small
by nature, on the driver. Artifacts of the
pipeline are single files with a fixed byte layout, streamed from the executors partition by partition.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import json
import math
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.scalars import text
from panelloom.operators.link import CROSSWALK, check_crosswalk
from panelloom.operators.rules import quoted
from panelloom.session import shared_checkpoints

#: Name of the column that counts a file's rows from 0.
ORDINAL = "_ord"
# Fixed value: the columns of a reviewed mapping.
MAPPING_FIELDS = (
    "followup_column_index", "followup_column", "column_family", "exists_exact_in_master", "y0_exists_in_master",
    "y1_exists_in_master", "y2_exists_in_master", "proposed_target_column", "confidence", "reason",
)


def read_text_table(spark: SparkSession, path: str | Path, *, encoding: str = "UTF-8", ordinal: bool = True, line_breaks: bool = True) -> DataFrame:
    """A CSV file as text columns with '' for missing cells, and its row order as _ord.

    Quoted line breaks and doubled quotes are read, blank lines skipped, a byte-order mark dropped; nothing is taken for
    a number or a null. One file is one split, as its cells may hold line breaks; without line_breaks, which promises that
    none do, a file is read by many tasks. _ord follows the file either way: splits are numbered in their order.
    """
    names = clean_headers(read_headers(path, encoding=encoding))
    if len(set(names)) != len(names):
        raise ValueError(f"{path} has a duplicated column name.")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .option("maxColumns", 20480)
        .option("maxCharsPerColumn", -1)
        .option("enforceSchema", True)
        .option("encoding", {"iso8859-1": "ISO-8859-1"}.get(codecs.lookup(encoding).name, encoding))
        .csv(str(path))
    )
    df = raw.select(*[F.coalesce(F.col(quoted(n)), F.lit("")).alias(n) for n in names])
    return df.withColumn(ORDINAL, F.monotonically_increasing_id()) if ordinal else df


def read_headers(path: str | Path, *, encoding: str = "utf-8") -> list[str]:
    """The first record of a CSV file, a byte-order mark dropped; an empty file is an error."""
    with open(path, encoding="utf-8-sig" if encoding.lower().replace("-", "") == "utf8" else encoding, newline="") as f:
        first = next(csv.reader(f), None)
    if first is None:
        raise ValueError(f"{path} is empty or has no header.")
    return first


def clean_headers(names: list[str]) -> list[str]:
    """Headers without what a byte-order mark leaves at the first of them."""
    return [re.sub("^(﻿|ï»¿)+", "", names[0]), *names[1:]] if names else []


def read_mapping(path: str | Path, *, required: Iterable[str] = MAPPING_FIELDS) -> list[dict]:
    """Rows of a reviewed mapping; an error names missing columns."""
    headers = read_headers(path)
    missing = [c for c in required if c not in headers]
    if missing:
        raise ValueError(f"{path} is missing required columns: {', '.join(missing)}")
    with open(path, encoding="utf-8-sig", newline="") as f:
        return [dict(r) for r in csv.DictReader(f)]


def column_index(cell: str) -> int:
    """0-based column of a cell's reference such as AB12."""
    n = 0
    for ch in re.match("[A-Za-z]*", cell)[0].upper() or "A":
        n = n * 26 + ord(ch) - 64
    return n - 1


class _Cells:
    """What an XML parser calls: takes the rows of cells of a worksheet, and the texts of shared strings, as they end."""

    def __init__(self, shared: list[str]):
        self.shared, self.rows, self.open, self.into = shared, [], [], None
        self.cells: dict[int, str] = {}
        self.cell: dict[str, str] = {}
        self.value: list[str] | None = None
        self.texts: list[str] = []

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        name, above = tag.rpartition("}")[2], self.open[-1] if self.open else ""
        self.open.append(name)
        self.into = None
        if name == "row":
            self.cells = {}
        elif name == "c" and above == "row":
            self.cell, self.value, self.texts = attributes, None, []
        elif name == "v" and above == "c" and self.value is None:
            self.into = self.value = []
        elif name == "t":
            self.into = self.texts
        elif name == "si":
            self.texts = []

    def data(self, text: str) -> None:
        if self.into is not None:
            self.into.append(text)

    def end(self, tag: str) -> None:
        name = self.open.pop()
        self.into = None
        if name == "c" and self.open[-1:] == ["row"]:
            kind, value = self.cell.get("t"), "".join(self.value or ())
            shown = "".join(self.texts) if kind == "inlineStr" else self.shared[int(value)] if kind == "s" and value else value
            self.cells[column_index(self.cell.get("r", "A1"))] = shown.strip()
        elif name == "row":
            self.rows.append([self.cells.get(i, "") for i in range(max(self.cells, default=-1) + 1)])
        elif name == "si" and len(self.open) == 1:
            self.shared.append("".join(self.texts))


def worksheet_rows(path: str | Path) -> Iterator[list[str]]:
    """Rows of a workbook's first sheet as stripped texts up to their last cell, read as a stream."""
    shared: list[str] = []
    with zipfile.ZipFile(path) as z:
        for name in ("xl/sharedStrings.xml", "xl/worksheets/sheet1.xml"):
            if name not in z.namelist():
                continue
            found = _Cells(shared)
            parser = ElementTree.XMLParser(target=found)
            with z.open(name) as f:
                while raw := f.read(1 << 16):
                    parser.feed(raw)
                    yield from found.rows
                    found.rows = []
            parser.close()


def read_worksheet(path: str | Path) -> list[list[str]]:
    """Rows of a workbook's first sheet as stripped texts, all of the same length; numbers stay as they are written."""
    rows = list(worksheet_rows(path))
    width = max(map(len, rows), default=0)
    return [r + [""] * (width - len(r)) for r in rows]


def read_crosswalk(spark: SparkSession, path: str | Path) -> DataFrame:
    """The crosswalk of a workbook: three checked text columns. A task reads it where it lies; its rows are checkpointed."""
    place = str(Path(path).absolute())
    head = next(worksheet_rows(place), None)
    if head is None:
        raise ValueError("The crosswalk workbook has no rows.")

    def unexpected(width: int) -> ValueError:
        return ValueError(f"Unexpected crosswalk columns: {head + [''] * (width - len(head))}")

    if tuple(head) != CROSSWALK:
        raise unexpected(max(map(len, worksheet_rows(place))))
    names = ["_width", *CROSSWALK]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in (i for b in batches for i in range(b.num_rows)):
            rows = worksheet_rows(place)
            next(rows)
            for some in batched(rows, 10_000):
                cells = [pa.array([r[i] if i < len(r) else "" for r in some], pa.string()) for i in range(len(CROSSWALK))]
                yield pa.RecordBatch.from_arrays([pa.array([len(r) for r in some], pa.int32()), *cells], names=names)

    shared_checkpoints(spark)
    schema = T.StructType([T.StructField("_width", T.IntegerType()), *[T.StructField(h, T.StringType()) for h in CROSSWALK]])
    df = spark.range(0, 1, 1, 1).mapInArrow(run, schema).checkpoint()
    width = df.agg(F.max("_width")).first()[0] or 0
    if width > len(CROSSWALK):
        raise unexpected(width)
    df = df.drop("_width").where(F.concat(*map(F.col, map(quoted, CROSSWALK))) != "")
    check_crosswalk(df)
    return df.select(*[text(c).alias(c) for c in CROSSWALK])


def sha256(path: str | Path) -> str:
    """Fingerprint of a file, read in blocks."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256) of many files, by the executors."""
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))


def shortest(x: float) -> str:
    """A double as its shortest text; whole numbers end in .0."""
    return repr(float(x))


def fourteen_digits(x: float) -> str:
    """A double in 14 significant digits, the same on every platform."""
    return "%.14g" % x


def write_table(df: DataFrame, path: str | Path, *, bom: bool = True, newline: str = "\n", number: Callable[[float], str] = shortest) -> int:
    """One CSV file of df in its order, missing cells empty; rows stream through the driver one partition at a time."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        out = csv.writer(f, lineterminator=newline)
        out.writerow(df.columns)
        for row in df.toLocalIterator(prefetchPartitions=True):
            out.writerow(["" if v is None or isinstance(v, float) and math.isnan(v) else number(v) if isinstance(v, float) else v for v in row])
            n += 1
    return n


def write_parts(df: DataFrame, path: str | Path) -> None:
    """A Parquet table with its fields' labels and formats, written by the executors: for tables too large for one file."""
    df.write.mode("overwrite").parquet(str(path))


def write_rows(path: str | Path, rows: Iterable[dict], fields: Iterable[str]) -> None:
    """One CSV file of small review rows."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.DictWriter(f, list(fields), extrasaction="ignore")
        out.writeheader()
        out.writerows(rows)


def write_json(path: str | Path, payload: dict) -> None:
    """An indented JSON file."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(payload, indent=2, default=str), encoding="utf-8")


def write_text(path: str | Path, body: str) -> None:
    """A text file."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(body, encoding="utf-8")


def batched(rows: Iterator, n: int) -> Iterator[list]:
    """Lists of up to n rows."""
    batch: list = []
    for r in rows:
        batch.append(r)
        if len(batch) == n:
            yield batch
            batch = []
    if batch:
        yield batch
