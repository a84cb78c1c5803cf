"""Reader and writer of SPSS system files (.sav), after the public description of the format.

Reader and writer take uncompressed, bytecode-compressed and block-compressed files of either byte order, with labels,
value labels, formats, long names and very long strings (up to 32,767 bytes). A file is one stream of cases: the driver
scans it for the places of cases, tasks decode the parts between them; tasks encode cases, the driver puts them in a row.
read_dictionary reads the dictionary only.
"""

from __future__ import annotations

import codecs
import os
import struct
import zlib
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelloom.functions import fieldmeta
from panelloom.functions.fieldmeta import Dictionary

# Fixed values of the format.
MISSING = -struct.unpack("<d", bytes.fromhex("ffffffffffffef7f"))[0]
BIAS = 100.0
FORMATS = {1: "A", 5: "F", 20: "DATE", 22: "DATETIME"}
CODES = {"A": 1, "F": 5, "DATE": 20, "DATETIME": 22}


# Fixed values of the format: the most bytes of a string, of one variable's part of it, and by which parts are counted.
MOST_BYTES, PART, COUNTED = 32_767, 255, 252
#: Bytes of cases in a block of a block-compressed file that is written.
BLOCK = 1 << 20
#: Bytes of cases that one task decodes, that are scanned at once, and that are coded at once (one case at least).
SPLIT, SCAN, BATCH = 16 << 20, 4 << 20, 1 << 20
_BLANKS = np.frombuffer(b" " * 8, np.uint64)[0]
_ENCODINGS = {2: "latin-1", 3: "latin-1", 1250: "cp1250", 1251: "cp1251", 1252: "cp1252", 28591: "latin-1", 65001: "utf-8"}


@dataclass
class Layout:
    """Variables of a file: (name, width; 0 is numeric) in order, its dictionary, and how its cases are written."""

    variables: list[tuple[str, int]] = field(default_factory=list)
    dictionary: Dictionary = field(default_factory=Dictionary)
    cases: int = -1
    compression: int = 0
    order: str = "<"
    encoding: str = "utf-8"
    bias: float = BIAS
    begin: int = 0
    blocks: list[tuple[int, int]] = field(default_factory=list)


def parts(width: int) -> list[int]:
    """Widths of the variables that hold a string."""
    if width <= PART:
        return [width]
    n = -(-width // COUNTED)
    return [PART] * (n - 1) + [width - (n - 1) * COUNTED]


def _units_of(width: int) -> int:
    """Eight-byte units of a variable."""
    return 1 if width == 0 else sum(max(1, (w + 7) // 8) for w in parts(width))


def read_dictionary(f: BinaryIO) -> Layout:
    """The layout of an open file, which is left at its first case."""
    head = f.read(176)
    if head[:4] not in (b"$FL2", b"$FL3"):
        raise ValueError("This is no SPSS system file.")
    order = next((o for o in "<>" if struct.unpack(o + "i", head[64:68])[0] in (2, 3)), None)
    if order is None:
        raise ValueError("The byte order of this system file is unknown.")
    ints = lambda n: struct.unpack(f"{order}{n}i", f.read(4 * n))
    _, _, compression, _, cases = struct.unpack(order + "5i", head[64:84])
    if compression not in (0, 1, 2):
        raise ValueError(f"System files with compression {compression} are not read.")
    out = Layout(cases=cases, compression=compression, order=order, bias=struct.unpack(order + "d", head[84:92])[0])
    short: list[str | None] = []
    labels: dict[str, bytes] = {}
    values: dict[str, list[tuple[bytes, bytes]]] = {}
    formats: dict[str, str] = {}
    widths: dict[str, int] = {}
    pending: list[tuple[bytes, bytes]] = []
    extra: dict[int, bytes] = {}
    while True:
        (kind,) = ints(1)
        if kind == 2:
            width, has_label, missing, fmt, _ = ints(5)
            name = f.read(8)
            label = None
            if has_label:
                (n,) = ints(1)
                label = f.read((n + 3) // 4 * 4)[:n]
            f.read(8 * abs(missing))
            if width < 0:
                short.append(None)
                continue
            key = name.decode("latin-1").rstrip()
            short.append(key)
            widths[key] = width
            formats[key] = f"{FORMATS.get(fmt >> 16 & 255, 'F')}{fmt >> 8 & 255}" + (f".{fmt & 255}" if width == 0 else "")
            if label is not None:
                labels[key] = label
        elif kind == 3:
            pending = []
            for _ in range(ints(1)[0]):
                raw, size = f.read(8), f.read(1)[0]
                pending.append((raw, f.read((size + 8) // 8 * 8 - 1)[:size]))
        elif kind == 4:
            for at in ints(ints(1)[0]):
                key = short[at - 1]
                if key and widths[key] == 0:
                    values[key] = pending
        elif kind == 6:
            f.read(80 * ints(1)[0])
        elif kind == 7:
            sub, size, n = ints(3)
            extra[sub] = f.read(size * n)
        elif kind == 999:
            f.read(4)
            break
        else:
            raise ValueError(f"Unknown record type {kind}.")
    if 3 in extra:
        out.encoding = _ENCODINGS.get(struct.unpack(order + "8i", extra[3][:32])[7], out.encoding)
    if 20 in extra:
        named = extra[20].decode("ascii", "replace").strip("\x00 ")
        try:
            out.encoding = codecs.lookup(named).name
        except LookupError:
            raise ValueError(f"The encoding of this system file is unknown: {named}") from None
    text = lambda raw: raw.decode(out.encoding, "replace")
    long_names = dict(x.split("=", 1) for x in text(extra.get(13, b"")).split("\t") if "=" in x)
    very_long = {k.strip("\x00\t").upper(): int(w.strip("\x00")) for k, _, w in (x.partition("=") for x in text(extra.get(14, b"")).split("\x00\t")) if w}
    skip = 0
    for key in (k for k in short if k):
        if skip:
            skip -= 1
            continue
        width = very_long.get(key.upper(), widths[key])
        skip = len(parts(width)) - 1
        name = long_names.get(key, key)
        out.variables.append((name, width))
        d = out.dictionary
        if key in labels:
            d.labels[name] = text(labels[key])
        if key in values:
            d.values[name] = {struct.unpack(order + "d", raw)[0]: text(shown) for raw, shown in values[key]}
        d.formats[name] = formats[key]
    if compression == 2:
        _, trailer, _ = struct.unpack(order + "3q", f.read(24))
        at = f.tell()
        f.seek(trailer + 16)
        _, n = ints(2)
        out.blocks = [struct.unpack(order + "2q2i", f.read(24))[1::2] for _ in range(n)]
        f.seek(at)
    out.begin = f.tell()
    return out


def _pieces(f: BinaryIO, layout: Layout, at: int = 0, block: int = 0) -> Iterator[bytes]:
    """The bytes of the cases, unzipped: from byte at on, of block-compressed files from byte at of that block on."""
    if layout.compression == 2:
        for place, size in layout.blocks[block:]:
            f.seek(place)
            yield zlib.decompress(f.read(size))[at:]
            at = 0
        return
    f.seek(layout.begin + at)
    while raw := f.read(SCAN):
        yield raw


def _groups(pieces: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of eight bytecodes: the byte where each begins, its codes (0 from the end of the cases on), all data units."""
    held, begin, ended = b"", 0, False
    while not ended:
        piece = next(pieces, None)
        ended = piece is None
        # At the end, a group that is cut off is filled up; the data that it lacks is left out below.
        raw = held + (b"\0" * 64 if ended else piece)
        there, n = (len(held) if ended else len(raw)) // 8, len(raw) // 8
        words = np.frombuffer(raw, np.uint8, 8 * n).reshape(n, 8)
        data = (words == 253).sum(1, dtype=np.uint8).tobytes()
        at, found = 0, []
        while at < there and (after := at + 1 + data[at]) <= n:
            found.append(at)
            at = after
        places = np.array(found, np.int64)
        codes, is_data = words[places], np.ones(at, bool)
        is_data[places] = False
        units = words[:at][is_data].reshape(-1).view(np.uint64)
        flat = codes.reshape(-1)
        if at > there:
            flat[np.flatnonzero(flat == 253)[len(units) - (at - there)] :] = 0
        if len(ends := np.flatnonzero(flat == 252)):
            flat[ends[0] :] = 0
            ended = True
        yield begin + 8 * places, codes, units[: np.count_nonzero(flat == 253)]
        held, begin = raw[8 * at :], begin + 8 * at


def _splits(f: BinaryIO, layout: Layout) -> list[tuple[int, int, int, int, int]]:
    """(block, byte, units to skip there, cases, cases before) of the parts of an open file that a task each decodes."""
    width = sum(_units_of(w) for _, w in layout.variables)
    if not width:
        return []
    most = max(1, SPLIT // (8 * width))
    units, starts = 0, []
    if not layout.compression:
        units = (f.seek(0, os.SEEK_END) - layout.begin) // 8
        starts = [(0, 8 * at, 0) for at in range(0, units, most * width)]
    else:
        lengths: list[int] = []

        def pieces() -> Iterator[bytes]:
            for raw in _pieces(f, layout):
                lengths.append(len(raw))
                yield raw

        for places, codes, _ in _groups(pieces()):
            filled = np.count_nonzero(codes, axis=1)
            before = units + np.cumsum(filled) - filled
            units += int(filled.sum())
            while (first := len(starts) * most * width) < units:
                k = int(np.searchsorted(before, first, "right")) - 1
                starts.append((0, int(places[k]), first - int(before[k])))
        if layout.compression == 2:
            begins = [0, *accumulate(lengths)]
            starts = [(k := bisect(begins, at) - 1, at - begins[k], skip) for _, at, skip in starts]
    cases, rest = divmod(units, width)
    if rest and not 0 <= layout.cases <= cases:
        raise ValueError("This system file ends inside a case.")
    return [(*at, min(most, cases - i * most), i * most) for i, at in enumerate(starts) if cases > i * most]


def _decoded(f: BinaryIO, layout: Layout, block: int, at: int, skip: int, cases: int) -> Iterator[np.ndarray]:
    """The units of a part's cases, a row of them per case."""
    width = sum(_units_of(w) for _, w in layout.variables)
    if not layout.compression:
        f.seek(layout.begin + at)
        most = max(1, BATCH // (8 * width))
        for i in range(0, cases, most):
            yield np.frombuffer(f.read(8 * width * min(most, cases - i)), np.uint64).reshape(-1, width)
        return
    known = [MISSING if c == 255 else c - layout.bias for c in range(256)]
    unit_of = np.frombuffer(struct.pack(layout.order + "256d", *known), np.uint64).copy()
    unit_of[254] = _BLANKS
    is_text = np.concatenate([np.full(_units_of(w), w > 0) for _, w in layout.variables])
    units, codes = np.empty(0, np.uint64), np.empty(0, np.uint8)
    for _, found, data in _groups(_pieces(f, layout, at, block)):
        found = found.reshape(-1)
        found = found[found != 0]
        got = unit_of[found]
        got[found == 253] = data
        units, codes = np.concatenate([units, got[skip:]]), np.concatenate([codes, found[skip:]])
        skip = max(0, skip - len(got))
        n = min(cases, len(units) // width)
        out = units[: n * width].reshape(n, width)
        out[(codes[: n * width].reshape(n, width) == 255) & is_text] = _BLANKS
        most = max(1, BATCH // (8 * width))
        yield from (out[i : i + most] for i in range(0, n, most))
        units, codes, cases = units[n * width :], codes[n * width :], cases - n
        if not cases:
            return


def _keeps_ascii(encoding: str) -> bool:
    try:
        return bytes(range(128)).decode(encoding) == "".join(map(chr, range(128)))
    except UnicodeError:
        return False


def _texts(units: np.ndarray, width: int, encoding: str, keeps_ascii: bool) -> pa.Array:
    """A string variable of cases, without trailing blanks."""
    n = len(units)
    raw = np.ascontiguousarray(units).view(np.uint8).reshape(n, -1)
    if width > PART:  # each part is full but for the last; what a part has beyond its width is padding
        step = 8 * ((PART + 7) // 8)
        raw = np.pad(raw, ((0, 0), (0, -raw.shape[1] % step))).reshape(n, -1, step)[:, :, :PART].reshape(n, -1)
    raw = np.ascontiguousarray(raw[:, :width])
    if not keeps_ascii or n and raw.max() > 127:
        return pa.array([r.tobytes().decode(encoding, "replace").rstrip(" \x00") for r in raw], pa.string())
    shown = (raw != 32) & (raw != 0)
    sizes = np.where(shown.any(1), width - shown[:, ::-1].argmax(1), 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[np.arange(width) < sizes[:, None]])])


def _batch(units: np.ndarray, layout: Layout, keeps_ascii: bool) -> list[pa.Array]:
    """The columns of cases: doubles (null for missing) and texts."""
    columns, at = [], 0
    for _, width in layout.variables:
        n = _units_of(width)
        if width:
            columns.append(_texts(units[:, at : at + n], width, layout.encoding, keeps_ascii))
        else:
            x = np.ascontiguousarray(units[:, at]).view(layout.order + "f8").astype(np.float64)
            columns.append(pa.array(x, mask=x == MISSING))
        at += n
    return columns


def _stamp(f: BinaryIO) -> tuple[int, int]:
    found = os.fstat(f.fileno())
    return found.st_size, found.st_mtime_ns


def read_sav(spark: SparkSession, path: str | Path, *, ordinal: str | None = None) -> DataFrame:
    """A system file as doubles and texts with its dictionary on the fields; ordinal names a column that counts rows.

    Tasks read the file where it lies, as text tables are read; one that has changed in the meantime is an error.
    """
    place = str(Path(path).absolute())
    with open(place, "rb") as f:
        layout = read_dictionary(f)
        splits, stamp = _splits(f, layout), _stamp(f)
    schema = T.StructType([T.StructField(n, T.StringType() if w else T.DoubleType()) for n, w in layout.variables])
    if ordinal:
        schema = schema.add(ordinal, T.LongType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps_ascii = _keeps_ascii(layout.encoding)
        for i in (i for b in batches for i in b.column(0).to_pylist()):
            *part, first = splits[i]
            with open(place, "rb") as f:
                if _stamp(f) != stamp:
                    raise ValueError(f"{place} has changed since its dictionary was read.")
                for units in _decoded(f, layout, *part):
                    columns = _batch(units, layout, keeps_ascii)
                    if ordinal:
                        columns.append(pa.array(np.arange(first, first + len(units))))
                    first += len(units)
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return fieldmeta.attach(spark.range(0, len(splits), 1, max(1, len(splits))).mapInArrow(run, schema), layout.dictionary)


def _label(text: str, most: int) -> bytes:
    raw = text.encode()[:most]
    return raw.decode("utf-8", "ignore").encode()


def _format(shown: str | None, width: int) -> int:
    if width:
        return CODES["A"] << 16 | min(width, 255) << 8
    kind = (shown or "F8.2").rstrip("0123456789.")
    size, _, decimals = (shown or "F8.2")[len(kind) :].partition(".")
    return CODES.get(kind, 5) << 16 | int(size or 8) << 8 | int(decimals or 0)


def write_sav(df: DataFrame, path: str | Path, *, file_label: str = "", compress: bool | str = True, order: str = "<") -> int:
    """df as a system file: numeric columns as doubles, others as text of up to 32,767 bytes a value; longer is an error.

    compress: True for bytecodes, "block" for zlib blocks of them. order: "<" or ">", the byte order. Labels and formats
    come from the fields' metadata. The widths of texts come first; then tasks encode the cases, whose bytes stream through
    the driver in df's order. The file takes its place when it is whole, so df may be read from the file that it replaces.
    """
    from pyspark.sql import functions as F

    numeric = [isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in df.schema.fields]
    ref = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    sizes = df.agg(F.count(F.lit(1)), *[F.max(F.octet_length(F.col(r).cast("string"))) for r, n in zip(ref, numeric, strict=True) if not n]).first()
    longest = iter(sizes[1:])
    widths = [0 if n else max(1, next(longest) or 1) for n in numeric]
    if any(w > MOST_BYTES for w in widths):
        raise ValueError(f"A text is longer than the {MOST_BYTES} bytes that a string variable holds: " + ", ".join(c for c, w in zip(df.columns, widths, strict=True) if w > MOST_BYTES))
    d = fieldmeta.read(df)
    short = [f"V{i:07d}" for i in range(len(df.columns))]
    pack = lambda shape, *x: struct.pack(order + shape, *x)
    code = 2 if compress == "block" else int(bool(compress))
    cells = df.select(*[F.col(r).cast("double" if n else "string").alias(f"c{i}") for i, (r, n) in enumerate(zip(ref, numeric, strict=True))])
    encoded = cells.mapInArrow(_encoder(widths, bool(code), order), "codes binary, data binary")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    part = Path(path).with_name(Path(path).name + ".part")
    with open(part, "wb") as f:
        f.write((b"$FL3" if code == 2 else b"$FL2") + b"@(#) SPSS DATA FILE".ljust(60) + pack("5id", 2, sum(map(_units_of, widths)), code, 0, sizes[0], BIAS))
        f.write(b"01 Jan 2000:00:00" + _label(file_label, 64).ljust(64) + b"   ")
        at: dict[str, int] = {}
        place, more = 1, 0
        for c, whole, s in zip(df.columns, widths, short, strict=True):
            at[c] = place
            for i, w in enumerate(parts(whole)):
                label = _label(d.labels.get(c, ""), 255) if i == 0 else b""
                fmt = _format(d.formats.get(c), w)
                name, more = (s, more) if i == 0 else (f"W{more:07d}", more + 1)
                f.write(pack("6i8s", 2, w, int(bool(label)), 0, fmt, fmt, name.encode()))
                if label:
                    f.write(pack("i", len(label)) + label.ljust((len(label) + 3) // 4 * 4))
                blanks = 0 if w == 0 else max(1, (w + 7) // 8) - 1
                f.write(pack("6i8s", 2, -1, 0, 0, 1 << 16 | 8 << 8, 1 << 16 | 8 << 8, b" " * 8) * blanks)
                place += 1 + blanks
        for c, w in zip(df.columns, widths, strict=True):
            if w == 0 and d.values.get(c):
                f.write(pack("2i", 3, len(d.values[c])))
                for value, text in d.values[c].items():
                    raw = _label(text, 120)
                    f.write(pack("dB", value, len(raw)) + raw.ljust((len(raw) + 8) // 8 * 8 - 1))
                f.write(pack("3i", 4, 1, at[c]))
        record = lambda sub, size, n, data: f.write(pack("4i", 7, sub, size, n) + data)
        record(3, 4, 8, pack("8i", 1, 0, 0, -1, 1, 1, 1 if order == ">" else 2, 65001))
        record(4, 8, 3, pack("3d", MISSING, -MISSING, struct.unpack("<d", bytes.fromhex("feffffffffffefff"))[0]))
        names = "\t".join(f"{s}={c}" for s, c in zip(short, df.columns, strict=True)).encode()
        record(13, 1, len(names), names)
        if very_long := "".join(f"{s}={w:05d}\x00\t" for s, w in zip(short, widths, strict=True) if w > PART).encode():
            record(14, 1, len(very_long), very_long)
        record(20, 1, 5, b"UTF-8")
        f.write(pack("2i", 999, 0))
        out = _BlockWriter(f, order) if code == 2 else f
        packer = _Packer(out)
        for row in encoded.toLocalIterator(prefetchPartitions=True):
            codes, data = map(zlib.decompress, row)
            packer.put(codes, data) if code else out.write(data)
        packer.end()
        if code == 2:
            out.end()
    os.replace(part, path)
    return sizes[0]


class _BlockWriter:
    """Cases in zlib blocks between a header and a trailer that say where they lie."""

    def __init__(self, f: BinaryIO, order: str):
        self.f, self.order, self.begin, self.held, self.blocks, self.done = f, order, f.tell(), bytearray(), [], 0
        f.write(b" " * 24)

    def write(self, raw: bytes) -> None:
        self.held += raw
        while len(self.held) >= BLOCK:
            self._put(BLOCK)

    def _put(self, n: int) -> None:
        packed = zlib.compress(bytes(self.held[:n]))
        self.blocks.append((self.begin + self.done, self.f.tell(), n, len(packed)))
        self.f.write(packed)
        self.done += n
        del self.held[:n]

    def end(self) -> None:
        if self.held:
            self._put(len(self.held))
        at = self.f.tell()
        self.f.write(struct.pack(self.order + "2q2i", int(-BIAS), 0, BLOCK, len(self.blocks)) + b"".join(struct.pack(self.order + "2q2i", *b) for b in self.blocks))
        end = self.f.tell()
        self.f.seek(self.begin)
        self.f.write(struct.pack(self.order + "3q", self.begin, at, end - at))
        self.f.seek(end)


def _numbers(cells: pa.Array, order: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytecodes, units) of numbers."""
    x = cells.to_numpy(zero_copy_only=False).astype(np.float64)
    missing = np.isnan(x)
    x = np.where(missing, MISSING, x)
    code = np.where(np.abs(x) < 1000, x, 0.5) + BIAS
    fits = (code == np.trunc(code)) & (code >= 1) & (code <= 251) & ~((x == 0) & np.signbit(x)) & (code - BIAS == x)
    return np.where(missing, 255, np.where(fits, code, 253)).astype(np.uint8), x.astype(order + "f8").view(np.uint64)


def _strings(cells: pa.Array, width: int) -> np.ndarray:
    """The units of texts, a row of them per text."""
    n, units, k = len(cells), _units_of(width), len(parts(width))
    cells = cells.cast(pa.large_string()).fill_null("")
    _, offsets, data = cells.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, 8 * cells.offset)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    sizes = np.diff(ends)
    if n and sizes.max() > width:
        raise ValueError("A text is longer than it was when the widths of texts were counted.")
    raw = np.full((n, PART * k if k > 1 else 8 * units), 32, np.uint8)
    raw[np.arange(raw.shape[1]) < sizes[:, None]] = data
    if k > 1:
        raw = np.pad(raw.reshape(n, k, PART), ((0, 0), (0, 0), (0, -PART % 8)), constant_values=32).reshape(n, -1)[:, : 8 * units]
    return np.ascontiguousarray(raw).view(np.uint64).reshape(n, units)


def _encoder(widths: list[int], compress: bool, order: str):
    """What a task does: bytecodes of all units (none uncompressed), and the units that are data, per some cases."""
    most = max(1, BATCH // (8 * sum(map(_units_of, widths)) or 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)):
            codes, units = [], []
            for cells, w in zip(batch.columns, widths, strict=True):
                if w == 0:
                    code, unit = (x[:, None] for x in _numbers(cells, order))
                else:
                    unit = _strings(cells, w)
                    code = np.where(unit == _BLANKS, 254, 253).astype(np.uint8)
                codes.append(code)
                units.append(unit)
            code, unit = np.concatenate(codes, 1), np.concatenate(units, 1)
            made = (code.tobytes(), unit[code == 253].tobytes()) if compress else (b"", unit.tobytes())
            # Zipped, a partition is about as large for the driver as it was in a shuffle.
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(x, 1)], pa.binary()) for x in made], names=["codes", "data"])

    return run


class _Packer:
    """Writes bytecodes in groups of eight, each before its data, however they come."""

    def __init__(self, f: BinaryIO | _BlockWriter):
        self.f, self.codes, self.data = f, b"", b""

    def put(self, codes: bytes, data: bytes) -> None:
        codes, data = self.codes + codes, self.data + data
        n = len(codes) // 8
        groups = np.frombuffer(codes, np.uint8, 8 * n).reshape(n, 8)
        filled = np.count_nonzero(groups == 253, axis=1)
        used = int(filled.sum())
        places = np.arange(n) + np.cumsum(filled) - filled
        out, is_data = np.empty(n + used, np.uint64), np.ones(n + used, bool)
        is_data[places] = False
        out[places] = groups.reshape(-1).view(np.uint64)
        out[is_data] = np.frombuffer(data, np.uint64, used)
        self.f.write(out.tobytes())
        self.codes, self.data = codes[8 * n :], data[8 * used :]

    def end(self) -> None:
        if self.codes:
            self.put(b"\xfc".ljust(8 - len(self.codes), b"\0"), b"")
