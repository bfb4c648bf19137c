"""SAS transport files (XPORT, version 5) as a Spark data source.

``spark.read.format("xport").load(path)`` reads a file, a folder of ``.xpt``
files or several of them; ``df.write.format("xport").save(folder)`` writes one
file per partition. The layout is the published one: 80-byte cards; library,
member and descriptor headers; one NAMESTR of 140 bytes per variable; rows of
fixed width one after the other, padded with blanks to a whole card.

* Numbers are base-16 floating point (sign, 7-bit exponent, 56-bit fraction) of
  2 to 8 bytes, decoded and encoded a column at a time in numpy. A number from a
  double comes back equal, from 16**-65 up to below 16**63; below that the
  fraction is shortened, above it writing fails. The missing codes ``.``,
  ``._`` and ``.A`` to ``.Z`` are null.
* Text has a fixed width; trailing blanks go, blank text is null (the format has
  no other missing text).
* A file is read in byte ranges: a range takes the rows that begin in it and
  reads on to the end of its last one, so rows may straddle ranges. Only the
  header is read on the driver, and every task reads the header of its own file.
* A short or otherwise malformed file raises ``XportError``; ``load_module``
  takes that (and a missing file) for an absent module.
* One member per file, as survey modules have; a second one is an error.

Paths are opened with ``pyarrow.fs`` (local paths, ``file:``, ``hdfs:``, ``s3:``,
``gs:``).

Options: ``rangeBytes`` (read; 64 MB), ``encoding`` (utf-8), ``textWidth``
(write; bytes per text column, 200 at most), ``member`` (write; the data set's
name).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from ..session import ship_package

# FIXED VALUES of the published format.
CARD = 80
NAMESTR = 140
LIBRARY = b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000  "
MEMBER = b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140  "
DESCRIPTOR = b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000  "
VARIABLES = b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000%04d00000000000000000000  "
ROWS = b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000  "
MISSING = b"._ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_TEXT = 200
MOST_NAME = 8
STAMP = b"01JAN00:00:00:00"  # of created and modified: the same files in every run

RANGE_BYTES = 64 << 20
BATCH_ROWS = 1 << 15


class XportError(ValueError):
    """The file is not a whole XPORT version 5 file."""


# ------------------------------------------------------------------ numbers

def decode_numbers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, missing) of a (rows, width) array of bytes, width 2 to 8."""
    rows, width = raw.shape
    full = np.zeros((rows, 8), dtype=np.uint8)
    full[:, :width] = raw
    bits = full.view(">u8").ravel().astype(np.uint64)
    fraction = bits & np.uint64((1 << 56) - 1)
    first = full[:, 0]
    missing = (fraction == 0) & np.isin(first, np.frombuffer(MISSING, np.uint8))
    exponent = (first & 0x7F).astype(np.int64) - 64
    values = np.ldexp(fraction.astype(np.float64), 4 * exponent - 56)
    return np.where(first & 0x80, -values, values), missing


def encode_numbers(values: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """(rows, 8) bytes of doubles; ``missing`` rows become the code ``.``."""
    values = np.where(missing, 0.0, values)
    if not np.isfinite(values).all():
        raise ValueError("infinite values have no XPORT form")
    mantissa, power = np.frexp(np.abs(values))  # value = mantissa * 2**power, mantissa in [0.5, 1)
    exponent = -(-power // 4)
    exponent[mantissa == 0] = -64
    if (exponent > 63).any():
        raise ValueError("a value is too large for XPORT (16**63)")
    short = np.maximum(-64 - exponent, 0)  # digits that no exponent is left for
    fraction = np.rint(np.ldexp(mantissa, 56 + power - 4 * (exponent + short))).astype(np.uint64)
    sign = np.signbit(values) & (fraction > 0)
    bits = (sign.astype(np.uint64) << np.uint64(63)) | ((exponent + short + 64).astype(np.uint64) << np.uint64(56)) | fraction
    bits[fraction == 0] = 0
    out = bits.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[missing] = np.frombuffer(b".\0\0\0\0\0\0\0", np.uint8)
    return out


# ------------------------------------------------------------------ layout

@dataclass(frozen=True)
class Variable:
    name: str
    numeric: bool
    width: int
    at: int


@dataclass(frozen=True)
class Layout:
    variables: tuple[Variable, ...]
    begin: int  # byte of the first row
    row: int    # bytes of a row

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(v.name, T.DoubleType() if v.numeric else T.StringType()) for v in self.variables])


def _number(raw: bytes, lo: int, size: int) -> int:
    return int.from_bytes(raw[lo:lo + size], "big", signed=True)


def read_layout(f) -> Layout:
    """The variables of an open file, from its header cards."""
    head = f.read(CARD * 8)
    cards = [head[i:i + CARD] for i in range(0, len(head), CARD)]
    found = re.match(rb"HEADER RECORD\*{7}NAMESTR HEADER RECORD!{7}\d{6}(\d{4})", cards[-1]) if len(head) == CARD * 8 else None
    size = re.match(rb"HEADER RECORD\*{7}MEMBER  HEADER RECORD!{7}\d{26}(\d{4})", cards[3]) if found else None
    if not found or not size or cards[0] != LIBRARY or cards[4] != DESCRIPTOR:
        raise XportError("not an XPORT version 5 file")
    count, width = int(found[1]), int(size[1])
    length = -(-count * width // CARD) * CARD
    raw = f.read(length + CARD)
    if not count or width < NAMESTR - 4 or len(raw) < length + CARD or raw[length:length + 27] != ROWS[:27]:
        raise XportError("its variables are cut off or none")
    variables = []
    for k in range(count):
        one = raw[k * width:(k + 1) * width]
        kind, bytes_, at = _number(one, 0, 2), _number(one, 4, 2), _number(one, 84, 4)
        name = one[8:16].decode("ascii", "replace").rstrip()
        if kind not in (1, 2) or bytes_ < 1 or at < 0 or (kind == 1 and not 2 <= bytes_ <= 8):
            raise XportError(f"variable {name} has no valid description")
        variables.append(Variable(name, kind == 1, bytes_, at))
    row = max(v.at + v.width for v in variables)
    return Layout(tuple(variables), CARD * 8 + length + CARD, row)


def write_layout(variables: list[Variable], member: str) -> bytes:
    """The header cards of a file with these variables."""
    name = member.encode("ascii").ljust(8)
    sas, gap = b"SAS     ", b" " * 24
    out = [LIBRARY, sas + sas + b"SASLIB  " + b"9.4     " + b" " * 8 + gap + STAMP, STAMP.ljust(CARD),
           MEMBER, DESCRIPTOR, sas + name + b"SASDATA " + b"9.4     " + b" " * 8 + gap + STAMP, STAMP.ljust(CARD),
           VARIABLES % len(variables)]
    described = b"".join(
        (1 if v.numeric else 2).to_bytes(2, "big") + bytes(2) + v.width.to_bytes(2, "big") + k.to_bytes(2, "big")
        + v.name.encode("ascii").ljust(8) + b" " * 40 + b" " * 8 + bytes(6) + bytes(2) + b" " * 8 + bytes(4)
        + v.at.to_bytes(4, "big") + bytes(52) for k, v in enumerate(variables, 1))
    out += [described.ljust(-(-len(described) // CARD) * CARD), ROWS]
    return b"".join(out)


def row_count(f, layout: Layout, size: int) -> int:
    """Whole rows of a file of ``size`` bytes. The blanks that fill the last card
    are no rows: rows of blanks alone at the end count only as far as they reach
    beyond that card."""
    body = size - layout.begin
    if body < 0 or size % CARD:
        raise XportError("its last card is cut off")
    rows, rest = divmod(body, layout.row)
    if rest >= CARD:
        raise XportError("its last row is cut off")
    tail_from = max(layout.begin, size - CARD + 1)  # the fill is shorter than a card
    first = (tail_from - layout.begin) // layout.row  # the first row that may lie in the fill
    f.seek(layout.begin + first * layout.row)
    tail = f.read(size - layout.begin - first * layout.row)
    if tail[len(tail) - rest:].strip(b" "):
        raise XportError("its last row is cut off")
    while rows > 0 and size - (layout.begin + (rows - 1) * layout.row) < CARD:
        at = (rows - 1 - first) * layout.row
        if tail[at:at + layout.row].strip(b" "):
            break
        rows -= 1
    return rows


# ------------------------------------------------------------------ files

def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _is_part(info: pafs.FileInfo) -> bool:
    """Whether a file of a folder is data: hidden ones belong to a running or failed job."""
    name = info.path.rsplit("/", 1)[-1].lower()
    return info.type == pafs.FileType.File and name.endswith(".xpt") and not name.startswith(("_", "."))


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of a folder's ``.xpt`` files, by name."""
    store, at = open_store(path)
    info = store.get_file_info(at)
    if info.type == pafs.FileType.File:
        found = [info]
    elif info.type == pafs.FileType.Directory:
        found = [i for i in store.get_file_info(pafs.FileSelector(at)) if _is_part(i)]
    else:
        found = []
    if not found:
        raise FileNotFoundError(f"no XPORT file at {path}")
    prefix = path[:len(path) - len(at)] if path.endswith(at) else ""
    return sorted((prefix + i.path, i.size) for i in found)


def check_file(path: str) -> Layout:
    """The layout of a file or of a folder's first file; every file's header and
    end are read, so that a file cut short is found before any task runs."""
    layout = None
    for one, size in list_files(path):
        store, at = open_store(one)
        with store.open_input_file(at) as f:
            mine = read_layout(f)
            row_count(f, mine, size)
        layout = layout or mine
        if mine.schema() != layout.schema():
            raise XportError(f"{one} has other variables than the first file")
    return layout


# ------------------------------------------------------------------ reading

@dataclass
class Range(InputPartition):
    path: str
    size: int
    lo: int
    hi: int


class XportReader(DataSourceReader):
    def __init__(self, paths: list[str], schema: T.StructType, options: dict):
        self.paths, self.columns, self.encoding = paths, schema.names, options.get("encoding", "utf-8")
        self.bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        return [Range(p, size, lo, min(lo + self.bytes, size))
                for path in self.paths for p, size in list_files(path) for lo in range(0, size, self.bytes)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, at = open_store(partition.path)
        with store.open_input_file(at) as f:
            layout = read_layout(f)
            where = {v.name: v for v in layout.variables}
            lost = [c for c in self.columns if c not in where]
            if lost:
                raise XportError(f"{partition.path} has no variable {', '.join(lost)}")
            rows = row_count(f, layout, partition.size)

            def first(byte: int) -> int:  # the first row that begins at or after a byte
                return min(rows, max(0, -(-(byte - layout.begin) // layout.row)))

            lo, hi = first(partition.lo), first(partition.hi)
            for start in range(lo, hi, BATCH_ROWS):
                n = min(BATCH_ROWS, hi - start)
                f.seek(layout.begin + start * layout.row)
                raw = f.read(n * layout.row)
                if len(raw) < n * layout.row:
                    raise XportError(f"{partition.path} ends before its last row")
                if MEMBER[:47] in raw:
                    raise XportError(f"{partition.path} holds more than one member")
                cells = np.frombuffer(raw, np.uint8).reshape(n, layout.row)
                yield pa.RecordBatch.from_arrays(
                    [self._column(where[c], cells) for c in self.columns], names=self.columns)

    def _column(self, v: Variable, cells: np.ndarray) -> pa.Array:
        own = np.ascontiguousarray(cells[:, v.at:v.at + v.width])
        if v.numeric:
            values, missing = decode_numbers(own)
            return pa.array(values, mask=missing)
        texts = [x.rstrip(b" \0").decode(self.encoding) for x in own.view(f"S{v.width}").ravel().tolist()]
        return pa.array([x or None for x in texts], pa.string())


# ------------------------------------------------------------------ writing

@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class XportWriter(DataSourceArrowWriter):
    """One file per partition, written under a hidden name and renamed when all
    tasks are done; a failed or repeated task leaves no file behind."""

    def __init__(self, path: str, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.encoding, width = options.get("encoding", "utf-8"), int(options.get("textwidth", MOST_TEXT))
        self.member = options.get("member", "DATA").upper()
        if not 1 <= width <= MOST_TEXT:
            raise ValueError(f"textWidth must be 1 to {MOST_TEXT}")
        if not re.fullmatch("[A-Z_][A-Z0-9_]{0,7}", self.member):
            raise ValueError(f"{self.member} is no member name")
        self.variables, at = [], 0
        for f in schema.fields:
            numeric = isinstance(f.dataType, (T.NumericType, T.BooleanType))
            if not numeric and not isinstance(f.dataType, T.StringType):
                raise ValueError(f"column {f.name}: XPORT holds numbers and text only")
            if len(f.name) > MOST_NAME or not f.name.isascii():
                raise ValueError(f"column {f.name}: names have {MOST_NAME} ASCII characters at most")
            self.variables.append(Variable(f.name, numeric, 8 if numeric else width, at))
            at += self.variables[-1].width
        if not self.variables or len(self.variables) > 9999:
            raise ValueError("XPORT holds 1 to 9999 columns")
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        name, rows, size = f"part-{uuid.uuid4().hex}.xpt", 0, 0
        with store.open_output_stream(f"{folder}/_{name}") as f:
            size += f.write(write_layout(self.variables, self.member))
            for b in iterator:
                cells = np.concatenate([self._cells(v, b.column(k)) for k, v in enumerate(self.variables)], axis=1)
                f.write(cells.tobytes())
                rows, size = rows + b.num_rows, size + cells.size
            f.write(b" " * (-size % CARD))
        return Written(name, rows)

    def _cells(self, v: Variable, column: pa.Array) -> np.ndarray:
        if v.numeric:
            values = column.cast(pa.float64())
            missing = np.array(values.is_null(nan_is_null=True))
            return encode_numbers(values.fill_null(0.0).to_numpy(zero_copy_only=False), missing)
        rows = [(x or "").encode(self.encoding) for x in column.to_pylist()]
        if max(map(len, rows), default=0) > v.width:
            raise ValueError(f"column {v.name}: a text is longer than {v.width} bytes (textWidth)")
        return np.frombuffer(b"".join(x.ljust(v.width) for x in rows), np.uint8).reshape(len(rows), v.width)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = open_store(self.path)
        old = [i.path for i in store.get_file_info(pafs.FileSelector(folder)) if _is_part(i)] if self.overwrite else []
        for k, m in enumerate(m for m in messages if m is not None):
            store.move(f"{folder}/_{m.path}", f"{folder}/part-{self.job}-{k:05d}.xpt")
        for path in old:
            store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = open_store(self.path)
        for m in messages:
            if m is not None and store.get_file_info(f"{folder}/_{m.path}").type == pafs.FileType.File:
                store.delete_file(f"{folder}/_{m.path}")


class XportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xport"

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("xport needs a path")
        return self.options["path"]

    def schema(self) -> T.StructType:
        return check_file(self._path()).schema()

    def reader(self, schema: T.StructType) -> XportReader:
        return XportReader([self._path()], schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> XportWriter:
        return XportWriter(self._path(), schema, dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("xport")`` known to the session."""
    ship_package(spark)
    spark.dataSource.register(XportSource)
