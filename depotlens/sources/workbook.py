"""Spreadsheet workbooks (zipped OOXML) as a Spark data source: ``spark.read.format("workbook")``.

Reading. Every workbook of a file or folder is cut into ranges of ``rows_per_partition`` sheet rows, one task each. A
task inflates the sheet's part as a stream, passes over the rows before its range without parsing them, and parses its
own rows a few thousand at a time. Text in the shared table is resolved in the task. The last range has no end, so a
sheet whose stated size is wrong loses no row. Rows without references and attributes, as this module writes them, are
counted and read by column; whatever looks different is read cell by cell, with the same values.

Writing. Every task writes workbooks of at most ``rows_per_file`` rows, with the text written inline, under names of
their own; the job's commit gives them their final names. Cells are formatted by column.

Types are declared, never inferred: pass a schema whose fields name the columns by their header (a field that is not
in the sheet is null; without a schema every column of the first workbook is text). A cell that does not fit its declared
type is null, and the row's cells as text stand in ``_corrupt_record`` if the schema has such a field; with
``mode`` FAILFAST it is an error. Dates are day numbers in the workbook's date system, rounded to the millisecond.
Numbers read as text have no trailing ``.0``. Empty cells are null, and so are error values.

Options: ``sheet`` (name, default the first), ``rows_per_partition``, ``rows_per_file``, ``mode``. Paths are those of
Arrow's file systems (local, s3, gs, hdfs) and must be reachable from every executor.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation
from typing import Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape, unescape

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

CORRUPT = "_corrupt_record"
SHEET_ROWS = 1_048_576  # the format's limit
MILLIS = 86_400_000

# Names of the file format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


# -- parts of a workbook --------------------------------------------------------------------------


def _open(path: str) -> zipfile.ZipFile:
    files, inner = _files_of(path)
    return zipfile.ZipFile(files.open_input_file(inner))


def _files_of(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


@dataclass(frozen=True)
class Sheet:
    """Where a sheet's rows are, how many it says it has, and the first day of the date system."""

    part: str
    rows: int
    epoch_1904: bool


def find_sheet(book: zipfile.ZipFile, name: str | None) -> Sheet:
    main = "xl/workbook.xml"
    for relation in ElementTree.fromstring(book.read("_rels/.rels")):
        if relation.get("Type", "").endswith("/officeDocument"):
            main = posixpath.normpath(relation.get("Target").lstrip("/"))
    root = ElementTree.fromstring(book.read(main))
    folder, _, base = main.rpartition("/")
    relations = ElementTree.fromstring(book.read(f"{folder}/_rels/{base}.rels"))
    targets = {r.get("Id"): r.get("Target") for r in relations}
    sheets, epoch_1904 = [], False
    for element in root.iter():
        if _local(element.tag) == "sheet":
            key = next(v for k, v in element.attrib.items() if _local(k) == "id" and k != "sheetId")
            sheets.append((element.get("name"), targets[key]))
        elif _local(element.tag) == "workbookPr":
            epoch_1904 = element.get("date1904") in ("1", "true")
    chosen = [target for title, target in sheets if name is None or title == name]
    if not chosen:
        raise ValueError(f"no sheet {name!r}; there are {[title for title, _ in sheets]}")
    target = chosen[0]
    part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
    with book.open(part) as stream:
        stated = re.search(rb'<(?:\w+:)?dimension\s[^>]*ref="[A-Z]+\d+:[A-Z]+(\d+)"', stream.read(1 << 16))
    return Sheet(part, int(stated.group(1)) if stated else 0, epoch_1904)


def shared_texts(book: zipfile.ZipFile) -> list[str]:
    """The shared text table; phonetic hints are left out."""
    name = next((n for n in book.namelist() if n.lower() == "xl/sharedstrings.xml"), None)
    if name is None:
        return []
    texts = []
    with book.open(name) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) == "si":
                texts.append(_text_of(element))
                element.clear()
    return texts


def _text_of(element: ElementTree.Element) -> str:
    """The text of a plain or rich text element."""
    out = []
    for child in element:
        kind = _local(child.tag)
        if kind == "t":
            out.append(child.text or "")
        elif kind == "r":
            out.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(out))


_ROW = re.compile(rb"<(?:\w+:)?row(?=[\s/>])([^>]*?)(/?)>")
_NUMBER = re.compile(rb'(?:^|\s)r="(\d+)"')


_ROW_END = re.compile(rb"</(?:\w+:)?row\s*>")


def sheet_rows(stream, first: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(number, inner XML) of the sheet's rows from ``first`` up to ``end``; others are passed over unparsed."""
    for number, rows in sheet_blocks(stream, first, end):
        yield from enumerate(rows, number) if isinstance(rows, list) else [(number, rows)]


def sheet_blocks(stream, first: int, end: int | None) -> Iterator[tuple[int, list[bytes] | bytes]]:
    """The same, with stretches of plain rows as (number of the first, list of rows)."""
    held, number, done = b"", 0, False
    while not done:
        data = stream.read(1 << 20)
        done = not data
        held += data
        at = held.find(b"<row>")
        last = held.rfind(b"</row>") + 6
        # Rows without attributes are numbered one after another, and need not be looked at to be passed over.
        if 0 <= at < last and not _ROW.search(held, 0, at) and (count := _plain_rows(held, at, last)):
            if number + count >= first:
                rows = [r[r.index(b"<row>") + 5 :] for r in held[at:last].split(b"</row>")[:-1]]
                a, b = max(0, first - number - 1), count if end is None else min(count, end - number - 1)
                if a < b:
                    yield number + 1 + a, rows[a:b]
            number += count
            if end is not None and number + 1 >= end:
                return
            held = held[last:]
        at = 0
        while True:
            tag = _ROW.search(held, at)
            if not tag:
                # Keep what may be the beginning of a tag.
                at = max(at, held.rfind(b"<"))
                break
            close = None if tag[2] else _ROW_END.search(held, tag.end())
            if not tag[2] and not close:
                at = tag.start()
                break
            stated = _NUMBER.search(tag[1])
            here = int(stated[1]) if stated else number + 1
            if end is not None and here >= end:
                return
            number, at = here, (close or tag).end()
            if close and here >= first:
                yield here, held[tag.end() : close.start()]
        held = held[at:]


def _plain_rows(data: bytes, start: int, end: int) -> int:
    """The number of rows in a part of a sheet if none has attributes or a prefix, else 0."""
    count = data.count(b"<row>", start, end)
    if data.count(b"</row>", start, end) != count or data.count(b"<row", start, end) != count:
        return 0
    return 0 if data.find(b":row", start, end) >= 0 else count


_TAG = re.compile(rb"(</?)\w+:(?=\w)")
_QUALIFIED = re.compile(rb'\s\w+:\w+="[^"]*"')


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def cells_of(rows: list[bytes], texts: list[str]) -> Iterator[dict[int, tuple[str, str]]]:
    """Per row its cells: column number to (kind, text)."""
    # Without name spaces, so that a fragment of the sheet can be parsed by itself.
    plain = b"".join(b"<row>" + _QUALIFIED.sub(b"", _TAG.sub(rb"\1", r)) + b"</row>" for r in rows)
    for row in ElementTree.fromstring(b"<rows>" + plain + b"</rows>"):
        cells, column = {}, -1
        for cell in row:
            if cell.tag != "c":
                continue
            reference, kind = cell.get("r"), cell.get("t", "n")
            column = _column(reference) if reference else column + 1
            value = cell.findtext("v")
            if kind == "inlineStr":
                inner = cell.find("is")
                value = _text_of(inner) if inner is not None else None
            elif kind == "s" and value is not None:
                value = texts[int(value)]
            if value is not None and kind != "e":
                cells[column] = (kind, value)
        yield cells


# -- values ---------------------------------------------------------------------------------------


def _moment(value: str, kind: str, epoch_1904: bool) -> datetime:
    if kind == "d":
        return datetime.fromisoformat(value.replace("Z", ""))
    if kind != "n":
        return datetime.fromisoformat(value.strip())
    days = float(value)
    if epoch_1904:
        first = datetime(1904, 1, 1)
    else:
        # The 1900 system counts a 29 February 1900 that did not exist.
        first = datetime(1899, 12, 30) if days >= 60 else datetime(1899, 12, 31)
    return first + timedelta(milliseconds=round(days * MILLIS))


def convert(kind: str, value: str, target: T.DataType, epoch_1904: bool = False) -> Any:
    """A cell as a value of the declared type; raises ValueError if it is none."""
    if isinstance(target, T.StringType):
        if kind == "n":
            number = float(value)
            return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
        return {"1": "true", "0": "false"}.get(value, value) if kind == "b" else value
    if isinstance(target, T.BooleanType):
        known = {"1": True, "true": True, "0": False, "false": False}.get(value.strip().lower())
        if known is None:
            raise ValueError(value)
        return known
    if isinstance(target, T.TimestampType):
        return _moment(value, kind, epoch_1904).replace(tzinfo=timezone.utc)
    if isinstance(target, T.TimestampNTZType):
        return _moment(value, kind, epoch_1904)
    if isinstance(target, T.DateType):
        return _moment(value, kind, epoch_1904).date()
    if isinstance(target, T.DecimalType):
        try:
            # The shortest text of the stored double is the number that was typed in.
            number = Decimal(repr(float(value))) if kind == "n" else Decimal(value.strip())
            return number.quantize(Decimal(1).scaleb(-target.scale))
        except InvalidOperation as error:
            raise ValueError(value) from error
    number = float(value)
    if isinstance(target, T.FractionalType):
        return number
    limit = {"byte": 7, "short": 15, "integer": 31, "long": 63}[target.typeName()]
    if not number.is_integer() or not -(2**limit) <= number < 2**limit:
        raise ValueError(value)
    return int(value) if re.fullmatch(r"-?\d+", value) else int(number)


# -- columns of plain rows ------------------------------------------------------------------------


class NotPlain(Exception):
    """The rows have something that is to be read cell by cell."""


#: How a plain cell begins, and the letter of its kind.
_BEGINS = {
    b'<c t="inlineStr"><is><t xml:space="preserve">': b"i", b'<c t="inlineStr"><is><t>': b"i", b"<c><v>": b"n", b'<c t="d"><v>': b"d", b'<c t="b"><v>': b"b",
}
_KINDS = {"i": "inlineStr", "n": "n", "d": "d", "b": "b"}
_ENTITY = re.compile(rb"&(?!amp;|lt;|gt;)")
_HEX = re.compile(r"_x([0-9A-Fa-f]{4})_")


def plain_columns(rows: list[bytes]) -> list[pa.Array]:
    """Per column its cells: the letter of the kind and the text, null for an empty cell."""
    # Control characters cannot stand in a sheet: 2 begins a cell, 3 ends a row, 4 ends a value.
    body = b"\x02\x03".join(rows) + b"\x02\x03"
    if b"\r" in body or (b"&" in body and _ENTITY.search(body)):
        raise NotPlain
    for begin, letter in _BEGINS.items():
        body = body.replace(begin, b"\x02" + letter)
    body = body.replace(b"</v></c>", b"\x04").replace(b"</t></is></c>", b"\x04").replace(b"<c/>", b"\x02")
    width = body.count(b"\x02", 0, body.index(b"\x03")) - 1
    parts = pc.split_pattern(pa.array([body.decode()], pa.large_string()), "\x02").values
    step = width + 1
    if b"<" in body or not width or body[:1] != b"\x02" or len(parts) != len(rows) * step + 1:
        raise NotPlain
    first = pa.array(range(0, len(rows) * step, step), pa.int64())
    # The last column are the ends of rows, so every row has all the others.
    ends = parts.take(pc.add(first, step))
    if pc.all(pc.starts_with(ends, "\x03")).as_py() is False or pc.max(pc.binary_length(ends)).as_py() > 1:
        raise NotPlain
    out = []
    for j in range(width):
        column = parts.take(pc.add(first, j + 1))
        full = pc.ends_with(column, "\x04")
        if not pc.all(full).as_py():
            empty = pc.equal(column, "")
            if not pc.all(pc.or_(full, empty)).as_py():
                raise NotPlain  # something between the cells
            column = pc.if_else(empty, pa.scalar(None, column.type), column)
        out.append(pc.utf8_rtrim(column, "\x04"))
    return out


def _plain_text(text: str) -> str:
    return _HEX.sub(lambda m: chr(int(m[1], 16)), unescape(text))


def plain_array(column: pa.Array, target: T.DataType, arrow: pa.DataType, epoch_1904: bool) -> pa.Array:
    """A column's cells as values of the declared type, the same as ``convert`` makes of each."""
    kinds = set(pc.unique(pc.utf8_slice_codeunits(column, 0, 1)).drop_null().to_pylist())
    texts = pc.utf8_slice_codeunits(column, 1)
    if not kinds:
        return pa.nulls(len(column), arrow)
    if kinds != {"i"} and pc.any(pc.or_(pc.equal(texts, ""), pc.match_substring(texts, "&"))).as_py():
        raise NotPlain
    if kinds == {"i"} and isinstance(target, T.StringType):
        odd = pc.or_(pc.match_substring(texts, "&"), pc.match_substring(texts, "_x"))
        if pc.any(odd).as_py():
            texts = pa.array([_plain_text(t) if o else t for t, o in zip(texts.to_pylist(), odd.to_pylist())], pa.large_string())
        return texts.cast(arrow)
    shape, through = None, arrow
    if kinds == {"n"}:
        # Up to 15 digits are kept by a double, and text and number have one spelling.
        if isinstance(target, T.StringType):
            shape = r"^(0|-?[1-9][0-9]{0,14})$"
        elif isinstance(target, T.IntegralType):
            shape = r"^(0|-?[1-9][0-9]{0,17})$"
        elif isinstance(target, T.DoubleType):
            shape = r"^(0|-?[1-9][0-9]{0,14}|-?[0-9]{1,11}\.[0-9]{1,4})$"
        elif isinstance(target, T.DecimalType):
            shape = r"^-?[0-9]{1,11}" + (rf"(\.[0-9]{{1,{min(4, target.scale)}}})?$" if target.scale else "$")
    elif kinds == {"d"}:
        if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
            shape, through = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$", pa.timestamp("us")
        elif isinstance(target, T.DateType):
            shape = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"
    if shape and pc.all(pc.match_substring_regex(texts, shape)).as_py():
        try:
            found = texts.cast(through)
            return pc.assume_timezone(found, "UTC").cast(arrow) if isinstance(target, T.TimestampType) else found
        except pa.ArrowInvalid as error:
            raise NotPlain from error
    out = []
    for cell in column.to_pylist():
        if cell is not None:
            kind, value = _KINDS[cell[0]], cell[1:]
            try:
                cell = convert(kind, _plain_text(value) if kind == "inlineStr" else value, target, epoch_1904)
            except (ValueError, OverflowError) as error:
                raise NotPlain from error
        out.append(cell)
    return pa.array(out, arrow)


# -- the data source ------------------------------------------------------------------------------


@dataclass
class RowRange(InputPartition):
    path: str
    sheet: Sheet
    first: int
    end: int | None

    def __post_init__(self):
        super().__init__(None)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> T.StructType:
        path = _workbooks(self.options["path"])[0]
        with _open(path) as book:
            header = _header(book, find_sheet(book, self.options.get("sheet")))
        return T.StructType([T.StructField(name, T.StringType()) for _, name in sorted(header.items())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WorkbookReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WorkbookWriter(dict(self.options), schema, overwrite)


def _workbooks(path: str) -> list[str]:
    files, inner = _files_of(path)
    info = files.get_file_info(inner)
    if info.type == pyarrow.fs.FileType.Directory:
        inside = files.get_file_info(pyarrow.fs.FileSelector(inner, recursive=True))
        found = sorted(i.path for i in inside if i.path.endswith((".xlsx", ".xlsm")) and not i.base_name.startswith((".", "_", "~")))
    else:
        found = [inner] if info.type == pyarrow.fs.FileType.File else []
    if not found:
        raise FileNotFoundError(f"no workbook at {path}")
    scheme = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    return [scheme + f for f in found]


def _header(book: zipfile.ZipFile, sheet: Sheet) -> dict[int, str]:
    """Column number to name, by the sheet's first row."""
    with book.open(sheet.part) as stream:
        first = next(sheet_rows(stream, 1, None), None)
    if first is None:
        return {}
    needs_shared = b't="s"' in first[1]
    cells = next(cells_of([first[1]], shared_texts(book) if needs_shared else []))
    return {column: value for column, (_, value) in cells.items()}


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.fields = options, schema
        self.failfast = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"

    def partitions(self) -> list[RowRange]:
        step, out = int(self.options.get("rows_per_partition", 100_000)), []
        for path in _workbooks(self.options["path"]):
            with _open(path) as book:
                sheet = find_sheet(book, self.options.get("sheet"))
            firsts = range(1, max(sheet.rows, 1) + 1, step)
            out.extend(RowRange(path, sheet, a, a + step if a + step <= sheet.rows else None) for a in firsts)
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.fields)
        with _open(partition.path) as book:
            columns = {name: at for at, name in _header(book, partition.sheet).items()}
            texts = shared_texts(book)
            places = [(field, columns.get(field.name)) for field in self.fields]
            epoch_1904 = partition.sheet.epoch_1904
            header_seen = partition.first > 1

            def by_cell(rows: list[bytes]) -> Iterator[pa.RecordBatch]:
                for at in range(0, len(rows), 4096):
                    made = list(zip(*self._rows(rows[at : at + 4096], texts, places, epoch_1904)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, arrow)], schema=arrow)

            def by_column(rows: list[bytes]) -> pa.RecordBatch:
                found = plain_columns(rows)
                made = [
                    pa.nulls(len(rows), kind.type)
                    if at is None or at >= len(found)
                    else plain_array(found[at], field.dataType, kind.type, epoch_1904)
                    for (field, at), kind in zip(places, arrow)
                ]
                return pa.RecordBatch.from_arrays(made, schema=arrow)

            with book.open(partition.sheet.part) as stream:
                held: list[bytes] = []
                for _, rows in sheet_blocks(stream, partition.first, partition.end):
                    single = isinstance(rows, bytes)
                    if not header_seen:
                        header_seen = True  # the first row there is, whatever its number
                        if single or len(rows) == 1:
                            continue
                        rows = rows[1:]
                    if held and (not single or len(held) == 4096):
                        yield from by_cell(held)
                        held = []
                    if single:
                        held.append(rows)
                        continue
                    try:
                        yield by_column(rows)
                    except NotPlain:
                        yield from by_cell(rows)
                if held:
                    yield from by_cell(held)

    def _rows(self, held: list[bytes], texts: list[str], places: list, epoch_1904: bool) -> Iterator[tuple]:
        for cells in cells_of(held, texts):
            values, broken = [], False
            for field, at in places:
                cell = cells.get(at)
                try:
                    values.append(None if cell is None else convert(*cell, field.dataType, epoch_1904))
                except (ValueError, OverflowError):
                    if self.failfast:
                        raise
                    broken = True
                    values.append(None)
            if broken:
                raw = json.dumps([cells[c][1] if c in cells else None for c in range(max(cells) + 1)], ensure_ascii=False)
                values = [raw if field.name == CORRUPT else v for (field, _), v in zip(places, values)]
            yield tuple(values)


@dataclass
class WrittenFiles(WriterCommitMessage):
    paths: list[str]


class WorkbookWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.most = min(int(options.get("rows_per_file", 100_000)), SHEET_ROWS - 1)
        self.names = [field.name for field in schema]
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        files, folder = _files_of(self.path)
        files.create_dir(folder, recursive=True)
        written: list[str] = []
        for held in _stretches(iterator, self.most):  # a file states its size before its rows
            name = f"{folder}/_{self.job}-{uuid.uuid4().hex}.xlsx"
            written.append(name)
            with files.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
                _write_workbook(book, self.names, held)
        return WrittenFiles(written)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        files, folder = _files_of(self.path)
        files.create_dir(folder, recursive=True)
        old = []
        if self.overwrite:
            inside = files.get_file_info(pyarrow.fs.FileSelector(folder))
            old = [i.path for i in inside if i.path.endswith(".xlsx") and not i.base_name.startswith("_")]
        made = sorted(path for message in messages if message for path in message.paths)
        for i, path in enumerate(made):
            files.move(path, f"{folder}/part-{i:05d}-{self.job}.xlsx")
        for path in old:
            files.delete_file(path)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        files, _ = _files_of(self.path)
        for message in messages:
            for path in message.paths if message else []:
                files.delete_file(path)


def _stretches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches in lists of ``most`` rows; the last list may have fewer."""
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - rows)
            held.append(part)
            at, rows = at + part.num_rows, rows + part.num_rows
            if rows == most:
                yield held
                held, rows = [], 0
    if held:
        yield held


def _write_workbook(book: zipfile.ZipFile, names: list[str], batches: list[pa.RecordBatch]) -> None:
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kinds = f"{_PACKAGE}/content-types"
    sheet_kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    book.writestr(
        "[Content_Types].xml",
        f'{head}<Types xmlns="{kinds}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{sheet_kind}.sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{sheet_kind}.worksheet+xml"/></Types>',
    )
    relation = '<Relationships xmlns="{}/relationships"><Relationship Id="rId1" Type="{}/{}" Target="{}"/></Relationships>'
    book.writestr("_rels/.rels", head + relation.format(_PACKAGE, _RELATIONS, "officeDocument", "xl/workbook.xml"))
    book.writestr("xl/_rels/workbook.xml.rels", head + relation.format(_PACKAGE, _RELATIONS, "worksheet", "worksheets/sheet1.xml"))
    book.writestr(
        "xl/workbook.xml",
        f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
    )
    with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as out:
        size = f"A1:{_letters(max(len(names), 1))}{sum(b.num_rows for b in batches) + 1}"
        out.write(f'{head}<worksheet xmlns="{_MAIN}"><dimension ref="{size}"/><sheetData>'.encode())
        out.write(f"<row>{''.join(map(_cell, names))}</row>".encode())
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                out.write(_row_texts(batch.slice(at, 4096)))
        out.write(b"</sheetData></worksheet>")


def _letters(column: int) -> str:
    """The letters of a column, counted from 1."""
    out = ""
    while column:
        column, digit = divmod(column - 1, 26)
        out = chr(65 + digit) + out
    return out


_FORBIDDEN = re.compile(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def _cell(value: Any) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, datetime):
        return f'<c t="d"><v>{value.isoformat()}</v></c>'
    if isinstance(value, date):
        return f'<c t="d"><v>{value.isoformat()}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(str(value))}</t></is></c>'


_ESCAPED = r"[&<>\x00-\x08\x0b-\x1f\x{FFFE}\x{FFFF}]|_x[0-9A-Fa-f]{4}_"


def _row_texts(batch: pa.RecordBatch) -> bytes:
    """The rows of a batch as they stand in a sheet."""
    if not batch.num_columns:
        return b"<row></row>" * batch.num_rows
    large = pa.large_string()
    join = lambda parts: pc.binary_join_element_wise(
        *(pa.scalar(p, large) if isinstance(p, str) else p for p in parts), pa.scalar("", large)
    )
    parts: list = ["<row>"]
    for column in batch.columns:
        before, texts, after = _cell_texts(column)
        cell = [before, texts.cast(large), after]
        parts += [pc.fill_null(join(cell), "<c/>")] if texts.null_count else cell
    rows = join([*parts, "</row>"])
    return "".join(rows.to_pylist()).encode()


def _cell_texts(column: pa.Array) -> tuple[str, pa.Array, str]:
    """What a column's cells begin with, their text (null: an empty cell) and what they end with, as ``_cell`` writes them."""
    kind = column.type
    if pa.types.is_integer(kind) or (pa.types.is_decimal128(kind) and 0 <= kind.scale <= 6):
        return "<c><v>", column.cast(pa.string()), "</v></c>"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        odd = pc.match_substring_regex(column, _ESCAPED)
        if pc.any(odd).as_py():
            column = pa.array([_escaped(v) if o else v for v, o in zip(column.to_pylist(), odd.to_pylist())], pa.large_string())
        return '<c t="inlineStr"><is><t xml:space="preserve">', column, "</t></is></c>"
    if pa.types.is_timestamp(kind) or pa.types.is_date32(kind):
        try:
            whole = column.cast(pa.timestamp("s", tz="UTC") if getattr(kind, "tz", None) else pa.timestamp("s"))
            years = pc.min_max(pc.year(whole)).as_py()
            if years["min"] is None or (years["min"] >= 1000 and years["max"] <= 9999):
                texts = column if pa.types.is_date32(kind) else whole.cast(pa.timestamp("s"))
                return '<c t="d"><v>', pc.replace_substring(texts.cast(pa.string()), " ", "T"), "</v></c>"
        except pa.ArrowInvalid:
            pass  # parts of seconds
    values = [v.astimezone(timezone.utc).replace(tzinfo=None) if isinstance(v, datetime) and v.tzinfo else v for v in column.to_pylist()]
    return "", pa.array([_cell(v) for v in values], pa.large_string()), ""


def _escaped(text: str) -> str:
    return escape(_FORBIDDEN.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(WorkbookSource)
