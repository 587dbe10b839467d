"""Archives as a Spark data source: ``spark.read.format("diagarc")`` and ``spark.readStream.format("diagarc")``.

A file is cut into byte ranges, and each task finds the documents that begin in its range, so files
of any size are read by many tasks and no task holds more than one document and one Arrow batch.
Documents lie back to back without marks between them. A range therefore begins at the first place
that looks like the head of a document (a date ``_id``, then an int32 ``type``) and is followed by
another such head or the end, and the range before it reads on to that very place: both ask the
same question of the same bytes, so every document is read once. A task takes several small ranges in
a row, since a task costs more than reading a few kilobytes: the number of tasks follows the bytes, and
so does the number of files that a sink writes.

Filters on path, type and time are taken over: files that the path excludes are never opened, and
the bytes of documents that type or time exclude are skipped.

As a stream the offset is a number of bytes per path, always the end of a whole document. A file may
grow while it is read: a document that is not whole yet waits for a later batch.

``register(spark)`` makes the format known. Options: ``path`` (file, folder or glob; local, or a scheme
that ``pyarrow.fs`` knows), ``splitBytes`` (32 MB), ``interim`` (all file names instead of closed archives
only), ``since`` and ``until`` (file name times, as in ``read_archives``), ``maxBytesPerTrigger`` (streams).
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith)

from diagarc.sources import wire
from diagarc.sources.archives import ARCHIVE_DOCS

SPLIT_BYTES = 32 << 20
#: In bytes: what small ranges of one task may cost together, and what each costs beside its own. Few ranges go to this many tasks.
TASK_COST, RANGE_COST, LEAST_TASKS = 4 << 20, 64 << 10, 256
_U32 = struct.Struct("<I")
# How a document of an archive begins, and closed archives' names.
_HEAD = re.compile(rb"....\x09_id\x00.{8}\x10type\x00[\x00-\x02]\x00\x00\x00", re.S)
_HEAD_BYTES = 27
_CLOSED = re.compile(r"metrics\.(\d{4}-\d{2}-\d{2})T(\d{2})-(\d{2})-(\d{2})Z-\d{5,}$")
_WINDOW = 1 << 20
_SCHEMA = pa.schema([("path", pa.string()), ("doc_no", pa.int64()), ("byte_offset", pa.int64()), ("doc_type", pa.int32()),
                     ("id_ms", pa.int64()), ("body", pa.binary()), ("error", pa.string())])


def register(spark: SparkSession) -> None:
    """Make ``format("diagarc")`` known to the session and let Spark hand it filters.

    The driver's process that plans a stream gets no shipped packages, only the context's environment,
    so this package's folder is put on its path there.
    """
    root, environment = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)


def _store(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path within it, and what is put before that again in rows."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
    if "://" not in path:
        return fs.LocalFileSystem(), path, "file:"
    store, inside = fs.FileSystem.from_uri(re.split(r"[*?\[{]", path)[0])
    return store, inside + path[len(re.split(r"[*?\[{]", path)[0]) :], path.split("://")[0] + "://"


def _glob(pattern: str) -> re.Pattern:
    out = ""
    for c in pattern:
        out += "[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c)
    return re.compile(out.rstrip("/") + r"(/.*)?$")


def list_files(options: dict) -> list[tuple[str, int]]:
    """(path, bytes) of the files that the options name, in order of path."""
    store, inside, scheme = _store(options["path"])
    fixed = re.split(r"[*?]", inside)[0]
    top = inside if fixed == inside else fixed.rsplit("/", 1)[0] or "/"
    info = store.get_file_info(top)
    files = [info] if info.type == fs.FileType.File else [] if info.type == fs.FileType.NotFound else store.get_file_info(fs.FileSelector(top, recursive=True))
    wanted, found = _glob(inside), []
    since, until = (re.sub(r"\D", "", options.get(k, "")).ljust(14, "0") if options.get(k) else None for k in ("since", "until"))
    for f in files:
        if f.type != fs.FileType.File or not wanted.match(f.path) or f.base_name.startswith(("_", ".")):
            continue
        closed = _CLOSED.match(f.base_name)
        stamp = re.sub(r"\D", "", "".join(closed.groups())) if closed else None
        if options.get("interim", "false").lower() != "true" and not closed:
            continue
        if since and (stamp is None or stamp < since) or until and (stamp is None or stamp >= until):
            continue
        found.append((scheme + f.path, f.size))
    return sorted(found)


@dataclass
class ByteRange(InputPartition):
    """Documents of ``path`` that begin in start..stop; ``size`` is where its readable bytes end; ``exact`` if a document begins at start.

    The task that reads it goes on with the ranges ``then``.
    """

    path: str
    start: int
    stop: int
    size: int
    exact: bool
    then: tuple[ByteRange, ...] = ()


def ranges_of(path: str, start: int, size: int, split: int) -> list[ByteRange]:
    return [ByteRange(path, at, min(at + split, size), size, at == start) for at in range(start, size, split)]


def in_tasks(ranges: list[ByteRange]) -> list[ByteRange]:
    """The ranges in their order, dealt to tasks of about equal cost; one that costs enough has a task of its own."""
    most = min(TASK_COST, sum(map(_cost, ranges)) // LEAST_TASKS)
    tasks, held = [], 0
    for r in ranges:
        if not tasks or held + _cost(r) > most:
            tasks.append([])
            held = 0
        tasks[-1].append(r)
        held += _cost(r)
    return [replace(first, then=tuple(then)) for first, *then in tasks]


def _cost(part: ByteRange) -> int:
    return part.stop - part.start + RANGE_COST


class _File:
    def __init__(self, path: str, size: int) -> None:
        store, inside, _ = _store(path)
        self.raw, self.size = store.open_input_file(inside), size

    def at(self, pos: int, n: int) -> bytes:
        self.raw.seek(pos)
        return self.raw.read(max(0, min(n, self.size - pos)))

    def begins(self, pos: int) -> bool:
        """Whether a document with the usual head lies at ``pos`` and another one or the end after it."""
        head = self.at(pos, _HEAD_BYTES)
        if not _HEAD.match(head):
            return False
        after = pos + _U32.unpack_from(head)[0]
        return after == self.size or after + 4 > self.size >= after or _HEAD.match(self.at(after, _HEAD_BYTES)) is not None

    def first(self, start: int, stop: int) -> int | None:
        """The first place from start to before stop where a document begins."""
        for window in range(start, stop, _WINDOW):
            data = self.at(window, _WINDOW + _HEAD_BYTES - 1)
            at = 0
            while found := _HEAD.search(data, at):
                pos = window + found.start()
                if found.start() >= _WINDOW or pos >= stop:
                    break
                if self.begins(pos):
                    return pos
                at = found.start() + 1
        return None


def read_range(part: ByteRange, wanted=None) -> Iterator[pa.RecordBatch]:
    """Documents of a range as ARCHIVE_DOCS rows; ``wanted(doc_type, id_ms)`` tells whose bytes are read.

    ``doc_no`` is the byte offset, which is unique and ordered within a path. An unreadable document
    gives an error row and ends its range; the next range begins anew.
    """
    file = _File(part.path, part.size)
    pos = part.start if part.exact else file.first(part.start, part.stop)
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    while pos is not None and part.size - pos >= 4:
        if pos >= part.stop and file.begins(pos):
            break  # the next range's
        head = file.at(pos, _HEAD_BYTES)
        (n,) = _U32.unpack_from(head)
        if n < 5:
            break
        doc_type = id_ms = body = error = None
        if pos + n > part.size:
            error = f"truncated_document: {n} bytes announced at byte {pos}"
        elif _HEAD.match(head) and wanted and not wanted(head[23], struct.unpack_from("<q", head, 9)[0]):
            pos += n
            continue
        else:
            body = file.at(pos, n)
            try:
                doc_type, id_ms = wire.head(body, 0, n)
            except wire.Malformed as e:
                error = str(e)
        if error is not None and wanted:
            break  # no type and no time: the filters exclude it
        if wanted is None or wanted(doc_type, id_ms):
            rows.append((part.path, pos, pos, doc_type, id_ms, body or b"", error))
            held += n if body else 0
        if error is not None:
            break
        pos += n
        if held > 8 << 20 or len(rows) == 4096:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


_COMPARE = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b,
            LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b, StringStartsWith: lambda a, b: a.startswith(b),
            StringEndsWith: lambda a, b: a.endswith(b), StringContains: lambda a, b: b in a, IsNotNull: lambda a, b: a is not None}


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options, self.tests = options, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if type(f) in _COMPARE and column in ("path", "doc_type", "id_ms"):
                self.tests.append((column, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def _passes(self, column: str, value) -> bool:
        named = {k.__name__: test for k, test in _COMPARE.items()}
        return all(named[kind](value, given) for c, kind, given in self.tests if c == column)

    def partitions(self) -> list[ByteRange]:
        split = int(self.options.get("splitbytes", SPLIT_BYTES))
        ranges = [r for path, size in list_files(self.options) if self._passes("path", path) for r in ranges_of(path, 0, size, split)]
        return in_tasks(ranges) or [ByteRange("", 0, 0, 0, True)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        by_head = any(c != "path" for c, _, _ in self.tests)
        for r in (part, *part.then):
            yield from read_range(r, (lambda t, ms: self._passes("doc_type", t) and self._passes("id_ms", ms)) if by_head else None)


class GrowingReader(DataSourceStreamReader):
    """Offsets are {path: end of the last whole document}."""

    def __init__(self, options: dict) -> None:
        self.options, self.known = options, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        left = int(self.options.get("maxbytespertrigger", 1 << 62))
        for path, size in list_files(self.options):
            pos = self.known.get(path, 0)
            if size < pos:
                raise ValueError(f"{path} has {size} bytes, {pos} were read: archives may grow, but not be replaced")
            if size - pos < 4 or left <= 0:
                continue
            file, begin = _File(path, size), pos
            while size - pos >= 4 and pos - begin < left:
                (n,) = _U32.unpack(file.at(pos, 4))
                if n < 5 or pos + n > size:
                    break
                pos += n
            left -= pos - begin
            if pos:
                self.known[path] = pos
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        for path, pos in end.items():  # after a restart, from what was read before
            self.known[path] = max(pos, self.known.get(path, 0))
        split = int(self.options.get("splitbytes", SPLIT_BYTES))
        return in_tasks([r for path, stop in sorted(end.items()) for r in ranges_of(path, start.get(path, 0), stop, split)])

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        for r in (part, *part.then):
            yield from read_range(r)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "diagarc"

    def schema(self) -> str:
        return ARCHIVE_DOCS

    def _given(self) -> dict:
        if "path" not in self.options:
            raise ValueError("option path is missing")
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self._given())

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self._given())
