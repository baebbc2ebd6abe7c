"""Members of zip archives as data sources that split them: delimited text by ranges of bytes, shapefiles by ranges of records.

The driver reads an archive's directory, a text's first line or a shapefile's index, and plans a partition for each SPLIT_BYTES of the
unpacked member. A task unpacks the member as a stream, passes over what comes before its range and keeps a block at a time,
so no task holds an archive, and what costs most, the making of rows, is spread over tasks. Paths are local or those
of a file system that Arrow knows (hdfs, s3, gs).
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 32 << 20
BLOCK = 1 << 20
ROWS = 4096
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def opened(path: str):
    """A file as a stream that can seek."""
    if "://" in path and not path.startswith("file://"):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(path.removeprefix("file://").removeprefix("file:"), "rb")


def listed(path: str) -> list[str]:
    """The archives of a path: itself, or those in a folder, in order of name."""
    from pyarrow import fs

    known = "://" in path and not path.startswith("file://")
    system, inner = fs.FileSystem.from_uri(path) if known else (fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:"))
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    return [f"{path.rstrip('/')}/{f.base_name}" for f in sorted(system.get_file_info(fs.FileSelector(inner)), key=lambda f: f.base_name) if f.extension.lower() == "zip"]


def _member(z: zipfile.ZipFile, suffix: str) -> zipfile.ZipInfo:
    found = next((m for m in z.infolist() if m.filename.lower().endswith(suffix.lower())), None)
    if found is None:
        raise FileNotFoundError(f"no member ends with {suffix}")
    return found


# Fixed names of reference systems in layers' descriptions.
SYSTEMS = {"Web_Mercator": "EPSG:3857", "Pseudo-Mercator": "EPSG:3857", "North_American_1983": "EPSG:4269", "NAD83": "EPSG:4269", "WGS_1984": "EPSG:4326", "WGS 84": "EPSG:4326"}


def system_of(path: str) -> str | None:
    """The reference system that the shapefiles of a path describe; ValueError if they differ, None if none does."""
    found = set()
    for archive in listed(path):
        with opened(archive) as f, zipfile.ZipFile(f) as z:
            described = [m for m in z.namelist() if m.lower().endswith(".prj")]
            text = z.read(described[0]).decode("utf-8", "replace") if described else ""
        found.add(next((crs for name, crs in SYSTEMS.items() if name in text), None))
    if len(found) > 1:
        raise ValueError(f"shapefiles of different reference systems: {sorted(map(str, found))}")
    return found.pop() if found else None


def _skip(stream, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, BLOCK)))
        if not got:
            raise ValueError("a member is shorter than its index says")
        n -= got


@dataclass
class Part(InputPartition):
    path: str
    member: str
    first: int
    end: int


class ZippedText(DataSource):
    """Rows of the first member with a `suffix` of each archive, its first line being the header; options `sep`, and the
    columns of the schema, which the header must have. Cells hold no line breaks."""

    @classmethod
    def name(cls) -> str:
        return "zipped_text"

    def schema(self) -> str:
        raise ValueError("a schema of text columns must be given")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TextReader(schema.names, dict(self.options))


class _TextReader(DataSourceReader):
    def __init__(self, columns: list[str], options: dict):
        self.columns, self.path, self.suffix, self.sep = columns, options["path"], options["suffix"], options.get("sep", "|")
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))

    def _header(self, z: zipfile.ZipFile, member: str) -> list[str]:
        with z.open(member) as f:
            return self._cells(f.readline())

    def _cells(self, line: bytes) -> list[str]:
        return next(csv.reader([line.decode("utf-8-sig").rstrip("\r\n")], delimiter=self.sep), [])

    def partitions(self) -> list[Part]:
        out = []
        for path in listed(self.path):
            with opened(path) as f, zipfile.ZipFile(f) as z:
                member = _member(z, self.suffix)
                if missing := set(self.columns) - set(self._header(z, member.filename)):
                    raise ValueError(f"columns are missing: {sorted(missing)}")
                out += [Part(path, member.filename, a, min(a + self.split, member.file_size)) for a in range(0, member.file_size, self.split)]
        return out

    def read(self, part: Part):
        with opened(part.path) as f, zipfile.ZipFile(f) as z:
            places = [self._header(z, part.member).index(c) for c in self.columns]
            with z.open(part.member) as stream:
                # A line belongs to the range that its first byte is in; the first line is the header.
                at = max(part.first - 1, 0)
                _skip(stream, at)
                lines = io.BufferedReader(stream, BLOCK)
                at += len(lines.readline())
                rows: list[list[str]] = []
                while at < part.end:
                    line = lines.readline()
                    if not line:
                        break
                    at += len(line)
                    if cells := self._cells(line):
                        rows.append([cells[p] if p < len(cells) else "" for p in places])
                    if len(rows) == ROWS:
                        yield self._batch(rows)
                        rows = []
                if rows:
                    yield self._batch(rows)

    def _batch(self, rows: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=self.columns)


class ZippedShapes(DataSource):
    """Attributes, as text (those that a layer lacks are empty), and `rings` of the records of zipped shapefiles; without a
    column `rings` in the schema only attributes are read."""

    @classmethod
    def name(cls) -> str:
        return "zipped_shapes"

    def schema(self) -> str:
        raise ValueError("a schema must be given")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ShapeReader(schema.names, dict(self.options))


class _ShapeReader(DataSourceReader):
    def __init__(self, columns: list[str], options: dict):
        self.columns, self.path = columns, options["path"]
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))

    def partitions(self) -> list[Part]:
        """Ranges of records; where a layer has no index, its records are one range."""
        out = []
        for path in listed(self.path):
            with opened(path) as f, zipfile.ZipFile(f) as z:
                table = _member(z, ".dbf").filename
                with z.open(table) as d:
                    n, _, size = struct.unpack("<IHH", d.read(12)[4:12])
                if "rings" in self.columns:
                    _member(z, ".shp")
                    try:
                        index = np.frombuffer(z.read(_member(z, ".shx"))[100:], dtype=">i4").reshape(-1, 2)[:, 0].astype(np.int64) * 2
                    except FileNotFoundError:
                        index = np.zeros(0, dtype=np.int64)
                    cuts = np.flatnonzero(np.diff(index // self.split, prepend=-1)) if len(index) == n else np.zeros(1, dtype=np.int64)
                else:
                    cuts = np.arange(0, max(n, 1), max(1, self.split // max(1, size)))
                out += [Part(path, table, int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], n], strict=True) if b > a]
        return out

    def read(self, part: Part):
        names = [c for c in self.columns if c != "rings"]
        with opened(part.path) as f, zipfile.ZipFile(f) as z, z.open(part.member) as table:
            head = table.read(32)
            _, length, size = struct.unpack("<IHH", head[4:12])
            fields, at = {}, 1
            described = table.read(length - 32)
            for k in range(0, len(described) - 31, 32):
                if described[k] == 0x0D:
                    break
                fields[described[k : k + 11].split(b"\0")[0].decode("latin-1")] = (at, described[k + 16])
                at += described[k + 16]
            _skip(table, part.first * size)
            shapes = None
            if "rings" in self.columns:
                shapes = io.BufferedReader(z.open(_member(z, ".shp").filename), BLOCK)
                # The index says where the first record is.
                first = 100 if part.first == 0 else int(np.frombuffer(z.read(_member(z, ".shx"))[100 + 8 * part.first : 104 + 8 * part.first], dtype=">i4")[0]) * 2
                _skip(shapes, first)
            for at in range(part.first, part.end, ROWS):
                rows = min(ROWS, part.end - at)
                cells = table.read(rows * size)
                text = {c: [cells[k * size + fields[c][0] : k * size + sum(fields[c])].decode("utf-8", "replace").strip() if c in fields else "" for k in range(rows)] for c in names}
                columns = {c: pa.array(v, pa.string()) for c, v in text.items()}
                if shapes is not None:
                    columns["rings"] = _rings(shapes, rows)
                yield pa.RecordBatch.from_arrays([columns[c] for c in self.columns], names=self.columns)


def _rings(shapes, rows: int) -> pa.Array:
    """Rings of the next records' polygons; no rings for records without a shape."""
    points, ends, counts, total = [], [0], [0], 0
    for _ in range(rows):
        head = shapes.read(8)
        body = shapes.read(2 * struct.unpack(">i", head[4:8])[0]) if len(head) == 8 else b""
        if len(body) >= 44 and struct.unpack("<i", body[:4])[0] in (5, 15, 25):
            parts, n = struct.unpack("<ii", body[36:44])
            starts = np.frombuffer(body, dtype="<i4", count=parts, offset=44)
            points.append(np.frombuffer(body, dtype="<f8", count=2 * n, offset=44 + 4 * parts))
            ends += [total + int(e) for e in [*starts[1:], n]]
            total += n
            counts.append(counts[-1] + parts)
        else:
            counts.append(counts[-1])
    xy = np.concatenate(points).reshape(-1, 2) if points else np.zeros((0, 2))
    flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], fields=list(POINT))
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
