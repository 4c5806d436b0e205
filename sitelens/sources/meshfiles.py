"""Point clouds and meshes as files: PLY (binary or text) and OBJ.

``ply`` and ``obj`` are Spark data sources. The driver reads headers only;
tasks read byte ranges of the files (records of a fixed width for binary
vertices, whole lines for text) and write part files that appear under their
final names when all tasks are done. Folders hold any number of files, whose
rows are known by (file, pos): pos is a row's place in its file.

A file that ends early, a header that isn't one, a line with too few numbers
and an unknown kind of number raise; nothing is skipped but comments, empty
lines and OBJ statements other than ``v`` and ``f``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

RANGE_BYTES = 64 << 20       # of a file that a task reads
ROWS_PER_FILE = 1_000_000    # rows that a task holds and writes to one file
# Names of the format's number types, old and new.
PLY_TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2",
             "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8"}
PLY_ORDER = {"ascii": "", "binary_little_endian": "<", "binary_big_endian": ">"}


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    fs, base = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    return fs, base.rstrip("/")


def _files(path: str, ending: str | tuple) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
    fs, base = _store(path)
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return fs, [info]
    found = fs.get_file_info(pafs.FileSelector(base))
    return fs, sorted((f for f in found if f.type == pafs.FileType.File and f.path.endswith(ending)), key=lambda f: f.path)


@dataclass
class Header:
    """What the head of a PLY file says."""
    order: str                           # '' for text, else the byte order
    elements: list[tuple[str, int, list[tuple[str, str]]]]     # name, rows, (property, type); a list's type is 'list a b'
    length: int

    @classmethod
    def parse(cls, head: bytes, path: str) -> "Header":
        end = head.find(b"end_header")
        stop = head.find(b"\n", end)
        if not head.startswith(b"ply") or end < 0 or stop < 0:
            raise ValueError(f"{path} has no PLY header")
        order, elements = None, []
        for line in head[:end].decode("ascii", "replace").splitlines()[1:]:
            w = line.split()
            if not w or w[0] in ("comment", "obj_info"):
                continue
            if w[0] == "format" and len(w) == 3 and w[1] in PLY_ORDER:
                order = PLY_ORDER[w[1]]
            elif w[0] == "element" and len(w) == 3 and w[2].isdigit():
                elements.append((w[1], int(w[2]), []))
            elif w[0] == "property" and elements and len(w) == 3 and w[1] in PLY_TYPES:
                elements[-1][2].append((w[2], PLY_TYPES[w[1]]))
            elif w[0] == "property" and elements and len(w) == 5 and w[1] == "list" and {w[2], w[3]} <= set(PLY_TYPES):
                elements[-1][2].append((w[4], f"list {PLY_TYPES[w[2]]} {PLY_TYPES[w[3]]}"))
            else:
                raise ValueError(f"{path}: cannot read header line {line!r}")
        if order is None or not elements or elements[0][0] != "vertex" or any(t.startswith("list") for _, t in elements[0][2]):
            raise ValueError(f"{path}: the header must name a format and start with plain vertices")
        return cls(order, elements, stop + 1)

    def vertex_type(self) -> np.dtype:
        return np.dtype([(n, self.order + t if self.order else t) for n, t in self.elements[0][2]])


def _header(fs: pafs.FileSystem, path: str, most: int = 1 << 20) -> Header:
    with fs.open_input_stream(path, compression=None) as f:
        return Header.parse(f.read(most), path)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    order: str = ""
    first: int = 0           # rows before the range (binary)


class PlyReader(DataSourceReader):
    """Vertices: file, pos and the properties as doubles. Binary vertices are
    cut at rows, text at bytes; a text row's pos is its place in bytes."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.step = int(options.get("rangebytes", RANGE_BYTES))
        self.names = [f.name for f in schema.fields if f.name not in ("file", "pos")]

    def partitions(self) -> list[InputPartition]:
        fs, files = _files(self.path, ".ply")
        out: list[InputPartition] = []
        for f in files:
            h = _header(fs, f.path)
            rows = h.elements[0][1]
            if h.order:
                width = h.vertex_type().itemsize
                if f.size < h.length + rows * width:
                    raise ValueError(f"{f.path} is cut: {rows} vertices need {h.length + rows * width} bytes, it has {f.size}")
                step = max(1, self.step // width)
                out += [Range(f.path, h.length + lo * width, h.length + min(rows, lo + step) * width, h.order, lo) for lo in range(0, rows, step)]
            elif len(h.elements) > 1 and any(n for _, n, _ in h.elements[1:]):
                out.append(Range(f.path, h.length, f.size, "", 0))       # faces follow: only reading tells where
            else:
                out += [Range(f.path, lo, min(f.size, lo + self.step)) for lo in range(h.length, f.size, self.step)]
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, _ = _store(self.path)
        h = _header(fs, part.path)
        kinds = h.vertex_type()
        if missing := set(self.names) - set(kinds.names):
            raise ValueError(f"{part.path} has no property {sorted(missing)}")
        if part.order:
            with fs.open_input_file(part.path) as f:
                f.seek(part.start)
                rows = np.frombuffer(f.read(part.end - part.start), kinds)
            yield self._batch(part.path, part.first + np.arange(len(rows)), [rows[n].astype(np.float64) for n in self.names])
            return
        at = [kinds.names.index(n) for n in self.names]
        pos, values, n = [], [], 0
        for place, line in _lines(fs, part, h.length):
            w = line.split()
            if not w:
                continue
            if part.start == h.length and n >= h.elements[0][1]:
                break
            if len(w) < len(kinds.names):
                raise ValueError(f"{part.path}: {len(w)} numbers for a vertex at byte {place}")
            n += 1
            pos.append(place)
            values.append([float(w[i]) for i in at])
        if part.start == h.length and part.end >= fs.get_file_info(part.path).size and n < h.elements[0][1]:
            raise ValueError(f"{part.path} is cut: {n} of {h.elements[0][1]} vertices")
        if pos:
            yield self._batch(part.path, np.array(pos), list(np.array(values, np.float64).T))

    def _batch(self, path: str, pos: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(pos)), pa.array(pos.astype(np.int64)), *map(pa.array, columns)],
                                          ["file", "pos", *self.names])


def _lines(fs: pafs.FileSystem, part: Range, body: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in a range of bytes."""
    with fs.open_input_file(part.path) as f:
        start = part.start
        if start > body:            # the line that spans the cut belongs to the range before
            f.seek(start - 1)
            while (piece := f.read(1 << 16)) and b"\n" not in piece:
                start += len(piece)
            start += piece.find(b"\n") if piece else 0
        f.seek(start)
        rest, place = b"", start
        while place < part.end:
            piece = f.read(1 << 20)
            rest += piece
            *lines, rest = rest.split(b"\n") if piece else [rest, b""]
            for line in lines:
                if place >= part.end:
                    return
                yield place, line
                place += len(line) + 1
            if not piece:
                return


class PlyWriter(DataSourceWriter):
    """A binary PLY file for every ROWS_PER_FILE rows of a partition: all
    numeric columns as double properties (integers beyond 2^53 raise)."""

    def __init__(self, schema: StructType, options: dict):
        self.path, self.names = options["path"], [f.name for f in schema.fields]
        bad = [f.name for f in schema.fields if f.dataType.simpleString() not in ("double", "float", "tinyint", "smallint", "int", "bigint")]
        if bad:
            raise ValueError(f"PLY holds numbers only; not {bad}")
        self.run = uuid.uuid4().hex

    def write(self, rows) -> WriterCommitMessage:
        from pyspark import TaskContext
        fs, base = _store(self.path)
        fs.create_dir(f"{base}/_temporary-{self.run}", recursive=True)
        task, held, files = TaskContext.get(), [], []

        def close() -> None:
            table = np.array(held, np.float64).reshape(len(held), len(self.names))
            if any(isinstance(v, int) and abs(v) > 1 << 53 for r in held for v in r) or np.isnan(table).any():
                raise ValueError("PLY properties are doubles without nulls; integers must lie within 2^53")
            head = "ply\nformat binary_little_endian 1.0\n" + f"element vertex {len(held)}\n" + "".join(f"property double {n}\n" for n in self.names) + "end_header\n"
            name = f"part-{task.partitionId():05d}-{len(files):04d}-{self.run[:8]}.ply"
            temp = f"{base}/_temporary-{self.run}/{task.taskAttemptId()}-{name}"
            with fs.open_output_stream(temp, compression=None) as f:
                f.write(head.encode() + table.astype("<f8").tobytes())
            files.append((temp, f"{base}/{name}"))
            held.clear()

        for row in rows:
            held.append(tuple(row))
            if len(held) >= ROWS_PER_FILE:
                close()
        if held or (task.partitionId() == 0 and not files):
            close()
        return _Files(files)

    def commit(self, messages) -> None:
        fs, base = _store(self.path)
        for m in messages:
            for temp, name in m.files:
                fs.move(temp, name)
        fs.delete_dir(f"{base}/_temporary-{self.run}")

    def abort(self, messages) -> None:
        fs, base = _store(self.path)
        if fs.get_file_info(f"{base}/_temporary-{self.run}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/_temporary-{self.run}")


@dataclass
class _Files(WriterCommitMessage):
    files: list


class PlySource(DataSource):
    """``spark.read.format("ply").load(path)`` and ``df.write.format("ply").mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> str:
        fs, files = _files(self.options["path"], ".ply")
        if not files:
            raise ValueError(f"no PLY files in {self.options['path']}")
        return "file string, pos long, " + ", ".join(f"`{n}` double" for n, _ in _header(fs, files[0].path).elements[0][2])

    def reader(self, schema: StructType) -> DataSourceReader:
        return PlyReader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("the ply source appends; write to a new folder")
        return PlyWriter(schema, {k.lower(): v for k, v in self.options.items()})


class ObjReader(DataSourceReader):
    """``v`` and ``f`` lines: file, pos, kind, and the three coordinates of a
    vertex or, for a face, the vertex numbers of its corners as written."""

    def __init__(self, options: dict):
        self.path, self.step = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        _, files = _files(self.path, (".obj", ".txt"))
        return [Range(f.path, lo, min(f.size, lo + self.step)) for f in files for lo in range(0, f.size, self.step)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.path:
            return
        fs, _ = _store(self.path)
        for place, line in _lines(fs, part, 0):
            w = line.split()
            if not w or w[0] not in (b"v", b"f"):
                continue
            try:
                if w[0] == b"v":
                    yield part.path, place, "v", [float(v) for v in w[1:4]], None
                    if len(w) < 4:
                        raise ValueError
                else:
                    corners = [int(v.split(b"/")[0]) for v in w[1:]]
                    if len(corners) < 3 or min(corners) < 1:
                        raise ValueError
                    yield part.path, place, "f", None, corners
            except ValueError:
                raise ValueError(f"{part.path}: cannot read {line!r} at byte {place}") from None


class ObjSource(DataSource):
    """``spark.read.format("obj").load(path)``; see ``read_obj`` for triangles."""

    @classmethod
    def name(cls) -> str:
        return "obj"

    def schema(self) -> str:
        return "file string, pos long, kind string, at array<double>, corners array<long>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ObjReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    from sitelens.session import ship_package
    ship_package(spark)
    spark.dataSource.register(PlySource)
    spark.dataSource.register(ObjSource)


def read_ply(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The vertices of a PLY file or of all in a folder, with pt_id: the
    property of that name, else the row's rank by (file, pos) from 0."""
    from sitelens.operators.cluster import global_rank
    register(spark)
    rows = spark.read.format("ply").option("rangeBytes", range_bytes).load(path)
    if "pt_id" in rows.columns:
        return rows.withColumn("pt_id", F.col("pt_id").cast("long")).drop("file", "pos")
    ranked = global_rank(rows.withColumn("_at", F.struct("file", "pos")), "_at")
    return ranked.withColumnRenamed("_rank", "pt_id").drop("file", "pos", "_at")


def write_ply(cloud: DataFrame, path: str) -> None:
    """The numeric columns of a cloud as binary PLY files in a new folder."""
    register(cloud.sparkSession)
    cloud.write.format("ply").mode("append").save(path)


def read_obj(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The triangles (tri_id, ax .. cz) of an OBJ file or of all in a folder.
    Faces of more corners are fans of triangles from their first; vertices are
    numbered per file, and a face with a number that its file doesn't have raises."""
    from sitelens.operators.cluster import global_rank
    register(spark)
    rows = spark.read.format("obj").option("rangeBytes", range_bytes).load(path).checkpoint()
    at = F.struct("file", "pos").alias("_at")
    verts = global_rank(rows.filter("kind = 'v'").select("file", at, "at"), "_at").drop("_at")
    base = verts.groupBy("file").agg(F.min("_rank").alias("_base"))
    verts = verts.join(F.broadcast(base) if base.count() <= 100_000 else base, "file").select("file", (F.col("_rank") - F.col("_base") + 1).alias("_n"), "at")
    fans = F.transform(F.sequence(F.lit(1), F.size("corners") - 2), lambda i: F.array(F.element_at("corners", 1), F.get("corners", i), F.get("corners", i + 1)))
    faces = rows.filter("kind = 'f'").select("file", "pos", F.posexplode(fans).alias("_k", "_c"))
    faces = global_rank(faces.select("file", F.struct("file", "pos", "_k").alias("_at"), "_c"), "_at").select(F.col("_rank").alias("tri_id"), "file", "_c").checkpoint()
    corners = faces.select("tri_id", "file", F.posexplode("_c").alias("_k", "_n")).join(verts, ["file", "_n"], "left")
    known = F.when(F.col("at").isNull(), F.raise_error(F.concat(F.lit("no vertex "), F.col("_n").cast("string"), F.lit(" in "), F.col("file")))).otherwise(F.col("at"))
    corners = corners.select("tri_id", "_k", known.alias("at"))
    names = [[f"{c}{a}" if (c, a) != ("b", "y") else "by_" for a in "xyz"] for c in "abc"]
    return corners.groupBy("tri_id").agg(*[F.max(F.when(F.col("_k") == k, F.col("at")[i])).alias(names[k][i]) for k in range(3) for i in range(3)])


def write_obj(triangles: DataFrame, path: str) -> None:
    """Triangles as OBJ text files in a new folder, three vertices and a face
    each; every file is complete by itself."""
    names = [[f"{c}{a}" if (c, a) != ("b", "y") else "by_" for a in "xyz"] for c in "abc"]
    corner = [F.concat_ws(" ", F.lit("v"), *[F.col(n).cast("double").cast("string") for n in p]) for p in names]
    numbered = triangles.sortWithinPartitions("tri_id").withColumn("_i", F.monotonically_increasing_id() % F.lit(1 << 33))
    face = F.concat_ws(" ", F.lit("f"), *[(F.col("_i") * 3 + k).cast("string") for k in (1, 2, 3)])
    lines = numbered.select(F.concat_ws("\n", *corner, face).alias("value"))
    lines.write.mode("errorifexists").text(path)
