"""Deterministic sharded WARC writer and reader.

Records are sorted by page id over contiguous id ranges (shards). A task
writes its shards record by record, every record a gzip member of its own,
and starts a new file once the compressed size passes a limit. Headers and
digests are regenerated from the payload. Files are written under temporary
names; only those in the manifest of the finished job get their final names,
so a lost or repeated task leaves nothing behind that a reader would see.
The same rows and parameters give the same files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import attach_groups, binary_list, materialize, prepare
from sitelens.session import scratch_path

DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, temp string, shard int, roll int, records long, bytes long, sha256 string"
PAGES = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
ID_BINS = 10_000         # bins of the first cut
LEAST_PARTS = 64         # parts of a bin that is cut again, at least
MAX_CUTS = 12            # 64 ** 12 parts tell any two ids apart
_SPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that holds ``path`` (a URI or a plain path)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(url: str) -> str:
    """A header value must stay on its line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit holds the HTTP head only."""
    digest = sha1_base32(payload)
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>", f"WARC-Date: {DATE}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}",
                  f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_SPACE, f'{refers_to}/{digest}')}>", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def mark_copies(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload, digest and keep_id to (page_id, url, html): of records
    with equal payloads of at least ``min_bytes`` bytes, the largest page_id
    (a null id is the smallest). Hot payloads don't move."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    groups = materialize(rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1), "warc-groups")
    n_rows = rows.count()
    # payloads that occur once need no partner
    return attach_groups(rows, groups, "digest", "n", n_rows, how="left")


def _pieces(rows: DataFrame, level: int, cuts: list[tuple]) -> DataFrame:
    """Adds column ``_b{level}``: which part of its bin (columns ``_b0`` to the
    level before) a row is in. A bin that ``cuts`` doesn't name stays whole
    (0); others are cut by id (from ``lo`` in steps of ``width``) or by a hash
    of the digest or URL."""
    names = [f"_p{i}" for i in range(level)]
    side = rows.sparkSession.createDataFrame(cuts, ", ".join([*(f"{n} long" for n in names), _CUTS]))
    if level:
        rows = rows.join(F.broadcast(side), [F.col(f"_b{i}") == F.col(n) for i, n in enumerate(names)], "left")
    else:
        rows = rows.withColumns({f.name: F.lit(v).cast(f.dataType) for f, v in zip(side.schema, cuts[0])})
    step = F.expr("(CAST(page_id AS DECIMAL(20,0)) - lo) div width")
    part = F.when(F.col("how") == "id", F.coalesce(step, F.lit(-1)))
    for how in ("digest", "url"):       # another hash at every level
        part = part.when(F.col("how") == how, F.pmod(F.xxhash64(how, F.lit(level)), F.col("parts")))
    return rows.withColumn(f"_b{level}", F.coalesce(part, F.lit(0)).cast("long")).drop(*names, "lo", "width", "parts", "how")


_CUTS = "lo decimal(20,0), width decimal(20,0), parts long, how string"


def _shards(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """Adds ``shard``: contiguous ranges of ids of about
    ``shard_bytes``, from exact sizes, so reruns agree. Ids are binned by equal
    widths; a bin with more bytes than a shard is binned again between its own
    least and largest id, a single id (or null) by digest, and equal digests of
    one id by URL. So outlying, repeated and null ids don't fill a shard, and
    bins follow the bytes, not the number of ids."""
    spark = rows.sparkSession
    sizes = materialize(rows.select("page_id", "digest", "url", (F.octet_length("payload") + 600).alias("size")), "warc-sizes")
    lo, hi = sizes.agg(F.min("page_id"), F.max("page_id")).first()
    lo, hi = lo or 0, hi or 0
    cuts, steps, bins = [(Decimal(lo), Decimal(-(-(hi - lo + 1) // ID_BINS)), 1, "id")], [], {}
    while cuts:
        sizes = _pieces(sizes, len(steps), cuts)
        steps.append(cuts)
        of, cuts, bins = [f"_b{i}" for i in range(len(steps))], [], {}
        for r in sizes.groupBy(*of).agg(F.sum("size").alias("n"), *[f(c).alias(a + c) for c in ("page_id", "digest", "url")
                                                                    for a, f in (("lo_", F.min), ("hi_", F.max))]).collect():
            path = tuple(r[c] for c in of)
            bins[path] = r["n"]
            parts = max(LEAST_PARTS, 2 * -(-r["n"] // shard_bytes))
            if r["n"] <= shard_bytes or len(steps) > MAX_CUTS:
                continue
            if r["lo_page_id"] != r["hi_page_id"]:
                cuts.append((*path, Decimal(r["lo_page_id"]), Decimal(-(-(r["hi_page_id"] - r["lo_page_id"] + 1) // parts)), parts, "id"))
            elif r["lo_digest"] != r["hi_digest"]:
                cuts.append((*path, None, None, parts, "digest"))
            elif r["lo_url"] != r["hi_url"]:
                cuts.append((*path, None, None, parts, "url"))
    shard, filled, out = 0, 0, []
    for path in sorted(bins):
        if filled and filled + bins[path] > shard_bytes:
            shard, filled = shard + 1, 0
        filled += bins[path]
        out.append((*path, shard))
    for level, step in enumerate(steps):
        rows = _pieces(rows, level, step)
    named = spark.createDataFrame(out, ", ".join(f"{c} long" for c in of) + ", shard int")
    return rows.join(F.broadcast(named), of).drop(*of)


def write_archives(rows: DataFrame, out: str, shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20, level: int = 4) -> DataFrame:
    """Write (page_id, url, payload, keep_id, digest) rows to ``out`` and
    return the committed manifest, a row per file. ``roll_bytes`` bounds a
    file's compressed size (plus one record)."""
    spark = rows.sparkSession
    rows = _shards(rows, shard_bytes)
    n_shards = max(1, rows.agg(F.max("shard")).first()[0] or 0) + 1
    rows = (rows.select("shard", "page_id", "url", "payload", "keep_id", "digest").repartitionByRange(n_shards, "shard")
            .sortWithinPartitions("shard", "page_id", "digest", "url"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(out)
        fs.create_dir(f"{base}/_temporary", recursive=True)
        stream, file = None, {}

        def close() -> pa.RecordBatch:
            stream.close()
            file["sha256"] = file.pop("hash").hexdigest()
            return pa.RecordBatch.from_pylist([file], _manifest_schema())

        for batch in batches:
            payloads = binary_list(batch.column(3))
            for shard, page_id, url, payload, keep in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                          batch.column(2).to_pylist(), payloads, batch.column(4).to_pylist()):
                if stream is not None and (file["shard"] != shard or file["bytes"] >= roll_bytes):
                    roll = file["roll"] + 1 if file["shard"] == shard else 0
                    yield close()
                    stream = None
                elif stream is None:
                    roll = 0
                if stream is None:
                    name = f"pages-{shard:06d}-{roll:04d}.warc.gz"
                    temp = f"_temporary/{uuid.uuid4().hex}-{name}"
                    file = {"name": name, "temp": temp, "shard": shard, "roll": roll, "records": 0, "bytes": 0, "hash": hashlib.sha256()}
                    stream = fs.open_output_stream(f"{base}/{temp}", compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, payload, keep, keep is not None and keep != page_id)) + packer.flush()
                stream.write(data)
                file["hash"].update(data)
                file["records"] += 1
                file["bytes"] += len(data)
        if stream is not None:
            yield close()

    manifest = materialize(rows.mapInArrow(run, MANIFEST), "warc-manifest")
    return commit(manifest, out)


def _manifest_schema() -> pa.Schema:
    return pa.schema([("name", pa.string()), ("temp", pa.string()), ("shard", pa.int32()), ("roll", pa.int32()),
                      ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def commit(manifest: DataFrame, out: str) -> DataFrame:
    """Give the manifest's files their final names, as a Spark job; repeating
    it does no harm. Then store the manifest beside them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(out)
        for batch in batches:
            for temp, name, size in zip(*(batch.column(c).to_pylist() for c in ("temp", "name", "bytes"))):
                if fs.get_file_info(f"{base}/{temp}").type != pafs.FileType.NotFound:
                    fs.move(f"{base}/{temp}", f"{base}/{name}")
                if fs.get_file_info(f"{base}/{name}").size != size:
                    raise OSError(f"{name} is missing or incomplete")
            yield batch

    done = manifest.mapInArrow(run, MANIFEST)
    done.write.mode("overwrite").parquet(f"{out}/_manifest")
    return manifest.sparkSession.read.schema(MANIFEST).parquet(f"{out}/_manifest")


def members(fs: pafs.FileSystem, path: str, block: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one record each, read as a stream."""
    with fs.open_input_stream(path, compression=None) as stream:
        unpacker, out, rest = zlib.decompressobj(31), [], b""
        while True:
            data = rest or stream.read(block)
            if not data:
                break
            out.append(unpacker.decompress(data))
            rest = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(out)
                unpacker, out = zlib.decompressobj(31), []
            else:
                rest = b""
        if out:
            raise OSError(f"{path} ends inside a record")


def parse(data: bytes) -> dict:
    """Headers and payload facts of a record; raises if a digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    h = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if "sha1:" + sha1_base32(block) != h["WARC-Block-Digest"]:
        raise OSError(f"block digest differs in {h['WARC-Record-ID']}")
    if h["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise OSError(f"payload digest differs in {h['WARC-Record-ID']}")
    page, refers = h.get("X-Page-ID"), h.get("X-Refers-To-Page-ID")
    return {"page_id": None if page is None else int(page), "url": h.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": None if refers is None else int(refers)}


def read_archives(manifest: DataFrame, out: str, batch_rows: int = 2000) -> DataFrame:
    """A row per record of the archives: what the headers say, checked."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(out)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for data in members(fs, f"{base}/{name}"):
                    rows.append(parse(data))
                    if len(rows) >= batch_rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = manifest.select("name")
    return files.repartition(max(1, files.count()), "name").mapInArrow(run, PAGES)


def archive_pages(pages: DataFrame, out: str | None = None, min_bytes: int = 0, shard_bytes: int = 64 << 20,
                  roll_bytes: int = 16 << 20) -> tuple[DataFrame, str]:
    """Write every page as a WARC record and return (manifest, folder).

    A null html is an empty payload, a null url leaves its header out, a null
    page_id leaves the id out and sorts first. Rows that repeat the largest
    id of their payload are all responses. An empty table writes no file.
    Other columns are not read."""
    spark = pages.sparkSession
    prepare(spark)
    out = out or scratch_path(spark, "warc")
    return write_archives(mark_copies(pages, min_bytes), out, shard_bytes, roll_bytes), out
