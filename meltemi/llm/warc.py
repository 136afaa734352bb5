"""WARC archives: a writer that turns repeated payloads into revisits, and a reader that salvages damaged files.

Each task writes gzip members, one record each, to files of its own in a shared folder; a file counts
once the manifest row of its task is written, so what a lost or repeated task left behind is never
read. The reader takes one record at a time. Where a check fails it searches for the next place at
which a member, or in plain files a version line, begins a record, goes on there, and logs the bytes
between as a quarantined gap.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch
from meltemi.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the format.
VERSION, MAGIC, BREAK = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Compressed bytes after which a task begins another file, and bytes read at a time.
ROLL, CHUNK = 16 << 20, 1 << 20

MANIFEST = "path string, records long, bytes long"
RECORD = """path string, start long, stop long, gap string, record_type string, page_id long, refers_to long,
    uri string, payload_digest string, payload_bytes long, payload binary"""
_FIELDS = [part.split()[0] for part in RECORD.replace("\n", " ").split(",")]


# ---- writing ------------------------------------------------------------------------------------

def with_payload(pages: DataFrame, html: str = "html") -> DataFrame:
    payload = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    return pages.withColumns({"payload": payload, "digest": F.sha2(payload, 256), "size": F.octet_length(payload)})


def typed(pages: DataFrame, least: int = 100) -> DataFrame:
    """payload, digest, and `first`: the smallest page_id of the equal payloads of `least` bytes or more."""
    rows = with_payload(pages).select("page_id", "url", "payload", "digest", "size")
    groups = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return rows.join(groups.filter("n > 1").select("digest", "first"), "digest", "left")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    import hashlib

    again = first is not None and first != page_id
    block = HTTP if again else HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%" + format(ord(c), "02X") for c in url))
    if again:
        head += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + BREAK + block + BREAK


#: Names that Hadoop has for schemes Arrow knows by others.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs"}


def open_system(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if scheme == "file":
        rest = "///" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}" if colon else uri)


def digest_fits(said: str, data: bytes) -> bool:
    """Whether data has the digest said, such as sha1:<Base32> or sha256:<hex>; one of an unknown kind is not checked."""
    import base64
    import hashlib

    name, _, value = said.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    raw = hashlib.new(name, data).digest()
    return value.strip().lower() == raw.hex() or value.strip().upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=")


def _write_batches(folder: str, date: str, roll: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        task, count = TaskContext.get(), 0
        system, base = open_system(folder)
        out = path = None
        records = size = 0
        for batch in batches:
            for page_id, url, payload, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first"))):
                if out is None:
                    path = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{count:05d}.warc.gz"
                    out, records, size, count = system.open_output_stream(f"{base}/{path}", compression=None), 0, 0, count + 1
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, payload, digest, first, date)) + packer.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll:
                    out.close()
                    yield _manifest(f"{folder}/{path}", records, size)
                    out = None
        if out is not None:
            out.close()
            yield _manifest(f"{folder}/{path}", records, size)

    return run


def _manifest(path: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records]), pa.array([size])], names=["path", "records", "bytes"])


def write(pages: DataFrame, folder: str, least: int = 100, date: str = "1970-01-01T00:00:00Z", roll: int = ROLL, level: int = 6) -> DataFrame:
    """Write one record per row of pages (page_id, url, html); the manifest (path, records, bytes), lazily.

    Write the manifest to a table and read the archives it names. Of rows with equal payloads of
    `least` bytes or more, that with the smallest page_id is a response and the others revisits; rows
    that share this page_id are all responses. A null html is an empty payload, a null url leaves its
    line out. A null page_id is never referred to, nor a group without any other. Other columns are
    not written. An empty table writes no file.
    """
    spark = pages.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop)
    # A path without a scheme lies in the cluster's default file system, not on an executor's own disk.
    uri = str(system.makeQualified(hadoop).toString())
    return typed(pages, least).mapInArrow(_write_batches(uri, date, roll, level), MANIFEST)


# ---- reading ------------------------------------------------------------------------------------

class Damaged(Exception):
    """A check failed."""


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith(VERSION.decode()):
        raise Damaged("no version line")
    fields = {}
    unfolded: list[str] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and unfolded:
            # A folded line goes on with the field before it.
            unfolded[-1] += " " + line.strip()
        else:
            unfolded.append(line)
    for line in unfolded:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("bad header line")
        name = name.strip().lower()
        if name in fields and name != "warc-concurrent-to":
            # The end of one header lost, another record's runs on in it.
            raise Damaged("repeated header field")
        fields[name] = value.strip()
    return fields


def check(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of the bytes of one whole record; Damaged if any check fails."""
    head, found, rest = data.partition(BREAK)
    if not found:
        raise Damaged("header not ended")
    fields = _fields(head)
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no content length")
    block = rest[:int(length)]
    if rest[int(length):] != BREAK or len(block) != int(length):
        raise Damaged("wrong content length")
    said = fields.get("warc-block-digest", "")
    if not digest_fits(said, block):
        raise Damaged("wrong block digest")
    return fields, block


class Archive:
    """Records and gaps of one file, in order; holds one record and a few read buffers."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def _read(self, at: int, n: int = CHUNK) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at))

    def _member(self, start: int) -> tuple[bytes, int]:
        """The content of the gzip member at start, and where it ends; zlib checks its length and CRC."""
        import zlib

        unpack, parts, at = zlib.decompressobj(31), [], start
        try:
            while not unpack.eof:
                raw = self._read(at)
                if not raw:
                    raise Damaged("member not ended")
                at += len(raw)
                parts.append(unpack.decompress(raw))
        except zlib.error as e:
            raise Damaged("bad member") from e
        return b"".join(parts), at - len(unpack.unused_data)

    def _plain(self, start: int) -> tuple[bytes, int]:
        """The bytes of the plain record at start."""
        head, at = b"", start
        while BREAK not in head:
            raw = self._read(at, 8192)
            if not raw or len(head) > CHUNK:
                raise Damaged("header not ended")
            head, at = head + raw, at + len(raw)
        head = head.partition(BREAK)[0]
        length = _fields(head).get("content-length", "")
        if not length.isdigit():
            raise Damaged("no content length")
        whole = len(head) + 2 * len(BREAK) + int(length)
        if start + whole > self.size:
            raise Damaged("record not ended")
        return self._read(start, whole), start + whole

    def _begins(self, at: int, packed: bool) -> bool:
        import zlib

        if not packed:
            # What a record before it has lost may include its last line end.
            line = self._read(at, 16).partition(b"\r\n")
            return bool(line[1]) and line[0][len(VERSION):].isdigit()
        try:
            return zlib.decompressobj(31).decompress(self._read(at, 512), 7) == VERSION
        except zlib.error:
            return False

    def _next(self, at: int) -> int:
        """The next place from `at` at which a record seems to begin, packed or plain; else the end of the file."""
        while at < self.size:
            raw = self._read(at, CHUNK + len(VERSION) - 1)
            found = []
            for mark, packed in ((MAGIC, True), (VERSION, False)):
                place = raw.find(mark)
                while place >= 0:
                    if self._begins(at + place, packed):
                        found.append(at + place)
                        break
                    place = raw.find(mark, place + 1)
            if found:
                return min(found)
            at += CHUNK
        return self.size

    def __iter__(self) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
        """(start, stop, reason of a gap or None, fields, block)."""
        at, gap, reason = 0, None, ""
        while at < self.size:
            try:
                packed = self._read(at, len(MAGIC)) == MAGIC
                data, stop = self._member(at) if packed else self._plain(at)
                fields, block = check(data)
            except Damaged as e:
                if gap is None:
                    gap, reason = at, str(e)
                at = self._next(at + 1)
                continue
            if gap is not None:
                yield gap, at, reason, {}, b""
                gap = None
            yield at, stop, None, fields, block
            at = stop
        if gap is not None:
            yield gap, self.size, reason, {}, b""


def _number(field: str | None) -> int | None:
    text = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def described(fields: dict[str, str], block: bytes) -> tuple:
    """record_type, page_id, refers_to, uri, payload_digest, payload_bytes, payload; Damaged if the payload fails its digest."""
    import hashlib

    kind = fields.get("warc-type", "")
    head, payload = b"", block
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(BREAK)
    said, length = fields.get("warc-payload-digest", ""), fields.get("x-payload-length", "")
    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    if kind == "revisit":
        digest, size = said.removeprefix("sha256:") or None, int(length) if length.isdigit() else None
    elif b"transfer-encoding:" not in head.lower() and not digest_fits(said, payload):
        # Archives differ in what they take the digest of where a transfer encoding lies over the payload.
        raise Damaged("wrong payload digest")
    return kind, _number(fields.get("warc-record-id")), _number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), digest, size, payload


def _read_batches(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap", pa.string()), ("record_type", pa.string()),
            ("page_id", pa.int64()), ("refers_to", pa.int64()), ("uri", pa.string()), ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = open_system(path)
                rows, held = [], 0
                with system.open_input_file(name) as file:
                    for start, stop, gap, fields, block in Archive(file, file.size()):
                        told = (None,) * 7
                        if gap is None:
                            try:
                                told = described(fields, block)
                            except Damaged as e:
                                gap = str(e)
                        payload = told[6] if payloads else None
                        rows.append((path, start, stop, gap, *told[:6], payload))
                        held += 256 + len(payload or b"")
                        if held > 8 * CHUNK:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives named in `path`, in RECORD's columns; a gap has a reason in `gap`.

    Files are packed member by member or plain. Bytes that are no record, at the front, between
    records or at the end, are one gap until the next record. An empty file has no rows.
    """
    spark = archives.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, F.xxhash64("path")).mapInArrow(_read_batches(payloads), RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 100) -> DataFrame:
    """Write pages to archives in a folder of the shared scratch, and read all records back, without payloads.

    Raises if a record does not come back whole.
    """
    scratch = Scratch(spark)
    folder = scratch_path(spark, "warc")
    manifest = scratch.write(write(pages, folder, least), "manifest")
    scratch.keep(folder)
    out = scratch.write(read(manifest, payloads=False), "records")
    written = manifest.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    whole, gaps = out.agg(F.count_if(F.col("gap").isNull()), F.count("gap")).first()
    if gaps or whole != written:
        raise RuntimeError(f"{written} records were written, {whole} came back whole, with {gaps} gaps")
    scratch.later()
    return out
