"""WARC archives: writing, and reading that salvages what a damaged file still holds.

Each record is a gzip member of its own. The reader walks from member to
member; when a member or the record in it fails a check, it searches for the next
place where a valid member (or, outside gzip, a version line) starts, goes on
from there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise, own_folder

LEAST_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
BROADCAST_ROWS = 1_000_000
# Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"(?<![^\n])WARC/1\.[01]\r?\n")
_BEGIN = re.compile(rb"\x1f\x8b\x08|(?<![^\n])WARC/1\.[01]\r?\n")
#: Bytes in which a version line or the start of a member is seen, and headers of a record.
_LONGEST, MOST_HEADER = 16, 1 << 16
_LENGTH = re.compile(rb"^content-length:\s*(\d+)\s*$", re.I | re.M)


def plan_records(pages: DataFrame) -> DataFrame:
    """Adds to ``page_id, url, html`` the payload's size and SHA-1, and whether it is a response or a revisit of which page.

    Of rows with one payload of at least 1000 bytes, those of the largest page_id
    are responses. A null html is an empty payload; a null page_id counts as the
    smallest and is never referred to while there is another.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    again = rows.where(F.col("payload_bytes") >= LEAST_REVISIT_BYTES).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k")
    again = materialise(again, "repeated")
    if again.count() <= BROADCAST_ROWS:  # a counted bound; more are joined by shuffle
        again = F.broadcast(again)
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull(), F.col("first"))
    out = rows.join(again, "payload_digest", "left").withColumn("refers_to", refers)
    return out.select("page_id", "url", "html", "payload_bytes", "payload_digest", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to")


def _name(page_id: int | None) -> str:
    return f"<urn:tidemark:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]+", "%20", url or "urn:tidemark:unknown")
    head = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    raw = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        out, path, size, count, done = None, "", 0, 0, []

        def finish() -> None:
            nonlocal out, size, count
            if out is not None:
                out.close()
                done.append((path, size, count))
            out, size, count = None, 0, 0

        for batch in batches:
            c = [batch.column(k) for k in ("page_id", "url", "html", "payload_digest", "refers_to")]
            for k in range(batch.num_rows):
                page, url, text, digest, refers = (x[k].as_py() for x in c)
                record = encode_record(page, url, (text or "").encode(), digest, refers)
                if out is not None and size + len(record) > ARCHIVE_BYTES:
                    finish()
                if out is None:
                    # a name of this attempt's own: what a failed attempt leaves is never listed
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path, compression=None)  # members are compressed already
                out.write(record)
                size, count = size + len(record), count + 1
        finish()
        yield pa.record_batch([pa.array([x[k] for x in done], t) for k, t in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))], names=["path", "bytes", "records"])

    return run


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes planned records to archives in ``folder`` (a URI that executors reach) and returns ``path, bytes, records`` of each."""
    pyarrow.fs.FileSystem.from_uri(folder)[0].create_dir(pyarrow.fs.FileSystem.from_uri(folder)[1], recursive=True)
    return materialise(records.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(_write(folder), "path string, bytes long, records long"), "archives")


class BadRecord(ValueError):
    pass


class Source:
    """A file that is read in windows, so that no more of it is held than a record."""

    def __init__(self, file, size: int, window: int = 1 << 20):
        self.file, self.size, self.window, self.held, self.at = file, size, window, b"", 0

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``."""
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.held):
            self.file.seek(at)
            self.held, self.at = self.file.read(max(n, self.window)), at
        return self.held[at - self.at : at - self.at + n]

    def next_start(self, at: int) -> int:
        """The first place from ``at`` where a member or a version line begins; the end if there is none."""
        while at < self.size:
            before = at > 0  # one byte more, to see whether a line begins
            found = _BEGIN.search(self.get(at - before, self.window - _LONGEST), before)
            if found:
                return at - before + found.start()
            at += max(1, self.window - 3 * _LONGEST)
        return self.size


def header_length(raw: bytes, whole: bool) -> tuple[int, int] | None:
    """Where the block begins and its length; None if the headers go on beyond ``raw``, unless that is the whole."""
    if not _START.match(raw) and (whole or len(raw) >= _LONGEST):
        raise BadRecord("no version line")
    end = raw.find(b"\r\n\r\n", 0, MOST_HEADER)
    if end < 0:
        if whole or len(raw) >= MOST_HEADER:
            raise BadRecord("no end of headers")
        return None
    length = _LENGTH.search(raw, 0, end)
    if not length:
        raise BadRecord("no length")
    return end + 4, int(length[1])


def parse_record(raw: bytes, whole: bool = True) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and the length of the record at the start of ``raw``; raises BadRecord where a check fails.

    None if the record goes on beyond ``raw``, unless that is the whole.
    """
    sizes = header_length(raw, whole)
    if sizes is None:
        return None
    start, size = sizes
    if len(raw) < start + size + 4 and not whole:
        return None
    block = bytes(raw[start : start + size])
    if len(block) < size or raw[start + size : start + size + 4] != b"\r\n\r\n":
        raise BadRecord("the block has another length")
    head = {}
    for line in bytes(raw[: start - 4]).split(b"\r\n")[1:]:
        key, _, value = line.decode("utf-8", "replace").partition(":")
        head[key.strip().lower()] = value.strip()
    declared = head.get("warc-block-digest", "").partition(":")
    if declared[0].lower() == "sha1" and declared[2].lower() != hashlib.sha1(block).hexdigest():
        raise BadRecord("the block has another digest")
    return head, block, start + size + 4


def _member(source: Source, at: int) -> Iterator[tuple]:
    """The valid records of a gzip member, inflated in steps; last ``("end", place, problem, whether the member itself is whole)``."""
    inflate, raw, pos, step, problem, held = zlib.decompressobj(31), bytearray(), at, 1 << 12, None, None
    while not inflate.eof:
        chunk = source.get(pos, step)
        if not chunk:
            problem = problem or "the member is cut short"
            break
        try:
            raw += inflate.decompress(chunk)
        except zlib.error as bad:
            problem = problem or str(bad)
            break
        pos, step = pos + len(chunk), min(1 << 16, 2 * step)
        while raw:
            try:
                got = parse_record(raw, inflate.eof)
            except BadRecord as bad:
                problem = problem or str(bad)
                line = _START.search(raw, 1)
                del raw[: line.start() if line else max(1, len(raw) - _LONGEST)]
                if not line:
                    break
                continue
            if got is None:
                break
            if held:
                yield "record", at, pos, held
            held = got[:2]
            del raw[: got[2]]
    end = pos - len(inflate.unused_data)
    if held and inflate.eof:  # the last record counts only if the member's own checks hold
        yield "record", at, end, held
    if inflate.eof and not held:
        problem = problem or "the member holds no record"
    yield "end", end, problem, inflate.eof


def _plain(source: Source, at: int) -> Iterator[tuple]:
    """The record outside gzip that starts here, then as ``_member``."""
    try:
        start, size = header_length(source.get(at, MOST_HEADER), True)
        if source.get(at + start + size, 4) != b"\r\n\r\n":
            raise BadRecord("the block has another length")
        head, block, length = parse_record(source.get(at, start + size + 4))
    except BadRecord as bad:
        yield "end", at, str(bad), False
        return
    yield "record", at, at + length, (head, block)
    yield "end", at + length, None, True


def salvage(data: bytes | Source) -> Iterator[tuple[str, int, int, object]]:
    """``("record", start, end, (headers, block))`` of each valid record and ``("gap", start, end, reason)`` of what lies between.

    A member may hold several records; each valid one counts, and the member is a gap
    as well if others in it, or the member itself, fail. The time grows with the
    file's length, and what is held with its longest record.
    """
    source = Source(io.BytesIO(data), len(data)) if isinstance(data, bytes) else data
    at, gap, reason = 0, None, ""
    while at < source.size:
        for kind, *what in _member(source, at) if source.get(at, 3) == MAGIC else _plain(source, at):
            if kind == "record":
                if gap is not None and gap < at:
                    yield "gap", gap, at, reason
                gap = None
                yield kind, *what
                continue
            end, problem, whole = what
            if problem and gap is None:
                gap, reason = at, problem
            if problem and whole:  # what is wrong is inside the member
                yield "gap", gap, end, reason
                gap = None
            at = end if whole else source.next_start(at + 1)
    if gap is not None:
        yield "gap", gap, source.size, reason


def _page_of(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:tidemark:page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def describe(head: dict[str, str], block: bytes) -> tuple[int | None, str | None, int, str, str, int | None]:
    """page_id, url, payload size and digest, type and the page referred to; raises BadRecord if the payload differs from its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = _LENGTH.search(http)
    digest = head.get("warc-payload-digest", "").partition(":")[2].lower()
    kind = head.get("warc-type", "")
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or (length and int(length[1]) != len(payload))):
        raise BadRecord("the payload has another digest")
    size = len(payload) if kind == "response" else int(length[1]) if length else 0
    return _page_of(head.get("warc-record-id", "")), head.get("warc-target-uri"), size, digest, kind, _page_of(head.get("warc-refers-to", ""))


_READ = "path string, start long, end long, gap string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


_ROWS = 1 << 12


def _made(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_TYPES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=[x.split()[0] for x in _READ.split(", ")])


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(path) as f:
                    rows = []
                    for kind, start, end, what in salvage(Source(f, f.size())):
                        try:
                            row = (None, *describe(*what)) if kind == "record" else (what, *[None] * 6)
                        except BadRecord as problem:
                            row = (str(problem), *[None] * 6)
                        rows.append((path, start, end, *row))
                        if len(rows) == _ROWS:
                            yield _made(rows)
                            rows = []
                    yield _made(rows)

    return run


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """All records of the archives and, with ``gap`` set to the reason, the byte ranges that were quarantined.

    ``archives`` has the column ``path`` (in the file system of ``folder``); the files are
    dealt out evenly and each is read by one task, a window at a time. Valid records have a null
    ``gap``; a damaged part gives one row with its range and reason, and the records
    after it are recovered.
    """
    paths = archives.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(_read(folder), _READ)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes a record for every page and reads the archives back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to,
    path, start, end`` of every record; quarantined gaps are not among them (see
    ``read_archives``). Repeated rows give a record each; rows that tie for the
    largest page_id of a payload are all responses; null html is an empty
    payload; an empty table gives an empty result; further columns are not read.
    """
    folder = own_folder(pages.sparkSession, "warc")
    archives = write_archives(plan_records(pages), folder)
    return read_archives(archives, folder).where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "start", "end")
