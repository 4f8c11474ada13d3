"""WARC archives in Zstandard: one frame for each record, and the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pass, checkpointed, open_folder, spread
from ledgerline.session import shared_dir

# fixed values: the skippable frame that holds a dictionary, a frame's magic number, names of the format
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_DATE = "2024-01-01T00:00:00Z"

LEAST_PAYLOAD = 100  # smaller payloads are never revisits
ARCHIVE_BYTES = 64 << 20  # an archive is closed when its records reach this size
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20  # of the first records of an archive, to train its dictionary
READ_BYTES = 1 << 18


def roles(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """(page_id, url, html, digest, refers_to) of pages (page_id, url, html): refers_to is null for responses.

    Of rows with equal payloads of `least` bytes or more those with the smallest page_id are responses, the others revisit
    it; a null page_id is never the smallest, and a response where no row has one. Digests are counted before the
    join, which is a plain one that adaptive execution may split.
    """
    rows = pages.selectExpr("page_id", "url", "coalesce(html, '') AS html", "sha2(coalesce(html, ''), 256) AS digest")
    large = pages.where(f"octet_length(html) >= {least}").selectExpr("page_id", "sha2(html, 256) AS digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    role = "IF(page_id <=> first, NULL, first) AS refers_to"
    return rows.join(checkpointed(firsts), "digest", "left").selectExpr("page_id", "url", "html", "digest", role)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, key: str) -> bytes:
    """One record. A revisit keeps the HTTP header, with the length of the payload, and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>",
        f"WARC-Date: {ARCHIVE_DATE}",
        f"WARC-Target-URI: {_one_line(url or '')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _trained(samples: list[bytes]) -> bytes:
    """A dictionary from the first records; their bytes themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html, digest, refers_to) into archives in a shared folder; (path, records, bytes) of each.

    A task writes one archive after another, each of about `archive_bytes` before compression, under a name of its own attempt;
    only the listed ones count, so a lost task leaves nothing that is read. The list is kept in
    the shared folder. Nulls: an empty payload or address, a missing page header. An empty table makes no archive.
    """
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def step(batches):
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        done, waiting, waiting_bytes = [], [], 0
        sink = packer = None
        size = records = number = 0

        def begin():
            nonlocal sink, packer, size, records
            raw = _trained(waiting)
            sink = files.open_output_stream(f"{base}/{name}-{len(done):04d}.warc.zst", compression=None)  # else the name would have it compressed again
            sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True, write_checksum=True)
            size = records = 0
            for one in waiting:
                put(one)
            waiting.clear()

        def put(one: bytes):
            nonlocal size, records
            sink.write(packer.compress(one))
            size, records = size + len(one), records + 1

        def close():
            nonlocal sink
            place = sink.tell()
            sink.close()
            done.append((f"{folder}/{name}-{len(done):04d}.warc.zst", records, place))
            sink = None

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))
            for page_id, url, html, digest, refers_to in zip(*columns):
                one = record(page_id, url, html.encode(), digest, refers_to, f"{folder}/{name}/{number}")
                number += 1
                if sink:
                    put(one)
                else:
                    waiting.append(one)
                    waiting_bytes += len(one)
                    if waiting_bytes >= SAMPLE_BYTES:
                        begin()
                        waiting_bytes = 0
                if sink and size >= archive_bytes:
                    close()
        if waiting:
            begin()
        if sink:
            close()
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=["path", "records", "bytes"])

    return checkpointed(arrow_pass(pages, step, "path string, records long, bytes long"))


def frames(source) -> Iterator[bytes]:
    """The records of an archive: the dictionary is taken from the leading skippable frame, each frame is decoded alone."""
    head = source.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = source.read(size)
    if len(raw) != size:
        raise ValueError("the dictionary frame is cut off")
    if raw[:4] == FRAME_MAGIC:
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    rest = source.read(READ_BYTES)
    while rest:
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not rest and not (rest := source.read(READ_BYTES)):
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(parts)
        rest = rest or source.read(READ_BYTES)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, after checks of form and lengths."""
    end = raw.find(b"\r\n\r\n")
    lines = raw[: max(end, 0)].decode().split("\r\n")
    if end < 0 or lines[0] != VERSION.decode():
        raise ValueError("not a record of this version")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.lower() in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"header {name} is missing")
    if not headers["content-length"].isdigit() or len(raw) != end + 8 + int(headers["content-length"]) or raw[-4:] != b"\r\n\r\n":
        raise ValueError("the length in the header is not that of the record")
    block = raw[end + 4 : -4]
    if headers.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
        raise ValueError("the block has another digest")
    return headers, block


def read_archives(archives: DataFrame, kind: str = "bigint", payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record in archives (path, ...).

    An archive is streamed frame by frame, so memory holds one record. A response's payload is measured and digested anew and
    compared with its headers; a revisit has the length and digest of the payload it leaves out. A
    damaged archive stops the job. `kind` is the type of page_id.
    """

    def step(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                files, at = open_folder(path)
                with files.open_input_stream(at, compression=None) as source:
                    rows = []
                    for raw in frames(source):
                        rows.append(_page(*parse(raw), payloads))
                        if len(rows) == 256:
                            yield _batch(rows, payloads)
                            rows = []
                    if rows:
                        yield _batch(rows, payloads)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    found = arrow_pass(spread(archives, "path", "bytes").select("path"), step, schema + (", payload binary" if payloads else ""))
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def _page(headers: dict[str, str], block: bytes, payloads: bool):
    end = block.find(b"\r\n\r\n")
    http = dict(line.lower().split(b": ", 1) for line in block[: max(end, 0)].split(b"\r\n")[1:])
    size, payload, digest = int(http[b"content-length"]), block[end + 4 :], headers["warc-payload-digest"].removeprefix("sha256:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("the payload is not that of the headers")
    elif kind != "revisit" or payload or "x-refers-to-page-id" not in headers:
        raise ValueError(f"unexpected record of type {kind}")
    row = (headers.get("x-page-id"), headers.get("warc-target-uri"), size, digest, kind, headers.get("x-refers-to-page-id"))
    return (*row, payload if kind == "response" else None) if payloads else row


def _batch(rows, payloads: bool) -> pa.RecordBatch:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * payloads
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
