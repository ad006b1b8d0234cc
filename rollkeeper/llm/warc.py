"""WARC archives in Zstandard with a dictionary, written from pages and read back.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary,
trained on the archive's own records; then comes one frame per record. The reader takes
the dictionary from there, decodes frame after frame from a stream, and holds each record
against its headers: version line, needed fields, Content-Length, the blank lines behind
the block, and for responses the HTTP length and the SHA-1 of the payload. A damaged
record gives a row with ``error``; if a frame can't be decoded at all, that row is the
archive's last, as nothing says where the next frame starts.

Of pages with equal payloads of at least ``MIN_SHARED`` bytes, that with the largest
page_id is the response and the others are revisits, which hold the HTTP headers only.
Rows that repeat that page_id are responses too. A null page_id is below all others, and
if all of them are null, all are responses. Null html: an empty payload. Null or odd url:
written as far as a header can hold it (control characters and blanks %-coded). A very long
payload is one frame. An empty table makes no file and no row. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import mapped
from rollkeeper.llm.files import located, new_folder, own_name, spread_files
from rollkeeper.session import written

MIN_SHARED = 1000
#: Uncompressed bytes of records in an archive.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
PAGE = "urn:rollkeeper:page:"
READ_BYTES = 64 << 10
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


class Damaged(ValueError):
    """A record or an archive that is not what its headers say."""


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given. ``digest``: SHA-1 in hex."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if uri:
        lines.append(f"WARC-Target-URI: {uri}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <{PAGE}{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    block = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary of the records; records too small or few for the trainer give a raw one, their first bytes."""
    import zstandard as z

    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    try:
        return z.train_dictionary(size, records, k=200, d=8).as_bytes()
    except z.ZstdError:
        return b"".join(records)[:1024]


def archive(records: list[bytes], level: int = 3) -> bytes:
    """The bytes of a whole archive."""
    import zstandard as z

    own = dictionary(records)
    packer = z.ZstdCompressor(level=level, dict_data=z.ZstdCompressionDict(own), write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(own)), own, *map(packer.compress, records)])


def _all(stream, n: int) -> bytes:
    parts, left = [], n
    while left and (part := stream.read(min(left, 1 << 20))):
        parts.append(part)
        left -= len(part)
    if left:
        raise Damaged("the archive ends inside its dictionary")
    return b"".join(parts)


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, decoded from a stream with a ``read(n)``."""
    import zstandard as z

    head = _all(stream, 8)
    magic, size = struct.unpack("<II", head)
    if magic != SKIPPABLE:
        raise Damaged("no dictionary frame at the start")
    own = _all(stream, size)
    if own[:4] == struct.pack("<I", FRAME):  # the dictionary may itself be packed
        own = z.ZstdDecompressor().decompressobj().decompress(own)
    opener = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(own))
    rest = b""
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        one, parts = opener.decompressobj(), []
        try:
            while not one.eof:
                rest = rest or stream.read(READ_BYTES)
                if not rest:
                    raise Damaged("the archive ends inside a frame")
                parts.append(one.decompress(rest))
                rest = one.unused_data if one.eof else b""
        except z.ZstdError as e:
            raise Damaged(f"a frame can't be decoded: {e}") from None
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """The fields and payload of one record, or ``Damaged``."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise Damaged("no WARC head")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damaged(f"not a header line: {line[:60]!r}")
        fields[name.strip().lower()] = value.strip()
    if missing := [x for x in NEEDED if not fields.get(x)]:
        raise Damaged(f"without {missing[0]}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Damaged("Content-Length is not the block's length")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    sizes = [line.partition(b":")[2].strip() for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not found or not http.startswith(b"HTTP/") or len(sizes) != 1 or not sizes[0].isdigit():
        raise Damaged("no HTTP head with a length")
    kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
    try:
        digest = base64.b32decode(digest).hex() if kind == "sha1" else ""
    except ValueError:
        digest = ""
    if len(digest) != 40:
        raise Damaged("no SHA-1 of the payload")
    own = fields["warc-record-id"].strip("<>").removeprefix(PAGE)
    out = {
        "page_id": int(own) if own else None,
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest,
        "refers_to": None,
        "payload": None,
        "error": None,
    }
    if out["record_type"] == "response":
        if len(payload) != out["payload_bytes"] or hashlib.sha1(payload).hexdigest() != digest:
            raise Damaged("the payload is not what its length and digest say")
        out["payload"] = payload
    elif out["record_type"] == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise Damaged("a revisit holds no payload and names a record")
        out["refers_to"] = int(fields["warc-refers-to"].strip("<>").removeprefix(PAGE))
    else:
        raise Damaged(f"unknown type {out['record_type'][:40]}")
    return out


READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string()),
    ]
)
READ_DDL = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary, error string"
)


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses), for each page."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= MIN_SHARED
    # Written, so that the join sees a table: small ones are broadcast, else hot digests are split.
    shared = written(
        rows.filter(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 and _last is not null")
        .drop("_n"),
        "shared-payloads",
    )
    return rows.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the records as archives below ``folder``; returns the stored table of them (path, records)."""

    def run(batches):
        number, own, size = 0, [], 0

        def close():
            nonlocal number, own, size
            path = own_name(folder, number, ".warc.zst")
            store, place = located(path)
            with store.open_output_stream(place, compression=None) as out:
                out.write(archive(own))
            row = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(own)], pa.int64())], names=["path", "records"])
            number, own, size = number + 1, [], 0
            return row

        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
            for k in range(batch.num_rows):
                own.append(record(*(c[k].as_py() for c in columns), date))
                size += len(own[-1])
                if size >= archive_bytes:
                    yield close()
        if own:
            yield close()

    return written(records.transform(mapped, run, "path string, records bigint"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives at ``path``, checked; ``error`` says what is wrong with one."""

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(batch.schema.names.index("path")).to_pylist():
                store, place = located(path)
                with store.open_input_stream(place, compression=None) as stream:
                    found = frames(stream)
                    while True:
                        try:
                            raw = next(found, None)
                        except Damaged as e:
                            rows.append({"error": f"{path}: {e}"})
                            break
                        if raw is None:
                            break
                        try:
                            row = parse(raw)
                        except (Damaged, ValueError) as e:
                            row = {"error": f"{path}: {e}"}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += 200 + len(row.get("payload") or b"")
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, READ)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, READ)

    return spread_files(archives).transform(mapped, run, READ_DDL)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, and what reading those gives."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = write_archives(plan_records(pages), new_folder(spark, "warc"))
    return read_archives(archives, payloads=False).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "error",
    )
