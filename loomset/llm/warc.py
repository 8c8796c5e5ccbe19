"""WARC archives in Zstandard: one dictionary, one frame for each record.

An archive starts with a skippable frame that holds the dictionary, itself compressed
or plain, and goes on with one frame for each record.  Archives are rows (name,
content): the writer makes them, and the reader takes its own or the files that Spark
reads with ``format("binaryFile")``, whatever tool made them: every record type of the
standard, HTTP heads before the payload, digests in base32 or hex or none at all.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.words import stored

DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
#: An archive is closed when its records have this many bytes before compression.
ARCHIVE_BYTES = 4 << 20
#: The dictionary is trained on up to this many bytes from the start of its archive.
SAMPLE_BYTES = 256 << 10
DICTIONARY_BYTES = 16 << 10
VERSION = b"WARC/1.1"
#: Shorter payloads are always stored.
LEAST_REVISIT = 1000
#: Up to this many repeated payloads, of some 150 bytes each, are broadcast.
BROADCAST_PAYLOADS = 100_000
#: Beyond, the pages of one payload go to this many places of the shuffle.
SALTS = 16
#: Record types of the standard.
TYPES = frozenset(
    "warcinfo response resource request metadata revisit conversion continuation".split()
)
#: Bytes of a digest, by the name of its algorithm.
DIGESTS = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}


class BadArchive(ValueError):
    """An archive that does not follow the format."""


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers: int | None) -> bytes:
    """One record, headers and block.  A revisit has no block of its own."""
    block = b"" if kind == "revisit" else payload
    known = uuid.uuid5(uuid.NAMESPACE_OID, f"{page}:{digest}")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{known}>"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(size)),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    if page is not None:
        headers.append(("X-Page-Id", str(page)))
    if refers is not None:
        headers.append(("X-Refers-To-Page-Id", str(refers)))
    if kind == "revisit":
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """Records as one archive.  Too few or too equal records have an empty dictionary."""
    sample, size = [], 0
    for x in records:
        sample.append(x[: 8 << 10])
        size += len(sample[-1])
        if size > SAMPLE_BYTES:
            break
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample) if len(sample) >= 16 else None
    except zstandard.ZstdError:  # nothing in common
        trained = None
    raw = trained.as_bytes() if trained else b""
    body = zstandard.ZstdCompressor().compress(raw) if raw else b""
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
    parts = [struct.pack("<II", DICTIONARY_FRAME, len(body)), body]
    parts += [packer.compress(x) for x in records]
    return b"".join(parts)


def _dictionary(content: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in the leading skippable frame, and where the records start."""
    if len(content) < 8:
        raise BadArchive("shorter than the head of a frame")
    magic, size = struct.unpack_from("<II", content)
    if magic == FRAME:
        return None, 0
    if magic != DICTIONARY_FRAME:
        raise BadArchive("starts neither with a dictionary nor with a record")
    body = content[8 : 8 + size]
    if len(body) != size:
        raise BadArchive("the dictionary is cut off")
    if body[:4] == struct.pack("<I", FRAME):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    return (zstandard.ZstdCompressionDict(body) if body else None), 8 + size


def frames(content: bytes) -> Iterator[bytes]:
    """The decompressed frames of an archive, one after the other."""
    known, at = _dictionary(content)
    unpacker = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    view = memoryview(content)[at:]
    while len(view):
        if len(view) >= 8 and view[0] >> 4 == 5 and view[1:4] == b"\x2a\x4d\x18":  # skippable
            end = 8 + int.from_bytes(view[4:8], "little")
            if end > len(view):
                raise BadArchive("the last frame is cut off")
            view = view[end:]
            continue
        one = unpacker.decompressobj()
        try:
            data = one.decompress(view)
        except zstandard.ZstdError as e:
            raise BadArchive(f"a frame can't be read: {e}") from e
        if not one.eof:
            raise BadArchive("the last frame is cut off")
        view = view[len(view) - len(one.unused_data) :]
        yield data


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record; both are checked."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/1."):
        raise BadArchive("no WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise BadArchive(f"no header: {name[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "content-length"):
        if name not in headers:
            raise BadArchive(f"no {name}")
    length = headers["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the block is not as long as its header says")
    return headers, rest[:-4]


def digest_of(header: str) -> tuple[str, str] | None:
    """Algorithm and lower-case hex of a digest header, which may be in hex or base32.

    None for algorithms that are not known; they can't be checked.
    """
    name, _, value = header.partition(":")
    name, value = name.strip().lower(), value.strip()
    size = DIGESTS.get(name)
    if size is None:
        return None
    if len(value) == 2 * size:
        return name, bytes.fromhex(value).hex()
    value = value.rstrip("=").upper()
    raw = base64.b32decode(value + "=" * (-len(value) % 8))
    if len(raw) != size:
        raise BadArchive(f"no {name} digest: {header[:80]}")
    return name, raw.hex()


def _fits(header: str | None, data: bytes) -> bool:
    known = digest_of(header) if header else None
    return known is None or hashlib.new(known[0], data).hexdigest() == known[1]


def dechunked(body: bytes) -> bytes | None:
    """A body in HTTP's chunked coding as it was before; None if it is not so coded."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
        if body[at - 2 : at] != b"\r\n":
            return None


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The payload in a block, checked against the record's digests.

    An HTTP message's payload is its body as it stands or, if only that fits the digest,
    without chunked coding.  A record that says it was truncated keeps what it has.
    """
    if not _fits(headers.get("warc-block-digest"), block):
        raise BadArchive("the block is not what its digest says")
    payload = block
    if headers.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    digest = headers.get("warc-payload-digest")
    if "warc-truncated" in headers or _fits(digest, payload):
        return payload
    plain = dechunked(payload) if payload is not block else None
    if plain is None or not _fits(digest, plain):
        raise BadArchive("the payload is not what its digest says")
    return plain


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives (name, content) of ``pages`` (page_id, url, html), in the shared folder.

    Of records with equal payloads of LEAST_REVISIT bytes or more, that with the
    largest page_id is the response; the others are revisits of it.  Shorter ones are
    responses.  A NULL html is empty; a row without a page_id is a response and is
    never referred to.  Of rows with one page_id and payload, all are responses, as a
    page does not revisit itself.
    """
    size = F.octet_length(F.coalesce("html", F.lit("")))
    # short payloads meet nobody; keys of their own keep them from one task
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    base = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), size.alias("size")
    ).withColumn("sha", F.when(F.col("size") >= LEAST_REVISIT, F.sha2("html", 256)).otherwise(alone))
    copies = base.filter((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy("sha", "size")
    last = copies.agg(F.max("page_id").alias("refers"), F.min("page_id").alias("_first"))
    last = stored(last.filter("_first < refers").drop("_first"))
    keys = ["sha", "size"]
    if last.count() <= BROADCAST_PAYLOADS:  # html is not shuffled
        last = F.broadcast(last)
    else:
        keys.append("_salt")
        base = base.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
        last = last.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        last = last.withColumn("_salt", F.col("_salt").cast("bigint"))
    told = base.join(last, keys, "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") < F.col("refers"), F.col("refers")).alias("refers")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def closed() -> pa.RecordBatch:
            content = archive(held)
            name = f"{hashlib.sha256(content).hexdigest()[:24]}.warc.zst"
            return pa.record_batch({"name": [name], "content": pa.array([content], pa.binary())})

        for batch in batches:
            html = batch.column("html").cast(pa.binary())
            columns = (batch.column("page_id"), batch.column("url"), html, batch.column("refers"))
            for page, url, payload, refers in zip(*(c.to_pylist() for c in columns)):
                kind = "response" if refers is None else "revisit"
                digest = hashlib.sha1(payload).hexdigest()
                held.append(record(kind, page, url, payload, digest, len(payload), refers))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    return stored(told.mapInArrow(pack, "name string, content binary"))


_READ = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary, error string, "
    "record_id string, refers_to_record string, refers_to_url string"
)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``archives`` (content binary), one row each, of every type.

    ``payload`` is NULL for revisits, and for all unless ``payloads``; of HTTP messages
    it is the body.  ``payload_digest`` is its SHA-1 in hex, counted anew; that of a
    revisit is taken from its header, and NULL unless that is a SHA-1.  A revisit names
    its response by page (archives of this writer), record or address.  A digest or
    length that does not fit, an unknown record type, and whatever breaks the format,
    gives a row with ``error``; what follows a broken frame in its archive can't be
    found and is lost with it.  NULL or empty content gives an error row, no archives
    give none.
    """
    fields = [x.split()[0] for x in _READ.split(", ")]

    def one(data: bytes) -> dict:
        headers, block = parse(data)
        kind = headers["warc-type"].lower()
        if kind not in TYPES:
            raise BadArchive(f"unknown record type {kind[:40]}")
        size = headers.get("x-payload-length")
        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
        row = {
            "page_id": None if page is None else int(page),
            "url": headers.get("warc-target-uri"),
            "payload_bytes": None if size is None else int(size),
            "record_type": kind,
            "refers_to": None if refers is None else int(refers),
            "record_id": headers["warc-record-id"],
            "refers_to_record": headers.get("warc-refers-to"),
            "refers_to_url": headers.get("warc-refers-to-target-uri"),
        }
        digest = headers.get("warc-payload-digest")
        if kind == "revisit":
            told = (refers, row["refers_to_record"], row["refers_to_url"], digest)
            if not any(told) or not _fits(headers.get("warc-block-digest"), block):
                raise BadArchive("a revisit has a reference, and the block that it says")
            known = digest_of(digest) if digest else None
            return row | {"payload_digest": known[1] if known and known[0] == "sha1" else None}
        payload = payload_of(headers, block)
        if size is not None and int(size) != len(payload):
            raise BadArchive("the payload is not as long as its header says")
        row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        return row | ({"payload": payload} if payloads else {})

    def rows(content: bytes | None) -> Iterator[dict]:
        if not content:
            yield {"error": "no content"}
            return
        try:
            for data in frames(content):
                try:
                    yield one(data)
                except (BadArchive, ValueError) as e:
                    yield {"error": str(e)}
        except BadArchive as e:
            yield {"error": str(e)}

    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    types += (pa.string(),) * 4
    schema = pa.schema(list(zip(fields, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held = []
                for row in rows(content.as_py()):
                    held.append(row)
                    if len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("content").mapInArrow(run, _READ)
