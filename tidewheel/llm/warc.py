"""WARC archives compressed with Zstandard: a writer, and a reader that checks what it reads.

An archive is a skippable frame that holds a dictionary, then one frame for each record. The writer trains
the dictionary on the archive's first payloads; of equal payloads of REVISIT bytes or more the one with the
smallest page id is a response and the others revisit it. The reader loads the dictionary, decodes frame by
frame, and raises on a bad frame, version line, header, length or digest.

Null payloads are empty, null addresses about:blank; a null page id is an empty one in the record's id, and
rows of equal page id and payload are all of one type. No pages give no archives and no records. Payloads of any
length are one record each. Other columns play no part. A task that is run again, or twice, leaves each archive once.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import byte_rows, written

REVISIT, SALTS = 100, 16
#: Payload bytes an archive gathers, of which so many train a dictionary of at most so many bytes.
ARCHIVE, TRAIN, DICTIONARY = 16 << 20, 1 << 20, 32 << 10
#: Fixed values of the formats.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
PAGE, PROFILE, END = "urn:x-page:", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    name = "" if page_id is None else str(page_id)
    address = "".join(url.split()) if url and url.strip() else "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + END
    headers = [("WARC-Record-ID", f"<{PAGE}{name}>"), ("WARC-Date", DATE), ("WARC-Target-URI", address), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{PAGE}{refers_to}>")], http)


def archive(records: list[bytes], samples: list[bytes]) -> bytes:
    """The dictionary frame, then a frame for each record."""
    held, kept = 0, []
    for s in samples:
        if held < TRAIN and s:
            kept.append(s[: TRAIN - held])
            held += len(kept[-1])
    try:
        words = zstandard.train_dictionary(DICTIONARY, kept)
    except zstandard.ZstdError:  # too few samples to train on: their bytes serve as they are
        words = zstandard.ZstdCompressionDict(b"".join(kept)[-DICTIONARY:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = words.as_bytes()
    one = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=True, write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(raw)) + raw + b"".join(one.compress(r) for r in records)


def place(store: pyarrow.fs.FileSystem, aside: str, name: str) -> None:
    """Gives a finished archive its name, unless another attempt of the task has written that archive, the same, already."""
    there = lambda: store.get_file_info(name).type == pyarrow.fs.FileType.File
    if not there():
        try:
            store.move(aside, name)
            return
        except OSError:
            if not there():
                raise
    store.delete_file(aside)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pyarrow.fs.FileSystem.from_uri(folder)
        part, seq = TaskContext.get().partitionId(), 0
        records: list[bytes] = []
        samples: list[bytes] = []
        held = 0

        def done():
            nonlocal seq, held
            info = record("warcinfo", [("WARC-Record-ID", f"<urn:x-archive:{part}-{seq}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            raw, name = archive([info, *records], samples), f"{top}/part-{part:05d}-{seq:05d}.warc.zst"
            aside = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
            with store.open_output_stream(aside) as f:
                f.write(raw)
            place(store, aside, name)
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([len(raw)], pa.int64())], ["archive", "records", "bytes"])
            seq, held = seq + 1, 0
            records.clear()
            samples.clear()
            return out

        for batch in batches:
            ids, urls, _, sizes, digests, refers = (batch.column(k).to_pylist() if k != 2 else None for k in range(6))
            for i, payload in enumerate(byte_rows(batch.column(2))):
                records.append(page_record(ids[i], urls[i], payload, sizes[i], digests[i], refers[i]))
                if refers[i] is None:
                    samples.append(payload)
                held += len(records[-1])
                if held >= ARCHIVE:
                    yield done()
        if records:
            yield done()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes folder/*.warc.zst; returns (archive, records, bytes) for each, read back from a written table.

    Payloads are compared by digest in narrow rows, dealt with a salt, so that a payload that a third of the
    pages share does not meet in one task; the pages themselves are dealt by that join once, at most.
    """
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    wide = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text.alias("html"), F.octet_length(text).cast("long").alias("size"), F.sha2(text, 256).alias("digest"))
    narrow = wide.where(F.col("size") >= REVISIT).select("page_id", "digest")
    several = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    several = several.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt")
    again = narrow.select("page_id", "digest", salt).join(several, ["digest", "salt"]).where(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again"), "first").distinct()
    joined = wide.join(again, wide["page_id"].eqNullSafe(again["again_id"]) & (wide["digest"] == again["again"]), "left")
    stored = joined.select("page_id", "url", F.when(F.col("first").isNull(), F.col("html")).otherwise("").alias("html"), "size", "digest", "first")
    dealt = stored.sortWithinPartitions("page_id", "digest", "url")
    uri = folder if "://" in folder else folder.replace("file:", "", 1)
    store, top = pyarrow.fs.FileSystem.from_uri(uri)
    store.create_dir(top)
    return written(dealt.mapInArrow(_write(uri), "archive string, records long, bytes long"), "archives")


# --- reading ----------------------------------------------------------------------------------------


def frame_size(raw: memoryview, at: int) -> int:
    """Bytes of the Zstandard frame at a place: its header, its blocks, its checksum."""
    head = bytes(raw[at : at + 18])
    if head[:4] != FRAME:
        raise ValueError(f"no Zstandard frame at byte {at}")
    to = at + zstandard.frame_header_size(head)
    while True:
        if to + 3 > len(raw):
            raise ValueError(f"the frame at byte {at} is cut off")
        block = int.from_bytes(raw[to : to + 3], "little")
        to += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    to += 4 * zstandard.get_frame_parameters(head).has_checksum
    if to > len(raw):
        raise ValueError(f"the frame at byte {at} is cut off")
    return to - at


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one whole record; raises if anything is amiss."""
    version, _, rest = raw.partition(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError(f"bad version line {version[:40]!r}")
    head, gap, body = rest.partition(END)
    headers = _headers(head)
    if not gap or any(k not in headers for k in ("warc-type", "warc-record-id", "warc-date", "content-length")):
        raise ValueError("a mandatory header is missing")
    size = int(headers["content-length"]) if headers["content-length"].isdigit() else -1
    if size != len(body) - 4 or body[-4:] != END:
        raise ValueError(f"content length {headers['content-length']} does not match the block")
    return headers, body[:-4]


def records_of(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of an archive's records, one frame each."""
    view, at, words = memoryview(raw), 0, None
    if len(raw) >= 8 and struct.unpack_from("<I", raw)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", raw, 4)[0]
        held = raw[8 : 8 + size]
        if len(held) != size:
            raise ValueError("the dictionary frame is cut off")
        if held[:4] == FRAME:
            held = zstandard.ZstdDecompressor().decompress(held)
        words = zstandard.ZstdCompressionDict(held) if held else None
        at = 8 + size
    one = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    while at < len(raw):
        size = frame_size(view, at)
        try:
            headers, block = parse_record(one.decompressobj().decompress(view[at : at + size]))
        except (ValueError, zstandard.ZstdError) as e:
            raise ValueError(f"record at byte {at}: {e}") from e
        yield at, headers, block
        at += size


def _page(uri: str) -> int | None:
    name = uri.strip("<>").removeprefix(PAGE)
    return int(name) if name else None


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """(page id, type, address, refers to, payload size, digest, payload) of a response or revisit; checks size and digest."""
    http, gap, payload = block.partition(END)
    status, _, rest = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP response")
    size, digest = int(_headers(rest)["content-length"]), headers["warc-payload-digest"].removeprefix("sha256:")
    refers = None
    if headers["warc-type"] == "revisit":
        refers = _page(headers["warc-refers-to"])
        if headers.get("warc-profile") != PROFILE or payload:
            raise ValueError("a revisit needs its profile and no payload")
    elif size != len(payload) or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("the payload's length or digest does not match")
    return _page(headers["warc-record-id"]), headers["warc-type"], headers.get("warc-target-uri"), refers, size, digest, payload


def _read(with_payload: bool):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["archive", "offset", "page_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for at, headers, block in records_of(raw.as_py()):
                    if headers["warc-type"] in ("response", "revisit"):
                        *page, payload = page_of(headers, block)
                        rows.append((path, at, *page, payload if with_payload else None))
                        held += len(payload) if with_payload else 0
                        if held >= ARCHIVE or len(rows) >= 10_000:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """A row for each response and revisit in folder/*.warc.zst: archive, offset, page_id, record_type, target_uri,
    refers_to, payload_bytes, payload_digest (sha256, hex) and payload (null unless asked for)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    return files.mapInArrow(_read(with_payload), "archive string, offset long, page_id long, record_type string, target_uri string, refers_to long, payload_bytes long, payload_digest string, payload binary")
