"""WARC archives in Zstandard, with a dictionary in the leading frame (operator 1).

Writing: a task trains a dictionary on an archive's first records and emits one
binary value an archive of about ``ROLL_BYTES``: the dictionary in a skippable
frame, and one Zstandard frame a record.  Spark's text writer puts each value
into a file of its own, ended by an empty skippable frame, which every decoder
ignores; its commit protocol keeps a retried or speculative task from leaving
half an archive, and any file system that Spark writes to will do.

Reading: archives come as (path, content) from the binary source.  A task loads
the dictionary of the leading frame, walks the block headers to the end of each
frame, decodes it, and checks the version line, the mandatory headers, the
lengths and the digests of each record.  The time is linear in the archive, and
a record that decodes to more than the limit is reported without being held.
An archive must fit Spark's limit for one binary value (2 GB).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage, scratch_folder

#: Fixed values of the formats.
DICT_MAGIC = 0x184D2A5D
SKIP_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"           # skippable frame 0x184D2A50 of no bytes
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICT_BYTES = 16 << 10
DICT_RECORDS = 400         # records a task trains its dictionary on, at most
DICT_SAMPLE = 2 << 20      # and bytes
LEVEL = 3
MAX_RECORD = 1 << 30       # decoded bytes of one record; longer ones are reported, not decoded
ROLL_BYTES = 32 << 20      # an archive is closed when it has so many bytes
DATE = datetime(2000, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")    # same input, same archive

READ_SCHEMA = ("path string, offset long, record_type string, record_id string, target_uri string, page_id long, refers_to long, "
               "payload_digest string, payload_bytes long, payload binary, error string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column, from built-in functions."""
    digest = F.sha1(payload)
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0"),
                                  "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for k in range(4)])


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record.  A revisit holds the HTTP header alone; its
    Content-Length still tells the payload's size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{uri}|{digest}")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE)]
    if uri is not None:
        head.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}")]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def frames(records: Iterator[bytes], roll: int | None = None) -> Iterator[bytes]:
    """The leading dictionary frame (left out if the first records cannot train
    one), then one frame a record; after ``roll`` bytes no further record is
    taken.  Holds ``DICT_SAMPLE`` bytes at most, and one record."""
    first, size = [], 0
    for r in records:
        first.append(r)
        size += len(r)
        if len(first) >= DICT_RECORDS or size >= DICT_SAMPLE:
            break
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, [r[:DICT_BYTES] for r in first]) if len(first) > 8 else None
    except zstandard.ZstdError:
        trained = None
    if trained is not None:
        data = trained.as_bytes()
        yield struct.pack("<II", DICT_MAGIC, len(data)) + data
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    done = 0
    for r in first:
        frame = compressor.compress(r)
        done += len(frame)
        yield frame
    first.clear()
    while roll is None or done < roll:
        r = next(records, None)
        if r is None:
            return
        frame = compressor.compress(r)
        done += len(frame)
        yield frame


def parse(data: bytes) -> dict:
    """Fields of one decoded record; ValueError if it is not a valid one."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("no end of headers")
    version, *lines = data[:end].split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError(f"version line {version[:20]!r}")
    head = {}
    for line in lines:
        name, sep, value = line.partition(b":")
        if not sep or not name or name != name.strip():
            raise ValueError(f"header line {line[:40]!r}")
        head[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if missing := [m for m in MANDATORY if m not in head]:
        raise ValueError(f"no {', '.join(missing)}")
    if not head["content-length"].isdigit():
        raise ValueError("content-length is no number")
    n = int(head["content-length"])
    block, tail = data[end + 4:end + 4 + n], data[end + 4 + n:]
    if len(block) != n or tail != b"\r\n\r\n":
        raise ValueError(f"content-length {n}, but the record holds {len(data) - end - 8} bytes")
    if "warc-block-digest" in head and head["warc-block-digest"].removeprefix("sha1:") != digest_of(block):
        raise ValueError("block digest differs")
    out = {"record_type": head["warc-type"], "record_id": head["warc-record-id"], "target_uri": head.get("warc-target-uri"),
           "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload": None, "payload_bytes": None}
    for column, name in (("page_id", "x-page-id"), ("refers_to", "x-refers-to-page-id")):
        out[column] = int(head[name]) if name in head else None
    if head.get("content-type", "").startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        sizes = [line.split(b":")[1].strip() for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        if not sep or len(sizes) != 1 or not sizes[0].isdigit():
            raise ValueError("no HTTP header with one content-length")
        out["payload_bytes"] = int(sizes[0])
        if out["record_type"] == "response":
            if len(payload) != int(sizes[0]):
                raise ValueError("payload length differs from the HTTP content-length")
            out["payload"] = payload
    elif out["record_type"] != "revisit":
        out["payload"], out["payload_bytes"] = block, len(block)
    if out["payload"] is not None and out["payload_digest"] not in (None, digest_of(out["payload"])):
        raise ValueError("payload digest differs")
    return out


def frame_end(view: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, by its block headers; EOFError
    if that is beyond the archive."""
    head = bytes(view[at:at + 18])
    try:
        end, checksum = at + zstandard.frame_header_size(head), zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        if len(head) < 18 and head[:4] == struct.pack("<I", FRAME_MAGIC):
            raise EOFError("archive ends inside a frame") from e
        raise
    last = False
    while not last:
        if end + 3 > len(view):
            raise EOFError("archive ends inside a frame")
        block = int.from_bytes(view[end:end + 3], "little")
        last, kind = bool(block & 1), block >> 1 & 3
        if kind == 3:
            raise zstandard.ZstdError("reserved block type")
        end += 3 + (1 if kind == 1 else block >> 3)
    end += 4 if checksum else 0
    if end > len(view):
        raise EOFError("archive ends inside a frame")
    return end


def decode_frame(decoder: zstandard.ZstdDecompressor, frame: memoryview, limit: int) -> bytes:
    """Content of one frame; ValueError as soon as it is longer than ``limit``."""
    size = zstandard.frame_content_size(bytes(frame[:18]))
    if size > limit:
        raise ValueError(f"longer than {limit} bytes")
    if size >= 0:
        return decoder.decompress(frame)
    parts, held = [], 0
    with decoder.stream_reader(frame) as reader:
        while part := reader.read(1 << 18):
            parts.append(part)
            held += len(part)
            if held > limit:
                raise ValueError(f"longer than {limit} bytes")
    return b"".join(parts)


def read_archive(content: bytes, max_record: int = MAX_RECORD) -> Iterator[dict]:
    """Records of one archive with their offset; what cannot be read comes as a
    row with ``error``.  A frame that is cut off or not Zstandard ends the
    archive; a bad record inside a good frame, or one that decodes to more than
    ``max_record`` bytes, does not."""
    view, at, decoder = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        try:
            if len(view) - at < 8:
                raise EOFError("archive ends inside a frame")
            magic, size = struct.unpack_from("<II", view, at)
            if magic in SKIP_MAGICS:
                if at + 8 + size > len(view):
                    raise EOFError("archive ends inside a skippable frame")
                if magic == DICT_MAGIC and at == 0:
                    data = bytes(view[8:8 + size])
                    if data[:4] == struct.pack("<I", FRAME_MAGIC):      # the dictionary may itself be compressed
                        try:
                            data = decode_frame(zstandard.ZstdDecompressor(), memoryview(data), max_record)
                        except ValueError as e:
                            raise EOFError(f"dictionary {e}") from e
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
                at += 8 + size
                continue
            end = frame_end(view, at)
            try:
                row = {"offset": at, "error": None, **parse(decode_frame(decoder, view[at:end], max_record))}
            except ValueError as e:
                row = {"offset": at, "error": f"record: {e}"}
        except (EOFError, zstandard.ZstdError) as e:
            yield {"offset": at, "error": f"frame: {e}"}
            return
        yield row
        at = end


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): ``refers_to`` is set for revisits.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest page_id is the response (several rows with that id: all of
    them), the others revisit it.  A null html is an empty payload.  A null
    page_id revisits a page that has one; where no copy has an id, all are
    responses.  Other columns are ignored."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    firsts = cut_lineage(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
                         .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                         .where("n > 1 AND first_id IS NOT NULL").select(F.col("digest").alias("d"), "first_id"))
    met = rows.join(firsts, F.col("digest") == F.col("d"), "left")
    return met.select("page_id", "url", "payload", "digest",
                      F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write_archives(planned: DataFrame, path: str) -> None:
    """Archives of about ``ROLL_BYTES`` under ``path`` (any file system Spark writes to)."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records():
            for pdf in batches:
                for page, url, payload, digest, refers in zip(*(pdf[c].tolist() for c in
                                                                ("page", "url", "payload", "digest", "refers"))):
                    yield record("revisit" if refers is not None else "response", None if page is None else int(page), url,
                                 bytes(payload), digest, None if refers is None else int(refers))
        rest = records()
        while parts := list(frames(rest, ROLL_BYTES)):
            yield pd.DataFrame({"value": [b"".join(parts)]})

    # ids as text: a column of longs with nulls would reach pandas as doubles
    rows = planned.select(F.col("page_id").cast("string").alias("page"), "url", "payload", "digest",
                          F.col("refers_to").cast("string").alias("refers"))
    framed = rows.mapInPandas(emit, "value binary")
    # a cast of binary to string keeps the bytes as they are, and the text writer writes them so
    framed.select(F.col("value").cast("string")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, max_record: int = MAX_RECORD) -> DataFrame:
    """Records of all archives under ``path`` (``READ_SCHEMA``), one row a
    record; rows with ``error`` tell what is damaged, or longer than
    ``max_record`` bytes, and where.  ``payloads``:
    whether the payload itself is returned (it is checked in any case).  Empty
    files give no row."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]

        def table(rows):
            pdf = pd.DataFrame(rows, columns=columns)
            return pdf.astype({c: "Int64" for c in ("offset", "page_id", "refers_to", "payload_bytes")})
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                rows, size = [], 0
                for r in read_archive(content, max_record):
                    size += len(r.get("payload") or b"") + 500
                    if not payloads:
                        r["payload"] = None
                    rows.append({"path": name, **r})
                    if size > 16 << 20:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(decode, READ_SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder and
    read them back: (page_id, payload_bytes, payload_digest, record_type,
    refers_to), one row a page.  A damaged record raises.  No page gives no row.
    The archives are removed with the scratch tables."""
    spark = pages.sparkSession
    path = scratch_folder(spark, "warc")
    write_archives(plan_records(pages, min_bytes), path)
    back = read_archives(spark, path, payloads=False)
    whole = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat("path", F.lit(" at "), F.col("offset").cast("string"), F.lit(": "), "error")).cast("string"))
    return back.select("page_id", "payload_bytes", "payload_digest", whole.alias("record_type"), "refers_to")


#: DuckDB SQL of ``round_trip`` over pages (page_id unique).
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY sha1(h)) AS first_id FROM p),
f AS (SELECT *, [CAST('0x' || substr(x, CAST(5 * k + 1 AS INTEGER), 5) AS BIGINT) FOR k IN range(8)] AS five FROM d)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          CAST(((five[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)
                   FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f
"""
