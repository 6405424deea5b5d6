"""WARC archives: writer with duplicate detection, and a salvage reader.

Writing.  One record per row, each its own gzip member.  Archives go through Spark's text writer, so
they reach any file system that Spark can write to and are committed like any Spark output:
members are raw bytes in a string column, and the line separator is an empty gzip member, so a file is
a plain sequence of members.  A file is closed before it would pass ``FILE_BYTES`` (a larger record has a file to
itself), so the files that are read back whole are bounded in bytes, not in rows.  Of rows with equal payloads (``min_dup_bytes`` at least) the one with
the smallest key is a response; the others are revisit records that name it.

Reading.  Each file is scanned member by member (or record by record, if it isn't compressed).  A
member or record counts only if its checks hold: the member inflates with a right CRC, the header parses,
the block has its ``Content-Length`` and digest and ends in two line ends.  After a failed check
the reader searches for the next gzip magic or version line from which the checks hold
again, goes on from there, and logs the bytes in between as a quarantined gap.  In a member of several
records the search for the next version line goes on in the inflated bytes.  If the member itself is
damaged, what inflated before the error (or before the next valid member) is searched too; with no right
CRC, a record there counts only if it states a block digest that holds and is not all that inflated (a
member that is one record stands or falls with its own checks).  Damage therefore costs the records it
touches, never those behind it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import prepare

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
#: An empty gzip member: separates the members of a file without adding content.
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Payloads shorter than this are never written as revisits.
MIN_DUP_BYTES = 100
#: Bytes of an archive, unless one record is larger.
FILE_BYTES = 32 << 20


def record_bytes(kind: str, record_id: str, uri: str, date: str, payload: bytes, digest: str,
                 refers_to: str | None = None) -> bytes:
    """One WARC record, not compressed.  A revisit's block is the HTTP head alone."""
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    head = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '%20', uri)}", f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha1:{block_digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def member(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def classify(pages: DataFrame, key: str, payload: str, min_dup_bytes: int = MIN_DUP_BYTES) -> DataFrame:
    """``pages`` with ``payload_digest``, ``record_type`` and ``refers_to``.

    Only (digest, key) is grouped, partially on each task; the payloads then meet the
    duplicated digests in one equi-join, which Spark splits where a digest is frequent.
    Rows equal in key and payload are alike: all are responses if their key is the smallest.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.withColumn("payload_digest", F.sha2(body, 256)).withColumn("_long", F.octet_length(body) >= min_dup_bytes)
    dup = (rows.where("_long").groupBy("payload_digest")
           .agg(F.min(F.col(f"`{key}`")).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
           .select(F.col("payload_digest").alias("_digest"), "_first"))
    later = F.col("_first").isNotNull() & ~F.col(f"`{key}`").eqNullSafe(F.col("_first"))
    return (rows.join(dup, (F.col("payload_digest") == F.col("_digest")) & F.col("_long"), "left")
            .withColumn("record_type", F.when(later, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(later, F.col("_first")))
            .drop("_long", "_digest", "_first"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html",
                   date: str = "2024-01-01T00:00:00Z", min_dup_bytes: int = MIN_DUP_BYTES,
                   records_per_file: int = 4096, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of ``pages`` to gzip archives below ``path``, of at most ``records_per_file`` records and
    ``file_bytes`` bytes (or one record).

    The record id is ``urn:key:<key>`` (no key: ``urn:key:``).  Null payloads and URIs are empty.  Only the
    three named columns are read, so further columns may have any name.
    """
    prepare(pages.sparkSession)
    rows = classify(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{uri}`").cast("string").alias("uri"),
                                 F.col(f"`{payload}`").cast("string").alias("payload")), "key", "payload", min_dup_bytes)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = rows.select(text("key").alias("key"), text("uri").alias("uri"),
                       F.when(F.col("record_type") == "response", text("payload")).otherwise("").alias("payload"),
                       "payload_digest", "record_type", text("refers_to").alias("refers_to"))

    def run(batches):
        held, size = [], 0  # a row is a file's members
        for b in batches:
            for k, u, p, digest, kind, ref in zip(*(c.to_pylist() for c in b.columns)):
                one = member(record_bytes(kind, f"urn:key:{k}", u, date, p.encode(), digest, f"urn:key:{ref}" if kind == "revisit" else None))
                if len(held) == records_per_file or held and size + len(one) + len(EMPTY_MEMBER) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])
                    held, size = [], 0
                held.append(one)
                size += len(one)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])

    (rows.mapInArrow(run, "members binary").select(F.col("members").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).text(path))


#: Header fields that a record states once.
ONCE = {"warc-type", "warc-record-id", "warc-date", "content-length"}


class Damaged(Exception):
    """A check of a member or record failed."""


#: What a header ends with, at any length, or the next version line if it has no end.
HEAD_END = re.compile(rb"\r\n\r\n|\nWARC/1\.")


def digest_holds(stated: str, data: bytes) -> bool | None:
    """Whether ``data`` has the digest ``<algorithm>:<value>`` (hex or base32, any case, padded or not); None: it cannot be told,
    as there is none or its algorithm is not known."""
    name, colon, value = stated.partition(":")
    name = name.strip().lower().replace("-", "")
    if not colon or name not in ("md5", "sha1", "sha256", "sha512"):
        return None
    value, want = value.strip().rstrip("="), hashlib.new(name, data)
    if len(value) == 2 * want.digest_size:
        return value.lower() == want.hexdigest()
    return value.upper() == base64.b32encode(want.digest()).decode().rstrip("=")


def parse_record(buf: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers (lower-case names), block and end of the record at ``at``; raises ``Damaged``."""
    if not buf.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    found = HEAD_END.search(buf, at)
    if not found or found.group() != END:
        raise Damaged("header without end")
    stop = found.start()
    try:
        lines = buf[at:stop].decode("utf-8").split("\r\n")
    except UnicodeDecodeError:
        raise Damaged("header is not UTF-8") from None
    head, name = {}, None
    for x in lines[1:]:
        if x[:1] in (" ", "\t") and name is not None:  # a folded line goes on with the value before it
            head[name] = f"{head[name]} {x.strip()}".strip()
            continue
        name, colon, value = x.partition(":")
        if not colon:
            raise Damaged("header line without colon")
        name = name.strip().lower()
        if name in head and name in ONCE:  # two headers run into each other
            raise Damaged(f"{name} is stated twice")
        head[name] = value.strip()
    size = head.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        raise Damaged("no content length")
    begin = stop + len(END)
    end = begin + int(size)
    if end + len(END) > len(buf):
        raise Damaged("block is cut off")
    if buf[end:end + len(END)] != END:
        raise Damaged("block does not end where its length says")
    block = buf[begin:end]
    if digest_holds(head.get("warc-block-digest", ""), block) is False:
        raise Damaged("block digest differs")
    return head, block, end + len(END)


def inflate(buf: bytes, at: int, stop: int | None = None) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member at ``at``, which has to end by ``stop``; of a damaged one what inflated,
    the place of the error and its reason."""
    z = zlib.decompressobj(31)
    stop = len(buf) if stop is None else stop
    parts, step, pos = [], 1 << 16, at
    try:
        while not z.eof:
            if pos >= stop:
                return b"".join(parts), stop, "member is cut off"
            parts.append(z.decompress(buf[pos:min(pos + step, stop)]))
            pos = min(pos + step, stop)
        return b"".join(parts), pos - len(z.unused_data), None
    except zlib.error as e:
        why = f"member does not inflate: {str(e)[:40]}"
    # the failed step once more byte by byte: a failed call returns nothing of what inflated
    z = zlib.decompressobj(31)
    z.decompress(buf[at:pos])
    for i in range(pos, stop):
        try:
            parts.append(z.decompress(buf[i:i + 1]))
        except zlib.error:
            return b"".join(parts), i, why
    return b"".join(parts), stop, why


def parse_member(buf: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``; raises ``Damaged``."""
    data, end, why = inflate(buf, at)
    if why:
        raise Damaged(why)
    return data, end


NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def scan_inflated(data: bytes, valid: bool):
    """Yield ("record", start, end, headers, block) and ("gap", start, end, reason, None) over the content of a member;
    ``valid``: its CRC holds."""
    at, gap, why = 0, -1, ""
    while at < len(data):
        try:
            head, block, end = parse_record(data, at)
            if not valid and not digest_holds(head.get("warc-block-digest", ""), block):
                raise Damaged("nothing vouches for the record of a damaged member")
            if not valid and end - at == len(data):
                raise Damaged("the only record of a damaged member")
        except Damaged as e:
            if gap < 0:
                gap, why = at, str(e)
            at = data.find(b"WARC/1.", at + 1)
            at = at if at >= 0 else len(data)
            continue
        if gap >= 0:
            yield "gap", gap, at, why, None
            gap = -1
        yield "record", at, end, head, block
        at = end
    if gap >= 0:
        yield "gap", gap, len(data), why, None


def salvage_member(buf: bytes, at: int) -> tuple[list, int, str | None]:
    """What ``scan_inflated`` finds in the member at ``at``, its end, and its error if it is damaged (then at least
    one gap is among the finds); raises ``Damaged`` if a member with content has no record."""
    data, end, why = inflate(buf, at)
    valid = why is None
    if not valid:  # it ends where the next valid member of records begins, if it ran into one
        ahead = buf.find(MAGIC, at + 1, end + len(MAGIC))
        while ahead >= 0:
            inner, _, bad = inflate(buf, ahead)
            if bad is None and any(x[0] == "record" for x in scan_inflated(inner, True)):
                data, end, _ = inflate(buf, at, ahead)
                break
            ahead = buf.find(MAGIC, ahead + 1, end + len(MAGIC))
    found = list(scan_inflated(data, valid))
    if not any(x[0] == "record" for x in found):
        if found or not valid:
            raise Damaged(why or found[0][3])
    elif not valid and not any(x[0] == "gap" for x in found):
        found.append(("gap", len(data), len(data), why, None))
    return found, end, why


def scan(buf: bytes):
    """Yield ("record", start, end, headers, block) and ("gap", start, end, reason, None) over one file.

    Records and gaps cover every byte but empty members, in order.  Records of one member, and the gaps between
    them, all have the member's place in the file; the reason of such a gap names its place in the inflated bytes.
    """
    at, done, why = 0, 0, ""  # done: the end of what has been yielded
    # records of a damaged member, which the file's bytes up to ``until`` may hold once more (in stored blocks)
    twice, until = set(), 0
    while at < len(buf):
        error = None
        try:
            if buf.startswith(MAGIC, at):
                found, end, error = salvage_member(buf, at)
            else:
                head, block, end = parse_record(buf, at)
                if at < until and (str(head), block) in twice:
                    at = end
                    continue
                found = [("record", at, end, head, block)]
        except Damaged as e:
            why = why or str(e)
        else:
            if at > done:
                yield "gap", done, at, why, None
            for kind, a, b, x, block in found:
                yield kind, at, end, x if kind == "record" else f"{x} (inflated bytes {a} to {b})", block
            done, why = max(done, end), error or ""
            if not error:
                at = end
                continue
            twice, until = {(str(x), block) for kind, _, _, x, block in found if kind == "record"}, end
        ahead = NEXT.search(buf, at + 1)
        at = ahead.start() if ahead else len(buf)
    if done < len(buf):
        yield "gap", done, len(buf), why, None


ROW = ("kind string, file string, start long, end long, reason string, record_type string, record_id string, "
       "uri string, date string, refers_to string, stated_digest string, payload_bytes long, payload_digest string")


def salvage(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Everything found below ``path``: one row per record (kind ``record``) and per quarantined
    byte range (kind ``gap``, with ``reason``).

    A response's payload is its block behind the HTTP head; ``payload_bytes`` and
    ``payload_digest`` are computed from the bytes read, ``stated_digest`` is the header's.
    ``payload=True`` adds the payload itself (binary).  Empty files give no row.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for kind, start, end, x, block in scan(content.as_py()):
                    if kind == "gap":
                        rows.append((kind, file, start, end, x, *[None] * 9))
                    else:
                        is_http = "application/http" in x.get("content-type", "")
                        head, _, body = block.partition(END) if is_http else (b"", b"", block)
                        rows.append((kind, file, start, end, None, x.get("warc-type"), x.get("warc-record-id", "").strip("<>"),
                                     x.get("warc-target-uri"), x.get("warc-date"),
                                     x["warc-refers-to"].strip("<>") if "warc-refers-to" in x else None,
                                     x.get("warc-payload-digest", "").rpartition(":")[2] or None,
                                     len(body), hashlib.sha256(body).hexdigest(), body))
                    if len(rows) >= 2048:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 7, pa.int64(), pa.string(), pa.binary()]
    schema = ROW + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]

    def batch(rows):
        cols = list(zip(*rows))[:len(names)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return files.mapInArrow(run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the payload length and digest of what they stand for: a revisit gets those of
    the response it refers to (null if that record was lost)."""
    target = (records.where("record_type = 'response'").groupBy(F.col("record_id").alias("_target"))
              .agg(F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest")))
    again = F.col("record_type") == "revisit"
    # a record that is no revisit looks for its own place, which no record has as its id: a null or a shared id
    # (that of all rows without a key) would bring all of them to one task
    records = records.withColumn("_of", F.when(again, F.col("refers_to")).otherwise(F.concat_ws(" ", F.lit("at"), "file", "start", "end")))
    return (records.join(target, F.col("_of") == F.col("_target"), "left")
            .withColumn("payload_bytes", F.when(again, F.col("_bytes")).otherwise(F.col("payload_bytes")))
            .withColumn("payload_digest", F.when(again, F.col("_digest")).otherwise(F.col("payload_digest")))
            .drop("_of", "_target", "_bytes", "_digest"))
