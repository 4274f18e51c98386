"""WARC archives: a writer with revisit records, and a reader that splits compressed archives at any byte.

Every record is a gzip member of its own. A reader task gets a byte range, looks for the gzip magic in it, and takes a
place for a member if decoding it from there gives a WARC header. It owns the records that start inside its range and
reads past the end of it to finish the last one; after a member the next is known without searching. So ranges need no
index, and any cut of the archives gives each record to exactly one task.

Archives are written to the folder that driver and executors share, each attempt of a task under a name of its own; the
list of archives that ``write`` returns names those of the attempts that counted, and only these are read. Nothing is
renamed, so any store will do.

Archives of other writers can be read too: digests in hexadecimal or base32 are checked if they are SHA-1, other digests and
missing ones are not; record ids that aren't page numbers give a null page_id, and ``record_id`` has them as they stand.

Nulls: null html is an empty payload, a null url or id is written without that header and read back as null. Rows that
repeat a page_id are records of their own. Only rows of a known id can be referred to; rows with a null id stay responses.
Ties: of equal payloads the largest page_id is the response, with each of its rows. Payloads may be of any length (a record
is decoded as a whole). An empty table gives no archives. Columns besides page_id, url and html are not written. A record that
begins in an archive and is cut off or does not decode is an error, or, if asked for, a row that says so.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.llm import common

MAGIC = b"\x1f\x8b\x08"
#: Smallest payload that a revisit may stand for, bytes of a reader's range, of a read, and of the header that must decode.
MIN_REVISIT, SPLIT, READ = 1000, 4 << 20, 1 << 18
VERSION = b"WARC/1.1\r\n"
#: Parts into which the pages of one payload are dealt.
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"
_B32 = {"enc": lambda h: base64.b32encode(bytes.fromhex(h)).decode(), "dec": lambda b: base64.b32decode(b).hex()}


def roles(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = MIN_REVISIT) -> DataFrame:
    """(page_id, refers_to) of the pages that revisit another: equal payloads of ``least`` bytes or more, all but the largest id.

    Payloads are compared by SHA-1 and size; only digests move.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    keys = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")).where(F.col("size") >= least)
    kept = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    kept = kept.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keys = keys.withColumn("salt", F.pmod(F.hash("page_id"), F.lit(SALTS)))
    return keys.join(kept, ["digest", "size", "salt"]).where("page_id < refers_to").select("page_id", "refers_to").distinct()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int = 6) -> bytes:
    """One gzip member with a response record, or with a revisit record that holds the HTTP header only."""
    digest = hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "revisit" if refers_to is not None else "response")]
    head += [("WARC-Record-ID", f"<{_URN}{page_id}>")] if page_id is not None else []
    head += [("WARC-Target-URI", " ".join(url.split()))] if url is not None else []
    head += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{_B32['enc'](digest)}")]
    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_URN}{refers_to}>")] if refers_to is not None else []
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _write(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, size = None, 0
        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)  # the name would have it compressed twice
                member = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers, level)
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([name]), pa.array([size], pa.int64())], ["name", "size"])

    return run


def write(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Writes (page_id, url, html) as archives below ``folder``; returns (name, size) of each, already written."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    who = roles(rows).withColumnRenamed("page_id", "__id")
    rows = rows.join(who, F.col("page_id") == F.col("__id"), "left").drop("__id")  # one archive a partition of the join
    return common.checkpointed(rows.mapInArrow(_write(folder, level), "name string, size long"))


def head_of(raw: bytes) -> dict[str, str]:
    """Header fields of a decoded member, of as many lines as are whole."""
    head, end, _ = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in (lines[1:] if end else lines[1:-1]))
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(raw: bytes) -> dict | None:
    """Header fields and block of a decoded member; None if it is no whole WARC record."""
    if not raw.startswith(b"WARC/"):
        return None
    _, _, rest = raw.partition(b"\r\n\r\n")
    fields = head_of(raw)
    n = fields.get("content-length", "0")
    n = int(n) if n.isdigit() else 0
    return {"fields": fields, "block": rest[:n]} if len(rest) >= n else None


class _Window:
    """Bytes of a file around a moving place."""

    def __init__(self, source, size: int):
        self.source, self.size, self.base, self.data = source, size, 0, b""

    def at(self, place: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``place``."""
        end = min(self.size, place + n)
        if not self.base <= place <= self.base + len(self.data):
            self.base, self.data = place, b""
        self.data = self.data[place - self.base :]
        self.base = place
        while self.base + len(self.data) < end:
            more = self.source.read_at(max(READ, end - self.base - len(self.data)), self.base + len(self.data))
            if not more:
                break
            self.data += more
        return self.data[:n]


#: First bytes of a decoded record by which a member is known to be one.
KNOWN = VERSION[:5]


def _salvaged(data: bytes) -> bytes:
    """What decodes of a damaged member, up to its first ``READ`` bytes, in steps so small that an error costs little."""
    d, out = zlib.decompressobj(31), b""
    try:
        while data and not d.eof and len(out) < READ:
            out += d.decompress(data, 64)
            data = d.unconsumed_tail
    except zlib.error:
        pass
    return out


def _member(window: _Window, place: int) -> tuple[bytes, int, str | None] | None:
    """(decoded bytes, place after it, damage) of the gzip member at ``place``; None if no record begins there.

    What decodes to the first bytes of a record is one: if the rest does not decode or is not there, that is said in damage,
    with what could be decoded of its beginning.
    """
    d, parts, at, damage = zlib.decompressobj(31), [], place, None
    head = b""
    while not d.eof and damage is None:
        chunk = window.source.read_at(READ, at) if not window.base <= at < window.base + len(window.data) else window.data[at - window.base :]
        left = chunk
        try:
            while left and not d.eof:
                # the head comes by itself, so that an error behind it does not hide it
                parts.append(d.decompress(left, READ if len(head) == len(KNOWN) else len(KNOWN) - len(head)))
                head = head if len(head) == len(KNOWN) else head + parts[-1]
                if not KNOWN.startswith(head):
                    return None
                left = d.unconsumed_tail
        except zlib.error as e:
            damage = str(e)
        if not chunk:
            damage = "the archive ends before the member does"
        at += len(chunk)
    if damage is not None:
        return (_salvaged(window.source.read_at(READ, place)), place + 1, damage) if head == KNOWN else None
    return (b"".join(parts), at - len(d.unused_data), None) if head == KNOWN else None


def read_range(source, size: int, start: int, stop: int) -> Iterator[tuple[int, dict]]:
    """(place, record) of the records whose member starts in [start, stop).

    A member that begins as a record and does not decode to a whole one gives a record all the same, with its damage and no
    trustworthy block; reading goes on behind its first byte, so what follows it is found.
    """
    window, place = _Window(source, size), start
    while place < stop:
        ahead = window.at(place, READ)
        hit = ahead.find(MAGIC)
        if hit < 0:
            place += max(1, len(ahead) - len(MAGIC) + 1)
            continue
        place += hit
        if place >= stop:
            return
        window.at(place, READ)
        found = _member(window, place)
        if found is None:
            place += 1
            continue
        raw, after, damage = found
        got = parse(raw) if damage is None else None
        if got is None:
            yield place, {"fields": head_of(raw), "block": b"", "damage": damage or "record is shorter than its length"}
        else:
            yield place, got | {"damage": None}
        place = after


def _number(urn: str | None) -> int | None:
    """The page number of a record id of this writer, else None."""
    found = re.fullmatch(rf"<?{_URN}(-?[0-9]{{1,19}})>?", urn or "")
    return int(found[1]) if found else None


def sha1_of(header: str | None) -> str | None:
    """Lower-case hexadecimal of a SHA-1 digest header in hexadecimal or base32; None for any other."""
    kind, _, value = (header or "").partition(":")
    if kind.strip().lower() not in ("sha1", "sha-1"):
        return None
    value = value.strip()
    if re.fullmatch("[0-9a-fA-F]{40}", value):
        return value.lower()
    return _B32["dec"](value.upper()) if re.fullmatch("[A-Za-z2-7]{32}", value) else None


_READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, record_id string, damage string"


def _read(folder: str, with_payload: bool, damaged: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        cols: list[list] = [[] for _ in range(9)]
        held = 0

        def batch_of():
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string()))], ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "record_id", "damage"])

        for batch in batches:
            for name, size, start, stop in zip(*(batch.column(c).to_pylist() for c in ("name", "size", "start", "stop"))):
                with fs.open_input_file(f"{root}/{name}") as source:
                    for place, rec in read_range(source, size, start, stop):
                        f, block = rec["fields"], rec["block"]
                        if rec["damage"] is not None:
                            if not damaged:
                                raise ValueError(f"{name}: the record that begins at byte {place} is damaged: {rec['damage']}")
                            for c, v in zip(cols, (_number(f.get("warc-record-id")), f.get("warc-target-uri"), f.get("warc-type"), _number(f.get("warc-refers-to")), None, None, None, (f.get("warc-record-id") or "").strip("<>") or None, rec["damage"])):
                                c.append(v)
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                        revisit = f.get("warc-type") == "revisit"
                        length = next((int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length" and v.strip().isdigit()), len(payload))
                        said = sha1_of(f.get("warc-payload-digest"))
                        digest = said if revisit else hashlib.sha1(payload).hexdigest()
                        if not revisit and f.get("warc-type") == "response" and b"transfer-encoding" not in http.lower() and said not in (None, digest):
                            raise ValueError(f"{name}: payload of {f.get('warc-record-id')} does not match its digest")
                        row = (_number(f.get("warc-record-id")), f.get("warc-target-uri"), f.get("warc-type"), _number(f.get("warc-refers-to")), length if revisit else len(payload), digest, payload if with_payload and not revisit else None, (f.get("warc-record-id") or "").strip("<>") or None, None)
                        for c, v in zip(cols, row):
                            c.append(v)
                        held += len(payload) if with_payload else 100
                        if held > 8 << 20 or len(cols[0]) >= 10_000:
                            yield batch_of()
                            cols[:] = [[] for _ in range(9)]
                            held = 0
        if cols[0]:
            yield batch_of()

    return run


def read(spark: SparkSession, folder: str, archives: DataFrame, split: int = SPLIT, with_payload: bool = False, damaged: bool = False) -> DataFrame:
    """Records of the archives (name, size) below ``folder``, read in ranges of ``split`` bytes.

    A record that begins and does not decode whole, or is cut off, is an error; with ``damaged`` it is a row that says so, with
    null payload, length and digest, and with those fields of its header that could be read.
    """
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long")))
    ranges = archives.select("name", "size", start.alias("start")).withColumn("stop", F.least(F.col("start") + split, F.col("size")))
    return ranges.repartition(common.partitions(spark), "name", "start").mapInArrow(_read(folder, with_payload, damaged), _READ)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC archives and read back: sizes, digests and what each record is."""
    folder = common.shared_dir(spark, "warc")
    archives = write(common.table(spark, sf_dir, "pages"), folder)
    return read(spark, folder, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM k
"""

QUERIES = {"op5_warc": op5_warc}
ORACLES = {"op5_warc": OP5_SQL}
