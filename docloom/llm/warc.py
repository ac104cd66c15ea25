"""Web archives: a writer with one gzip member per record, and a sequential, verifying reader.

Archives are files below a shared folder, opened from the tasks with ``pyarrow.fs`` (local mounts,
object stores, HDFS). A task names its files anew at each attempt and only the manifest of a
finished write lists files, so a task that is run again leaves no torn archive behind. A page's
id is its record id; a revisit keeps the headers of the response, whose Content-Length is the
length of the full payload, and names the record it refers to.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import stored
from docloom.session import scratch_path

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
ROWS = 512
_EMPTY = hashlib.sha256(b"").hexdigest()

MANIFEST = "archive string, records long, bytes long"
RECORD = (
    "archive string, position long, page_id long, record_type string, target_uri string, "
    "payload_bytes long, payload_digest string, refers_to long, verified boolean"
)


def classify(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Rows of (page_id, url, payload, digest, refers_to); ``refers_to`` is set for revisits.

    Among records of one payload of at least ``min_bytes``, the smallest page_id is the response.
    A null html is an empty payload. Rows without page_id revisit if any row with an id has their
    payload and are responses otherwise; rows that repeat the smallest id are responses all.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # One row per payload that occurs under more than one id; a hot one is counted map-side first.
    seen = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and original is not null")
        .select("digest", "original")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("original")) & F.col("original").isNotNull()
    return rows.join(seen, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("original")).alias("refers_to")
    )


def _name(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if pd.isna(page_id) else f"<urn:page:{int(page_id)}>"


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    revisit = not pd.isna(refers_to)
    head = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = head if revisit else head + payload
    target = "".join(c if " " < c else f"%{ord(c):02X}" for c in url) if url else "urn:unknown"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
    lines.append(f"Content-Length: {len(block)}")
    text = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write classified pages as archives below ``folder``; returns the manifest, already stored."""

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                payload = row.payload.encode("utf-8", "surrogatepass")
                data = _record(row.page_id, row.url, payload, row.digest, row.refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    rows = pages.select(
        F.col("page_id"), "url", "payload", "digest", "refers_to"
    )
    return stored(rows.mapInPandas(write, MANIFEST), "warc-manifest")


class _Members:
    """Decompressed bytes of an archive, member by member, with a bounded buffer."""

    def __init__(self, source):
        self.source, self.raw, self.text = source, b"", bytearray()
        self.unzip, self.offset, self.begun = None, 0, 0

    def next_member(self) -> bool:
        """Go to the next gzip member; false at the end of the file."""
        if not self.raw:
            self.raw = self.source.read(CHUNK)
        if not self.raw:
            return False
        self.unzip, self.begun = zlib.decompressobj(31), self.offset
        self.text.clear()
        return True

    def fill(self) -> bool:
        """Decompress some more of this member; false when it has ended."""
        while not self.unzip.eof:
            data = self.raw or self.source.read(CHUNK)
            if not data:
                raise ValueError("archive ends inside a record")
            more = self.unzip.decompress(data, CHUNK)
            rest = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            self.offset += len(data) - len(rest)
            self.raw = rest
            if more:
                self.text += more
                return True
        return False

    def head(self) -> dict[str, str]:
        """Header fields up to the empty line, names in lower case."""
        while (end := self.text.find(b"\r\n\r\n")) < 0:
            if not self.fill():
                raise ValueError("record without an end of its header")
        lines = bytes(self.text[:end]).decode("utf-8", "surrogatepass").split("\r\n")
        del self.text[: end + 4]
        fields = (line.partition(":") for line in lines[1:])
        return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in fields}

    def take(self, size: int, use) -> None:
        """Hand the next ``size`` bytes to ``use`` in pieces."""
        while size:
            if not self.text and not self.fill():
                raise ValueError("record shorter than its Content-Length")
            part = bytes(self.text[:size])
            del self.text[: len(part)]
            size -= len(part)
            use(part)


def _page(name: str | None):
    return int(name[10:-1]) if name and name.startswith("<urn:page:") else None


def records(source, name: str, with_payload: bool = False):
    """Rows of RECORD of one open archive, in order; digests are checked on the way."""
    members = _Members(source)
    while members.next_member():
        at = members.begun
        head = members.head()
        if not head[""].startswith("WARC/"):
            raise ValueError(f"{name}: no record at {at}")
        block, payload, parts = hashlib.sha256(), hashlib.sha256(), []
        left, http, opening, inside = int(head["content-length"]), {}, bytearray(), 0

        def feed(part: bytes) -> None:
            nonlocal inside, http
            block.update(part)
            if not http:
                opening.extend(part)
                if (end := opening.find(b"\r\n\r\n")) < 0:
                    return
                lines = bytes(opening[:end]).decode("latin-1").split("\r\n")
                fields = (line.partition(":") for line in lines[1:])
                http = {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in fields}
                part = bytes(opening[end + 4 :])
            payload.update(part)
            inside += len(part)
            if with_payload:
                parts.append(part)

        members.take(left, feed)
        members.take(4, lambda part: None)
        while members.fill():
            if members.text:
                raise ValueError(f"{name}: bytes after the record at {at}")
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        good = f"sha256:{block.hexdigest()}" == head["warc-block-digest"]
        revisit = head["warc-type"] == "revisit"
        if not revisit:
            good = good and payload.hexdigest() == stated and inside == int(http["content-length"])
        row = (
            name, at, _page(head["warc-record-id"]), head["warc-type"], head["warc-target-uri"],
            int(http["content-length"]), stated, _page(head.get("warc-refers-to")), good,
        )
        yield (*row, None if revisit else b"".join(parts)) if with_payload else row


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the listed archives; one task reads an archive front to back.

    ``verified`` says whether the digests and lengths of a record hold; a broken frame raises.
    """
    schema = RECORD + (", payload binary" if with_payload else "")
    columns = [field.split()[0] for field in schema.split(", ")]
    whole = ["position", "page_id", "payload_bytes", "refers_to"]

    def frame(rows):
        return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in whole})

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["archive"]:
                rows = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for row in records(source, name, with_payload):
                        rows.append(row)
                        if len(rows) == ROWS:
                            yield frame(rows)
                            rows = []
                if rows:
                    yield frame(rows)

    tasks = max(1, manifest.count())
    return manifest.select("archive").repartition(tasks).mapInPandas(read, schema)


def warc_query(spark, sf_dir: str) -> DataFrame:
    """Write all pages as archives and read them back."""
    folder = scratch_path(spark, "warc")
    pages = classify(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND original IS NOT NULL AND original IS DISTINCT FROM page_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND original IS NOT NULL AND original IS DISTINCT FROM page_id
            THEN original END AS refers_to,
       TRUE AS verified
FROM q
"""
