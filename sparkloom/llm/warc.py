"""WARC archives: written record by record with an index, read back by the index alone."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, partitions, stored

INDEX = "archive string, offset long, length long, url string, payload_digest string, page_id long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, digest_holds boolean"
#: An archive is closed beyond so many bytes.
ARCHIVE_BYTES = 1 << 30
#: Ranges that are at most GAP apart are read together, up to READ bytes at a time.
GAP, READ = 64 << 10, 8 << 20
#: Of archives, so many bytes are read by one task at least.
SPAN = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _uri(url: str) -> str:
    """Control characters and spaces can't stand in a header line."""
    return "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in url.encode("utf-8", "replace")) if any(ord(c) <= 32 or ord(c) >= 127 for c in url) else url


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record, uncompressed. A revisit has the HTTP header of the page, with its full length, and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {_uri(url)}"] if url is not None else []
    head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if revisit else []
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of an uncompressed record; the payload's digest is checked where there is a payload."""
    top, _, rest = data.partition(b"\r\n\r\n")
    head = {k.lower(): v for k, v in (line.split(": ", 1) for line in top.decode().split("\r\n")[1:])}
    block = rest[: int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length: "))
    page = lambda name: None if (x := head.get(name, "<urn:page:none>")[10:-1]) == "none" else int(x)
    digest = base64.b32decode(head["warc-payload-digest"][5:]).hex()
    revisit = head["warc-type"] == "revisit"
    return {
        "page_id": page("warc-record-id"), "url": head.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "record_type": head["warc-type"],
        "refers_to": page("warc-refers-to"), "payload": None if revisit else payload, "digest_holds": None if revisit else hashlib.sha1(payload).hexdigest() == digest and len(payload) == size,
    }


def with_roles(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_digest, revisit and refers_to of every row.

    Among equal payloads of at least `least_bytes`, rows with the largest page_id are responses and the others revisit
    it. A null html is the empty payload. Null ids never win against others; where all ids of a group are null, all its
    rows are responses, as are repeated rows that share the largest id.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("payload_digest", F.sha1("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long"))
    # one row a digest and task is shuffled, however many copies a payload has
    heads = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("head"), F.count("*").alias("copies"))
    heads = heads.filter("copies > 1").drop("copies")
    rows = rows.join(heads, ["payload_digest", "payload_bytes"], "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("head")) & F.col("head").isNotNull(), F.lit(False))
    return rows.withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("head"))).drop("head")


def write_archives(roles: DataFrame, folder: str, *, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of with_roles() as gzipped WARC records below `folder`; returns the index (INDEX), itself stored.

    Each attempt of a task writes files of its own names and the index names only those of attempts that succeeded, so
    that a lost executor or a repeated attempt leaves unnamed files at most.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, at = None, "", 0
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        try:
            for batch in batches:
                index = []
                for page_id, url, payload, digest, revisit, refers_to in zip(batch["page_id"], batch["url"], batch["payload"], batch["payload_digest"], batch["revisit"], batch["refers_to"], strict=True):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    page_id = None if pd.isna(page_id) else int(page_id)
                    url = None if url is None or url is pd.NA or url != url else url
                    data = _member(record_bytes(page_id, url, payload, digest, None if pd.isna(refers_to) else int(refers_to), bool(revisit), date))
                    out.write(data)
                    index.append((name, at, len(data), url, digest, page_id))
                    at += len(data)
                made = pd.DataFrame(index, columns=["archive", "offset", "length", "url", "payload_digest", "page_id"])
                yield made.astype({"page_id": "Int64", "offset": "int64", "length": "int64"})
        finally:
            if out is not None:
                out.close()

    rows = roles.select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", "payload_digest", "revisit", F.col("refers_to").cast("string").alias("refers_to")
    )
    return stored(rows.mapInPandas(write, INDEX), "warc-index")


def read_archives(spark: SparkSession, folder: str, selected: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Records (RECORD) at the selected rows of an index: ranges are sorted, close ones are read at once.

    Without `payloads` the payload column is null; its digest is checked all the same.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        opened = (None, None)
        for batch in batches:
            rows = list(zip(batch["archive"], batch["offset"].astype(int), batch["length"].astype(int), strict=True))
            found, first = [], 0
            while first < len(rows):
                name, start, length = rows[first]
                end, last = start + length, first + 1
                while last < len(rows) and rows[last][0] == name and rows[last][1] - end <= GAP and rows[last][1] + rows[last][2] - start <= READ:
                    end, last = max(end, rows[last][1] + rows[last][2]), last + 1
                if opened[0] != name:
                    if opened[1] is not None:
                        opened[1].close()
                    opened = (name, fs.open_input_file(f"{root}/{name}"))
                span = opened[1].read_at(end - start, start)
                for _, offset, size in rows[first:last]:
                    found.append(parse_record(zlib.decompress(span[offset - start : offset - start + size], 31)))
                    if not payloads:
                        found[-1]["payload"] = None
                first = last
            if found:
                made = pd.DataFrame(found)
                yield made.astype({"page_id": "Int64", "refers_to": "Int64"})
        if opened[1] is not None:
            opened[1].close()

    where = selected.select("archive", "offset", "length").withColumn("span", F.floor(F.col("offset") / SPAN))
    return where.repartition(partitions(spark), "archive", "span").sortWithinPartitions("archive", "offset").drop("span").mapInPandas(read, RECORD)


def archived(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, url and digest_holds (null for revisits).
    Nulls, ties and repeated rows: see with_roles(). An empty table gives an empty result. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    index = write_archives(with_roles(pages, id_col=id_col, url_col=url_col, html_col=html_col, least_bytes=least_bytes), folder)
    return read_archives(spark, folder, index, payloads=False).drop("payload")
