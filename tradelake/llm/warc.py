"""WARC archives: one gzip member per record, written and read sequentially.

Records are written by the tasks that hold the pages, into archives of
bounded size in the shared folder; a task names its archive by a fresh id and
returns what it wrote, so an archive of a failed or repeated task is never listed and
never read. The reader takes the listed archives one after the other, inflates member
by member in small steps, frames each record by its Content-Length and checks
block and payload digests.

Of records with equal payloads of at least ``MIN_REVISIT_BYTES``, the one with
the smallest id is a response and the others are revisits that refer to it and
carry the HTTP header alone. Files are opened through Arrow's file systems, so
the shared folder can be any store that they know.

Defined cases: NULL payloads are empty; a payload may have any length, it is
one record; of repeated rows with the smallest id every one is a response; a
NULL id comes last and is stored as an empty field; an empty table writes no
archive and reads as an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.llm.common import scratch, staged

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
STEP = 1 << 16
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORDS = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "target_uri string, payload binary")


def _id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One record, not yet compressed; ``digest`` is the payload's SHA-256."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20]", "", url or "") or "about:blank"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
            ("WARC-Payload-Digest", "sha256:" + digest)]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _open(path: str):
    """(file system, path on it) of a URI or a plain path."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _open(folder)
        made, out, name, size, n = [], None, "", 0, 0
        for rows in batches:
            for r in rows.itertuples(index=False):
                if out is None:
                    store.create_dir(top, recursive=True)
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                page, refers = (None if pd.isna(x) else int(x) for x in (r.page_id, r.first_id))
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record_bytes(page, r.url, bytes(r.payload), r.digest, refers, bool(r.revisit))
                data = packer.compress(raw) + packer.flush()
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    made.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", n, size))
        if made:
            yield pd.DataFrame(made, columns=["path", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   text_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row; returns the list of archives (path, records, bytes)."""
    folder = folder or scratch(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "utf-8")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = staged(rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy("digest")
                    .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-firsts")
    # joined by sorting at every size alike: the list of repeated payloads grows with the pages
    rows = rows.hint("merge").join(firsts, "digest", "left")
    rows = rows.withColumn("revisit", F.expr("first_id is not null and not (page_id <=> first_id)"))
    # ids travel as text: pandas would turn a long column with NULLs into doubles
    return staged(rows.select(F.col("page_id").cast("string"), "url", "payload", "digest",
                              F.col("first_id").cast("string"), "revisit")
                  .mapInPandas(_writer(folder, archive_bytes), "path string, records long, bytes long"), "warc-list")


class BadRecord(ValueError):
    """A record that breaks the framing or a digest."""


class RecordReader:
    """Records of one archive in order: (headers, block)."""

    def __init__(self, stream):
        self.stream, self.tail, self.buffer = stream, b"", bytearray()
        self.inflater = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Inflate a step more of the current member; False at its end."""
        while not self.inflater.eof:
            data = self.tail or self.stream.read(STEP)
            if not data:
                raise BadRecord("archive ends within a gzip member")
            got = self.inflater.decompress(data, STEP)
            self.tail = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if got:
                self.buffer += got
                return True
        return False

    def _line(self) -> bytes:
        while (k := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                raise BadRecord("record ends within its header")
        line = bytes(self.buffer[:k])
        del self.buffer[:k + 2]
        return line

    def _take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise BadRecord("record is shorter than its Content-Length")
        data = bytes(self.buffer[:n])
        del self.buffer[:n]
        return data

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            if not self.tail:
                self.tail = self.stream.read(STEP)
                if not self.tail:
                    return
            self.inflater, self.buffer = zlib.decompressobj(31), bytearray()
            if self._line() != VERSION:
                raise BadRecord("not a record")
            head = {}
            while line := self._line():
                k, _, v = line.decode("utf-8").partition(":")
                head[k.strip().lower()] = v.strip()
            block = self._take(int(head["content-length"]))
            if self._take(4) != b"\r\n\r\n" or self._more() or self.buffer:
                raise BadRecord("record does not end where its Content-Length says")
            if "sha256:" + hashlib.sha256(block).hexdigest() != head["warc-block-digest"]:
                raise BadRecord("block digest differs")
            yield head, block


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def parse_record(head: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS, with the payload digest verified where the payload is there."""
    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?mi)^content-length:\s*(\d+)", http)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise BadRecord("payload length or digest differs")
    return (_page(head["warc-record-id"]), kind, size, digest, _page(head.get("warc-refers-to")),
            head["warc-target-uri"], payload if kind == "response" else None)


def _reader(with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path in rows["path"]:
                store, name = _open(path)
                held, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for head, block in RecordReader(stream):
                        r = parse_record(head, block)
                        held.append(r if with_payload else (*r[:-1], None))
                        size += 300 + (len(block) if with_payload else 0)
                        if size > 16 << 20:
                            yield _frame(held, names)
                            held, size = [], 0
                if held:
                    yield _frame(held, names)
    return run


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    # ids are made integers before a NULL beside them can turn them into doubles
    columns = dict(zip(names, zip(*rows)))
    return pd.DataFrame({n: pd.array(c, "Int64") if n in ("page_id", "refers_to") else list(c) for n, c in columns.items()})


def read_archives(spark: SparkSession, archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives (column path); each archive is read by one task, in order."""
    # whole archives are the unit of work: deal them out one by one
    n = max(1, archives.count())
    return (archives.select("path").repartition(n, F.xxhash64("path"))
            .mapInPandas(_reader(with_payload), RECORDS))
