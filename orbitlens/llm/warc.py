"""WARC archives with a two-level capture index.

Writing: one record per page, each a gzip member of its own.  Records of equal
payload are stored once: the smallest page id is the response, the others are
revisit records that refer to it.  A task writes its own files (named after
partition and attempt) in the shared folder and returns the captures it wrote;
the stored capture table commits them, so files of lost or repeated attempts are
never read.

Index: captures are sorted by reversed-host URL key (``com,example)/path``) and
page id and cut into compressed blocks; every block's first key is the sparse
directory.  A look-up finds its index part among the parts' first keys (one per
partition, so bounded), then bisects the part's directory and the block, and
reads just the record's byte range.

Defined results: a null html is the empty payload (equal to other empty ones);
a null url has the empty key; null page ids sort first in the index and are
responses only where no row of that payload has an id; rows that repeat id and
payload are all responses; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm.shared import new_path, stored

NO_ID = -(1 << 63)
LAST_ID = (1 << 63) - 1
PART_LINES = 100_000           # captures of one part of the index
READ_BYTES = 64 << 20          # archive bytes that one task reads back
STRIPE_BYTES = 1 << 20         # neighbouring records that stay in one task
CAPTURE = "surt string, page_id long, file string, offset long, length long"
FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def surt(url: str | None) -> str:
    """Reversed-host key: no scheme, no fragment, no default port, host in lower case."""
    rest = one_line((url or "").strip()).split("#", 1)[0]
    if not rest:
        return ""
    scheme, sep, tail = rest.partition("://")
    if not sep:
        scheme, tail = "", rest
    cut = min((i for i in (tail.find("/"), tail.find("?")) if i >= 0), default=len(tail))
    host, path = tail[:cut].rpartition("@")[2].lower(), tail[cut:] or "/"
    name, colon, port = host.partition(":")
    if colon and port in ("", {"http": "80", "https": "443"}.get(scheme.lower())):
        colon = port = ""
    return ",".join(reversed(name.split("."))) + colon + port + ")" + path


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def one_line(text: str | None) -> str:
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in text or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member; ``refers_to`` makes it a revisit without payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            *([f"WARC-Target-URI: {one_line(url)}"] if url is not None else []),
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=5, mtime=0)


def _number(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(member: bytes) -> dict:
    """Headers and payload of a record; the payload is held against its digest."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] == "response":
        if len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest:
            raise ValueError(f"record {h['WARC-Record-ID']}: the payload doesn't match its digest")
    return {"page_id": _number(h["WARC-Record-ID"]), "url": h.get("WARC-Target-URI"), "payload": payload, "payload_bytes": size,
            "payload_digest": digest, "record_type": h["WARC-Type"],
            "refers_to": _number(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None}


# ------------------------------------------------------------------- writing
def write_archives(pages: DataFrame, root: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write the pages' records below ``root``; returns the committed captures (``CAPTURE``).

    Payloads of fewer than ``min_bytes`` bytes are always responses.
    """
    p = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                      F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
         .withColumn("sha", F.sha1(F.col("html").cast("binary"))))
    own = p.select("page_id", "sha").distinct()
    first = own.groupBy("sha").agg(F.min("page_id").alias("first")).where("first is not null")
    # the payload itself moves once, by id and digest, so a payload of many pages stays spread
    target = own.join(first, "sha").where("page_id is null or page_id <> first").withColumnRenamed("page_id", "t_id")
    placed = p.join(target.withColumnRenamed("sha", "t_sha"), (F.col("sha") == F.col("t_sha")) & F.col("page_id").eqNullSafe(F.col("t_id")),
                    "left").select("page_id", "url", "html", F.when(F.octet_length("html") >= min_bytes, F.col("first")).alias("first"))

    def write(batches):
        from pyarrow import fs
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        out, at, name, number = None, 0, "", 0
        try:
            for b in batches:
                rows = []
                for page, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None or at >= max_file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:03d}.warc.gz", 0
                        out, number = store.open_output_stream(f"{base}/{name}", compression=None), number + 1
                    data = record(page, url, html.encode(), refers)
                    out.write(data)
                    rows.append((surt(url), page, name, at, len(data)))
                    at += len(data)
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["surt", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return stored(placed.mapInArrow(write, CAPTURE), "captures")


def build_index(captures: DataFrame, *, block_lines: int = 500) -> DataFrame:
    """Stored index: one row per block (part, block, first_surt, first_id, n, body); directory and blocks in one table."""
    def cut(batches):
        part = TaskContext.get().partitionId()
        held, block = [], 0

        def emit(lines):
            body = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode(), 6)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([lines[0][0]]),
                 pa.array([lines[0][1]], pa.int64()), pa.array([len(lines)], pa.int32()), pa.array([body], pa.binary())],
                names=["part", "block", "first_surt", "first_id", "n", "body"])

        for b in batches:
            held += zip(*(c.to_pylist() for c in b.columns))
            while len(held) >= block_lines:
                yield emit(held[:block_lines])
                held, block = held[block_lines:], block + 1
        if held:
            yield emit(held)

    keyed = captures.select("surt", F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"), "file", "offset", "length")
    # a part holds a bounded number of captures, whatever their bytes
    parts = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // PART_LINES))
    return stored(keyed.repartitionByRange(parts, "surt", "page_id").sortWithinPartitions("surt", "page_id", "file", "offset")
                  .mapInArrow(cut, "part int, block int, first_surt string, first_id long, n int, body binary"), "index")


# ------------------------------------------------------------------- reading
def look_up(index: DataFrame, queries: DataFrame, *, id_col: str | None = "page_id", url_col: str = "url") -> DataFrame:
    """Captures (``CAPTURE``) of every distinct query: one page's if ``id_col`` is given, else all of the URL."""
    parts = sorted((r.s, r.part) for r in index.groupBy("part").agg(F.min(F.struct("first_surt", "first_id")).alias("s")).collect())
    edges = [tuple(s) for s, _ in parts]                               # one per partition
    numbers = [n for _, n in parts]

    def assign(batches):
        for b in batches:
            out = []
            for page, url in zip(*(c.to_pylist() for c in b.columns)):
                key = surt(url)
                low, high = ((key, page), (key, page)) if id_col else ((key, NO_ID), (key, LAST_ID))
                # equal keys may end the part before the one that starts with them
                for k in range(max(0, bisect_left(edges, low) - 1), bisect_right(edges, high)):
                    out.append((numbers[k], key, low[1], high[1]))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.string(), pa.int64(), pa.int64()])],
                                             names=["part", "surt", "low", "high"])

    def find(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        first = list(zip(blocks["first_surt"].to_pylist(), blocks["first_id"].to_pylist()))
        body = blocks["body"]
        out, opened, lines = [], -1, []
        for key, low, high in sorted(zip(*(wanted[c].to_pylist() for c in ("surt", "low", "high")))):
            for k in range(max(0, bisect_left(first, (key, low)) - 1), bisect_right(first, (key, high))):
                if k != opened:
                    lines = [(a, int(i), f, int(o), int(n)) for a, i, f, o, n in
                             (x.rsplit("\t", 4) for x in zlib.decompress(body[k].as_py()).decode().split("\n"))]
                    opened = k
                at = bisect_left(lines, (key, low))
                while at < len(lines) and lines[at][:2] <= (key, high):
                    out.append(lines[at])
                    at += 1
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=["surt", "page_id", "file", "offset", "length"])

    page = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) if id_col else F.lit(NO_ID)
    asked = (queries.select(page.alias("page_id"), F.col(url_col).cast("string").alias("url"))
             .mapInArrow(assign, "part int, surt string, low long, high long").distinct())
    # as many tasks as parts: adaptive execution would merge them by the size of these small rows
    n = max(1, len(parts))
    blocks = index.select("part", "block", "first_surt", "first_id", "body").repartition(n, "part")
    return asked.repartition(n, "part").groupBy("part").cogroup(blocks.groupBy("part")).applyInArrow(find, CAPTURE)


def read_records(captures: DataFrame, root: str, *, with_payload: bool = False) -> DataFrame:
    """Range-read and parse the captures' records, in file order.

    The captures are stored first: their summed length, not the size of their small rows, gives the number of tasks."""
    schema = FOUND + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]

    def read(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(root)
        name, handle = None, None
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part, rows = b.slice(at, 500), []
                for file, offset, length in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("file", "offset", "length"))):
                    if file != name:
                        if handle is not None:
                            handle.close()
                        name, handle = file, store.open_input_file(f"{base}/{file}")
                    handle.seek(offset)
                    rows.append(parse(handle.read(length)))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)], names=names)
        if handle is not None:
            handle.close()

    captures = stored(captures.select("file", "offset", "length"), "found")
    total = captures.agg(F.sum("length")).first()[0] or 0              # one number
    tasks = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // READ_BYTES))
    stripe = F.floor(F.col("offset") / STRIPE_BYTES)
    return (captures.withColumn("stripe", stripe).repartition(tasks, "file", "stripe")
            .sortWithinPartitions("file", "offset").drop("stripe").mapInArrow(read, schema))


def archive_round_trip(spark: SparkSession, pages: DataFrame, root: str | None = None, *, min_bytes: int = 0) -> DataFrame:
    """Write all pages, index them, look every page up in the index and read its record back (``FOUND``)."""
    root = root or new_path(spark, "warc")
    index = build_index(write_archives(pages, root, min_bytes=min_bytes))
    return read_records(look_up(index, pages), root)
