"""WARC archives with a two-level capture index.

``write`` puts one gzip member per page into archives in a shared folder. Captures are sorted by
reversed-host URL key (``com,example)/path``) and written as index shards: compressed blocks of
``BLOCK_LINES`` lines, then a sparse directory of the first key of each block. ``lookup`` finds the
shard by binary search among at most ``MAX_SHARDS`` first keys, the block by binary search in that
shard's directory, the lines by binary search in the block, and reads records by byte range.

A task gives its files a name of their own and reports them only when they are closed, so a task
that is run again leaves at worst a file that nothing refers to.
"""

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import written

BLOCK_LINES = 1000
MAX_SHARDS = 4096
ARCHIVE_BYTES = 64_000_000
LEAST_REVISIT = 100
#: A frequent payload's rows meet its first record in so many parts.
SALTS = 16
#: Bytes of an archive that one reading task takes at a stretch.
STRETCH = 4_000_000
#: Bytes of archives for each reading task.
TASK_BYTES = 64_000_000
_CAPTURE = "surt string, file string, start long, length long"
_RESPONSE = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def surt(url: str | None) -> str:
    """The sort key of a URL: its host's labels reversed, then the rest; empty for null, as it is if not a URL."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    return (",".join(reversed(host.lower().split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
            + (f"?{parts.query}" if parts.query else ""))


def _opened(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def page_record(page: str, url: str | None, payload: bytes, digest: str, first: str | None) -> bytes:
    """A response record, or with ``first`` a revisit of that page's record without the payload."""
    headers = [("WARC-Type", "revisit" if first is not None else "response"), ("WARC-Record-ID", f"<urn:page:{page}>"),
               ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if first is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<urn:page:{first}>")]
    block = _RESPONSE.format(len(payload)).encode()
    return member(headers, block if first is not None else block + payload)


def parsed(data: bytes) -> dict:
    """The parts of one record; an error if it is cut short or its payload has another digest."""
    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    refers = headers.get("WARC-Refers-To")
    return {"page": headers["WARC-Record-ID"][10:-1], "record_type": headers["WARC-Type"], "url": headers.get("WARC-Target-URI"),
            "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": digest,
            "refers_to": refers[10:-1] if refers else None}


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Archives in ``folder``; the captures (surt, file, start, length), as a written table.

    Null payloads are empty, null URLs have no target and the key "", null keys an empty id. Of the
    records of one payload of at least ``LEAST_REVISIT`` bytes, those with the smallest key are
    responses and all others revisits of it; a payload whose keys are all null has responses only.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = (pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)).withColumn("part", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS))))
    repeated = (pages.select(F.col(key).alias("key"), body.alias("payload")).where(F.octet_length("payload") >= LEAST_REVISIT)
                .groupBy(F.sha2("payload", 256).alias("digest")).agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1"))
    firsts = repeated.select("digest", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("part"))
    placed = rows.join(firsts, ["digest", "part"], "left").select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), "url", "payload", "digest",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("first"))

    def run(batches):
        where, base = _opened(folder)
        where.create_dir(f"{base}/archives", recursive=True)
        out, held, start, name = None, [], 0, None

        def closed():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["surt", "file", "start", "length"])

        for batch in batches:
            for page, link, content, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"archives/{uuid.uuid4().hex}.warc.gz"
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                    info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                   ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    held, start = [], len(info)
                data = page_record(page, link, content, digest, first)
                out.write(data)
                held.append((surt(link), name, start, len(data)))
                start += len(data)
                if start >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(placed.mapInArrow(run, _CAPTURE), "captures")


def index(captures: DataFrame, folder: str) -> DataFrame:
    """Index shards in ``folder``; rows (first, last, file, start, length, blocks) telling each shard's directory.

    Ordering is by key, file and place, so a frequent URL fills blocks and shards like any other.
    """
    spark = captures.sparkSession
    shards = min(MAX_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        where, base = _opened(folder)
        lines, directory, start, out, name, last = [], [], 0, None, None, None

        def block():
            nonlocal start
            data = zlib.compress("\n".join(json.dumps(line) for line in lines).encode(), 6)
            out.write(data)
            directory.append((lines[0][0], start, len(data)))
            start += len(data)
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    where.create_dir(f"{base}/index", recursive=True)
                    name = f"index/{uuid.uuid4().hex}.idx"
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(row)
                last = row[0]
                if len(lines) == BLOCK_LINES:
                    block()
        if out is not None:
            if lines:
                block()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(data)
            out.close()
            yield pa.RecordBatch.from_pylist([{"first": directory[0][0], "last": last, "file": name, "start": start,
                                               "length": len(data), "blocks": len(directory)}],
                                             schema=pa.schema([("first", pa.string()), ("last", pa.string()), ("file", pa.string()),
                                                               ("start", pa.int64()), ("length", pa.int64()), ("blocks", pa.int64())]))

    ordered = captures.repartitionByRange(shards, "surt", "file", "start").sortWithinPartitions("surt", "file", "start")
    return written(ordered.mapInArrow(run, "first string, last string, file string, start long, length long, blocks long"), "shards")


def surts(df: DataFrame, url: str = "url") -> DataFrame:
    """The distinct keys of a column of URLs."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in batch.column(0).to_pylist()], pa.string())], names=["surt"])
    return df.select(F.col(url).cast("string").alias("url")).distinct().mapInArrow(run, "surt string").distinct()


def _range(where, path: str, opened: dict, start: int, length: int) -> bytes:
    if path not in opened:
        if len(opened) > 16:
            opened.pop(next(iter(opened))).close()
        opened[path] = where.open_input_file(path)
    return opened[path].read_at(length, start)


def lookup(keys: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Captures (surt, file, start, length) of distinct keys; a key that was never captured gives none.

    The list of shards, at most ``MAX_SHARDS``, goes to every task. A key that fills several shards is
    looked for in each of them by a task of its own.
    """
    known = sorted((r["first"], r["last"], r["file"], r["start"], r["length"]) for r in shards.collect())

    def places(batches):
        firsts, lasts = [k[0] for k in known], [k[1] for k in known]
        for batch in batches:
            rows = [(key, i) for key in batch.column(0).to_pylist() for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
                                             names=["surt", "shard"])

    def run(batches):
        where, base = _opened(folder)
        opened, shard, directory, firsts, number, lines = {}, None, None, None, None, None
        for batch in batches:
            out = []
            for key, i in zip(*(c.to_pylist() for c in batch.columns)):
                _, _, name, start, length = known[i]
                path = f"{base}/{name}"
                if i != shard:
                    directory = json.loads(zlib.decompress(_range(where, path, opened, start, length)))
                    firsts, shard, number = [d[0] for d in directory], i, None
                # The block before the first that begins with the key or later may end with it.
                block = max(0, bisect_left(firsts, key) - 1)
                while block < len(directory) and directory[block][0] <= key:
                    if block != number:
                        data = zlib.decompress(_range(where, path, opened, directory[block][1], directory[block][2])).decode()
                        lines, number = [json.loads(x) for x in data.split("\n")], block
                    at = bisect_left(lines, key, key=lambda x: x[0])
                    while at < len(lines) and lines[at][0] == key:
                        out.append(lines[at])
                        at += 1
                    block += 1
                if len(out) > 20_000:
                    yield rows_of(out)
                    out = []
            yield rows_of(out)

    def rows_of(out):
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
            (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["surt", "file", "start", "length"])

    asked = keys.select("surt").mapInArrow(places, "surt string, shard long")
    # Captures are small rows, reading them is not: the number of tasks is set, or adaptive execution would merge them into one.
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(tasks, "shard", F.pmod(F.xxhash64("surt"), F.lit(8))).sortWithinPartitions("shard", "surt").mapInArrow(run, _CAPTURE)


RECORD = ("page string, record_type string, url string, payload binary, payload_bytes long, payload_digest string, refers_to string")


def read(captures: DataFrame, folder: str) -> DataFrame:
    """The records of captures, by byte ranges: page, record_type, url, payload (null for revisits),
    payload_bytes and payload_digest (of the full payload), refers_to."""
    names = ["page", "record_type", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        where, base = _opened(folder)
        opened = {}
        for batch in batches:
            held, size = [], 0
            for name, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(parsed(_range(where, f"{base}/{name}", opened, start, length)))
                size += held[-1]["payload_bytes"]
                if size > 8_000_000:
                    yield flushed(held)
                    held, size = [], 0
            if held:
                yield flushed(held)

    def flushed(held):
        return pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], t) for n, t in zip(names, types)], names=names)

    # As many tasks as the archives' bytes need, at least those of any shuffle.
    from pyarrow import fs
    where, base = _opened(folder)
    found = where.get_file_info(fs.FileSelector(f"{base}/archives", allow_not_found=True))
    tasks = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sum(f.size or 0 for f in found) // TASK_BYTES))
    return (captures.select("file", "start", "length").repartition(tasks, "file", F.floor(F.col("start") / STRETCH))
            .sortWithinPartitions("file", "start").mapInArrow(run, RECORD))
