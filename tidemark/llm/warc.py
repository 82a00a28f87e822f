"""WARC archives with a two-level capture index.

Pages are written as WARC records by Spark's text writer: a record is text that ends with two line ends,
which is the writer's separator. Equal payloads are stored once; the other records refer to them. Reading
the archives gives an index line per record: reversed-host URL key, page, file, offset and length. Sorted
lines go into compressed blocks; a sparse directory holds each block's first and last key. Look-ups of many URLs
(``find_captures``) range the directory by every ``ROOT_BLOCKS``-th of its keys; tasks bisect the directory of a range for the
blocks that can hold a key, unpack only these and bisect their lines. ``Captures`` does the same for single URLs and reads
a record by its byte range alone.

Defined results: a null html is an empty payload, and equal empty payloads refer to one like others. Of
equal payloads the largest page id is the response; repeated rows of it all are. A null page id is smaller
than every other and refers to the response like others. A null URL is an empty one. Other columns of the
input are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemark.llm.common import map_arrow, release
from tidemark.session import scratch_path

#: Payload bytes of one archive file, and index lines of one block, about.
FILE_BYTES, BLOCK_LINES = 8 << 20, 2000
#: Blocks of the directory between two keys of its root.
ROOT_BLOCKS = 1000

_END = "\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the last to the first, then the port, path and query.

    Scheme, user, fragment and a leading ``www`` do not count.
    """
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.strip()
    labels = host.split(".")
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    place = ",".join(reversed(labels)) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _plain(value: str) -> str:
    return " ".join(value.split())


def record(page_id: int | None, url: str, payload: bytes, first: int | None, is_response: bool) -> str:
    """One record without its closing line ends; ``first``: the page that the payload is stored with."""
    kind = "response" if is_response else "revisit"
    name = "null" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_plain(url)}",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if not is_response:
        head += [
            f"WARC-Refers-To: <urn:page:{first}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(payload) if is_response else 0}")
    return "\r\n".join(head) + _END + (payload.decode("utf-8") if is_response else "")


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records in ``data``, by their Content-Length."""
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:body].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:] if line)
        end = body + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, end + 4 - at, headers, data[body:end]
        at = end + 4


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "null") else None


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to files of about ``file_bytes``.

    Which payloads repeat is found on digests alone. Html is compressed and shuffled once: it is dealt by the
    keys of the join, and the join's tasks write the files.
    """
    page = F.coalesce(F.col("page_id").cast("long").cast("string"), F.lit("null"))
    rows = pages.select(
        page.alias("page"),
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    sizes = rows.select(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    keys = rows.select("page_id", "page", "digest").distinct()
    firsts = keys.groupBy(F.col("digest").alias("f_digest")).agg(F.max("page_id").alias("first"))
    found = keys.join(firsts, F.col("digest") == F.col("f_digest")).select(
        F.col("page").alias("k_page"), F.col("digest").alias("k_digest"), "first"
    )
    n_files = max(1, -(-sizes // file_bytes))

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        packed = [zlib.compress(h.encode("utf-8"), 6) for h in batch["html"].to_pylist()]
        yield {n: batch[n] for n in ("page", "page_id", "url", "digest")} | {"packed": pa.array(packed, pa.binary())}

    packed = map_arrow(rows, pack, "page string, page_id long, url string, digest binary, packed binary")
    dealt = packed.repartition(n_files, "page", "digest").join(
        found, (F.col("page") == F.col("k_page")) & (F.col("digest") == F.col("k_digest"))
    )
    dealt = dealt.select("page_id", "url", "packed", "first")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        columns = [batch[n].to_pylist() for n in ("page_id", "url", "packed", "first")]
        values = [record(p, u, zlib.decompress(h), f, p == f) for p, u, h, f in zip(*columns, strict=True)]
        yield {"value": pa.array(values, pa.string())}

    map_arrow(dealt, run, "value string").write.option("lineSep", _END).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, responses with the digest of what was read."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    schema = (
        "page_id long, url string, url_key string, record_type string, refers_to long, payload_bytes long,"
        " payload_digest string, file string, at long, length long"
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for i in range(batch.num_rows):
            yield _columns(batch["path"][i].as_py(), batch["content"][i].as_py())

    # One file at a time in a worker: a batch ends after some MB.
    return map_arrow(files, run, schema)


def _columns(file: str, data: bytes) -> dict:
    rows = []
    for at, length, head, block in parse(data):
        told = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            if _digest(block) != told:
                raise ValueError(f"the payload at byte {at} of {file} is damaged")
            refers, size = None, len(block)
        else:
            refers, size = _page(head.get("WARC-Refers-To")), int(head["X-Payload-Length"])
        uri = head["WARC-Target-URI"]
        rows.append((_page(head["WARC-Record-ID"]), uri, url_key(uri), head["WARC-Type"], refers, size, told, at, length))
    kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = "page_id url url_key record_type refers_to payload_bytes payload_digest at length".split()
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    out = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
    return out | {"file": pa.array([file] * len(rows), pa.string())}


def write_index(records: DataFrame, path: str, block_lines: int = BLOCK_LINES) -> None:
    """Write the two levels: ``path/blocks`` and ``path/directory``.

    Records are ranged and sorted by URL key; each block holds the next ``block_lines`` lines, compressed.
    A row of the directory says which keys a block holds. Blocks are numbered in the order of their keys: the
    task in the upper half, then from 0 on.
    """
    lines = records.select("url_key", "page_id", "record_type", "payload_digest", "refers_to", "payload_bytes", "file", "at", "length")
    ordered = lines.repartitionByRange("url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    ordered = ordered.withColumn("task", F.spark_partition_id())
    kinds = [("block", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()), ("n_lines", pa.int64()), ("data", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        n = 0

        def block(rows: list[dict]) -> pa.RecordBatch:
            number = (rows[0]["task"] << 32) + n
            data = zlib.compress("\n".join(json.dumps({k: v for k, v in r.items() if k != "task"}, separators=(",", ":")) for r in rows).encode(), 6)
            values = [number, rows[0]["url_key"], rows[-1]["url_key"], len(rows), data]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(values, kinds, strict=True)], names=[k for k, _ in kinds])

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= block_lines:
                yield block(held[:block_lines])
                n += 1
                del held[:block_lines]
        if held:
            yield block(held)

    blocks = ordered.mapInArrow(run, "block long, first_key string, last_key string, n_lines long, data binary")
    blocks.write.parquet(f"{path}/blocks")
    written = records.sparkSession.read.parquet(f"{path}/blocks")
    written.select("block", "first_key", "last_key", "n_lines").write.parquet(f"{path}/directory")


_LINE = (
    "url_key string, page_id long, record_type string, payload_digest string, refers_to long, payload_bytes long,"
    " file string, at long, length long"
)
_KINDS = {
    "url_key": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "payload_digest": pa.string(),
    "refers_to": pa.int64(), "payload_bytes": pa.int64(), "file": pa.string(), "at": pa.int64(), "length": pa.int64(),
}


def _unpacked(data: bytes) -> list[dict]:
    return [json.loads(x) for x in zlib.decompress(data).split(b"\n")]


def _as_columns(rows: list[dict]) -> dict:
    return {n: pa.array([r[n] for r in rows], k) for n, k in _KINDS.items()}


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All index lines, unpacked from the blocks."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for data in batch["data"].to_pylist():
            yield _as_columns(_unpacked(data))

    return map_arrow(spark.read.parquet(f"{path}/blocks").select("data"), run, _LINE)


def url_keys(urls: DataFrame, url: str = "url") -> DataFrame:
    """``url_key`` of each row, each key once."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"url_key": pa.array([url_key(_plain(u)) for u in batch["url"].to_pylist()], pa.string())}

    rows = urls.select(F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))
    return map_arrow(rows, run, "url_key string").distinct()


def _ranges(rows: DataFrame, first: str, last: str, root: list[str]) -> DataFrame:
    """``rows`` with ``range``, once for every range of the root that their keys from ``first`` to ``last`` touch."""

    names = list(rows.columns)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        ends = [[bisect.bisect_right(root, k) for k in batch[c].to_pylist()] for c in (first, last)]
        lists = [list(range(a, b + 1)) for a, b in zip(*ends, strict=True)]
        yield {n: batch[n] for n in names} | {"ranges": pa.array(lists, pa.list_(pa.int32()))}

    touched = map_arrow(rows, run, StructType([*rows.schema.fields, StructField("ranges", ArrayType(IntegerType()))]))
    return touched.select(*names, F.explode("ranges").alias("range"))


def find_blocks(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``url_key, block``: the blocks whose range of keys holds a key, by bisection of the directory.

    The root, the keys that the directory is ranged by, is one key in some ``ROOT_BLOCKS`` times ``BLOCK_LINES`` captures and
    goes to the tasks. A task holds the directory of one range and bisects it for each key of that range.
    """
    directory = spark.read.parquet(f"{path}/directory").select("block", "first_key", "last_key")
    heads = directory.where(F.col("block").bitwiseAND((1 << 32) - 1) % ROOT_BLOCKS == 0).select("first_key")
    root = sorted(r["first_key"] for r in heads.distinct().collect())
    # The columns of both sides stand in one frame; in each range the directory comes first.
    none = lambda kind: F.lit(None).cast(kind)
    held = _ranges(directory, "first_key", "last_key", root).select("range", "block", "first_key", "last_key", none("string").alias("url_key"))
    asked = _ranges(keys.select("url_key"), "url_key", "url_key", root)
    asked = asked.select("range", none("long").alias("block"), none("string").alias("first_key"), none("string").alias("last_key"), "url_key")
    streams = held.union(asked).repartition("range").sortWithinPartitions("range", F.col("block").asc_nulls_last())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, blocks, firsts, lasts = None, [], [], []
        for batch in batches:
            found: list[tuple[str, int]] = []
            for here, block, first, last, key in zip(*[batch[c].to_pylist() for c in ("range", "block", "first_key", "last_key", "url_key")], strict=True):
                if here != place:
                    place, blocks, firsts, lasts = here, [], [], []
                if block is not None:  # they come in the order of their keys
                    blocks.append(block)
                    firsts.append(first)
                    lasts.append(last)
                else:
                    found += [(key, b) for b in blocks[bisect.bisect_left(lasts, key) : bisect.bisect_right(firsts, key)]]
            columns = [pa.array([k for k, _ in found], pa.string()), pa.array([b for _, b in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["url_key", "block"])

    return streams.mapInArrow(run, "url_key string, block long")


def find_captures(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The index lines of all captures of ``keys`` (url_key, each once): blocks by the directory, lines by bisection."""
    asked = find_blocks(spark, path, keys).select("block", F.lit(None).cast("binary").alias("data"), F.col("url_key").alias("asked"))
    blocks = spark.read.parquet(f"{path}/blocks").select("block", "data", F.lit(None).cast("string").alias("asked"))
    streams = blocks.union(asked).repartition("block").sortWithinPartitions("block", F.col("asked").asc_nulls_first())

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, lines, names, held = None, None, [], []
        for batch in batch_rows:
            for data, key in zip(batch["data"].to_pylist(), batch["asked"].to_pylist(), strict=True):
                if data is not None:  # unpacked only if a key follows
                    packed, lines = data, None
                    continue
                if lines is None:
                    lines = _unpacked(packed)
                    names = [x["url_key"] for x in lines]
                held += lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]
                if len(held) > BLOCK_LINES:
                    yield pa.RecordBatch.from_pydict(_as_columns(held))
                    held = []
        yield pa.RecordBatch.from_pydict(_as_columns(held))

    return streams.mapInArrow(run, _LINE)


class Captures:
    """Look-ups in a written index, for the few URLs that a user asks for.

    The directory has one row per some thousand captures; its rows for a key come from Parquet by their
    ranges, so that neither level is ever held whole.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.blocks, self.directory = (spark.read.parquet(f"{path}/{n}") for n in ("blocks", "directory"))

    def lines(self, url: str) -> list[dict]:
        """Index lines of a URL: the directory names the blocks that can hold its key, these are bisected."""
        key, out = url_key(_plain(url)), []
        named = self.directory.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("block").select("block")
        for row in named.toLocalIterator():
            for held in self.blocks.where(F.col("block") == row["block"]).select("data").collect():
                lines = _unpacked(held["data"])
                keys = [x["url_key"] for x in lines]
                out += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
        return sorted(out, key=lambda x: (x["page_id"] is not None, x["page_id"] or 0))

    def payload(self, line: dict) -> bytes:
        """The payload of a response line, read as a byte range; a revisit's is that of ``refers_to``."""
        data = self._range(line["file"], line["at"], line["length"])
        _, _, head, block = next(parse(data))
        if _digest(block) != head["WARC-Payload-Digest"].removeprefix("sha1:") and head["WARC-Type"] == "response":
            raise ValueError("the payload is damaged")
        return block

    def _range(self, file: str, at: int, length: int) -> bytes:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(file)
        stream = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(place)
        try:
            stream.seek(at)
            return bytes(stream.readNBytes(length))
        finally:
            stream.close()


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write archives and index of ``pages`` to scratch, look all their URLs up, and give what the captures say of each page."""
    spark = pages.sparkSession
    archives, index = scratch_path(spark, "archives"), scratch_path(spark, "captures")
    write_archives(pages, archives)
    release(spark)  # the html's shuffle files, as large as the archives
    write_index(read_records(spark, archives), index)
    found = find_captures(spark, index, url_keys(pages))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
