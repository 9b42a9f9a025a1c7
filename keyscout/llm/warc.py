"""A deterministic sharded WARC writer and a reader of what it committed.

Records are range-sorted by page id, then by payload digest. Ranges begin at those of the (id, digest) keys whose hash
lies under a bound, about 65,536 of them, whatever the ids are: a stray id makes no range wider, and the rows of one id or
without an id are split by digest. Bytes are summed per range over all rows, and shards are runs of ranges, so the same
input always gives the same files. Only rows equal in id and digest always share a shard. A task writes the records of a shard in order and begins
a new file when the compressed bytes reach the limit. Headers, record ids and digests are made anew from the payload.
Each file is written under a temporary name and moved into place; the manifest, written last, names the files with
their record counts and SHA-256, and only files that it names count as written.

Of records with equal payloads of at least 100 bytes, the one with the smallest page id is a response and the others
are revisits, which hold headers only. A null payload is an empty one. Null ids are sorted last, are kept as null, and
are a response only if no equal payload has an id. Among rows that repeat an id and payload one is the response and the
others revisit it. Empty tables give an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout.llm.files import opened, write_whole

LEAST_REVISIT = 100
#: Ranges that bytes are counted for.
RANGES = 65_536
SHARD_BYTES = 32 << 20
FILE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _sha(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def _key(page_id: Column, digest: Column) -> Column:
    """Text of 37 characters in the order of ids, null last, then of digests."""
    number = F.lpad((page_id.cast("decimal(20,0)") + F.lit(Decimal(1 << 63))).cast("string"), 20, "0")
    return F.concat(F.coalesce(F.concat(F.lit("0"), number), F.lit("1" + "0" * 20)), F.substring(digest, 1, 16))


def _range_of(edges: list[str]) -> Callable[[Column], Column]:
    """How many of the sorted ``edges`` are not above a key."""
    sorted_edges = np.array(edges, "S37")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sorted_edges, keys.to_numpy().astype("S37"), side="right").astype(np.int32))

    return place


def _shard_edges(digests: DataFrame, shard_bytes: int) -> list[str]:
    """The least keys of all shards but the first; at most one edge for every range."""
    keys = digests.select(_key(F.col("page_id"), F.col("digest")).alias("key"), "bytes")
    n = keys.count()
    picked = keys.select("key")
    if n > RANGES:
        picked = picked.where(F.shiftrightunsigned(F.xxhash64("key"), 1) < F.lit(int(RANGES / n * (1 << 63))))
    edges = sorted(r["key"] for r in picked.distinct().collect())
    sizes = keys.groupBy(_range_of(edges)(F.col("key")).alias("range")).agg(F.sum(F.col("bytes") + 512).alias("bytes"))
    starts, held = [], 0
    for at, size in sorted(tuple(r) for r in sizes.collect()):
        if held and held + size > shard_bytes:
            starts.append(edges[at - 1])
            held = 0
        held += size
    return starts


def _page_record(page: int | None, url: str | None, payload: bytes, refers: tuple[int | None] | None, nth: int) -> bytes:
    """One gzip member; ``refers`` holds the response's page id for a revisit."""
    name = "" if page is None else str(page)
    digest = _sha(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {name}\r\n\r\n".encode()
    block = http if refers else http + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in (url or "")) or "urn:page:" + name
    headers = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{target} {name} {digest} {nth}')}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target)]
    if refers:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", "" if refers[0] is None else str(refers[0]))]
    headers += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _sha(block)), ("Content-Type", "application/http; msgtype=response")]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(_record("revisit" if refers else "response", headers, block)) + packer.flush()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_revisit: int = LEAST_REVISIT, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` under ``folder`` and returns the manifest (file, records, bytes, sha256), which is in the folder, too."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    digests = rows.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    edges = _shard_edges(digests, shard_bytes)
    spark = pages.sparkSession
    first = digests.where(F.col("bytes") >= least_revisit).groupBy("digest").agg(F.min("page_id").alias("response"), F.count("*").alias("copies")).where("copies > 1")
    revisits = digests.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("response"))).select("page_id", "digest", "response", F.lit(True).alias("revisit")).distinct()
    records = rows.select("page_id", F.sha2("payload", 256).alias("digest"), "url", "payload", F.lit(None).cast("long").alias("response"), F.lit(False).alias("revisit"))
    mixed = records.unionByName(revisits, allowMissingColumns=True)
    placed = mixed.withColumn("shard", _range_of(edges)(_key(F.col("page_id"), F.col("digest"))))
    dealt = placed.repartitionById(len(edges) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "digest", F.desc("revisit"), "url")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, body, count, last, told, nth = None, 0, [], 0, None, None, 0
        done: list[tuple] = []

        def roll() -> None:
            nonlocal part, body, count
            if body:
                data = b"".join(body)
                name = f"pages-{now:06d}-{part:04d}.warc.gz"
                write_whole(f"{folder}/{name}", data)
                done.append((name, count, len(data), hashlib.sha256(data).hexdigest()))
                part, body, count = part + 1, [], 0

        size = 0
        for batch in batches:
            names = batch.schema.names
            for row in zip(*(batch.column(names.index(c)) for c in ("shard", "page_id", "digest", "url", "payload", "response", "revisit"))):
                at, page, digest, url, payload, response, revisit = (x.as_py() for x in row)
                if at != now:
                    roll()
                    now, part, size = at, 0, 0
                if revisit:
                    told = (page, digest, response)
                    continue
                same = last == (page, digest)
                nth = nth + 1 if same else 0
                last = (page, digest)
                refers = None
                if told and told[:2] == (page, digest):
                    refers = (told[2],)
                elif same and len(payload) >= least_revisit:
                    refers = (page,)
                body.append(_page_record(page, url, payload, refers, nth))
                count += 1
                size += len(body[-1])
                if size >= file_bytes:
                    roll()
                    size = 0
        roll()
        files, records, sizes, shas = zip(*done) if done else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())], ["file", "records", "bytes", "sha256"])

    manifest = f"{folder}/manifest"
    dealt.mapInArrow(write, "file string, records long, bytes long, sha256 string").write.json(manifest)
    return spark.read.schema("file string, records long, bytes long, sha256 string").json(manifest)


def _members(path: str) -> Iterator[bytes]:
    """The gzip members of a file, one by one."""
    system, name = opened(path)
    with system.open_input_stream(name, compression=None) as source:
        unpack, parts, data = zlib.decompressobj(31), [], b""
        while data or (data := source.read(1 << 20)):
            parts.append(unpack.decompress(data))
            data = b""
            if unpack.eof:
                yield b"".join(parts)
                data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of the files that the manifest names.

    Digests of blocks and of whole payloads are checked against the headers; a mismatch is an error.
    """
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string").json(f"{folder}/manifest")
    shard = F.regexp_extract("file", r"^pages-(\d+)-", 1).cast("int")
    shards = manifest.agg(F.max(shard)).first()[0] or 0
    files = manifest.select("file", shard.alias("shard")).repartitionById(shards + 1, F.col("shard")).select("file")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out: list[tuple] = []
                held = 0
                for record in _members(f"{folder}/{name}"):
                    out.append(_parsed(record))
                    held += len(record)
                    if held > 4 << 20:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    return files.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if _sha(block) != fields["warc-block-digest"]:
        raise ValueError(f"a block digest does not match: {fields['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = _fields(http)
    kind = head.split(b"\r\n")[1].partition(b":")[2].strip().decode()
    digest = fields["warc-payload-digest"]
    if kind == "response" and _sha(payload) != digest:
        raise ValueError(f"a payload digest does not match: {fields['warc-record-id']}")
    number = lambda x: int(x) if x else None
    sha = base64.b32decode(digest.partition(":")[2]).hex()
    refers = number(fields.get("x-refers-to-page", "")) if kind == "revisit" else None
    return number(inner["x-page-id"]), fields["warc-target-uri"], int(inner["content-length"]), sha, kind, refers, payload if kind == "response" else None
