"""Deterministic sharded WARC archives, written by tasks and read back.

Records are sorted by id within ranges of about equal size, which come from an exact histogram of
payload bytes, so the same input gives the same shards and, byte for byte, the same files. A shard rolls
to a new file when the compressed size passes a limit. HTTP headers, record ids and digests are made
anew. Files appear under their names only when complete and count only if the manifest names them.

Which records revisit others is decided on (id, digest, length) alone. The decisions travel as marker
rows that sort in front of the page they belong to, so the payloads are shuffled once.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm.common import bound_batches, column, text_of
from txlake.llm.shared_files import TempFile, open_fs
from txlake.session import stage

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
BUCKETS = 1 << 14
ENTRY = "shard long, part long, file string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}:{copy}')}>"


def _record(page_id, url, payload: bytes, digest: str, refers_to: int | None, copy: int) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "about:blank"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest, 0)), ("X-Refers-To-Page-Id", str(refers_to))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class _Shard:
    """Writes the records of one shard, file after file."""

    def __init__(self, folder: str, shard: int, max_file_bytes: int, level: int):
        self.folder, self.shard, self.max_file_bytes, self.level = folder, shard, max_file_bytes, level
        self.part, self.file = 0, None
        self.entries: list[tuple] = []

    def add(self, record: bytes) -> None:
        if self.file is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.file, self.records, self.hash = TempFile(f"{self.folder}/{self.name}"), 0, hashlib.sha256()
        # One gzip member a record, without a time, so that equal records are equal bytes.
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self.file.write(data)
        self.hash.update(data)
        self.records += 1
        if self.file.bytes >= self.max_file_bytes:
            self.roll()

    def roll(self) -> None:
        if self.file is not None:
            self.file.commit()
            self.entries.append((self.shard, self.part, self.name, self.records, self.file.bytes, self.hash.hexdigest()))
            self.part, self.file = self.part + 1, None


def _writer(folder: str, max_file_bytes: int, level: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, marked, last, copy = None, None, None, 0
        entries: list[tuple] = []
        for batch in batches:
            rows = zip(batch["shard"], batch["id"], batch["digest"], batch["marker"], batch["refers_to"], batch["url"], batch["payload"])
            for number, page_id, digest, marker, refers_to, url, payload in rows:
                page_id = None if pd.isna(page_id) else int(page_id)
                if marker:
                    marked = (page_id, digest, int(refers_to))
                    continue
                if shard is None or shard.shard != number:
                    if shard is not None:
                        shard.roll()
                        entries += shard.entries
                    shard = _Shard(folder, int(number), max_file_bytes, level)
                copy = copy + 1 if last == (page_id, digest) else 0
                last = (page_id, digest)
                original = marked[2] if marked is not None and marked[:2] == last else None
                shard.add(_record(page_id, url, payload, digest, original, copy))
        if shard is not None:
            shard.roll()
            entries += shard.entries
        yield pd.DataFrame(entries, columns=[c.split()[0] for c in ENTRY.split(", ")])

    return write


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_payload: int = 100, shard_bytes: int = 32 << 20, max_file_bytes: int = 16 << 20, level: int = 6,
) -> DataFrame:
    """Write one record per row of ``pages`` under ``folder`` and return the manifest.

    Of records with equal payloads of ``min_payload`` bytes or more the smallest id is a response, the
    others revisit it; all shorter ones are responses. Rows that repeat the smallest id with the same
    payload are responses as well, each with a record id of its own. A null payload is empty. Null ids
    have no smallest: they revisit the smallest id of the same payload if there is one; they are
    written in shards of their own. An empty table gives an empty manifest. Other columns play no part.
    """
    bound_batches(pages.sparkSession)
    payload = F.encode(text_of(column(pages, payload_col)), "UTF-8")
    keyed = pages.select(
        column(pages, id_col).cast("long").alias("id"), column(pages, url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    # Ids, digests and lengths are needed several times: written once, a hundred bytes a page.
    ids = stage(keyed.select("id", "digest", F.octet_length("payload").cast("long").alias("n")), "warc-ids")

    firsts = (
        ids.where(F.col("n") >= min_payload).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) & F.col("first").isNotNull()).select("digest", "first")
    )
    markers = (
        ids.where(F.col("n") >= min_payload).join(firsts, "digest")
        .where(F.col("id").isNull() | (F.col("id") > F.col("first")))
        .select("id", "digest", F.col("first").alias("refers_to")).distinct()
    )

    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    lo, width = ends["lo"] or 0, max(1, -(-((ends["hi"] or 0) - (ends["lo"] or 0) + 1) // BUCKETS))
    # Null ids sort among themselves by digest, in 256 buckets below all others.
    bucket = F.when(F.col("id").isNull(), F.conv(F.substr("digest", F.lit(1), F.lit(2)), 16, 10).cast("long") - 256).otherwise(
        F.floor((F.col("id") - lo) / width)
    )
    # At most BUCKETS + 256 rows, one per bucket: that bounds the window and the broadcast.
    sizes = ids.groupBy(bucket.alias("bucket")).agg(F.sum(F.col("n") + 600).alias("bytes"))
    before = F.coalesce(F.sum("bytes").over(_ordered()), F.lit(0))
    shards = F.broadcast(sizes.select("bucket", F.floor(before / shard_bytes).alias("shard")))

    rows = keyed.select("id", "digest", F.lit(False).alias("marker"), F.lit(None).cast("long").alias("refers_to"), "url", "payload").unionByName(
        markers.select("id", "digest", F.lit(True).alias("marker"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    )
    placed = rows.withColumn("bucket", bucket).join(shards, "bucket").drop("bucket")
    n_shards = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    # Shard numbers are consecutive: a range partition each, or several neighbours if there are many.
    dealt = placed.repartitionByRange(int(min(n_shards, 100_000)), "shard").sortWithinPartitions("shard", "id", "digest", F.desc("marker"), "url")
    entries = dealt.mapInPandas(_writer(f"{folder}/records", max_file_bytes, level), ENTRY)
    # Spark commits the manifest as a whole; a file it does not name is no part of the archive.
    entries.write.mode("overwrite").json(f"{folder}/manifest")
    return manifest(pages.sparkSession, folder)


def _ordered():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENTRY).json(f"{folder}/manifest")


def records(stream, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip stream, one member after the other."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest:
                rest = stream.read(chunk)
                if not rest:
                    if parts:
                        raise ValueError("the archive ends within a record")
                    return
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        record = b"".join(parts)
        head, _, body = record.partition(b"\r\n\r\n")
        version, *lines = head.split(b"\r\n")
        headers = dict(line.decode().split(": ", 1) for line in lines)
        block = body[: int(headers["Content-Length"])]
        if version != VERSION or body[len(block) :] != b"\r\n\r\n":
            raise ValueError("malformed record")
        if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"block digest of {headers['WARC-Record-ID']} is wrong")
        yield headers, block


def _reader(folder: str, with_payload: bool):
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                fs, path = open_fs(f"{folder}/records/{name}")
                found, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for headers, block in records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        claimed = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        original = headers.get("X-Refers-To-Page-Id")
                        if original is None and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, claimed):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not fit its headers")
                        page_id = headers.get("X-Page-Id")
                        found.append((
                            None if page_id is None else int(page_id), headers["WARC-Target-URI"], headers["WARC-Type"], size, claimed,
                            None if original is None else int(original), payload if with_payload and original is None else None,
                        ))
                        held += len(payload) if with_payload else 100
                        if held > 8 << 20:
                            yield _frame(found, columns)
                            found, held = [], 0
                yield _frame(found, columns)

    return read


def _frame(found: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(found, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the files that the manifest names; digests are checked on the way.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisits too.
    """
    files = manifest(spark, folder).select("file", "shard", "part")
    dealt = files.repartition(spark.sparkContext.defaultParallelism * 4, "file")
    return dealt.select("file").mapInPandas(_reader(folder, with_payload), RECORD)
