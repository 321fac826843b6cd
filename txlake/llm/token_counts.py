"""Token counts by scanning flat token files for end-of-document ids.

The files hold 16-bit little-endian ids and nothing else: no index, no lengths. Each task searches one
block of a file for the separator in one vectorised pass and reports, besides the documents that lie
whole in the block, how many tokens come before its first and after its last separator. A prefix scan
over the block reports of a file (sums of separators, the last separator so far) says with which
document a block begins and how many tokens of it lie in the blocks before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import bound_batches, column, text_of
from txlake.llm.pieces import Codec
from txlake.llm.shared_files import TempFile, open_fs
from txlake.session import stage

WIDTH = 2
WRITTEN = "file string, ordinal long, id long, n_bytes long"
REPORT = "file string, block long, n long, separators long, first long, last long, lengths array<long>"


def _writer(folder: str, model: bytes, max_file_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(model)
        if codec.model.vocab_size() > 1 << 8 * WIDTH:
            raise ValueError("ids do not fit")
        split, part, file, ordinal = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, len(batch), 64):
                some = batch.iloc[at : at + 64]
                for doc_id, ids in zip(some["id"], codec.encode(some["text"].tolist())):
                    if file is None:
                        name = f"tokens-{split:06d}-{part:05d}.bin"
                        file, ordinal = TempFile(f"{folder}/{name}"), 0
                    # Without the begin id; the end id is the separator.
                    file.write(np.frombuffer(ids, dtype="<u4")[1:].astype("<u2").tobytes())
                    rows.append((name, ordinal, None if pd.isna(doc_id) else int(doc_id), None))
                    ordinal += 1
                    if file.bytes >= max_file_bytes:
                        file.commit()
                        rows.append((name, None, None, file.bytes))
                        part, file = part + 1, None
            yield _frame(rows)
        if file is not None:
            file.commit()
            yield _frame([(name, None, None, file.bytes)])

    return write


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["file", "ordinal", "id", "n_bytes"])
    return frame.astype({"ordinal": "Int64", "id": "Int64", "n_bytes": "Int64"})


def write_token_files(
    docs: DataFrame, folder: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", max_file_bytes: int = 256 << 20
) -> tuple[DataFrame, DataFrame]:
    """Tokenize ``docs`` into flat files; returns (files, order).

    ``files`` (file, n_bytes) names what was written; ``order`` (file, ordinal, id) says which document
    stands where. Every row is a document: null and empty texts have no token but their separator,
    null ids and repeated rows are kept. Ids are integers. An empty table gives no file.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(column(docs, id_col).cast("long").alias("id"), text_of(column(docs, text_col)).alias("text"))
    written = stage(rows.mapInPandas(_writer(folder, model, max_file_bytes), WRITTEN), "token-order")
    files = written.where(F.col("ordinal").isNull()).select("file", "n_bytes")
    return files, written.where(F.col("ordinal").isNotNull()).select("file", "ordinal", "id")


def _scanner(folder: str, separator: int, block_bytes: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name, block in zip(batch["file"], batch["block"]):
                fs, path = open_fs(f"{folder}/{name}")
                with fs.open_input_file(path) as f:
                    f.seek(int(block) * block_bytes)
                    tokens = np.frombuffer(f.read(block_bytes), dtype="<u2")
                at = np.flatnonzero(tokens == separator)
                ends = (int(at[0]), int(at[-1])) if len(at) else (None, None)
                found.append((name, int(block), len(tokens), len(at), *ends, np.diff(at) - 1))
            frame = pd.DataFrame(found, columns=[c.split()[0] for c in REPORT.split(", ")])
            yield frame.astype({"first": "Int64", "last": "Int64"})

    return scan


def count_tokens(files: DataFrame, folder: str, separator: int, block_bytes: int = 4 << 20) -> DataFrame:
    """(file, ordinal, n_tokens) for every document that a separator ends, the separator not counted.

    Tokens after the last separator of a file belong to no document. ``files`` has (file, n_bytes);
    an empty file has no documents.
    """
    if block_bytes % WIDTH:
        raise ValueError("a block must hold whole tokens")
    spark = files.sparkSession
    blocks = files.where(F.col("n_bytes") > 0).select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_bytes") - 1) / block_bytes))).alias("block")
    )
    dealt = blocks.repartition(max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "block")
    reports = stage(dealt.mapInPandas(_scanner(folder, separator, block_bytes), REPORT), "block-reports")
    # A file has max_file_bytes / block_bytes blocks: small windows.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = reports.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    stitched = placed.select(
        "file", "start", "first", "lengths", "separators",
        F.coalesce(F.sum("separators").over(earlier), F.lit(0)).alias("ordinal"),
        F.coalesce(F.max(F.col("start") + F.col("last")).over(earlier), F.lit(-1)).alias("separator_before"),
    ).where(F.col("separators") > 0)
    # The first document of a block began after the last separator before it.
    lead = F.array(F.col("start") + F.col("first") - F.col("separator_before") - 1)
    docs = stitched.select("file", "ordinal", F.posexplode(F.concat(lead, F.col("lengths"))).alias("k", "n_tokens"))
    return docs.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "n_tokens")
