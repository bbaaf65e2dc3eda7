"""Token ids in ORC files (operator 6).

Documents are range-partitioned by id, tokenised in place and written as ORC:
integer columns run-length encoded, row indexes every ``INDEX_ROWS`` rows and
Bloom filters on ``doc_id``.  Files can be split at stripes when read, and a
filter on ids skips stripes and row groups by their statistics and filters.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .common import read, slices
from .tokenizing import byte_bpe

STRIPE_BYTES = 32 << 20
INDEX_ROWS = 1000


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Write the ids of every text (null: empty) followed by ``end_id``.

    Files hold doc_id, part (number of the range of ids), part_start (ids of
    the earlier rows of the part) and ids, in ascending doc_id order; null ids
    come first and rows with equal ids in input order.  The raw texts are
    shuffled once, before tokenising, so nothing is tokenised twice; an id
    shared by many rows is spread over parts by the input position.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        bpe, before, part = byte_bpe(tokenizer_path), 0, TaskContext.get().partitionId()
        for b in slices(batches):
            ids = [np.append(x, np.uint32(end_id)) for x in bpe.encode(b.column("text"))]
            sizes = np.array([len(x) for x in ids], np.int64)
            ends = np.cumsum(sizes)
            flat = pa.array(np.concatenate(ids).astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(before + ends - sizes),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), flat)],
                ["doc_id", "part", "part_start", "ids"])
            before += int(ends[-1])

    ordered = (docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("__at"))
               .repartitionByRange("doc_id", "__at").sortWithinPartitions("doc_id", "__at"))
    (ordered.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, part int, part_start long, ids array<int>")
     .write.mode("error")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(INDEX_ROWS))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd")
     .orc(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """doc_id, part, part_start, ids; a list of ids becomes a pushed filter
    that ORC answers from its statistics and Bloom filters."""
    df = spark.read.orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))


def file_digest(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all earlier documents), n_tokens, ids_crc32 of
    what ``read_token_files`` gives.  Only one total per part is gathered; the
    running sum over the parts is a window over those totals."""
    kind = files.schema["doc_id"].dataType.simpleString()

    def digest(batches):
        for b in batches:
            ids = b.column("ids")
            offs, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[lo:hi]) for lo, hi in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("part_start"), pa.array(np.diff(offs).astype(np.int64)),
                 pa.array(crc, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(digest, f"doc_id {kind}, part int, part_start long, n_tokens long, ids_crc32 long")
    totals = files.groupBy("part").agg(F.max(F.col("part_start") + F.size("ids")).alias("n"))   # the last row of a part ends it
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_offset"))
    return rows.join(F.broadcast(offsets), "part").select(   # one row per part written, a few hundred thousand at most
        "doc_id", (F.col("part_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as ORC under the shared folder and read back."""
    import public_tokenizers
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-token-files-{uuid.uuid4().hex}"
    write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return file_digest(read_token_files(spark, path))
