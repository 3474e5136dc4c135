"""Token-id files: frequency ranks in one to four bytes each, lengths in separate control bytes.

A file is a folder with two Parquet tables. `ranks` lists the ids by falling frequency. `blocks` has one row for about
65,536 ids of consecutive documents: shard, block, first (ids of the shard before it), doc_ids, lengths, control, data.
A control byte holds the byte lengths, less one, of four ranks, the first in its low bits; data holds their
bytes, low ones first. The tables are written by Spark's committers, so an attempt that dies leaves nothing behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lintel.llm.common import shared_path, stored, whole_text
from lintel.llm.vocabulary import encoder

BLOCK_IDS = 1 << 16
#: For every control byte the byte lengths of its four values.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
STEPS = np.arange(4, dtype=np.uint32)
BLOCKS = (
    "shard int, block int, first long, n_ids long, doc_ids array<bigint>, lengths array<int>, control binary, data binary"
)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[STEPS <= more[:, None]]
    fours = np.zeros((len(values) + 3) // 4 * 4, np.uint8)
    fours[: len(values)] = more
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of pack: byte lengths by table lookup, then one gather for each byte position."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for step in range(1, 4):
        at = np.flatnonzero(sizes > step)
        values[at] |= raw[starts[at] + step].astype(np.uint32) << np.uint32(8 * step)
    return values


def token_ids(docs: DataFrame, tokenizer: str, end: int | None) -> DataFrame:
    """(doc_id, key, ids): ids of every whole text as little-endian bytes, and the end id where one is given.

    key is a hash of the text, which orders rows of one doc_id.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        tail = b"" if end is None else coder.packed([end])
        for batch in given:
            ids = [coder.encode(t) + tail for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.array(ids, pa.binary())], ["doc_id", "key", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(whole_text()).alias("key"), whole_text().alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, key bigint, ids binary")


def frequencies(tokens: DataFrame, dtype: str, size: int) -> DataFrame:
    """(id, n) of all ids. A task hands on one row for each id at most."""

    def counted(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in given:
            total += np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return tokens.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int | None = 0) -> None:
    """Encode all whole texts and write their ids in ascending doc_id order (null ids last, ties by text) to path.

    Null text counts as empty, so its document is the end id alone. Ids are made once and kept in the shared folder;
    the frequencies of the whole corpus come from there. The ranks are as many as the vocabulary has ids, which bounds what the
    driver holds. One range shuffle of the ids puts them in order.
    """
    spark = docs.sparkSession
    coder = encoder(tokenizer)
    dtype, size = coder.dtype, coder.size
    tokens = stored(token_ids(docs, tokenizer, end), "ids", "snappy")
    counts = frequencies(tokens, dtype, size).toPandas()
    n = np.zeros(size, np.int64)
    n[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    by_rank = np.argsort(-n, kind="stable")
    rank = np.empty(size, np.uint32)
    rank[by_rank] = np.arange(size, dtype=np.uint32)
    spark.createDataFrame(
        pa.table({"rank": pa.array(range(size), pa.int32()), "id": pa.array(by_rank, pa.int32()), "n": pa.array(n[by_rank], pa.int64())})
    ).coalesce(1).write.parquet(f"{path}/ranks")

    def blocks(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, first, number = TaskContext.get().partitionId(), 0, 0
        names: list = []
        parts: list = []
        held = 0

        def block() -> pa.RecordBatch:
            control, data = pack(rank[np.concatenate(parts)])
            row = [shard, number, first, held, names, [len(p) for p in parts], control, data]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            fields = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], fields)

        for batch in given:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                names.append(doc_id)
                parts.append(np.frombuffer(ids, dtype))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield block()
                    first, number, held, names, parts = first + held, number + 1, 0, [], []
        if names:
            yield block()

    order = [F.col("doc_id").asc_nulls_last(), F.col("key").asc()]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids, from a file of write_ids.

    Blocks know their place in their shard; the sizes of the shards, one row each, are summed up and joined by broadcast.
    """
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()], np.uint32)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )

    def documents(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for row in batch.to_pylist():
                ids = by_rank[unpack(row["control"], row["data"], row["n_ids"])]
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                out = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"] + row["base"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), pa.array(ids, pa.int64()).cast(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names)

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    names = [k.split()[0] for k in kinds.split(", ")]
    return blocks.join(F.broadcast(shards), "shard").mapInArrow(documents, kinds)


def through_file(docs: DataFrame, tokenizer: str, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Write docs to a new file in the shared folder and read it back."""
    path = shared_path(docs.sparkSession, "idfile")
    write_ids(docs, path, tokenizer, end)
    return read_ids(docs.sparkSession, path, with_ids)
