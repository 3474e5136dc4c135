"""Best-fit packing of documents into sequences, by rounds over a shrinking tree of partitions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import stored, whole_text
from lintel.llm.vocabulary import encoder

#: Items that one task packs at a time, at most: some 40 MB.
TASK_ITEMS = 200_000
#: Partitions whose underfull bins meet in the next round.
FAN_IN = 8


def best_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of every item, and the fill of every bin: best fit over falling sizes.

    Bins are kept by their free room, and a bit mask tells which rooms exist, so the tightest bin that takes an
    item is the lowest set bit at or above its size.
    """
    bins, offsets, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    free: list[list[int]] = [[] for _ in range(room + 1)]
    mask = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            at = free[left].pop()
            if not free[left]:
                mask &= ~(1 << left)
        else:
            left, at = room, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, room - left
        fills[at] += size
        left -= size
        if left:
            if not free[left]:
                mask |= 1 << left
            free[left].append(at)
    return bins, offsets, np.array(fills, np.int64)


def pieces(docs: DataFrame, tokenizer: str, room: int, end: int, with_ids: bool) -> DataFrame:
    """(item, doc_id, piece, start, length, ids_crc32[, ids]): documents with an end id, cut to at most room ids.

    Only the first piece of a document may be shorter than room. item numbers the pieces of a task.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(tokenizer)
        tail = coder.packed([end])
        at = TaskContext.get().partitionId() << 40
        for batch in given:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.frombuffer(coder.encode(text) + tail, coder.dtype).astype("<u4")
                cuts = [0, *range(len(ids) % room or min(room, len(ids)), len(ids) + 1, room)]
                for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row = [at, doc_id, n, a, b - a, zlib.crc32(ids[a:b])] + [ids[a:b].astype(np.int32)] * with_ids
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types, strict=True)], names)

    kinds = "item bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    names = [k.split()[0] for k in kinds.split(", ")]
    of = {"bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    types = [of[k.split()[1]] for k in kinds.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(batches, kinds)


def fit_round(items: DataFrame, room: int, level: int, parts: int) -> DataFrame:
    """(item, bin, base, fill) for (item, size), packed within each of parts partitions; bins are new numbers."""

    def packed(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = (level << 56) | (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal made
            table = pa.Table.from_batches(held)
            bins, base, fills = best_fit(table["size"].to_numpy().astype(np.int64), room)
            out = [table["item"].combine_chunks(), pa.array(bins + made), pa.array(base), pa.array(fills[bins])]
            made += len(fills)
            return pa.RecordBatch.from_arrays(out, ["item", "bin", "base", "fill"])

        for batch in given:
            held.append(batch)
            if sum(b.num_rows for b in held) >= TASK_ITEMS:
                yield flush()
                held = []
        if held:
            yield flush()

    return items.repartition(parts).mapInArrow(packed, "item bigint, bin bigint, base bigint, fill bigint")


def place(items: DataFrame, room: int, slack: int = 0) -> DataFrame:
    """(item, bin, base): a bin and an offset for every (item, size) with sizes from 1 to room.

    Round 0 packs the items of every partition by best fit. Bins with at most slack free places are done;
    the others become items of the next round, in which the bins of FAN_IN partitions meet, until one partition
    has had them all or a round merges nothing. A partition is packed in portions of TASK_ITEMS, so a task's memory is
    bounded. Each round's table is in the shared folder, and the table of rounds is folded from
    its end: what is joined with the items at last is one row for each bin of round 0 that went on.
    """
    parts = max(1, -(-items.count() // TASK_ITEMS))
    rounds = [stored(fit_round(items, room, 0, parts), "bins")]
    while True:
        under = rounds[-1].where(F.col("fill") < room - slack).select(F.col("bin").alias("item"), F.col("fill").alias("size")).distinct()
        n = under.count()
        if n < 2 or (parts == 1 and len(rounds) > 1):
            break
        parts = max(1, -(-parts // FAN_IN), -(-n // TASK_ITEMS))
        rounds.append(stored(fit_round(under, room, len(rounds), parts), "bins"))
        if rounds[-1].select("bin").distinct().count() == n:
            break
    where = None
    for later in reversed(rounds[1:]):
        later = later.select("item", "bin", "base")
        where = later if where is None else _moved(later, where)
    placed = rounds[0].select("item", "bin", "base")
    return placed if where is None else _moved(placed, where)


def _moved(placed: DataFrame, where: DataFrame) -> DataFrame:
    to = where.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("base").alias("by"))
    return placed.join(to, "bin", "left").select(
        "item", F.coalesce("to", "bin").alias("bin"), (F.col("base") + F.coalesce("by", F.lit(0))).alias("base")
    )


def pack_documents(docs: DataFrame, tokenizer: str, room: int = 1024, end: int = 2, slack: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    Whole texts are encoded once and the end id is appended; a document above room ids is cut, its first piece being
    the short one. Null text counts as empty, so its document is the end id alone; repeated rows are packed each; an
    empty table gives no rows. Pieces of a sequence lie one after the other from offset 0. Texts do not move: what
    the rounds shuffle is an item number and a size, and numbers below come from the written table of pieces.
    """
    cut = stored(pieces(docs, tokenizer, room, end, with_ids), "pieces")
    where = place(cut.select("item", F.col("length").alias("size")), room, slack)
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return cut.join(where, "item").select(*kept, F.col("bin").alias("sequence_id"), F.col("base").alias("offset"))
