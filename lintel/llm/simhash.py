"""SimHash near-duplicates: segment popcounts as a Manhattan lower bound, then exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import keep_rows, row_key, stored, whole_text
from lintel.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
LOW_BITS = 0x5555555555555555
BLOCK = 1 << 14


def simhash(text: str, width: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's shingles of width words, repeats included; 0 without words."""
    words = text.encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.zeros(len(words), np.int64)
    np.cumsum(sizes[:-1] + 1, out=starts[1:])
    last = min(width, len(words)) - 1
    begins, ends = starts[: len(words) - last].tolist(), (starts + sizes)[last:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begins), BLOCK):
        hashes = [digest(joined[a:b], seed) for a, b in zip(begins[at : at + BLOCK], ends[at : at + BLOCK], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint16)
    set_bits = (2 * counts > len(begins)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, key, fp): the SimHash of every row as a signed long."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = np.fromiter((simhash(t, width) for t in frame["text"]), np.int64, len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "key": frame["key"], "fp": fp})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("key"), whole_text().alias("text"))
    return rows.mapInPandas(batches, "doc_id bigint, key binary, fp bigint")


def popcounts(fp: Column) -> Column:
    """The popcount of each of the 32 segments of two bits, in unary: 00, 01 or 11.

    In this code the Manhattan distance of two vectors of popcounts is the number of differing bits, and it is never
    above the distance of the fingerprints.
    """
    right = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(right).bitwiseAND(F.lit(LOW_BITS))
    every = fp.bitwiseAND(right).bitwiseAND(F.lit(LOW_BITS))
    return some.bitwiseOR(F.shiftleft(every, 1))


def close_pairs(prints: DataFrame, most: int = 3) -> DataFrame:
    """Pairs (a, b) of different fingerprints of the column fp that differ in at most 3 bits.

    If two vectors of popcounts are within Manhattan distance 3, their first or their second
    halves are within 1. So the grid of a half has a cell for every vector of 16 popcounts; a fingerprint
    lies in its own cell of both grids and also probes the cells that are one up in one coordinate. Of two
    fingerprints in neighbouring cells one is a step up from the other, so no pair is lost. Within
    the join the bound on the whole vectors is tested first and then the fingerprints themselves.
    fp must be free of repeats. A row costs about 28 narrow rows; cells hold only fingerprints that agree
    in a whole half, and a cell with very many is split by adaptive execution like any skewed key.
    """
    if most > 3:
        raise ValueError("the two grids are complete up to 3 differing bits")
    coded = prints.select("fp", popcounts(F.col("fp")).alias("code"))
    halves = coded.select(
        "fp", "code",
        F.posexplode(F.array(F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("code", 32))).alias("half", "cell"),
    )
    # One up: 00 becomes 01 and 01 becomes 11, that is, the lowest clear bit of the segment is set.
    low, high = 0x55555555, 0xAAAAAAAA
    risen = F.expr(
        f"transform(filter(sequence(0, 31), i -> (shiftrightunsigned(cell, i) & 1) = 0 AND "
        f"(i % 2 = 0 OR (shiftrightunsigned(cell, i - 1) & 1) = 1)), i -> cell | shiftleft(1L, i))"
    )
    assert low ^ high == 0xFFFFFFFF
    probes = halves.select("fp", "code", "half", F.col("cell").alias("own"), F.explode(F.concat(F.array("cell"), risen)).alias("cell"))
    a, b = halves.alias("a"), probes.alias("b")
    return (
        a.join(
            b,
            (F.col("a.half") == F.col("b.half")) & (F.col("a.cell") == F.col("b.cell"))
            & ((F.col("b.own") != F.col("b.cell")) | (F.col("a.fp") < F.col("b.fp")))
            & (F.bit_count(F.col("a.code").bitwiseXOR(F.col("b.code"))) <= most)
            & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= most),
        )
        .select(F.least("a.fp", "b.fp").alias("a"), F.greatest("a.fp", "b.fp").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id, class_key, key.

    Documents link when their fingerprints differ in at most `most` bits; component_id is the smallest
    doc_id reachable over links (null if no row of the component has an id), class_key the smallest
    row key among the rows with that id, which names one row to keep. Null texts and texts without words have
    fingerprint zero and link like any other; repeated rows each get a row; an empty table
    gives none; other columns are not looked at.

    Copies are merged into one fingerprint before anything is joined, so a group of copies of any size
    costs one probe and adds no pairs. Only different fingerprints are linked.
    """
    rows = stored(fingerprints(docs, width), "simhash")
    low = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    lone = rows.groupBy("fp").agg(F.min(low).alias("low"))
    roots = components(close_pairs(lone.select("fp"), most))
    classes = stored(
        lone.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes"
    )
    lowest = classes.groupBy("root").agg(F.min("low").alias("low"))
    named = classes.select("fp", "root").join(lowest, "root")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("low.doc_id").alias("component_id"),
        F.col("low.key").alias("class_key"), "key",
    )


def drop_near_duplicates(docs: DataFrame, width: int = 3, most: int = 3) -> DataFrame:
    """One row of every class of near_duplicates, with all its columns: the one with the smallest id."""
    return keep_rows(docs, near_duplicates(docs, width, most).where("key = class_key").select("key"))
