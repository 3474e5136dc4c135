"""Order-independent document fingerprints: a homomorphic hash of the multiset of paragraphs.

Only built-in functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lintel.llm.common import row_key, stored, whole_text

LANES = 64
POWER = 48
#: A line, cut after sentence ends; a stretch without any is cut every 240 characters, counted from the last cut.
PIECE = r"[^\n]{1,240}?(?:[.!?](?=\s)|(?=\n)|\z)|[^\n]{1,240}"


def _halves(lane: int) -> Column:
    """One signed 32-bit half of the hash number lane // 2 of the piece."""
    whole = F.xxhash64("h1", "h2", F.lit(lane // 2))
    return F.shiftright(whole, 32) if lane % 2 else F.shiftright(F.shiftleft(whole, 32), 32)


def multiset_hash(rows: DataFrame, by: list[str], text: str, lanes: int = LANES, piece: str = PIECE) -> DataFrame:
    """One row per value of `by`: n_pieces and the lane sums, an array of longs called sums.

    Every paragraph is hashed to `lanes` numbers of 32 bits with mean 0 (all derived from 128 bits of the paragraph);
    the fingerprint is their sum. Sums of up to 2^31 paragraphs fit a long, and as text only the
    remainder modulo 2^48 is given, so adding or subtracting fingerprints lane by lane inserts or deletes paragraphs.
    Texts without paragraphs have sums of 0. Values of `by` must be unique.
    """
    pieces = rows.select(*by, F.explode_outer(F.regexp_extract_all(text, F.lit(piece), F.lit(0))).alias("p")).select(
        *by, "p", F.xxhash64("p").alias("h1"), F.xxhash64(F.lit(1), "p").alias("h2")
    )
    there = F.col("p").isNotNull()
    sums = pieces.groupBy(*by).agg(
        F.count("p").alias("n_pieces"),
        *[F.sum(F.when(there, _halves(i)).otherwise(F.lit(0).cast("bigint"))).alias(f"s{i}") for i in range(lanes)],
    )
    return sums.select(*by, "n_pieces", F.array([f"s{i}" for i in range(lanes)]).alias("sums"))


def added(left: Column, right: Column, sign: int = 1) -> Column:
    """The sums after the paragraphs of right are inserted (sign 1) or deleted (sign -1)."""
    return F.zip_with(left, right, lambda x, y: x + y * F.lit(sign))


def as_text(sums: Column, power: int = POWER) -> Column:
    """The sums modulo 2^power, as hexadecimal digits."""
    digits = power // 4
    return F.array_join(F.transform(sums, lambda s: F.lpad(F.lower(F.hex(s.bitwiseAND(F.lit(2**power - 1)))), digits, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """Shared part of two multisets, estimated from the sums alone: 1 for equal sums, near 0 without common paragraphs.

    Lanes are random with mean 0, so the dot product of two sums estimates the common paragraphs and that of a sum with
    itself its own; 2ab / (aa + bb) is exactly 1 only for equal sums. The standard error is about 1 / sqrt(lanes).
    """
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda t, v: t + v)

    scale = dot(left, left) + dot(right, right)
    found = F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(left, right) * 2 / scale))
    return F.when(left == right, F.lit(1.0)).when(scale == 0, F.lit(0.0)).otherwise(found)


def ring(rows: DataFrame) -> DataFrame:
    """rows, which have key, doc_id and n, with next_key: the next key by descending id, and the first after the last.

    Null ids come last and equal ids go by key. Rows are dealt out by ranges of ids and numbered with their range;
    a window looks ahead within a range, and the end of a range takes the head of the next one. The heads are one row a
    range, so their broadcast is bounded by the number of partitions.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").desc()]
    ranged = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ring")
    within = Window.partitionBy("range").orderBy(*order)
    looked = ranged.withColumn("ahead", F.lead("key").over(within))
    heads = ranged.groupBy("range").agg(F.max_by("key", F.struct(F.col("doc_id").isNotNull(), "doc_id", "key")).alias("head"))
    along = Window.partitionBy(F.lit(0)).orderBy("range")
    around = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("range", F.coalesce(F.lead("head").over(along), F.first("head").over(around)).alias("head"))
    return looked.join(F.broadcast(after), "range").select(*rows.columns, F.coalesce("ahead", "head").alias("next_key"))


def edited_fingerprints(docs: DataFrame, lanes: int = LANES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are to neighbours.

    Edited: the last third (rounded down) of the code points is replaced by as many, or all, from the
    start of the next document by descending doc_id; after the last comes the first. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_pieces. Null text counts as empty; an empty
    text has the fingerprint of no paragraphs. Rows repeated as a whole count once in the order of
    documents and each get a row. A table of one document is its own next. No rows for an empty table.

    Rows repeated as a whole are merged before anything moves, so a hot row is one row a task. Texts then move through one shuffle by key, which
    all uses of them share, the starts of texts through a second one, and the lane sums of a text, to the document before
    it, through a third. All else is made within a partition, as rows then lie by key.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), row_key().alias("key"))
    known = texts.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min(F.length("text")).alias("n"), F.count("*").alias("copies"))
    links = stored(ring(known), "ring")
    by_key = texts.select("key", "text").dropDuplicates(["key"])
    wanted = links.select(F.col("next_key").alias("key"), F.col("key").alias("to"), F.expr("n div 3").alias("size"))
    starts = by_key.join(wanted, "key").select(F.col("to").alias("key"), F.expr("substring(text, 1, int(size))").alias("start"))
    facts = ["key", "doc_id", "n", "copies"]
    both = by_key.join(links.select(*facts), "key").join(starts, "key").select(
        *facts, F.posexplode(F.array("text", F.expr("concat(substring(text, 1, int(n - n div 3)), start)"))).alias("which", "t")
    ).select(*facts, "which", "t", F.sha2("t", 256).alias("sha"))
    sums = multiset_hash(both, [*facts, "which", "sha"], "t", lanes)
    one = lambda c, at: F.first(F.when(F.col("which") == at, F.col(c)), ignorenulls=True)
    prints = sums.groupBy(*facts).agg(
        one("n_pieces", 0).alias("n_pieces"), one("sums", 0).alias("own"), one("sums", 1).alias("new"), one("sha", 1).alias("edited_sha256")
    )
    # the sums of every text once more, sent to the document before it: narrower than to carry both documents' sums through a join
    near = multiset_hash(by_key, ["key"], "text", lanes).join(wanted, "key").select(F.col("to").alias("key"), F.col("sums").alias("next_own"))
    return (
        prints.join(near, "key")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            "doc_id", F.col("n").cast("bigint").alias("n_chars"), "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("new")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"), "n_pieces",
        )
    )
