"""Exact duplicates: group by a 128-bit content hash, compare bytes inside groups.

Only built-in functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import BLANKS, keep_rows, row_key, whole_text


def without_blanks(text: Column) -> Column:
    """The text without ASCII white space: two texts are equal when this is."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _number(digits: str) -> Column:
    return F.lit(digits).cast("decimal(38,0)")


def _rank(doc_id: Column, length: Column) -> Column:
    """Length descending, then id ascending with null last, as one number, which aggregates in place."""
    place = F.coalesce(doc_id.cast("decimal(38,0)") + _number(str(2**63)), _number(str(2**64)))
    return ((F.lit(2**31) - length).cast("decimal(17,0)") * F.lit(str(10**20)).cast("decimal(21,0)") + place).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    """The id in a rank; null for the place of null."""
    place = rank % _number(str(10**20))
    return F.when(place < _number(str(2**64)), (place - _number(str(2**63))).cast("bigint"))


def exact_duplicates(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, key.

    Texts are equal when identical after white space is deleted; null counts as empty. Of equal
    texts the row with the most code points stays, then the smallest doc_id (null ids last). Rows
    that agree in id and length too each get a row, and one of them is kept; key is the smallest
    of theirs, so for a kept row it names one input row. An empty table gives no rows; other columns of docs are not looked at.

    The grouping key is the hash and then the text itself, so a collision of the hash leaves two
    groups. Aggregation before the shuffle turns the copies that a task has seen into one row, however
    many there are. Only ids, hashes and lengths go through the join that tells every row its group;
    the partitions of a huge group are split there by adaptive execution.
    """
    rows = docs.select(
        "doc_id", F.length(whole_text()).alias("n"), without_blanks(whole_text()).alias("bare"), row_key().alias("key")
    ).select("doc_id", "n", "key", "bare", hashed(F.col("bare")).alias("hash"), F.sha2("bare", 256).alias("sha"))
    first = _rank(F.col("doc_id"), F.col("n"))
    groups = (
        rows.groupBy("hash", "bare").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
        .select("hash", F.sha2("bare", 256).alias("sha"), "first", "group_size")
    )
    members = (
        rows.groupBy("hash", "sha", "doc_id", "n").agg(F.count("*").alias("copies"), F.min("key").alias("key"))
        .withColumn("rank", first)
    )
    return (
        members.join(groups, ["hash", "sha"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            "doc_id", _id_of(F.col("first")).alias("keep_id"), "group_size",
            ((F.col("rank") == F.col("first")) & (F.col("copy") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"), "key",
        )
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all their columns."""
    return keep_rows(docs, exact_duplicates(docs).where("kept").select("key"))


EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT bare, arg_min(doc_id, {'n': -length(text), 'd': doc_id}) AS keep_id, count(*) AS group_size
  FROM t GROUP BY bare
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.bare) AS text_sha256
FROM t JOIN g USING (bare)
"""
