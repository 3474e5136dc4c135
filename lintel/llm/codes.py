"""Vector code compression: product codes whose codebooks are learnt by Lloyd rounds that skip entries which did not move."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import discard, stored_at
from lintel.llm.vectors import SCALE, add_groups, is_whole, lists, matrix, squared_distances, sum_rows, sum_schema, summed, to_integers
from lintel.operators.state import State, lookup
from lintel.session import spread

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Rows of one distance matrix: some 8 MB at 256 entries.
STEP = 4096


@dataclass
class Codebooks:
    """Integer entries, part by entry by position within the part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def text(self) -> str:
        """All components in decimal, by part, entry and position, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that rows of codes stand for."""
        return np.concatenate([part[codes[:, p]] for p, part in enumerate(self.entries)], axis=1)


def assign(x: np.ndarray, entries: np.ndarray, code: np.ndarray, far: np.ndarray, moved: np.ndarray) -> None:
    """Bring the nearest entry (the lower index on a tie) and the squared distance of parts up to date, in place.

    code and far hold what was right before the entries marked in `moved` were replaced. A part whose own entry has not moved is still
    at the stored distance, and every other entry that stayed is still behind it: only the moved ones are
    compared. Where the own entry moved, or none is known (code -1), all entries are looked at.
    """
    own = (code < 0) | moved[code]
    rest = np.nonzero(own)[0]
    if len(rest):
        found = squared_distances(x[rest], entries)
        code[rest] = found.argmin(1)
        far[rest] = found[np.arange(len(rest)), code[rest]]
    active = np.nonzero(moved)[0]
    kept = np.nonzero(~own)[0]
    if len(kept) and len(active):
        found = squared_distances(x[kept], entries[active])
        best = found.argmin(1)
        near, index = found[np.arange(len(kept)), best], active[best]
        better = (near < far[kept]) | ((near == far[kept]) & (index < code[kept]))
        code[kept[better]], far[kept[better]] = index[better], near[better]


def _kept(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """Rows with whole vectors, of integers; as yet without codes."""
    rows = vectors.where(is_whole(vector)).select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), to_integers(vector).alias("v")
    )
    return spread(rows)


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; equal ids go by their vectors, null ids come last."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    fit = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = fit.orderBy(*order).limit(1).select(F.size("v")).first()
    if first is None:
        return None
    width = first[0]
    start = np.array([r.v for r in fit.where(F.size("v") == width).orderBy(*order).limit(entries).select("v").collect()], np.int64)
    return Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, width // parts).transpose(1, 0, 2)))


def _assigned(state: DataFrame, books: Codebooks, moved: np.ndarray | None) -> DataFrame:
    """One pass over the rows, no shuffle: all columns as they are, code and far brought up to date."""
    parts, n, size = books.entries.shape
    entries = books.entries
    which = np.ones((parts, n), bool) if moved is None else moved

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                x = matrix(part["v"], parts * size).astype(np.int64)
                if moved is None:
                    code, far = np.full((len(x), parts), -1, np.int64), np.zeros((len(x), parts), np.int64)
                else:
                    code, far = matrix(part["code"], parts).astype(np.int64), matrix(part["far"], parts).astype(np.int64)
                for p in range(parts):
                    mine, gap = code[:, p].copy(), far[:, p].copy()
                    assign(x[:, p * size : (p + 1) * size], entries[p], mine, gap, which[p])
                    code[:, p], far[:, p] = mine, gap
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"], part["label"], part["v"], lists(code, pa.int32()), lists(far, pa.int64())], names
                )

    names = ["vec_id", "label", "v", "code", "far"]
    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.select("vec_id", "label", "v", *[c for c in ("code", "far") if moved is not None]).mapInArrow(
        batches, f"vec_id {kinds['vec_id']}, label {kinds['label']}, v array<bigint>, code array<int>, far array<bigint>"
    )


def _replaced(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floored mean of its parts; unused ones stay. Tasks hand on one line an entry that they met."""
    parts, n, size = books.entries.shape

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * n, size), object), np.zeros(parts * n, np.int64)
        for batch in given:
            x, code = matrix(batch["v"], parts * size).astype(np.int64), matrix(batch["code"], parts).astype(np.int64)
            for p in range(parts):
                at = slice(p * n, (p + 1) * n)
                add_groups(total[at], count[at], code[:, p], x[:, p * size : (p + 1) * size])
        if count.any():
            yield sum_rows(((g, count[g], total[g]) for g in np.nonzero(count)[0]), size)

    entries = books.entries.copy()
    for g, (many, sums) in summed(state.select("v", "code").mapInArrow(batches, sum_schema(size)), size).items():
        entries[g // n, g % n] = [s // many for s in sums]
    return Codebooks(entries)


def compress_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all vectors and the codebooks that decode them: vec_id, label, code array<int>, far array<bigint> (a squared distance a part).

    Components x become floor(1024 * x). The codebook of each of `parts` equal consecutive parts starts as that part of the `entries`
    vectors with the smallest ids; `rounds` times every part goes to its nearest entry and every used entry to the floored mean of its
    parts; then parts are assigned once more. Ties go to the lower index. All arithmetic is exact.

    Rows whose vector is null or has a null or non-finite component are left out. The width is that of the smallest id whose vector can be
    cut into equal parts; vectors of another width keep their row with null code and far. Repeated rows and ids each count and
    each get a row; equal ids start the codebooks in the order of their vectors, null ids after the others. With fewer vectors than entries
    the codebooks are smaller; without any the result is empty and the codebooks None. Other columns are not looked at.

    Rows with codes and distances are one table in the shared folder that every round replaces, so no vector is shuffled and a lost executor costs
    one pass; what tasks hand on is one line an entry. The codebooks (parts x entries) are the only thing on the driver.
    """
    spark = vectors.sparkSession
    rows = _kept(vectors, vec_id, vector, label)
    books = first_codebooks(rows, parts, entries)
    nothing = F.lit(None)
    if books is None:
        bare = rows.select("vec_id", "label", nothing.cast("array<int>").alias("code"), nothing.cast("array<bigint>").alias("far"))
        return bare, None
    fits = F.size("v") == books.width
    state, path = stored_at(_assigned(rows.where(fits), books, None), "codes")
    for _ in range(rounds):
        after = _replaced(state, books)
        moved = (after.entries != books.entries).any(2)
        books = after
        if not moved.any():
            break  # nothing moves any more: further rounds would change nothing
        state, old = stored_at(_assigned(state, books, moved), "codes"), path
        state, path = state
        discard(spark, old)
    odd = rows.where(~fits).select("vec_id", "label", nothing.cast("array<int>").alias("code"), nothing.cast("array<bigint>").alias("far"))
    return state.select("vec_id", "label", "code", "far").unionByName(odd), books


def codes_with_digests(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: codes as two hexadecimal digits a part, errors summed over parts and over equal labels."""
    coded, books = compress_vectors(vectors)
    digest = hashlib.sha256(books.text().encode()).hexdigest() if books else ""
    hexed = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    rows = coded.select(
        "vec_id", "label", F.array_join(hexed, "").alias("code"), F.aggregate("far", F.lit(0).cast("bigint"), lambda t, v: t + v).alias("error")
    )
    by_label = rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"), F.count("*").alias("many")
    )
    done = lookup(rows, State.of(by_label, "many"), {"label": "label"}, {"label_error": "label_error"})
    return done.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL, every round written out, all entries compared every time."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cells AS MATERIALIZED (SELECT rid, (d - 1) * {parts} // n AS p, d, x FROM (
            SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS d, len(v) AS n FROM kept))""",
        f"m0 AS MATERIALIZED (SELECT rid - 1 AS e, p, d, x FROM cells WHERE rid <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, arg_min(e, (far, e)) AS e, min(far) AS far FROM (
            SELECT c.rid, c.p, m.e, sum((c.x - m.x) * (c.x - m.x)) AS far FROM cells c JOIN m{r} m ON c.d = m.d GROUP BY c.rid, c.p, m.e) GROUP BY rid, p)""")
        if r < rounds:
            steps.append(f"""u{r} AS (SELECT a.e, c.p, c.d, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n
                FROM cells c JOIN a{r} a ON a.rid = c.rid AND a.p = c.p GROUP BY a.e, c.p, c.d)""")
            steps.append(f"""m{r + 1} AS MATERIALIZED (SELECT m.e, m.p, m.d, coalesce((u.s - ((u.s % u.n) + u.n) % u.n) // u.n, m.x) AS x
                FROM m{r} m LEFT JOIN u{r} u ON u.e = m.e AND u.d = m.d)""")
    last = rounds
    return f"""WITH {", ".join(steps)},
        book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, d)) AS sha FROM m{last}),
        coded AS (SELECT rid, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{last} GROUP BY rid)
        SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, sha AS codebooks_sha256
        FROM kept k JOIN coded USING (rid) CROSS JOIN book"""
