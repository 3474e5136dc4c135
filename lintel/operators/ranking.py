"""Orders that do not depend on partitioning: md5 order for splits, key order for numbering.

A window over a handful of classes would be a handful of giant partitions. Ranks are found from
counts of hash prefixes instead, so that only rows of one small bucket are ever sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lintel.operators.state import State, lookup
from lintel.session import cut, keep

HEX = "0123456789abcdef"
#: Stands for all keys that share a hash.
EVERY = object()
BUCKET_ROWS = 100_000
SPLIT_ROWS = 100_000


def md5_of(seed: int, key: str) -> Column:
    """Hash of seed and key; a null key counts as an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))


def with_row_number(df: DataFrame, name: str = "__row") -> DataFrame:
    """df written out once with a number for each row, so that a table can be joined with itself whatever its keys are."""
    return cut(df.withColumn(name, F.monotonically_increasing_id()))


def exact_rank(
    df: DataFrame, by: list[str], order: Column, key: str, name: str = "rank", digits: int | None = None, tie: str | None = None
) -> DataFrame:
    """1-based rank of each row within `by`, in ascending (order, key, tie); `order` is a hex text.

    Rows are bucketed by the first hex digits of `order`. Bucket sizes, summed up, give each
    bucket its first rank; rows are ranked within their bucket. The digits grow with the table,
    so that a bucket stays near BUCKET_ROWS rows however large a class is.
    """
    hashed = df.withColumn("__h", order)
    if digits is None:
        digits = prefix_digits(df.count())
    bucketed = hashed.withColumn("__b", F.substring("__h", 1, digits))
    sizes = bucketed.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    starts = _starts(sizes, by, digits)
    # a broadcast join while the buckets are few; then the window is the only shuffle of the rows
    ranked = lookup(bucketed, State.of(starts), {**{b: b for b in by}, "__b": "__b"})
    within = F.row_number().over(W.partitionBy(*by, "__b").orderBy("__h", key, *([tie] if tie else [])))
    return ranked.withColumn(name, F.col("__start") + within).drop("__h", "__b", "__start")


def prefix_digits(rows: int) -> int:
    digits = 2
    while rows > BUCKET_ROWS * 16**digits and digits < 10:
        digits += 1
    return digits


def _starts(sizes: DataFrame, by: list[str], digits: int) -> DataFrame:
    """Rows before each bucket. Sums run over at most 16**3 entries a window, level by level."""
    if digits <= 3:
        before = F.sum("__n").over(W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, -1))
        return sizes.select(*by, "__b", F.coalesce(before, F.lit(0)).alias("__start"))
    head = F.substring("__b", 1, digits - 3).alias("__p")
    tops = sizes.groupBy(*by, head).agg(F.sum("__n").alias("__n")).withColumnRenamed("__p", "__b")
    top_starts = _starts(tops, by, digits - 3).withColumnsRenamed({"__b": "__p", "__start": "__base"})
    inner = sizes.withColumn("__p", F.substring("__b", 1, digits - 3))
    before = F.sum("__n").over(
        W.partitionBy(*by, "__p").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    )
    return inner.withColumn("__in", F.coalesce(before, F.lit(0))).join(top_starts, [*by, "__p"]).select(
        *by, "__b", (F.col("__base") + F.col("__in")).alias("__start")
    )


def split_thresholds(
    df: DataFrame, label: str, key: str, share: float, seed: int, most: int = SPLIT_ROWS
) -> dict[object, tuple[str, object] | None]:
    """Per class the last (md5, key) that belongs to the first floor(n * share) rows.

    Narrowed by hash prefix: each pass counts one more block of digits among the rows that share
    the boundary prefix, until few rows are left to sort. Only counts reach the driver. Where many rows share the boundary's
    whole hash, and so their key, the key is EVERY: all of them belong.
    """
    hashed = df.select(label, F.col(key).alias("k"), md5_of(seed, key).alias("h"))
    sizes = {r[label]: r["n"] for r in hashed.groupBy(label).agg(F.count("*").alias("n")).collect()}
    left = {y: int(n * share) for y, n in sizes.items()}
    found: dict[object, tuple[str, object] | None] = {y: None for y, t in left.items() if t == 0}
    prefix = {y: "" for y in sizes if y not in found}
    pool = dict(sizes)
    while prefix:
        near = _within(hashed, label, prefix)
        small = {y for y in prefix if pool[y] <= most}
        if small:
            rows = near.where(_is_in(label, small))
            rank = F.row_number().over(W.partitionBy(label).orderBy("h", "k"))
            wanted = F.lit(None).cast("boolean")
            for y in small:
                wanted = F.when(_same(label, y), F.col("r") == left[y]).otherwise(wanted)
            for r in rows.withColumn("r", rank).where(wanted).collect():
                found[r[label]] = (r.h, r.k)
            prefix = {y: p for y, p in prefix.items() if y not in small}
            if not prefix:
                break
            near = _within(hashed, label, prefix)
        whole = {y: p for y, p in prefix.items() if len(p) == 32}  # one key that holds more than `most` rows
        found.update({y: (p, EVERY) for y, p in whole.items()})
        prefix = {y: p for y, p in prefix.items() if y not in whole}
        if not prefix:
            break
        near = _within(hashed, label, prefix)
        depth = min(32, max(map(len, prefix.values())) + 3)
        counts = near.groupBy(label, F.substring("h", 1, depth).alias("p")).agg(F.count("*").alias("n"))
        per_class: dict[object, list[tuple[str, int]]] = {}
        for r in counts.collect():  # at most 16**3 rows a class
            per_class.setdefault(r[label], []).append((r.p, r.n))
        for y, entries in per_class.items():
            for p, n in sorted(entries):
                if left[y] <= n:
                    prefix[y], pool[y] = p, n
                    break
                left[y] -= n
    return found


def _same(label: str, y: object) -> Column:
    return F.col(label).eqNullSafe(F.lit(y))


def _is_in(label: str, classes: set) -> Column:
    test = F.lit(False)
    for y in classes:
        test = test | _same(label, y)
    return test


def _within(hashed: DataFrame, label: str, prefix: dict[object, str]) -> DataFrame:
    test = F.lit(False)
    for y, p in prefix.items():
        test = test | (_same(label, y) & F.col("h").startswith(p))
    return hashed.where(test)


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42, name: str = "is_valid"
) -> DataFrame:
    """Mark floor(n * test_size) rows of each class, first in md5 order, as validation rows.

    The mark is a comparison with one threshold per class: the table itself is not shuffled. Rows of one class that share a
    key, a null one included, stay together, so a part can be larger by the rows that share the boundary's key. No mark is null.
    """
    mark = F.lit(False)
    for y, last in split_thresholds(df, label, key, test_size, seed).items():
        if last is not None:
            h, k = last
            upto = F.lit(True) if k is EVERY else F.col(key).isNull() if k is None else F.coalesce(F.col(key) <= F.lit(k), F.lit(True))
            first = (F.col("__h") < h) | ((F.col("__h") == h) & upto)
            mark = F.when(_same(label, y), first).otherwise(mark)
    return df.withColumn("__h", md5_of(seed, key)).withColumn(name, mark.cast("int")).drop("__h")


def stratified_folds(
    df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Fold 0..k-1 per row, class shares equal: rank in md5 order within the class, mod k."""
    ranked = exact_rank(df, [label], md5_of(seed, key), key, "__rank")
    return ranked.withColumn(name, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def fold_rows(df: DataFrame, fold: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of one fold."""
    return df.where(F.col(name) != fold), df.where(F.col(name) == fold)


def dense_position(df: DataFrame, key: str, name: str = "Id") -> DataFrame:
    """0-based position in ascending key order, by range partitions plus partition offsets."""
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    # upper bits: partition, lower 33 bits: row within it; written out so both uses agree
    fixed = cut(ordered.withColumn("__m", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__m", 33)
    sizes = fixed.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    offset, offsets = 0, []
    for r in sorted(sizes.collect()):  # one row per partition
        offsets.append((r["__p"], offset))
        offset += r["__n"]
    spark = df.sparkSession
    table = State.of(spark.createDataFrame(offsets, "__p long, __start long"))
    numbered = lookup(fixed.withColumn("__q", part), table, {"__q": "__p"})
    place = F.col("__start") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(name, place).drop("__m", "__q", "__start")


def seats(df: DataFrame, key: str, digits: int | None = None, row: str = "__row") -> DataFrame:
    """Place of each row (row number and __i) in an order that has nothing to do with the values of its key."""
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return exact_rank(df.select(row, key), [], order, key, "__i", digits, row).select(row, "__i")


def seated_rows(df: DataFrame, key: str, digits: int | None = None) -> DataFrame:
    """df with a row number (__row) and the row's place by `seats` (__i), written as columns: of a table that is permuted many times each scan
    then reads what it needs.
    """
    rows = keep(df.withColumn("__row", F.monotonically_increasing_id()))
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return keep(exact_rank(rows, [], order, key, "__i", digits, "__row"))


def permuted_rows(
    df: DataFrame, columns: list[str], key: str, seed: int, places: DataFrame | None = None, digits: int | None = None
) -> DataFrame:
    """df with columns dealt out anew beside the own ones, as __p_<column>: the row at place i by `seats` gets the row at place i by md5.

    One rank and two joins serve all columns. Rows are told apart by a row number, which `with_row_number` writes unless df has one (column
    __row, which then stays): null and repeated keys neither lose nor multiply rows, and their rows are in the order of that number. `places` and
    `digits` save work when one table is permuted many times; rows by `seated_rows` have their places with them and take a single join.
    """
    numbered = "__row" in df.columns
    rows = df if numbered else with_row_number(df)
    dealt = rows.select(key, "__row", *[F.col(c).alias(f"__p_{c}") for c in columns])
    values = exact_rank(dealt, [], md5_of(seed, key), key, "__i", digits, "__row").drop(key, "__row")
    if "__i" in df.columns:
        # what is done with each row later costs more than to move it: it is not left to as few tasks as the moved bytes alone would get
        n = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return rows.repartition(n, "__i").join(values.repartition(n, "__i"), "__i")
    places = seats(rows, key, digits) if places is None else places
    done = rows.join(places.join(values, "__i").drop("__i"), "__row")
    return done if numbered else done.drop("__row")
