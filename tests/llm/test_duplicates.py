"""Exact and near duplicates and fingerprints against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from tables import awkward, docs_of, documents, empty

from lintel.llm import exact, multiset, simhash
from lintel.llm.components import components

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(BLANK.sub("", t or ""), []).append((i, t or ""))
    out = []
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        ranked = sorted(members, key=lambda m: m != keep)
        out += [(i, keep[0], len(members), at == 0, hashlib.sha256(bare.encode()).hexdigest()) for at, (i, _) in enumerate(ranked)]
    return sorted(out, key=str)


@pytest.mark.parametrize("digits", [1, 32])
def test_exact_with_and_without_collisions(spark, digits):
    for docs in (awkward(spark, "hash", "key", "kept", "copies", "__row_key"), documents(spark)):
        got = exact.exact_duplicates(docs, lambda t: F.substring(F.md5(t), 1, digits))
        have = sorted([tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)
        assert have == exact_brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_exact_drop(spark):
    docs = awkward(spark, "key")
    left = exact.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted((r.text or "" for r in left.collect()))
    assert len(kept) == len({BLANK.sub("", t) for t in kept}) == 7
    assert exact.exact_duplicates(empty(spark)).count() == 0 and exact.drop_exact_duplicates(empty(spark)).count() == 0


def test_exact_stays_native(spark):
    plan = exact.exact_duplicates(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def simhash_brute(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_brute(rows):
    prints = [simhash_brute(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def test_near_duplicates(spark):
    for docs in (awkward(spark, "fp", "key", "root", "low"), documents(spark)):
        got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted([tuple(r) for r in got], key=str) == near_brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_near_drop_keeps_one_of_each_class(spark):
    docs = awkward(spark, "key")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    classes = simhash.near_duplicates(docs).select("class_key").distinct().count()
    assert kept.count() == classes


def test_close_pairs_lose_none(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    points = set(base)
    for b in base:
        for flips in (1, 2, 3, 4, 5):
            for _ in range(4):
                x = b
                for bit in rng.sample(range(64), flips):
                    x ^= 1 << bit
                points.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    pairs = simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert len(pairs) == len(want) and {tuple(p) for p in pairs} == want


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)]
    random.Random(3).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}}


def edited_brute(rows):
    keyed = sorted(rows, key=lambda r: -r[0])
    out = {}
    for at, (i, t) in enumerate(keyed):
        after = keyed[(at + 1) % len(keyed)][1]
        k = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest())
    return out


def test_edited_fingerprints(spark):
    docs = documents(spark).withColumn("key", F.lit("clash"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = multiset.edited_fingerprints(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == edited_brute(rows) and len(got) == len(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    lines = {}
    for text, prints in by_text.items():
        lines.setdefault(next(iter(prints)), set()).add(tuple(sorted(x for x in text.split("\n") if x)))
    assert all(len(v) == 1 for v in lines.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    long = [r for r in got if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


def test_edited_fingerprints_of_awkward_rows(spark):
    docs = awkward(spark, "which", "sums", "copies", "n")
    got = multiset.edited_fingerprints(docs).collect()
    assert len(got) == docs.count()
    assert len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    one = multiset.edited_fingerprints(docs_of(spark, ["a b c d e f"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest() and one.n_chars == 11
    assert multiset.edited_fingerprints(empty(spark)).count() == 0


def test_multiset_hash_inserts_deletes_and_ignores_order(spark):
    rows = spark.createDataFrame([(1, "a line.\nother line.\nlast"), (2, "last\na line.\nother line."), (3, "other line."), (4, "a line.\nlast")], "k long, t string")
    sums = {r.k: r.sums for r in multiset.multiset_hash(rows, ["k"], "t").collect()}
    assert sums[1] == sums[2] and sums[1] != sums[3]
    frame = spark.createDataFrame([(sums[1], sums[3], sums[4])], "a array<long>, b array<long>, c array<long>")
    less, more = frame.select(multiset.added(F.col("a"), F.col("b"), -1), multiset.added(F.col("c"), F.col("b"))).first()
    assert less == sums[4] and more == sums[1]
    plan = multiset.multiset_hash(rows, ["k"], "t")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_unrelated_texts_are_told_apart(spark):
    rows = spark.createDataFrame([(i, "\n".join(f"line {i} {j}." for j in range(8))) for i in range(1200)], "k long, t string")
    sums = multiset.multiset_hash(rows, ["k"], "t").select("k", "sums")
    after = sums.select((F.col("k") - 1).alias("k"), F.col("sums").alias("other")).where("k % 2 = 0")
    found = sums.join(after, "k").select(multiset.likeness(F.col("sums"), F.col("other")).alias("near")).collect()
    # Below 0 counts as 0, which leaves half of the variance 1 / 64.
    assert len(found) == 600 and (sum(r.near**2 for r in found) / len(found)) ** 0.5 < 0.105
    assert len(multiset.edited_fingerprints(docs_of(spark, ["a b"])).first().fingerprint) == 64 * 12


def test_kept_rows_have_their_own_columns_whatever_their_names(spark):
    from lintel.llm.exact import drop_exact_duplicates
    from lintel.llm.simhash import drop_near_duplicates

    docs = docs_of(spark, ["one two three four", "one two three four", "other words are here", None]).selectExpr("*", "'mine' AS __row_key", "'too' AS __ROW_KEY_")
    for drop in (drop_exact_duplicates, drop_near_duplicates):
        got = drop(docs)
        assert got.columns == docs.columns
        assert {(r["__row_key"], r["__ROW_KEY_"]) for r in got.collect()} == {("mine", "too")}


def test_lane_sums_and_likeness_by_brute_force(spark):
    """Paragraphs by the pattern, lanes by 64-bit hashes computed apart, sums and dot products in Python integers."""
    import re

    import xxhash

    from lintel.llm import multiset

    texts = ["one line.\ntwo lines? yes. no\n\nthree", "two lines? yes. no", "", "x" * 700, "same. same. same.", "three\none line."]
    docs = docs_of(spark, texts)
    rows = {r.doc_id: r for r in multiset.edited_fingerprints(docs, lanes=8).collect()}
    piece = re.compile(multiset.PIECE.replace(r"\z", r"\Z"))

    def signed(h):
        return h - (1 << 64) if h >= 1 << 63 else h

    def of_longs(*values, seed=42):
        for v in values:
            seed = signed(xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed=seed & (2**64 - 1)))
        return seed

    def sums(text):
        total = [0] * 8
        for p in piece.findall(text):
            raw = p.encode()
            h1 = signed(xxhash.xxh64_intdigest(raw, seed=42))
            first = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed=42)
            h2 = signed(xxhash.xxh64_intdigest(raw, seed=first))
            for lane in range(8):
                seed = of_longs(h1, h2)
                whole = signed(xxhash.xxh64_intdigest((lane // 2).to_bytes(4, "little"), seed=seed & (2**64 - 1)))
                half = whole >> 32 if lane % 2 else ((whole & 0xFFFFFFFF) ^ 0x80000000) - 0x80000000
                total[lane] += half
        return total

    def likeness(a, b):
        dot = lambda x, y: float(sum(i * j for i, j in zip(x, y, strict=True)))
        if a == b:
            return 1.0
        scale = dot(a, a) + dot(b, b)
        return max(0.0, min(1.0, 2 * dot(a, b) / scale)) if scale else 0.0

    for i, text in enumerate(texts):
        after = texts[i - 1]  # descending ids, and the last after the first
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        shown = lambda s: "".join(f"{x % (1 << 48):012x}" for x in s)
        assert rows[i].fingerprint == shown(sums(text)) and rows[i].edited_fingerprint == shown(sums(edited))
        assert abs(rows[i].near_edited - likeness(sums(text), sums(edited))) < 1e-9
        assert abs(rows[i].near_next - likeness(sums(text), sums(after))) < 1e-9
        assert rows[i].n_pieces == len(piece.findall(text))
