"""Token files, packing and byte-pair encoding against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import awkward, documents, empty

from lintel.llm import idfile, packing
from lintel.llm.bpe import Bpe, encode_documents
from lintel.llm.common import shared_path
from lintel.llm.vocabulary import TextEncoder, default_path

BYTES, WORDS = default_path("byte_bpe_50k.json"), default_path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "a\nb c", "x <|endoftext|> y", "<|endoftext|>", "it's 's   x", "漢字 🙂 x　 y",
    "a\x1c b", "\n", "a \t", "é́ ' s", "l' été", "x.\nDe La", "x. \nDe", "a\n\nb c", "x.,\ny a.\n", " é.\né.", "İ Σ ΑΣ ß", "\x85a",
]


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def noise(letters, n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_encoder_gives_the_library_s_ids():
    made = TextEncoder(BYTES, most=50)
    for text in ODD + noise(" \n\tab'sé1!.,<漢 \x1f", 4000):
        assert np.frombuffer(made.encode(text), made.dtype).tolist() == made.library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_gives_the_library_s_ids_and_text():
    own, other = Bpe(WORDS, most=50), library(WORDS)
    for text in ODD + noise(" \n\tab'sé1!.,<漢\x1fΣİ́²", 4000):
        want = other.encode(text, add_special_tokens=False).ids
        ids, shown = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert shown.decode() == other.decode(want, skip_special_tokens=False) == own.decode(want)


def test_bpe_text_is_decoded_from_the_ids():
    own = Bpe(WORDS)
    one, other = own.encode("one")[0], own.encode("other")[0]
    own.words["one"] = other
    ids, shown = own.encode("one one.")
    assert one != other and ids.startswith(other + other)
    assert shown.decode() == own.decode(np.frombuffer(ids, "<u4").tolist())


@pytest.mark.parametrize("top", [1, 255, 256, 65535, 65536, 2**24, 2**32 - 1])
def test_packed_values_come_back(top):
    values = np.random.default_rng(3).integers(0, top, 1001, endpoint=True).astype(np.uint32)
    for n in (0, 1, 3, 4, 1001):
        control, data = idfile.pack(values[:n])
        assert len(control) == (n + 3) // 4 and (idfile.unpack(control, data, n) == values[:n]).all()


def file_brute(rows, end):
    made, out, start = library(BYTES), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(made.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_file_of_all_documents(spark):
    docs = documents(spark)
    got = idfile.through_file(docs, BYTES).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == file_brute([(r.doc_id, r.text) for r in docs.collect()], 0)


def test_file_of_awkward_rows(spark):
    docs = awkward(spark, "ids", "start", "key", "shard")
    path = shared_path(spark, "file")
    idfile.write_ids(docs, path, BYTES, end=7)
    got = idfile.read_ids(spark, path).collect()
    assert len(got) == docs.count() and all(r.ids[-1] == 7 and len(r.ids) == r.n_tokens for r in got)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted([r.doc_id for r in got if r.doc_id is not None]) + [None, None]
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True) and sum(r.n for r in ranks) == sum(r.n_tokens for r in got)
    assert idfile.through_file(empty(spark), BYTES, with_ids=True).count() == 0


def check_packing(rows, room):
    by_doc, by_bin = {}, {}
    for r in rows:
        by_bin.setdefault(r.sequence_id, []).append(r)
    for members in by_bin.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= room
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    return by_doc, by_bin


def test_packing_all_documents(spark):
    docs = documents(spark)
    rows = packing.pack_documents(docs, BYTES).collect()
    by_doc, by_bin = check_packing(rows, 1024)
    made = library(BYTES)
    total = 0
    for r in docs.collect():
        ids = made.encode(r.text or "", add_special_tokens=False).ids + [2]
        parts = sorted(by_doc.pop(r.doc_id), key=lambda p: p.piece)
        assert sum((list(p.ids) for p in parts), []) == ids and [p.piece for p in parts] == list(range(len(parts)))
        assert all(p.length == 1024 for p in parts[1:]) and [p.start for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in parts)
        total += len(ids)
    assert not by_doc and len(by_bin) <= 1.03 * -(-total // 1024) + 1


def test_packing_awkward_rows(spark):
    docs = awkward(spark, "item", "bin", "size", "ids")
    rows = packing.pack_documents(docs, BYTES, room=64).collect()
    check_packing(rows, 64)
    assert sum(r.piece == 0 for r in rows) == docs.count()
    assert sum(r.length == 1 for r in rows if r.piece == 0) >= 3
    assert packing.pack_documents(empty(spark), BYTES).count() == 0


def test_packing_in_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ITEMS", 40)
    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    rows = packing.place(items, 100).collect()
    assert sorted(r["item"] for r in rows) == list(range(3000))
    bins = {}
    for r in rows:
        bins.setdefault(r.bin, []).append((r.base, sizes[r["item"]]))
    for members in bins.values():
        at = 0
        for base, size in sorted(members):
            assert base == at
            at += size
        assert at <= 100
    assert len(bins) < 1.1 * sum(sizes) / 100


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 3, 5]), 10)
    assert sorted(fills.tolist()) == [3, 10, 10] and bins[1] == bins[4] and bins[0] == bins[2]


def test_bpe_query_digests(spark):
    docs = awkward(spark, "ids", "n_tokens")
    other = library(WORDS)
    got = encode_documents(docs, WORDS).collect()
    want = []
    for r in docs.collect():
        ids = other.encode(r.text or "", add_special_tokens=False).ids
        text = other.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted([tuple(r)[:4] for r in got], key=str) == sorted(want, key=str)
    assert all(hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 and len(r.ids) == r.n_tokens for r in got)
    assert encode_documents(empty(spark), WORDS).count() == 0
    whole = encode_documents(documents(spark), WORDS, with_ids=False).agg(F.sum("n_tokens")).first()[0]
    assert whole == sum(len(other.encode(r.text or "", add_special_tokens=False).ids) for r in documents(spark).collect())
