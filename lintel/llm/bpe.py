"""Byte-pair encoding with word ends: merges from a priority queue over a linked list of symbols; decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import whole_text

KEPT_WORDS = 400_000
LONG_WORD = 64
#: Marks that end words and never join letters or digits in a piece.
STOPS = ".,;:!?"
#: Below this character the libraries' notions of letter and digit are the same.
PLAIN = "\u0250"
#: White space for Python's split, but not for the vocabulary's patterns.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD = regex.compile(r"[^\p{White_Space}]+")


class _Words(dict):
    """Word -> its ids; filled on demand, emptied when full."""

    def __init__(self, owner: Bpe, most: int):
        super().__init__()
        self.owner, self.most = owner, most

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(STOPS)
        if stem and stem != word and stem[-1] < PLAIN and stem[-1].isalnum():
            return self[stem] + self[word[len(stem) :]]
        out = self.owner.word(word)
        if len(word) <= LONG_WORD:
            if len(self) >= self.most:
                self.clear()
            self[word] = out
        return out


class Bpe:
    """Encoder and decoder of one vocabulary file with merges, lower case, NFC and an end-of-word suffix."""

    def __init__(self, path: str, most: int = KEPT_WORDS):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model = made["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks: dict[tuple[str, str], int] = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.shown = [self.strings.get(i) for i in range(max(self.strings) + 1)]
        cuts = [p["pattern"]["Regex"] for p in made["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.cut = regex.compile(cuts[0])
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(moved)}
        self.words = _Words(self, most)

    def merge(self, symbols: list[str]) -> list[str]:
        """Apply the lowest-ranked merge, leftmost first, until none is left.

        Symbols form a doubly linked list; the queue holds (rank, place, left, right). An entry whose symbols
        have changed since it was put in is stale and skipped.
        """
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive: list[str | None] = list(symbols)
        ranks = self.ranks
        queue = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, at, left, right = heapq.heappop(queue)
            then = after[at] if alive[at] == left else n
            if then >= n or alive[then] != right:
                continue
            alive[at], alive[then] = left + right, None
            after[at] = beyond = after[then]
            if beyond < n:
                before[beyond] = at
                if (pair := (alive[at], alive[beyond])) in ranks:
                    heapq.heappush(queue, (ranks[pair], at, *pair))
            if (ahead := before[at]) >= 0 and (pair := (alive[ahead], alive[at])) in ranks:
                heapq.heappush(queue, (ranks[pair], ahead, *pair))
        return [s for s in alive if s is not None]

    def word(self, word: str) -> bytes:
        """Ids of a normalised stretch without white space."""
        found: list[str] = []
        for piece in self.cut.findall(word):
            letters = [self.alphabet[b] for b in piece.encode("utf-8", "replace")]
            letters[-1] += self.end
            found += self.merge(letters)
        return np.array([self.ids[s] for s in found], "<u4").tobytes()

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit numbers, and the text in UTF-8 that these ids decode to."""
        got: list[bytes] = []
        for stretch in self.marks.split(text) if self.marks and "<" in text else [text]:
            if stretch in self.special:
                got.append(self.special[stretch].to_bytes(4, "little"))
                continue
            if not unicodedata.is_normalized("NFC", stretch):
                stretch = unicodedata.normalize("NFC", stretch)
            # A sigma keeps its form at the end of a word, as letters are lowered one by one.
            stretch = stretch.replace("Σ", "σ").lower()
            words = stretch.split() if SEPARATORS.search(stretch) is None else WORD.findall(stretch)
            got += map(self.words.__getitem__, words)
        ids = b"".join(got)
        return ids, self.decode(np.frombuffer(ids, "<u4").tolist()).encode()

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings, a space between them, as a tokenizer without a decoder gives."""
        return " ".join(map(self.shown.__getitem__, ids))


_made: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """One encoder a worker process and file."""
    if path not in _made:
        _made[path] = Bpe(path)
    return _made[path]


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    Whole texts are normalised, cut and merged as the vocabulary file says; strings of its special tokens in a text
    give their ids. Digests are of the ids as little-endian 32-bit numbers and of the decoded text in UTF-8. Null text
    counts as empty and has no ids; repeated rows each get a row; other columns are not looked at. No shuffle:
    a task holds one batch and a bounded store of words.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary)
        for batch in given:
            done = [coder.encode(t) for t in batch["text"].to_pylist()]
            out = [
                batch["doc_id"], pa.array([len(i) // 4 for i, _ in done], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i, _ in done]), pa.array([hashlib.sha256(d).hexdigest() for _, d in done]),
            ]
            if with_ids:
                out.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in done], pa.list_(pa.int32())))
                out.append(pa.array([d.decode() for _, d in done]))
            yield pa.RecordBatch.from_arrays(out, names)

    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    names = [k.split()[0] for k in kinds.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(batches, kinds)
