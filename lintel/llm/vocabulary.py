"""Ids of whole texts through the tokenizers library, each distinct word encoded once a worker."""

from __future__ import annotations

import json
import os
import struct

KEPT_WORDS = 500_000
LONG_WORD = 64
#: Marks that end words and never join letters or digits in a piece.
STOPS = ".,;:!?"
#: Below this character Python's and the library's notions of letter and digit are the same.
PLAIN = "\u0250"


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Word (without the one space or line feed before it) -> its ids as bytes; filled on demand, emptied when full."""

    def __init__(self, owner: TextEncoder, before: str, most: int):
        super().__init__()
        self.owner, self.before, self.most = owner, before, most

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(STOPS)
        if stem and stem != word and stem[-1] < PLAIN and stem[-1].isalnum():
            return self[stem] + self.owner.stops[word[len(stem) :]]
        if not word or word[0].isspace() or word[-1].isspace():
            raise ValueError("white space next to white space")
        if "\n" in word:
            lines = word.split("\n")
            return self[lines[0]] + b"".join(map(self.owner.lines.__getitem__, lines[1:]))
        ids = self.owner.piece(self.before, word)
        if len(word) <= LONG_WORD:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class _Stops(dict):
    """A run of stops -> its ids."""

    def __init__(self, owner: TextEncoder):
        super().__init__()
        self.owner = owner

    def __missing__(self, run: str) -> bytes:
        ids = self.owner.whole(run)
        if len(run) <= 4:
            self[run] = ids
        return ids


class TextEncoder:
    """encode(text) gives the library's ids of the whole text as little-endian bytes of self.dtype.

    Byte-level tokenizers cut texts before merging, and a single space before a visible character always
    starts a new piece. So a text may be encoded word by word, and words recur. Where a space has other white space
    beside it, or for a tokenizer of another make, the library gets the whole text. Special tokens' strings in a text
    are recognised as the library does by default.
    """

    def __init__(self, path: str, most: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        cut = made.get("pre_tokenizer") or {}
        self.by_word = (
            made.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in made.get("added_tokens", []))
        )
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        self.model = self.library.model
        self.pack = {n: struct.Struct(f"<{n}{'H' if self.dtype == '<u2' else 'I'}").pack for n in range(1, 9)}
        self.words, self.lines = _Words(self, " ", most), _Words(self, "\n", most // 8)
        self.stops = _Stops(self)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in shown]
        #: The byte-level alphabet: visible bytes stand for themselves, the others for characters from 256 on.
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(moved)}
        self.opening = {" ": (self.alphabet[32], b""), "\n": ("", self.whole("\n") if self.by_word else b"")}

    def packed(self, ids: list[int]) -> bytes:
        if len(ids) in self.pack:
            return self.pack[len(ids)](*ids)
        return struct.pack(f"<{len(ids)}{'H' if self.dtype == '<u2' else 'I'}", *ids)

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def piece(self, before: str, word: str) -> bytes:
        """Ids of the word after a space or line feed; a word of letters goes straight to the library's merges."""
        if len(word) > LONG_WORD or not word.isalpha() or max(word) >= PLAIN:
            return self.whole(before + word)
        mark, ids = self.opening[before]
        shown = word if word.isascii() else "".join(map(self.alphabet.__getitem__, word.encode()))
        return ids + self.packed([t.id for t in self.model.tokenize(mark + shown)])

    def encode(self, text: str) -> bytes:
        if not self.by_word or " " not in text:
            return self.whole(text) if text else b""
        first, *rest = text.split(" ")
        if first and first[-1].isspace():
            return self.whole(text)
        last = rest.pop() if not rest[-1] else None
        try:
            got = b"".join(map(self.words.__getitem__, rest))
        except ValueError:
            return self.whole(text)
        # A space at the very end is a piece of its own.
        return (self.whole(first) if first else b"") + got + (b"" if last is None else self.whole(" "))


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder a worker process and file."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]
