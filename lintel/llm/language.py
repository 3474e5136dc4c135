"""Language by string kernels: blended-spectrum presence kernels, Nyström landmarks, one-versus-rest ridge regression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lintel.llm.common import whole_text
from lintel.llm.quality import held_out

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Settings:
    """Bounds of what is fitted on: rows and landmarks a language, languages, rows of all languages, characters of a sampled row, letters told
    apart; longest n-gram and ridge penalty. Predictions are for whole texts.
    """

    rows: int = 300
    languages: int = 256
    all_rows: int = 30_000
    landmarks: int = 32
    row_chars: int = 8192
    letters: int = 94
    longest: int = 3
    ridge: float = 1e-2


@dataclass
class LanguageModel:
    classes: list[str] = field(default_factory=list)
    letters: str = ""
    longest: int = 3
    columns: np.ndarray | None = None  #: code of an n-gram -> row of presence, or -1
    presence: np.ndarray | None = None  #: n-grams by landmarks, over the root of the landmark's number of n-grams
    weights: np.ndarray | None = None  #: landmarks by classes


class Grams:
    """Sets of n-grams of texts over an alphabet: 0 is all that is no letter, 1 any other letter."""

    def __init__(self, letters: str, longest: int):
        self.base = len(letters) + 2
        self.table = np.ones(0x110000, np.uint8)
        for c in range(0x250):
            self.table[c] = LETTER.match(chr(c)) is not None
        self.table[0x2000:0x2070] = self.table[0x3000:0x3021] = self.table[0x1F000:0x1FB00] = 0
        for i, c in enumerate(letters):
            self.table[ord(c)] = i + 2
        self.longest = longest
        self.size = sum(self.base**n for n in range(1, longest + 1))
        self.seen = np.zeros(self.size, np.int64)

    def codes(self, text: str) -> np.ndarray:
        """The codes of the distinct n-grams of the text, of all lengths."""
        chars = self.table[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
        # A run of non-letters is one boundary.
        chars = chars[np.concatenate(([True], (chars[1:] != 0) | (chars[:-1] != 0)))] if len(chars) else chars
        parts, offset, grams = [], 0, np.zeros(len(chars), np.int64)
        for n in range(1, self.longest + 1):
            if len(chars) < n:
                break
            grams = grams[: len(chars) - n + 1] * self.base + chars[n - 1 :]
            parts.append(grams + offset)
            offset += self.base**n
        if not parts:
            return np.empty(0, np.int64)
        every = np.concatenate(parts)
        # The last place at which a code was written is one place for each code: no sort, nothing to clear.
        at = np.arange(len(every))
        self.seen[every] = at
        return every[self.seen[every] == at]


def kernel_rows(model: LanguageModel, grams: Grams, texts: list[str]) -> np.ndarray:
    """Normalised presence kernels of texts with the landmarks: common n-grams over the root of both numbers."""
    x = np.zeros((len(texts), len(model.presence)), np.float32)
    sizes = np.ones(len(texts), np.float32)
    for i, text in enumerate(texts):
        codes = grams.codes(text)
        columns = model.columns[codes]
        x[i, columns[columns >= 0]] = 1
        sizes[i] = max(1, len(codes))
    return (x @ model.presence) / np.sqrt(sizes)[:, None]


def fit_language(docs: DataFrame, settings: Settings | None = None) -> LanguageModel:
    """Learn from text and non-null lang of the documents whose crc32(doc_id) mod 5 is not 0.

    Of every language up to `rows` different texts with a letter are taken, in the order of a hash of the text, the first `landmarks` of
    them as landmarks. Languages, and which texts of them, are found from hashes alone, on which repeated texts are one, so
    neither copies nor common languages push others out; then one text for each hash, cut to row_chars, comes to the driver. A model has a
    column for each language, so `languages` bounds them: those with most different texts are learnt.
    """
    settings = settings or Settings()
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 5, 0)).select("lang", whole_text().alias("text"))
    hashed = rows.where(F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("text").alias("h"))
    different = hashed.distinct()
    counts = {r.lang: r["count"] for r in different.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.languages).collect()}
    sampled: list[tuple[str, str]] = []
    if counts:
        most = min(settings.rows, settings.all_rows // len(counts))
        # A share of each language that holds enough texts almost surely; the hash then says which of them are taken.
        told = [(k, min(1.0, 4 * (most + 10) / n)) for k, n in counts.items()]
        rate = F.broadcast(docs.sparkSession.createDataFrame(told, "lang string, rate double"))  # at most `languages` rows
        thin = different.join(rate, "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("rate") * (1 << 20))
        place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))  # a few times `rows` a language
        chosen = thin.withColumn("place", place).where(F.col("place") <= most).select("lang", "h", "place")
        texts = rows.select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, settings.row_chars).alias("text"))
        found = texts.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "place").agg(F.min("text").alias("text"))  # at most all_rows rows
        sampled = [(r.lang, r.text) for r in found.orderBy("place", "lang").collect()]
    if not sampled:
        return LanguageModel()
    classes = sorted({lang for lang, _ in sampled})
    letters = Counter(c for _, t in sampled for c in t.lower() if LETTER.match(c))
    alphabet = "".join(sorted(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[: settings.letters]))
    model = LanguageModel(classes, alphabet, settings.longest)
    grams = Grams(alphabet, settings.longest)
    taken, marks = Counter(), []
    for lang, text in sampled:
        taken[lang] += 1
        if taken[lang] <= settings.landmarks:
            marks.append(grams.codes(text))
    codes = np.unique(np.concatenate(marks))
    model.columns = np.full(grams.size, -1, np.int32)
    model.columns[codes] = np.arange(len(codes))
    model.presence = np.zeros((len(codes), len(marks)), np.float32)
    for j, mark in enumerate(marks):
        model.presence[model.columns[mark], j] = 1 / np.sqrt(max(1, len(mark)))
    between = model.presence.T.astype(float) @ model.presence
    values, vectors = np.linalg.eigh(between)
    root = vectors @ np.diag(np.where(values > 1e-8, 1 / np.sqrt(np.maximum(values, 1e-8)), 0)) @ vectors.T
    mapped = kernel_rows(model, grams, [t for _, t in sampled]).astype(float) @ root
    target = np.where(np.array([lang for lang, _ in sampled])[:, None] == np.array(classes)[None, :], 1.0, -1.0)
    ridge = np.linalg.solve(mapped.T @ mapped + settings.ridge * len(mapped) / len(marks) * np.eye(len(marks)), mapped.T @ target)
    model.weights = (root @ ridge).astype(np.float32)
    return model


def predict(model: LanguageModel, grams: Grams, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of texts; the score maps a regression value from -1 to 1 onto 0 to 1."""
    values = kernel_rows(model, grams, texts) @ model.weights
    best = values.argmax(1)
    held = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1)
    said = [LETTER.search(t) is not None for t in texts]
    return [model.classes[b] if s else UNKNOWN for b, s in zip(best, said, strict=True)], [float(h) if s else 0.0 for h, s in zip(held, said, strict=True)]


#: Texts of one matrix product: some 10 MB of presences.
BATCH = 256


def identify_language(docs: DataFrame, settings: Settings | None = None, model: LanguageModel | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    lang_pred is a learned language, or und (score 0) where text is null or has no letter, or where nothing could be learned.
    Whole texts are scored, in batches: presences of n-grams times landmarks times weights. Null ids
    are not held out; repeated rows each get a row; other columns are not looked at. No shuffle of texts.
    """
    model = model or fit_language(docs, settings)
    names = ["doc_id", "held_out", "lang_pred", "score"]
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), whole_text().alias("text"))
    if not model.classes:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(model.letters, model.longest)
        for batch in given:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                langs, held = predict(model, grams, part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(langs, pa.string()), pa.array(held, pa.float64())], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
