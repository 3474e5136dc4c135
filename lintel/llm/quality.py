"""Quality by compression: zstandard dictionaries of good and of bad text, and a calibrated score."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.llm.common import fresh, whole_text

THRESHOLD = 0.7


@dataclass(frozen=True)
class Settings:
    """Bounds of what is fitted on: labelled rows a class for a dictionary, rows for calibration, characters of a
    dictionary row, bytes of a dictionary, length of a training sample. Scores are of whole texts.
    """

    dictionary_rows: int = 2000
    calibration_rows: int = 4000
    row_chars: int = 4096
    dictionary_bytes: int = 1 << 16
    sample_bytes: int = 1024
    level: int = 3
    ridge: float = 1.0


@dataclass
class QualityModel:
    """Two dictionaries, and a logistic calibration of what they tell; constant is the score where one class is unknown."""

    good: bytes = b""
    bad: bytes = b""
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float | None = None
    level: int = 3

    def open(self) -> list[zstandard.ZstdCompressor]:
        made = [zstandard.ZstdCompressionDict(d) for d in (self.good, self.bad)]
        plain = {"level": self.level, "write_content_size": False, "write_dict_id": False}
        return [zstandard.ZstdCompressor(dict_data=d, **plain) for d in made] + [zstandard.ZstdCompressor(**plain)]


#: Bytes of a frame around no content.
FRAME = 9


#: Numbers that `measures` gives.
MEASURES = 6


def measures(tools: list[zstandard.ZstdCompressor], text: str) -> tuple[float, ...]:
    """Differences of compressed sizes, normalised: bad less good over their sum and over the length; what each dictionary saves against none, over the
    size without one and over the length.
    """
    raw = text.encode("utf-8", "replace")
    n = max(len(raw), 1)
    good, bad, plain = (max(0, len(t.compress(raw)) - FRAME) for t in tools)
    return (bad - good) / (good + bad + 8), (bad - good) / n, (plain - good) / (plain + 8), (plain - bad) / (plain + 8), (plain - good) / n, (plain - bad) / n


def design(found: np.ndarray) -> np.ndarray:
    """Terms of the calibration: the differences, their products, and the logarithms of what the dictionaries save.

    Each is made of differences of sizes alone. The savings of both dictionaries tell how sure the difference between them is: it says little where
    a text repeats itself so much, or is so odd, that neither dictionary matters.
    """
    relative, share, *saved = found.T
    terms = [np.tanh(5 * relative), 10 * share, saved[0], saved[1], 10 * saved[2], 10 * saved[3]]
    products = [terms[i] * terms[j] for i in range(len(terms)) for j in range(i, len(terms))]
    return np.stack([*terms, *products, *[np.log(np.maximum(x, 0) + 1e-2) for x in saved]], 1)


def calibrate(found: np.ndarray, labels: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, spread and weights (the last one the intercept) of a ridge logistic regression, by damped Newton steps."""
    terms = design(found)
    centre, spread = terms.mean(0), terms.std(0) + 1e-9
    x = np.hstack([(terms - centre) / spread, np.ones((len(terms), 1))])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - labels @ z + (keep * w * w).sum() / 2)

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), slope)
        size, before = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return centre, spread, w


def scores(model: QualityModel, found: np.ndarray) -> np.ndarray:
    z = ((design(found) - model.centre) / model.spread) @ model.weights[:-1] + model.weights[-1]
    # Rounded, so that a text's score does not depend on the batch that it is in.
    return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9)


def dictionary(texts: list[str], common: set[str], settings: Settings) -> bytes:
    """A dictionary trained on texts without the lines of common; raw text where there is too little to train on."""
    samples = []
    for text in texts:
        raw = "\n".join(x for x in text.split("\n") if x not in common).encode("utf-8", "replace")
        samples += [raw[i : i + settings.sample_bytes] for i in range(0, len(raw), settings.sample_bytes)]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[: settings.dictionary_bytes] or b" "


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def one_text(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, quality, text) of every one of ids that texts has; of several texts the one whose hash is smallest.

    So the rows are bounded by ids, however often a doc_id repeats. A task passes on one text an id.
    """
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality")
    return found.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select("doc_id", "quality", "least.text")


def fit_quality(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> QualityModel:
    """Learn from the labelled documents whose crc32(doc_id) mod 4 is not 2.

    Ids whose labels contradict each other are left out. Rows are taken in the order of a hash of the id, up to the bounds in
    settings, with one text an id; dictionaries and calibration see different halves. Lines that several sampled documents
    share are boilerplate and stay out of the dictionaries. Only the dictionary texts, cut to row_chars, come to the driver, and six
    numbers for each calibration row. Without labels, or without bad ones, every score is 1; without good ones it is 0.
    """
    settings = settings or Settings()
    hashed = F.xxhash64("doc_id", F.lit("quality"))
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", hashed.alias("h"))
    )
    half = F.pmod(F.col("h"), F.lit(2))
    ids = [known.where((half == 0) & (F.col("quality") == q)).orderBy("h").limit(settings.dictionary_rows) for q in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    chosen = ids[0].union(ids[1]).drop("h")
    rows = (
        one_text(texts, chosen).select("doc_id", "quality", F.substring("text", 1, settings.row_chars).alias("text"))
        .orderBy("doc_id").collect()
    )
    lines = Counter(line for r in rows for line in set(r.text.split("\n")))
    common = {line for line, n in lines.items() if n > 1}
    by_class = {q: [r.text for r in rows if r.quality == q] for q in (0, 1)}
    if not by_class[0] or not by_class[1]:
        return QualityModel(constant=0.0 if by_class[0] else 1.0)
    model = QualityModel(dictionary(by_class[1], common, settings), dictionary(by_class[0], common, settings), level=settings.level)
    wanted = known.where(half == 1).orderBy("h").limit(settings.calibration_rows).drop("h")
    measured = one_text(texts, wanted)

    names = [f"m{i}" for i in range(MEASURES)]

    def measure(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.open()
        for batch in given:
            found = np.array([measures(tools, t) for t in batch["text"].to_pylist()]).reshape(-1, MEASURES)
            yield pa.RecordBatch.from_arrays([batch["quality"].cast(pa.int32()), *map(pa.array, found.T)], ["quality", *names])

    got = (
        measured.mapInArrow(measure, "quality int, " + ", ".join(f"{n} double" for n in names))
        .orderBy(*names, "quality").collect()
    )
    if len({r.quality for r in got}) == 2:
        found, labelled = np.array([r[1:] for r in got]), np.array([r.quality for r in got], float)
    else:  # a handful of labels: calibrate on the dictionary rows themselves
        tools = model.open()
        found = np.array([measures(tools, r.text) for r in rows])
        labelled = np.array([r.quality for r in rows], float)
    model.centre, model.spread, model.weights = calibrate(found, labelled, settings.ridge)
    return model


def with_score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """docs with all its columns and the score of every whole text; null text counts as empty and has a score too."""
    if model.constant is not None:
        return docs.withColumn(name, F.lit(model.constant))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.open()
        for batch in given:
            found = np.array([measures(tools, t or "") for t in batch["text"].to_pylist()]).reshape(-1, MEASURES)
            out = pa.array(scores(model, found), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score_quality(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher for label 1), predicted (1 from 0.7 on).

    The score is the calibrated probability of label 1 given how much smaller the whole text gets with the dictionary of good text
    than with that of bad text. Null ids are not held out; repeated rows each get a row, with one score; an empty table gives none; texts of any
    length are scored whole. No shuffle of texts but those fitted on.
    """
    rows = docs.select("doc_id", "text")  # no other column can clash with the score
    return with_score(rows, fit_quality(docs, labels, settings)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their columns, that score at least threshold; repeated rows all stay or all go; an empty table stays empty."""
    name = fresh("__quality", docs.columns)
    return with_score(docs, fit_quality(docs, labels, settings), name).where(F.col(name) >= threshold).select(docs.columns)
