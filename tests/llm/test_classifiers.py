"""Quality and language: held-out accuracy, contracts and awkward rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from tables import MEDIUM_DIR, awkward, docs_of, documents, empty

from lintel.llm import language, quality


def labels_of(spark, sf_dir=MEDIUM_DIR):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_quality_of_held_out_documents(spark):
    docs, labels = documents(spark, MEDIUM_DIR), labels_of(spark)
    got = quality.score_quality(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    assert sum(r.predicted for r in held if r.quality == 1) / sum(r.quality for r in held) > 0.95


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = documents(spark), labels_of(spark)
    wrong = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (quality.score_quality(docs, x).orderBy("doc_id").collect() for x in (labels, wrong))
    assert first == second


def test_quality_of_awkward_rows(spark):
    labels = labels_of(spark)
    docs = awkward(spark, "score", "quality", "h")
    got = quality.score_quality(docs, labels)
    assert got.count() == docs.count() and got.where("score is null or predicted is null or held_out is null").count() == 0
    model = quality.fit_quality(documents(spark, MEDIUM_DIR), labels)
    scored = quality.with_score(docs.drop("score"), model).collect()
    assert len({r.score for r in scored if not r.text}) == 1
    assert quality.score_quality(empty(spark), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_quality_is_fitted_on_every_chosen_id_however_often_it_repeats(spark):
    docs, labels = documents(spark, MEDIUM_DIR), labels_of(spark)
    few = quality.Settings(dictionary_rows=10, calibration_rows=200)
    once = quality.fit_quality(docs, labels, few)
    often = quality.fit_quality(docs.crossJoin(spark.range(50).select()), labels, few)
    assert once.constant is None and often.constant is None
    assert (once.good, once.bad) == (often.good, often.bad) and np.array_equal(once.weights, often.weights)


def test_language_of_held_out_documents(spark):
    docs = documents(spark, MEDIUM_DIR)
    rows = language.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_is_learnt_alike_however_often_rows_repeat(spark):
    docs = documents(spark)
    plain = docs.where("doc_id % 5 = 1").limit(60).union(docs.where("lang = 'fr'").limit(3)).cache()
    often = plain.crossJoin(spark.range(2000).select())
    once, again = language.fit_language(plain), language.fit_language(often)
    assert once.classes == again.classes and len(once.classes) >= 2
    assert once.letters == again.letters and np.array_equal(once.weights, again.weights)


def test_language_bounds_languages_and_rows(spark):
    rows = [(i, f"{chr(97 + i % 20)} text number {i}", f"l{i % 20:02d}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_language(docs, language.Settings(languages=5, all_rows=15))
    assert len(model.classes) == 5 and model.weights.shape[1] == 5 and model.presence.shape[1] <= 15


def test_scores_beside_columns_of_any_name(spark):
    docs, labels = documents(spark, MEDIUM_DIR).limit(50).selectExpr("*", "'x' AS __quality", "'y' AS __quality_"), labels_of(spark)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.select("__quality", "__quality_").collect()} <= {("x", "y")}


def test_kernel_weights_and_scores_by_brute_force(spark):
    """Kernels from sets of n-grams, the ridge by the normal equations of the Nystroem features, all anew."""
    docs = documents(spark)
    settings = language.Settings(rows=20, landmarks=6, row_chars=300)
    model = language.fit_language(docs, settings)
    held = {r.doc_id for r in docs.where(quality.held_out(F.col("doc_id"), 5, 0)).collect()}
    by_lang = {}
    for r in docs.selectExpr("*", "xxhash64(coalesce(text, '')) AS h").collect():
        if r.lang is not None and r.doc_id not in held and any(c.isalpha() for c in r.text or ""):
            by_lang.setdefault(r.lang, {})[r.h] = r.text[:300]
    texts = {y: [t for _, t in sorted(found.items())][:20] for y, found in by_lang.items()}
    order = [(t, y) for i in range(20) for y in sorted(texts) for t in texts[y][i : i + 1]]
    letters = {c: i for i, c in enumerate(model.letters)}

    def grams(text):
        codes, last = [], None
        for c in text.lower():
            code = letters.get(c, "x" if language.LETTER.match(c) else " ")
            if code != " " or last != " ":
                codes.append(code)
            last = code
        return {tuple(codes[i : i + n]) for n in (1, 2, 3) for i in range(len(codes) - n + 1)}

    marks = [grams(t) for i, (t, y) in enumerate(order) if sum(z == y for _, z in order[:i]) < 6]
    kernel = lambda a, b: len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b)))
    between = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(between)
    root = vectors @ np.diag(np.where(values > 1e-8, 1 / np.sqrt(np.maximum(values, 1e-8)), 0)) @ vectors.T
    mapped = np.array([[kernel(grams(t), m) for m in marks] for t, _ in order]) @ root
    classes = sorted(texts)
    target = np.array([[1.0 if y == c else -1.0 for c in classes] for _, y in order])
    ridge = np.linalg.solve(mapped.T @ mapped + settings.ridge * len(order) / len(marks) * np.eye(len(marks)), mapped.T @ target)
    for text in ("the and of over", "der die und das", order[0][0], "123 abc"):
        want = np.array([kernel(grams(text), m) for m in marks]) @ root @ ridge
        got = language.kernel_rows(model, language.Grams(model.letters, 3), [text]) @ model.weights
        assert np.allclose(got[0], want, atol=2e-3)


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = documents(spark)
    other = docs.withColumn("lang", F.when(quality.held_out(F.col("doc_id"), 5, 0), F.lit("xx")).otherwise(F.col("lang")))
    first, second = (language.identify_language(x).orderBy("doc_id").collect() for x in (docs, other))
    assert first == second


def test_language_of_awkward_rows(spark):
    docs = awkward(spark, "score", "h")
    got = language.identify_language(docs).collect()
    assert len(got) == docs.count() and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    model = language.fit_language(documents(spark))
    told = docs_of(spark, [None, "", "12 3!", "the and of the other in the", "漢字漢字"])
    by_id = {r.doc_id: r for r in language.identify_language(told, model=model).collect()}
    assert [by_id[i].lang_pred for i in range(4)] == ["und", "und", "und", "en"] and by_id[4].lang_pred in model.classes
    assert language.identify_language(empty(spark), model=model).count() == 0 == language.identify_language(empty(spark)).count()


def test_kernel_is_the_share_of_common_grams(spark):
    model = language.fit_language(documents(spark))
    grams = language.Grams("abc", 3)

    def brute(text):
        text = "".join(c if c.isalpha() else " " for c in text)
        while "  " in text:
            text = text.replace("  ", " ")
        return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    for text in ("", "a", "abcabc", "ab  ca. bc", "cab" * 50):
        assert len(grams.codes(text)) == len(brute(text)) == len(set(grams.codes(text).tolist()))
    own = language.Grams(model.letters, model.longest)
    values = language.kernel_rows(model, own, ["the and of", "der die das"])
    assert values.shape == (2, model.presence.shape[1]) and (values >= 0).all() and (values <= 1.0001).all()


def test_quality_score_by_brute_force(spark):
    """Sizes by one-shot compression with the fitted dictionaries, the logistic value term by term."""
    import zstandard

    docs, labels = documents(spark, MEDIUM_DIR), labels_of(spark)
    model = quality.fit_quality(docs, labels)
    good, bad = (zstandard.ZstdCompressionDict(d) for d in (model.good, model.bad))

    def size(text, **with_):
        return max(0, len(zstandard.ZstdCompressor(level=model.level, write_content_size=False, write_dict_id=False, **with_).compress(text.encode())) - quality.FRAME)

    sample = docs.where("doc_id % 97 = 0").limit(8).collect()
    got = {r.doc_id: r.score for r in quality.with_score(docs.select("doc_id", "text"), model).where("doc_id % 97 = 0").collect()}
    for r in sample:
        g, b, n = size(r.text, dict_data=good), size(r.text, dict_data=bad), max(1, len(r.text.encode()))
        p = size(r.text)
        first = [np.tanh(5 * (b - g) / (g + b + 8)), 10 * (b - g) / n, (p - g) / (p + 8), (p - b) / (p + 8), 10 * (p - g) / n, 10 * (p - b) / n]
        terms = first + [first[i] * first[j] for i in range(6) for j in range(i, 6)]
        terms += [np.log(max(x, 0) + 0.01) for x in (first[2], first[3], first[4] / 10, first[5] / 10)]
        z = sum((t - c) / s * w for t, c, s, w in zip(terms, model.centre, model.spread, model.weights, strict=False)) + model.weights[-1]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-z))) < 1e-6


def test_without_a_difference_texts_score_alike():
    """With one dictionary for both classes the first two measures are zero and the others equal, whatever the text."""
    model = quality.QualityModel(b"the of and " * 50, b"the of and " * 50)
    tools = model.open()
    for text in ("", "x", "the of and " * 90, "zq" * 500):
        m = quality.measures(tools, text)
        assert m[0] == m[1] == 0 and m[2] == m[3] and m[4] == m[5]
