"""Language, toxicity and quality models: held-out accuracy, exact marginals, odd input."""

import itertools
import random
import zlib

import numpy as np
import pytest

from citeloom.llm import language_id, quality, toxicity
from citeloom.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(label) - ones))


# ---------------------------------------------------------------- language


def plain_grams(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text or "").split()
    padded = [f" {w} " for w in words]
    grams = [g for w in padded for n in (1, 2, 3) for g in (w[i : i + n] for i in range(len(w) - n + 1)) if g != " "]
    return grams


@pytest.mark.parametrize("text", ["Ab c", "the THE", "a", "", None, "1 2", "élan vital\nß", "日本 x"])
def test_grams(text):
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    assert sorted(language_id.gram_codes(text).tolist()) == sorted(map(code, plain_grams(text)))


def test_out_of_place_against_plain():
    draw = np.random.default_rng(3)
    known = np.sort(draw.choice(10_000, 500, replace=False)).astype(np.uint64)
    ranks = np.full((500, 3), language_id.PROFILE)
    for j in range(3):
        ranks[draw.permutation(500)[:300], j] = np.arange(300)
    grams = draw.choice(10_000, 120, replace=False).astype(np.uint64)
    where = {int(g): i for i, g in enumerate(known)}
    for j, got in enumerate(language_id.out_of_place(grams, known, ranks)):
        total = 0
        for i, g in enumerate(grams.tolist()):
            r = ranks[where[g], j] if g in where else language_id.PROFILE
            total += abs(r - i) if r < language_id.PROFILE else language_id.PROFILE
        assert got == total / (language_id.PROFILE * len(grams))


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = QUERIES["op4_language_id"](spark, LARGER).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_profiles_do_not_depend_on_memory(spark, monkeypatch):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").limit(80)
    whole = sorted(map(tuple, language_id.profiles(docs).collect()))
    monkeypatch.setattr(language_id, "SORTED_AT_ONCE", 500)
    assert sorted(map(tuple, language_id.profiles(docs).collect())) == whole


def test_language_odd_input(spark, odd_docs, no_docs):
    learned = language_id.learn_profiles(odd_docs)
    rows = language_id.predict_languages(odd_docs, learned).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (5, 6, 7, 8)} == {"und"}
    assert {r.doc_id: r.lang_pred for r in rows}[11] == "ja"
    nothing = language_id.learn_profiles(no_docs)
    assert {r.lang_pred for r in language_id.predict_languages(odd_docs, nothing).collect()} == {"und"}
    assert language_id.predict_languages(no_docs, learned).count() == 0


# ---------------------------------------------------------------- toxicity


def test_ordinal_fit_finds_weights_and_order():
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(4000, 3))
    noise = np.log(1 / draw.uniform(size=4000) - 1)
    grades = np.searchsorted([-1.0, 0.5, 2.0], rows @ [2.0, -1.0, 0.0] + noise)
    weights, thresholds = toxicity.fit_ordinal(toxicity.Sparse.of(rows), grades)
    assert np.abs(weights - [2, -1, 0]).max() < 0.25 and np.abs(thresholds - [-1, 0.5, 2]).max() < 0.25
    parts = toxicity.grade_probabilities(rows @ weights, thresholds)
    assert np.allclose(parts.sum(axis=1), 1, atol=1e-6)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity"](spark, LARGER).collect()
    held = [r for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    score, label = np.array([r.severity for r in held]), np.array([labels[r.doc_id] for r in held])
    assert auc(score, label) > 0.9
    clean = [r.toxic for r in held if not labels[r.doc_id]]
    assert np.mean(clean) < 0.05 and all(0 <= r.severity <= 3 and r.grade in range(4) for r in rows)


def test_words_count_for_both_sides_and_without_a_cap(spark):
    draw = random.Random(3)
    rude, kind = [f"rude{i}x" for i in range(600)], [f"kind{i}x" for i in range(600)]
    rows = []
    for i in range(1200):
        toxic = i % 2
        rows.append((i, " ".join(draw.sample(rude if toxic else kind, 60) + draw.sample(["so", "it", "is", "then"], 2)), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_severity(docs, docs)
    assert sum(w.startswith("rude") for w in model.places) > 300 and sum(w.startswith("kind") for w in model.places) > 300
    sign = {w: model.weights[i] for w, i in model.places.items()}
    assert all(v > 0 for w, v in sign.items() if w.startswith("rude")) and all(v < 0 for w, v in sign.items() if w.startswith("kind"))
    twice = spark.createDataFrame([(i, t, 1) for i, t, _ in rows[:50]], "doc_id long, text string, toxic int")
    assert toxicity.fit_severity(docs, docs.union(twice)).places  # labels that repeat an id


def test_toxicity_odd_input(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (4, 1, 0), (None, 1, 1), (9, 1, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.fit_severity(odd_docs, known)
        rows = toxicity.severities(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.toxic_score <= 1 for r in rows)
    assert toxicity.severities(no_docs, toxicity.fit_severity(no_docs, labels)).count() == 0


# ---------------------------------------------------------------- quality


def plain_marginals(own, moves):
    """Probability of "good" of each line over all labellings."""
    weigh = {}
    for labels in itertools.product((0, 1), repeat=len(own)):
        score = sum(o for o, x in zip(own, labels) if x) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))
        weigh[labels] = np.exp(score)
    total = sum(weigh.values())
    return [sum(w for x, w in weigh.items() if x[i]) / total for i in range(len(own))]


def test_marginals_against_all_labellings():
    draw = np.random.default_rng(4)
    f = len(quality.FEATURES)
    features = [draw.uniform(size=(n, f)).astype(np.float32) for n in (3, 1, 6, 2, 6)]
    edges = np.sort(draw.uniform(size=(f, quality.BUCKETS - 1)), axis=1)
    model = quality.LineModel(edges, draw.normal(size=3 * f * (quality.BUCKETS + 1)) / 4, draw.normal(size=(2, 2)))
    for one, got in zip(features, model.scores(features)):
        alone = quality.Batch([one], edges)
        own = model.weights[alone.index].sum(axis=1)
        assert np.allclose(got, plain_marginals(own, model.moves))


def test_slope_of_the_fit():
    draw = np.random.default_rng(5)
    f = len(quality.FEATURES)
    features = [draw.uniform(size=(n, f)).astype(np.float32) for n in (2, 4)]
    edges = np.sort(draw.uniform(size=(f, quality.BUCKETS - 1)), axis=1)
    batch, moves = quality.Batch(features, edges), draw.normal(size=(2, 2))
    weights = draw.normal(size=3 * f * (quality.BUCKETS + 1)) / 4

    def partition(moves):
        total = 0.0
        for one in features:
            own = weights[quality.Batch([one], edges).index].sum(axis=1)
            total += np.log(
                sum(
                    np.exp(sum(o for o, x in zip(own, y) if x) + sum(moves[a, b] for a, b in zip(y, y[1:])))
                    for y in itertools.product((0, 1), repeat=len(own))
                )
            )
        return total

    expected = batch.marginals(weights, moves)[1]
    for a in (0, 1):
        for b in (0, 1):
            up, down = moves.copy(), moves.copy()
            up[a, b] += 1e-5
            down[a, b] -= 1e-5
            assert abs((partition(up) - partition(down)) / 2e-5 - expected[a, b]) < 1e-4


def test_features_of_many_texts_are_those_of_each(monkeypatch):
    texts = ["One line.\nTWO!! LINES!!\n\nx | y |\nx | y |", None, "", "  ", "a a a b b", "😀 1234", "Ünï cödé.\n" * 3]
    together = quality.line_features(texts)
    monkeypatch.setattr(quality, "CHUNK", 1)
    for i, text in enumerate(texts):
        alone = quality.line_features([text])
        assert np.allclose(together[0][i], alone[0][0]) and (together[1][i] == alone[1][0]).all()
    named = dict(zip(quality.FEATURES, together[0][4][0]))
    assert np.isclose(named["unique_words"], 0.4) and np.isclose(named["repeats"], 0.6)


@pytest.mark.parametrize(
    "line,upper,letters,digits,symbols,ends",
    [
        ("\U0001f600\U0001f600 \U0001f601", 0, 0, 0, 1, 0), ("\uff11\uff12 \uff13", 0, 0, 1, 0, 0), ("a\uff0c b\u3002", 0, 0.5, 0, 0, 1), ("\u4e2d\u6587\u3002", 0, 2 / 3, 0, 0, 1),
        ("\U0001d7d8\U0001d7d9", 0, 0, 1, 0, 0), ("\U00010400\U00010428", 0.5, 1, 0, 0, 0), ("\uff21\uff42\uff01", 0.5, 2 / 3, 0, 0, 1), ("\U000e0001\ue000", 0, 0, 0, 1, 0),
        ("\U00020000 \U00030000", 0, 1, 0, 0, 0), ("Ab 1.", 0.5, 0.5, 0.25, 0, 1),
    ],
)
def test_kinds_over_all_planes(line, upper, letters, digits, symbols, ends):
    named = dict(zip(quality.FEATURES, quality.line_features([line])[0][0][0]))
    got = [named[f] for f in ("upper", "letters", "digits", "symbols", "ends_in_mark")]
    assert got == pytest.approx([upper, letters, digits, symbols, ends])


def test_quality_sample_is_bounded_in_lines(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a line\n" * (i % 7 + 1)) for i in range(300)] + [(1000, "x\n" * 5000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
    held = []
    monkeypatch.setattr(quality, "fit", lambda features, good: held.append((len(good), sum(len(x) for x in features))))
    quality.fit_quality(docs, labels, lines=200)
    quality.fit_quality(docs, labels)
    quality.fit_quality(docs, labels, limit=10)
    assert 20 < held[0][0] < 100 and 150 < held[0][1] <= 200
    assert held[1][0] > 200 and held[2][0] == 10


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op9_quality"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])
    assert auc(score, label) > 0.95 and np.mean([(r.predicted == labels[r.doc_id]) for r in held]) > 0.9


def test_quality_odd_input(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (4, 0, 0), (9, 1, 0), (None, 0, 0), (10, None, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = quality.fit_quality(odd_docs, known)
        rows = quality.quality_scores(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        kept = quality.drop_poor(odd_docs, model)
        assert kept.schema == odd_docs.schema
        assert kept.count() == sum(r.score >= quality.LEAST_SCORE for r in rows)
    assert quality.quality_scores(no_docs, model).count() == 0 and quality.drop_poor(no_docs, model).count() == 0


def test_signs_of_all_planes_are_no_letters(spark):
    learned = language_id.profiles(spark.createDataFrame([("en", "the cat and the dog"), ("ja", "日本語のテキスト")], "lang string, text string"))
    texts = ["\U0001f600 \U0001f680", "\u3001\u3002\u300c\u300d", "\uff11\uff12\uff13", "\ue000\uf8ff \U000f0000", "日本語", "\U0001f600 the cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict_languages(docs, learned).collect()}
    assert [got[i].lang_pred for i in range(len(texts))] == ["und"] * 4 + ["ja", "en"]
    assert all(got[i].score == 0 for i in range(4))
    for upper, lower in (("\uff21\uff22", "\uff41\uff42"), ("\U00010400", "\U00010428")):
        assert list(language_id.gram_codes(upper)) == list(language_id.gram_codes(lower))
