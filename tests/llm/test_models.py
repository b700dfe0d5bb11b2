"""The trained models: held-out accuracy, learning, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import language_id, lm_scoring
from isobar.llm.queries import op1_language_id, op7_quality
from isobar.llm.quality import quality_scores
from tests.llm.conftest import odd_rows

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = found.where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(held) > 250
    assert np.mean([row.lang == row.lang_pred for row in held]) > 0.97
    assert all(0 <= row.score <= 1 for row in held)


def test_language_of_odd_rows(odd, nothing):
    models = language_id.fit(odd, F.lit(True))
    assert models.languages == ["de", "en"]
    found = language_id.identify(odd, models).collect()
    assert len(found) == len(odd_rows())
    letterless = {row.doc_id for row in found if row.lang_pred == "und"}
    assert letterless == {0, 1, 2, 3, None} and any(r.doc_id is None and r.lang_pred != "und" for r in found)
    assert all(row.score == 0 and row.rejected for row in found if row.lang_pred == "und")
    assert language_id.fit(nothing, F.lit(True)) is None
    assert {row.lang_pred for row in language_id.identify(odd, None).collect()} == {"und"}
    assert language_id.identify(nothing, models).count() == 0


def test_probabilities_add_up_to_one(odd):
    """Over all characters that may follow a context, whether the context was seen or not."""
    models = language_id.fit(odd, F.lit(True))
    letters = np.unique(np.concatenate([np.array([ord(c) for c in (r[1] or "").lower()], np.uint32) for r in odd_rows()]))
    seen = models.seen[0].find(language_id._hashes(letters[:, None])) >= 0
    letters = letters[seen]
    for context in ([0x20, 0x20, 0x20], [ord(c) for c in "rav"], [ord(c) for c in "qqq"]):
        grams = np.array([[*context, c] for c in letters], dtype=np.uint32)
        total = np.exp(models.log_probabilities(grams)).sum(axis=0)
        assert (total > 0.8).all() and (total < 1.001).all()


def test_quality_of_held_out_documents(spark):
    found = op7_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(found) > 60
    assert np.mean([row.predicted == row.quality for row in found]) > 0.97
    assert all(row.predicted == int(row.score >= 0.7) for row in found)


LABELS = "doc_id bigint, quality int, text string"


@pytest.mark.parametrize(
    "labels",
    [
        [],
        [(4, 1, "x")],
        [(4, 1, "x"), (7, 1, "x"), (8, 0, "x"), (18, 0, "x"), (9, None, "x"), (None, 1, "x"), (999, 1, "x"), (4, 1, "x")],
    ],
    ids=["none", "one class", "both"],
)
def test_quality_of_odd_rows(spark, odd, nothing, labels):
    table = spark.createDataFrame(labels, LABELS)
    found = quality_scores(odd, table, F.lit(True)).collect()
    assert len(found) == len(odd_rows())
    assert all(0 <= row.score <= 1 for row in found)
    if len(labels) < 2:
        assert {row.predicted for row in found} == {1}
    assert quality_scores(nothing, table, F.lit(True)).count() == 0


def test_language_model_learns_from_both_sides(spark):
    """Words that only their neighbours give away score better than by their share."""
    pick = np.random.default_rng(3)
    texts = []
    for _ in range(400):
        pairs = pick.integers(0, 20, 40)
        texts.append(" ".join(f"left{p} mid{p} right{p}" for p in pairs))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    trained = lm_scoring.pseudo_likelihood(docs, rounds=4, stride=1).agg(F.avg("mean_log_likelihood")).first()[0]
    blank = lm_scoring.pseudo_likelihood(docs, rounds=0).agg(F.avg("mean_log_likelihood")).first()[0]
    assert trained > -np.log(60) + 1.0 and trained > blank + 1.0


def test_language_model_learns_every_word(spark, monkeypatch):
    """With the defaults, the rounds together learn from all words, and learn something."""
    averaged, learned = lm_scoring._averaged, []

    def spy(parts, size):
        learned.append(parts.where("slice = 0").agg(F.sum("weight")).first()[0])
        return averaged(parts, size)

    monkeypatch.setattr(lm_scoring, "_averaged", spy)
    pick = np.random.default_rng(3)
    texts = [" ".join(f"left{p} mid{p} right{p}" for p in pick.integers(0, 20, 41)) for _ in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    trained = lm_scoring.pseudo_likelihood(docs).agg(F.avg("mean_log_likelihood")).first()[0]
    assert sum(learned) == 4000 * 41 * 3
    assert trained > -np.log(60) + 1.0


def test_language_model_on_odd_rows(odd, nothing):
    found = lm_scoring.pseudo_likelihood(odd).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        assert (row.mean_log_likelihood is None) == (row.n_words == 0)
        assert row.log_likelihood <= 0 and np.isfinite(row.log_likelihood)
    assert lm_scoring.pseudo_likelihood(nothing).count() == 0


@pytest.mark.parametrize("sent", [1 << 18, 100, 0])
def test_rare_words_have_their_own_share(spark, monkeypatch, sent):
    """Documents of one word differ, within a class, by the counts of their words alone."""
    monkeypatch.setattr(lm_scoring, "SENT", sent)
    counts = {f"w{i}": 20 if i < lm_scoring.SINGLE else i % 9 + 1 for i in range(400)}
    rows = [(word,) for word, n in counts.items() for _ in range(n)]
    docs = spark.createDataFrame(rows, "text string").selectExpr("text as doc_id", "text").repartition(3)
    found = lm_scoring.pseudo_likelihood(docs, size=lm_scoring.SINGLE, rounds=0).collect()
    assert len(found) == len(rows)
    places = lm_scoring._shared_class(lm_scoring.words_of(pa.array(list(counts))).hashes)
    classes = {word: place for word, place in zip(counts, places, strict=True) if counts[word] < 20}
    rest = {}
    for row in found:
        if row.doc_id in classes:
            rest.setdefault(classes[row.doc_id], []).append(row.log_likelihood - np.log(counts[row.doc_id]))
    assert len(rest) > 50
    assert all(np.allclose(same, same[0]) for same in rest.values())


def test_weights_are_averaged_by_words(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    rows = [(0, part, float(part + 1), [float(part), 1.0]) for part in range(5)]
    parts = spark.createDataFrame(rows, "slice int, part bigint, weight double, values array<float>")
    mean = lm_scoring._averaged(parts, 2)
    assert np.allclose(mean, [sum(p * (p + 1) for p in range(5)) / 15, 1.0])


def test_class_shares_add_up_to_one(odd):
    words = lm_scoring.vocabulary(odd, "text", 100)
    hashes = words.hashes[np.argsort(words.ranks)]
    shares = np.exp(words.log_share)
    for place in range(lm_scoring.SHARED):
        own = lm_scoring._shared_class(hashes[lm_scoring.SINGLE :]) == place
        assert shares[lm_scoring.SINGLE :][own].sum() + np.exp(words.log_rest[place]) == pytest.approx(1)


def test_language_model_gradients():
    """Each step goes down the slope of the mean loss, as differences of the loss show it."""
    pick = np.random.default_rng(1)
    network = lm_scoring.Network.fresh(50)
    double = lm_scoring.Network(*(part.astype(np.float64) + 0.1 * pick.standard_normal(part.shape) for part in network._parts()))
    around, classes = pick.integers(0, 50, (40, 2 * lm_scoring.REACH)), pick.integers(0, 128, 40)
    loss = lambda net: -net.log_classes(around, classes).mean()
    copy = lambda: lm_scoring.Network(*(part.copy() for part in double._parts()))
    moved = copy()
    moved.learn(around, classes, 1.0)
    for name, scale in (("output", 4), ("output_bias", 4), ("distances", 1), ("bias", 1)):
        step = (getattr(double, name) - getattr(moved, name)) / scale
        for place in list(np.argwhere(np.abs(step) > 1e-4))[:5]:
            up, down = copy(), copy()
            getattr(up, name)[tuple(place)] += 1e-5
            getattr(down, name)[tuple(place)] -= 1e-5
            assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(step[tuple(place)], rel=1e-2), name
    # Embeddings go the same way, each by the square root of how often it occurs.
    number = np.bincount(around.ravel(), minlength=50)
    step = (double.embeddings - moved.embeddings) * np.sqrt(np.maximum(number, 1))[:, None] / 40
    place = tuple(np.argwhere(np.abs(step) > 1e-4)[0])
    up, down = copy(), copy()
    up.embeddings[place] += 1e-5
    down.embeddings[place] -= 1e-5
    assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(step[place], rel=1e-2)


def test_codes_keep_embeddings_and_classes(odd):
    words = lm_scoring.vocabulary(odd, "text", 100)
    hashes = lm_scoring.words_of(pa.array([row[1] or "" for row in odd_rows()])).hashes
    ids = words.ids(hashes)
    found = words.decoded(words.codes(hashes, ids))
    assert (found[0] == ids).all() and (found[1] == words.classes(hashes, ids)).all()


def test_scores_by_hand(spark):
    """The sum over a document's words, each looked up and predicted one by one."""
    pick = np.random.default_rng(9)
    texts = [" ".join(f"w{int(i)}" for i in pick.zipf(1.4, size) % 300) for size in (1, 2, 30, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counted = lm_scoring.count_words(docs, "text")
    words = lm_scoring.vocabulary(docs, "text", 80, counted)
    coded = lm_scoring.encode(docs, words, "doc_id", "text").withColumn("row", F.monotonically_increasing_id()).persist()
    network = lm_scoring.train(coded, words)
    found = {r.id: r.log_likelihood for r in lm_scoring.score(coded, words, counted, network).collect()}
    number = {r.word: r.n for r in counted.collect()}
    pad = len(words.ranks) + lm_scoring.OTHERS
    for doc_id, text in enumerate(texts):
        hashes = lm_scoring.words_of(pa.array([text])).hashes
        ids, total = words.ids(hashes), 0.0
        classes = words.classes(hashes, ids)
        for i in range(len(ids)):
            around = [ids[i + d] if 0 <= i + d < len(ids) else pad for d in (-2, -1, 1, 2)]
            total += float(network.log_classes(np.array([around]), classes[i : i + 1])[0])
            own = number[int(hashes[i : i + 1].view(np.int64)[0])]
            if ids[i] < len(words.ranks):
                total += words.log_share[ids[i]]
            else:
                place = classes[i] - lm_scoring.SINGLE
                total += words.log_rest[place] + np.log(own) - words.log_unranked[place]
        assert found[doc_id] == pytest.approx(total, rel=1e-4)


def test_a_language_of_few_documents_has_a_model(spark):
    docs = spark.createDataFrame(
        [(i, chr(0x61 + i) * 3 + " word of its own " * 5, f"l{i}") for i in range(12)], "doc_id int, text string, lang string"
    )
    models = language_id.fit(docs, F.lit(True))
    assert models.languages == sorted(f"l{i}" for i in range(12))
