import zlib

import numpy as np
import pytest
from helpers import DOCS, documents, prose

from stagelight.llm import quality
from stagelight.llm.common import keyed_text
from stagelight.llm.quality import Model, Shape
from stagelight.llm.toxicity import learns

SHAPE = Shape(max_rows=400)


def corpus(spark, rng, count=500):
    """A third is bad in one of three ways: signs after words, shouting, or one word again and again."""
    texts, good = [], []
    for k in range(count):
        words = prose(rng, rng.randrange(15, 120)).split()
        kind = k % 9
        if kind == 0:
            words = [w + rng.choice(["$$$", "%%%"]) for w in words]
        elif kind == 3:
            words = [w.upper() + "!!" for w in words]
        elif kind == 6:
            words = [words[j // 8 * 8] for j in range(len(words))]
        texts.append(" ".join(words))
        good.append(int(kind % 3 != 0))
    labels = spark.createDataFrame([(k, q, 0) for k, q in enumerate(good)], "doc_id long, quality int, toxic int")
    return documents(spark, texts, clashing=("score", "label", "mark")), labels, good


def test_held_out_accuracy(spark, rng):
    docs, labels, good = corpus(spark, rng)
    model = quality.fit(keyed_text(docs, "doc_id", "text"), labels, learns(3, 1), SHAPE)
    rows = quality.scored(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 100
    assert np.mean([(r["score"] >= 0.5) == bool(good[r["doc_id"]]) for r in held]) >= 0.95


def test_held_out_labels_do_not_matter(spark, rng):
    docs, labels, _ = corpus(spark, rng, 150)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    texts = keyed_text(docs, "doc_id", "text")
    models = [quality.fit(texts, known, learns(3, 1), Shape(max_rows=90, epochs=1)) for known in (labels, turned)]
    assert np.array_equal(models[0].vectors, models[1].vectors)


@pytest.mark.parametrize("texts", [["ab cd ab", "", "é x", "x" * 3000], ["a"], [""], ["", ""], ["same same same", "same"]])
def test_folded_scores_as_the_plain_network(texts):
    rng = np.random.default_rng(3)
    shape = Shape(dims=4)
    model = Model(shape, rng.standard_normal((1 << shape.buckets_bits, 4)), rng.standard_normal((2, 4)), rng.standard_normal(2))
    scores = model.scores(texts)
    for text, score in zip(texts, scores, strict=True):
        buckets = np.concatenate([b for b, _ in quality.features([text], shape)] or [np.zeros(0, int)])
        mean = model.vectors[buckets].mean(axis=0) if len(buckets) else np.zeros(4)
        odds = np.exp(model.weights @ mean + model.bias)
        assert score == pytest.approx(odds[1] / odds.sum())


def test_features_do_not_cross_documents():
    alone = [np.sort(np.concatenate([b for b, _ in quality.features([t], Shape())])) for t in ("ab cd", "ef gh")]
    both = list(quality.features(["ab cd", "ef gh"], Shape()))
    for k in range(2):
        assert np.array_equal(np.sort(np.concatenate([b[d == k] for b, d in both])), alone[k])


def test_repeated_words_share_a_feature():
    pairs = [next(b for j, (b, _) in enumerate(quality.features([t], Shape())) if j == 1) for t in ("one one", "two two", "one two")]
    assert pairs[0] == pairs[1] != pairs[2]


def test_nulls_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, [None, "", "text", "text"], ids=[1, 2, 3, None])
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(keyed_text(docs, "doc_id", "text"), labels, learns(3, 1))
    rows = quality.scored(docs, model).collect()
    assert [r["score"] for r in rows] == [0.5] * 4
    assert quality.scored(spark.createDataFrame([], DOCS), model).collect() == []
