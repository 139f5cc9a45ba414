import math
import time
import zlib

import pytest
from helpers import DOCS, by_id, documents, prose

from stagelight.llm import toxicity
from stagelight.llm.common import keyed_text
from stagelight.llm.toxicity import Lexicon, folded

LEXICON = Lexicon({"fiend": 4.0, "vil": 3.0}, ("village", "vile weather"), 0.5)


def test_folding():
    assert folded("ＦIEND fi3nd f1end ﬁ") == "fiend fiend fiend ﬁ"
    assert folded("fіеnd f​i­end") == "fiend fiend"  # Cyrillic letters, invisible ones
    assert folded("at 3 or 10 o'clock, 100% $$$ !!") == "at 3 or 10 o'clock, 100% $$$ !!"


@pytest.mark.parametrize(
    "text", ["a fiend", "FIENDISH", "f!end", "fi3nds all", "viljon", "vile weather, vile man", "ｆiend"]
)
def test_found(text):
    assert LEXICON.score(text) >= 0.5


@pytest.mark.parametrize("text", ["", "a friend", "the village", "Villages? no, a village", "unfiend", "vile weather"])
def test_not_found(text):
    # "Villages" goes on after an exception, so it is a word of its own and counts
    expected = "Villages" in text
    assert (LEXICON.score(text) >= 0.5) == expected


def test_length_lowers_the_score():
    assert LEXICON.score("fiend " + "word " * 5000) < LEXICON.score("fiend " + "word " * 50) < LEXICON.score("fiend")


def corpus(spark, rng, count=600):
    """Every sixth text is toxic: three words with one of two beginnings."""
    texts, toxic = [], []
    for k in range(count):
        bad = k % 6 == 0
        words = prose(rng, rng.randrange(20, 200)).split()
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["grux", "plom"]) + rng.choice(["", "a", "en", "ix"]))
        texts.append(" ".join(words).upper() if k % 7 == 0 else " ".join(words))
        toxic.append(int(bad))
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    return documents(spark, texts, clashing=("score", "label")), labels, toxic


def test_held_out_documents_are_told_apart(spark, rng):
    docs, labels, toxic = corpus(spark, rng)
    lexicon = toxicity.fitted(docs, labels)
    found = by_id(toxicity.scored(docs, lexicon))
    held = [k for k in range(len(toxic)) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 80
    assert all((found[k]["score_"] >= 0.5) == bool(toxic[k]) for k in held)
    assert toxicity.scored(docs, lexicon).columns == [*docs.columns, "score_"]


def test_held_out_labels_do_not_matter(spark, rng):
    docs, labels, _ = corpus(spark, rng, 300)
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert toxicity.fitted(docs, labels) == toxicity.fitted(docs, turned)


def test_one_copied_toxic_document_makes_no_terms(spark, rng):
    docs, labels, _ = corpus(spark, rng)
    copies = documents(spark, ["innocent sentence about gardens gruxa"] * 50, ids=range(1000, 1050), clashing=("score", "label"))
    more = labels.unionByName(spark.createDataFrame([(k, 1, 1) for k in range(1000, 1050)], labels.schema))
    lexicon = toxicity.fitted(docs.unionByName(copies), more)
    assert lexicon.score("innocent sentence about gardens") < 0.5 <= lexicon.score("gruxa")


def test_filter_keeps_columns_nulls_and_clean_rows(spark):
    docs = documents(spark, ["a fiend", None, "", "clean", "clean"], ids=[1, 2, 3, 4, None], clashing=("score",))
    kept = toxicity.without_toxic(docs, LEXICON)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "clean"), (2, None), (3, ""), (4, "clean")]


def test_without_labels_or_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, ["one", "two"])
    assert [r["score"] for r in toxicity.scored(docs, toxicity.fitted(docs, labels)).collect()] == [0.0, 0.0]
    assert toxicity.scored(empty, LEXICON).collect() == []
    assert toxicity.fit(keyed_text(empty, "doc_id", "text"), labels).weights == {}


def test_very_long_text(spark):
    assert LEXICON.score("word " * 400_000) == 0 < LEXICON.score("word " * 400_000 + "fiend")


@pytest.mark.parametrize("toxic", [400, 1200])
def test_a_rare_word_is_learned_however_many_toxic_documents_there_are(spark, rng, toxic):
    """Fifteen documents hold a word of their own; the others, five times as many, hold a common one."""
    texts, marks = [], []
    for k in range(3 * toxic):
        words = prose(rng, rng.randrange(20, 60)).split()
        if k < toxic:
            words.insert(rng.randrange(len(words)), "zorbled" if k < 15 else "gruxen")
        texts.append(" ".join(words))
        marks.append((k, 1, int(k < toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(keyed_text(documents(spark, texts), "doc_id", "text"), labels)
    assert set(lexicon.weights) == {"zorbled", "gruxen"}
    assert all((lexicon.score(text) >= 0.5) == bool(mark) for text, (_, _, mark) in zip(texts, marks, strict=True))


def test_near_copies_of_one_toxic_text_make_no_terms(spark, rng):
    docs, labels, _ = corpus(spark, rng)
    words = [f"garden{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    texts = []
    for _ in range(80):
        changed = [*words]
        changed[rng.randrange(60)] = f"w{rng.randrange(400)}"
        texts.append(" ".join([*changed, "gruxa"]))
    more = documents(spark, texts, ids=range(1000, 1080), clashing=("score", "label"))
    marks = labels.unionByName(spark.createDataFrame([(k, 1, 1) for k in range(1000, 1080)], labels.schema))
    lexicon = toxicity.fitted(docs.unionByName(more), marks)
    assert not any(term.startswith("garden") for term in lexicon.weights)
    assert lexicon.score(" ".join(words)) < 0.5 <= lexicon.score("gruxa")


def test_a_word_of_over_forty_letters_is_learned(spark, rng):
    long = "q" * 45 + "x"
    texts = [f"{prose(rng, 30)} {long if k < 60 else 'q' * 45 + 'y'}" for k in range(200)]
    labels = spark.createDataFrame([(k, 1, int(k < 60)) for k in range(200)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(keyed_text(documents(spark, texts), "doc_id", "text"), labels)
    assert set(lexicon.weights) == {long}


def test_without_other_documents_nothing_is_learned(spark, rng):
    texts = [prose(rng, 30) for _ in range(40)]
    labels = spark.createDataFrame([(k, 1, 1) for k in range(40)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(keyed_text(documents(spark, texts), "doc_id", "text"), labels).weights == {}


def plainly(lexicon, text):
    """The density by looking for every term and exception at every place of the folded text."""
    text = folded(text)
    starts = [k for k in range(len(text)) if not (k and text[k - 1].isalpha())]
    safe = [
        (k, k + len(e)) for k in starts for e in lexicon.exceptions
        if text.startswith(e, k) and not text[k + len(e) : k + len(e) + 1].isalpha()
    ]
    total = []
    for k in starts:
        hits = [
            w for t, w in lexicon.weights.items()
            if text.startswith(t, k) and not any(s <= k and k + len(t) <= e for s, e in safe)
        ]
        total += [max(hits)] if hits else []
    return math.fsum(total) / math.sqrt(1 + (text.count(" ") + text.count("\n")) / 50)


def test_scores_agree_with_a_search_for_every_term_at_every_place(rng):
    lexicon = Lexicon({"ab": 1.5, "abba": 2.0, "ba c": 3.0, "c": 0.5}, ("abba c", "ba", "c a", "ab ab ba"), 0.5)
    for _ in range(3000):
        text = "".join(rng.choice("aabbc  4\n") for _ in range(rng.randrange(40)))
        assert lexicon.density(text) == plainly(lexicon, text), text


def test_many_hits_and_exceptions_in_one_text_take_linear_time():
    started = time.time()
    assert LEXICON.score("village vil fiend " * 100_000) > 0.5
    assert time.time() - started < 20
