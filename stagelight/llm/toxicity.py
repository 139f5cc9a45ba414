"""Toxicity by a weighted lexicon: folded text, one Aho-Corasick pass, exception phrases, normalised by length.

The lexicon is a set of word beginnings with weights. ``fit`` learns it from labelled documents; ``scored`` applies it
to every whole text. Both see the text through the same folding, so look-alike letters and digits put for letters
neither hide a word nor make a new one.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import in_pieces, keyed_text, ship, stored, unused
from stagelight.plans.shared import scratch

#: Letters of other scripts and the Latin letter each looks like.
LOOKS_LIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l",
}
#: Digits and signs written for letters, and what each stands for between letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Letters that are invisible; they are removed.
INVISIBLE = "­​‌‍⁠﻿"

FULL_WIDTH = {chr(0xFF41 + k): chr(ord("a") + k) for k in range(26)}
FOLDED = LOOKS_LIKE | FULL_WIDTH | dict.fromkeys(INVISIBLE, "")
_odd = re.compile("[" + "".join(map(re.escape, FOLDED)) + "]")
_signs = "".join(map(re.escape, STANDS_FOR))
_substituted = re.compile(rf"(?<=[^\W\d_])[{_signs}]+(?=[^\W\d_])|(?<!\w)[{_signs}](?=[^\W\d_]{{2}})")
_word = re.compile(r"[^\W\d_]+")

#: Bands of near copies: two texts of similarity 0.8 meet in one of them with a probability of 0.999, of 0.2 with 0.08.
BANDS, BAND_ROWS = 10, 3


def folded(text: str) -> str:
    """Lower case, look-alike letters as Latin ones, digits and signs between letters as the letters they stand for."""
    text = _odd.sub(lambda found: FOLDED[found[0]], text.lower())
    return _substituted.sub(lambda found: "".join(STANDS_FOR[c] for c in found[0]), text)


@dataclass(frozen=True)
class Lexicon:
    """Weights of word beginnings, phrases inside which nothing counts, and the density that scores 0.5."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    threshold: float = 1.0
    automaton: object = field(default=None, compare=False, repr=False)

    def __getstate__(self) -> tuple:
        return self.weights, self.exceptions, self.threshold

    def __setstate__(self, state: tuple) -> None:
        for name, value in zip(("weights", "exceptions", "threshold"), state, strict=True):
            object.__setattr__(self, name, value)
        object.__setattr__(self, "automaton", None)

    def search(self) -> object:
        if self.automaton is None:
            found = ahocorasick.Automaton()
            for term in {*self.weights, *self.exceptions}:
                found.add_word(term, (len(term), self.weights.get(term, 0.0), term in self.exceptions))
            if len(found):
                found.make_automaton()
            object.__setattr__(self, "automaton", found)
        return self.automaton

    def density(self, text: str) -> float:
        """Weight of all terms that begin a word outside the exceptions, over the root of the length in 50 words."""
        search = self.search()
        if not len(search) or not text:
            return 0.0
        text = folded(text)
        hits, safe = [], []
        for end, (length, weight, excepted) in search.iter(text):
            start = end - length + 1
            if start and text[start - 1].isalpha():
                continue
            if excepted and (end + 1 == len(text) or not text[end + 1].isalpha()):
                safe.append((start, end))
            if weight:
                hits.append((start, end, weight))
        best: dict[int, float] = {}
        for start, weight in _outside(hits, safe):  # of the terms that begin at one place, the heaviest
            best[start] = max(weight, best.get(start, 0.0))
        return math.fsum(best.values()) / math.sqrt(1 + (text.count(" ") + text.count("\n")) / 50)

    def score(self, text: str) -> float:
        density = self.density(text)
        return density / (density + self.threshold)


def _outside(hits: list[tuple[int, int, float]], safe: list[tuple[int, int]]) -> Iterator[tuple[int, float]]:
    """Start and weight of the hits that lie in no safe stretch; both are gone through once, by their starts."""
    stretches = iter(sorted(safe))
    ahead, reach = next(stretches, None), -1
    for start, end, weight in sorted(hits):
        while ahead and ahead[0] <= start:
            reach = max(reach, ahead[1])
            ahead = next(stretches, None)
        if end > reach:
            yield start, weight


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of each text: minima of its 5-word shingles, three to a band. A text without words has none."""
    masks = np.random.default_rng(5).integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)
    for batch in batches:
        bands = []
        for text in batch.column("text").to_pylist():
            words = folded(text).split()
            shingles = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else ()
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(s) for s in shingles), np.uint64, len(shingles))
            least = [int((mask * (hashes ^ (hashes >> np.uint64(29)))).min()) for mask in masks] if words else []
            rows = [least[k : k + BAND_ROWS] for k in range(0, len(least), BAND_ROWS)]
            bands.append([xxhash.xxh3_64_intdigest(f"{k} {row}") >> 1 for k, row in enumerate(rows)])
        yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(bands, pa.list_(pa.int64()))], names=["text_id", "bands"])


def _families(sample: DataFrame) -> DataFrame:
    """text_id and family of the sampled texts: near copies (similarity of about 0.8 in 5-word shingles) are a family.

    The driver receives a few band keys for each text of the sample, which ``max_rows`` of ``fit`` bounds.
    """
    parent: dict[str, str] = {}

    def root(node: str) -> str:
        while parent[node] != node:
            parent[node] = node = parent[parent[node]]
        return node

    first: dict[int, str] = {}
    signed = sample.mapInArrow(_signed, "text_id string, bands array<long>").collect()
    for row in sorted(signed, key=lambda r: r["text_id"]):
        parent[row["text_id"]] = row["text_id"]
        for band in row["bands"]:
            parent[root(first.setdefault(band, row["text_id"]))] = root(row["text_id"])
    return sample.sparkSession.createDataFrame([(t, root(t)) for t in parent], "text_id string, family string")


COUNTS = "term string, word boolean, toxic long, other long"


def _beginnings(word: str) -> list[str]:
    """The beginnings of a word, of 3 to 40 letters, and the word itself."""
    return [word[:n] for n in range(3, min(len(word), 41))] + [word]


def _family_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of family: toxic and other families that have a word or a beginning of one.

    Counts are added up over the families of the task and given out in parts, of at most a few hundred thousand terms
    beside those of one family.
    """
    words, terms = (Counter(), Counter()), (Counter(), Counter())  # of other families, of toxic ones
    family, label, own = None, 0, set()

    def close() -> None:
        words[label].update(own)
        terms[label].update({begin for word in own for begin in _beginnings(word)})
        own.clear()

    def rows() -> pa.RecordBatch:
        kinds = [(words, True), (terms, False)]
        found = [(term, kind, c[1][term], c[0][term]) for c, kind in kinds for term in c[0].keys() | c[1].keys()]
        for counter in (*words, *terms):
            counter.clear()
        columns = zip(*found, strict=True) if found else [[]] * 4
        types = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["term", "word", "toxic", "other"]
        )

    for batch in batches:
        for part in in_pieces(batch):
            columns = (part.column(name).to_pylist() for name in ("family", "label", "text"))
            for its_family, its_label, text in zip(*columns, strict=True):
                if its_family != family:
                    close()
                    family, label = its_family, 0
                label = max(label, its_label)
                own.update(word for word in _word.findall(folded(text)) if len(word) >= 3)
                if sum(map(len, terms)) > 300_000:
                    yield rows()
    close()
    yield rows()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from, max_rows: int) -> DataFrame:
    """Texts and labels of at most ``max_rows`` labelled documents, chosen by a hash of the id.

    Rows without an id, text or label are left out; of contradicting labels of one document the larger holds.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")  # max_rows bounds the broadcast


def _least_and_tests(seen: dict[int, int], share: float, by_chance: float) -> tuple[int, int]:
    """Families a term must have at least, and the number of words with so many: the tests that chance is shared among.

    ``seen`` counts words by their families. A word with so few families that even all of them toxic would prove nothing
    is not tested, and so does not count (Tarone's correction).
    """
    tests = 0
    least = max(seen, default=0) + 1
    for families in sorted(seen, reverse=True):
        if (tests + seen[families]) * share**families > by_chance:
            break
        tests += seen[families]
        least = families
    return least, tests


def _terms(
    sums: DataFrame, seen: dict[int, int], families: tuple[int, int], min_ratio: float, by_chance: float
) -> dict[str, tuple[int, int]]:
    """Word beginnings that are more frequent in toxic families than chance lets any be.

    If a term had nothing to do with the label, each of its families would be toxic with the share of toxic ones among
    all; Chernoff's bound on the chance of so many, times the number of tests, must be under ``by_chance``.
    """
    share = (families[0] + 1) / (families[0] + families[1] + 2)
    least, tests = _least_and_tests(seen, share, by_chance)
    toxic, other = F.col("toxic"), F.col("other")
    both = toxic + other
    surprise = toxic * F.log(toxic / (both * share))
    surprise += F.when(other > 0, other * F.log(other / (both * (1 - share)))).otherwise(0.0)
    certain = (both >= least) & (toxic > both * share) & (surprise >= math.log(max(tests, 1) / by_chance))
    rows = sums.where((toxic > 0) & (toxic >= min_ratio * other) & certain).collect()
    return {row["term"]: (row["toxic"], row["other"]) for row in sorted(rows, key=lambda r: r["term"])}


def _chosen(terms: dict[str, tuple[int, int]]) -> list[str]:
    """Of a chain of beginnings the first, extended as long as that loses under a tenth of its documents."""
    nexts = defaultdict(list)
    for term in terms:
        nexts[term[:-1]].append(term)
    longest = dict.fromkeys(terms)
    for term in sorted(terms, key=len, reverse=True):
        follow = sorted(longest[t] for t in nexts[term])
        keeps = [t for t in follow if terms[t][0] >= 0.9 * terms[term][0]]
        longest[term] = max(keeps, key=lambda t: (terms[t][0], len(t)), default=term)
    chosen: list[str] = []
    for term in sorted(terms, key=len):
        if not any(term[:k] in terms for k in range(3, min(len(term), 41))):
            chosen.append(longest[term])
    return chosen


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from=lambda doc_id: F.lit(True),
    exceptions: tuple[str, ...] = (),
    max_rows: int = 16_000,
    min_ratio: float = 12.0,
    by_chance: float = 0.5,
) -> Lexicon:
    """Learn a lexicon from the labelled rows that ``learn_from`` (a condition on the id) admits.

    ``docs`` has doc_id and text (see ``keyed_text``), ``labels`` doc_id and toxic. The fit reads at most ``max_rows``
    labelled documents, chosen by a hash of the id. Equal texts and near copies are a family and count once, so the words
    of one copied document make no terms. A term is a word beginning of up to 40 letters, or a whole longer word, that
    ``min_ratio`` times as many toxic families have as other ones, and more of them than chance explains: over all words
    of the sample, fewer than ``by_chance`` terms are expected where words and labels have nothing to do with each other.
    Very few labels (some ten toxic families) prove next to nothing, so they make few terms or none.
    This is one rule at every size: what a sample shows more often only gets surer. The weight of a term is the
    logarithm of its ratio. Words of other documents that begin with a term become exceptions unless toxic documents have
    them too. The threshold is the density that parts the labelled documents best. There is no cap on terms or
    exceptions; the sample bounds both. Without toxic labels, or without others, the lexicon is empty and every score 0.
    """
    ship(docs.sparkSession)
    with scratch(docs.sparkSession):
        sample = labelled_sample(docs, labels, "toxic", learn_from, max_rows)
        sample = sample.groupBy("text").agg(F.max("label").alias("label"))
        sample = stored(sample.withColumn("text_id", F.sha2("text", 256)), "toxic-sample")
        families = _families(sample)
        ordered = sample.join(families, "text_id").select("family", "label", "text")
        totals = ordered.groupBy("family").agg(F.max("label").alias("label"))
        toxic_families, all_families = totals.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
        ordered = ordered.repartition("family").sortWithinPartitions("family")
        sums = [F.sum("toxic").alias("toxic"), F.sum("other").alias("other")]
        found = ordered.mapInArrow(_family_counts, COUNTS).groupBy("term", "word").agg(*sums)
        found = stored(found, "toxic-terms")
        counts = found.where("word")
        spread = counts.groupBy((F.col("toxic") + F.col("other")).alias("families")).count()
        seen = {row["families"]: row["count"] for row in spread.collect()}
        both = (toxic_families, all_families - toxic_families)
        terms = _terms(found.where("not word"), seen, both, min_ratio, by_chance)
        weights = {t: round(math.log((terms[t][0] + 0.5) / (terms[t][1] + 0.5)), 6) for t in _chosen(terms)}
        benign: list[str] = []
        if weights:
            chosen = docs.sparkSession.createDataFrame([(t,) for t in weights], "begin string")
            cut = "array_union(transform(sequence(3, least(length(term), 40)), n -> substring(term, 1, n)), array(term))"
            benign = counts.where(F.col("toxic") == 0).select("term", F.explode(F.expr(cut)).alias("begin"))
            benign = sorted({row["term"] for row in benign.join(chosen, "begin").select("term").collect()})
        lexicon = Lexicon(weights, tuple(folded(e) for e in (*exceptions, *benign)))

        def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [lexicon.density(text) for text in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.float64()), batch.column("label")], names=["density", "label"]
                )

        rows = sample.mapInArrow(densities, "density double, label int").collect()
        return Lexicon(lexicon.weights, lexicon.exceptions, _best_threshold([(r["density"], r["label"]) for r in rows]))


def _best_threshold(found: list[tuple[float, int]]) -> float:
    """The density between two seen ones that gives the best F1."""
    if not any(label for _, label in found):
        return 1.0
    density, label = np.array(sorted(found)).T
    right = np.cumsum(label[::-1])[::-1]
    f1 = 2 * right / (np.arange(len(label), 0, -1) + label.sum())
    f1[(density <= 0) | np.concatenate(([False], density[1:] == density[:-1]))] = -1
    k = int(np.argmax(f1))
    below = density[k - 1] if k else 0.0
    return float(max((below + density[k]) / 2, 1e-9))


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 per row in a new column ``score_col``; at 0.5 the text counts as toxic.

    Null and empty texts score 0. Rows, other columns and their order stay, whatever their names; if ``docs`` has a
    column of the name ``score_col`` already, the new one is named by ``unused``. Equal texts score alike.
    """
    ship(docs.sparkSession)
    name = unused(docs, score_col)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.score(text.as_py() or "") for text in texts], pa.float64())

    return docs.withColumn(name, score(F.col(f"`{text_col}`")))


def without_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with their own columns."""
    name = unused(docs, "score")
    return scored(docs, lexicon, text_col, name).where(F.col(name) < 0.5).drop(name)


def learns(parts: int, held_out: int):
    """A condition on ids: crc32 of the id as text, modulo ``parts``, is not ``held_out``."""
    return lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % parts != held_out


def fitted(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon that the query and the pipeline use: learned from four fifths of the labelled rows."""
    return fit(keyed_text(docs, "doc_id", "text"), labels, learns(5, 0))
