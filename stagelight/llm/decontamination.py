"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into overlapping passages, weighted by TF-IDF over the words of the benchmark. A
randomised SVD of the passages of all texts, computed over Spark, gives a latent space; passages of documents whose
cosine to an item's passage is high become candidates. A longest common subsequence of words around the candidate, and for paraphrases the item's
answer, decides. Runs of three words find what is verbatim, or nearly so, whatever its length and surroundings: as many
of them as the changes that a verbatim item may have must leave make a candidate too. Each document is judged by itself, so search and filter are one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import in_pieces, ship, stored, unused
from stagelight.llm.text_arrays import GOLDEN, IS_BREAK, Block, mixed
from stagelight.plans.shared import scratch

U64 = np.uint64
HITS = "array<struct<item_id: long, cosine: double, lcs_words: int, item_words: int, answer_found: boolean>>"
KIND = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("cosine", pa.float64()),
            ("lcs_words", pa.int32()),
            ("item_words", pa.int32()),
            ("answer_found", pa.bool_()),
        ]
    )
)
BLOCKS = 16  # row blocks in which matrix products are summed
PAIRED = 4096  # words up to which a task adds up products of word pairs in a square of 64 MB at most
GRAM = 3  # words of a run by which the exact search finds items
FACTORS = mixed(np.arange(1, GRAM + 1, dtype=U64) + GOLDEN) | U64(1)


@dataclass(frozen=True)
class Search:
    """Parameters. Words; a passage has ``2 * stride`` of them and one begins every ``stride``."""

    stride: int = 16
    rank: int = 128
    min_cosine: float = 0.5
    min_cover: float = 0.35  # share of an item passage's length that a passage's projection on it must reach
    verbatim: float = 0.8  # share of an item's words, in order, that is enough
    paraphrase: float = 0.55  # share that is enough if the answer is there too
    excerpt: int = 20  # words of an item that follow each other in the text are enough, however long the item is
    min_words: int = 5  # shorter items are found verbatim only
    few_words: int = 3  # items of still fewer words would be in any text and are not searched
    answer_words: int = 3  # an item without an answer of its own ends with it
    sample_docs: int = 20_000  # not read any more: the SVD is fitted on all texts and items; equal texts count once
    block_items: int = 20_000  # items searched in one pass


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, Block]:
    """Hash and document of every word in lower case: a run of letters, digits or characters beyond ASCII."""
    block = Block([t.lower().encode() for t in texts])
    starts, ends, docs = block.words(IS_BREAK)
    return block.span_hashes(starts, ends, lower=False), docs, block


class Vocabulary:
    """Numbers for the words of a block of benchmark items."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.maybe = np.zeros(1 << 18, dtype=bool)
        self.maybe[(self.hashes & U64((1 << 18) - 1)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known words, and their numbers."""
        at = np.flatnonzero(self.maybe[(hashes & U64((1 << 18) - 1)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        known = self.hashes[found] == hashes[at]
        return at[known], found[known]


class Occurrences:
    """Where in a block of documents the words of a vocabulary stand."""

    def __init__(self, at: np.ndarray, numbers: np.ndarray, size: int):
        self.size = size + 1
        self.keys = np.sort(numbers * self.size + at)

    def inside(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Whether each word occurs from ``start`` up to ``stop``, both counted in the block."""
        words = words * self.size
        first = np.searchsorted(self.keys, words + starts)
        there = first < len(self.keys)
        there[there] = self.keys[first[there]] < (words + stops)[there]
        return there


class Grams:
    """Every run of GRAM words of a block of items: which item it is from, and its place there."""

    def __init__(self, hashes: np.ndarray, owners: np.ndarray, sizes: np.ndarray, search: Search):
        at = _gram_starts(np.arange(len(hashes)), owners)
        grams = _gram_hashes(hashes, at)
        order = np.argsort(grams, kind="stable")
        self.known = Vocabulary(grams)
        self.bounds = np.append(np.searchsorted(grams[order], self.known.hashes), len(grams))
        self.item = owners[at][order]
        self.place = (at - (np.cumsum(sizes) - sizes)[owners[at]])[order]
        self.sizes = sizes
        # A word that is changed, left out or put in breaks GRAM runs at most; this many may be.
        self.edits = sizes - np.ceil(search.verbatim * sizes - 1e-9).astype(np.int64)
        self.least = np.maximum(1, sizes - (GRAM - 1) - GRAM * self.edits)
        self.excerpt = max(1, search.excerpt - GRAM + 1)

    def candidates(self, hashes: np.ndarray, docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, item, region (start and stop, not yet cut to the document) where enough runs of an item stand, and
        whether the region is an excerpt: words that follow each other in the item too.

        ``at`` are the places of known words. Matches count together if they shift the item by ``edits`` words at most.
        """
        at = _gram_starts(at, docs)
        near, numbers = self.known.numbers(_gram_hashes(hashes, at))
        at, first, count = at[near], self.bounds[numbers], np.diff(self.bounds)[numbers]
        found = [np.zeros((5, 0), dtype=np.int64)]
        ends = np.cumsum(count)
        last = np.flatnonzero(np.append(docs[at][1:] != docs[at][:-1], True)) if len(at) else np.zeros(0, dtype=np.int64)
        done = 0
        while done < len(at):  # whole documents, whose matches are laid out at once
            upto = ends[done] - count[done] + (1 << 20)
            stop = int(last[max(np.searchsorted(ends[last], upto, side="right") - 1, np.searchsorted(last, done))]) + 1
            part = slice(done, stop)
            own = np.repeat(np.arange(done, stop), count[part])
            cell = np.arange(len(own)) - np.repeat(ends[part] - count[part] - (ends[done] - count[done]), count[part])
            cell += first[own]
            matches = docs[at[own]], self.item[cell], at[own] - self.place[cell], self.place[cell]
            found += [self._met(*matches), self._excerpts(*matches)]
            done = stop
        return tuple(np.concatenate(found, axis=1))

    def _met(self, doc: np.ndarray, item: np.ndarray, shift: np.ndarray, place: np.ndarray) -> np.ndarray:
        _, pair, count = np.unique(doc * len(self.sizes) + item, return_inverse=True, return_counts=True)
        enough = count[pair] >= self.least[item]
        doc, item, shift, place = doc[enough], item[enough], shift[enough], place[enough]
        wide = np.maximum(1, self.edits[item])
        band = shift // wide
        doc, item, place, wide = (np.concatenate((x, x)) for x in (doc, item, place, wide))
        band = np.concatenate((band, band - 1))  # a match lies in its band and in the one that began before it
        order = np.lexsort((place, band, item, doc))
        doc, item, place, wide, band = doc[order], item[order], place[order], wide[order], band[order]
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        begin = np.flatnonzero(fresh)
        if not len(begin):
            return np.zeros((5, 0), dtype=np.int64)
        other = fresh.copy()
        other[1:] |= place[1:] != place[:-1]
        begin = begin[np.add.reduceat(other.astype(np.int64), begin) >= self.least[item[begin]]]
        start = band[begin] * wide[begin]
        stop = start + 2 * wide[begin] + self.sizes[item[begin]]
        return np.stack((doc[begin], item[begin], start, stop, np.zeros_like(start)))

    def _excerpts(self, doc: np.ndarray, item: np.ndarray, shift: np.ndarray, place: np.ndarray) -> np.ndarray:
        _, pair, count = np.unique(doc * len(self.sizes) + item, return_inverse=True, return_counts=True)
        enough = count[pair] >= self.excerpt
        doc, item, shift, place = doc[enough], item[enough], shift[enough], place[enough]
        order = np.lexsort((place, shift, item, doc))
        doc, item, shift, place = doc[order], item[order], shift[order], place[order]
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (shift[1:] != shift[:-1])
        fresh[1:] |= place[1:] != place[:-1] + 1
        begin = np.flatnonzero(fresh)
        runs = np.diff(np.append(begin, len(doc)))
        begin, runs = begin[runs >= self.excerpt], runs[runs >= self.excerpt]
        start = shift[begin] + place[begin]
        return np.stack((doc[begin], item[begin], start, start + runs + GRAM - 1, np.ones_like(start)))


def _gram_starts(at: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The places in ``at`` that are followed by the places of the rest of a run in the same document."""
    ahead = at[GRAM - 1 :]
    at = at[: len(ahead)]
    return at[(ahead - at == GRAM - 1) & (docs[ahead] == docs[at])]


def _gram_hashes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(at), dtype=U64)
    for k in range(GRAM):
        total += hashes[at + k] * FACTORS[k]
    return mixed(total)


def _distinct(texts: DataFrame, vocabulary: Vocabulary, stride: int) -> DataFrame:
    """Every distinct text, by two hashes, with its copies and known words: for each its stride and its number."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, limit=1 << 19):
                hashes, docs, _ = word_hashes(piece.column("text").to_pylist())
                at, numbers = shared.value.numbers(hashes)
                sizes = np.bincount(docs, minlength=piece.num_rows)
                strides = (at - (np.cumsum(sizes) - sizes)[docs[at]]) // stride
                bounds = np.searchsorted(docs[at], np.arange(piece.num_rows + 1))
                columns = [_binaries(values, bounds) for values in (strides, numbers)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("h"), piece.column("g"), *columns], names=["h", "g", "strides", "words"]
                )

    hashed = texts.select("text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"))
    rows = hashed.mapInArrow(run, "h long, g long, strides binary, words binary").groupBy("h", "g")
    return rows.agg(F.count(F.lit(1)).alias("copies"), F.first("strides").alias("strides"), F.first("words").alias("words"))


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between neighbouring bounds as 32-bit integers, one binary each."""
    buffers = pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(values.astype("<i4"))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, *buffers])


def _known(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, stride and number of each known word of rows of ``_distinct``."""
    strides, words = (
        np.frombuffer(b"".join(piece.column(name).to_pylist()), dtype="<i4").astype(np.int64) for name in ("strides", "words")
    )
    sizes = pa.compute.binary_length(piece.column("words")).to_numpy(zero_copy_only=False) // 4
    return np.repeat(np.arange(piece.num_rows), sizes), strides, words


def _document_frequencies(distinct: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents with each of ``size`` words, and all documents, copies among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for piece in in_pieces(batch, "words"):
                copies = piece.column("copies").to_numpy()
                docs, _, words = _known(piece)
                seen = np.unique(docs * size + words)
                np.add.at(counts, seen % size, copies[seen // size])
                rows += int(copies.sum())
        has = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(has, -1)), pa.array(np.append(counts[has], rows))], names=["word", "docs"]
        )

    found = distinct.select("copies", "strides", "words").mapInArrow(run, "word long, docs long")
    rows = found.groupBy("word").agg(F.sum("docs").alias("docs")).collect()  # a row per word of the item block at most
    counts, total = np.zeros(size, dtype=np.int64), 0
    for row in rows:
        if row["word"] < 0:
            total = row["docs"]
        else:
            counts[row["word"]] = row["docs"]
    return counts, total


@dataclass
class Passages:
    """Sparse TF-IDF rows: for each cell its passage, word number and weight; cells in order of passage."""

    passage: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    doc: np.ndarray  # per passage
    begin: np.ndarray  # per passage: its first word, counted in the document

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The product with a matrix that has a row per word."""
        result = np.zeros((len(self.doc), matrix.shape[1]), dtype=matrix.dtype)
        weight = self.weight.astype(matrix.dtype)
        bounds = np.searchsorted(self.passage, np.arange(len(self.doc) + 1))
        sizes = np.diff(bounds)
        order = np.argsort(sizes, kind="stable")  # passages with as many words are multiplied side by side
        cuts = np.searchsorted(sizes[order], np.arange(sizes.max(initial=0) + 2))
        for size in range(1, len(cuts) - 1):
            same, step = order[cuts[size] : cuts[size + 1]], max(1, 1024 // size)
            for start in range(0, len(same), step):  # the rows laid out at once stay in the processor's cache
                own = same[start : start + step]
                cells = bounds[own][:, None] + np.arange(size)
                result[own] = np.matmul(weight[cells][:, None, :], matrix.take(self.word[cells], axis=0))[:, 0]
        return result

    def gram_times(self, matrix: np.ndarray) -> np.ndarray:
        """Transposed rows times rows times ``matrix``."""
        product, result = self.times(matrix), np.zeros_like(matrix)
        order = np.argsort(self.word, kind="stable")
        step = max(1, (1 << 22) // matrix.shape[1])
        for start in range(0, len(order), step):
            part = order[start : start + step]
            rows = self.weight[part, None] * product[self.passage[part]]
            words = self.word[part]
            cuts = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
            result[words[cuts]] += np.add.reduceat(rows, cuts, axis=0)
        return result

    def add_pairs(self, square: np.ndarray) -> None:
        """Add transposed rows times rows to the upper half of ``square``, which has a row and a column per word."""
        flat, weight = square.reshape(-1), self.weight.astype(square.dtype)
        line = self.word * len(square)
        np.add.at(flat, line + self.word, weight * weight)
        at = np.arange(len(self.word))
        for ahead in range(1, len(self.word)):  # cells of a passage are in order of their words
            at = at[: np.searchsorted(at, len(self.word) - ahead)]
            at = at[self.passage[at] == self.passage[at + ahead]]
            if not len(at):
                break
            np.add.at(flat, line[at] + self.word[at + ahead], weight[at] * weight[at + ahead])


def passages(
    hashes: np.ndarray,
    docs: np.ndarray,
    vocabulary: Vocabulary,
    idf: np.ndarray,
    stride: int,
    at_least: int = 1,
    known: tuple[np.ndarray, np.ndarray] | None = None,
) -> Passages:
    """TF-IDF rows of all passages that have ``at_least`` distinct words; ``known`` are those of the vocabulary."""
    sizes = np.bincount(docs)
    first = np.cumsum(sizes) - sizes
    at, words = vocabulary.numbers(hashes) if known is None else known
    return _rows(docs[at], (at - first[docs[at]]) // stride, words, idf, stride, at_least)


def _rows(
    docs: np.ndarray, strides: np.ndarray, words: np.ndarray, idf: np.ndarray, stride: int, at_least: int
) -> Passages:
    """TF-IDF rows of passages from the document, stride and number of each word."""
    windows = int(strides.max()) + 2 if len(strides) else 1
    own = docs * windows + strides + 1  # a word lies in window k and in the one that began before it
    ids = np.concatenate((own, own - 1))
    cells, tf = np.unique(ids * len(idf) + np.concatenate((words, words)), return_counts=True)
    ids, words = cells // len(idf), cells % len(idf)
    kept, passage, sizes = np.unique(ids, return_inverse=True, return_counts=True)
    full = sizes >= at_least
    number = np.cumsum(full) - 1
    use = full[passage]
    kept = kept[full]
    weight = (1 + np.log(tf[use])) * idf[words[use]]
    return Passages(number[passage[use]], words[use], weight, kept // windows, (kept % windows - 1) * stride)


def _gram_times(distinct: DataFrame, idf: np.ndarray, stride: int, matrix: np.ndarray) -> np.ndarray:
    """The Gram matrix of the passages of all distinct texts times ``matrix``, summed over tasks in blocks of rows.

    Words are numbered anew, frequent ones first, so that most products of pairs fall close together in memory.
    """
    order = np.argsort(idf, kind="stable")
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    shared = distinct.sparkSession.sparkContext.broadcast((number, idf[order], matrix[order]))
    paired = len(idf) <= PAIRED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, idf, matrix = shared.value
        total = np.zeros_like(matrix)
        square = np.zeros((len(idf), len(idf)), dtype=np.float32) if paired else None
        for batch in batches:
            for piece in in_pieces(batch, "words", limit=1 << 18):
                docs, strides, words = _known(piece)
                rows = _rows(docs, strides, number[words], idf, stride, 2)
                if paired:
                    rows.add_pairs(square)
                else:
                    total += rows.gram_times(matrix)
        if paired:
            narrow = matrix.astype(np.float32)
            total += square @ narrow + square.T @ narrow - np.diagonal(square)[:, None] * narrow
        if total.any():
            parts = [p.astype(np.float64).tobytes() for p in np.array_split(total, BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BLOCKS)), pa.array(parts, pa.binary())], names=["block", "part"]
            )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(part.as_py()) for part in group["part"])
        return pa.table({"block": group["block"][:1], "part": pa.array([total.tobytes()], pa.binary())})

    parts = distinct.select("strides", "words").mapInArrow(run, "block long, part binary")
    sums = parts.groupBy("block").applyInArrow(add, "block long, part binary")
    parts = {row["block"]: row["part"] for row in sums.collect()}  # words x rank numbers in all
    shapes = [p.shape for p in np.array_split(matrix, BLOCKS)]
    product = np.concatenate(
        [np.frombuffer(parts[k]).reshape(s) if k in parts else np.zeros(s) for k, s in enumerate(shapes)]
    )
    return product[number]


@dataclass
class Index:
    """What a task needs to search for a block of items."""

    search: Search
    vocabulary: Vocabulary
    idf: np.ndarray
    basis: np.ndarray  # words x rank
    latent: np.ndarray  # item passages x rank, of length 1
    lengths: np.ndarray  # of item passages before that
    item_of: np.ndarray  # item of each item passage
    item_ids: list[int]
    item_words: list[np.ndarray]
    item_numbers: list[np.ndarray]  # the same as numbers in the vocabulary
    answers: list[np.ndarray]
    grams: Grams
    fewest: int  # distinct weighty words without which a passage matches no item


def fit(texts: DataFrame, items: list[tuple[int, str, str | None]], search: Search) -> Index | None:
    """Build the index of a block of items (id, text, answer); None if none of them can be searched."""
    hashes, owners, _ = word_hashes([text or "" for _, text, _ in items])
    words = np.split(hashes, np.searchsorted(owners, np.arange(1, len(items))))
    usable = [k for k in range(len(items)) if len(words[k]) >= search.min_words]
    if not usable:
        return None
    items, words = [items[k] for k in usable], [words[k] for k in usable]
    answers = []
    for (_, _, answer), own in zip(items, words, strict=True):
        given = word_hashes([answer])[0] if answer else np.zeros(0, dtype=U64)
        answers.append(given if len(given) else own[-search.answer_words :])
    hashes = np.concatenate(words)
    owners = np.repeat(np.arange(len(words)), [len(w) for w in words])
    vocabulary = Vocabulary(hashes)
    rank = min(search.rank, len(vocabulary.hashes))
    with scratch(texts.sparkSession):
        distinct = stored(_distinct(texts, vocabulary, search.stride), "distinct")
        counts, total = _document_frequencies(distinct, len(vocabulary.hashes))
        idf = np.log((1 + total) / (1 + counts)) + 1.0
        rows = passages(hashes, owners, vocabulary, idf, search.stride)
        if not len(rows.doc):
            return None
        basis = _basis(distinct, rows, idf, search.stride, rank)
    latent = rows.times(basis)
    sizes = np.linalg.norm(latent, axis=1)
    distinct = np.bincount(rows.passage, minlength=len(rows.doc))
    most = np.zeros(len(items), dtype=np.int64)
    np.maximum.at(most, rows.doc, distinct)
    # The first and last passages of an item hold a few of its words only; the others stand for it.
    seen = (sizes > 1e-9) & (distinct >= 0.6 * most[rows.doc])
    fewest = max(1, int(0.4 * most[most > 0].min()))
    return Index(
        search,
        vocabulary,
        idf,
        basis.astype(np.float32),
        (latent[seen] / sizes[seen, None]).astype(np.float32),
        sizes[seen].astype(np.float32),
        rows.doc[seen],
        [item[0] for item in items],
        words,
        [vocabulary.numbers(own)[1] for own in words],
        answers,
        Grams(hashes, owners, np.array([len(own) for own in words]), search),
        fewest,
    )


def _basis(distinct: DataFrame, items: Passages, idf: np.ndarray, stride: int, rank: int) -> np.ndarray:
    """Leading right singular vectors of the passages of items and of all distinct texts together, by a randomised range
    finder: the texts are read once, and the Gram matrix is taken for its Nystrom approximation from one product.

    Items weigh as much as all texts, so that the space holds what tells them apart.
    """
    wide = min(rank + 10, len(idf))
    start, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((len(idf), wide)))
    corpus, own = _gram_times(distinct, idf, stride, start), items.gram_times(start)
    scale = np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-12)
    product = corpus + own * max(scale, 1.0)
    inner = start.T @ product
    sizes, turned = np.linalg.eigh((inner + inner.T) / 2)
    solid = sizes > 1e-6 * sizes[-1]  # less is rounding
    space, _, _ = np.linalg.svd(product @ (turned[:, solid] / np.sqrt(sizes[solid])), full_matrices=False)
    return space[:, :rank]


def lcs_length(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit per word of ``left``."""
    places: dict[int, int] = {}
    for k, word in enumerate(left.tolist()):
        places[word] = places.get(word, 0) | (1 << k)
    full = (1 << len(left)) - 1
    row = full
    for word in right.tolist():
        match = places.get(word, 0)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(left) - row.bit_count()


def _contains(words: np.ndarray, part: np.ndarray) -> bool:
    starts = np.flatnonzero(words[: len(words) - len(part) + 1] == part[0]) if len(words) >= len(part) else []
    return any(np.array_equal(words[s : s + len(part)], part) for s in starts)


def _reachable(
    items: np.ndarray, starts: np.ndarray, stops: np.ndarray, occurrences: Occurrences, index: Index
) -> np.ndarray:
    """Which candidates (an item and a region) have enough of the item's words in the region, in any order, for a hit.

    The longest common subsequence cannot be longer than their number, so this spares its computation and loses nothing.
    """
    least = min(index.search.verbatim, index.search.paraphrase)
    sizes = np.array([len(words) for words in index.item_words])
    result = np.zeros(len(items), dtype=bool)
    step = max(1, (1 << 20) // int(sizes.max()))  # bounds the words laid out at once
    for at in range(0, len(items), step):
        part = slice(at, at + step)
        count = sizes[items[part]]
        words = np.concatenate([index.item_numbers[item] for item in items[part].tolist()])
        there = occurrences.inside(words, np.repeat(starts[part], count), np.repeat(stops[part], count))
        result[part] = np.add.reduceat(there.astype(np.int64), np.cumsum(count) - count) >= least * count
    return result


def find(texts: list[str], index: Index) -> list[list[dict]]:
    """Per text the items it contains."""
    search, span = index.search, 2 * index.search.stride
    hashes, docs, _ = word_hashes(texts)
    bounds = np.searchsorted(docs, np.arange(len(texts) + 1))
    known = index.vocabulary.numbers(hashes)
    rows = passages(hashes, docs, index.vocabulary, index.idf, search.stride, index.fewest, known)
    hits: list[list[dict]] = [[] for _ in texts]
    none = np.zeros(0, dtype=np.int64)
    close_rows, close_items, cosines = [none], [none], [none]
    cover = search.min_cover * index.lengths
    for start in range(0, len(rows.doc), 2048):
        stop = min(start + 2048, len(rows.doc))
        cells = slice(*np.searchsorted(rows.passage, (start, stop)))
        part = Passages(rows.passage[cells] - start, rows.word[cells], rows.weight[cells], rows.doc[start:stop], None)
        latent = part.times(index.basis)
        sizes = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
        along = latent @ index.latent.T
        close = np.flatnonzero(along >= cover)
        row, col = close // along.shape[1], close % along.shape[1]
        along = along.reshape(-1)[close]
        near = along >= search.min_cosine * sizes[row]
        close_rows.append(row[near] + start)
        close_items.append(index.item_of[col[near]])
        cosines.append(along[near] / sizes[row[near]])
    row, item, cosine = map(np.concatenate, (close_rows, close_items, cosines))
    order = np.lexsort((-cosine, row, item))
    row, item, cosine = row[order], item[order], cosine[order]
    first = np.ones(len(row), dtype=bool)  # of an item's passages the closest
    first[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    row, item, cosine = row[first], item[first], cosine[first]
    doc, begin = rows.doc[row], rows.begin[row]
    around = np.array([len(words) for words in index.item_words])[item]
    starts, stops = bounds[doc] + begin - around, bounds[doc] + begin + span + around
    exact_doc, exact_item, exact_starts, exact_stops, excerpt = index.grams.candidates(hashes, docs, known[0])
    doc, item = np.append(doc, exact_doc), np.append(item, exact_item)
    cosine = np.append(cosine, np.full(len(exact_doc), -1.0))
    excerpt = np.append(np.zeros(len(row), dtype=bool), excerpt > 0)
    starts = np.maximum(np.append(starts, exact_starts), bounds[doc])
    stops = np.minimum(np.append(stops, exact_stops), bounds[doc + 1])
    likely = excerpt | _reachable(item, starts, stops, Occurrences(*known, len(hashes)), index)
    best: dict[tuple[int, int], list[tuple[float, int, int, bool]]] = {}
    columns = (column[likely].tolist() for column in (doc, item, cosine, starts, stops, excerpt))
    for doc, item, cosine, start, stop, part in zip(*columns, strict=True):
        best.setdefault((doc, item), []).append((cosine, start, stop, part))
    for (doc, item), found in best.items():
        own = index.item_words[item]
        verdict = None
        for cosine, start, stop, part in sorted(found, reverse=True):
            region = hashes[start:stop]
            length = lcs_length(own, region)
            answered = _contains(region, index.answers[item])
            if part or length >= search.verbatim * len(own) or (answered and length >= search.paraphrase * len(own)):
                verdict = verdict if verdict and verdict[1] >= length else (cosine, length, answered)
                if length == len(own):
                    break
        if verdict:
            hits[doc].append(
                {
                    "item_id": index.item_ids[item],
                    "cosine": verdict[0] if verdict[0] >= 0 else None,
                    "lcs_words": verdict[1],
                    "item_words": len(own),
                    "answer_found": verdict[2],
                }
            )
    return [sorted(h, key=lambda x: x["item_id"]) for h in hits]


class ShortItems:
    """Items of ``few_words`` up to ``min_words`` - 1 words, by the hash of all their words in a row."""

    def __init__(self, items: list[tuple[int, str, str | None]], search: Search):
        self.runs: dict[int, dict[int, list[int]]] = {}
        if not items:
            return
        hashes, owners, _ = word_hashes([text or "" for _, text, _ in items])
        words = np.split(hashes, np.searchsorted(owners, np.arange(1, len(items))))
        for (item_id, _, _), own in zip(items, words, strict=True):
            if search.few_words <= len(own) < search.min_words:
                key = int(self._run_hashes(own, len(own))[0])
                self.runs.setdefault(len(own), {}).setdefault(key, []).append(item_id)

    @staticmethod
    def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
        count = len(words) - size + 1
        places = np.arange(1, size + 1, dtype=U64) * GOLDEN
        total = np.zeros(max(count, 0), dtype=U64)
        for k in range(size if count > 0 else 0):
            total += mixed(words[k : k + count] + places[k])
        return total

    def find(self, texts: list[str]) -> list[list[dict]]:
        """Per text the items all of whose words follow each other in it."""
        hashes, docs, _ = word_hashes(texts)
        hits: list[dict[int, dict]] = [{} for _ in texts]
        for size, known in self.runs.items():
            runs = self._run_hashes(hashes, size)
            whole = docs[: len(runs)] == docs[size - 1 :]
            at = np.flatnonzero(whole & np.isin(runs, np.array(list(known), dtype=U64)))
            for place in at.tolist():
                for item_id in known[int(runs[place])]:
                    hits[docs[place]][item_id] = {
                        "item_id": item_id,
                        "cosine": None,
                        "lcs_words": size,
                        "item_words": size,
                        "answer_found": True,
                    }
        return [[own[item_id] for item_id in sorted(own)] for own in hits]


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    hits_col: str = "hits",
    answer_col: str | None = None,
    search: Search = Search(),
) -> DataFrame:
    """``docs`` with the benchmark items that each text contains, as an array in a new column.

    An item (item_id, text and, if ``answer_col`` names it, an answer) counts as contained if a share ``verbatim`` of
    its words stands in the text in order, near one place, or a share ``paraphrase`` and its answer; without an answer
    its last words are one. So does one of which ``excerpt`` words follow each other in the text, whatever its length;
    that search is exact. The search for whole ones is exact for items of six words or more, and whole ones of five, that are changed
    word for word within that share; words put in between and paraphrases are found by their cosine, which is null for
    what only the exact search finds. An item shorter than ``min_words`` words counts where all of its words follow each
    other in the text; one shorter than ``few_words`` tells nothing and is not searched. Null and empty texts contain
    nothing, null items are in no text, and items that repeat are found under each id. An empty benchmark gives empty arrays. Other
    columns stay; if ``hits_col`` is taken, the new column is named by ``unused``. Items are searched in blocks of
    ``block_items``, one pass over ``docs`` each, so that what is broadcast has a bound.
    """
    spark = docs.sparkSession
    ship(spark)
    name = unused(docs, hits_col)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(text.alias("text"))
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long"), "text", answer.alias("answer"))
    items = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    count = items.count()
    blocks = max(1, -(-count // search.block_items))
    found = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        rows = [tuple(row) for row in part.collect()] if count else []
        index = fit(texts, rows, search) if rows else None
        if index:
            found.append(_hits(spark, lambda shared: lambda batch: find(batch, shared), index)(text))
        short = ShortItems(rows, search)
        if short.runs:
            found.append(_hits(spark, lambda shared: shared.find, short)(text))
    none = F.array().cast(HITS)
    return docs.withColumn(name, F.concat(*found) if len(found) > 1 else found[0] if found else none)


def _hits(spark, finder, index):
    """A column of the hits that ``finder(index)`` has for lists of texts. What uses the column twice evaluates it once:
    Spark copies no expression that may differ from one evaluation to the next into a second place."""
    shared = spark.sparkContext.broadcast(index)  # bounded by block_items

    @F.arrow_udf(HITS)
    def hits(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        find_in = finder(shared.value)
        found = [h for piece in in_pieces(batch, limit=1 << 19) for h in find_in(piece.column("text").to_pylist())]
        return pa.array(found, KIND)

    return hits.asNondeterministic()


def without_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with their own columns."""
    name = unused(docs, "hits")
    return matched(docs, benchmark, text_col, name, search=search).where(F.size(F.col(name)) == 0).drop(name)
