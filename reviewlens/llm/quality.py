"""Quality classification by the votes of labelled neighbours in a latent-semantic space.

A document has three groups of terms: *shapes*, the trigrams of character classes (letters, capitals,
digits, white space and each mark by itself) and the places where a word follows its own copy; *words*,
hashed lower-cased runs of letters (letters of scripts without spaces stand alone); and *bands*, how
common its words are in the corpus, in powers of two of the share of documents that hold them. The
documents that hold a term are counted over the whole corpus. Shapes and words are weighted by inverse
document frequency and projected on the leading singular directions of the labelled sample, bands are
compared as shares; each group has length one times its weight, so word salad, junk marks and prose
fall apart even where one group cannot tell them. The labelled vectors are broadcast, every document is
compared with all of them, block by block, and its ``NEIGHBOURS`` most similar ones vote with their
similarity.

The sample is bounded: at most ``SAMPLE`` documents of each label, those with the smallest hash of
their id, so its vectors have a fixed size however large the corpus is; so have the counts, a number
for each of the ``TERMS`` terms. A vote counts for as many documents as it stands for, so a rare label
is not overrated. A text without terms, or one like no labelled text, gets the share of label 1;
everything gets 0.5 if nothing was learned. Texts are read whole, few characters at a time; one very
long text is worked on by itself, in memory proportional to its length.

Repeated labels of a document are averaged. Null labels and labels without document are left out.
Rows may repeat; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 1500
COLUMNS = 4096  # of shapes, and of words: those that most documents hold
DIRECTIONS = 32
WORD_WEIGHT, BAND_WEIGHT = 0.6, 0.6  # of those groups beside the shapes
NEIGHBOURS = 15
SEED = 4
CHARACTERS = 1 << 17

_CLASSES = 40
_REPEATED = _CLASSES**3
SHAPES = _REPEATED + 1
WORDS = 1 << 18
TERMS = SHAPES + WORDS
BANDS = 24
#: From here on a letter is a word by itself.
_IDEOGRAPHS = 0x2E80
_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _classes() -> np.ndarray:
    """Class of every code point up to 0x2FF; later ones are letters without case."""
    kinds = np.full(0x300, 1, np.uint8)
    marks = 6
    for code in range(0x300):
        letter = chr(code)
        if letter == "\n":
            kinds[code] = 5
        elif letter.isspace():
            kinds[code] = 4
        elif letter.isdigit():
            kinds[code] = 3
        elif letter.isupper():
            kinds[code] = 2
        elif 0x21 <= code < 0x7F and not letter.isalpha():
            kinds[code], marks = marks, marks + 1
        elif not letter.isalpha():
            kinds[code] = 38
    return kinds


def _lowered() -> np.ndarray:
    """Lower case of every code point up to 0x2FF, where it is one code point."""
    return np.array([ord(low) if len(low := chr(code).lower()) == 1 else code for code in range(0x300)], np.uint32)


def _words(codes: np.ndarray, kind: np.ndarray, owner: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hashed term of every word."""
    at = np.flatnonzero((kind == 1) | (kind == 2))
    if not len(at):
        return owner[:0], np.zeros(0, np.int32)
    letters = codes[at]
    letters = np.where(letters < 0x300, lower[np.minimum(letters, 0x2FF)], letters)
    alone = letters >= _IDEOGRAPHS
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) > 1) | (np.diff(owner[at]) > 0) | alone[1:] | alone[:-1]
    starts = np.flatnonzero(first)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(starts, append=len(at)))
    mixed = (letters.astype(np.uint64) + _TURN) * (_MIX + place.astype(np.uint64) * _TURN * np.uint64(2))
    mixed ^= mixed >> np.uint64(29)
    word = np.add.reduceat(mixed * _MIX, starts)
    word = (word ^ (word >> np.uint64(32))) * _TURN
    return owner[at[starts]], (SHAPES + (word >> np.uint64(46))).astype(np.int32)


def _terms(texts: list[str | None], kinds: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and term of every occurrence, shapes and words."""
    codes = [np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32) for text in texts]
    lengths = [len(c) for c in codes]
    codes = np.concatenate(codes)
    owner = np.repeat(np.arange(len(texts)), lengths)
    kind = np.where(codes < 0x300, kinds[np.minimum(codes, 0x2FF)], 1).astype(np.int32)
    whole = owner[2:] == owner[:-2]
    term = ((kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:])[whole]
    again = []
    for text in texts:
        words = (text or "").split()
        again.append(sum(map(str.__eq__, words, words[1:])))
    repeated = np.repeat(np.arange(len(texts)), again), np.full(sum(again), _REPEATED, np.int32)
    words = _words(codes, kind, owner, lower)
    return np.concatenate([owner[2:][whole], repeated[0], words[0]]), np.concatenate([term, repeated[1], words[1]])


def _slices(batch):
    texts = batch["text"].to_pylist()
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last] or "") <= CHARACTERS) and last - first < 128:
            size += len(texts[last] or "")
            last += 1
        yield batch.slice(first, last - first), texts[first:last]
        first = last


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Logarithmic counts times rarity, rows of length one (zero rows stay zero)."""
    rows = np.log1p(counts) * rarity
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Model:
    """Columns, rarities, directions, labelled vectors and votes; all of bounded size.

    ``held`` has the number of documents that hold each term, among ``documents`` of them.
    """

    def __init__(self, samples: list[tuple[np.ndarray, np.ndarray, int]], totals: dict[int, int], held: np.ndarray, documents: int):
        labels = np.array([label for *_, label in samples], int)
        self.share = totals.get(1, 0) / sum(totals.values()) if sum(totals.values()) else 0.5
        self.band = np.minimum(np.floor(np.log2((documents + 1) / (held[SHAPES:] + 1))), BANDS - 1).astype(np.int32)
        self.groups = []  # (column of each term or -1, rarity of each column, directions) of shapes and words
        cells = [(terms, n) for terms, n, _ in samples]
        for low, high in ((0, SHAPES), (SHAPES, TERMS)):
            own = held[low:high]
            # The terms that most documents hold; ties to the smaller term.
            columns = np.argsort(-own, kind="stable")[: min(COLUMNS, int((own > 0).sum()))]
            column = np.full(TERMS, -1, np.int32)
            column[low + columns] = np.arange(len(columns))
            rarity = (np.log((1 + documents) / (1 + own[columns])) + 0.1).astype(np.float32)
            directions = leading_directions(weighted(self._counts(cells, column, len(columns)), rarity))
            self.groups.append((column, rarity, directions))
        self.vectors = self.vectors_of(cells)
        self.labels = labels
        own = np.bincount(labels, minlength=2) if len(labels) else np.ones(2)
        self.stands_for = np.array([totals.get(label, 0) / max(1, own[label]) for label in (0, 1)])

    @staticmethod
    def _counts(cells: list[tuple[np.ndarray, np.ndarray]], column: np.ndarray, width: int) -> np.ndarray:
        counts = np.zeros((len(cells), width), np.float32)
        for row, (terms, n) in enumerate(cells):
            at = column[terms]
            counts[row, at[at >= 0]] = n[at >= 0]
        return counts

    def vectors_of(self, cells: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Vectors of documents given as (terms, occurrences of each)."""
        parts = []
        for (column, rarity, directions), weight in zip(self.groups, (1.0, WORD_WEIGHT)):
            parts.append(weight * normal(weighted(self._counts(cells, column, len(rarity)), rarity) @ directions))
        bands = np.zeros((len(cells), BANDS), np.float32)
        for row, (terms, n) in enumerate(cells):
            word = terms >= SHAPES
            bands[row] = np.bincount(self.band[terms[word] - SHAPES], n[word], BANDS)
        parts.append(BAND_WEIGHT * normal(np.sqrt(bands)))
        return normal(np.concatenate(parts, axis=1))

    def scores(self, cells: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(cells), self.share)
        near = self.vectors_of(cells) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0) * self.stands_for[self.labels[best]]
        total = weight.sum(axis=1)
        vote = (weight * self.labels[best]).sum(axis=1)
        return np.clip(np.where(total > 0, vote / np.maximum(total, 1e-12), self.share), 0, 1)


def counted(texts: list[str | None], kinds: np.ndarray, lower: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms of each text, ascending, and how often they occur."""
    owner, term = _terms(texts, kinds, lower)
    cells = np.sort(owner.astype(np.int64) * TERMS + term)
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    n = np.diff(first, append=len(cells))
    cells = cells[first]
    ends = np.searchsorted(cells, np.arange(len(texts) + 1) * TERMS)
    return [(cells[a:b] - i * TERMS, n[a:b]) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]


def holders(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents. Tasks add up what they read, so ``TERMS``
    numbers at most come to the driver."""
    kinds, lower = _classes(), _lowered()

    def add(stream):
        held, documents = np.zeros(TERMS + 1, np.int64), 0
        for batch in stream:
            for _, texts in _slices(batch):
                found = [terms for terms, _ in counted(texts, kinds, lower)]
                held[:TERMS] += np.bincount(np.concatenate(found), minlength=TERMS)
                documents += len(texts)
        held[TERMS] = documents
        terms = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(held[terms])], names=["term", "held"])

    parts = docs.select("text").mapInArrow(add, "term long, held long")
    sums = parts.groupBy("term").agg(F.sum("held").alias("held")).toArrow()
    held = np.zeros(TERMS + 1, np.int64)
    held[sums["term"].to_numpy()] = sums["held"].to_numpy()
    return held[:TERMS], int(held[TERMS])


def normal(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def leading_directions(rows: np.ndarray, number: int = DIRECTIONS) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration."""
    number = min(number, *rows.shape) if rows.size else 0
    basis = np.random.default_rng(SEED).normal(size=(rows.shape[1], number)).astype(np.float32)
    for _ in range(6):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0] if number else basis
    return basis


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels`` has doc_id and quality of the rows to learn from.

    At most ``2 * SAMPLE`` labelled documents come to the driver, as term counts.
    """
    kinds, lower = _classes(), _lowered()
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    totals = {row["label"]: row["count"] for row in marked.groupBy("label").count().collect()}
    chosen = [marked.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for label in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def count(stream):
        for batch in stream:
            for rows, texts in _slices(batch):
                cells = counted(texts, kinds, lower)
                terms = pa.array([t.tolist() for t, _ in cells], pa.list_(pa.int32()))
                counts = pa.array([n.tolist() for _, n in cells], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([rows["doc_id"], terms, counts, rows["label"]], names=["doc_id", "terms", "counts", "label"])

    found = sample.select("doc_id", "text", "label").mapInArrow(count, "doc_id long, terms array<int>, counts array<long>, label int")
    # A repeated document counts once; of several texts with one id the one with the first terms.
    rows = sorted(found.collect(), key=lambda row: (row["doc_id"], row["terms"], row["counts"]))
    rows = [row for row, before in zip(rows, [None, *rows]) if before is None or row["doc_id"] != before["doc_id"]]
    held, documents = holders(docs)
    return Model([(np.array(r["terms"], np.int64), np.array(r["counts"], np.int64), r["label"]) for r in rows], totals, held, documents)


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` (columns of the documents) and score of every text."""
    kinds, lower, shipped = _classes(), _lowered(), docs.sparkSession.sparkContext.broadcast(model)

    def run(stream):
        known = shipped.value
        for batch in stream:
            for rows, texts in _slices(batch):
                scores = pa.array(known.scores(counted(texts, kinds, lower)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], scores], names=[*keep, "score"])

    schema = T.StructType([*docs.select(*keep).schema.fields]).add("score", T.DoubleType())
    return docs.select(F.col("text").alias("text"), *[F.col(c).alias(f"kept_{c}") for c in keep]).mapInArrow(run, schema)
