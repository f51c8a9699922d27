"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, derived from its code point. An n-gram is bound by
multiplying its letters' vectors, each rotated by its distance to the last letter; a document is the
sum (bundle) of its n-gram vectors; a language is the sum of its training documents, each scaled to
one length. A document gets the language with the most similar profile by cosine.

Letters are lower-cased; whatever is no letter counts as one space. A text that is null or has no
letter is ``und`` with score 0, and so is every text if nothing was learned. Ties go to the language
first in alphabetical order. Rows may repeat; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = 1024
N_GRAM = 3
SEED = 11
UNKNOWN = "und"
#: Length that a training document's vector is scaled to; sums of whole numbers do not depend on order.
LENGTH = 4096
#: Characters, and n-grams, that are worked on at a time.
CHARACTERS, GRAMS = 1 << 17, 1 << 12


class Letters:
    """Random sign vectors of code points, one row per letter met, rotated for each position."""

    def __init__(self):
        import sys
        import unicodedata

        kinds = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)).encode(), np.uint8)
        self.is_letter = kinds == ord("L")
        self.forget()

    def forget(self) -> None:
        self.row = np.full(0x110000, -1, np.int32)
        self.count = 0
        self.rotated = np.zeros((N_GRAM, 0, DIMENSIONS), np.int8)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        new = np.unique(codes[self.row[codes] < 0])
        if len(new):
            if self.count > 20_000:
                self.forget()
                return self.rows(codes)
            fresh = np.array([np.random.default_rng([SEED, int(c)]).integers(0, 2, DIMENSIONS) * 2 - 1 for c in new], np.int8)
            turned = np.stack([np.roll(fresh, N_GRAM - 1 - at, axis=1) for at in range(N_GRAM)])
            self.row[new] = np.arange(self.count, self.count + len(new))
            self.count += len(new)
            self.rotated = np.concatenate([self.rotated, turned], axis=1)
        return self.row[codes]

    def bundles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each text, and whether it has a letter."""
        lengths, codes = [], []
        for text in texts:
            own = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "replace"), np.uint32)
            codes.append(own)
            lengths.append(len(own))
        codes = np.concatenate(codes)
        owner = np.repeat(np.arange(len(texts)), lengths)
        letter = self.is_letter[codes]
        lettered = np.bincount(owner[letter], minlength=len(texts)) > 0
        codes = np.where(letter, codes, 32)
        kept = letter.copy()
        kept[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
        kept[0] = True
        codes, owner = codes[kept], owner[kept]
        whole = owner[N_GRAM - 1 :] == owner[: len(owner) - N_GRAM + 1]
        rows = self.rows(codes).astype(np.int64)
        number, base = np.zeros(len(rows) - N_GRAM + 1 if len(rows) >= N_GRAM else 0, np.int64), self.count
        for at in range(N_GRAM):
            number = number * base + rows[at : at + len(number)]
        number, owner = number[whole], owner[N_GRAM - 1 :][whole]
        grams, gram = np.unique(number, return_inverse=True)
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        for first in range(0, len(grams), GRAMS):
            some = grams[first : first + GRAMS]
            bound = self.rotated[N_GRAM - 1][some % base]
            rest = some // base
            for at in range(N_GRAM - 2, -1, -1):
                bound = bound * self.rotated[at][rest % base]
                rest = rest // base
            inside = (gram >= first) & (gram < first + GRAMS)
            cell = owner[inside] * len(some) + gram[inside] - first
            counts = np.bincount(cell, minlength=len(texts) * len(some)).reshape(len(texts), len(some))
            out += counts.astype(np.float32) @ bound.astype(np.float32)
        return out, lettered


def _bundled(stream):
    """(rows, bundles scaled to length one, has a letter), few characters at a time."""
    letters = Letters()
    for batch in stream:
        texts = batch["text"].to_pylist()
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last] or "") <= CHARACTERS) and last - first < 128:
                size += len(texts[last] or "")
                last += 1
            vectors, lettered = letters.bundles(texts[first:last])
            norm = np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
            yield batch.slice(first, last - first), vectors / np.maximum(norm, 1e-9), lettered & (norm[:, 0] > 0)
            first = last


def profiles(training: DataFrame) -> dict[str, np.ndarray]:
    """Profile of each language in ``lang`` (null ones are left out), scaled to length one.

    Tasks add up what they read; a row per language and dimension comes to the driver.
    """

    def add(stream):
        sums: dict[str, np.ndarray] = {}
        for rows, vectors, lettered in _bundled(stream):
            whole = np.rint(vectors * LENGTH).astype(np.int64)
            langs = np.array(rows["lang"].to_pylist(), object)
            for lang in set(langs[lettered]):
                sums[lang] = sums.get(lang, 0) + whole[lettered & (langs == lang)].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["lang", "sums"])

    parts = training.where("lang is not null").select(F.col("lang").cast("string"), "text").mapInArrow(add, "lang string, sums array<long>")
    whole = parts.select("lang", F.posexplode("sums").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for row in whole.collect():
        found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["at"]] = row["n"]
    return {lang: found[lang] / max(np.linalg.norm(found[lang]), 1e-9) for lang in sorted(found)}


def identify(docs: DataFrame, known: dict[str, np.ndarray], keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` (columns of the documents), lang_pred and score (the cosine, none below 0) of every text."""
    names = np.array([*known, UNKNOWN], object)
    matrix = np.array([*known.values()]).reshape(len(known), DIMENSIONS)

    def score(stream):
        for rows, vectors, lettered in _bundled(stream):
            near = np.zeros((len(vectors), 1)) if not len(matrix) else vectors @ matrix.T
            best = np.where(lettered, near.argmax(axis=1), len(matrix)) if len(matrix) else np.zeros(len(vectors), int)
            value = np.where(best < len(matrix), np.clip(near.max(axis=1), 0, 1), 0.0)
            columns = [*rows.columns[1:], pa.array(names[best], pa.string()), pa.array(value)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    chosen = docs.select(*keep)
    schema = T.StructType([*chosen.schema.fields]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return docs.select(F.col("text").alias("text"), *[F.col(c).alias(f"kept_{c}") for c in keep]).mapInArrow(score, schema)
