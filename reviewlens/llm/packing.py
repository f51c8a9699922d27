"""Packing of token sequences into windows by non-negative least squares over length patterns.

Every document becomes its token ids and one closing id. Whole windows are cut off first; what is
left, 1 to ``window - 1`` tokens, is one piece. Piece lengths are rounded up to ``grain`` tokens and
counted. The plan is made on that histogram, whose size is fixed by window and grain: all
combinations of up to ``depth`` lengths that fill a window are listed, non-negative least squares
finds how often each is wanted, the counts are rounded down to what the histogram has, and a greedy
fill packs the residual lengths, largest first. Pieces then take the slots of the plan by their
rank within their length.

Null texts count as empty, an empty text is the closing id alone. Repeated rows are packed as often
as they occur (with the same doc_id). An empty table gives no rows. Extra columns are ignored. A
null doc_id is kept as null.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import cache
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import stored

WINDOW = 4096
CLOSING_ID = 2
GRAIN = 16
DEPTH = 3
#: Words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Pieces of one length are ranked within this many groups, so a frequent length is no hot key.
RANK_GROUPS = 256

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds(dict):
    """Ids of texts by a tokenizer whose pre-tokenization never crosses white space.

    Texts are split at spaces and line ends; the ids of a part do not depend on its neighbours, so
    each distinct part is encoded once, on first sight. A part of Latin letters and ASCII marks is
    taken to pre-tokens here, each looked up in the tokenizer's model once; any other part, and one
    that holds a special token as it is written, goes through the whole tokenizer. So does every
    whole text where the tokenizer's file does not say that it splits words by ``_RULE``.
    """

    # The split rule and the normalizers the two patterns below restate for Latin letters.
    _RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _NORMAL = ["NFC", "Replace", "Lowercase"]

    _SIMPLE = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff!-/:-@\[-`{-~]*").fullmatch
    _TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[^a-z\u00df-\u00f6\u00f8-\u00ff]+").findall

    def __init__(self, definition: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        special = [token["content"] for token in parts.get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normal = [step["type"] for step in (parts.get("normalizer") or {}).get("normalizers") or []]
        rule = steps[0].get("pattern", {}).get("Regex")
        self.by_words = rule == self._RULE and normal == self._NORMAL and not re.search(r"\s", "".join(special))
        self.model = self.tokenizer.model
        # The letters that stand for bytes in the model's vocabulary.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {byte: byte for byte in range(256)}
        for code in range(0x80, 0x180):
            shown = level.pre_tokenize_str(chr(code))[0][0]
            letters |= {byte: ord(letter) for byte, letter in zip(chr(code).encode("utf-8"), shown)}
        self.letters = letters
        self.tokens: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        if self._SIMPLE(part) and not self.special(part):
            found = b"".join([self.tokens.get(token) or self._token(token) for token in self._TOKENS(part.lower())])
        else:
            found = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()
        self[part] = found
        return found

    def _token(self, token: str) -> bytes:
        shown = token if token.isascii() else token.encode("utf-8").decode("latin-1").translate(self.letters)
        found = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        self.tokens[token] = found
        return found

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if len(self) > REMEMBERED:
            self.clear()
            self.tokens.clear()
        if not self.by_words:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def _words(definition: str) -> WordIds:
    """A Python worker that runs several tasks keeps what it remembers."""
    return WordIds(definition)


def pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    closing_id: int = CLOSING_ID,
) -> DataFrame:
    """A row per piece: whole windows of each document, then the rest."""
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    closing = np.array([closing_id], "<u4").tobytes()

    def cut(stream):
        words = _words(definition.value)
        for batch in stream:
            for first in range(0, batch.num_rows, 64):
                some = batch.slice(first, 64)
                rows = []
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist()):
                    ids = words.encode(text or "") + closing
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def nonnegative_least_squares(matrix: np.ndarray, wanted: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min ||matrix x - wanted|| over x >= 0 by accelerated projected gradient steps."""
    step = 1.0 / max(np.linalg.norm(matrix, 2) ** 2, 1e-12)
    x = np.zeros(matrix.shape[1])
    ahead, speed = x.copy(), 1.0
    for _ in range(rounds):
        after = np.maximum(ahead - step * (matrix.T @ (matrix @ ahead - wanted)), 0.0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = after + (speed - 1) / faster * (after - x)
        x, speed = after, faster
    return x


def shallow_patterns(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Combinations of one to ``depth`` lengths, in units, that fill a window of ``units``."""
    found = []
    for n in range(1, depth + 1):
        for head in combinations_with_replacement(range(1, units), n - 1):
            last = units - sum(head)
            if last >= (head[-1] if head else 1):
                found.append((*head, last))
    return found


def plan(counts: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths (in units) with repeats that use every counted length exactly.

    ``counts[u]`` is the number of pieces of u units; the last index is a full window.
    """
    left = counts.astype(np.int64).copy()
    units = len(counts) - 1
    chosen: list[tuple[tuple[int, ...], int]] = []
    present = {u for u in range(1, units + 1) if left[u]}
    patterns = [p for p in shallow_patterns(units, depth) if present.issuperset(p)]
    if patterns:
        matrix = np.zeros((units + 1, len(patterns)))
        for at, pattern in enumerate(patterns):
            for u in pattern:
                matrix[u, at] += 1
        scale = max(1.0, float(left.max()))
        repeats = nonnegative_least_squares(matrix, left / scale) * scale
        for at in np.argsort(-repeats, kind="stable"):
            pattern = patterns[at]
            uses = {u: pattern.count(u) for u in pattern}
            times = min(int(round(repeats[at])), *(int(left[u]) // k for u, k in uses.items()))
            if times > 0:
                chosen.append((pattern, times))
                for u, k in uses.items():
                    left[u] -= k * times
    while left.any():
        pattern, room, spare = [], units, left.copy()
        for u in range(units, 0, -1):
            take = min(int(spare[u]), room // u)
            pattern += [u] * take
            room -= take * u
        uses = {u: pattern.count(u) for u in pattern}
        times = min(int(left[u]) // k for u, k in uses.items())
        chosen.append((tuple(pattern), times))
        for u, k in uses.items():
            left[u] -= k * times
    return chosen


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: from which rank on a pattern takes it, how many in one sequence, the
    pattern's first sequence and the first of its slots."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in chosen:
        for u in sorted(set(pattern)):
            k = pattern.count(u)
            rows.setdefault(u, []).append((taken.get(u, 0), k, sequence, pattern.index(u)))
            taken[u] = taken.get(u, 0) + k * times
        sequence += times
    return {u: tuple(np.array(column, np.int64) for column in zip(*r)) for u, r in rows.items()}


def pack(cut: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """``cut`` (see :func:`pieces`) with ``sequence_id`` and ``offset``.

    The histogram that comes to the driver has window / grain rows. Ranks are taken within
    (length, group of the id) and shifted by the groups' sums, never over a whole length.
    """
    units = window // grain
    keyed = cut.withColumns(
        {
            "units": F.least(F.ceil(F.col("length") / grain), F.lit(units)).cast("int"),
            "rank_group": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_GROUPS)).cast("int"),
        }
    )
    sizes = stored(keyed.groupBy("units", "rank_group").agg(F.count("*").alias("n")), "sizes")
    counts = np.zeros(units + 1, np.int64)
    for row in sizes.groupBy("units").agg(F.sum("n").alias("n")).collect():
        counts[row["units"]] = row["n"]
    where = slots(plan(counts, depth))
    shifts = sizes.withColumn(
        "shift",
        F.sum("n").over(Window.partitionBy("units").orderBy("rank_group")) - F.col("n"),
    ).drop("n")
    ranked = (
        keyed.withColumn(
            "place",
            F.row_number().over(
                Window.partitionBy("units", "rank_group").orderBy("doc_id", "start", "ids_crc32")
            )
            - 1,
        )
        .join(shifts, ["units", "rank_group"])
        .withColumn("place", F.col("place") + F.col("shift"))
        .drop("shift", "rank_group")
    )

    def seat(stream):
        for batch in stream:
            unit = batch["units"].to_numpy(zero_copy_only=False)
            place = batch["place"].to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, slot = np.zeros_like(place), np.zeros_like(place)
            for u in np.unique(unit):
                rows = unit == u
                since, k, first, at = where[int(u)]
                line = np.searchsorted(since, place[rows], "right") - 1
                past = place[rows] - since[line]
                sequence[rows] = first[line] + past // k[line]
                slot[rows] = at[line] + past % k[line]
            columns = [batch[name] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(slot)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
            )

    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.mapInArrow(seat, f"{PIECES}, sequence_id long, slot long")
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .drop("slot")
    )


def packed(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their sequence and offset. The pieces are stored once, so
    texts are read and encoded a single time."""
    return pack(stored(pieces(docs, vocabulary, window), "pieces"), window)
