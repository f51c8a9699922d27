"""Byte-level byte-pair encoding and decoding of whole texts.

Each match of the split pattern is encoded separately. A segment tree over the byte positions of a
match holds the leftmost position of the smallest pair rank; a merge takes the root, joins the two
parts and updates the pairs to the left and right of the joined part on the way up, a logarithmic
number of nodes. Matches are handled in groups of similar length, one step of all their trees at a
time; a match is encoded once per task and remembered.

Null texts count as empty, which have no ids. Rows may repeat, extra columns are ignored, an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import list_array, ragged

#: Chunks of text whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Matches of more bytes go one by one.
LONG = 64
_NONE = np.int64(1) << 40
#: Between these two characters no match of the pattern crosses, whatever stands around.
_SEAM = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class PairTable:
    """Rank of the token that two neighbouring tokens form, by a sorted table of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = np.int64(max(ranks.values()) + 1)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                one, two = ranks.get(token[:cut]), ranks.get(token[cut:])
                if one is not None and two is not None:
                    keys.append(one * int(self.base) + two)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, np.int64)[order], _NONE)
        self.known = dict(zip(keys, merged)).get

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; a large number where the pair forms no token or a side is missing."""
        key = np.where((left < 0) | (right < 0), -1, left * self.base + right)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)


def merge_group(parts: list[bytes], width: int, table: PairTable) -> list[np.ndarray]:
    """Ids of byte strings of at most ``width`` bytes (a power of two).

    ``tree[:, 1]`` is the root, leaf p of a row stands at ``width + p`` and holds rank and position
    of the pair that begins at byte p, as rank * width + p: the minimum is the leftmost of the
    smallest ranks.
    """
    n = len(parts)
    lengths = np.array([len(p) for p in parts])
    ids = np.full((n, width), -1, np.int64)
    ids[np.arange(width) < lengths[:, None]] = table.byte_id[np.frombuffer(b"".join(parts), np.uint8)]
    after = np.tile(np.arange(1, width + 1), (n, 1))
    after[np.arange(n), lengths - 1] = width
    before = np.tile(np.arange(-1, width - 1), (n, 1))
    tree = np.full((n, 2 * width), _NONE * width, np.int64)
    if width > 1:
        pair = table.rank(ids[:, :-1], ids[:, 1:])
        tree[:, width:-1] = pair * width + np.arange(width - 1)
        level = width
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    row = np.flatnonzero(tree[:, 1] < _NONE * width) if width > 1 else np.arange(0)

    def put(rows, leaf, value):
        node = leaf + width
        tree[rows, node] = value
        while node[0] > 1 if len(node) else False:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair_at(rows, leaf):
        follower = after[rows, leaf]
        inside = follower < width
        right = np.where(inside, ids[rows, np.minimum(follower, width - 1)], -1)
        return table.rank(ids[rows, leaf], right) * width + leaf

    while len(row):
        top = tree[row, 1]
        left, rank = top % width, top // width
        right = after[row, left]
        ids[row, left] = rank
        ids[row, right] = -1
        beyond = after[row, right]
        after[row, left] = beyond
        some = beyond < width
        before[row[some], beyond[some]] = left[some]
        put(row, right, np.full(len(row), _NONE * width))
        put(row, left, pair_at(row, left))
        earlier = before[row, left]
        some = earlier >= 0
        if some.any():
            put(row[some], earlier[some], pair_at(row[some], earlier[some]))
        row = row[tree[row, 1] < _NONE * width]
    kept = ids >= 0
    return np.split(ids[kept].astype(np.int32), np.cumsum(kept.sum(axis=1))[:-1])


def merge_one(part: bytes, table: PairTable) -> np.ndarray:
    """The same tree for one long byte string, where a step over arrays would cost more."""
    n = len(part)
    width = 1 << (n - 1).bit_length()
    ids = table.byte_id[np.frombuffer(part, np.uint8)]
    tree = np.full(2 * width, _NONE * width, np.int64)
    tree[width : width + n - 1] = table.rank(ids[:-1], ids[1:]) * width + np.arange(n - 1)
    level = width
    while level > 1:
        level //= 2
        tree[level : 2 * level] = np.minimum(tree[2 * level : 4 * level : 2], tree[2 * level + 1 : 4 * level : 2])
    ids, tree = ids.tolist(), tree.tolist()
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    none, known, base = int(_NONE) * width, table.known, int(table.base)

    def put(leaf: int, value: int) -> None:
        node = leaf + width
        tree[node] = value
        while node > 1:
            value, other = tree[node], tree[node ^ 1]
            value = value if value < other else other
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    def pair_at(leaf: int) -> int:
        follower = after[leaf]
        rank = known(ids[leaf] * base + ids[follower]) if follower < n else None
        return none if rank is None else rank * width + leaf

    while tree[1] < none:
        rank, left = divmod(tree[1], width)
        right = after[left]
        ids[left], ids[right] = rank, -1
        after[left] = beyond = after[right]
        if beyond < n:
            before[beyond] = left
        put(right, none)
        put(left, pair_at(left))
        earlier = before[left]
        if earlier >= 0:
            put(earlier, pair_at(earlier))
    return np.array([i for i in ids if i >= 0], np.int32)


def merge_all(parts: list[bytes], table: PairTable) -> list[np.ndarray]:
    """Ids of byte strings of any length; groups of up to about a million tree nodes."""
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(parts)
    width_of = np.array([1 << max(0, len(p) - 1).bit_length() for p in parts])
    for width in np.unique(width_of):
        members = np.flatnonzero(width_of == width)
        step = max(1, (1 << 19) // int(width))
        for start in range(0, len(members), step):
            some = members[start : start + step]
            if width > LONG:
                for i in some:
                    found[i] = merge_one(parts[i], table)
                continue
            filled = [i for i in some if parts[i]]
            if filled:
                for i, ids in zip(filled, merge_group([parts[i] for i in filled], int(width), table)):
                    found[i] = ids
    return found


class Memory(dict):
    """Place of each name, new names numbered on first sight; their number arrays, end to end."""

    def __init__(self):
        super().__init__()
        self.new: list = []
        self.values, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, name):
        self[name] = place = len(self)
        self.new.append(name)
        return place

    def places(self, lists: list[list]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, names) for names in lists), np.int64)

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Arrays of the new names, in their order."""
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(lengths))
        self.values = np.append(self.values, values)
        self.new = []

    def at(self, places: np.ndarray, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Values at all places, and how many each list has."""
        starts = self.ends[places]
        lengths = self.ends[places + 1] - starts
        reached = np.append(0, np.cumsum(lengths))
        return ragged(self.values, starts, lengths), np.diff(reached[np.append(0, np.cumsum(list(map(len, lists)), dtype=np.int64))])


class Encoder:
    """Ids of texts, with the chunks between seams and the matches in them remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.split = regex.compile(pattern)
        self.table = PairTable(ranks)
        self.chunks, self.matches = Memory(), Memory()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many each text has."""
        if len(self.chunks) > REMEMBERED:
            self.chunks, self.matches = Memory(), Memory()
        lists = []
        for text in texts:
            plain = not ("  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text))
            names: list = text.split(" ") if plain else _SEAM.split(text)
            names[0] = (names[0],)  # no space before it
            lists.append(names)
        places = self.chunks.places(lists)
        if self.chunks.new:
            found = [self.split.findall(name[0] if isinstance(name, tuple) else " " + name) for name in self.chunks.new]
            inner = self.matches.places(found)
            if self.matches.new:
                merged = merge_all([match.encode("utf-8") for match in self.matches.new], self.table)
                self.matches.add(np.concatenate(merged), np.array(list(map(len, merged))))
            self.chunks.add(*self.matches.at(inner, found))
        return self.chunks.at(places, lists)


def _ranks(docs: DataFrame, vocabulary: str | None):
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text."""
    import public_tokenizers

    lines, pattern = _ranks(docs, vocabulary), pattern or public_tokenizers.PATTERN

    def run(stream):
        encoder = Encoder(read_ranks(lines.value), pattern)
        for batch in stream:
            for first in range(0, batch.num_rows, 128):
                some = batch.slice(first, 128)
                ids, lengths = encoder.encode([text or "" for text in some["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([some["doc_id"], list_array(ids, lengths, pa.int32())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Adds ``content``: the bytes that the ids stand for (null ids: null)."""
    lines = _ranks(encoded, vocabulary)

    def run(stream):
        ranks = read_ranks(lines.value)
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        starts = np.cumsum(lengths) - lengths
        content = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        for batch in stream:
            for first in range(0, batch.num_rows, 128):
                some = batch.slice(first, 128)
                column = some["ids"]
                ids = column.flatten().to_numpy(zero_copy_only=False)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.append(0, np.cumsum(lengths[ids]))[np.append(0, np.cumsum(counts))]
                data = ragged(content, starts[ids], lengths[ids]).tobytes()
                values = [data[a:b] for a, b in zip(ends[:-1], ends[1:])]
                empty = column.is_null().to_pylist()
                binary = pa.array([None if no else value for no, value in zip(empty, values)], pa.binary())
                yield pa.RecordBatch.from_arrays([some["doc_id"], column, binary], names=["doc_id", "ids", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, content binary")
