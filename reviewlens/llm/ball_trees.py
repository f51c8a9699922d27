"""Exact ranked lexical search by sparse ball trees.

A document is a sparse vector of whole numbers, its terms' saturated frequencies; an item is the
vector of its terms' weights; the score is their inner product. Documents are cut into trees of
bounded size. A node holds the mean of its documents and the largest distance from it, so no document
below it scores more than the item's product with the mean plus the item's length times that radius,
where terms that no document of the node holds are left out of the length. Sums of doubles are
widened by a bound of their rounding error, so a bound is never too low. Subtrees are taken best
first until the best bound left is below the k-th score found; leaves are scored in 64-bit integers.

Spark reads each text once per block of items: terms of the block's items are counted and stored,
document counts come from a grouped sum, and each task then builds its trees one by one, keeping k
documents per item, which also prune its later trees. Only the items' terms, cut into blocks of
bounded size, are collected and broadcast. The tasks' rows are cut to k in two steps, so no item
gathers all of them in one task.

Null and empty texts have no terms: such documents only fail to count, such items have no rows.
Items and documents that repeat are rows of their own; null doc_ids rank last among equal scores.
Very long texts need memory for themselves and their own terms. Extra columns are ignored; an
empty table on either side gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import list_array, ragged, stored

TOP = 10
#: Documents of a leaf, and of a tree, which is closed earlier at this many terms of documents.
LEAF = 64
TREE = 2048
TREE_TERMS = 400_000
#: Terms of items that one block of items holds, roughly.
ITEM_TERMS = 500_000
#: First-step groups that an item's found documents are dealt over.
SPREAD = 64

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
).translate(bytes.maketrans(_UPPER, _LOWER))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and everything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


class Tree:
    """Ball tree over documents given as rows of (columns, values); every row has an entry.

    Nodes are numbered in the order they are made; node i covers the documents
    ``order[first[i]:last[i]]``, whose entries stand in that order after building.
    """

    def __init__(self, columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, leaf: int = LEAF):
        self.own, columns = np.unique(columns, return_inverse=True)
        starts = np.cumsum(lengths) - lengths
        squares = np.add.reduceat((values * values).astype(np.float64), starts)
        # Rounding of a sum of so many products, relative to the product of the lengths.
        self.rounding = 2.3e-16 * (len(self.own) + 8)
        order = np.arange(len(lengths))
        self.first, self.last, self.children, radii, means = [0], [len(lengths)], [None], [], []
        node = 0
        while node < len(self.first):
            rows = order[self.first[node] : self.last[node]]
            at = ragged(columns, starts[rows], lengths[rows])
            value = ragged(values, starts[rows], lengths[rows]).astype(np.float64)
            row = np.repeat(np.arange(len(rows)), lengths[rows])
            mean = np.bincount(at, value, len(self.own)) / len(rows)

            def products(vector):
                return np.bincount(row, value * vector[at], len(rows))

            def dense(which):
                return np.bincount(at[row == which], value[row == which], len(self.own))

            size = float(mean @ mean)
            apart = np.maximum(squares[rows] - 2 * products(mean) + size, 0.0)
            slack = 4 * self.rounding * (squares[rows].max() + size)
            radii.append(math.sqrt(apart.max() + slack) * (1 + 1e-12))
            means.append(mean)
            if len(rows) > leaf:
                one = dense(apart.argmax())
                two = dense((squares[rows] - 2 * products(one)).argmax())
                half = len(rows) // 2
                order[self.first[node] : self.last[node]] = rows[np.argpartition(products(two - one), half)]
                middle = self.first[node] + half
                self.children[node] = (len(self.first), len(self.first) + 1)
                self.first += [self.first[node], middle]
                self.last += [middle, self.last[node]]
                self.children += [None, None]
            node += 1
        self.order, self.radii, self.means = order, np.array(radii), np.array(means).T.copy()
        self.columns, self.values = ragged(columns, starts[order], lengths[order]), ragged(values, starts[order], lengths[order])
        self.ends = np.append(0, np.cumsum(lengths[order]))

    def bounds(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node, at least the largest score below it."""
        means = self.means[at]
        weight = weights.astype(np.float64)
        length = np.sqrt((weight * weight) @ (means > 0))
        return (weight @ means + length * self.radii) * (1 + 4 * self.rounding) + 1

    def scores(self, node: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a leaf and their exact scores; ``weight`` of every column."""
        first, last = self.first[node], self.last[node]
        a, b = self.ends[first], self.ends[last]
        products = weight[self.columns[a:b]] * self.values[a:b]
        return self.order[first:last], np.add.reduceat(products, self.ends[first:last] - a)

    def search(self, at: np.ndarray, weights: np.ndarray, best: list, k: int, key) -> int:
        """Adds to ``best``, a heap of up to k (score, -key(document), ...); leaves visited.

        ``at`` and ``weights`` are the item's terms among the tree's columns.
        """
        bounds = self.bounds(at, weights).tolist()
        weight = np.zeros(len(self.own), np.int64)
        weight[at] = weights
        open_nodes, visited = [(-bounds[0], 0)], 0
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if len(best) == k and -bound < best[0][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(open_nodes, (max(bound, -bounds[child]), child))
                continue
            visited += 1
            documents, scores = self.scores(node, weight)
            least = best[0][0] if len(best) == k else 1
            for which in np.flatnonzero(scores >= max(least, 1)).tolist():
                found = (int(scores[which]), *key(int(documents[which])))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return visited


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (its terms), ``terms`` and ``counts`` of those in the vocabulary, by place there."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(stream):
        place = {term: at for at, term in enumerate(shared.value)}
        for batch in stream:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                sizes, lengths, at, tf = [], [], [], []
                for text in some["text"]:
                    found = terms(text.as_py())
                    sizes.append(len(found))
                    known = [(place[term], n) for term, n in Counter(found).items() if term in place]
                    lengths.append(len(known))
                    at += [p for p, _ in known]
                    tf += [n for _, n in known]
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], pa.array(sizes, pa.int64()), list_array(np.array(at, np.int32), lengths, pa.int32()), list_array(np.array(tf, np.int64), lengths, pa.int64())],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def _found(index: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """(row, doc_id, score): for every task and item, the task's k best documents."""
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def run(stream):
        items, weights = shared.value
        best: list[list] = [[] for _ in items]

        def plant(ids, sizes, at, tf, lengths):
            some = lengths > 0
            if not some.any():
                return
            inside = np.repeat(some, lengths)
            ids = [i for i, keep in zip(ids, some.tolist()) if keep]
            size = np.array([10 + 90 * n * documents // total for n, keep in zip(sizes, some.tolist()) if keep], np.int64)
            at, tf, lengths = at[inside], tf[inside], lengths[some]
            tree = Tree(at, 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(size, lengths)), lengths)
            # Null ids rank last.
            keys = [(-i, i) if i is not None else (-(1 << 63), i) for i in ids]
            for heap, (_, own) in zip(best, items):
                place = np.searchsorted(tree.own, own)
                place[place == len(tree.own)] = 0
                known = tree.own[place] == own
                if known.any():
                    tree.search(place[known], weights[own[known]], heap, k, keys.__getitem__)

        held: list[tuple] = []
        for batch in stream:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                held.append(
                    (
                        some["doc_id"].to_pylist(),
                        some["n"].to_pylist(),
                        some["terms"].flatten().to_numpy().astype(np.int64),
                        some["counts"].flatten().to_numpy(),
                        some["terms"].value_lengths().to_numpy().astype(np.int64),
                    )
                )
                if sum(len(h[0]) for h in held) >= TREE or sum(len(h[2]) for h in held) >= TREE_TERMS:
                    plant(sum((h[0] for h in held), []), sum((h[1] for h in held), []), *(np.concatenate([h[i] for h in held]) for i in (2, 3, 4)))
                    held = []
        if held:
            plant(sum((h[0] for h in held), []), sum((h[1] for h in held), []), *(np.concatenate([h[i] for h in held]) for i in (2, 3, 4)))
        for heap, (row, _) in zip(best, items):
            if heap:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(heap), pa.int64()), pa.array([f[2] for f in heap], pa.int64()), pa.array([f[0] for f in heap], pa.int64())],
                    names=["row", "doc_id", "score"],
                )

    return index.select("doc_id", "n", "terms", "counts").mapInArrow(run, "row long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_terms: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents (doc_id, text) with the highest scores
    above 0 for every item (item_id, text)."""

    def split(stream):
        for batch in stream:
            found = [sorted(set(terms(text.as_py()))) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    asked = items.select(F.col("item_id").cast("long"), "text").mapInArrow(split, "item_id long, terms array<binary>")
    asked = stored(asked.where(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(size / item_terms)
    found = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms").collect()
        vocabulary = sorted({bytes(term) for _, held in own for term in held})
        place = {term: at for at, term in enumerate(vocabulary)}
        index = stored(counted(docs, vocabulary), "terms")
        documents, total = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not documents:
            continue
        held_by = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * held_by.get(at, 0) + 1))) for at in range(len(vocabulary))], np.int64)
        wanted = [(row, np.array([place[bytes(term)] for term in held], np.int64)) for row, held in own]
        found.append(_found(index, wanted, weights, documents, total, k))
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    best = reduce(DataFrame.union, found).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    for keys in (["row", "part"], ["row"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), b AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark
), whole AS (
  SELECT CAST(count(*) FILTER (len(ts) > 0) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d
), freq AS (
  SELECT r, doc_id, t, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY r, doc_id, t
), weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM freq, whole GROUP BY t
), asked AS (SELECT DISTINCT i, item_id, t FROM (SELECT i, item_id, unnest(ts) AS t FROM b)
), scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN freq USING (t) JOIN weight USING (t), whole GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
