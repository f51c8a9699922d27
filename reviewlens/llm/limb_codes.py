"""Vector codes: every part of an integer vector is replaced by its nearest codebook entry.

Components become integers, vectors are cut into equal consecutive parts, and each part position has
a codebook that starts as that part of the vectors with the smallest ids and moves to the floors of
its members' means, round by round. All distances are exact: integers are broken into limbs so
short that the double-precision product of two limb matrices stays below 2^53, the dot products are
recombined in 64-bit integers, and the first smallest distance wins.

Spark deals out the vectors; a task sends one row per used entry (count and component sums), Spark
adds these up, and only the codebooks, whose size is fixed by the parameters, come to the driver and
go out again. Integers too large for 64-bit distances are handled by unbounded integers instead,
their sums as limbs of 32 bits; an error too large for a long is null, and so is its label's.

Null vectors and vectors with null or non-finite components are dropped. Vectors of each length have
codebooks of their own; a length that the parts do not divide is cut at the rounded-down marks. Equal
ids start in the order of their vectors, null ids last. With fewer vectors than entries the codebooks
are smaller. Rows may repeat, null labels are one label, extra columns are ignored, an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors compared at a time.
BLOCK = 1024
#: Rows of one label are dealt over this many groups when they look up the label's sum.
SPREAD = 32
_WORD = (1 << 32) - 1


def limb_bits(width: int) -> int:
    """Bits of a limb, so that a sum of ``width`` products of two limbs stays below 2^53."""
    return (53 - math.ceil(math.log2(max(1, width)))) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Doubles whose sum, the i-th shifted left by i * bits, is ``values``; only the last is signed."""
    found = []
    while values.size and (values.min() < -(1 << (bits - 1)) or values.max() >= 1 << (bits - 1)):
        found.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*found, values.astype(np.float64)]


def exact_dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of the rows of ``left`` (..., n, width) and ``right`` (..., m, width), int64."""
    bits = limb_bits(left.shape[-1])
    total = np.zeros((*left.shape[:-1], right.shape[-2]), np.int64)
    shorter = limbs(right, bits)
    for i, one in enumerate(limbs(left, bits)):
        for j, two in enumerate(shorter):
            total += np.matmul(one, np.swapaxes(two, -1, -2)).astype(np.int64) << (bits * (i + j))
    return total


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry and squared distance of rows (n, width), int64 or unbounded integers."""
    if rows.dtype == object:
        apart = ((rows[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2) if rows.shape[1] else np.zeros((len(rows), len(entries)), object)
        return apart.argmin(axis=1), apart.min(axis=1)
    apart = (entries * entries).sum(axis=1) - 2 * exact_dots(rows, entries)
    first = apart.argmin(axis=1)
    return first, apart[np.arange(len(rows)), first] + (rows * rows).sum(axis=1)


def integers(column: pa.Array, scale: int, wide: bool) -> np.ndarray:
    """Floors of the scaled components, a row per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if wide:
        values = np.array([math.floor(Fraction(x) * scale) for x in flat.tolist()] + [0], object)[:-1]
    else:
        values = np.floor(flat * scale).astype(np.int64)
    return values.reshape(len(column), -1) if len(values) else values.reshape(len(column), 0)


class Codebooks:
    """Entries of every part of vectors of one length; the values are Python integers or int64."""

    def __init__(self, first: np.ndarray, parts: int, scale: int, wide: bool):
        marks = [first.shape[1] * p // parts for p in range(parts + 1)]
        self.cuts = [slice(a, b) for a, b in zip(marks, marks[1:])]
        self.entries = [first[:, cut] for cut in self.cuts]
        self.scale, self.wide = scale, wide

    def sha256(self) -> str:
        decimal = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(decimal.encode()).hexdigest()

    def assigned(self, column: pa.Array):
        """Blocks of (integers, entry of each part, summed squared distances)."""
        for start in range(0, len(column), BLOCK):
            rows = integers(column.slice(start, BLOCK), self.scale, self.wide)
            found = [nearest(rows[:, cut], entries) for cut, entries in zip(self.cuts, self.entries)]
            yield rows, np.stack([at for at, _ in found], axis=1), sum(apart for _, apart in found)

    def moved(self, vectors: DataFrame, words: int) -> None:
        """One round: every used entry becomes the floor of its members' mean."""
        size = len(self.entries[0])
        widest = max(cut.stop - cut.start for cut in self.cuts)
        names = [f"s{i}" for i in range(widest * words)]
        books = vectors.sparkSession.sparkContext.broadcast(self)

        def sums(stream):
            known = books.value
            counts = np.zeros((len(known.cuts), size), np.int64)
            totals = np.zeros((len(known.cuts), size, widest), object if known.wide else np.int64)
            for batch in stream:
                for rows, at, _ in known.assigned(batch["embedding"]):
                    for part, cut in enumerate(known.cuts):
                        np.add.at(totals[part, :, : cut.stop - cut.start], at[:, part], rows[:, cut])
                        counts[part] += np.bincount(at[:, part], minlength=size)
            part, entry = np.nonzero(counts)
            used = totals[part, entry].astype(object)
            low = [(used >> (32 * word)) & _WORD for word in range(words - 1)] + [used >> (32 * (words - 1))]
            columns = [pa.array(low[word][:, at].tolist(), pa.int64()) for at in range(widest) for word in range(words)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part * size + entry, pa.int32()), pa.array(counts[part, entry]), *columns], names=["slot", "n", *names]
            )

        schema = "slot int, n long" + "".join(f", {name} long" for name in names)
        found = vectors.select("embedding").mapInArrow(sums, schema)
        for row in found.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in names]).collect():
            part, entry = divmod(row["slot"], size)
            for at in range(self.entries[part].shape[1]):
                total = sum(row[f"s{at * words + word}"] << (32 * word) for word in range(words))
                self.entries[part][entry, at] = total // row["n"]


def _coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    digest = books.sha256()

    def run(stream):
        for batch in stream:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                for _, at, apart in shared.value.assigned(some["embedding"]):
                    codes = np.ascontiguousarray(at.astype(np.uint8))
                    errors = [int(x) if x < 1 << 63 else None for x in apart.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [some["vec_id"], some["label"], pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(errors, pa.int64())],
                        names=["vec_id", "label", "code", "error"],
                    )

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {kind}, code binary, error long").withColumn("codebooks_sha256", F.lit(digest))


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, label, ``code`` (a byte per part), ``error``, ``label_error`` (errors summed over the
    label) and ``codebooks_sha256`` of every vector that is kept; columns vec_id, embedding, label."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number must fit in a byte")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label").where(
        F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    sizes = kept.groupBy(F.size("embedding").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("embedding", F.abs))).alias("largest")
    )
    found = []
    for size, n, largest in sizes.orderBy("size").collect():
        own = kept.where(F.size("embedding") == size)
        top = math.ceil(Fraction(largest or 0.0) * scale) + 1
        wide = max(1, size) * (2 * top) ** 2 >= 1 << 62
        words = 1 if top * n < 1 << 62 else (top * n).bit_length() // 32 + 1
        first = own.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
        books = Codebooks(integers(pa.array([row[0] for row in first], pa.list_(pa.float64())), scale, wide), parts, scale, wide)
        for _ in range(rounds):
            books.moved(own, words)
        found.append(_coded(own, books))
    if not found:
        empty = kept.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit("")}).where("false")
    coded = stored(reduce(DataFrame.union, found), "codes")
    sums = (
        coded.groupBy("label")
        .agg(F.when(F.count_if(F.col("error").isNull()) == 0, F.try_sum("error")).alias("label_error"))
        .select(F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("of_part"))
    )
    dealt = coded.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(SPREAD)).cast("int"))
    both = F.col("label").eqNullSafe(F.col("of_label")) & (F.col("part") == F.col("of_part"))
    return dealt.join(sums, both).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


_SQL = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), coords AS (
  SELECT k, (i - 1) // (len(embedding) // 16) AS p, (i - 1) % (len(embedding) // 16) AS j,
    CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT k, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), c0 AS (SELECT p, k - 1 AS e, j, x FROM coords WHERE k <= 64)
{rounds}
, last AS (
  SELECT k, p, min(d * 64 + e) AS m FROM (
    SELECT k, p, e, CAST(sum((coords.x - c.x) * (coords.x - c.x)) AS BIGINT) AS d
    FROM coords JOIN c2 AS c USING (p, j) GROUP BY k, p, e) GROUP BY k, p
), scored AS (
  SELECT k, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error
  FROM last GROUP BY k
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM c2) AS codebooks_sha256
FROM kept JOIN scored USING (k)
"""

_ROUND = """, near{to} AS (
  SELECT k, p, min(d * 64 + e) % 64 AS e FROM (
    SELECT k, p, e, CAST(sum((coords.x - c.x) * (coords.x - c.x)) AS BIGINT) AS d
    FROM coords JOIN c{of} AS c USING (p, j) GROUP BY k, p, e) GROUP BY k, p
), sum{to} AS (
  SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM coords JOIN near{to} USING (k, p) GROUP BY p, e, j
), c{to} AS (
  SELECT c.p, c.e, c.j, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n + n) % n)) // n END AS x
  FROM c{of} AS c LEFT JOIN sum{to} AS u ON u.p = c.p AND u.e = c.e AND u.j = c.j
)"""
#: DuckDB SQL for the query's rows, for vectors of one length that the parts divide.
SQL = _SQL.format(rounds="".join(_ROUND.format(of=i, to=i + 1) for i in range(ROUNDS)))
