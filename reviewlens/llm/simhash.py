"""SimHash near duplicates by covering locality-sensitive hashing.

A fingerprint bit is one if it is set in over half of the document's shingle hashes. Two
fingerprints are linked if at most ``radius`` bits differ. Bit i is given the vector
``i mod (2^(radius+1) - 1) + 1`` of radius + 1 binary digits; mask v keeps the bits whose vector has an odd
number of digits in common with v. Any ``radius`` vectors leave a v that is even with all of them,
so two fingerprints within the radius agree under at least one of the 2^(radius+1) - 1 masks: no link
is missed.

A document without words has fingerprint zero and is linked like any other; null texts have none.
Equal fingerprints are handled once. Rows may repeat; extra columns are ignored; an empty table gives
no rows. Documents with a null doc_id take part, component ids are the smallest doc_id that is not
null (null if a group has none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import components, forest, stored

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints compared at a time; a larger bucket is cut into blocks and every pair of blocks.
BLOCK = 128

_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def shingle_hashes(text: str | None, shingle: int) -> bytes:
    """Eight bytes of hash per word shingle of a text; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return b""
    # A shingle is a slice of the words joined by one space.
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-shingle]).tolist()
    return b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of the word shingles of a text."""
    hashes = shingle_hashes(text, shingle)
    n = len(hashes) // 8
    ones = np.zeros(BITS, np.int64)
    bits = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for first in range(0, n, 4096):
        ones += np.unpackbits(bits[first : first + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint as a (signed) long."""

    def run(stream):
        for batch in stream:
            values = np.array([fingerprint(text.as_py(), shingle) for text in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks, as signed longs."""
    size = 2 ** (radius + 1) - 1
    found = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i in range(BITS) if ((i % size + 1) & v).bit_count() % 2)
        found.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return found


def block_pairs(df: DataFrame, keys: list[str], member: str, block: int) -> DataFrame:
    """Adds ``low`` and ``high``: within these keys, every pair of rows meets in exactly one or, if
    both lie in one block, in several groups (low, high) of at most two blocks.

    Keys with one row are dropped. The rows grow as the square of a key's rows over ``block``.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    parts = sizes.select(*keys, F.ceil(F.col("n") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64(member, F.lit(7)), F.col("parts")).cast("int")
    return (
        df.join(parts, keys)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .drop("other", "parts")
    )


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (left, right) that join all fingerprints within the radius, of each group of copies
    by its smallest document; ``prints`` has distinct ``fingerprint`` and ``id``.

    Within a block the links found are reduced to one per fingerprint, towards the smallest
    reachable one, so a block of copies gives no more links than rows.
    """
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("kept")) for v, m in enumerate(masks(radius))]))
    dealt = prints.select("id", "fingerprint", tables.alias("at")).select("id", "fingerprint", "at.mask", "at.kept")
    met = (
        block_pairs(dealt, ["mask", "kept"], "fingerprint", block)
        .groupBy("mask", "kept", "low", "high")
        .agg(F.collect_list("id").alias("ids"), F.collect_list("fingerprint").alias("prints"))
        .where(F.size("ids") > 1)
        .select("ids", "prints")
    )

    def run(stream):
        for batch in stream:
            ids, prints = batch["ids"], batch["prints"]
            for first in range(0, batch.num_rows, 1024):
                left, right = [], []
                for at in range(first, min(first + 1024, batch.num_rows)):
                    own = ids[at].values.to_numpy()
                    bits = prints[at].values.to_numpy().view(np.uint64)
                    one, two = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius, 1))
                    if len(one):
                        order = np.argsort(own)
                        place = np.argsort(order)
                        root = own[order][forest(len(own), place[one], place[two])]
                        own = own[order]
                        left.append(own[own != root])
                        right.append(root[own != root])
                if left:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["left", "right"])

    return met.mapInArrow(run, "left long, right long")


def grouped(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every document."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "distinct")
    found = components(distinct.select("id").where("id is not null"), links(distinct.where("id is not null"), radius))
    of_print = distinct.join(found, "id", "left").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
