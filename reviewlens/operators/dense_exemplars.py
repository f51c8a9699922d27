"""Affinity propagation over all pairs of a user's places, without a message that cannot count.

Every place may follow every other place of its user, at minus the distance in miles times its visits;
being an exemplar costs the median distance between two visits at different places. That definition
has a message per pair, so its work grows with the square of a user's places.

Users of up to ``BLOCK`` places meet in matrices within a task, after one shuffle of their places: medians,
costs and all rounds, users of one size together. No pair or message of theirs leaves the task. Tables hold
coordinates only: unit vectors follow from them and are neither stored nor shuffled for these users.

For larger users pairs appear behind joins of places with blocks of places and are filtered or summed where
they appear; only those that can matter are shuffled, as messages. A bound proves which cannot. With ``p`` the
cost of being an exemplar, at any time and damped or not,

* ``a + s`` of the pair (i, k) is at most ``s(i, k)``, as a place offers others at most zero,
* for i itself it is at least ``p``, as a place's own availability is never below zero, and
* for the nearest place k of i it is at least ``s(i, k) + p``, as ``r(k, k)`` is never below ``p``.

So a pair with ``s(i, k) < s(i, nearest) + p`` is never first nor second of its row, moves no other
message, has no positive responsibility and backs no one: leaving it out changes no exemplar. What
remains are the pairs up to about the median distance, with a margin for rounding.

Places without user, id or coordinates are left out. A user with one place has it as exemplar; an
empty table gives no rows; other columns are ignored. (user_id, place_id) must be unique, as
:func:`reviewlens.operators.visits.user_places` gives them; equal coordinates under two ids are two places.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from reviewlens.functions import geo, geo_arrays
from reviewlens.operators import whole_users
from reviewlens.operators.affinity_rounds import exemplar_sites
from reviewlens.operators.scale import cut_lineage, group_sizes, width_for

BLOCK = 1024  # places that meet a place in one row; users of no more take matrices
PAIRS = 2_000_000  # pairs a task opens
_PAIRS_IN_MATRICES = 20_000_000  # pairs whose rounds a task runs
_TOGETHER = 50_000  # pairs in the matrices of users that take their rounds together
_LOOK = 5  # rounds after which settled users leave
_ALONE = -1e9  # stands for "no rival" where a user has one place
_LEAST_SPREAD = 0.01
_STEPS = 32.0  # steps per unit of the logarithm in which the median is looked for first
_DIGITS = 6  # of a mile, in which the median is exact
_MARGIN = 1e-5


def spots(places: DataFrame, block: int | None = None) -> DataFrame:
    """Places with unit vectors, dealt over ``parts`` blocks of their user, written out."""
    known = places.select("user_id", F.col("place_id").alias("site"), "latitude", "longitude", "visits")
    return in_blocks(cut_lineage(known.dropna(subset=["user_id", "site", "latitude", "longitude"])), block)


def in_blocks(known: DataFrame, block: int | None = None) -> DataFrame:
    """What :func:`spots` gives, of written places that all have a user, site and coordinates."""
    block = block or BLOCK
    sizes = group_sizes(known, "user_id").where(F.col("group_rows") > block)
    large = cut_lineage(sizes.select("user_id", F.ceil(F.col("group_rows") / block).cast("int").alias("parts")))
    if large.isEmpty():
        return geo.with_vector(known.withColumns({"parts": F.lit(1), "part": F.lit(0)}))
    dealt = known.join(large, "user_id", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("site"), F.col("parts")).cast("int")
    return geo.with_vector(cut_lineage(dealt.withColumn("part", part)))


def _stored(rows: DataFrame) -> DataFrame:
    """Rows without what follows from their coordinates."""
    return rows.drop("vx", "vy", "vz")


def _width(followers: DataFrame, each: int) -> int:
    """Partitions for the pairs of these places: few rows open into many, so their number counts."""
    sizes = followers.groupBy("user_id").agg(F.count("*").alias("n"))
    pairs = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0
    least = int(followers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(pairs / each))


def _pairs(followers: DataFrame, leaders: DataFrame, *also: str) -> DataFrame:
    """(user_id, i, k, visits, met, miles) of every place and every other place of its user, as a
    stream: places meet the blocks of leaders, a row per block, which is opened behind the join.
    ``also`` names columns of the followers to take along, so that no pair is joined again."""
    members = F.struct(F.col("site").alias("k"), F.col("visits").alias("met"), *(f"v{axis}" for axis in "xyz"))
    blocks = leaders.groupBy("user_id", "part").agg(F.collect_list(members).alias("members"))
    left = followers.select(
        "user_id",
        F.col("site").alias("i"),
        "visits",
        *also,
        *(F.col(f"v{axis}").alias(f"a{axis}") for axis in "xyz"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    ).repartition(_width(followers, PAIRS), "user_id", "part")
    distance = geo.miles_between(geo.vector_columns("a"), geo.vector_columns("v"))
    return (
        left.join(blocks, ["user_id", "part"])
        .select("user_id", "i", "visits", *also, "ax", "ay", "az", F.explode("members").alias("member"))
        .select("user_id", "i", "visits", *also, "ax", "ay", "az", "member.*")
        .where(F.col("i") != F.col("k"))
        .select("user_id", "i", "k", "visits", "met", *also, distance.alias("miles"))
    )


def candidates(spots: DataFrame) -> DataFrame:
    """(user_id, i, k, visits, miles, weight): every place and every other place of its user, ``weight``
    the pairs of their visits."""
    weight = (F.col("visits") * F.col("met")).alias("weight")
    return _pairs(spots, spots).select("user_id", "i", "k", "visits", "miles", weight)


def _step() -> Column:
    return F.round(F.ln(F.greatest("miles", F.lit(_LEAST_SPREAD))) * _STEPS).cast("int")


def _reached(counts: DataFrame, by: str, weight: str = "weight") -> DataFrame:
    """Rows of ``counts`` with ``upto``, the weight up to and with them, and the user's ``total``."""
    user = Window.partitionBy("user_id")
    return counts.withColumns(
        {"upto": F.sum(weight).over(user.orderBy(by)), "total": F.sum(weight).over(user)}
    )


def profiles(spots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per place (user_id, site, nearest, cost): the distance to the nearest other place, and the
    miles of all other visits to it. Per user (user_id, spread): the median distance.

    Distances are counted in logarithmic steps first; the step that holds the median is then
    counted to ``_DIGITS`` digits of a mile, so the windows see counts, not pairs.
    """
    seen = cut_lineage(
        _pairs(spots, spots).groupBy("user_id", "i", _step().alias("step")).agg(
            F.min("miles").alias("nearest"),
            F.sum(F.col("visits") * F.col("met")).alias("weight"),
            F.sum(F.col("met") * F.col("miles")).alias("cost"),
        )
    )
    sites = seen.groupBy("user_id", F.col("i").alias("site")).agg(
        F.min("nearest").alias("nearest"), F.sum("cost").alias("cost")
    )
    steps = _reached(seen.groupBy("user_id", "step").agg(F.sum("weight").alias("weight")), "step")
    middle = cut_lineage(
        steps.where("upto * 2 >= total")
        .groupBy("user_id")
        .agg(F.min_by(F.struct("step", "total", (F.col("upto") - F.col("weight")).alias("below")), "step").alias("m"))
        .select("user_id", "m.*")
    )
    fine = (
        _pairs(spots.join(middle, "user_id"), spots, "step", "total", "below")
        .where(_step() == F.col("step"))
        .groupBy("user_id", F.round("miles", _DIGITS).alias("spread"), "total", "below")
        .agg(F.sum(F.col("visits") * F.col("met")).alias("weight"))
    )
    upto = F.sum("weight").over(Window.partitionBy("user_id").orderBy("spread")) + F.col("below")
    medians = (
        fine.select("user_id", "spread", (upto * 2 >= F.col("total")).alias("half"))
        .where("half")
        .groupBy("user_id")
        .agg(F.min("spread").alias("spread"))
    )
    return sites, medians


def _apart(spots: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of users with one block, and of those with several if there are any."""
    large = spots.where("parts > 1")
    return spots.where("parts = 1"), None if large.isEmpty() else large


def preferences(spots: DataFrame) -> DataFrame:
    """The spots with ``nearest``, ``cost`` and ``spread``, written out; zero, zero and the least
    spread for places without others."""
    ordinary, large = _apart(spots)
    found = _profiles_of_whole_users(ordinary)
    if large is not None:
        found = found.unionByName(_stored(_profiles_by_joins(large)))
    return geo.with_vector(cut_lineage(found))


def _profiles_by_joins(spots: DataFrame) -> DataFrame:
    sites, medians = profiles(spots)
    least = F.lit(_LEAST_SPREAD)
    return (
        spots.join(sites, ["user_id", "site"], "left")
        .join(medians, "user_id", "left")
        .withColumns(
            {
                "nearest": F.coalesce("nearest", F.lit(0.0)),
                "cost": F.coalesce("cost", F.lit(0.0)),
                "spread": F.greatest(F.coalesce("spread", least), least),
            }
        )
    )


def _dealt(rows: DataFrame, *order: str, sized: DataFrame | None = None) -> DataFrame:
    """Whole users in the partitions, sorted by site, with unit vectors. ``sized`` are rows to take the
    width from, where they are not the same."""
    like = rows if sized is None else sized
    width = max(width_for(like), _width(like, _PAIRS_IN_MATRICES))
    dealt = _stored(rows).repartition(width, "user_id").sortWithinPartitions("user_id", "site", *order)
    return geo.with_vector(dealt)


class _Users:
    """Some whole users of a task, their columns as arrays."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.at = tuple(whole_users.numbers(table, f"v{axis}") for axis in "xyz")
        self.visits = whole_users.numbers(table, "visits")

    def alike(self) -> Iterator[np.ndarray]:
        """Row numbers, a line per user, of users with equally many places."""
        starts = whole_users.starts_of(self.table, "user_id")
        sizes = np.diff(np.append(starts, self.table.num_rows))
        for size in np.unique(sizes):
            firsts, few = starts[sizes == size], max(1, _TOGETHER // int(size) ** 2)
            for first in range(0, len(firsts), few):
                yield firsts[first : first + few, None] + np.arange(size)

    def miles(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances as a matrix per user, and of each two places once with their pairs of visits."""
        one, other = np.triu_indices(rows.shape[1], 1)
        i, k = rows[:, one], rows[:, other]
        once = geo_arrays.miles(self.at, i.ravel(), k.ravel()).reshape(i.shape)
        whole = np.zeros((*rows.shape, rows.shape[1]))
        whole[:, one, other] = whole[:, other, one] = once
        return whole, once, self.visits[i] * self.visits[k]

    def similarities(self, rows: np.ndarray, miles: np.ndarray, spread: np.ndarray) -> np.ndarray:
        s = -miles * self.visits[rows][:, :, None]
        own = np.arange(rows.shape[1])
        tilt = whole_users.numbers(self.table, "tilt")[rows]
        s[:, own, own] = -spread[:, None] * (tilt + 1.0)
        return s


def _medians(miles: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighted median of each line, to ``_DIGITS`` digits, and the least spread at least."""
    if not miles.shape[1]:
        return np.full(len(miles), _LEAST_SPREAD)
    order = np.argsort(miles, axis=1)
    upto = np.cumsum(np.take_along_axis(weight, order, 1), axis=1)
    middle = np.argmax(upto * 2 >= upto[:, -1:], axis=1)
    line = np.arange(len(miles))
    digits = Decimal(1).scaleb(-_DIGITS)
    found = miles[line, order[line, middle]].tolist()
    rounded = [float(Decimal(repr(m)).quantize(digits, ROUND_HALF_UP)) for m in found]
    return np.maximum(rounded, _LEAST_SPREAD)


def _profiles_of_whole_users(spots: DataFrame) -> DataFrame:
    """What :func:`_profiles_by_joins` gives, for users that fit into a task."""
    names = ("nearest", "cost", "spread")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_users.whole(batches):
            users = _Users(table)
            found = {name: np.zeros(table.num_rows) for name in names}
            for rows in users.alike():
                miles, once, weight = users.miles(rows)
                found["cost"][rows] = (miles * users.visits[rows][:, None, :]).sum(axis=2)
                found["spread"][rows] = _medians(once, weight)[:, None]
                if rows.shape[1] > 1:
                    own = np.arange(rows.shape[1])
                    miles[:, own, own] = np.inf
                    found["nearest"][rows] = miles.min(axis=2)
            table = table.select(kept.names)
            for name in names:
                table = table.append_column(name, pa.array(found[name]))
            yield from table.combine_chunks().to_batches()

    kept = _stored(spots).schema
    schema = StructType([*kept.fields, *(StructField(name, DoubleType()) for name in names)])
    return _dealt(spots).mapInArrow(run, schema)


def _rounds(s: np.ndarray, damping: float, max_rounds: int, settle_rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(exemplars, settled) of users of one size, a matrix of similarities each: the rounds of the sparse
    form, with every message. Sums go over the followers in their order, as they do there."""
    exemplars, settled = np.zeros(s.shape[:2], bool), np.zeros(len(s), bool)
    left, own = np.arange(len(s)), np.arange(s.shape[1])
    r, a = np.zeros_like(s), np.zeros_like(s)
    held, chosen = np.zeros(s.shape[:2], int), np.zeros(s.shape[:2], bool)
    for number in range(1, max_rounds + 1):
        user = np.arange(len(s))[:, None]
        v = a + s
        first = v.argmax(axis=2)
        best = v[user, own, first]
        v[user, own, first] = _ALONE
        second = v.max(axis=2)
        new = np.subtract(s, best[:, :, None], out=v)
        new[user, own, first] = s[user, own, first] - second
        new *= 1.0 - damping
        r *= damping
        r += new
        backing = np.maximum(r, 0.0, out=new)
        backing[:, own, own] = r[:, own, own]
        others = np.subtract(backing.sum(axis=1)[:, None, :], backing, out=backing)
        offered = others[:, own, own]
        offer = np.minimum(others, 0.0, out=others)
        offer[:, own, own] = offered
        offer *= 1.0 - damping
        a *= damping
        a += offer
        now = a[:, own, own] + r[:, own, own] > 0
        held = np.where(now == chosen, held + 1, 1)
        chosen = now
        if number % _LOOK:
            continue
        done = (held.min(axis=1) >= settle_rounds) & chosen.any(axis=1)
        if done.any():
            exemplars[left[done]], settled[left[done]] = chosen[done], True
            left, s, r, a, held, chosen = (of[~done] for of in (left, s, r, a, held, chosen))
            if not len(left):
                break
    exemplars[left] = chosen
    return exemplars, settled


def _exemplars_of_whole_users(rows: DataFrame, damping: float, max_rounds: int, settle_rounds: int) -> DataFrame:
    """Rows of exemplar places with ``settled``, for users that fit into a task. ``spread`` is found where the
    rows have none."""
    known = "spread" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_users.whole(batches):
            users = _Users(table)
            leads, settled = np.zeros(table.num_rows, bool), np.zeros(table.num_rows, bool)
            for at in users.alike():
                miles, once, weight = users.miles(at)
                spread = whole_users.numbers(table, "spread")[at[:, 0]] if known else _medians(once, weight)
                s = users.similarities(at, miles, spread)
                leads[at], done = _rounds(s, damping, max_rounds, settle_rounds)
                settled[at] = done[:, None]
            found = table.select(kept.names).append_column("settled", pa.array(settled))
            yield from found.filter(pa.array(leads)).combine_chunks().to_batches()

    kept = _stored(rows).schema
    schema = StructType([*kept.fields, StructField("settled", BooleanType())])
    return _dealt(rows).withColumn("tilt", _tilt()).mapInArrow(run, schema)


def _tilt() -> Column:
    """A millionth at most, which breaks ties between places."""
    return F.pmod(F.xxhash64("user_id", "site"), F.lit(1_000_000)) / 1e12


def _own() -> Column:
    """Similarity of a place to itself."""
    return -F.col("spread") * (_tilt() + 1.0)


def similarities(known: DataFrame, prune: bool = True) -> DataFrame:
    """(user_id, i, k, s) of the pairs that can matter, or of all, over what :func:`preferences` gives."""
    own = known.select("user_id", F.col("site").alias("i"), F.col("site").alias("k"), _own().alias("s"))
    reach = (F.col("nearest") * F.col("visits") + F.col("spread")) * (1.0 + _MARGIN)
    pairs = _pairs(known.withColumn("bound", -reach), known, "bound").withColumn("s", -F.col("miles") * F.col("visits"))
    if prune:
        pairs = pairs.where("s >= bound")
    return own.union(pairs.select("user_id", "i", "k", "s"))


def net_similarities(known: DataFrame, chosen: DataFrame) -> DataFrame:
    """(user_id, net): what the places of a user with exemplars lose to their nearest exemplars,
    and what the exemplars cost, as a negative sum."""
    leads = chosen.select("user_id", "site", F.lit(True).alias("leads"))
    ordinary, large = _apart(known)
    found = _net_of_whole_users(ordinary, leads)
    if large is None:
        return found
    marked = cut_lineage(_stored(large).join(leads, ["user_id", "site"], "left"))
    return found.union(_net_by_joins(geo.with_vector(marked)))


def _marked(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The places of the table, in which exemplars follow the places they are, and whether each leads."""
    of_place = table["leads"].is_null().to_numpy()
    firsts = whole_users.starts_of(table, "user_id", "site")
    sizes = np.diff(np.append(firsts, table.num_rows))
    meets = np.repeat(np.add.reduceat((~of_place).astype(int), firsts), sizes)
    rows = np.repeat(np.arange(table.num_rows), np.where(of_place, np.maximum(meets, 1), 0))
    return table.take(pa.array(rows)).combine_chunks(), meets[rows] > 0


def _net_of_whole_users(places: DataFrame, leads: DataFrame) -> DataFrame:
    """Places and exemplars are dealt together, so that no join comes before."""
    columns = ["user_id", "site", "latitude", "longitude", "visits", "spread"]
    schema = StructType([places.schema["user_id"], StructField("net", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_users.whole(batches):
            table, leads = _marked(table)
            if not table.num_rows:
                continue
            users = _Users(table)
            spread, led, net = whole_users.numbers(table, "spread"), [], []
            for rows in users.alike():
                rows = rows[leads[rows].any(axis=1)]
                s = users.similarities(rows, users.miles(rows)[0], spread[rows[:, 0]])
                own = np.arange(rows.shape[1])
                nearest = np.where(leads[rows][:, None, :], s, -np.inf).max(axis=2, initial=-np.inf)
                led += rows[:, 0].tolist()
                net += np.where(leads[rows], s[:, own, own], nearest).sum(axis=1).tolist()
            found = table.take(pa.array(led, pa.int64())).select(["user_id"])
            yield from found.append_column("net", pa.array(net, pa.float64())).combine_chunks().to_batches()

    both = places.select(columns).unionByName(leads, allowMissingColumns=True)
    return _dealt(both, "leads", sized=places).withColumn("tilt", _tilt()).mapInArrow(run, schema)


def _net_by_joins(marked: DataFrame) -> DataFrame:
    leaders = marked.where("leads")
    own = leaders.select("user_id", F.col("site").alias("i"), _own().alias("s"))
    follow = _pairs(marked.where("leads is null"), leaders)
    best = follow.select("user_id", "i", (-F.col("miles") * F.col("visits")).alias("s"))
    best = best.groupBy("user_id", "i").agg(F.max("s").alias("s"))
    return own.union(best).groupBy("user_id").agg(F.sum("s").alias("net"))


def exemplars_of(known: DataFrame, damping: float = 0.5, max_rounds: int = 200, settle_rounds: int = 15) -> DataFrame:
    """(user_id, site, settled) over what :func:`preferences` gives, by the rounds of the sparse form."""
    settings = (damping, max_rounds, settle_rounds)
    ordinary, large = _apart(known)
    columns = ["user_id", "site", "latitude", "longitude", "visits", "spread"]
    found = _exemplars_of_whole_users(ordinary.select(columns), *settings).select("user_id", "site", "settled")
    return found if large is None else found.union(exemplar_sites(similarities(large), *settings))


def dense_exemplar_centers(
    places: DataFrame,
    damping: float = 0.5,
    max_rounds: int = 200,
    settle_rounds: int = 15,
    large_user: int | None = None,
) -> DataFrame:
    """Exemplar places of each user over all pairs of its places, and whether the user settled:
    (user_id, site, latitude, longitude, visits, settled). Users with more than ``large_user`` places,
    ``BLOCK`` by default, take joins."""
    return centers_of(spots(places, large_user), damping, max_rounds, settle_rounds)


def centers_of(spots: DataFrame, damping: float, max_rounds: int, settle_rounds: int) -> DataFrame:
    """What :func:`dense_exemplar_centers` gives, of what :func:`spots` gives."""
    settings = (damping, max_rounds, settle_rounds)
    columns = ["user_id", "site", "latitude", "longitude", "visits"]
    ordinary, large = _apart(spots)
    found = _exemplars_of_whole_users(ordinary.drop("part", "parts"), *settings)
    # Written out, as the rounds are long and what follows may read the exemplars more than once.
    found = cut_lineage(found.select(*columns, "settled"))
    if large is None:
        return found
    known = geo.with_vector(cut_lineage(_stored(_profiles_by_joins(large))))
    chosen = exemplar_sites(similarities(known), *settings)
    return found.unionByName(known.select(columns).join(chosen, ["user_id", "site"]))
