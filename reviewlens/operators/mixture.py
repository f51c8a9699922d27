"""Home areas by Gaussian mixtures: expectation-maximisation of all users in shared rounds.

A round joins the places with their user's current parameters and adds up sufficient sums per
(user, number of components). Places are laid out and sorted by user once and kept, so a round
shuffles the small parameter rows only; joins and sums stay inside the partition. Users with
very many places run through the same rounds spread by (user, part), where partial sums are all
that is exchanged besides.

Users whose places fit into a task need no rounds of jobs: one shuffle brings their places together
and the same rounds run on arrays, for some users at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import whole_users
from reviewlens.operators.scale import (
    apart_by_size,
    cut_lineage,
    split_hot_groups,
    width_for,
)

MAX_COMPONENTS = 4
_SLOTS = range(1, MAX_COMPONENTS + 1)
_EMPTY = 1e-9
_LARGE = 100_000  # places beyond which a user is spread over parts
_TOGETHER = 20_000  # places of ordinary users that a task works on at a time
_STATE = ["n", "parts", "ll", "settled"]


def _slot(name: str, c: int) -> Column:
    return F.col(f"{name}{c}")


def _parameter_columns() -> list[str]:
    return [f"{name}{c}" for name in ("share", "lat", "lon", "var") for c in _SLOTS]


def _moments(places: DataFrame) -> DataFrame:
    lat, lon, w = F.col("latitude"), F.col("longitude"), F.col("visits")
    sums = places.groupBy("user_id").agg(
        F.sum(w).cast("double").alias("n"),
        F.max("parts").alias("parts"),
        F.sum(w * lat).alias("s_lat"),
        F.sum(w * lon).alias("s_lon"),
        F.sum(w * lat * lat).alias("s_lat2"),
        F.sum(w * lon * lon).alias("s_lon2"),
        F.sum(w * lat * lon).alias("s_both"),
    )
    n, m_lat, m_lon = F.col("n"), F.col("m_lat"), F.col("m_lon")
    return sums.withColumns({"m_lat": F.col("s_lat") / n, "m_lon": F.col("s_lon") / n}).select(
        "user_id",
        "n",
        "parts",
        "m_lat",
        "m_lon",
        F.greatest(F.col("s_lat2") / n - m_lat * m_lat, F.lit(0.0)).alias("v_lat"),
        F.greatest(F.col("s_lon2") / n - m_lon * m_lon, F.lit(0.0)).alias("v_lon"),
        (F.col("s_both") / n - m_lat * m_lon).alias("v_both"),
    )


def _initial(moments: DataFrame, var_floor: float) -> DataFrame:
    """Start for 1 to 4 components: means at normal quantiles along the main axis of spread."""
    v_lat, v_lon, v_both = F.col("v_lat"), F.col("v_lon"), F.col("v_both")
    gap = (v_lat - v_lon) / 2.0
    shaped = moments.withColumns(
        {
            "angle": F.atan2(v_both, gap) / 2.0,
            "spread": F.sqrt((v_lat + v_lon) / 2.0 + F.sqrt(gap * gap + v_both * v_both)),
            "k": F.explode(F.array(*(F.lit(k) for k in _SLOTS))),
        }
    )

    def offset(c: int) -> Column:
        quantiles = {k: NormalDist().inv_cdf((c - 0.5) / k) for k in _SLOTS if c <= k}
        return reduce(
            lambda chosen, k: chosen.when(F.col("k") == k, F.lit(quantiles[k])), quantiles, F
        ).otherwise(F.lit(0.0))

    columns = {}
    for c in _SLOTS:
        columns[f"share{c}"] = F.when(F.col("k") >= c, F.lit(1.0) / F.col("k")).otherwise(0.0)
        columns[f"lat{c}"] = F.col("m_lat") + offset(c) * F.col("spread") * F.cos("angle")
        columns[f"lon{c}"] = F.col("m_lon") + offset(c) * F.col("spread") * F.sin("angle")
        columns[f"var{c}"] = F.greatest((v_lat + v_lon) / 2.0 / F.col("k"), F.lit(var_floor))
    start = shaped.withColumns(columns)
    return start.select(
        "user_id",
        "k",
        "n",
        "parts",
        F.lit(None).cast("double").alias("ll"),
        F.lit(False).alias("settled"),
        *_parameter_columns(),
    )


def _each_slot(*texts: str) -> list[str]:
    """The SQL texts once per component, ``#`` standing for its number."""
    return [text.replace("#", str(c)) for text in texts for c in _SLOTS]


def _over_slots(text: str, join: str) -> str:
    return join.join(_each_slot(text))


def _sums(places: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """State rows with the log-likelihood of their parameters and each component's
    responsibility-weighted sums around its current mean."""
    if "part" in keys:
        state = state.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = places.join(state, keys)
    rows = rows.selectExpr("*", *_each_slot("latitude - lat# AS dx#", "longitude - lon# AS dy#"))
    rows = rows.selectExpr("*", *_each_slot("dx# * dx# + dy# * dy# AS sq#"))
    density = f"ln(share# / (var# * {2.0 * math.pi}D)) - sq# / (var# * 2)"
    rows = rows.selectExpr("*", *_each_slot(f"if(share# > 0, {density}, NULL) AS log#"))
    rows = rows.selectExpr("*", f"greatest({_over_slots('log#', ', ')}) AS top")
    rows = rows.selectExpr("*", *_each_slot("coalesce(exp(log# - top), 0D) AS e#"))
    rows = rows.selectExpr("*", f"{_over_slots('e#', ' + ')} AS mass")
    rows = rows.selectExpr("*", *_each_slot("visits * e# / mass AS r#"))
    # The state is the same on every row of a group, so it rides along instead of being joined.
    carried = [f"first({name}) AS {name}" for name in [*_STATE, *_parameter_columns()]]
    sums = _each_slot(
        "sum(r#) AS size#", "sum(r# * dx#) AS x#", "sum(r# * dy#) AS y#", "sum(r# * sq#) AS q#"
    )
    totals = ["sum(visits * (top + ln(mass))) AS fit", *carried, *sums]
    return rows.groupBy("user_id", "k").agg(*map(F.expr, totals))


def _advanced(sums: DataFrame, var_floor: float, tolerance: float) -> DataFrame:
    """Next state. A row whose mean log-likelihood has settled keeps its parameters."""
    now = f"settled OR coalesce(abs(fit / n - ll) < {tolerance}D, false)"
    rows = sums.withColumnsRenamed({"settled": "was"}).selectExpr(
        "*", now.replace("settled", "was") + " AS settled"
    )
    moves = f"NOT settled AND size# > {_EMPTY}D"
    spread = "(q# / size# - x# / size# * x# / size# - y# / size# * y# / size#) / 2"
    return rows.selectExpr(
        "user_id",
        "k",
        "n",
        "parts",
        "fit / n AS ll",
        "settled",
        *_each_slot(
            f"if({moves}, size# / n, share#) AS share#",
            f"if({moves}, lat# + x# / size#, lat#) AS lat#",
            f"if({moves}, lon# + y# / size#, lon#) AS lon#",
            f"if({moves}, greatest({spread}, {var_floor}D), var#) AS var#",
        ),
    )


def _fitted(
    stored: DataFrame,
    keys: list[str],
    min_visits: int,
    max_rounds: int,
    tolerance: float,
    var_floor: float,
    trace: list | None,
) -> DataFrame | None:
    """Rounds over one layout of the places. Settled rows and the places only they need leave
    whenever half of the rows have settled."""
    width = width_for(stored)
    moments = _moments(stored).where(F.col("n") >= min_visits)
    active = cut_lineage(_initial(moments, var_floor))
    left = active.count()
    if left == 0:
        return None

    def laid_out() -> DataFrame:
        rows = stored.drop("parts").repartition(width, *keys).sortWithinPartitions(*keys).persist()
        rows.count()  # once stored, its partitioning is known to the rounds
        return rows

    spots, served = laid_out(), left
    done: list[DataFrame] = []
    for _ in range(max_rounds):
        rows = active.repartition(width, "user_id")
        step = cut_lineage(_advanced(_sums(spots, rows, keys), var_floor, tolerance))
        if trace is not None:
            trace.append(step)
        active = step.where(~F.col("settled"))
        left = active.count()
        if left * 2 > served:
            active = step  # few have settled: they stay, unchanged, until it pays to part
            continue
        done.append(step.where("settled"))
        if left == 0:
            break
        users = active.select("user_id").distinct()
        spots.unpersist()
        stored = cut_lineage(stored.join(users, "user_id", "left_semi"))
        spots, served = laid_out(), left
    else:
        rows = active.repartition(width, "user_id")
        last = _sums(spots, rows, keys).withColumn("ll", F.col("fit") / F.col("n"))
        done.append(cut_lineage(last.select(*active.columns)))
    spots.unpersist()
    return reduce(DataFrame.union, done)


class _Users:
    """Places of some whole users as arrays, and the rounds on them."""

    def __init__(self, table: pa.Table, min_visits: int):
        starts = whole_users.starts_of(table, "user_id")
        self.spots = np.stack([whole_users.numbers(table, name) for name in ("latitude", "longitude")], axis=1)
        self.visits = whole_users.numbers(table, "visits")
        user = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        known = np.add.reduceat(self.visits, starts) >= min_visits
        self.names = table["user_id"].combine_chunks().take(pa.array(starts[known]))
        rows = known[user]
        self.spots, self.visits = self.spots[rows], self.visits[rows]
        self.user = (np.cumsum(known) - 1)[user[rows]]
        self.starts = np.flatnonzero(np.diff(self.user, prepend=-1))

    def start(self, k: int, var_floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares, means and variances of :func:`_initial`, unused slots included."""
        total = np.add.reduceat(self.visits, self.starts)[:, None]
        mean = np.add.reduceat(self.visits[:, None] * self.spots, self.starts) / total
        square = np.add.reduceat(self.visits[:, None] * self.spots * self.spots, self.starts) / total
        v_lat, v_lon = np.maximum(square - mean * mean, 0.0).T
        product = np.add.reduceat(self.visits * self.spots.prod(axis=1), self.starts) / total[:, 0]
        v_both = product - mean.prod(axis=1)
        gap = (v_lat - v_lon) / 2.0
        angle = np.arctan2(v_both, gap) / 2.0
        spread = np.sqrt((v_lat + v_lon) / 2.0 + np.sqrt(gap * gap + v_both * v_both))
        way = np.stack([np.cos(angle), np.sin(angle)], axis=1) * spread[:, None]
        offset = np.array([NormalDist().inv_cdf((c - 0.5) / k) if c <= k else 0.0 for c in _SLOTS])
        means = mean[:, None, :] + offset[None, :, None] * way[:, None, :]
        shares = np.broadcast_to(np.array([1.0 / k if c <= k else 0.0 for c in _SLOTS]), means.shape[:2])
        var = np.maximum((v_lat + v_lon) / 2.0 / k, var_floor)
        return shares.copy(), means, np.repeat(var[:, None], MAX_COMPONENTS, axis=1)

    def fit(self, k: int, max_rounds: int, tolerance: float, var_floor: float) -> tuple[np.ndarray, ...]:
        """(ll, settled, shares, means, variances) of the mixtures of k components."""
        shares, means, variances = self.start(k, var_floor)
        lls, done = np.full(len(shares), np.nan), np.zeros(len(shares), bool)
        going = np.arange(len(shares))
        spots, visits, user, starts = self.spots, self.visits, self.user, self.starts
        share, mean, var, ll = shares[:, :k], means[:, :k], variances[:, :k], lls
        for number in range(max_rounds + 1):
            n = np.add.reduceat(visits, starts)
            gaps = spots[:, None, :] - mean[user]
            square = gaps[..., 0] * gaps[..., 0] + gaps[..., 1] * gaps[..., 1]
            log = np.log(share / (var * (2.0 * math.pi)))[user] - square / (var * 2)[user]
            top = log.max(axis=1)
            each = np.exp(log - top[:, None])
            mass = each.sum(axis=1)
            now = np.add.reduceat(visits * (top + np.log(mass)), starts) / n
            settled = np.abs(now - ll) < tolerance if number < max_rounds else np.zeros(len(n), bool)
            ll = now
            leave = settled if number < max_rounds else ~settled
            if leave.any():
                to = going[leave]
                lls[to], done[to] = ll[leave], settled[leave]
                shares[to, :k], means[to, :k], variances[to, :k] = share[leave], mean[leave], var[leave]
            if leave.all():
                break
            part = each * (visits / mass)[:, None]
            size = np.add.reduceat(part, starts)
            shift = np.add.reduceat(part[..., None] * gaps, starts)
            moves = size > _EMPTY
            by = np.where(moves, size, 1.0)
            shift /= by[..., None]
            spread = (np.add.reduceat(part * square, starts) / by - (shift * shift).sum(axis=2)) / 2
            share = np.where(moves, size / n[:, None], share)
            mean = np.where(moves[..., None], mean + shift, mean)
            var = np.where(moves, np.maximum(spread, var_floor), var)
            if leave.any():
                stay = ~leave
                rows = stay[user]
                spots, visits, user = spots[rows], visits[rows], (np.cumsum(stay) - 1)[user[rows]]
                starts = np.flatnonzero(np.diff(user, prepend=-1))
                share, mean, var, ll, going = share[stay], mean[stay], var[stay], ll[stay], going[stay]
        return lls, done, shares, means, variances


def _fitted_whole_users(
    places: DataFrame, min_visits: int, max_rounds: int, tolerance: float, var_floor: float
) -> DataFrame:
    """The fits of users whose places fit into a task, one shuffle for all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_users.whole(batches, _TOGETHER):
            users = _Users(table, min_visits)
            size = len(users.names)
            for k in _SLOTS if size else ():
                ll, settled, shares, means, variances = users.fit(k, max_rounds, tolerance, var_floor)
                n = np.add.reduceat(users.visits, users.starts)
                state = [np.full(size, k, np.int32), n, np.ones(size, np.int32), ll, settled]
                found = [*shares.T, *means[..., 0].T, *means[..., 1].T, *variances.T]
                columns = [users.names, *(pa.array(np.ascontiguousarray(x)) for x in (*state, *found))]
                yield pa.RecordBatch.from_arrays(columns, names=["user_id", "k", *_STATE, *_parameter_columns()])

    user = places.schema["user_id"].dataType.simpleString()
    schema = f"user_id {user}, k int, n double, parts int, ll double, settled boolean"
    schema += "".join(f", {name} double" for name in _parameter_columns())
    return whole_users.dealt(places).mapInArrow(run, schema)


def mixture_models(
    places: DataFrame,
    min_visits: int = 5,
    max_rounds: int = 100,
    tolerance: float = 1e-3,
    var_floor: float = 1e-3,
    large_user: int = _LARGE,
    trace: list | None = None,
) -> DataFrame:
    """Fitted spherical mixtures per user for 1 to 4 components, with ``ll`` (mean log-likelihood
    of the parameters) and ``bic``. Users below ``min_visits`` have none.

    A row is settled once its mean log-likelihood moves less than ``tolerance`` in a round.
    ``trace`` collects the state after each round, for tests; all users then take the rounds of jobs.
    """
    spot = ["user_id", "latitude", "longitude", "visits"]
    columns = cut_lineage(places.select(*spot).dropna(subset=spot))
    ordinary, large = apart_by_size(columns, "user_id", large_user)
    settings = (min_visits, max_rounds, tolerance, var_floor)
    if trace is None:
        whole = cut_lineage(_fitted_whole_users(ordinary, *settings))
        found = [None if whole.isEmpty() else whole]
    else:
        found = [_fitted(ordinary.withColumn("parts", F.lit(1)), ["user_id"], *settings, trace)]
    if large is not None:
        spread = split_hot_groups(large, "user_id", ["latitude", "longitude"], large_user)
        found.append(_fitted(cut_lineage(spread), ["user_id", "part"], *settings, trace))
    found = [frame for frame in found if frame is not None]
    if not found:
        raise ValueError("no user has enough visits")
    weights = F.col("k") * 4 - 1
    return reduce(DataFrame.union, found).withColumn(
        "bic", F.col("ll") * F.col("n") * -2.0 + weights * F.ln("n")
    )


def mixture_centers(models: DataFrame) -> DataFrame:
    """Means of each user's mixture with the lowest BIC, the smaller one on a tie."""
    kept = F.struct("k", *(f"{name}{c}" for name in ("lat", "lon") for c in _SLOTS))
    best = models.groupBy("user_id").agg(F.min_by(kept, F.struct("bic", "k")).alias("best"))
    means = F.array(
        *(
            F.struct(
                F.lit(c).alias("component"),
                F.col(f"best.lat{c}").alias("latitude"),
                F.col(f"best.lon{c}").alias("longitude"),
            )
            for c in _SLOTS
        )
    )
    return best.select(
        "user_id", F.explode(F.slice(means, F.lit(1), F.col("best.k"))).alias("m")
    ).select("user_id", "m.component", "m.latitude", "m.longitude")


def model_checks(places: DataFrame, models: DataFrame) -> DataFrame:
    """Per model what its places say of it: the mean place, and ``ll`` computed anew.

    ``latitude`` and ``longitude`` are the means of the mixture; after a round of the fit they equal
    the visit-weighted mean of the user's places, however many components there are.
    """
    parts = F.array(
        *(F.struct(*(F.col(f"{name}{c}").alias(name) for name in ("share", "lat", "lon", "var"))) for c in _SLOTS)
    )
    stated = models.select("user_id", "k", "ll", F.filter(parts, lambda p: p["share"] > 0).alias("parts"))

    def log_density(p: Column) -> Column:
        square = F.pow(F.col("latitude") - p["lat"], 2) + F.pow(F.col("longitude") - p["lon"], 2)
        return F.ln(p["share"] / (p["var"] * (2.0 * math.pi))) - square / (p["var"] * 2)

    def total(field: str) -> Column:
        return F.aggregate("parts", F.lit(0.0), lambda sum_, p: sum_ + p["share"] * p[field])

    rows = places.select("user_id", "latitude", "longitude", "visits").join(stated, "user_id")
    rows = rows.withColumn("logs", F.transform("parts", log_density)).withColumn("top", F.array_max("logs"))
    mass = F.aggregate("logs", F.lit(0.0), lambda sum_, one: sum_ + F.exp(one - F.col("top")))
    found = rows.groupBy("user_id", "k").agg(
        F.sum("visits").alias("visits"),
        (F.sum(F.col("visits") * (F.col("top") + F.ln(mass))) / F.sum("visits")).alias("found_ll"),
    )
    return stated.select("user_id", "k", "ll", total("lat").alias("latitude"), total("lon").alias("longitude")).join(
        found, ["user_id", "k"]
    )
