"""The rounds of affinity propagation over a table of similarities (user_id, i, k, s).

Users whose messages fit into a task run there as arrays, after one shuffle; those with more run
through the same rounds as rows spread by site.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.scale import apart_by_size, cut_lineage, width_for

_BLOCK = 5  # rounds between two lineage cuts
_LARGE = 1_000_000  # messages beyond which a user is spread by site
_TOGETHER = 500_000  # messages of ordinary users that a task works on at a time
_ALONE = -1e9  # stands for "no rival" where a site has no neighbour


class _Messages:
    """Messages of some whole users as arrays, sorted by follower."""

    def __init__(self, rows: pd.DataFrame):
        user, self.names = pd.factorize(rows["user_id"], sort=False)
        i, k = rows["i"].to_numpy(), rows["k"].to_numpy()
        sites, codes = np.unique(np.concatenate([i, k]), return_inverse=True)
        follower = user * np.int64(len(sites)) + codes[: len(i)]
        leader = user * np.int64(len(sites)) + codes[len(i) :]
        order = np.lexsort((leader, follower))
        known, self.follower = np.unique(follower[order], return_inverse=True)
        self.leader = np.searchsorted(known, leader[order])
        self.s = rows["s"].to_numpy()[order]
        self.r, self.a = np.zeros(len(order)), np.zeros(len(order))
        self.site, self.user = sites[known % len(sites)], known // len(sites)
        self.held, self.chosen = np.zeros(len(known), int), np.zeros(len(known), bool)
        self._index()

    def _index(self) -> None:
        self.starts = np.flatnonzero(np.diff(self.follower, prepend=-1))
        self.own = self.follower == self.leader
        self.user_starts = np.flatnonzero(np.diff(self.user, prepend=-1))

    def round(self, damping: float) -> None:
        """One exchange of responsibilities and availabilities, both damped."""
        v = self.a + self.s
        best = np.maximum.reduceat(v, self.starts)[self.follower]
        first = v == best
        alone = np.add.reduceat(first.astype(int), self.starts)[self.follower] == 1
        second = np.maximum.reduceat(np.where(first, _ALONE, v), self.starts)[self.follower]
        rival = np.where(first & alone, second, best)
        self.r = self.r * damping + (self.s - rival) * (1.0 - damping)
        backing = np.where(self.own, self.r, np.maximum(self.r, 0.0))
        total = np.bincount(self.leader, backing, len(self.site))
        others = total[self.leader] - backing
        offer = np.where(self.own, others, np.minimum(others, 0.0))
        self.a = self.a * damping + offer * (1.0 - damping)
        now = (self.a + self.r)[self.own] > 0
        self.held = np.where(now == self.chosen, self.held + 1, 1)
        self.chosen = now

    def settled(self, settle_rounds: int) -> np.ndarray:
        """Whether the user of each site has settled."""
        held = np.minimum.reduceat(self.held, self.user_starts)
        any_chosen = np.logical_or.reduceat(self.chosen, self.user_starts)
        return np.repeat((held >= settle_rounds) & any_chosen, np.diff(self.user_starts, append=len(self.user)))

    def exemplars(self, of: np.ndarray, settled: bool) -> pd.DataFrame:
        found = of & self.chosen
        return pd.DataFrame(
            {"user_id": self.names[self.user[found]], "k": self.site[found], "settled": settled}
        )

    def keep(self, sites: np.ndarray) -> None:
        edges, number = sites[self.follower], np.cumsum(sites) - 1
        self.follower, self.leader = number[self.follower[edges]], number[self.leader[edges]]
        self.s, self.r, self.a = self.s[edges], self.r[edges], self.a[edges]
        self.site, self.user = self.site[sites], self.user[sites]
        self.held, self.chosen = self.held[sites], self.chosen[sites]
        self._index()


def _whole_users(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by user, cut only between users, about ``_TOGETHER`` at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        held.append(batch)
        if sum(map(len, held)) >= _TOGETHER:
            rows = pd.concat(held, ignore_index=True)
            last = rows["user_id"] == rows["user_id"].iloc[-1]
            if not last.all():
                yield rows[~last]
            held = [rows[last]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _propagated(
    rows: pd.DataFrame, damping: float, max_rounds: int, settle_rounds: int
) -> Iterator[pd.DataFrame]:
    """The rounds of some whole users."""
    messages = _Messages(rows)
    for number in range(1, max_rounds + 1):
        messages.round(damping)
        if number % _BLOCK:
            continue
        settled = messages.settled(settle_rounds)
        if settled.any():
            yield messages.exemplars(settled, True)
            messages.keep(~settled)
        if not len(messages.site):
            return
    if len(messages.site):
        yield messages.exemplars(np.ones(len(messages.site), bool), False)


def _exemplars_of_whole_users(
    similarity: DataFrame, damping: float, max_rounds: int, settle_rounds: int
) -> DataFrame:
    """The rounds of users that fit into a task, one shuffle for all of them."""

    def propagate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_users(batches):
            yield from _propagated(rows, damping, max_rounds, settle_rounds)

    user = similarity.schema["user_id"].dataType.simpleString()
    return (
        similarity.repartition(width_for(similarity), "user_id")
        .sortWithinPartitions("user_id")
        .mapInPandas(propagate, f"user_id {user}, k long, settled boolean")
    )


def _round(messages: DataFrame, damping: float) -> DataFrame:
    """One exchange of responsibilities ``r`` and availabilities ``a``, both damped."""
    kept = ["user_id", "i", "k", "s", "held", "chosen"]
    follower = "OVER (PARTITION BY user_id, i)"
    leader = "OVER (PARTITION BY user_id, k)"
    old, new = f"{damping}D", f"{1.0 - damping}D"

    rows = messages.selectExpr("*", "a + s AS v", f"max(a + s) {follower} AS best")
    # the best offer of all other sites: the second best for the one site that has the best
    rival = f"""coalesce(
        if(v = best AND sum(int(v = best)) {follower} = 1, max(if(v < best, v, NULL)) {follower}, best),
        {_ALONE}D)"""
    rows = rows.selectExpr(*kept, "a", f"r * {old} + (s - {rival}) * {new} AS r")
    rows = rows.selectExpr("*", "if(i = k, r, greatest(r, 0D)) AS backing")
    rows = rows.selectExpr("*", f"sum(backing) {leader} - backing AS others")
    rows = rows.selectExpr(
        *kept, "r", f"a * {old} + if(i = k, others, least(0D, others)) * {new} AS a"
    )
    chosen = "(i = k AND a + r > 0)"
    return rows.selectExpr(
        "user_id",
        "i",
        "k",
        "s",
        "r",
        "a",
        f"if({chosen} = chosen, held + 1, 1) AS held",
        f"{chosen} AS chosen",
    )


def _exemplars_spread_by_site(
    similarity: DataFrame, damping: float, max_rounds: int, settle_rounds: int
) -> list[DataFrame]:
    """The rounds of very large users as rows; users with settled exemplars leave."""
    width = width_for(similarity)
    zero = F.lit(0.0)
    messages = cut_lineage(
        similarity.withColumns({"r": zero, "a": zero, "held": F.lit(0), "chosen": F.lit(False)})
    )
    done: list[DataFrame] = []
    own = F.col("i") == F.col("k")
    for _ in range(0, max_rounds, _BLOCK):
        if messages.isEmpty():
            return done
        step = messages.repartition(width, "user_id", "i")
        for _ in range(_BLOCK):
            step = _round(step, damping)
        step = cut_lineage(step)
        verdicts = step.where(own).groupBy("user_id").agg(
            ((F.min("held") >= settle_rounds) & F.max("chosen")).alias("settled")
        )
        step = step.join(verdicts, "user_id")
        left = step.where(own & F.col("chosen") & F.col("settled"))
        done.append(left.select("user_id", "k", "settled"))
        messages = step.where(~F.col("settled")).drop("settled")
    last = messages.where(own & F.col("chosen"))
    done.append(last.select("user_id", "k", F.lit(False).alias("settled")))
    return done


def exemplar_sites(
    similarity: DataFrame,
    damping: float = 0.5,
    max_rounds: int = 200,
    settle_rounds: int = 15,
    large_user: int = _LARGE,
) -> DataFrame:
    """Sites that affinity propagation leaves as exemplars: (user_id, site, settled).

    A user leaves the rounds when its exemplars, at least one, have not changed for
    ``settle_rounds`` rounds; this is looked at every five rounds. Users that ``max_rounds`` left
    unsettled have the exemplars of the last round, marked as not settled.
    """
    ordinary, large = apart_by_size(cut_lineage(similarity), "user_id", large_user)
    settings = (damping, max_rounds, settle_rounds)
    done = [_exemplars_of_whole_users(ordinary, *settings)]
    if large is not None:
        done += _exemplars_spread_by_site(large, *settings)
    return reduce(DataFrame.union, done).select("user_id", F.col("k").alias("site"), "settled")
