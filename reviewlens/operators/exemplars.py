"""Home areas by affinity propagation: every place of a user is a site, and may follow every other one.

No places are merged and no candidate is left out, however far: sites, candidates and similarities are
those of :mod:`reviewlens.operators.dense_exemplars`, where users of ordinary size meet in matrices within
a task and larger ones behind joins of blocks, without the messages that a bound proves can never count.

Places without user or longitude are left out. One without a latitude is near to none, so it is an exemplar
of its own. One without an id gets a number of its coordinates; (user_id, place_id) must be unique otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import dense_exemplars, whole_users
from reviewlens.operators.affinity_rounds import exemplar_sites
from reviewlens.operators.scale import cut_lineage

__all__ = ["candidates", "exemplar_centers", "exemplar_sites", "similarities", "sites"]


def _named(places: DataFrame) -> DataFrame:
    number = F.pmod(F.xxhash64("latitude", "longitude"), F.lit((1 << 31) - 1))
    kind = places.schema["place_id"].dataType
    return places.withColumn("place_id", F.coalesce("place_id", number.cast(kind)))


def sites(places: DataFrame) -> DataFrame:
    """(user_id, site, latitude, longitude, visits) of every place, with unit vectors and the blocks of
    very large users."""
    return dense_exemplars.spots(_named(places))


def candidates(sites: DataFrame) -> DataFrame:
    """(user_id, i, k, visits, miles, weight): all other sites k of the user of site i, ``visits`` those
    of i and ``weight`` the number of visit pairs."""
    return dense_exemplars.candidates(sites)


def similarities(sites: DataFrame) -> DataFrame:
    """(user_id, i, k, s): cost of site i following site k, and of being an exemplar where i = k.

    Between sites it is the negative distance times the visits of i. The preference is minus the
    median distance between two visits at different sites of the user. A per-site millionth of it
    breaks ties between equal sites. Pairs that can never count are left out.
    """
    return dense_exemplars.similarities(dense_exemplars.preferences(sites))


def exemplar_centers(
    places: DataFrame,
    damping: float = 0.5,
    max_rounds: int = 200,
    settle_rounds: int = 15,
    large_user: int = whole_users.LARGE,
) -> DataFrame:
    """Coordinates of each user's exemplar places, and whether the user settled: (user_id, site,
    latitude, longitude, visits, settled). Users with more than ``large_user`` places meet their
    candidates behind joins."""
    columns = ["user_id", F.col("place_id").alias("site"), "latitude", "longitude", "visits"]
    known = _named(places).select(*columns).dropna(subset=["user_id", "site", "longitude"])
    known = cut_lineage(known)
    spots = dense_exemplars.in_blocks(known.dropna(subset=["latitude"]), large_user)
    centers = dense_exemplars.centers_of(spots, damping, max_rounds, settle_rounds)
    alone = known.where("latitude is null")
    if alone.isEmpty():
        return centers
    verdicts = centers.groupBy("user_id").agg(F.min("settled").alias("settled"))
    settled = F.coalesce("settled", F.lit(max_rounds >= settle_rounds))
    return centers.unionByName(alone.join(verdicts, "user_id", "left").withColumn("settled", settled))
