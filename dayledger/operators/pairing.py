"""Stations with their responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayledger.operators.joining import null_safe_join
from dayledger.session import written

#: A station's place in the registry; names may repeat or be missing.
STATION_KEY = ("position",)

_RANK, _FILE, _COPIES = "_rank", "_file", "_copies"


def _ranked(responses: DataFrame) -> DataFrame:
    """Add the rank of each body: its length, then a hash; one without a body ranks last.

    Both are in one decimal, which aggregates in place where a struct or text would be sorted.
    """
    body = F.col("body")
    length = F.octet_length(body).cast("decimal(10,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)")
    unsigned = F.xxhash64(body).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    rank = F.when(body.isNull(), F.lit(-1)).otherwise(length + unsigned).cast("decimal(38,0)")
    ranked = responses.withColumn(_RANK, rank)
    return ranked if _FILE in responses.columns else ranked.withColumn(_FILE, F.lit(0).cast("long"))


def _choice(ranked: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """The key, rank and file of the response that stays, and how often that file has it.

    Bodies are read for their rank only; what is grouped and shuffled are numbers, map side first,
    so a key with a third of all responses sends on one row per task, rank and file.
    """
    copies = ranked.groupBy(*on, _RANK, _FILE).agg(F.count(F.lit(1)).alias(_COPIES))
    best = copies.groupBy(*on).agg(F.max(F.struct(_RANK, _FILE, _COPIES)).alias("_best"))
    return best.select(*on, f"_best.{_RANK}", f"_best.{_FILE}", f"_best.{_COPIES}")


def pair(
    stations: DataFrame, responses: DataFrame, on: tuple[str, ...] = STATION_KEY
) -> DataFrame:
    """A row for each station that has a response: its body, and the station's columns beside it.

    One response per key counts, as one request is made per station: of responses landed again one
    with a body, the longest, of equally long ones that with the greater hash. Stations that share
    a key share its response, so rows never multiply.

    The choice is made by small keys and written first; then each body moves once, to its rank in
    the choice, unless that is small enough to come to the bodies. No body is sorted.
    """
    bodies = [c for c in responses.columns if c != _FILE and (c in on or c not in stations.columns)]
    ranked = _ranked(responses)
    choice = written(_choice(ranked, on))
    ranked = ranked.select(*bodies, _RANK, _FILE)
    keys = [*on, _RANK, _FILE]
    alone = null_safe_join(choice.where(F.col(_COPIES) == 1), stations, list(on))
    paired = null_safe_join(ranked, alone.hint("shuffle_hash"), keys).drop(_RANK, _FILE, _COPIES)
    again = choice.where(F.col(_COPIES) > 1)
    if again.isEmpty():
        return paired
    # The same body several times in one file: only these few are grouped.
    wanted = again.hint("shuffle_hash")
    some = null_safe_join(ranked, wanted, keys, "left_semi").drop(_RANK, _FILE)
    others = [c for c in bodies if c not in on]
    once = some.groupBy(*on).agg(F.first(F.struct(*others)).alias("_one"))
    once = once.select(*on, *[F.col(f"_one.{c}").alias(c) for c in others]).select(*bodies)
    return paired.unionByName(null_safe_join(once, stations, list(on)))
