"""Join every fact row to the first of several lookups that knows it.

Lookups may be asked by different keys ("ways").  Joining wide facts once per
way would shuffle them once per way, and a hot key would sit in one task each
time.  So the ways are walked on the distinct key combinations only:

1. facts are pre-aggregated to their distinct keys, map-side combined: any
   number of copies of a key is one row per map task from here on;
2. those narrow rows are joined to each lookup in turn, keeping the best hit;
3. the facts meet the verdicts in one join - the only shuffle of wide rows.

Every join is a left join of two plain shuffles, whose oversized partitions
adaptive execution splits by map output, whatever their keys: rows of a key of
any size are dealt out to as many tasks as their bytes ask for.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Way:
    """One way to a hit.

    ``lookup`` has one row per combination of the columns named in ``on``, which
    maps each to SQL over the keys.  ``hit`` is SQL over the keys and the
    lookup's other columns: a struct that sorts by its first field, the step.
    It must be null where those columns are.
    """

    lookup: DataFrame
    on: Mapping[str, str]
    hit: str = "hit"


def key_profile(
    facts: DataFrame, keys: Sequence[str], dealt_by: str | None = None
) -> DataFrame:
    """Distinct keys, and ``_rows``, the number of facts that have them.

    Dealt by one of the keys, they are walked through lookups dealt alike without a
    shuffle for each way.  They are made distinct before, so that copies do not add up.
    """
    profile = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return profile.repartition(dealt_by) if dealt_by else profile


def best_hits(profile: DataFrame, ways: Sequence[Way]) -> DataFrame:
    """``profile`` with the lowest-step ``hit`` of all ways, null without one.

    Both sides of each join may be large, and Spark cannot estimate what
    building a lookup does to its size, hence the merge hint: a small-looking
    plan must not end in a large broadcast.
    """
    kept = list(profile.columns)
    walked = profile
    for way in ways:
        lookup = way.lookup.withColumnsRenamed({c: f"_on_{c}" for c in way.on})
        condition = F.expr(" AND ".join(f"_on_{c} = {sql}" for c, sql in way.on.items()))
        walked = walked.withColumnRenamed("hit", "_best").join(
            lookup.hint("merge"), condition, "left"
        )
        best = f"least(_best, {way.hit})" if "_best" in walked.columns else way.hit
        walked = walked.selectExpr(*kept, f"{best} AS hit")
    return walked


def first_hit(
    facts: DataFrame, keys: Sequence[str], ways: Sequence[Way], dealt_by: str | None = None
) -> DataFrame:
    """``facts`` plus the struct ``hit`` of the lowest step, null without a hit.

    ``keys`` are non-null columns of ``facts`` that decide the outcome.  ``dealt_by`` is
    the key that all ways ask with and by which all lookups are dealt.
    """
    verdicts = best_hits(key_profile(facts, keys, dealt_by), ways).where("hit IS NOT NULL")
    # The one key of the join is a hash of all keys: the verdicts then never keep the
    # partitioning of a lookup's first key, so both sides are shuffles that can be split,
    # and rows are sorted by a number.  It is made on both sides, not shuffled.  The keys
    # decide; as "=" they would be keys of the join as well, by which rows are sorted.
    told = {k: f"{k}_hashed" for k in keys}
    same = F.xxhash64(*keys) == F.xxhash64(*told.values())
    for key, other in told.items():
        same &= (F.col(key) >= F.col(other)) & (F.col(key) <= F.col(other))
    verdicts = verdicts.select(*[F.col(k).alias(t) for k, t in told.items()], "hit").hint("merge")
    return facts.join(verdicts, same, "left").drop(*told.values())
