"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Every document starts in a shard by its
rank in a hash order, so row counts are even from the start.  In each round the
linked documents look at the shards of their neighbours and ask to gather where
most of them are, as far as there is room; requests are granted under quotas,
larger groups first, and what is granted is settled.  Documents without links,
and groups that no shard has room for, fill the seats that are left, so counts
stay even.  A link is cut when its ends lie in two shards.

Defined results: law `rows`, counts differ by at most one; a null text has no
bytes and is linked to nothing; repeated rows are rows of their own; an empty
table gives no rows; further columns are ignored.  A group larger than a shard
is taken as parts of at most one shard's rows, each gathered by itself.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import release, staged

SHARDS = 40
ROWS_PER_CHUNK = 50_000
PLANNED = 4  # rounds that one plan holds
OVERHEAD = 16


def described(documents: DataFrame) -> DataFrame:
    """Narrow rows: the text is replaced by its length, checksum and hash."""
    text = F.col("text").cast("binary")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("link"),
    )


def chunk_count(total: int) -> int:
    return max(1, -(-total // ROWS_PER_CHUNK))


def ranked(rows: DataFrame, keys: list[str], name: str, total: int) -> DataFrame:
    """Adds a gapless rank from 0 per keys.

    Rows are dealt to chunks by a hash of the row; a rank is the size of the
    earlier chunks plus the row number in its own, so a key of any size, or a
    doc_id of many rows, is ranked by many tasks.  Equal rows get neighbouring ranks.
    """
    row = F.xxhash64("doc_id", "size", "text_crc32", "link")
    dealt = rows.withColumn("_chunk", F.pmod(row, F.lit(chunk_count(total))).cast("int"))
    sizes = dealt.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, "_chunk").orderBy("doc_id", "size", "text_crc32", "link")
    return (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(starts, [*keys, "_chunk"])
        .withColumn(name, (F.col("_start") + F.col("_row")).cast("long"))
        .select(*rows.columns, name)
    )


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def _per_shard(numbers: list[int], shard="shard"):
    """A number of each shard; the list is as long as there are shards."""
    return F.get(F.array(*[F.lit(n).cast("long") for n in numbers]), F.col(shard))


def group_sizes(rows: DataFrame) -> DataFrame:
    return rows.where("link IS NOT NULL").groupBy("link").agg(F.count(F.lit(1)).alias("_members"))


def split_by_links(
    rows: DataFrame, sizes: DataFrame, total: int, shards: int
) -> tuple[DataFrame, DataFrame]:
    """Documents without a neighbour; and those with one, each with its unit:
    its group, or a part of at most a shard's rows where the group is larger."""
    least = max(1, total // shards)
    # Fewer than 2 * shards groups can be larger than a shard, so their list is
    # broadcast; the rows of such a group never meet in one task.
    large = F.broadcast(sizes.where(F.col("_members") > least).select("link"))
    parted = (
        ranked(rows.join(large, "link"), ["link"], "_rank", total)
        .withColumn("part", F.floor(F.col("_rank") / least))
        .drop("_rank")
    )
    counted = rows.join(large, "link", "left_anti").join(sizes, "link", "left")
    alone = counted.where("_members IS NULL OR _members = 1").drop("_members")
    whole = counted.where("_members > 1").withColumn("part", F.lit(0).cast("long"))
    return alone, whole.drop("_members").unionByName(parted)


def requests(held: DataFrame, room: list[int], turn: int) -> DataFrame:
    """Per unit that fits some shard: the shard it asks for.

    held has the number of a unit's members in each shard where it has any.  Of
    the shards with room for the whole unit, that with most members has the
    first claim; where none of them has room, the others are tried in an order
    given by a hash.
    """
    fits = _per_shard(room) >= F.col("members")
    choice = F.struct("held", F.xxhash64("link", "part", "shard").alias("h"), "shard")
    asked = held.groupBy("link", "part", "members").agg(F.max(F.when(fits, choice)).alias("best"))
    elsewhere = F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.lit(len(room) - 1)),
            lambda s: F.when(
                F.get(F.array(*map(F.lit, room)), s) >= F.col("members"),
                F.struct(F.xxhash64("link", "part", F.lit(turn), s).alias("h"), s.alias("shard")),
            ),
        )
    )
    return asked.select(
        "link", "part", "members", F.coalesce("best.shard", elsewhere["shard"]).alias("wish")
    ).where("wish IS NOT NULL")


def granted(asked: DataFrame, room: list[int], total: int) -> DataFrame:
    """Units that fit the quota of the shard they ask for; (link, part, wish).

    Larger units come first.  The sum of earlier requests is taken over size
    classes and chunks, so no shard's requests meet in one task.
    """
    dealt = asked.withColumn(
        "_chunk",
        F.struct(
            (-F.floor(F.log2("members"))).cast("int").alias("size_class"),
            F.pmod(F.xxhash64("link", "part"), F.lit(chunk_count(total))).cast("int").alias("c"),
        ),
    )
    sums = dealt.groupBy("wish", "_chunk").agg(F.sum("members").alias("_sum"))
    before = Window.partitionBy("wish").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = F.coalesce(F.sum("_sum").over(before), F.lit(0))
    starts = sums.withColumn("_start", earlier).drop("_sum")
    within = Window.partitionBy("wish", "_chunk").orderBy("link", "part")
    return (
        dealt.withColumn("_upto", F.sum("members").over(within))
        .join(starts, ["wish", "_chunk"])
        .where(F.col("_start") + F.col("_upto") <= _per_shard(room, "wish"))
        .select("link", "part", "wish", "members")
    )


def _counts(rows: DataFrame, shards: int) -> list[int]:
    """Rows per shard: as many numbers as there are shards."""
    found = dict(rows.groupBy("shard").count().collect())
    return [found.get(s, 0) for s in range(shards)]


def seated(free: DataFrame, left: list[int], total: int) -> DataFrame:
    """Unlinked documents stay while their shard has seats left; the others
    are dealt to the seats that other shards have left."""
    shards = len(left)
    have = _counts(free, shards)
    surplus, moved = [], 0
    for n, seats in zip(have, left):
        surplus.append(moved)
        moved += max(0, n - seats)
    to, taken = F.lit(None).cast("int"), 0
    place = _per_shard(surplus) + F.col("_rank") - _per_shard(left)
    for shard, (n, seats) in enumerate(zip(have, left)):
        if seats > n:
            here = (place >= taken) & (place < taken + seats - n)
            to = F.when(here, F.lit(shard)).otherwise(to)
            taken += seats - n
    stays = F.col("_rank") < _per_shard(left)
    return (
        ranked(free, ["shard"], "_rank", total)
        .withColumn("shard", F.when(stays, F.col("shard")).otherwise(to))
        .drop("_rank")
    )


def settled_units(held: DataFrame, room: list[int], total: int) -> tuple[list, list[int]]:
    """Rounds of label propagation: granted (link, part, wish, members) of each
    round, and the room that is left.

    The last round is one that grants nothing: then no pending unit fits a shard.  As
    only shards with room for a unit are asked, each round settles at least the first
    request of every shard that is asked, so there is a last one.
    """
    rounds, cuts, pending = [], [], held
    for turn in itertools.count():
        moves = staged(granted(requests(pending, room, turn), room, total), "shard-moves")
        rounds.append(moves)
        taken = dict(moves.groupBy("wish").agg(F.sum("members")).collect())
        if not taken:
            break
        room = [n - taken.get(s, 0) for s, n in enumerate(room)]
        pending = pending.join(moves, ["link", "part"], "left_anti")
        if turn % PLANNED == PLANNED - 1:  # so a plan does not grow with the rounds
            pending = staged(pending, "shard-pending")
            if cuts:
                release(cuts.pop())
            cuts.append(pending)
    release(*cuts)
    return rounds, room


def assign_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, link, shard, slot)."""
    unit = ["link", "part"]
    rows = staged(described(documents), "shard-rows")
    total = rows.count()
    seats = ranked(rows.withColumn("_all", F.lit(0)), ["_all"], "_seat", total)
    first = F.pmod("_seat", F.lit(shards)).cast("int")
    state = staged(seats.withColumn("shard", first).drop("_all", "_seat"), "shard-start")
    sizes = staged(group_sizes(state), "shard-groups")
    alone, linked = split_by_links(state, sizes, total, shards)
    alone, linked = staged(alone, "shard-alone"), staged(linked, "shard-linked")
    members = linked.groupBy(*unit).agg(F.count(F.lit(1)).alias("members"))
    counts = linked.groupBy(*unit, "shard").agg(F.count(F.lit(1)).alias("held"))
    held = staged(counts.join(members, unit), "shard-held")
    rounds, room = settled_units(held, capacities(total, shards), total)
    settled = rounds[0]
    for moves in rounds[1:]:
        settled = settled.unionByName(moves)
    gathered = linked.join(settled.select(*unit, "wish"), unit).drop("shard", "part")
    scattered = linked.join(settled, unit, "left_anti").drop("part")
    whole = staged(
        seated(alone.unionByName(scattered), room, total).unionByName(
            gathered.withColumnRenamed("wish", "shard")
        ),
        "shard-seated",
    )
    release(rows, state, sizes, alone, linked, held, *rounds)
    return ranked(whole, ["shard"], "slot", total)


def shard_report(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    return assign_shards(documents, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
