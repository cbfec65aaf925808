"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots, bytes and rows are summed per slot, and a versioned
table maps slots to shards. Rebalancing edits the map: it moves slots, never single records, so a
new version says exactly which part of the data has to move.

The slot table has as many rows as there are slots, a parameter, whatever the size of the data; it
alone reaches the driver and is broadcast. The records are read twice and not moved: placing them
is a look-up. Only :func:`numbered` shuffles, and only the columns it is given.

Defined results: a null text has size 1 (no bytes, plus 1); a null key hashes like any other value;
repeated records share a slot; an empty table gives a map of empty slots; columns of the input that
have the name of an added column are replaced.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: ``shards[s]`` is the shard of slot s."""
    version: int
    shards: tuple

    def moved_from(self, other: "SlotMap") -> list:
        return [s for s, (a, b) in enumerate(zip(other.shards, self.shards)) if a != b]


def slot_of(keys, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_weights(records: DataFrame, keys, size: Column, slots: int = SLOTS) -> list:
    """(rows, bytes) of each slot."""
    sums = records.groupBy(slot_of(keys, slots).alias("slot")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    weights = [(0, 0)] * slots
    for slot, rows, size_sum in sums.collect():  # at most one row per slot
        weights[slot] = (rows, size_sum)
    return weights


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    return SlotMap(1, tuple(s % shards for s in range(slots)))


def rebalanced(current: SlotMap, loads, shards: int) -> SlotMap:
    """The next version: slots moved from the fullest shard to the emptiest until no move narrows
    the gap between them. ``shards`` may be larger than before; a smaller number first sends the
    slots of the removed shards to the emptiest ones."""
    homes = [[] for _ in range(shards)]
    for slot, shard in enumerate(current.shards):
        if shard < shards:
            homes[shard].append(slot)
    total = [sum(loads[s] for s in home) for home in homes]
    for slot in sorted((s for s, h in enumerate(current.shards) if h >= shards),
                       key=lambda s: (-loads[s], s)):
        to = min(range(shards), key=lambda h: (total[h], h))
        homes[to].append(slot)
        total[to] += loads[slot]
    while True:
        full = max(range(shards), key=lambda h: (total[h], -h))
        bare = min(range(shards), key=lambda h: (total[h], h))
        gap = total[full] - total[bare]
        fitting = [s for s in homes[full] if 0 < loads[s] < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(2 * loads[s] - gap), s))
        homes[full].remove(slot)
        homes[bare].append(slot)
        total[full] -= loads[slot]
        total[bare] += loads[slot]
    shard_of = {slot: shard for shard, home in enumerate(homes) for slot in home}
    return SlotMap(current.version + 1, tuple(shard_of[s] for s in range(len(current.shards))))


def map_rows(spark: SparkSession, slot_map: SlotMap, weights=None) -> DataFrame:
    """The map as a table; with weights also each slot's first position in its shard."""
    weights = weights or [(0, 0)] * len(slot_map.shards)
    seen, rows = {}, []
    for slot, shard in enumerate(slot_map.shards):
        rows.append((slot, shard, weights[slot][0], weights[slot][1], seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + weights[slot][0]
    return spark.createDataFrame(
        rows, "virtual_slot int, shard int, rows long, bytes long, offset long").coalesce(1)


def save_map(table: DataFrame, root: str, version: int) -> None:
    table.write.mode("overwrite").parquet(f"{root}/version={version}")


def load_map(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, by default the newest."""
    stored = spark.read.parquet(root)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def placed(records: DataFrame, keys, stored_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The records with ``virtual_slot``, ``shard`` and the slot's ``offset`` in its shard."""
    bare = records.drop("virtual_slot", "shard", "offset")
    slot = bare.withColumn("virtual_slot", slot_of(keys, slots))
    return slot.join(F.broadcast(stored_map.select("virtual_slot", "shard", "offset")),
                     "virtual_slot", "left")


def numbered(rows: DataFrame, order) -> DataFrame:
    """``slot``: the row's place in its shard, without gaps from 0. Rows are ranked inside their
    virtual slot, so the work is split over thousands of slots and not over a few shards."""
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    return rows.withColumn("slot", F.col("offset") + rank - 1).drop("offset")


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder for each shard."""
    rows.drop("offset").write.partitionBy("shard").parquet(path)
