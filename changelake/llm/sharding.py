"""Operator 11, sharding by fixed virtual slots.

1. Every record is hashed by its id into one of ``SLOTS`` virtual slots. The number of slots
   never changes, whatever the number of shards.
2. Bytes are aggregated per slot. A slot of several records and more than a ``SPLIT``-th of a shard's share, such as
   that of one id (or of the null id) with many rows, is divided by the records' texts into
   ``FRAGMENTS`` fragments, and a fragment that is still larger, such as one of equal rows, by the
   records' places in the stored record table.
3. The slot map names the shard of every slot, fragment and part of a fragment, whichever is the
   unit. Units are placed from the largest down, each on the shard with the fewest bytes so far.
4. Maps are stored as versions. ``rebalance`` edits the newest one for other sizes or another
   number of shards: units move from the fullest to the emptiest shard until the shards are
   near equal, and all others stay. A shard over its share that can give nothing is left aside.
5. Within its shard a record has a gapless number from 0, in no particular order. Records are
   numbered within chunks of the stored table, and the chunks' counts are summed up, so no
   shard passes through one task.

Only the map passes through the driver: at most ``SLOTS`` slots, the fragments of at most ``SPLIT``
x shards large slots and the parts of as many large fragments, however many records there are.

Defined cases: null text has no bytes (size 16, checksum 0); a null id is an id like any other;
repeated rows are records of their own; an empty table has an empty map; a single record larger
than a shard's share cannot be divided and leaves its shard over it; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.llm.store import stored, table
from changelake.session import scratch_dir
from changelake.sources import fs

SHARDS = 40
SLOTS = 8192
FRAGMENTS = 64
#: Shards are near equal when the fullest and the emptiest differ by at most 1 of so many of the mean.
NEAR = 200
#: A slot of more than this part of a shard's share is dealt out by fragments.
SPLIT = 8
OVERHEAD = 16
CHUNK = 1 << 16
#: Shards of a slot: by fragment, then by part; a list of one stands for all.
MAP = "slot int, shards array<array<int>>"

Unit = tuple[int, int, int]
Shards = list[list[int]]


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """The record table: doc_id, size, text_crc32, virtual_slot, fragment, and the record's
    place (file, chunk, at) in the stored table."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32")), "shard-records")
    placed = base.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    part = lambda *c: F.pmod(F.xxhash64(*c), F.lit(FRAGMENTS)).cast("int")
    return placed.select("doc_id", "size", "text_crc32", F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("virtual_slot"),
                         part("text_crc32", "size").alias("fragment"), part("file", "at").alias("part"),
                         "file", F.floor(F.col("at") / CHUNK).alias("chunk"), "at")


def units(rows: DataFrame, shards: int) -> dict[Unit, int]:
    """Bytes of every unit (slot, fragment, part); an undivided slot or fragment is its part 0."""

    def sums(some: DataFrame, *by: str) -> dict[Unit, tuple[int, int]]:
        got = some.groupBy(*by).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        return {(r.virtual_slot, r.fragment if "fragment" in by else 0, r.part if "part" in by else 0): (r["size"], r.n) for r in got}

    out = sums(rows, "virtual_slot")
    most = sum(n for n, _ in out.values()) / (shards * SPLIT)
    for by in ("fragment", "part"):
        large = {u for u, (n, records) in out.items() if n > most and records > 1}
        if not large:
            break
        key = F.col("virtual_slot") if by == "fragment" else F.col("virtual_slot") * FRAGMENTS + F.col("fragment")
        named = [s if by == "fragment" else s * FRAGMENTS + f for s, f, _ in large]
        parts = dict.fromkeys([(s, k, 0) if by == "fragment" else (s, f, k) for s, f, _ in large for k in range(FRAGMENTS)], (0, 0))
        parts.update(sums(rows.where(key.isin(named)), *("virtual_slot", "fragment", "part")[:2 if by == "fragment" else 3]))
        out = {u: n for u, n in out.items() if u not in large} | parts
    return {u: n for u, (n, _) in out.items()}


def _largest_first(sizes: Mapping[Unit, int]) -> list[tuple[Unit, int]]:
    return sorted(sizes.items(), key=lambda x: (-x[1], x[0]))


def build(sizes: Mapping[Unit, int], shards: int) -> dict[Unit, int]:
    """The shard of every unit, from the largest unit down."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for unit, n in _largest_first(sizes):
        load, k = heapq.heappop(heap)
        out[unit] = k
        heapq.heappush(heap, (load + n, k))
    return out


def rebalance(now: Mapping[int, Shards], sizes: Mapping[Unit, int], shards: int) -> dict[Unit, int]:
    """The shard of every unit after few moves: from the fullest to the emptiest shard, the
    largest unit that fits the smaller of their gaps to the mean. Units of shards that are gone,
    and of slots that the map does not have, are placed first."""
    held: list[list[tuple[int, Unit]]] = [[] for _ in range(shards)]
    load, homeless = [0] * shards, []

    def put(unit: Unit, n: int, k: int) -> None:
        held[k].append((n, unit))
        load[k] += n

    for unit, n in _largest_first(sizes):
        slot, fragment, part = unit
        have = now.get(slot, [[shards]])
        have = have[fragment % len(have)]
        k = have[part % len(have)]
        if k < shards:
            put(unit, n, k)
        else:
            homeless.append((unit, n))
    for unit, n in homeless:
        put(unit, n, min(range(shards), key=load.__getitem__))
    active = set(range(shards))
    while len(active) > 1:
        mean = sum(load[k] for k in active) / len(active)
        full, low = max(active, key=load.__getitem__), min(active, key=load.__getitem__)
        if NEAR * (load[full] - load[low]) <= mean:
            break
        gap = min(load[full] - mean, mean - load[low])
        fits = max(((n, unit) for n, unit in held[full] if 0 < n <= gap), default=None)
        if fits is None:  # nothing fits under the mean: the least unit, if that still evens the two
            fits = min(((n, unit) for n, unit in held[full] if 0 < n < load[full] - load[low]), default=None)
        if fits is None:
            active.remove(full)
            continue
        held[full].remove(fits)
        load[full] -= fits[0]
        put(fits[1], fits[0], low)
    return {unit: k for k in range(shards) for _, unit in held[k]}


def by_slot(placed: Mapping[Unit, int]) -> dict[int, Shards]:
    """A map's rows: the shards of every slot, by fragment and part."""
    out: dict[int, Shards] = {}
    for (slot, fragment, part), shard in sorted(placed.items()):
        have = out.setdefault(slot, [])
        if part == 0:
            have.append([])
        have[fragment].append(shard)
    return out


def versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions of the map below ``root``."""
    names = [n for n in fs.children(spark, root) if n.startswith("version=") and fs.exists(spark, f"{root}/{n}/_SUCCESS")]
    return sorted(int(n.partition("=")[2]) for n in names)


def save(spark: SparkSession, root: str, shards_of: Mapping[int, Shards]) -> int:
    """Store the map as the next version; a stored version is never changed."""
    version = max(versions(spark, root), default=0) + 1
    spark.createDataFrame(sorted(shards_of.items()), MAP).coalesce(1).write.parquet(f"{root}/version={version}")
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the newest by default; at most ``SLOTS`` rows."""
    have = versions(spark, root)
    if version is None and have:
        version = have[-1]
    if version not in have:
        raise FileNotFoundError(f"no version {version} of the slot map below {root}")
    return spark.read.schema(MAP).parquet(f"{root}/version={version}")


def placed(rows: DataFrame, slot_map: DataFrame, name: str = "shard") -> DataFrame:
    """``rows`` with the shard that the map gives them."""
    entries = F.broadcast(slot_map.select(F.col("slot").alias("virtual_slot"), F.col("shards").alias("_shards")))
    inner = F.element_at("_shards", F.pmod(F.col("fragment"), F.size("_shards")) + 1)
    shard = F.element_at(inner, F.pmod(F.col("part"), F.size(inner)) + 1)
    return rows.join(entries, "virtual_slot").withColumn(name, shard).drop("_shards")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``, their gapless number from 0 in their shard."""
    cell = ["file", "chunk", "shard"]
    within = F.row_number().over(Window.partitionBy(*cell).orderBy("at")) - 1
    before = Window.partitionBy("shard").orderBy("file", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*cell).agg(F.count("*").alias("n")).select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.withColumn("within", within).join(offsets, cell).withColumn("slot", (F.col("offset") + F.col("within")).cast("long"))


def plan(rows: DataFrame, root: str, shards: int = SHARDS) -> int:
    """Store the next version of the map below ``root``: the newest one edited for these records
    and this number of shards, or a new one. Returns its version."""
    spark = rows.sparkSession
    sizes = units(rows, shards)
    if versions(spark, root):
        now = {r.slot: r.shards for r in load(spark, root).collect()}
        return save(spark, root, by_slot(rebalance(now, sizes, shards)))
    return save(spark, root, by_slot(build(sizes, shards)))


def shard(docs: DataFrame, root: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, slot (the number in the shard) and
    map_version of every row, under the next version of the map below ``root``."""
    rows = records(docs, id_col, text_col, slots)
    version = plan(rows, root, shards)
    return numbered(placed(rows, load(docs.sparkSession, root, version))).select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot", F.lit(version).alias("map_version"))


def query(spark, sf_dir: str) -> DataFrame:
    """Besides the contract's columns: virtual_slot, map_version, and next_shard, the shard under
    the version edited for one more shard."""
    root = scratch_dir(spark, "llm", "slot-map", fresh=True)
    rows = records(table(spark, sf_dir, "documents"))
    version, grown = plan(rows, root), plan(rows, root, SHARDS + 1)
    both = placed(placed(rows, load(spark, root, version)), load(spark, root, grown), "next_shard")
    return numbered(both).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                 F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(version).alias("map_version"), "next_shard")
