"""Balanced label propagation over shards, with DataFrame operations only.

Every linked document starts with a shard taken from the smallest id around it,
so small groups start together. Each round joins links with the neighbours'
current shards, takes the most frequent one as the wish, and settles the wishes
under the quota of each shard: wishes are ranked inside the shard, the first
``quota`` stay, the rest fill the free places of other shards in rank order, so
that a group larger than a shard fills whole shards. Unlinked documents then
fill what is left. The law is ``rows``: shard counts differ by one at most.

Ranks come from two levels (cells of about ``CELL_ROWS`` rows by hash, prefix
sums over the cells), so no task sorts a whole shard and a group holding a
third of all rows is spread over many cells.

Edge cases: a null or empty text has no group, size 1 (no bytes plus 1) and the
checksum 0; repeated rows (and null ids) are separate rows with slots of their
own; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS = 16
CELL_ROWS = 4096


def _cells(community: Column, community_size: Column, row: Column, buckets: int) -> list[Column]:
    """Cell of a row: hash bucket of its community; a large community has cells of its own."""
    large = community_size > CELL_ROWS
    parts = F.ceil(community_size / F.lit(CELL_ROWS))
    return [F.pmod(F.xxhash64(community), F.lit(buckets)).alias("cell"),
            F.when(large, community).otherwise(F.lit(-1)).alias("own"),
            F.when(large, F.pmod(F.xxhash64(row), parts)).otherwise(F.lit(0)).alias("part")]


def ranked(rows: DataFrame, by: list[str], out: str) -> DataFrame:
    """Gapless position of each row within ``by``, in order (cell, own, part, community, row)."""
    keys = [*by, "cell", "own", "part"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_"))
    before = Window.partitionBy(*by).orderBy("cell", "own", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"))
    inside = Window.partitionBy(*keys).orderBy("community", "row")
    numbered = rows.withColumn("at_", F.row_number().over(inside) - 1)
    return (numbered.join(starts, keys).withColumn(out, F.col("start_") + F.col("at_")).drop("start_", "at_"))


def _interval(position: Column, sizes: list[int]) -> tuple[Column, Column]:
    """Shard and offset inside it of a position, when shard k takes sizes[k] positions."""
    shard, offset, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for k, size in enumerate(sizes):
        here = (position >= start) & (position < start + size)
        shard = F.when(here, F.lit(k)).otherwise(shard)
        offset = F.when(here, position - start).otherwise(offset)
        start += size
    return shard, offset


def settle(wishes: DataFrame, quotas: list[int], name: str) -> tuple[DataFrame, list[int]]:
    """(row, community, cell.., shard) wishes to kept places: shard and slot, counts within the quotas.

    Returns the placed rows and the rows per shard.
    """
    shards = len(quotas)
    placed = ranked(wishes, ["shard"], "slot")
    quota = F.element_at(F.array(*[F.lit(int(q)).cast("long") for q in quotas]), F.col("shard") + 1)
    placed = materialize(placed.withColumn("kept", F.col("slot") < quota), f"{name}-ranked")
    kept = {r["shard"]: r["n"] for r in placed.where("kept").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    kept = [kept.get(k, 0) for k in range(shards)]
    free = [q - n for q, n in zip(quotas, kept, strict=True)]
    homeless = ranked(placed.where("NOT kept").drop("slot", "shard"), ["kept"], "position")
    shard, offset = _interval(F.col("position"), free)
    base = F.element_at(F.array(*[F.lit(int(n)).cast("long") for n in kept]), F.col("shard") + 1)
    homeless = (homeless.withColumn("shard", shard).withColumn("slot", offset + base)
                .drop("position"))
    out = materialize(placed.where("kept").unionByName(homeless).drop("kept"), name)
    counts = {r["shard"]: r["n"] for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return out, [counts.get(k, 0) for k in range(shards)]


def propagate(links: DataFrame, quotas: list[int], rounds: int = 2) -> tuple[DataFrame, list[int]]:
    """Places of all linked rows. ``links``: pairs (a, b) of row numbers, a != b."""
    shards = len(quotas)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    start = (both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("community"))
             .withColumnRenamed("a", "row"))
    start = materialize(start, "op9-start")
    sizes = start.groupBy("community").agg(F.count("*").alias("size_"))
    total = sum(quotas)
    buckets = max(1, total // CELL_ROWS)
    nodes = start.join(sizes, "community").select(
        "row", "community", *_cells(F.col("community"), F.col("size_"), F.col("row"), buckets))
    nodes = materialize(nodes, "op9-nodes")
    wishes = nodes.withColumn("shard", F.pmod(F.xxhash64(F.col("community")), F.lit(shards)).cast("int"))
    places, counts = settle(wishes, quotas, "op9-round0")
    for k in range(1, rounds + 1):
        labels = places.select(F.col("row").alias("b"), "shard")
        votes = both.join(labels, "b").groupBy("a", "shard").agg(F.count("*").alias("n"))
        best = (votes.groupBy("a").agg(F.max(F.struct("n", (-F.col("shard")).alias("s"))).alias("best"))
                .select(F.col("a").alias("row"), (-F.col("best.s")).cast("int").alias("wish")))
        wishes = (places.drop("slot").withColumnRenamed("shard", "old").join(best, "row", "left")
                  .withColumn("shard", F.coalesce("wish", "old")).drop("wish", "old"))
        places, counts = settle(wishes, quotas, f"op9-round{k}")
    return places, counts


def quotas_for(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = 2) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.xxhash64(text).alias("digest"))
    # the row number is fixed once written
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "op9-rows")
    total = base.count()
    if total == 0:
        return base.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    key = ["digest", "size", "text_crc32"]
    hubs = (base.groupBy(*key).agg(F.min("row").alias("hub"), F.count("*").alias("copies"))
            .where("copies > 1").drop("copies"))
    links = (base.select("row", *key).join(hubs, key).where("row <> hub")
             .select(F.col("row").alias("a"), F.col("hub").alias("b")))
    links = materialize(links, "op9-links")
    quotas = quotas_for(total, shards)
    places, counts = propagate(links, quotas, rounds)

    buckets = max(1, total // CELL_ROWS)
    alone = (base.select("row").join(places.select("row"), "row", "left_anti")
             .withColumn("community", F.col("row")).withColumn("all", F.lit(0))
             .select("row", "community", "all", *_cells(F.col("row"), F.lit(1), F.col("row"), buckets)))
    filled = ranked(alone, ["all"], "position")
    shard, offset = _interval(F.col("position"), [q - n for q, n in zip(quotas, counts, strict=True)])
    first = F.element_at(F.array(*[F.lit(int(n)).cast("long") for n in counts]), F.col("shard") + 1)
    filled = filled.withColumn("shard", shard).withColumn("slot", offset + first)
    where = places.select("row", "shard", "slot").unionByName(filled.select("row", "shard", "slot"))
    return (base.join(where, "row")
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                    F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
