"""Balanced label propagation: documents linked by equal texts move to one shard under row quotas.

The law is ``rows``: shard sizes differ by at most one row. Links are the equal
texts; a group's documents fall into at most ``cells`` cells (group, id hash), so
a group of any size is at most that many rows. Cells start without a shard, except
those of groups larger than a quota (fewer than there are shards), which fill shards of
their own. Each round counts the votes of every group (its rows in each shard) and joins
them with the cells; what lies apart asks for the shard where most of its neighbours are
and room is left; a group that is nowhere yet asks as a whole for a shard with room for
all of it, drawn by room, and only where no shard has that room, cell by cell for the
emptiest. Large groups ask before small ones. Asks are admitted bucket by bucket, larger groups
first, as far as the shard's quota goes, so cut links are the parts that quotas force
apart. It ends when no cell asks; cells that fit nowhere any more are dealt with the
documents without links, which fill the quotas up.

Everything is DataFrame operations; only per-shard numbers (``shards`` or ``shards`` x
buckets rows) and the groups larger than a quota reach the driver. Defined results: null texts
have no links, size 1 and a null text_crc32; empty texts are equal texts; equal rows take
different slots; long texts count by their digest; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewatch.llm.common import dense_index, kept, read, register

#: groups ask together whose rows are within this factor
RANGE = 8


def _pick(values: list[int], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index + 1)


def seeded(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Cells (grp, cell, n, shard) with those of groups larger than a quota on shards of their own, the rest on -1."""
    large = cells.groupBy("grp").agg(F.sum("n").alias("size")).filter(F.col("size") > max(quotas)) \
        .orderBy(F.desc("size"), "grp").collect()          # fewer than shards: quotas add up to all rows
    free, rows = list(range(len(quotas))), []
    for g in large:
        left, at = g["size"], 0
        while free and left >= quotas[free[0]] > 0:
            s = free.pop(0)
            rows.append((bytes(g["grp"]), at, at + quotas[s], s))
            at, left = at + quotas[s], left - quotas[s]
    if not rows:
        return cells.withColumn("shard", F.lit(-1))
    places = cells.sparkSession.createDataFrame(rows, "_grp binary, lo long, hi long, s int")      # at most shards rows
    upto = F.sum("n").over(Window.partitionBy("grp").orderBy("cell"))            # at most ``cells`` rows a group
    run = cells.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("n"))
    inside = (F.col("grp") == F.col("_grp")) & (F.col("_from") >= F.col("lo")) & (F.col("_to") <= F.col("hi"))
    return run.join(F.broadcast(places), inside, "left").select("grp", "cell", "n", F.coalesce("s", F.lit(-1)).alias("shard"))


def propagate(cells: DataFrame, quotas: list[int], rounds: int = 300, ladder: int = 256) -> DataFrame:
    """Cells (grp, cell, n, shard) after label propagation; no shard's load passes its quota. -1: fits nowhere.

    Raises if cells still move after ``rounds`` rounds.
    """
    shards, below, fine = len(quotas), None, ladder
    for step in range(rounds):
        votes = [F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)) for s in range(shards)]
        groups = kept(cells.groupBy("grp").agg(F.sum(F.when(F.col("shard") < 0, F.col("n")).otherwise(0)).alias("left"),
                                               F.array(*votes).alias("votes")))
        waiting = F.col("left") if below is None else F.when(F.col("left") < below, F.col("left"))
        seen = groups.agg(F.max(waiting).alias("most"), *[F.sum(F.col("votes")[s]).alias(f"s{s}") for s in range(shards)]).first()
        free = [max(0, q - int(seen[f"s{s}"] or 0)) for s, q in enumerate(quotas)]
        most = int(seen["most"] or 0)
        least = max(1, most // RANGE)                       # the largest groups that wait ask first
        # where most neighbours are and room is left
        room = F.array(*[F.lit(f).cast("long") for f in free])
        known = F.array_max(F.transform("votes", lambda v, s: F.when((v > 0) & (F.get(room, s) > 0), F.struct(
            v.alias("votes"), F.pmod(F.xxhash64("grp", s), F.lit(1 << 20)).alias("tie"), s.alias("to")))))
        if not any(free):
            return cells
        # nowhere yet: a shard with room for all, else one of the emptiest, drawn by room
        enough = F.when(F.array_max(room) >= F.col("left"), F.col("left")).otherwise(F.lit(-(-max(free) // 2)))
        whole = F.transform(room, lambda f: F.when(f >= enough, f).otherwise(0))
        total = F.aggregate("whole", F.lit(0).cast("long"), lambda a, f: a + f)
        place = F.pmod(F.xxhash64("grp", F.lit(step)), F.col("total"))
        drawn = F.aggregate("whole", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("to")),
                            lambda a, f: F.struct((a["sum"] + f).alias("sum"), F.when(a["sum"] + f <= F.col("place"), a["to"] + 1)
                                                  .otherwise(a["to"]).alias("to")))["to"]
        asks_now = (F.col("left") >= least) & (F.col("left") > 0) & (F.lit(True) if below is None else F.col("left") < below)
        told = groups.withColumns({"known": known, "whole": whole}).withColumn("total", total).withColumn("place", place) \
            .withColumn("to", F.when(F.col("known").isNotNull(), F.col("known.to")).otherwise(drawn))
        told = told.select("grp", "left", "votes", "known", "to", asks_now.alias("now"),
                           (F.get(room, F.col("to")) >= F.col("left")).alias("fits"))
        joined = cells.join(told, "grp")
        fresh = (F.col("shard") < 0) & F.col("now")
        moves = (F.col("shard") >= 0) & (F.col("known.votes") > F.get("votes", F.col("shard")))
        size = F.when(F.col("shard") < 0, F.col("left")).otherwise(F.col("known.votes"))
        apart = F.when((F.col("shard") < 0) & F.col("fits"), F.lit(-1)).otherwise(F.col("cell"))    # a whole group in one bucket
        asks = kept(joined.filter((fresh | moves) & (F.get(room, F.col("to")) > 0)).select(
            "grp", "cell", "n", "to", ((64 - F.floor(F.log2(size))) * fine
                                       + F.pmod(F.xxhash64("grp", apart, F.lit(step)), F.lit(fine))).cast("long").alias("bucket")))
        ahead = Window.partitionBy("to").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ranked = asks.groupBy("to", "bucket").agg(F.sum("n").alias("n")) \
            .withColumn("fits", F.sum("n").over(ahead) <= _pick(free, F.col("to")))       # shards x 64 x ladder rows at most
        asked = ranked.groupBy("fits").agg(F.count("*").alias("n")).collect()
        if any(r["fits"] for r in asked):
            admitted = asks.join(ranked.filter("fits").select("to", "bucket"), ["to", "bucket"]).select("grp", "cell", "to")
            cells = kept(cells.join(admitted, ["grp", "cell"], "left")
                         .select("grp", "cell", "n", F.coalesce("to", "shard").alias("shard")))
            fine = ladder
        elif asked and fine < 1 << 16:
            fine *= 16                                      # finer buckets before giving up
        elif most and most > least:
            below, fine = least, ladder                     # these fit nowhere; smaller ones may
        elif most > 1:
            below, fine = most, ladder
        else:
            return cells
    raise RuntimeError(f"cells still move after {rounds} rounds")


def assign_shards(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = 16, rounds: int = 300,
                  cells: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    raw = F.col(text).cast("binary")
    base = kept(docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("grp")))
    total = base.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int")
    counted = base.filter("grp is not null").groupBy("grp", cell.alias("cell")).agg(F.count("*").alias("n"))
    linked = kept(counted.withColumn("g", F.sum("n").over(Window.partitionBy("grp"))).filter("g > 1").select("grp", "cell", "n"))
    placed = propagate(kept(seeded(linked, quotas)), quotas, rounds).filter("shard >= 0").select("grp", "cell", "shard")
    rows = kept(base.withColumn("cell", cell).join(placed, ["grp", "cell"], "left")
                .withColumn("label", F.coalesce("shard", F.lit(-1)))
                .select("doc_id", "size", "text_crc32", "label"))
    found = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    held = [int(found.get(s, 0)) for s in range(shards)]
    over = [max(0, x - q) for x, q in zip(held, quotas, strict=True)]
    room = [max(0, q - x) for x, q in zip(held, quotas, strict=True)]
    singles = int(found.get(-1, 0))
    numbered = dense_index(rows, "label", ["doc_id", "size", "text_crc32"], "i", per_task=5000)
    stays = (F.col("label") >= 0) & (F.col("i") < _pick([*quotas, 0], F.greatest("label", F.lit(0))))
    spill = [singles + sum(over[:s]) for s in range(shards)]
    filler = F.when(F.col("label") < 0, F.col("i")).otherwise(
        F.col("i") - _pick([*quotas, 0], F.greatest("label", F.lit(0))) + _pick([*spill, 0], F.greatest("label", F.lit(0))))
    upto = [sum(room[:s + 1]) for s in range(shards)]
    to = sum(((F.col("f") >= F.lit(u)).cast("int") for u in upto[:-1]), F.lit(0))
    first = [sum(room[:s]) for s in range(shards)]
    base_slot = [min(x, q) for x, q in zip(held, quotas, strict=True)]
    return (numbered.withColumn("f", F.when(stays, F.lit(None).cast("long")).otherwise(filler))
            .withColumn("shard", F.when(stays, F.col("label")).otherwise(to).cast("int"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.when(F.col("f").isNull(), F.col("i"))
                    .otherwise(F.col("f") - _pick(first, F.col("shard")) + _pick(base_slot, F.col("shard"))).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


@register("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))
