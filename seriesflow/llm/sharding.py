"""Sharding by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.llm.common import materialize, number_rows

CELLS, FILL_CELLS = 512, 4096


def flows(demand: dict, load: dict, target: dict) -> dict:
    """How many of the ``demand`` moves (from, to) to admit so that no shard ends above its target.

    All moves at first; then the moves into a shard that would overflow shrink in
    proportion, which also shrinks what leaves other shards, until all fit.
    A table of shards x shards numbers.
    """
    admitted = {k: float(n) for k, n in demand.items()}
    for _ in range(200):
        worst = 0.0
        for s in target:
            into = sum(n for (a, b), n in admitted.items() if b == s)
            out = sum(n for (a, b), n in admitted.items() if a == s)
            over = load.get(s, 0) - out + into - target[s]
            if into > 0 and over > 0:
                scale = max(0.0, 1 - over / into)
                admitted = {k: n * scale if k[1] == s else n for k, n in admitted.items()}
                worst = max(worst, over)
        if worst < 0.5:
            break
    return admitted


def balanced_shards(docs: DataFrame, shards: int = 16, max_rounds: int = 16,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, link, shard, slot, moved.

    Documents with equal texts are linked through their text's digest (a star,
    not all pairs). Every linked document starts in a shard by its hash. In
    each round a group's members look at how many of them each shard holds and
    move to the fullest shard that is open (ties by a hash of group and shard,
    so that groups spread). How many may move from one shard to another is set
    by ``flows``; moves are admitted cell by cell up to that quota (16 x 16 x
    512 cells at most, broadcast). A shard that has to turn moves away is
    closed to later rounds, so a group larger than one shard fills one after
    another. Rounds end when nobody wants to move or all shards are closed. Documents without links have no edges to cut: they fill the shards
    up, so shard sizes in rows differ by one at most (larger ones first).

    Null texts have size 1, crc32 0 and no link; empty texts are linked like
    any other equal texts. Repeated rows are separate members of their group.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    base = materialize(docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.md5(text.cast("binary")).alias("link")), "shard-base")
    groups = materialize(base.where("link is not null").groupBy("link").agg(F.count(F.lit(1)).alias("members"))
                         .where("members > 1"), "shard-groups")
    total = base.count()
    target = {s: total // shards + (s < total % shards) for s in range(shards)}
    label = F.pmod(F.xxhash64("doc_id", "link"), F.lit(shards)).cast("int")
    # A group of many members is spread over cells; a small one shares a cell and so moves as a whole.
    spread = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("members") / 64))
    state = materialize(base.join(groups, "link").withColumn("shard", label)
                        .withColumn("cell", F.pmod(F.xxhash64("link") + spread * 7919, F.lit(CELLS)).cast("int"))
                        .drop("members"), "shard-state")
    closed: set[int] = set()  # shards that had to turn moves away
    for _ in range(max_rounds):
        load = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}  # one row a shard
        held = materialize(state.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n")), "shard-held")
        rank = F.struct("n", F.xxhash64("link", "shard").alias("tie"), F.col("shard").alias("s"))
        open_shards = [s for s in range(shards) if s not in closed]
        if not open_shards:
            break
        best = held.where(F.col("shard").isin(open_shards)).groupBy("link").agg(F.max(rank).alias("best"))
        wish = (held.join(best, "link").where(F.col("best") > rank)
                .select("link", "shard", F.col("best.s").alias("target")))
        asked = materialize(state.join(materialize(wish, "shard-wish"), ["link", "shard"], "left"), "shard-asked")
        cells = materialize(asked.where("target is not null").groupBy("shard", "target", "cell")
                            .agg(F.count(F.lit(1)).alias("n")), "shard-cells")
        demand = {(r["shard"], r["target"]): r["n"] for r in
                  cells.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()}  # at most shards x shards rows
        allowed = flows(demand, load, target)
        closed |= {b for (a, b), n in demand.items() if allowed[a, b] < n - 0.5}
        quotas = [(a, b, int(n)) for (a, b), n in allowed.items() if n >= 1]
        if not demand or len(closed) == shards and not quotas:
            break
        if not quotas:
            continue
        w = (Window.partitionBy("shard", "target").orderBy(F.xxhash64("shard", "target", "cell"), "cell")
             .rowsBetween(Window.unboundedPreceding, 0))
        quota = spark.createDataFrame(quotas, "shard int, target int, quota long")
        admitted = materialize(cells.join(F.broadcast(quota), ["shard", "target"]).withColumn("sum", F.sum("n").over(w))
                               .where("sum <= quota").select("shard", "target", "cell", F.lit(True).alias("go")), "shard-admitted")
        state = materialize(asked.join(F.broadcast(admitted), ["shard", "target", "cell"], "left")
                            .withColumn("shard", F.when(F.col("go"), F.col("target")).otherwise(F.col("shard")))
                            .drop("target", "go"), "shard-state")
    placed = number_rows(state.drop("cell"), ["shard"], ["doc_id", "link"], "shard-placed", 256, "slot")
    quota = F.element_at(F.array(*[F.lit(target[s]).cast("long") for s in range(shards)]), F.col("shard") + 1)
    placed = materialize(placed.withColumn("over", F.col("slot") >= quota), "shard-placed-rows")
    free = base.join(groups.select("link"), "link", "left_anti").select("doc_id", "size", "text_crc32", "link")
    free = materialize(free.unionByName(placed.where("over").select(*free.columns)), "shard-free")
    full = {r["shard"]: r["count"] for r in placed.where("not over").groupBy("shard").count().collect()}
    numbered = number_rows(free.withColumn("one", F.lit(0)), ["one"], ["doc_id", "link"], "shard-fill", FILL_CELLS).drop("one")
    shard, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        need = target[s] - full.get(s, 0)
        here = (F.col("idx") >= at) & (F.col("idx") < at + need)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("idx") - at + full.get(s, 0)).otherwise(slot)
        at += need
    filled = numbered.withColumn("shard", shard).withColumn("slot", slot.cast("long")).drop("idx")
    return (placed.where("not over").drop("over").withColumn("linked", F.lit(True))
            .unionByName(filled.withColumn("linked", F.lit(False))))


def cut_edges(sharded: DataFrame) -> DataFrame:
    """Of all pairs of documents with equal texts: how many there are, and how many lie in two shards."""
    per = sharded.where("link is not null").groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy("link").agg(F.sum("n").alias("n"), F.sum(F.expr("n * (n - 1) / 2")).alias("kept"))
            .agg(F.coalesce(F.sum(F.expr("n * (n - 1) / 2")), F.lit(0.0)).alias("edges"),
                 F.coalesce(F.sum(F.expr("n * (n - 1) / 2 - kept")), F.lit(0.0)).alias("cut")))
