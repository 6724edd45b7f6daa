"""Sharding by balanced label propagation, under the law ``rows``: shard sizes differ by one row at most.

Documents with equal texts are linked. A group of them is a hub, so that a document's neighbours in a shard are counted per
(group, shard) and links are never written out as pairs.

The first labels are dealt by a hash of the row, evenly along the quotas, so that a group is cut as chance has it. Then in each round every
cell (the rows of a group in one shard) wants to go to a shard of its group that has room for the whole of it, of these to the one that
holds most, equal ones told apart by a hash of group and round. Between two shards as many rows move one way as the other, and beyond that as
many as the target's quota leaves free, so that sizes stay even all along. The rounds end when three of them in a row have joined no cells. Of
what they leave, the groups still cut lie one after the other along the room of the whole ones, so that only a group on the border of two
shards is cut: of the small groups at most one per border. Documents without links fill the quotas at the end.

Groups above a 64th of a shard, at most 64 for each shard, are packed beforehand: one larger than a shard fills shards of its own and puts
its rest where it fits. Propagation would spread them, as each of their cells is the largest of its shard.

Rows of one cell are interchangeable, so cells are what moves, and rows are dealt to them by their rank in the group.

Ranks and running quotas are computed in hash buckets, never over a whole group or shard in one task.

Defined results: a NULL text is linked to the empty text and has size 1. NULL doc_ids and repeated rows are rows like any other;
identical rows may be dealt to different slots. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import running_sum
from feedloom.scratch import materialize, scratch_path

SHARDS = 16
#: Rounds without a gain after which they end.
PATIENCE = 3
#: Groups above this part of a shard are packed one by one, on the driver.
SMALL = 64


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def placed_whole(groups: list[tuple[bytes, int]], quota: list[int]) -> tuple[list[tuple[bytes, int, int]], list[int]]:
    """(digest, shard, n) of groups laid into empty shards, and the room that is left. Fullest and emptiest shard that fits are both
    tried; the emptiest wins if it cuts no more."""
    found = []
    for fullest in (False, True):
        room, cells, parts = list(quota), [], []
        for digest, rows in sorted(groups, key=lambda g: (-g[1], g[0])):
            for s, q in enumerate(quota):
                if rows >= q > 0 and room[s] == q:
                    cells.append((digest, s, q))
                    rows, room[s] = rows - q, 0
            parts.append((digest, rows))
        for digest, rows in sorted(parts, key=lambda g: (-g[1], g[0])):
            while rows:
                fits = [(room[s] if fullest else -room[s], s) for s in range(len(quota)) if room[s] >= rows]
                s = min(fits)[1] if fits else max(range(len(quota)), key=lambda s: (room[s], -s))
                n = min(rows, room[s])
                cells.append((digest, s, n))
                rows, room[s] = rows - n, room[s] - n
        found.append((cells, room))
    return min(found, key=lambda x: len(x[0]))


def along(groups: DataFrame, room: list[int]) -> DataFrame:
    """(digest, shard, n): ``groups`` (written: digest, rows) one after the other in hash order, over the shards in proportion to their room."""
    total, whole = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0], sum(room)
    ends = [total * sum(room[: s + 1]) // max(whole, 1) for s in range(len(room))]
    line = running_sum(groups.withColumn("all", F.lit(0)).withColumn("h", F.xxhash64("digest")), ["all"], "h", F.col("rows"), "start", bits=12, ties=("digest",))
    pieces = []
    for s, (start, end) in enumerate(zip([0, *ends], ends)):
        n = F.least(F.col("start") + F.col("rows"), F.lit(end)) - F.greatest(F.col("start"), F.lit(start))
        pieces.append(F.struct(F.lit(s).alias("shard"), n.cast("long").alias("n")))
    cut = line.select("digest", F.explode(F.filter(F.array(*pieces), lambda c: c["n"] > 0)).alias("cell"))
    return cut.select("digest", "cell.shard", "cell.n")


def allowances(wanted: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may move between each two shards: what moves back, and what the quota of the target leaves free."""
    allowed, left = {}, list(free)
    for (a, b), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        swap = min(n, wanted.get((b, a), 0))
        more = min(n - swap, left[b])
        left[b] -= more
        allowed[a, b] = swap + more
    return allowed


def propagate(cells: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """(digest, shard, n) when no round gains any more, or after ``rounds``. Cells of a group are at most one per shard.

    Each gain is a cell less, so the rounds end. What is collected is one number per shard or pair of shards.
    """
    spark = cells.sparkSession
    shards = len(quota)
    fewest, idle, i = cells.count(), 0, -1
    while idle < PATIENCE and (rounds is None or i + 1 < rounds):
        i += 1
        held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = [q - held.get(s, 0) for s, q in enumerate(quota)]
        spare = F.element_at(F.array(*[F.lit(n).cast("long") for n in free]), F.col("shard") + 1)
        rows = cells.groupBy("digest").agg(F.sum("n").alias("rows"), F.count("*").alias("cells")).filter("cells > 1")
        scored = cells.join(rows, "digest").withColumn("score", F.struct(spare >= F.col("rows") - F.col("n"), "n", F.xxhash64("digest", "shard", F.lit(i)), "shard"))
        scored = materialize(scored.select("digest", "shard", "n", "score"), scratch_path(spark, "shard-scored"))
        best = scored.groupBy("digest").agg(F.max("score").alias("best")).select("digest", F.col("best.shard").alias("to"))
        movers = scored.drop("score").join(best, "digest").filter("shard != to")
        movers = movers.withColumn("h", F.xxhash64("digest", "shard", F.lit(i)))
        movers = materialize(movers, scratch_path(spark, "shard-movers"))
        sums = movers.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()
        allowed = allowances({(r["shard"], r["to"]): r["n"] for r in sums}, free)
        if not sums:
            break
        table = F.array(*[F.lit(allowed.get((a, b), 0)).cast("long") for a in range(shards) for b in range(shards)])
        ranked = running_sum(movers, ["shard", "to"], "h", F.col("n"), "ahead", ties=("digest",))
        may = F.element_at(table, F.col("shard") * shards + F.col("to") + 1)
        moved = ranked.select("digest", "shard", "to", F.greatest(F.lit(0), F.least(F.col("n"), may - F.col("ahead"))).alias("go"))
        gone = moved.filter("go > 0")
        changes = cells.unionByName(gone.select("digest", "shard", (-F.col("go")).alias("n"))).unionByName(gone.select("digest", F.col("to").alias("shard"), F.col("go").alias("n")))
        cells = materialize(changes.groupBy("digest", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), scratch_path(spark, "shard-cells"))
        now = cells.count()
        fewest, idle = (now, 0) if now < fewest else (fewest, idle + 1)
    return cells


def dealt(rows: DataFrame, room: list[int]) -> DataFrame:
    """The first cells of ``rows`` (written: digest, h): dealt by the rows' hashes, in proportion to the room."""
    total, whole = rows.count(), sum(room)
    ends = [total * sum(room[: s + 1]) // max(whole, 1) for s in range(len(room))]
    ranked = running_sum(rows.withColumn("all", F.lit(0)), ["all"], "h", F.lit(1), "rank", bits=12, ties=("digest",))
    shard = F.coalesce(*[F.when(F.col("rank") < end, s) for s, end in enumerate(ends)]).cast("int")
    return ranked.select("digest", shard.alias("shard")).groupBy("digest", "shard").agg(F.count("*").alias("n"))


def whole_groups(cells: DataFrame) -> DataFrame:
    return cells.join(cells.groupBy("digest").agg(F.count("*").alias("cells")).filter("cells = 1").select("digest"), "digest")


def placed_by_rounds(rows: DataFrame, room: list[int]) -> tuple[DataFrame, DataFrame, list[int]]:
    """Cells of the groups that the rounds made whole, the groups (digest, rows) they left cut, and the room beside the whole ones."""
    spark = rows.sparkSession
    cells = propagate(materialize(dealt(rows, room), scratch_path(spark, "shard-dealt")), room)
    whole = materialize(whole_groups(cells), scratch_path(spark, "shard-whole"))
    cut = cells.join(whole.select("digest"), "digest", "left_anti").groupBy("digest").agg(F.sum("n").alias("rows"))
    held = {r["shard"]: r["n"] for r in whole.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    cut = materialize(cut, scratch_path(spark, "shard-cut"))
    return whole.select("digest", "shard", "n"), cut, [n - held.get(s, 0) for s, n in enumerate(room)]


def assigned(slim: DataFrame, shards: int) -> DataFrame:
    """``slim`` (written: digest, h) with ``shard``."""
    spark = slim.sparkSession
    groups = slim.groupBy("digest").agg(F.count("*").alias("rows"))
    groups = materialize(groups, scratch_path(spark, "shard-groups"))
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    quota = quotas(total, shards)
    marked = materialize(slim.join(groups, "digest"), scratch_path(spark, "shard-marked"))
    linked, single = marked.filter("rows > 1"), marked.filter("rows = 1")
    # At most SMALL groups for each shard are packed here, whatever the input.
    small = max(1, quota[-1] // SMALL)
    large = [(bytes(r["digest"]), r["rows"]) for r in groups.filter(F.col("rows") > small).collect()]
    packed, room = placed_whole(large, quota)
    whole, cut, left = placed_by_rounds(linked.filter(F.col("rows") <= small), room)
    cells = whole.unionByName(along(cut, left)).unionByName(spark.createDataFrame(packed, "digest binary, shard int, n long"))
    cells = materialize(cells, scratch_path(spark, "shard-cells"))
    # A group's rows, in hash order, go to its cells in shard order. A group has at most one cell per shard.
    upto = Window.partitionBy("digest").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = cells.select("digest", F.struct(F.sum("n").over(upto).alias("end"), "shard").alias("cell"))
    ends = ends.groupBy("digest").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    ends = materialize(ends, scratch_path(spark, "shard-ends"))
    ranked = materialize(running_sum(linked, ["digest"], "h", F.lit(1), "rank"), scratch_path(spark, "shard-ranked"))
    placed = ranked.join(ends, "digest").withColumn("shard", F.expr("filter(cells, c -> c.end > rank)[0].shard"))
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    bounds, end = [], 0
    for s, q in enumerate(quota):
        end += q - held.get(s, 0)
        bounds.append(end)
    filler = running_sum(single.withColumn("all", F.lit(0)), ["all"], "h", F.lit(1), "rank", bits=12)
    shard = F.coalesce(*[F.when(F.col("rank") < b, s) for s, b in enumerate(bounds)])
    columns = slim.columns
    return placed.select(*columns, "shard").unionByName(filler.select(*columns, shard.cast("int").alias("shard")))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    ).withColumn("h", F.xxhash64("doc_id", "digest"))
    slim = materialize(slim, scratch_path(spark, "shard-slim"))
    placed = materialize(assigned(slim, shards), scratch_path(spark, "shard-placed"))
    slots = running_sum(placed, ["shard"], "h", F.lit(1), "slot", bits=12, ties=("doc_id",))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
