"""Mixing sources to target weights by Pfair scheduling.

Every source is a lane of blocks of ``BLOCK_ROWS`` documents.  Block ``i`` (from 0)
of a lane of weight ``w`` is released at slot ``floor(i / w)`` and due by slot
``ceil((i + 1) / w)``; each slot takes the released block with the earliest deadline.
The weights are whole units, so the schedule repeats after as many slots as there
are units: one period, whose size the configuration bounds, is scheduled by a
fold, and the slot of every block of any lane follows from its number.  At every
slot each lane is less than one block away from its weight.

The mix ends when every document has had its turn, so none is lost; lanes that
are then through start again (``epoch``), at most ``MAX_EPOCHS`` times in all, after
which their slots stay empty.  Without given weights the target is the size of a
source to the power ``SMOOTHING``.

A null source is a lane of its own.  Beyond ``MAX_LANES`` sources the smallest
share a lane.  Repeated rows are documents of their own; null texts and ids and
further columns, whatever their names, pass through; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.tables import packed, uniform, unpacked, with_places

BLOCK_ROWS = 64
UNITS = 1_000  # resolution of the weights
SMOOTHING = 0.8
MAX_LANES = 500
MAX_EPOCHS = 4
SEED = 6
OTHERS = "o"


def lane_of(source: str = "source") -> Column:
    return F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source)))


@dataclass(frozen=True)
class Lane:
    name: str
    rows: int
    units: int


def lanes_of(docs: DataFrame, weights: dict[str | None, float] | None = None) -> list[Lane]:
    """The lanes by size; at most ``MAX_LANES`` rows come to the driver."""
    counts = docs.groupBy(lane_of().alias("name")).agg(F.count("*").alias("rows"))
    if weights is not None:
        named = [("n" if k is None else f"s{k}") for k, w in weights.items() if w > 0]
        counts = counts.groupBy(F.when(F.col("name").isin(named), F.col("name")).otherwise(OTHERS).alias("name")
                                ).agg(F.sum("rows").alias("rows"))
    top = counts.orderBy(F.desc("rows"), "name").limit(MAX_LANES - 1).collect()
    sizes = [(r["name"], r["rows"]) for r in top]
    if len(sizes) == MAX_LANES - 1:
        rest = counts.agg(F.sum("rows")).first()[0] - sum(n for _, n in sizes)
        sizes += [(OTHERS, rest)] if rest else []
    if not sizes:
        return []
    given = {("n" if k is None else f"s{k}"): w for k, w in (weights or {}).items()}
    target = [given.get(name, 0.0) if weights is not None else n ** SMOOTHING for name, n in sizes]
    whole = sum(target) or 1.0
    return [Lane(name, n, max(1, int(UNITS * t / whole))) for (name, n), t in zip(sizes, target)]


def period(spark: SparkSession, units: list[int]) -> list[int]:
    """The lane of every slot of one period: earliest deadline first."""
    total = sum(units)
    parts = F.lit(units)

    def step(state: Column, slot: Column) -> Column:
        done = state["done"]
        due = F.transform(parts, lambda a, s: F.when(
            F.floor(F.get(done, s) * total / a) <= slot,
            F.struct(F.ceil((F.get(done, s) + 1) * total / a).alias("deadline"), s.alias("lane"))))
        lane = F.array_min(F.filter(due, lambda d: d.isNotNull()))["lane"]
        return F.struct(
            F.transform(done, lambda n, s: n + F.when(s == lane, 1).otherwise(0)).alias("done"),
            F.concat(state["picked"], F.array(lane)).alias("picked"))

    start = F.struct(F.lit([0] * len(units)).alias("done"), F.array().cast("array<int>").alias("picked"))
    picked = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, step, lambda s: s["picked"])
    return spark.range(1).select(picked.alias("p")).first()["p"]


def lane_table(spark: SparkSession, lanes: list[Lane]) -> DataFrame:
    """One row a lane: its units, blocks, scheduled blocks and places in a period."""
    units = [lane.units for lane in lanes]
    total = sum(units)
    places: list[list[int]] = [[] for _ in lanes]
    for slot, lane in enumerate(period(spark, units)):
        places[lane].append(slot)
    blocks = [-(-lane.rows // BLOCK_ROWS) for lane in lanes]
    end = 1 + max((b - 1) // u * total + p[(b - 1) % u] for b, u, p in zip(blocks, units, places))
    due = [min(end // total * u + sum(x < end % total for x in p), MAX_EPOCHS * b)
           for b, u, p in zip(blocks, units, places)]
    rows = [F.struct(F.lit(lane.name).alias("__lane"), F.lit(u).cast("long").alias("__units"), F.lit(b).cast("long").alias("__blocks"),
                     F.lit(d).cast("long").alias("__due"), F.lit(p).alias("__places"), F.lit(total).cast("long").alias("__total"))
            for lane, u, b, d, p in zip(lanes, units, blocks, due, places)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """``docs`` plus ``__epoch, __block, __row, __slot``, one row per turn of a document."""
    spark = docs.sparkSession
    lanes = lanes_of(docs, weights)
    if not lanes:
        nothing = F.lit(0).cast("long")
        return docs.select("*", *[nothing.alias(c) for c in ("__epoch", "__block", "__row", "__slot")])
    own = [lane.name for lane in lanes if lane.name != OTHERS]
    lane = lane_of()
    if len(own) < len(lanes):
        lane = F.when(lane.isin(own), lane).otherwise(OTHERS)
    placed = with_places(docs.withColumn("__lane", lane), ["__lane"], uniform(SEED, "doc_id"),
                         sum(x.rows for x in lanes), "__place")
    turns = placed.join(F.broadcast(lane_table(spark, lanes)), "__lane").withColumn(
        "__block", F.floor(F.col("__place") / BLOCK_ROWS)).withColumn(
        "__epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__due") - 1 - F.col("__block")) / F.col("__blocks")))))
    number = F.col("__epoch") * F.col("__blocks") + F.col("__block")
    slot = F.floor(number / F.col("__units")) * F.col("__total") + F.get("__places", (number % F.col("__units")).cast("int"))
    return turns.select(*docs.columns, "__epoch", "__block", (F.col("__place") % BLOCK_ROWS).alias("__row"), slot.alias("__slot"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """The documents in the order of the mix, each as often as it has turns."""
    ordered = schedule(packed(docs, "doc_id", "source"), weights).repartitionByRange("__slot", "__row").sortWithinPartitions("__slot", "__row")
    return unpacked(ordered, docs.columns)


def op6(docs: DataFrame) -> DataFrame:
    return schedule(docs.select("doc_id", "source")).select(
        "doc_id", "source", F.col("__epoch").alias("epoch"), F.col("__block").alias("block"),
        F.col("__row").alias("block_row"), F.col("__slot").alias("slot"))


SQL = f"""
WITH RECURSIVE
n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT row_number() OVER (ORDER BY n DESC, source) AS s, source, n, (n + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS b,
  greatest(1, CAST(floor({UNITS} * pow(n, {SMOOTHING}) / (SELECT sum(pow(n, {SMOOTHING})) FROM n)) AS BIGINT)) AS u FROM n),
k AS (SELECT list(u ORDER BY s) AS us, CAST(sum(u) AS BIGINT) AS total FROM w),
run AS (
  SELECT CAST(-1 AS BIGINT) AS t, [CAST(0 AS BIGINT) FOR x IN us] AS done, CAST(0 AS BIGINT) AS pick, us, total FROM k
  UNION ALL
  SELECT t, [done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END FOR i IN range(1, len(us) + 1)], pick, us, total FROM (
    SELECT t + 1 AS t, done, us, total, list_min([CASE WHEN done[i] * total // us[i] <= t + 1
      THEN ((done[i] + 1) * total + us[i] - 1) // us[i] * 10000 + i END FOR i IN range(1, len(us) + 1)]) % 10000 AS pick
    FROM run WHERE t + 1 < total)),
p AS (SELECT pick AS s, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM run WHERE t >= 0),
e AS (SELECT max((b - 1) // u * total + t) + 1 AS finish FROM w, k, p WHERE p.s = w.s AND p.j = (b - 1) % u),
due AS (SELECT w.*, least({MAX_EPOCHS} * b, finish // total * u + (SELECT count(*) FROM p WHERE p.s = w.s AND t < finish % total)) AS due
  FROM w, k, e),
d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source
    ORDER BY CAST('0x' || substr(md5('{SEED}#' || doc_id), 1, 15) AS BIGINT)) - 1 AS place FROM documents),
t AS (SELECT doc_id, d.source, place // {BLOCK_ROWS} AS block, place % {BLOCK_ROWS} AS block_row, s, u, b,
    unnest(range(0, (due - 1 - place // {BLOCK_ROWS}) // b + 1)) AS epoch
  FROM d JOIN due ON d.source = due.source)
SELECT doc_id, source, epoch, block, block_row, (epoch * b + block) // u * total + p.t AS slot
FROM t, k, p WHERE p.s = t.s AND p.j = (epoch * b + block) % u"""
