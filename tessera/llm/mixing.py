"""Mixing sources to target weights: temperature, a bisected exponent, and budgeted block permutations.

A source's share of tokens (words) p becomes the weight p^tau / sum p^tau. tau = 1 keeps the corpus as it is,
tau = 0 gives every source the same. The exponent is bisected: repetition_exponent finds the smallest tau at which no source is
repeated more than max_repeats times as often as the least repeated one (only the smallest and the largest share matter); entropy_exponent
the largest tau whose weights reach an entropy, each step of which is one aggregate over the table of sources. Sources stay a
table throughout; none of them is collected. The budget is cut by weight into a quota of tokens for each source.

A quota is realised in blocks. Rows of equal source, doc_id and text are one unit, which knows its number of rows. The units
of a source fall, by a seeded hash, into blocks of about BLOCK_ROWS rows, and an order of the blocks and of the units inside
each is a permutation of the source. A quota of q
whole passes and a rest takes every block q times and for the rest the blocks first in order, up to
the block that the rest ends in; of that block the first units in order, up to the unit that the rest ends in; and of that unit
as many copies as fit. So a source misses its quota by less than one row, whatever its rows share. Only block
totals (a row per block) are summed over a source, so that a hot source meets in no task; rows see
nothing but two numbers of their block, looked up by a join against the block table.

schedule gives the mixture as places: the turn of a block in an epoch, and a row's place inside the block. mix gives the rows in that
order: the blocks of all sources and epochs are shuffled together, so that every stretch of the mixture has the weights; it is sorted over
ranges by (turn, block, epoch, place), where a row's own number spreads equal rows, so that no range is hot.

Defined results: a null source is the source ""; null and empty texts have no tokens, cost nothing and follow
their unit; a source of such texts alone is passed over once; a null doc_id is one of its own; rows that repeat a doc_id with other texts
are units of their own, with the same text one unit whose rows are chosen by number, not by their other columns; other columns are
ignored by the schedule and kept by mix, whatever they are called; an empty table or one without any token gives an empty schedule.
docs has to be a table that rereads alike (a file scan), since a row's number is its place in the scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import columns_of, partitions, small, table, written

BLOCK_ROWS = 256
MAX_REPEATS = 1.5
SEED = 17
#: Copies of one unit that one row of the table of surplus copies stands for.
COPIES_A_ROW = 4096


def bisect(holds: Callable[[float], bool], rounds: int = 60) -> float:
    """The least tau in [0, 1] from which on `holds` is true (it is at 1)."""
    if holds(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def repetition_exponent(least: float, most: float, max_repeats: float) -> float:
    """A share p is repeated p^(tau - 1) times, up to a factor; so the smallest share most often, the largest least often."""
    return bisect(lambda tau: (1 - tau) * (math.log(most) - math.log(least)) <= math.log(max_repeats) + 1e-12)


def entropy_at(totals: DataFrame, most: float, tau: float) -> float:
    """Entropy of the weights at tau: ln S - tau / S sum x^tau ln x, for x = tokens / most and S = sum x^tau."""
    x = F.col("tokens") / F.lit(float(most))
    powers, logs = totals.where("tokens > 0").agg(F.sum(F.pow(x, F.lit(tau))), F.sum(F.pow(x, F.lit(tau)) * F.log(x))).head()
    return math.log(powers) - tau * logs / powers


def entropy_exponent(totals: DataFrame, most: float, target: float, rounds: int = 40) -> float:
    """The largest tau whose weights have at least the target entropy; 0 if none has."""
    if entropy_at(totals, most, 1.0) >= target:
        return 1.0
    return 1.0 - bisect(lambda down: entropy_at(totals, most, 1.0 - down) >= target or down >= 1.0, rounds)


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _unit(seed: int) -> list[Column]:
    """128 bits of doc_id and text: a row's place in its source's permutation, and its name there."""
    own = [F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("doc_id").isNull(), F.col("text").isNull()]
    return [F.xxhash64(F.lit(seed), F.lit(word), *own).alias(name) for word, name in (("row", "_order"), ("unit", "_name"))]


class Plan:
    """Quotas by source and copies by block; tables written to the shared folder.

    sources: source, tokens, rows, weight, quota, blocks. blocks: passes (whole copies of every row), cut (units
    before it come once more), full (all of them do). surplus: the copies of the one unit of a source that the rest ends in.
    """

    def __init__(self, docs: DataFrame, max_repeats: float = MAX_REPEATS, target_entropy: float | None = None, budget: float | None = None, seed: int = SEED):
        self.seed = seed
        rows = docs.select(_source().alias("source"), *_unit(seed), n_tokens(F.col("text")).alias("tokens"))
        units = rows.groupBy("source", "_order", "_name", "tokens").agg(F.count(F.lit(1)).alias("rows"))
        units = written(units, "units")
        totals = written(units.groupBy("source").agg(F.sum(F.col("tokens") * F.col("rows")).alias("tokens"), F.sum("rows").alias("rows")), "totals")
        least, most = totals.where("tokens > 0").agg(F.min("tokens"), F.max("tokens")).head()
        self.most = most
        self.tau = 1.0 if not most else repetition_exponent(least, most, max_repeats) if target_entropy is None else entropy_exponent(totals, most, target_entropy)
        raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(most or 1)), F.lit(self.tau))).otherwise(0.0)
        powers = (totals.agg(F.sum(raw)).head()[0] or 1.0) if most else 1.0
        weighted = totals.withColumn("weight", raw / F.lit(powers))
        if budget is None:  # every source is passed over once at least
            budget = weighted.where("weight > 0").agg(F.max(F.col("tokens") / F.col("weight"))).head()[0] or 0.0
        self.budget = budget
        blocks = F.greatest(F.lit(1), F.round(F.col("rows") / BLOCK_ROWS)).cast("long")
        self.sources = written(weighted.withColumn("quota", F.col("weight") * F.lit(float(budget))).withColumn("blocks", blocks), "sources")
        self._cut(units)

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows (with source and the unit) with the number of their block."""
        s = self.sources.select(F.col("source").alias("_source"), F.col("blocks").alias("_blocks"))
        joined = rows.join(small(s), F.col("source") == F.col("_source"))
        return joined.withColumn("_block", F.pmod(F.xxhash64(F.lit(self.seed), F.lit("block"), "_name"), F.col("_blocks"))).drop("_blocks")

    def _cut(self, units: DataFrame) -> None:
        placed = self.placed(units).withColumn("cost", F.col("tokens") * F.col("rows"))
        sums = placed.groupBy("_source", "_block").agg(F.sum("cost").alias("block_tokens"))
        sums = written(sums.withColumn("turn", F.xxhash64(F.lit(self.seed), F.lit("turn"), "_source", "_block")), "block-sums")
        # prefix sums over a source's blocks, in slices of the order so that no source's blocks meet in one task
        slices = sums.withColumn("slice", F.shiftright(F.shiftright(F.col("turn"), 32) + (1 << 31), 22).cast("long"))
        per_slice = slices.groupBy("_source", "slice").agg(F.sum("block_tokens").alias("slice_tokens"))
        before = per_slice.select("_source", "slice", (F.sum("slice_tokens").over(W.partitionBy("_source").orderBy("slice")) - F.col("slice_tokens")).alias("before"))
        inside = F.sum("block_tokens").over(W.partitionBy("_source", "slice").orderBy("turn", "_block").rowsBetween(W.unboundedPreceding, 0)) - F.col("block_tokens")
        q = self.sources.select(F.col("source").alias("_source"), "quota", F.col("tokens").alias("total"))
        known = slices.withColumn("inside", inside).join(before, ["_source", "slice"]).join(small(q), "_source")
        # a source without tokens costs nothing and is passed over once
        known = known.withColumn("passes", F.when(F.col("total") == 0, int(bool(self.most))).otherwise(F.floor(F.try_divide("quota", "total") + 1e-9)).cast("long"))
        known = known.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("total") - F.col("before") - F.col("inside")))
        known = written(known, "known")
        ended = known.where((F.col("rest") > 0) & (F.col("rest") < F.col("block_tokens"))).select("_source", "_block", "passes", "turn", "rest")
        # at most one block of a source ends inside; its units, about BLOCK_ROWS, are ranked
        run = F.sum("cost").over(W.partitionBy("_source", "_block").orderBy("_order", "_name").rowsBetween(W.unboundedPreceding, 0))
        part = placed.join(small(ended), ["_source", "_block"]).withColumn("over", run - F.col("rest")).where(F.col("over") > 1e-6)
        cut = written(part.groupBy("_source", "_block").agg(F.min(F.struct("_order", "_name", "tokens", "rows", "over")).alias("cut")), "cut")
        self.blocks = written(
            known.join(small(cut), ["_source", "_block"], "left").select("_source", "_block", "turn", "passes", ((F.col("rest") > 0) & (F.col("rest") >= F.col("block_tokens"))).alias("full"), F.struct("cut._order", "cut._name").alias("cut"), F.col("cut").isNotNull().alias("ends")), "blocks"
        )
        # of the unit that the rest ends in: as many rows as fit, the lowest epoch that its rows don't have
        fits = F.col("cut.rows") - F.ceil((F.col("cut.over") - 1e-6) / F.col("cut.tokens"))
        extra = cut.join(small(ended.select("_source", "_block", "passes", "turn")), ["_source", "_block"]).withColumn("copies", fits).where("copies > 0")
        self.surplus = written(extra.select("_source", "_block", "turn", F.col("passes").alias("epoch"), F.col("cut._order").alias("_order"), F.col("cut._name").alias("_name"), "copies"), "surplus")

    def epochs(self, rows: DataFrame) -> DataFrame:
        """rows (with source, unit and _number), once for each epoch: with epoch, turn, _block and place. The surplus copies come from one row of their unit each."""
        blocks = self.blocks.withColumnRenamed("_source", "_s").withColumnRenamed("_block", "_b")
        joined = self.placed(rows).join(small(blocks), (F.col("_source") == F.col("_s")) & (F.col("_block") == F.col("_b")))
        once_more = F.col("full") | (F.col("ends") & (F.struct("_order", "_name") < F.col("cut")))
        copies = (F.col("passes") + F.when(F.coalesce(once_more, F.lit(False)), 1).otherwise(0)).cast("int")
        own = joined.where(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
        # one row per unit in surplus, a unit a source at most: chosen where the rows lie
        names = [F.col(c) for c in ("_source", "_block", "_order", "_name")]
        packed = self.placed(rows).join(small(self.surplus), ["_source", "_block", "_order", "_name"]).select(*names, "turn", "epoch", "copies", F.struct(*columns_of(rows)).alias("_row"), "_number")
        first = packed.groupBy(*names, "turn", "epoch", "copies").agg(F.min_by("_row", "_number").alias("_row"))
        runs = first.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_A_ROW).cast("long"))))
        runs = runs.repartition(*names, "_from")
        more = runs.withColumn("_number", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + COPIES_A_ROW, F.col("copies")) - 1)))
        kept = [n for n in rows.columns if n != "_number"]
        more = more.select(*[F.col("_row")[n].alias(n) for n in kept], (-1 - F.col("_number")).alias("_number"), F.col("epoch").cast("int").alias("epoch"), "turn", "_block")
        both = own.select(*kept, "_number", "epoch", "turn", "_block").unionByName(more)
        place = F.xxhash64(F.col("_order"), F.col("epoch"), F.col("_number"))
        return both.withColumn("turn", F.xxhash64(F.col("turn"), F.col("epoch"))).withColumn("place", place)


def _numbered(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    return docs.select("doc_id", _source().alias("source"), *_unit(seed), *more, F.monotonically_increasing_id().alias("_number"))


def schedule(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """doc_id, source, epoch, turn, block, place: the mixture; its rows follow (turn, block, epoch, place)."""
    plan = plan or Plan(docs)
    return plan.epochs(_numbered(docs, plan.seed)).select("doc_id", "source", "epoch", "turn", F.col("_block").alias("block"), "place")


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with rows left out or repeated as the mixture holds them, in its order, with the columns of docs."""
    plan = Plan(docs, **options)
    # a row travels as one struct: none of its columns can meet one of the plan's
    rows = plan.epochs(_numbered(docs, plan.seed, F.struct(*columns_of(docs)).alias("row")))
    order = ("turn", "_block", "epoch", "place")
    return rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents"))


QUERIES = {"op8_mixing": op8_mixing}
SQL: dict[str, str] = {}
