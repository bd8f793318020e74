"""Mix sources to target weights by pivotal dependent rounding.

Every document has an expected number of copies: its source's target over its source's size.  The
whole part is taken as it is.  The fractions are rounded together: two documents of a source pass
words from one to the other until the fraction of one is 0 or 1; which way is drawn so that each
expectation stays what it was.  The other goes on as residual.  Residuals meet in a reduction tree:
documents are dealt to small groups by a hash, each group folds to one residual, and ``FAN`` groups
make the next group.  A hot source only has more groups.  So a source misses its target by the
rounding of one document.

Defined results: a null source is a source of its own; a text without words (or null) has size 0
and takes 0; very long texts count with all words; repeated rows are rounded each for itself; ties
between equal rows are broken by their number, so that which of them takes more does not matter; an empty
table gives an empty result.  Draws are hashes, so reruns agree.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.common import Query, cut, read, word_count

#: Fixed values of the contract: weights in turn, share of all words, most copies of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0

#: Rows of a group, and groups that meet in one of the next level, on average.
FAN = 32

#: More sources than this are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 100_000

UNIT = "struct<turn:bigint,doc_id:bigint,row_no:int,size:bigint,part:double,whole:int,source_size:bigint,target:double>"
DONE = "array<struct<doc_id:bigint,size:bigint,copies:int,source_size:bigint,target:double>>"


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``(source, source_size, target)``: shares by weight, none above ``most`` times its size.

    One row per source is all that the ordered windows see.  A level L solves
    sum(min(most * size, L * weight)) = share * sum(size): sources are taken in the order in which
    a rising level fills them, and the first one that L does not fill fixes L.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    turn = F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("goal", F.sum("source_size").over(all_rows) * share)
        .withColumn(
            "level",
            (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(onwards),
        )
        .withColumn(
            "level",
            F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "level")))
            .over(all_rows)
            .getField("level"),
        )
        .select(
            "source",
            "source_size",
            F.coalesce(F.least("cap", F.col("level") * F.col("weight")), "cap").alias("target"),
        )
    )


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _pair(carry: Column, other: Column, seed: int) -> tuple[Column, Column]:
    """One pivotal step: the unit that became integral (``part`` 0 or 1), and the residual."""
    has = carry["part"] * carry["size"]
    lacks = (1 - carry["part"]) * carry["size"]
    other_has = other["part"] * other["size"]
    other_lacks = (1 - other["part"]) * other["size"]
    up, down = F.least(lacks, other_has), F.least(has, other_lacks)
    draw = _draw(F.lit(seed), carry["turn"], other["turn"])
    rises = draw * (up + down) <= down

    def to(unit: Column, part: Column) -> Column:
        return unit.withField("part", F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)))

    one, zero = F.lit(1.0), F.lit(0.0)
    settled = F.when(
        rises, F.when(lacks <= other_has, to(carry, one)).otherwise(to(other, zero))
    ).otherwise(F.when(has <= other_lacks, to(carry, zero)).otherwise(to(other, one)))
    residual = F.when(
        rises,
        F.when(lacks <= other_has, to(other, other["part"] - up / other["size"])).otherwise(
            to(carry, carry["part"] + up / carry["size"])
        ),
    ).otherwise(
        F.when(has <= other_lacks, to(other, other["part"] + down / other["size"])).otherwise(
            to(carry, carry["part"] - down / carry["size"])
        )
    )
    return settled, residual


def _result(unit: Column, extra: Column) -> Column:
    return F.struct(
        unit["doc_id"].alias("doc_id"),
        unit["size"].alias("size"),
        (unit["whole"] + extra.cast("int")).alias("copies"),
        unit["source_size"].alias("source_size"),
        unit["target"].alias("target"),
    )


def _fold_group(units: Column, seed: int) -> Column:
    """Fold the units of a group: ``(carry, done)``."""
    start = F.struct(
        F.get(units, F.lit(0)).alias("carry"),
        F.array().cast(DONE).alias("done"),
    )

    def step(state: Column, unit: Column) -> Column:
        settled, residual = _pair(state["carry"], unit, seed)
        return F.struct(
            residual.cast(UNIT).alias("carry"),
            F.concat(state["done"], F.array(_result(settled, settled["part"]))).cast(DONE).alias("done"),
        )

    return F.aggregate(F.slice(units, F.lit(2), F.size(units)), start, step)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` of every row of ``docs``."""
    spark = docs.sparkSession
    same = Window.partitionBy("doc_id", "source", "size").orderBy(F.lit(0))
    sizes = cut(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        ).withColumn("row_no", F.row_number().over(same))
    )
    targets = cut(source_targets(sizes, weights, share, most))
    counts = sizes.agg(F.count(F.lit(1)).alias("rows")).first()
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    of = targets.withColumnRenamed("source", "of_source")
    expected = F.col("target") / F.col("source_size")
    slots = max(1, -(-counts["rows"] // FAN))
    turn = F.xxhash64(F.lit(seed), "doc_id", "row_no")
    units = (
        sizes.join(of, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0))
        .withColumn("whole", F.floor("expected").cast("int"))
        .select(
            "source",
            F.pmod(turn, F.lit(slots)).alias("slot"),
            F.struct(
                turn.alias("turn"),
                "doc_id",
                "row_no",
                "size",
                (F.col("expected") - F.col("whole")).alias("part"),
                "whole",
                "source_size",
                "target",
            ).cast(UNIT).alias("unit"),
        )
    )
    settled = F.col("unit.part") <= 0
    results = [units.where(settled).select(_result(F.col("unit"), F.lit(0)).alias("r"))]
    open_units, level = units.where(~settled), 0
    while True:
        folded = cut(
            open_units.groupBy("source", "slot")
            .agg(F.array_sort(F.collect_list("unit")).alias("units"))
            .select("source", "slot", _fold_group(F.col("units"), seed + level).alias("state"))
        )
        results.append(folded.select(F.explode("state.done").alias("r")))
        open_units = folded.select(
            "source", F.floor(F.col("slot") / FAN).alias("slot"), F.col("state.carry").alias("unit")
        )
        if slots == 1:
            break
        slots, level = -(-slots // FAN), level + 1
    nearest = F.round(F.col("unit.part"))
    results.append(open_units.select(_result(F.col("unit"), nearest).alias("r")))
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every.select("r.*").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {"op6_mixing": op6_mixing}
ORACLES: dict[str, str] = {}
