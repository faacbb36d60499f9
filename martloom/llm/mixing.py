"""Mixing sources to target weights by Poisson replication, with built-in functions.

A source whose share of the result shall be w gets the mean repetition rate w * total / (its documents). Each document is
repeated k times, where k is the inverse of the Poisson distribution of that mean at a number that depends on the seed and the
document's id only, so a repeated task or another partitioning gives the same rows. Copies are shuffled by a hash of seed,
document and copy, which is a random order over all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

# Means above this are sums of several draws, so that exp(-mean) stays far from 0.
_PART = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, from the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def poisson_steps(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2 ...

    The table ends where the rest is below 2^-53: no number of 52 bits lies beyond it, so nothing is cut off.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.array(F.exp(-mean)).alias("all"))

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        total = state["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), F.concat(state["all"], F.array(total)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda s: s["all"])


def temperature_rates(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """(source, rate): shares proportional to (documents of the source) ** power, with as many documents in all as now."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("total"), F.sum(F.pow(F.col("n").cast("double"), F.lit(power))).alias("weight"))
    rate = F.pow(F.col("n").cast("double"), F.lit(power)) / F.col("weight") * F.col("total") / F.col("n")
    # ``total`` is a single row.
    return sizes.join(F.broadcast(total)).select("source", rate.alias("rate"))


def weight_rates(docs: DataFrame, weights: dict[str | None, float], total: int | None = None, source: str = "source") -> DataFrame:
    """(source, rate) for given weights of sources; sources without a weight get none. ``total`` documents, or as many as now."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "wanted string, weight double")
    present = sizes.join(wanted, sizes["source"].eqNullSafe(wanted["wanted"]))
    sums = present.agg(F.sum("weight").alias("weights")).join(F.broadcast(sizes.agg(F.sum("n").alias("total"))))
    rows = F.col("total") if total is None else F.lit(total)
    return present.join(F.broadcast(sums)).select("source", (F.col("weight") / F.col("weights") * rows / F.col("n")).alias("rate"))


def replicate(docs: DataFrame, rates: DataFrame, seed: str = "mix", id_column: str = "doc_id", source: str = "source") -> DataFrame:
    """``row`` (the given row as a struct), ``rate``, ``n_copies``, ``copy_no`` (from 1) and ``shuffle_key``, in shuffled order.

    Documents that draw 0 are left out, as are sources without a rate or with rate 0. A missing source is a source of its
    own, a missing id is an id; rows of equal id draw the same number. An empty table gives an empty result.
    """
    steps = F.transform(F.array(F.lit(0)), lambda _: poisson_steps(F.col("part")))[0]
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / _PART)).cast("int")
    tables = rates.where("rate > 0").withColumn("parts", parts).withColumn("part", F.col("rate") / F.col("parts")).withColumn("steps", steps)
    # Read back, the table of sources has its own size and not one guessed from the documents: few sources need no shuffle of them.
    tables = stored(tables.select(F.col("source").alias("rate_source"), "rate", "parts", "steps"), "rates")
    given = docs.select(F.struct("*").alias("row"), F.col(source).alias("of"), F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"))
    drawn = given.join(tables, F.col("of").eqNullSafe(F.col("rate_source")))
    one = lambda i: F.size(F.filter("steps", lambda p: p <= uniform(F.lit(seed), F.col("name"), i.cast("string"))))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda total, i: total + one(i))
    counted = drawn.withColumn("n_copies", copies).where("n_copies > 0")
    spread = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(seed + " order"), "name", F.col("copy_no").cast("string")))
    spread = spread.select("row", "rate", "n_copies", "copy_no", key.alias("shuffle_key"))
    return spread.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
