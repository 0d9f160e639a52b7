"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

A uniform permutation cut into shards sends to each shard a number of rows of each input
partition that follows the multivariate hypergeometric law. So these numbers are drawn
first, from partition sizes alone; then every partition permutes its rows and deals them out
by its line of the matrix, the rows are exchanged, and every shard permutes what it got.
No global sort is needed and every size is exact. All of it is DataFrame expressions.

The matrix is drawn in two steps, for groups of about sqrt(partitions) partitions and then
inside each group, so no step is sequential over all partitions. One number is drawn by
inverting the distribution function over twelve standard deviations around its mean.
Draws are hashes of the seed and the place in the matrix: a repeated task repeats them.

Each row counts, with a NULL or repeated id or text too. Shard sizes differ by one at most;
with fewer rows than shards some shards are empty. An empty table gives no rows. Input
columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.llm.common import written

#: Half-width of the window that a draw searches, in standard deviations.
REACH = 12


def let(fields: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` over named values that are computed once for it."""
    return F.element_at(F.transform(F.array(F.struct(*[c.alias(n) for n, c in fields.items()])), body), 1)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` items taken without replacement are among the ``good`` ones."""

    def bounds(p: Column) -> Column:
        every = (p["good"] + p["bad"]).cast("double")
        some = F.greatest(every, F.lit(1.0))
        mean = p["draws"] * p["good"] / some
        variance = mean * p["bad"] / some * (every - p["draws"]) / F.greatest(every - 1, F.lit(1.0))
        reach = REACH * F.sqrt(F.greatest(variance, F.lit(0.0))) + REACH
        return let(
            {
                "good": p["good"],
                "free": p["bad"] - p["draws"],
                "draws": p["draws"],
                "u": p["u"],
                "low": F.greatest(F.lit(0).cast("long"), p["draws"] - p["bad"], F.floor(mean - reach)),
                "high": F.least(p["good"], p["draws"], F.ceil(mean + reach)),
            },
            total,
        )

    def following(q: Column, weight: Column, k: Column) -> Column:
        """The weight of k + 1, from that of k."""
        return weight * (q["good"] - k).cast("double") * (q["draws"] - k) / ((k + 1).cast("double") * (q["free"] + k + 1))

    def total(q: Column) -> Column:
        weights = F.aggregate(
            F.sequence(q["low"], q["high"]),
            F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum")),
            lambda a, k: F.struct(following(q, a["weight"], k).alias("weight"), (a["sum"] + a["weight"]).alias("sum")),
            lambda a: a["sum"],
        )
        return let({"q": q, "goal": weights * q["u"]}, lambda z: pick(z["q"], z["goal"]))

    def pick(q: Column, goal: Column) -> Column:
        """The smallest k whose cumulative weight reaches the goal."""
        return F.aggregate(
            F.sequence(q["low"], q["high"]),
            F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"), q["low"].alias("k")),
            lambda a, k: F.struct(
                following(q, a["weight"], k).alias("weight"),
                (a["sum"] + a["weight"]).alias("sum"),
                F.when(a["sum"] < goal, k).otherwise(a["k"]).alias("k"),
            ),
            lambda a: a["k"],
        )

    return let({"good": good, "bad": bad, "draws": draws, "u": u}, bounds)


def dealt(capacities: Column, sizes: Column, *seed: Column) -> Column:
    """One array of counts per size: how many items of it go to each capacity.

    ``sizes`` add up to the capacities, which shrink from size to size.
    """
    none = F.array().cast("array<bigint>")

    def line(capacity: Column, size: Column, at: Column) -> Column:
        return F.aggregate(
            F.transform(capacity, lambda c, i: F.struct(c.alias("room"), i.alias("shard"))),
            F.struct(size.alias("left"), total_of(capacity).alias("rest"), none.alias("counts")),
            lambda a, c: let(
                {
                    "a": a,
                    "room": c["room"],
                    "k": hypergeometric(c["room"], a["rest"] - c["room"], a["left"], uniform(*seed, at, c["shard"])),
                },
                lambda z: F.struct(
                    (z["a"]["left"] - z["k"]).alias("left"),
                    (z["a"]["rest"] - z["room"]).alias("rest"),
                    F.concat(z["a"]["counts"], F.array(z["k"])).alias("counts"),
                ),
            ),
            lambda a: a["counts"],
        )

    return F.aggregate(
        F.transform(sizes, lambda n, i: F.struct(n.alias("n"), i.alias("at"))),
        F.struct(capacities.alias("room"), F.array().cast("array<array<bigint>>").alias("lines")),
        lambda a, s: let(
            {"a": a, "counts": line(a["room"], s["n"], s["at"])},
            lambda z: F.struct(
                F.zip_with(z["a"]["room"], z["counts"], lambda c, k: c - k).alias("room"),
                F.concat(z["a"]["lines"], F.array(z["counts"])).alias("lines"),
            ),
        ),
        lambda a: a["lines"],
    )


def total_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, n) -> (part, parts, counts): rows that go from each partition to each shard.

    The sizes, one row per input partition, meet in one row; that is all that does.
    """
    whole = sizes.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("all")).where(F.size("all") > 0)
    ns = F.transform("all", lambda x: x["n"])
    width = F.ceil(F.sqrt(F.size("all").cast("double"))).cast("int")
    groups = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("all") / F.col("width")).cast("int") - 1),
        lambda j: F.slice("all", j * F.col("width") + 1, F.col("width")),
    )
    capacities = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(F.col("rows") / shards).cast("long") + F.when(s < F.col("rows") % shards, 1).otherwise(0),
    )
    grouped = (
        whole.withColumns({"width": width, "rows": total_of(ns), "parts": F.size("all")})
        .withColumns({"groups": groups, "room": capacities})
        .withColumn(
            "room",
            dealt(F.col("room"), F.transform("groups", lambda g: total_of(F.transform(g, lambda x: x["n"]))), F.lit(seed), F.lit(-1)),
        )
        .select("parts", F.posexplode(F.arrays_zip("groups", "room")).alias("at", "of"))
        .select("parts", "at", F.col("of.groups").alias("members"), F.col("of.room").alias("room"))
    )
    lines = dealt(F.col("room"), F.transform("members", lambda x: x["n"]), F.lit(seed), F.col("at"))
    return (
        grouped.repartition("at")
        .withColumn("counts", lines)
        .select("parts", F.explode(F.arrays_zip("members", "counts")).alias("of"))
        .select(F.col("of.members.part").alias("part"), "parts", F.col("of.counts").alias("counts"))
    )


def shuffled(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless in its shard), uniformly at random."""
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    numbered = written(
        rows.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("id"),
        ),
        "shard_rows",
    )
    matrix = communication_matrix(numbered.groupBy("part").agg(F.count("*").alias("n")), shards, seed)
    shuffle_in_part = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("send"), "id"), "id")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)), lambda s: total_of(F.slice("counts", 1, s))
    )
    sent = (
        numbered.withColumn("rank", F.row_number().over(shuffle_in_part))
        .join(matrix.withColumn("ends", ends), "part")
        .select(
            "row",
            "id",
            F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard"),
            F.pmod(F.xxhash64(F.lit(seed), F.lit("bin"), "id"), F.col("parts").cast("long")).alias("bin"),
        )
    )
    # A shard is permuted in as many bins as there were partitions: a uniform bin, then a uniform place in it.
    sent = written(sent, "shard_sent")
    bins = sent.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = bins.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_bin = Window.partitionBy("shard", "bin").orderBy(F.xxhash64(F.lit(seed), F.lit("place"), "id"), "id")
    return (
        sent.withColumn("place", F.row_number().over(in_bin))
        .join(bases, ["shard", "bin"])
        .select("row.*", "shard", (F.col("base") + F.col("place") - 1).alias("slot"))
    )
