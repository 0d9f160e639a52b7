"""Hierarchical codes such as ``3.10.301``: ancestors, sums over the tree, totals that disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.expressions import col


def depth(code: str | Column, separator: str = ".") -> Column:
    """Number of parts of a code."""
    return F.size(_parts(code, separator))


def parent(code: str | Column, separator: str = ".") -> Column:
    """The code without its last part; NULL for a code of one part."""
    parts = _parts(code, separator)
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), separator))


def prefixes(code: str | Column, separator: str = ".") -> Column:
    """The code and all its ancestors, shortest first; NULL for a NULL code."""
    parts = _parts(code, separator)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))


def _parts(code: str | Column, separator: str) -> Column:
    return F.split(col(code), f"\\Q{separator}\\E")


def closure(df: DataFrame, code: str, ancestor: str = "ancestral", separator: str = ".") -> DataFrame:
    """Each row once for its own code and for each ancestor: one row per level, no join per level."""
    return df.select("*", F.explode(prefixes(code, separator)).alias(ancestor))


def tree_sums(leaves: DataFrame, by: Sequence[str], code: str, value: str, name: str, separator: str = ".") -> DataFrame:
    """(by, code, nivel, name): the value of every code as the sum of the leaves below it."""
    each = closure(leaves.select(*by, code, value), code, "_ancestor", separator)
    summed = each.groupBy(*by, F.col("_ancestor").alias(code)).agg(F.sum(value).alias(name))
    return summed.select(*by, code, depth(code, separator).alias("nivel"), name)


def disagreeing_totals(
    df: DataFrame, by: Sequence[str], code: str, value: str, tolerance: float = 0.005, separator: str = "."
) -> DataFrame:
    """(by, code, informado, soma_dos_filhos, filhos, diferenca) of totals that are not the sum of their children.

    Every row is sent to its own code and, as a child, to its parent's, and both meet in one
    aggregation; the hierarchy is never joined with itself. Codes without children, and
    children whose parent is not there, are no totals. Repeated codes add up.
    """
    amount, nothing = F.col(value).cast("double"), F.lit(None).cast("double")

    def sent(to: Column, own: Column, child: Column, is_child: int) -> Column:
        return F.struct(to.alias("_code"), own.alias("_own"), child.alias("_child"), F.lit(is_child).alias("_is_child"))

    rows = F.array(sent(F.col(code), amount, nothing, 0), sent(parent(code, separator), nothing, amount, 1))
    each = df.select(*by, F.inline(rows)).where(F.col("_code").isNotNull())
    met = each.groupBy(*by, F.col("_code").alias(code)).agg(
        F.sum("_own").alias("informado"),
        F.sum("_child").alias("soma_dos_filhos"),
        F.sum("_is_child").alias("filhos"),
        F.count_if(F.col("_is_child") == 0).alias("_there"),
    )
    difference = F.coalesce("informado", F.lit(0.0)) - F.coalesce("soma_dos_filhos", F.lit(0.0))
    both = met.where((F.col("filhos") > 0) & (F.col("_there") > 0)).withColumn("diferenca", difference)
    return both.where(F.abs("diferenca") > tolerance).drop("_there")


def orphans(df: DataFrame, by: Sequence[str], code: str, separator: str = ".") -> DataFrame:
    """(by, code) of codes whose parent has no row. NULL groups match no other."""
    there = df.select(*by, F.col(code).alias("_parent")).distinct()
    below = df.select(*by, code, parent(code, separator).alias("_parent")).where(F.col("_parent").isNotNull()).distinct()
    return below.join(there, [*by, "_parent"], "left_anti").select(*by, code)
