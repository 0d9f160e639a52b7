"""Two-way fixed-effects regression with entity-clustered errors, for many panels at once.

The slope of ``y ~ x + entity + time`` is that of the residuals of x and y after both
effects are taken out. Entity effects are removed inside each entity. The time effects
then solve a linear system with one unknown per period, whose matrix is a sum over
entities. Every task adds up the matrices of its entities and hands on one per panel,
these are added one after the other, and the system is solved in Python. So a task holds
one matrix of periods x periods numbers for each panel it meets (``HELD`` of them at
most, then it hands them on), and no pair of periods is ever a row. Periods are bounded by
what such a matrix may take: 3,000 of them are 72 MB. The result is exact for unbalanced
panels as well.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicpanel import fixed_values as fv
from civicpanel.functions.expressions import is_value, round_half_even

# Executors get the functions of this module with the task and need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEGLIGIBLE = 1e-12
#: Numbers of all matrices that a task holds before it hands them on.
HELD = 8_000_000


def _let(value: Column, body) -> Column:
    """Bind a value once for use inside a lambda.

    A plain column would be inlined into the lambda and computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(cells: str | Column, term) -> Column:
    return F.aggregate(cells, F.lit(0.0), lambda acc, c: acc + term(c))


def _means(cells: str | Column) -> Column:
    """Weighted means of x and y over the cells of an entity, and their total weight."""
    nothing = F.lit(0.0)
    return F.aggregate(
        cells,
        F.struct(nothing.alias("n"), nothing.alias("x"), nothing.alias("y")),
        lambda acc, c: F.struct(
            (acc["n"] + c["n"]).alias("n"),
            (acc["x"] + c["n"] * c["x"]).alias("x"),
            (acc["y"] + c["n"] * c["y"]).alias("y"),
        ),
        lambda acc: F.struct(
            acc["n"].alias("n"),
            F.try_divide(acc["x"], acc["n"]).alias("x"),
            F.try_divide(acc["y"], acc["n"]).alias("y"),
        ),
    )


def _less(c: Column, by: Column, *keep: str) -> Column:
    """A cell with x and y reduced by those of another struct."""
    return F.struct(
        *[c[f].alias(f) for f in (*keep, "n", "vx", "vxy")],
        (c["x"] - by["x"]).alias("x"),
        (c["y"] - by["y"]).alias("y"),
    )


def merged_cells(panel: DataFrame, by: list[str]) -> DataFrame:
    """(by, entity, t, rows, n, x, y, vx, vxy): repeated rows of a cell as their mean and inner deviations."""
    complete = is_value("x") & is_value("y")
    xs, ys = (F.when(complete, F.col(c).cast("double")) for c in ("x", "y"))
    for key in (*by, "entity", "t"):
        panel = panel.where(F.col(key).isNotNull())
    return panel.groupBy(*by, "entity", "t").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(xs).cast("double").alias("n"),
        F.coalesce(F.avg(xs), F.lit(0.0)).alias("x"),
        F.coalesce(F.avg(ys), F.lit(0.0)).alias("y"),
        F.coalesce(F.var_pop(xs) * F.count(xs), F.lit(0.0)).alias("vx"),
        F.coalesce(F.covar_pop(xs, ys) * F.count(xs), F.lit(0.0)).alias("vxy"),
    )


def _entity_rows(panel: DataFrame, by: list[str]) -> DataFrame:
    """One row per (panel, entity) with its cells, x and y centred on the entity mean.

    Repeated rows of a cell are merged first, before any shuffle; an entity then holds at
    most one cell per period.
    """
    cells = merged_cells(panel, by)
    # One collected column, so that no reader of these rows prunes another part of it and
    # all of them share the same shuffle.
    cell = F.struct("t", "rows", "n", "x", "y", "vx", "vxy")
    grouped = cells.groupBy(*by, "entity").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    used = F.filter("cells", lambda c: c["n"] > 0)
    centred = _let(_means("used"), lambda m: F.transform("used", lambda c: _less(c, m, "t")))
    return grouped.withColumn("used", used).select(
        *by,
        "entity",
        F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + c["rows"]).alias("rows"),
        centred.alias("cells"),
    )


def _period_sums(entities: DataFrame, by: list[str]) -> DataFrame:
    """Per (panel, period): weights and entity-centred sums. Counts ride along."""
    cells = entities.select(*by, "rows", F.posexplode_outer("cells").alias("pos", "c"))
    once = F.coalesce(F.col("pos") == 0, F.lit(True))
    n, x, y = F.col("c.n"), F.col("c.x"), F.col("c.y")
    return cells.groupBy(*by, F.col("c.t").alias("t")).agg(
        F.sum(n).alias("weight"),
        F.sum(n * x).alias("bx"),
        F.sum(n * y).alias("by"),
        F.sum(n * x * x + F.col("c.vx")).alias("sxx"),
        F.sum(n * x * y + F.col("c.vxy")).alias("sxy"),
        F.sum(F.when(once, F.col("rows"))).alias("rows"),
        F.count(F.when(once, 1)).alias("entities"),
        F.count(F.when(once & F.col("pos").isNotNull(), 1)).alias("used"),
    )


class _Links:
    """How entities link the periods of one panel, as a matrix that grows with its periods."""

    def __init__(self):
        self.place: dict = {}
        self.matrix = np.zeros((8, 8))

    def add(self, periods, block: np.ndarray) -> None:
        at = [self.place.setdefault(t, len(self.place)) for t in periods]
        if len(self.place) > len(self.matrix):
            grown = np.zeros((2 * len(self.place),) * 2)
            grown[: len(self.matrix), : len(self.matrix)] = self.matrix
            self.matrix = grown
        self.matrix[np.ix_(at, at)] += block

    def row(self) -> tuple[list, np.ndarray]:
        """Periods in order and the matrix, line by line."""
        periods = sorted(self.place)
        at = [self.place[t] for t in periods]
        return periods, self.matrix[np.ix_(at, at)].ravel()


def _period_links(entities: DataFrame, by: list[str]) -> DataFrame:
    """(by, periods, links): one row per panel, links[i * n + j] of the i-th and j-th period."""
    cells = entities.where(F.size("cells") > 0).select(
        *by,
        F.col("cells.t").alias("periods"),
        F.col("cells.n").alias("links"),
    )
    schema = cells.schema

    def frame(panels: dict) -> pd.DataFrame:
        rows = [(*key, *links.row()) for key, links in panels.items()]
        return pd.DataFrame(rows, columns=[*by, "periods", "links"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        panels: dict[tuple, _Links] = {}
        for batch in batches:
            for *key, periods, n in batch.itertuples(index=False):
                panels.setdefault(tuple(key), _Links()).add(periods, np.outer(n, n) / n.sum())
            if sum(p.matrix.size for p in panels.values()) > HELD:
                yield frame(panels)
                panels = {}
        if panels:
            yield frame(panels)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of one panel follow each other."""
        panels: dict[tuple, _Links] = {}
        for batch in batches:
            for *key, periods, links in batch.itertuples(index=False):
                if panels and tuple(key) not in panels:
                    yield frame(panels)
                    panels = {}
                panels.setdefault(tuple(key), _Links()).add(periods, links.reshape(len(periods), -1))
        if panels:
            yield frame(panels)

    parts = cells.mapInPandas(gather, schema)
    together = parts.repartition(*by).sortWithinPartitions(*by) if by else parts.repartition(1)
    return together.mapInPandas(add, schema)


def _solve(by: list[str]):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        sums = rows[rows["links"].isna()]
        periods = sums.dropna(subset=["t"]).sort_values("t")
        links = rows["links"].dropna()
        out = {c: rows[c].iloc[0] for c in by}
        out["n_obs"] = int(sums["rows"].sum())
        out["n_entities"] = int(sums["entities"].sum())
        out["n_used"] = periods["weight"].sum()
        out["n_params"] = int(sums["used"].sum()) + len(periods)
        out["slope0"], out["scale"], out["effects"] = None, None, []
        target = periods[["bx", "by"]].to_numpy()
        if len(periods) and np.isfinite(target).all():
            # Both the sums and the matrix have the panel's periods in ascending order.
            system = np.diag(periods["weight"].to_numpy()) - links.iloc[0].reshape(len(periods), -1)
            effects = np.linalg.lstsq(system, target, rcond=1e-11)[0]
            sxx, sxy = periods["sxx"].sum(), periods["sxy"].sum()
            left = sxx - target[:, 0] @ effects[:, 0]
            if left > NEGLIGIBLE * sxx:
                out["slope0"] = (sxy - target[:, 0] @ effects[:, 1]) / left
                out["scale"] = sxx
            out["effects"] = [
                {"t": t, "x": gx, "y": gy} for t, (gx, gy) in zip(periods["t"], effects)
            ]
        return pd.DataFrame([out])

    return solve


_EFFECTS = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("x", "y")])


@F.pandas_udf(_EFFECTS)
def _effects_at(periods: pd.Series, known: pd.Series, x: pd.Series, y: pd.Series) -> pd.DataFrame:
    """The effects of the periods of each entity, looked up in the panel's ascending periods."""
    found = []
    for mine, every, gx, gy in zip(periods, known, x, y):
        at = np.searchsorted(every, mine) if len(every) else []
        found.append((gx[at], gy[at]) if len(every) else (gx, gy))
    return pd.DataFrame(found, columns=["x", "y"])


def two_sided_p(statistic: Column) -> Column:
    """Two-sided p-value of a standard normal statistic, to about 1e-13 of its value.

    Up to z = 2 one minus the error function, from its series of positive terms; beyond,
    where that difference loses digits, the continued fraction of the complement.
    """
    z = F.abs(statistic) / math.sqrt(2.0)
    series = _let(
        z,
        lambda z: F.aggregate(
            F.sequence(F.lit(1), F.lit(60)),
            F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
            lambda acc, k: _let(
                acc["term"] * 2.0 * z * z / (2 * k + 1),
                lambda term: F.struct(term.alias("term"), (acc["sum"] + term).alias("sum")),
            ),
            lambda acc: acc["sum"],
        ),
    )
    error = z * (2.0 / math.sqrt(math.pi)) * F.exp(-z * z) * series
    fraction = _let(
        z, lambda z: F.aggregate(F.sequence(F.lit(120), F.lit(1)), z, lambda acc, k: z + k / 2.0 / acc)
    )
    tail = F.exp(-z * z) / math.sqrt(math.pi) / fraction
    return F.when(z > 2.0, tail).when(z.isNotNull(), F.greatest(1.0 - error, F.lit(0.0)))


def fixed_effects(
    panel: DataFrame,
    by: Sequence[str],
    entity: str,
    time: str,
    x: str,
    y: str,
    min_obs: int = 30,
    min_entities: int = 5,
    alpha: float = 0.05,
    on_missing: str = "fail",
    digits: tuple[int, int] | None = (5, 4),
) -> DataFrame:
    """(by, n_obs, n_entities, efeito, erro_padrao, valor_p, interpretacao) per panel.

    Panels under either minimum get the "insufficient" verdict. A panel without
    variation of x left, or (unless ``on_missing`` is "drop") with a missing value, gets
    "could not estimate". Errors are clustered by entity with the usual small-sample
    factor; p-values are normal.
    """
    if on_missing not in ("fail", "drop"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    names = {f"by_{i}": c for i, c in enumerate(by)}
    by = list(names)
    columns = {**names, "entity": entity, "t": time, "x": x, "y": y}
    panel = panel.select(*[F.col(c).alias(own) for own, c in columns.items()])
    types = dict(panel.dtypes)
    entities = _entity_rows(panel, by)
    solution_schema = ", ".join(
        [f"{c} {types[c]}" for c in by]
        + ["n_obs BIGINT, n_entities BIGINT, n_used DOUBLE, n_params BIGINT, slope0 DOUBLE, scale DOUBLE"]
        + [f"effects ARRAY<STRUCT<t: {types['t']}, x: DOUBLE, y: DOUBLE>>"]
    )
    system = _period_sums(entities, by).unionByName(_period_links(entities, by), allowMissingColumns=True)
    solved = system.groupBy(*by).applyInPandas(_solve(by), solution_schema)

    # Residuals of each cell: take out the time effects, then what they leave of the
    # entity mean; then one struct of sums per entity.
    timed = F.zip_with("cells", F.arrays_zip("taken.x", "taken.y"), lambda c, effect: _less(c, effect))
    slope0 = F.col("slope0")

    def add(acc: Column, c: Column, mean: Column) -> Column:
        return _let(
            F.struct((c["x"] - mean["x"]).alias("x"), (c["y"] - mean["y"]).alias("y")),
            lambda r: F.struct(
                (acc["s"] + c["n"] * r["x"] * (r["y"] - slope0 * r["x"]) + c["vxy"] - slope0 * c["vx"]).alias("s"),
                (acc["q"] + c["n"] * r["x"] * r["x"] + c["vx"]).alias("q"),
            ),
        )

    nothing = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    entity_sums = _let(
        timed,
        lambda cells: _let(
            _means(cells), lambda mean: F.aggregate(cells, nothing, lambda acc, c: add(acc, c, mean))
        ),
    )
    # A few panels hold all entities, so each panel's entities are dealt over as many salts as
    # a shuffle has partitions and the one solution row of the panel is repeated for each. The
    # null-safe test adds no filter to one reader of the entity rows, which would stop it
    # sharing their shuffle.
    salts = max(1, int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    repeated = solved.withColumnsRenamed({c: f"_of_{c}" for c in by}).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    same = F.pmod(F.xxhash64("entity"), F.lit(salts)).cast("int").eqNullSafe(F.col("_salt"))
    for c in by:
        same &= F.col(c) == F.col(f"_of_{c}")
    scores = (
        entities.join(repeated, same)
        .withColumn("taken", _effects_at("cells.t", "effects.t", "effects.x", "effects.y"))
        .select(
            *by, "n_obs", "n_entities", "n_used", "n_params", "scale", "slope0",
            (F.size("cells") > 0).alias("used"), entity_sums.alias("sums"),
        )
        .select("*", F.col("sums.s").alias("score"), F.col("sums.q").alias("square"))
    )
    s, q = F.col("score"), F.col("square")
    sums = scores.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in ("n_obs", "n_entities", "n_used", "n_params", "scale", "slope0")],
        F.count_if("used").alias("clusters"),
        F.sum(s).alias("s"),
        F.sum(q).alias("q"),
        F.sum(s * s).alias("ss"),
        F.sum(s * q).alias("sq"),
        F.sum(q * q).alias("qq"),
    )

    # The solved slope centres the scores; what is left of it corrects both results.
    fitted = sums.withColumn("shift", F.when(F.col("q") > F.col("scale") * NEGLIGIBLE, F.col("s") / F.col("q")))
    shift = F.col("shift")
    meat = F.col("ss") - 2 * shift * F.col("sq") + shift * shift * F.col("qq")
    complete = F.lit(on_missing == "drop") | (F.col("n_obs") == F.col("n_used"))
    estimated = fitted.select(
        *by,
        "n_obs",
        "n_entities",
        F.when(complete, slope0 + shift).alias("slope"),
        F.when(complete, clustered_error(meat, F.col("q"))).alias("error"),
    )
    return report(estimated, names, min_obs, min_entities, alpha, digits)


def clustered_error(meat: Column, square: Column) -> Column:
    """Standard error from the summed squares of the entities' scores (columns ``clusters``, ``n_used``, ``n_params``)."""
    factor = F.try_divide(F.col("clusters"), F.col("clusters") - 1) * F.when(
        F.col("n_used") > F.col("n_params"), (F.col("n_used") - 1) / (F.col("n_used") - F.col("n_params"))
    )
    return F.try_divide(F.sqrt(factor * F.greatest(meat, F.lit(0.0))), square)


def report(
    estimated: DataFrame,
    names: dict[str, str],
    min_obs: int = 30,
    min_entities: int = 5,
    alpha: float = 0.05,
    digits: tuple[int, int] | None = (5, 4),
) -> DataFrame:
    """Verdicts on (keys of ``names``, n_obs, n_entities, slope, error), under the names of the panel's columns."""
    enough = (F.col("n_obs") >= min_obs) & (F.col("n_entities") >= min_entities)
    held = estimated.withColumns({c: F.when(enough, F.col(c)) for c in ("slope", "error")}).withColumn("enough", enough)
    tested = held.withColumn("p", two_sided_p(F.try_divide("slope", "error")))
    effect, p = F.col("slope"), F.col("p")
    verdict = (
        F.when(~F.col("enough"), fv.VERDICT_FEW)
        .when(effect.isNull() | p.isNull(), fv.VERDICT_FAILED)
        .when((p < alpha) & (effect < 0), fv.VERDICT_DOWN)
        .when(p < alpha, fv.VERDICT_UP)
        .otherwise(fv.VERDICT_NONE)
    )
    return tested.select(
        *[F.col(own).alias(c) for own, c in names.items()],
        "n_obs",
        "n_entities",
        (effect if digits is None else round_half_even(effect, digits[0])).alias("efeito"),
        F.col("error").alias("erro_padrao"),
        (p if digits is None else round_half_even(p, digits[1])).alias("valor_p"),
        verdict.alias("interpretacao"),
    )
