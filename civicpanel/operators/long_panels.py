"""Two-way fixed-effects regression for panels with many periods, by conjugate gradients.

The estimate is that of ``panel_regression.fixed_effects``. There the time effects come from one
dense matrix of periods x periods; here they come from rounds of joins and sums over the cells
(entity, period), so a panel may have as many periods as it likes. One round multiplies the
current direction with that matrix without ever having it: a mean over the periods of each
entity, then a sum over the entities of each period. Rounds are preconditioned by the weight
of each period and end when every panel's residual has fallen to ``TOLERANCE`` of what it was;
the number of rounds follows from how well entities and periods are linked, not from their
number. The state, one row per panel and period, is stored after every round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.operators.panel_regression import NEGLIGIBLE, clustered_error, merged_cells, report
from civicpanel.sources.scratch import stored

TOLERANCE = 1e-10
ROUNDS = 500
SIDES = ("x", "y")


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def _per_entity(cells: DataFrame, by: list[str], columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Cells with the weighted means of columns over each entity."""
    means = [(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(m) for c, m in zip(columns, names)]
    return cells.join(cells.groupBy(*by, "entity").agg(*means), [*by, "entity"])


def _scalars(state: DataFrame, by: list[str], **sums: Column) -> DataFrame:
    """State with sums over each panel."""
    return state.join(state.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in sums.items()]), by)


def _start(cells: DataFrame, by: list[str]) -> DataFrame:
    """Per (panel, period): weight d, effects l = 0, residuals r, directions p and, for all periods alike, the products z."""
    sums = cells.groupBy(*by, "t").agg(F.sum("n").alias("d"), *[F.sum(F.col("n") * F.col(s)).alias(f"r{s}") for s in SIDES])
    first = sums.withColumns({f"l{s}": F.lit(0.0) for s in SIDES} | {f"p{s}": F.col(f"r{s}") / F.col("d") for s in SIDES})
    known = _scalars(first, by, **{f"z{s}": F.col(f"r{s}") * F.col(f"r{s}") / F.col("d") for s in SIDES})
    return known.withColumns({f"o{s}": F.col(f"z{s}") for s in SIDES})


def _round(cells: DataFrame, state: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    """One step of conjugate gradients for x and y; a panel that is done stays as it is."""
    directed = cells.select(*by, "entity", "t", "n").join(state.select(*by, "t", "px", "py"), [*by, "t"])
    taken = _per_entity(directed, by, ["px", "py"], ["mx", "my"])
    product = taken.groupBy(*by, "t").agg(*[F.sum(F.col("n") * (F.col(f"p{s}") - F.col(f"m{s}"))).alias(f"q{s}") for s in SIDES])
    met = _scalars(state.join(product, [*by, "t"]), by, **{f"w{s}": F.col(f"p{s}") * F.col(f"q{s}") for s in SIDES})
    live = {s: F.col(f"z{s}") > F.lit(tolerance**2) * F.col(f"o{s}") for s in SIDES}
    step = {s: F.when(live[s], _ratio(F.col(f"z{s}"), F.col(f"w{s}"))).otherwise(0.0) for s in SIDES}
    moved = met.withColumns(
        {f"l{s}": F.col(f"l{s}") + step[s] * F.col(f"p{s}") for s in SIDES} | {f"r{s}": F.col(f"r{s}") - step[s] * F.col(f"q{s}") for s in SIDES}
    )
    left = _scalars(moved, by, **{f"new{s}": F.col(f"r{s}") * F.col(f"r{s}") / F.col("d") for s in SIDES})
    turned = {s: F.col(f"r{s}") / F.col("d") + _ratio(F.col(f"new{s}"), F.col(f"z{s}")) * F.col(f"p{s}") for s in SIDES}
    next_ = left.withColumns({f"p{s}": F.when(live[s], turned[s]).otherwise(0.0) for s in SIDES})
    return next_.withColumns({f"z{s}": F.when(live[s], F.col(f"new{s}")).otherwise(F.col(f"z{s}")) for s in SIDES}).select(*state.columns)


def time_effects(cells: DataFrame, by: list[str], tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """(by, t, lx, ly) for cells (by, entity, t, n, x, y) with x and y centred on their entity's means."""
    state = stored(_start(cells, by), "effects")
    for _ in range(rounds):
        worst = [F.max(_ratio(F.col(f"z{s}"), F.col(f"o{s}"))).alias(s) for s in SIDES]
        ratios = state.agg(*worst).first()
        if max(r or 0.0 for r in ratios) <= tolerance**2:
            return state.select(*by, "t", "lx", "ly")
        state = stored(_round(cells, state, by, tolerance), "effects")
    raise RuntimeError(f"time effects are not found after {rounds} rounds")


def fixed_effects_long(
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
    """As ``fixed_effects``, for any number of periods. Rows without a panel, entity or period count nowhere."""
    if on_missing not in ("fail", "drop"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    names = {f"by_{i}": c for i, c in enumerate(by)}
    own = [*names, "panel"]
    columns = {**names, "entity": entity, "t": time, "x": x, "y": y}
    panel = panel.select(*[F.col(c).alias(n) for n, c in columns.items()]).withColumn("panel", F.lit(0))
    cells = stored(merged_cells(panel, own), "cells")
    used = cells.where("n > 0")
    centred = _per_entity(used, own, ["x", "y"], ["ax", "ay"]).withColumns({s: F.col(s) - F.col(f"a{s}") for s in SIDES})
    centred = stored(centred.drop("ax", "ay", "rows"), "centred")
    effects = time_effects(centred, own)
    timed = _per_entity(centred.join(effects, [*own, "t"]), own, ["lx", "ly"], ["mx", "my"])
    rest = stored(timed.withColumns({s: F.col(s) - F.col(f"l{s}") + F.col(f"m{s}") for s in SIDES}).drop("lx", "ly", "mx", "my"), "residuals")
    squares = rest.groupBy(*own).agg(
        F.sum(F.col("n") * F.col("x") * F.col("x") + F.col("vx")).alias("q"), F.sum(F.col("n") * F.col("x") * F.col("y") + F.col("vxy")).alias("xy"),
        F.countDistinct("t").alias("periods"),
    )
    before = centred.groupBy(*own).agg(F.sum(F.col("n") * F.col("x") * F.col("x") + F.col("vx")).alias("scale"))
    slopes = squares.join(before, own).withColumn("slope", F.when(F.col("q") > F.col("scale") * NEGLIGIBLE, F.col("xy") / F.col("q")))
    # Scores of the entities, with the slope taken out.
    parts = rest.groupBy(*own, "entity").agg(
        F.sum(F.col("n") * F.col("x") * F.col("y") + F.col("vxy")).alias("sy"), F.sum(F.col("n") * F.col("x") * F.col("x") + F.col("vx")).alias("sx")
    )
    score = F.col("sy") - F.col("slope") * F.col("sx")
    meats = parts.join(slopes.select(*own, "slope"), own).groupBy(*own).agg(F.sum(score * score).alias("meat"), F.count(F.lit(1)).alias("clusters"))
    counts = cells.groupBy(*own).agg(
        F.sum("rows").alias("n_obs"), F.countDistinct("entity").alias("n_entities"), F.sum("n").alias("n_used")
    )
    fitted = counts.join(slopes, own, "left").join(meats, own, "left").withColumn("n_params", F.col("clusters") + F.col("periods"))
    complete = F.lit(on_missing == "drop") | (F.col("n_obs") == F.col("n_used"))
    estimated = fitted.select(
        *names, "n_obs", "n_entities", F.when(complete, F.col("slope")).alias("slope"),
        F.when(complete, clustered_error(F.col("meat"), F.col("q"))).alias("error"),
    )
    return report(estimated, names, min_obs, min_entities, alpha, digits)
