import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.operators import panel_regression as regression
from civicpanel.operators.long_panels import fixed_effects_long
from civicpanel.operators.panel_regression import fixed_effects, two_sided_p

SCHEMA = "combo STRING, uf STRING, ano INT, x DOUBLE, y DOUBLE"


def explicit_dummies(data):
    """Slope, clustered error and p by ordinary least squares on written-out dummies."""
    entities = sorted({r[1] for r in data})
    times = sorted({r[2] for r in data})
    design = np.array(
        [
            [1.0, x]
            + [float(u == e) for e in entities[1:]]
            + [float(t == s) for s in times[1:]]
            for _, u, t, x, _ in data
        ]
    )
    y = np.array([r[4] for r in data])
    pseudo = np.linalg.pinv(design)
    inverse = pseudo @ pseudo.T
    beta = pseudo @ y
    residual = y - design @ beta
    meat = np.zeros((design.shape[1],) * 2)
    for e in entities:
        mine = np.array([r[1] == e for r in data])
        s = design[mine].T @ residual[mine]
        meat += np.outer(s, s)
    n, k = design.shape
    g = len(entities)
    variance = (inverse @ meat @ inverse) * g / (g - 1) * (n - 1) / (n - k)
    se = math.sqrt(variance[1, 1])
    return beta[1], se, math.erfc(abs(beta[1] / se) / math.sqrt(2))


def noisy(combo, entities, years, seed, hole=0.0, repeat=0.0, trend=0.0):
    rng = np.random.default_rng(seed)
    data = []
    for e in range(entities):
        base = rng.normal(0, 20)
        for t in range(years):
            if rng.random() < hole:
                continue
            for _ in range(1 + (rng.random() < repeat)):
                x = base + trend * t + rng.normal(0, 3)
                y = 0.4 * x + base * 2 - 3 * t * trend + rng.normal(0, 5)
                data.append((combo, f"u{e:03d}", 2000 + t, float(x), float(y)))
    return data


@pytest.mark.parametrize(
    "data",
    [
        noisy("balanced", 12, 6, 1),
        noisy("holes", 20, 8, 2, hole=0.3),
        noisy("repeats", 15, 6, 3, hole=0.2, repeat=0.3),
        noisy("trend", 20, 8, 4, hole=0.4, trend=1000.0),
    ],
    ids=["balanced", "holes", "repeats", "trend"],
)
def test_equals_explicit_dummies(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = fixed_effects(df, ["combo"], "uf", "ano", "x", "y", digits=None).collect()[0]
    beta, se, p = explicit_dummies(data)
    assert got["n_obs"] == len(data)
    assert got["n_entities"] == len({r[1] for r in data})
    assert got["efeito"] == pytest.approx(beta, rel=1e-8)
    assert got["erro_padrao"] == pytest.approx(se, rel=1e-7)
    assert got["valor_p"] == pytest.approx(p, rel=1e-6, abs=1e-12)


@pytest.mark.parametrize("missing", ["fail", "drop"])
def test_rounds_equal_the_matrix(spark, missing):
    """Panels with holes, repeats, missing values, a disconnected one and a small one: conjugate gradients find the same."""
    data = noisy("holes", 14, 40, 5, hole=0.5, repeat=0.1) + noisy("trend", 10, 20, 6, hole=0.3, trend=50.0) + noisy("few", 3, 4, 7)
    data += [("split", f"v{e}", 10 * (e % 2) + t, float((e * t) % 5), float((e + 1) * t * t % 7)) for e in range(8) for t in range(9)]
    data += [("missing", *r[1:]) for r in noisy("m", 8, 9, 8)] + [("missing", "u000", 2001, None, 1.0), (None, "u1", 2000, 1.0, 1.0), ("holes", None, 2000, 1.0, 1.0)]
    data += [("flat", f"u{e}", t, 2.0, float(e * t)) for e in range(6) for t in range(6)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    both = [f(df, ["combo"], "uf", "ano", "x", "y", on_missing=missing, digits=None) for f in (fixed_effects, fixed_effects_long)]
    expected, found = ({r.combo: r for r in b.collect()} for b in both)
    assert both[0].dtypes == both[1].dtypes and set(found) == set(expected) == {"holes", "trend", "few", "split", "missing", "flat"}
    for name, r in expected.items():
        assert found[name][:3] == r[:3] and found[name].interpretacao == r.interpretacao
        for column in ("efeito", "erro_padrao", "valor_p"):
            assert found[name][column] == (None if r[column] is None else pytest.approx(r[column], rel=1e-6, abs=1e-9)), (name, column)


def test_long_panels_of_nothing(spark):
    assert fixed_effects_long(spark.createDataFrame([], SCHEMA), ["combo"], "uf", "ano", "x", "y").collect() == []


def line_panel(drop=0, shift_entity=None, shift_year=None):
    data = []
    for i in range(6):
        for t in range(5):
            x = float((i * t) % 7)
            y = 3 * x + 10 * i - 2 * t
            y += 5 if i == shift_entity else 0
            y += 5 if t == shift_year else 0
            data.append(("a", f"u{i}", 2000 + t, x, y))
    return data[drop:]


def test_exact_slope_and_minimum(spark):
    def slope(data):
        return fixed_effects(
            spark.createDataFrame(data, SCHEMA), ["combo"], "uf", "ano", "x", "y"
        ).collect()[0]

    assert slope(line_panel())["efeito"] == 3.0
    assert slope(line_panel(shift_entity=2))["efeito"] == 3.0
    assert slope(line_panel(shift_year=3))["efeito"] == 3.0
    few = slope(line_panel(drop=1))
    assert (few["n_obs"], few["efeito"], few["interpretacao"]) == (29, None, fv.VERDICT_FEW)


def test_no_variation_left_gives_no_estimate(spark):
    for x in (lambda i, t: i + t, lambda i, t: 7, lambda i, t: i, lambda i, t: 0):
        data = [("a", f"u{i}", 2000 + t, float(x(i, t)), float(i * t)) for i in range(6) for t in range(6)]
        got = fixed_effects(spark.createDataFrame(data, SCHEMA), ["combo"], "uf", "ano", "x", "y").collect()[0]
        assert (got["efeito"], got["valor_p"], got["interpretacao"]) == (None, None, fv.VERDICT_FAILED)


def test_perfect_fit_and_flat_outcome(spark):
    """No residual at all, and an outcome that never moves: no division error either way."""
    flat = [(c, e, t, x, 1.0) for c, e, t, x, _ in line_panel()]
    got = fixed_effects(spark.createDataFrame(flat, SCHEMA), ["combo"], "uf", "ano", "x", "y").collect()[0]
    assert got["efeito"] == 0.0 and got["n_obs"] == 30


def test_disconnected_panel(spark):
    """Two groups of entities that share no year: dummies are redundant, the slope is not."""
    early = noisy("d", 6, 4, 21)
    late = [(c, "v" + e, t + 50, x, y) for c, e, t, x, y in noisy("d", 6, 4, 22)]
    df = spark.createDataFrame(early + late, SCHEMA)
    got = fixed_effects(df, ["combo"], "uf", "ano", "x", "y", digits=None).collect()[0]
    beta, se, _ = explicit_dummies(early + late)
    assert got["efeito"] == pytest.approx(beta, rel=1e-9)
    assert got["erro_padrao"] == pytest.approx(se, rel=1e-8)


def test_missing_value_fails_unless_dropped(spark):
    data = noisy("m", 10, 6, 5)
    with_gap = [*data, ("m", "u000", 2099, None, 1.0)]
    df = spark.createDataFrame(with_gap, SCHEMA)
    failed = fixed_effects(df, ["combo"], "uf", "ano", "x", "y").collect()[0]
    assert (failed["n_obs"], failed["efeito"], failed["interpretacao"]) == (61, None, fv.VERDICT_FAILED)
    gone = df.union(spark.createDataFrame([("m", "u999", 2001, None, None)], SCHEMA))
    still = fixed_effects(gone, ["combo"], "uf", "ano", "x", "y", on_missing="drop", digits=None).collect()[0]
    assert (still["n_obs"], still["n_entities"]) == (62, 11)
    assert still["erro_padrao"] == pytest.approx(explicit_dummies(data)[1], rel=1e-8)
    dropped = fixed_effects(df, ["combo"], "uf", "ano", "x", "y", on_missing="drop", digits=None).collect()[0]
    assert dropped["efeito"] == pytest.approx(explicit_dummies(data)[0], rel=1e-9)


def test_infinite_and_nan_values_give_no_estimate(spark):
    data = noisy("m", 10, 6, 5)
    for bad in (float("inf"), float("nan")):
        broken = [*data[1:], ("m", "u000", 2000, bad, 1.0)]
        got = fixed_effects(spark.createDataFrame(broken, SCHEMA), ["combo"], "uf", "ano", "x", "y").collect()[0]
        assert (got["n_obs"], got["efeito"], got["interpretacao"]) == (60, None, fv.VERDICT_FAILED)


def test_any_column_names_and_time_types(spark):
    data = noisy("m", 10, 6, 5)
    df = spark.createDataFrame(data, SCHEMA).selectExpr(
        "combo AS t", "'k' AS rows", "uf AS x", "make_date(ano, 1, 1) AS entity", "x AS link", "y AS s"
    )
    got = fixed_effects(df, ["t", "rows"], "x", "entity", "link", "s", digits=None)
    assert got.columns[:2] == ["t", "rows"]
    row = got.collect()[0]
    assert (row["t"], row["rows"]) == ("m", "k")
    assert row["efeito"] == pytest.approx(explicit_dummies(data)[0], rel=1e-9)


def test_panels_are_independent_and_verdicts(spark):
    strong = [("up", e, t, x, 2 * x + y * 0.01) for _, e, t, x, y in noisy("", 12, 6, 7)]
    down = [("down", e, t, x, -2 * x + y * 0.01) for _, e, t, x, y in noisy("", 12, 6, 8)]
    rng = np.random.default_rng(9)
    none = [("none", e, t, x, float(rng.normal())) for _, e, t, x, y in noisy("", 12, 6, 9)]
    df = spark.createDataFrame(strong + down + none + line_panel(drop=5), SCHEMA)
    got = rows(fixed_effects(df, ["combo"], "uf", "ano", "x", "y"), "combo", "interpretacao")
    assert got == [
        ("a", fv.VERDICT_FEW),
        ("down", fv.VERDICT_DOWN),
        ("none", fv.VERDICT_NONE),
        ("up", fv.VERDICT_UP),
    ]


def test_source_is_read_once(spark, data):
    """Both the system and the scores read the same shuffled entity rows."""
    orders = spark.read.parquet(f"{data}/orders.parquet").selectExpr(
        "o_orderpriority AS combo", "o_custkey AS uf", "year(o_orderdate) AS ano",
        "o_totalprice AS x", "o_totalprice * o_totalprice AS y",
    )
    out = fixed_effects(orders, ["combo"], "uf", "ano", "x", "y")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1, plan


def test_p_value(spark):
    values = [0.0, 1e-9, 0.1, -0.5, 1.0, 1.959963984540054, -2.5, 4.0, 6.0, 8.0, 8.4, 9.0, 40.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in values], "t DOUBLE").select("t", two_sided_p(F.col("t")).alias("p"))
    for row in df.collect():
        if row.t is None:
            assert row.p is None
        else:
            assert row.p == pytest.approx(math.erfc(abs(row.t) / math.sqrt(2)), rel=1e-11, abs=1e-300)


def test_one_matrix_per_panel_whatever_repeats(spark, monkeypatch):
    """Repeated cells and a small memory give the same single row per panel, with no row per pair."""
    data = [*noisy("a", 40, 9, 5, hole=0.3, repeat=0.8), *noisy("b", 30, 6, 6, repeat=0.5)]
    df = spark.createDataFrame(data, SCHEMA).repartition(6).selectExpr("combo AS by_0", "uf AS entity", "ano AS t", "x", "y")
    entities = regression._entity_rows(df, ["by_0"])

    def links():
        return {r.by_0: (r.periods, np.array(r.links)) for r in regression._period_links(entities, ["by_0"]).collect()}

    whole = links()
    monkeypatch.setattr(regression, "HELD", 1)
    for key, (periods, matrix) in links().items():
        assert periods == whole[key][0] == sorted(periods)
        assert len(matrix) == len(periods) ** 2 and np.allclose(matrix, whole[key][1])
    expected = np.zeros((9, 9))
    for e in {r[1] for r in data if r[0] == "a"}:
        n = np.bincount([r[2] - 2000 for r in data if r[0] == "a" and r[1] == e], minlength=9)
        expected += np.outer(n, n) / n.sum()
    assert np.allclose(whole["a"][1].reshape(9, 9), expected)
