"""Distinct counts, published stars, refresh, long histories, codes, intervals and bad lines."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicpanel.operators import codes, distinct, history, intervals, keyword_index, rollup
from civicpanel.plans import star
from civicpanel.sources import published, rejects, scratch, variants
from civicpanel.sources.frames import indicator_dim, state_dim
from workload import inputs as src
from workload import upkeep
from workload.domain import order_fact


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- distinct counts


def test_bitmaps_equal_distinct_counts(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40_000, 40_050), -3, 2**40])) for _ in range(900)]
    df = spark.createDataFrame(data, "g STRING, v BIGINT")
    states = distinct.bitmap_states(df, ["g"], "v")
    assert rows(distinct.count_states(states, ["g"], "n"), "g", "n") == rows(
        df.where("v IS NOT NULL").groupBy("g").agg(F.countDistinct("v").alias("n")), "g", "n"
    )
    found = {(r.grao, r.entidade): r.n for r in distinct.count_grains(states, {"g": "g", "all": F.lit("x")}, "n").collect()}
    everything = {v for _, v in data if v is not None}
    assert found["all", "x"] == len(everything) and set(found) == {("g", "a"), ("g", "b"), ("all", "x")}
    assert distinct.count_states(distinct.bitmap_states(df.where("false"), ["g"], "v"), ["g"], "n").collect() == []


def test_states_of_two_runs_merge(spark):
    first, second = (spark.range(a, b).select(F.lit("g").alias("g"), "id") for a, b in ((0, 70_000), (60_000, 100_000)))
    both = distinct.bitmap_states(first, ["g"], "id").unionByName(distinct.bitmap_states(second, ["g"], "id"))
    assert distinct.count_states(both, ["g"], "n").first().n == 100_000
    assert distinct.merge_states(both, ["g"]).count() == 5  # of 32,768 values each, the first one of value 0


def test_numbered_values(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", None, "", "ç"]], "v STRING")
    assert rows(distinct.numbered_values(df, "v", "n"), "v", "n") == [("", 0), ("a", 1), ("b", 2), ("ç", 3)]
    many = distinct.numbered_values(spark.range(50_000).select((F.col("id") % 9_000).alias("v")).repartition(8), "v", "n")
    assert many.where("v <> n").count() == 0 and many.count() == 9_000


def passes_over(df, name):
    """How often a plan reads a table of the test data."""
    return plan(df).count(f"/{name}.parquet")


def test_population_reads_no_orders_again(spark, data):
    """The fact is stored once; the report over it reads neither orders nor customers."""
    from workload.reports import page_correlations, page_outcome_series, page_regressions

    for query in (page_correlations, page_regressions, page_outcome_series):
        assert passes_over(query(spark, data), "orders") == 0


# --- published star


@pytest.fixture
def small_star(spark, tmp_path):
    root = str(tmp_path / "star")
    fact = spark.createDataFrame(
        [(2000, "SP", "2_gini", "", 0.5), (2001, "SP", "2_gini", "", 0.6), (2000, "RJ", "8_ideb", "x", 4.0)],
        "ano INT, sigla_uf STRING, id_indicador STRING, dimensao STRING, valor DOUBLE",
    )
    published.publish(spark, root, fact, state_dim(spark), indicator_dim(spark))
    return root, fact


def gini(spark, root, **more):
    return rows(published.read_published(spark, root, **more)["fato_indicador"].where("id_indicador = '2_gini'"), "ano", "valor")


def test_replace_one_indicator(spark, small_star):
    root, fact = small_star
    newer = fact.where("id_indicador = '2_gini' AND ano = 2001").withColumn("valor", F.lit(0.7))
    renamed = indicator_dim(spark).withColumn("nome", F.lit("novo"))
    assert published.replace(spark, root, ["2_gini"], newer, {"dim_indicador": renamed}) == 2
    tables = published.read_published(spark, root)
    assert gini(spark, root) == [(2001, 0.7)]
    assert tables["fato_indicador"].count() == 2 and tables["dim_governador"] is None
    assert {r.nome for r in tables["dim_indicador"].collect()} == {"novo"}
    assert tables["dim_estado"].count() == state_dim(spark).count()
    assert gini(spark, root, publication=1) == [(2000, 0.5), (2001, 0.6)]
    pruned = plan(tables["fato_indicador"].where("id_indicador = '8_ideb'"))
    assert "PartitionFilters: [" in pruned and "id_indicador" in pruned


def test_broken_off_between_the_steps(spark, small_star, monkeypatch):
    """Until the list is there, readers see the old fact and the old dimensions; a second try goes through."""
    root, fact = small_star
    newer = fact.where("id_indicador = '2_gini'").withColumn("valor", F.lit(9.0))
    renamed = indicator_dim(spark).withColumn("nome", F.lit("novo"))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(published, "announce", broken)
        with pytest.raises(OSError):
            published.replace(spark, root, ["2_gini"], newer, {"dim_indicador": renamed})
    assert gini(spark, root) == [(2000, 0.5), (2001, 0.6)]
    assert "novo" not in {r.nome for r in published.read_published(spark, root)["dim_indicador"].collect()}
    published.replace(spark, root, ["2_gini"], newer, {"dim_indicador": renamed})
    assert gini(spark, root) == [(2000, 9.0), (2001, 9.0)]
    assert len(published.forget_old(spark, root)) == 1  # what the broken try had staged
    assert gini(spark, root) == [(2000, 9.0), (2001, 9.0)]


def test_publication_rules(spark, small_star, tmp_path):
    root, fact = small_star
    with pytest.raises(ValueError, match="8_ideb"):
        published.replace(spark, root, ["2_gini"], fact)
    with pytest.raises(RuntimeError, match="came in between"):
        published.announce(spark, root, 0, [])
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        published.replace(spark, str(tmp_path / "none"), ["2_gini"], fact.where("id_indicador = '2_gini'"))
    published.replace(spark, root, ["2_gini"], fact.where("false"))
    assert gini(spark, root) == [] and published.read_published(spark, root)["fato_indicador"].count() == 1
    unnamed = fact.withColumn("id_indicador", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="no indicator"):
        published.publish(spark, str(tmp_path / "other"), unnamed, state_dim(spark), indicator_dim(spark))


# --- refresh


def test_merge_equals_roll_up(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, 2000, 2001]), rng.choice("ab"), float(rng.randint(-9, 9)), 1, 0.0) for _ in range(200)]
    df = spark.createDataFrame(data, "ano INT, k STRING, v DOUBLE, n BIGINT, x DOUBLE").withColumn("low", F.col("v")).withColumn("high", F.col("v"))
    states = {"v": "sum", "n": "sum", "low": "min", "high": "max"}
    whole = rollup.roll_up(df, ["ano", "k"], states)
    split = F.col("v") > 0
    merged = rollup.with_late_rows(rollup.roll_up(df.where(split), ["ano", "k"], states), df.where(~split), ["ano", "k"], states)
    assert rows(merged) == rows(whole) and merged.schema == whole.schema
    fresh = rollup.roll_up(df.where("ano = 2001").withColumn("v", F.lit(0.0)), ["ano", "k"], states)
    replaced = rollup.with_periods_replaced(whole, fresh, "ano", [2001])
    assert rows(replaced.where("ano = 2001")) == rows(fresh) and rows(replaced.where("ano IS NULL OR ano = 2000")) == rows(whole.where("ano IS NULL OR ano = 2000"))
    with pytest.raises(ValueError):
        rollup.roll_up(df, ["ano"], {"v": "median"})


def test_periods_without_rows_go(spark, tmp_path):
    folder = str(tmp_path / "kept")
    old = spark.createDataFrame([("a", 1.0, y) for y in (2000, 2001, 2002)], "k STRING, v DOUBLE, ano INT")
    old.write.partitionBy("ano").parquet(folder)
    rollup.replace_periods(old.where("ano = 2001").withColumn("v", F.lit(5.0)), folder, "ano", [2001, 2002])
    assert rows(spark.read.schema(old.schema).parquet(folder), "ano", "v") == [(2000, 1.0), (2001, 5.0)]


def test_refresh_reads_changed_years_only(spark, data):
    for fresh in upkeep.fresh_years(spark, data):
        filters = [line for line in plan(fresh).splitlines() if "orders.parquet" in line]
        assert len(filters) == 1 and "PushedFilters: [" in filters[0]
        pushed = filters[0].split("PushedFilters: [")[1]
        assert pushed.startswith("Or(And(GreaterThanOrEqual(o_orderdate,1996-01-01T00:00),LessThan(o_orderdate,1997-01-01T00:00)),")


# --- long histories


def plain_history(data):
    out, seen = [], {}
    for k, t, v in sorted(data, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] is not None, r[2])):
        total, last, most = seen.get(k, (None, None, None))
        out.append((k, t, v, total if v is None else (total or 0.0) + v, last, most))
        seen[k] = (out[-1][3], v, v if most is None else most if v is None else max(most, v))
    return out


def test_history_equals_a_plain_scan(spark, monkeypatch):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *range(50)]), rng.choice([None, float(rng.randint(-5, 5))])) for _ in range(3_000)]
    df = spark.createDataFrame(data, "k STRING, t INT, v DOUBLE").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = history.scanned(df, ["k"], ["t"], {"total": "v"}, {"last": "v"}, {"most": "v"})
        assert rows(found) == rows(spark.createDataFrame(plain_history(data), found.schema))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert history.scanned(df.where("false"), ["k"], ["t"], {"total": "v"}).collect() == []


def test_a_hot_key_is_shared_by_tasks(spark, monkeypatch):
    kept, write = [], history.stored
    monkeypatch.setattr(history, "stored", lambda df, name: kept.append(write(df, name)) or kept[-1])
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", F.lit(1.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = history.scanned(df, ["k"], ["id"], {"total": "v"})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.where("k = 0").agg(F.max("total")).first()[0] == 20_000
    slices = [r["count"] for r in kept[0].where("k = 0").groupBy("_part").count().collect()]
    assert len(slices) >= 3 and max(slices) <= 60_000 / 8 * 1.5
    assert "SortMergeJoin" in plan(found) or "BroadcastHashJoin" in plan(found)


# --- codes


def test_code_parts(spark):
    df = spark.createDataFrame([("3.10.301",), ("3",), (None,), ("a..b",)], "c STRING")
    found = df.select("c", codes.depth("c").alias("d"), codes.parent("c").alias("p"), codes.prefixes("c").alias("all")).collect()
    assert [tuple(r) for r in found] == [
        ("3.10.301", 3, "3.10", ["3", "3.10", "3.10.301"]), ("3", 1, None, ["3"]), (None, -1 if found[2].d == -1 else None, None, None),
        ("a..b", 3, "a.", ["a", "a.", "a..b"]),
    ]


def test_disagreeing_totals(spark):
    data = [("3", 10.0), ("3.1", 4.0), ("3.2", 6.0), ("3.2.1", 5.0), ("4", None), ("4.1", 0.0), ("5.1", 2.0), ("6", 1.0), (None, 3.0), ("7", 1.0), ("7.1", None)]
    df = spark.createDataFrame([(2000, c, v) for c, v in data], "ano INT, c STRING, v DOUBLE")
    assert rows(codes.disagreeing_totals(df, ["ano"], "c", "v"), "c", "informado", "soma_dos_filhos", "filhos", "diferenca") == [
        ("3.2", 6.0, 5.0, 1, 1.0), ("7", 1.0, None, 1, 1.0),
    ]
    assert rows(codes.orphans(df, ["ano"], "c"), "c") == [("5.1",)]
    leaves = df.where("c IN ('3.1', '3.2.1', '5.1')")
    assert rows(codes.tree_sums(leaves, ["ano"], "c", "v", "s"), "c", "nivel", "s") == [
        ("3", 1, 9.0), ("3.1", 2, 4.0), ("3.2", 2, 5.0), ("3.2.1", 3, 5.0), ("5", 1, 2.0), ("5.1", 2, 2.0),
    ]


# --- days


def test_intervals_by_day(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    rng = random.Random(4)
    terms = [(rng.choice(["a", "b", None]), day(s), day(s + rng.randint(-1, 60)), i) for i, s in enumerate(rng.choices(range(300), k=60))]
    terms += [("a", None, day(3), 90), ("a", day(3), None, 91)]
    moments = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *map(day, range(400))]), i) for i in range(300)]
    t = spark.createDataFrame(terms, "k STRING, s DATE, e DATE, i INT")
    m = spark.createDataFrame(moments, "k STRING, d DATE, id INT")
    for days in (1, 7, 1000):
        found = intervals.assign_intervals(m, t, ["k"], "d", "s", "e", ["i"], days)
        expected = []
        for k, d, id_ in moments:
            inside = [i for j, s, e, i in terms if None not in (k, d, j, s, e) and j == k and s <= d <= e]
            expected += [(k, d, id_, i) for i in inside or [None]]
        assert rows(found) == rows(spark.createDataFrame(expected, found.schema))
        inner = intervals.assign_intervals(m, t, ["k"], "d", "s", "e", ["i"], days, how="inner")
        assert inner.count() == sum(r[3] is not None for r in expected)
    shown = plan(found)
    assert "NestedLoop" not in shown and "Cartesian" not in shown
    assert intervals.in_bins(t, "s", "e", 60).count() < 3 * len(terms)


def test_overlaps(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    data = [("a", day(0), day(30), 0), ("a", day(2), day(4), 1), ("a", day(10), day(12), 2), ("a", day(31), day(40), 3), ("b", day(3), day(9), 4), ("b", day(9), day(9), 5)]
    found = intervals.overlaps(spark.createDataFrame(data, "k STRING, s DATE, e DATE, i INT"), ["k"], "s", "e")
    assert rows(found, "i", "fim_anterior") == [(1, day(30)), (2, day(30)), (5, day(9))]


# --- bad lines


def test_bad_lines_are_reported(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('v,k,extra\n1.5,a,x\nn/d,b,y\n2.5,"c, d",z\n3.5,e\n4.5,f,g,h\n,i,\n')
    (folder / "b.csv").write_text("v,k,extra\n7,last,x\nseven,bad,x\n")
    parsed = rejects.read_csv(spark, str(folder), "k STRING, v DOUBLE")
    assert rows(parsed.rows) == [("a", 1.5), ("c, d", 2.5), ("i", None), ("last", 7.0)]
    assert rows(parsed.rejects.select("linha")) == [("3.5,e",), ("4.5,f,g,h",), ("n/d,b,y",), ("seven,bad,x",)]
    assert {r.arquivo.rsplit("/", 1)[1]: r.linhas for r in parsed.rejected_per_file().collect()} == {"a.csv": 3, "b.csv": 1}
    assert parsed.rows.count() == 4 and parsed.rows.select("k").count() == 4
    with pytest.raises(ValueError, match="no column w"):
        rejects.read_csv(spark, str(folder), "w INT")


def test_consolidation_without_the_bad_lines(spark, tmp_path):
    (tmp_path / "gini_uf.csv").write_text("ano,cod_uf,uf,indice_gini\n2000,35,São Paulo,0.5\n2001,35,São Paulo,n/d\n")
    whole = star.consolidate_folder(spark, str(tmp_path), on_bad="reject")
    assert rows(whole.fact, "ano", "valor") == [(2000, 0.5)]
    assert rows(whole.rejects, "tabela", "linha") == [("gini_uf", "2001,35,São Paulo,n/d")]
    with pytest.raises(Exception, match="n/d"):
        star.consolidate_folder(spark, str(tmp_path)).fact.collect()
    with pytest.raises(ValueError):
        star.consolidate_folder(spark, str(tmp_path), on_bad="ignore")


def test_stored_tables_are_cleared(spark, data):
    scratch.clear(spark)
    fact = order_fact(spark, data)
    folder = fact.inputFiles()[0].rsplit("/", 1)[0]
    assert scratch.clear(spark) == 3
    with pytest.raises(Exception):
        spark.read.parquet(folder)
    assert src.states(spark, data).count() == 25


# --- JSON, search, buckets


def test_variant_leaves(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a":{"b":[1,{"c":null}]},"d":"x"}\nnot json\n[true]\n7\n{}\n')
    records = variants.read_records(spark, str(tmp_path / "r.json"))
    assert records.where("registro IS NULL").count() == 1
    assert rows(variants.leaves(records, "registro")) == [
        ("$", "7"), ("$.a.b[0]", "1"), ("$.a.b[1].c", None), ("$.d", "x"), ("$[0]", "true"),
    ]
    assert rows(variants.leaves(records, "registro", depth=1).where("caminho = '$.a'")) == [("$.a", '{"b":[1,{"c":null}]}')]
    assert rows(variants.entries(records, "registro"), "pos", "chave") == [(0, "a"), (0, None), (1, "d")]


def test_indexed_search_equals_a_scan(spark, tmp_path):
    rng = random.Random(5)
    texts = [(i, rng.choice([None, "", "ab", "".join(rng.choices("abcDE ", k=rng.randint(3, 40)))])) for i in range(400)] + [(900, "Ação\nlonga"), (None, "abcabc")]
    df = spark.createDataFrame(texts, "id INT, t STRING")
    index = keyword_index.build(df, "id", "t", buckets=8, folder=str(tmp_path / "index"))
    for words in (["abc"], ["ABCD", "ção"], ["dede", "nowhere"], ["ab"], ["x" * 50], [], [""]):
        wanted = [w.lower() for w in words if w]
        expected = sorted(i for i, t in texts if i is not None and t and any(w in t.lower() for w in wanted))
        assert sorted(r.id for r in index.search(spark, words).collect()) == expected
    shown = plan(index.search(spark, ["abcd"]))
    assert "PartitionFilters: [_balde" in shown.replace("isnotnull(_balde", "_balde")


def test_posting_lists_are_stored_in_pieces(spark, tmp_path):
    """One record for each letter triple of the rows of a batch, also of long texts and of letters beyond 16 bits."""
    long = "".join(random.Random(6).choices("abcdefgh \x00é😀", k=20_000))
    texts = [(f"k{i}", "one two three") for i in range(300)] + [("long", long + "Needle"), ("end", "x\x00😀y"), (None, "one")]
    df = spark.createDataFrame(texts, "id STRING, t STRING").coalesce(1)
    before = spark.conf.get(keyword_index.ARROW_ROWS)
    index = keyword_index.build(df, "id", "t", buckets=8, folder=str(tmp_path / "index"))
    assert spark.conf.get(keyword_index.ARROW_ROWS) == before
    lists = spark.read.schema(index.list_schema).parquet(index.lists)
    distinct = {t.lower()[i : i + 3] for k, t in texts if k for i in range(len(t) - 2)}
    assert lists.count() == len(distinct)
    for word in ("needle", "two three", long[10_000:10_030], "\x00😀Y", "no"):
        expected = sorted(k for k, t in texts if k and word.lower() in t.lower())
        assert sorted(r.id for r in index.search(spark, [word]).collect()) == expected


def test_bucketed_join_has_no_exchange(spark, data):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spent, balances = upkeep.bucketed_sides(spark, data, 1)
        joined = spent.join(balances, ["ano", "sigla_uf"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
