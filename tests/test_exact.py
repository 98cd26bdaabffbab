"""Exact quantiles, running totals, samples and neighbours against plain computation."""

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import forest, resample, running, sampling
from riskloom.operators.forest import leaves, near_neighbours
from riskloom.operators.neighbours import first_of, nearest_neighbours, reaches
from riskloom.operators.quantiles import exact_quantiles, exact_quantiles_by
from riskloom.operators.resample import synthetic_rows
from riskloom.session import written_once


@pytest.fixture(scope="module")
def lines(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_extendedprice", "l_quantity", "l_discount", "l_returnflag", "l_orderkey"
    )
    return df.withColumn("nothing", F.lit(None).cast("double")).cache()


@pytest.mark.parametrize("settle,accuracy", [(200_000, 10_000), (100, 100), (3, 20)])
def test_quantiles(lines, settle, accuracy):
    columns, shares = ["l_extendedprice", "l_quantity", "l_discount", "nothing"], [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(lines, columns, shares, settle_rows=settle, accuracy=accuracy)
    pdf = lines.toPandas()
    for c in columns[:3]:
        assert list(got[c].values()) == pytest.approx(list(np.quantile(pdf[c], shares)), rel=1e-12)
    assert set(got["nothing"].values()) == {None}


def test_quantiles_ignore_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"][0.5] == 2.5


@pytest.mark.parametrize("rows", [100_000, 200])
def test_quantiles_by_group(lines, monkeypatch, rows):
    monkeypatch.setattr(running, "ROWS_PER_RANGE", rows)
    monkeypatch.setattr(running.running_totals, "__defaults__", ((), False, rows))
    got = exact_quantiles_by(lines, "l_returnflag", "l_extendedprice", [0.25, 0.5]).toPandas().set_index("l_returnflag")
    want = lines.toPandas().groupby("l_returnflag").l_extendedprice.quantile([0.25, 0.5]).unstack()
    assert np.allclose(got.loc[want.index, ["q_0", "q_1"]], want, rtol=1e-12)


@pytest.mark.parametrize("rows", [100_000, 50])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(lines, rows, descending):
    grouped = lines.groupBy("l_extendedprice").agg(F.count("*").alias("n"))
    out = running.running_totals(grouped, "l_extendedprice", {"upto": "n"}, descending=descending, rows_per_range=rows)
    pdf = out.toPandas().sort_values("l_extendedprice", ascending=not descending)
    assert (pdf.n.cumsum() == pdf.upto).all()


def test_exact_choice_per_group(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 10 == 0, "rare").otherwise("usual"))
    for wanted in ({"rare": 123, "usual": 4000}, {"rare": 0, "usual": 4500}, {"rare": 500}):
        marked = sampling.mark_chosen(df, "g", wanted, ["id"], 1)
        got = {r["g"]: r["n"] for r in marked.where("chosen").groupBy("g").agg(F.count("*").alias("n")).collect()}
        assert got == {g: n for g, n in wanted.items() if n}
    with pytest.raises(ValueError):
        sampling.mark_chosen(df, "g", {"rare": 501}, ["id"], 1)


def test_stratified_counts_follow_largest_remainder():
    assert sampling.stratified_counts({0: 7, 1: 4}, 0.2) == {0: 2, 1: 1}
    assert sampling.stratified_counts({0: 90, 1: 10}, 0.2) == {0: 18, 1: 2}
    assert sum(sampling.stratified_counts({0: 3, 1: 3, 2: 5}, 0.25).values()) == 3


def test_split_is_repeatable(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 9 == 0).cast("int"))
    split = sampling.stratified_split(df, "y", ["id"])
    first = {r["id"] for r in split.where("is_test").collect()}
    again = {r["id"] for r in sampling.stratified_split(df.repartition(7), "y", ["id"]).where("is_test").collect()}
    assert first == again and len(first) == 200
    other = {r["id"] for r in sampling.stratified_split(df, "y", ["id"], seed=1).where("is_test").collect()}
    assert other != first


def test_seeded_sample_sizes(spark):
    df = spark.range(100)
    assert sampling.seeded_sample(df, ["id"], 7).count() == 7
    assert sampling.seeded_sample(df, ["id"], 700).count() == 100


def brute_neighbours(ids, x, k):
    d = np.zeros((len(x), len(x)))
    for j in range(x.shape[1]):
        d += (x[:, None, j] - x[None, :, j]) ** 2
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    return {(ids[i], r + 1): ids[j] for i in range(len(ids)) for r, j in enumerate(order[i]) if np.isfinite(d[i, j])}


@pytest.mark.parametrize("copies", [False, True])
@pytest.mark.parametrize("options", [{}, {"n_pivots": 20, "block_rows": 30}])
def test_neighbours(spark, copies, options):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(400, 3)), 1)
    if copies:
        x[::3] = 0.5
    pdf = pd.DataFrame(x, columns=list("abc")).assign(id=np.arange(len(x)))
    near = nearest_neighbours(spark.createDataFrame(pdf), "id", list("abc"), 5, **options)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in near.collect()}
    assert got == brute_neighbours(pdf["id"].to_numpy(), x, 5)


def test_neighbours_of_few_points(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 5.0)], "id long, a double")
    got = sorted(tuple(r) for r in nearest_neighbours(df, "id", ["a"], 5).collect())
    assert got == [(1, 2, 1, 1.0), (1, 3, 2, 5.0), (2, 1, 1, 1.0), (2, 3, 2, 4.0), (3, 1, 2, 5.0), (3, 2, 1, 4.0)]


def recall(near, ids, x, k, some):
    lists = near.groupBy("id").agg(F.collect_list("neighbour").alias("n")).collect()
    found = {r["id"]: set(r["n"]) for r in lists}
    hits = 0
    for i in some:
        far = ((x - x[i]) ** 2).sum(1)
        far[i] = np.inf
        hits += len(found[ids[i]] & set(ids[np.argsort(far, kind="stable")[:k]].tolist()))
    return hits / (k * len(some))


@pytest.mark.parametrize("width", [8, 30])
def test_recall_of_the_forest(spark, width):
    """Independent normal columns, the hardest case: 12,000 points fill about a dozen leaves a tree."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(12_000, width)).round(5)
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x))))
    near = written_once(near_neighbours(df, "id", names, 5), "near")
    assert near.count() == 5 * len(x)
    assert recall(near, np.arange(len(x)), x, 5, rng.choice(len(x), 300, replace=False)) >= 0.9


def test_forest_leaves_are_bounded_and_hold_every_point(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(3000, 3)), np.repeat([[1.0, 2.0, 3.0]], 6, 0), np.tile([0.0, 0.0, 1.0], (40, 1)) * np.arange(40)[:, None]])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    placed = written_once(leaves(df, 3, 64, 2, 7), "leaves")
    assert placed.groupBy("tree", "cell").count().agg(F.max("count")).first()[0] <= 64
    per_tree = placed.groupBy("tree", "id").count()
    assert per_tree.count() == 3 * len(x) and per_tree.agg(F.max("count")).first()[0] <= 4


def test_forest_is_exact_within_one_leaf_and_with_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (300, 2)).astype(float)
    ids = np.array([f"k{i:03}" for i in range(300)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(id=ids))
    got = sorted((r["id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in near_neighbours(df, "id", ["a", "b"], 5).collect())
    exact = sorted((r["id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in nearest_neighbours(df, "id", ["a", "b"], 5).collect())
    assert got == exact
    assert near_neighbours(df.limit(0), "id", ["a", "b"], 5).count() == 0
    with pytest.raises(ValueError, match="too small"):
        near_neighbours(df, "id", ["a", "b"], 5, leaf_rows=10)


def test_crowded_cells_are_cut_before_a_task_takes_them(spark, monkeypatch):
    """Several rounds, text ids with nulls last, and lists that name the ids given."""
    monkeypatch.setattr(forest, "CELL_LEAVES", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3_000, 3)).round(5)
    ids = np.array([f"k{i * 7 % 3000}" for i in range(3_000)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=ids))
    near = written_once(near_neighbours(df, "id", list("abc"), 5, leaf_rows=128), "near")
    assert near.count() == 5 * len(x) and set(near.columns) == {"id", "neighbour", "rank", "distance"}
    assert recall(near, ids, x, 5, range(0, 3_000, 10)) >= 0.9


def test_trees_are_searched_in_turn_and_leave_nothing_but_the_lists(spark, monkeypatch, tmp_path):
    """The lists are those of all trees at once; places and earlier lists are gone."""
    x = np.random.default_rng(4).normal(size=(2_000, 3)).round(5)
    points = written_once(spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"), "points")

    def lists(made):
        return sorted((r["id"], [(p["d2"], p["neighbour"]) for p in r["near"]]) for r in made.collect())

    monkeypatch.setattr(forest, "CELL_LEAVES", 1)
    at_once = forest.candidates(points, 6, range(1, 4), 128, 2, 42)
    want = lists(forest.best_of(reduce(DataFrame.unionByName, at_once), 6))
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    got = forest.nearest_lists(points, 6, 3, 128, 2, 42)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["lists"]
    assert lists(got) == want
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=[f"k{i}" for i in range(len(x))]))
    near = near_neighbours(df, "id", list("abc"), 5, leaf_rows=128)
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"lists", "points", "names", "numbered", "places"}
    assert near.count() == 5 * len(x)


def test_vectors_are_looked_up_for_the_neighbours_that_copies_use(spark, monkeypatch):
    """Fewer copies than neighbours use some of them; the rows made are those of the whole lists."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(90, 2)).round(4), columns=["a", "b"]).assign(id=[f"k{i}" for i in range(90)], y=[int(i < 40) for i in range(90)])
    rows, sent = spark.createDataFrame(pdf), []
    keep = resample.written_alone
    monkeypatch.setattr(resample, "written_alone", lambda *a: sent.append(keep(*a)) or sent[-1])
    made = {(r["id"], r["copy"]): (r["a"], r["b"]) for r in synthetic_rows(rows, "y", "id", ["a", "b"]).collect()}
    assert len(made) == 10 and sent[0].count() == 10
    few = pdf[pdf.y == 1].reset_index(drop=True)
    x = few[["a", "b"]].to_numpy()
    for (key, copy), got in made.items():
        at = int(few.index[few.id == key][0])
        order = np.argsort(((x - x[at]) ** 2).sum(1), kind="stable")[1:]
        hexed = hashlib.md5(f"42|{key}|{copy}".encode()).hexdigest()
        there, u = x[order[int(hexed[:8], 16) % 5]], int(hexed[8:16], 16) / 2**32
        assert np.allclose(got, x[at] + u * (there - x[at]))


def test_neighbour_searches_broadcast_no_table_of_points(spark):
    """An array counts as one number in Spark's estimates, so tables of wide vectors passed for small ones and went to the driver."""
    names = [f"c{i}" for i in range(60)]
    rows = spark.range(60).select("id", (F.col("id") % 3 > 0).cast("int").alias("y"), *[(F.col("id") * (i + 1) % 17).cast("double").alias(c) for i, c in enumerate(names)])
    for made in (near_neighbours(rows, "id", names, 5), nearest_neighbours(rows, "id", names, 5), synthetic_rows(rows, "y", "id", names)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        # Only the few crowded cells may be.
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "tree" not in line]


def test_the_first_of_each_row_are_those_of_a_stable_sort():
    rng = np.random.default_rng(2)
    for width in (3, 6, 40):
        far = rng.integers(0, 5, (30, width)).astype(float)
        far[:4, 1:] = np.nan
        rows, columns = first_of(far, 6)
        want = np.argsort(far, axis=1, kind="stable")[:, :6]
        assert columns.reshape(want.shape).tolist() == want.tolist()
        assert rows.reshape(want.shape).tolist() == [[i] * want.shape[1] for i in range(30)]


def test_a_reach_holds_k_others():
    v = np.random.default_rng(3).normal(size=(700, 2))
    far = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    assert np.allclose(reaches(v, 4), np.sort(far, axis=1)[:, 4])
    assert np.isinf(reaches(v[:4], 4)).all()
