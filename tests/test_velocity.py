import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from riskloom.operators import velocity
from riskloom.operators.velocity_state import VelocityState

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)
KIND = "key int, who string, at timestamp, amount double"


def run(spark, rows, windows=(1, 7, 30), **options):
    df = spark.createDataFrame(rows, KIND)
    out = velocity.add_velocity(df, ["who"], "at", "amount", windows, **options)
    names = velocity.feature_names("who", windows)
    return {r["key"]: tuple(r[n] for n in names) for r in out.collect()}


def brute_force(rows, windows):
    want = {}
    for key, who, at, _ in rows:
        values = []
        for w in windows:
            seen = [
                a or 0.0 for _, i, t, a in rows
                if who is not None and at is not None and i == who and t is not None and at - w * DAY <= t < at
            ]
            values += [len(seen), sum(seen), sum(seen) / len(seen) if seen else 0.0]
        want[key] = values
    return want


@pytest.mark.parametrize("frame_rows", [1000, 0])
def test_known_answers(spark, frame_rows):
    days = [0, 1, 1, 2, 8, 9]
    rows = [(i, "a", START + d * DAY, float(2**i)) for i, d in enumerate(days)] + [(9, "b", START, 5.0)]
    got = run(spark, rows, [7], frame_rows=frame_rows)
    assert [got[i][:2] for i in range(6)] == [(0, 0), (1, 1), (1, 1), (3, 7), (3, 14), (2, 24)]
    assert got[9] == (0, 0.0, 0.0)


@pytest.mark.parametrize("frame_rows,scale", [(10**6, None), (0, None), (0, 2), (10**6, 2)])
def test_busy_ids_ties_and_missing_values(spark, frame_rows, scale):
    rng = random.Random(3)
    rows = []
    for key in range(400):
        who = rng.choice(["hot", "hot", "hot", "cold", f"id{key % 40}", None])
        at = START + timedelta(seconds=rng.choice([0, 3600, 86400, rng.randrange(60 * 86400)]))
        rows.append((key, who, at if key % 37 else None, round(rng.uniform(-5, 90), 2) if key % 29 else None))
    windows = (1, 2, 7, 30)
    got, want = run(spark, rows, windows, frame_rows=frame_rows, money_scale=scale), brute_force(rows, windows)
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-9), key


def test_history_counts_but_does_not_come_out(spark):
    old = spark.createDataFrame([(0, "a", START, 3.0)], KIND)
    new = spark.createDataFrame([(1, "a", START + DAY, 4.0), (2, "a", START + 2 * DAY, 5.0)], KIND)
    out = velocity.add_velocity(new, ["who"], "at", "amount", [7], history=old)
    assert sorted((r["key"], r["who_transactions_last_7d"], r["who_total_amount_last_7d"]) for r in out.collect()) == [
        (1, 1, 3.0), (2, 2, 7.0)
    ]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, "a", START, 1.0)], KIND)
    assert velocity.add_velocity(df, ["who"], "absent", "amount").columns == df.columns
    no_ids = velocity.add_velocity(df, ["x", "y"], "at", "amount", [1])
    assert no_ids.columns == [*df.columns, *velocity.feature_names("x", [1]), *velocity.feature_names("y", [1])]
    assert no_ids.first()[4:] == (0, 0.0, 0.0, 0, 0.0, 0.0)
    some = velocity.add_velocity(df, ["who", "x"], "at", "amount", [1])
    assert some.columns == [*df.columns, *velocity.feature_names("who", [1])]
    no_amount = velocity.add_velocity(df.drop("amount"), ["who"], "at", "amount", [1])
    assert no_amount.first()["amount"] == 0.0
    empty = velocity.add_velocity(df.where("false"), ["who"], "at", "amount")
    assert empty.count() == 0 and len(empty.columns) == 4 + 9


def test_chunks_keep_windows_apart(spark):
    """A busy id is partitioned by time as well, so no task sorts all of its rows."""
    rows = [(i, "hot", START + timedelta(hours=i), 1.0) for i in range(50)]
    out = velocity.add_velocity(spark.createDataFrame(rows, KIND), ["who"], "at", "amount", [1], frame_rows=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__id" in plan and "chunk" in plan
    assert {r["who_transactions_last_1d"] for r in out.where("key >= 24").select(F.col("who_transactions_last_1d")).collect()} == {24}


def test_state_gives_the_frames_of_the_union(spark, tmp_path):
    rng = random.Random(3)
    minutes = [rng.choice([0, 1, 59, 60, 61, 1440, 1441, 10_080, 43_200, rng.randrange(60_000)]) + rng.choice([0, 0, 1440]) for _ in range(160)]
    rows = sorted(((i, rng.choice(["a", "b", None]), START + timedelta(minutes=m), float(rng.randrange(-50, 50))) for i, m in enumerate(minutes)), key=lambda r: r[2])
    cuts = [0, 40, 41, 110, 160]
    # Rows of one instant stay in one batch.
    cuts = [next((k for k in range(c, 161) if k in (0, 160) or rows[k][2] != rows[k - 1][2]), 160) for c in cuts]
    state = VelocityState(spark, str(tmp_path), ["who"], "at", "amount")
    names, got = velocity.feature_names("who"), {}
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        batch = spark.createDataFrame(rows[low:high], KIND)
        before = state.measured(batch, f"b{number}").collect()
        assert state.apply(batch, f"b{number}") is True and state.apply(batch, f"b{number}") is False
        again = state.measured(batch, f"b{number}").collect()
        assert sorted(before) == sorted(again)
        got |= {r["key"]: [r[n] for n in names] for r in again}
        if number == 2:
            state.compact()
            with pytest.raises(ValueError, match="merged"):
                state.measured(batch, "b0")
    want = brute_force(rows, velocity.WINDOW_DAYS)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert len(state.manifest().batches) == 4 and len(state.manifest().tables) == 2


def test_state_takes_each_batch_once_from_many_drivers(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a", START, 1.0), (2, "a", START + DAY, 2.0)], KIND)
    with ThreadPoolExecutor(4) as pool:
        took = list(pool.map(lambda k: VelocityState(spark, str(tmp_path), ["who"], "at", "amount").apply(batch, f"b{k % 2}"), range(4)))
    state = VelocityState(spark, str(tmp_path), ["who"], "at", "amount")
    assert sorted(took) == [False, False, True, True] and sorted(state.manifest().batches) == ["b0", "b1"]
    late = spark.createDataFrame([(3, "a", START + 2 * DAY, 0.0), (4, None, None, None)], KIND)
    rows = {r["key"]: r for r in state.measured(late).collect()}
    assert rows[3]["who_transactions_last_7d"] == 4 and rows[3]["who_total_amount_last_1d"] == 4.0 and rows[4]["who_transactions_last_30d"] == 0
    with pytest.raises(ValueError, match="kept in"):
        VelocityState(spark, str(tmp_path), ["who"], "at", "amount", money_scale=2)
    state.compact(from_day=10**6)
    assert state.measured(late).where("who_transactions_last_30d > 0").count() == 0
    assert state.measured(late.limit(0)).count() == 0


def test_measures_are_joined_without_a_broadcast(spark):
    rows = [(i, f"w{i % 5}", START + i * DAY, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, KIND).withColumn("place", F.concat(F.lit("p"), F.col("key") % 3))
    for ids in (["who"], ["who", "place"]):
        out = velocity.add_velocity(df, ids, "at", "amount")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
