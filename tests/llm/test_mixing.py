import pytest

from quire.llm import mixing

DOCS = "doc_id long, text string, source string, extra int"
TARGETS = "source string, target_share double, max_repeats int"


def make(spark):
    rows = [(i, "x" * 100, "big", 0) for i in range(100)]
    rows += [(1000 + i, "é" * 10, "small", 0) for i in range(10)]
    rows += [(2000, None, "small", 0), (2001, "", "small", 0), (3000, "zzz", None, 0), (3001, "zzz", "other", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.4, 3), ("absent", 0.1, 5)], TARGETS)
    return docs, targets


def test_water_fill_clamps_and_redistributes(spark):
    docs, targets = make(spark)
    plan = {r.source: r for r in mixing.water_fill(mixing.source_sizes(docs, targets)).collect()}
    assert plan["small"].size == 200 and plan["big"].size == 10_000
    assert plan["small"].granted == 600 and plan["small"].clamped_round == 1
    assert plan["absent"].granted == 0 and plan["absent"].clamped_round == 1
    assert plan["big"].granted == pytest.approx(10_200 - 600)
    found = mixing.unreachable(mixing.water_fill(mixing.source_sizes(docs, targets)))
    assert {r.source for r in found.collect()} == {"small", "absent"}


def test_sample_is_seeded_capped_and_near_the_quota(spark):
    docs, targets = make(spark)
    plan = mixing.water_fill(mixing.source_sizes(docs, targets), budget=15_300)
    mix = mixing.sample_mix(docs, plan, seed=3)
    rows = sorted(map(tuple, mix.collect()))
    assert rows == sorted(map(tuple, mixing.sample_mix(docs.repartition(3), plan, seed=3).collect()))
    assert rows != sorted(map(tuple, mixing.sample_mix(docs, plan, seed=4).collect()))
    granted = {r.source: r.granted for r in plan.collect()}
    used = {}
    for _, source, size, copies in rows:
        used[source] = used.get(source, 0) + size * copies
        assert copies <= {"big": 2, "small": 3}[source]
    assert granted["big"] - 100 <= used["big"] <= granted["big"]
    assert used["small"] == granted["small"] == 600
    shares = [r.actual_share for r in mixing.mix_report(plan, mix).collect()]
    assert sum(shares) == pytest.approx(1)


def test_empty_tables(spark):
    docs, targets = make(spark)
    none = mixing.water_fill(mixing.source_sizes(docs, targets.limit(0)))
    assert none.count() == 0 and mixing.sample_mix(docs, none).count() == 0
    plan = mixing.water_fill(mixing.source_sizes(docs.limit(0), targets))
    assert {r.granted for r in plan.collect()} == {0.0}
    assert mixing.mix_report(plan, mixing.sample_mix(docs.limit(0), plan)).count() == 3


def fill(spark, targets, budget=None):
    docs, _ = make(spark)
    sizes = mixing.source_sizes(docs, spark.createDataFrame(targets, TARGETS))
    plan = mixing.water_fill(sizes, budget)
    return docs, plan, {r.source: r for r in plan.collect()}


def test_what_the_shares_leave_is_given_out_when_nobody_is_clamped(spark):
    docs, plan, rows = fill(spark, [("big", 0.48, 2), ("small", 0.02, 3)])
    assert {k: r.clamped_round for k, r in rows.items()} == {"big": None, "small": None}
    assert rows["big"].granted == pytest.approx(0.96 * 10_200)
    assert rows["small"].granted == pytest.approx(0.04 * 10_200)
    # the second round can clamp, too
    docs, plan, rows = fill(spark, [("big", 0.45, 2), ("small", 0.05, 3)])
    assert (rows["small"].granted, rows["small"].clamped_round) == (600, 2)
    assert rows["big"].granted == pytest.approx(9_600)
    assert mixing.unreachable(plan).count() == 0


def test_a_clamp_takes_nothing_from_the_others(spark):
    docs, plan, rows = fill(spark, [("big", 1.5, 2), ("small", 0.5, 1)])
    assert (rows["small"].granted, rows["small"].clamped_round) == (200, 1)
    assert rows["big"].granted == pytest.approx(1.5 * 10_200)


def test_missing_share_or_cap_is_not_made_up(spark):
    docs, plan, rows = fill(spark, [("big", 0.5, 2), ("small", 0.5, None)])
    assert rows["small"].max_repeats is None and rows["small"].clamped_round is None
    assert mixing.unreachable(plan).count() == 0
    docs, plan, rows = fill(spark, [("big", 1.0, 2), ("small", None, 3)])
    assert rows["small"].target_share is None and rows["small"].granted is None
    assert rows["big"].granted == 10_200
    mix = mixing.sample_mix(docs, plan)
    assert {r.source for r in mix.select("source").distinct().collect()} == {"big"}
    assert {r.source: r.used_size for r in mixing.mix_report(plan, mix).collect()} == {"big": 10_200, "small": 0}
