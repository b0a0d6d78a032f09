import random
from datetime import datetime
from decimal import Decimal
from functools import partial

import pytest

from starflow.operators.checks import scd2_intervals
from starflow.operators.dimensions import (
    OPEN_END,
    DuplicateKeyError,
    MissingKeyError,
    scd1_load,
    scd2_as_of,
    scd2_carry,
    scd2_changed,
    scd2_current,
    scd2_merge,
    scd2_new,
    unkeyed_rows,
)
from starflow.sources.storage import publish, read_partition, read_previous
from starflow.specs import DimSpec

SPEC = DimSpec(
    name="thing",
    source="things",
    key="id",
    attributes=("label", "price", "city", "born"),
    tracked=("price", "city"),
    fixed=("born",),
)
SCHEMA = "id bigint, label string, price decimal(16,2), city string, born string"
DAYS = [f"2026-01-0{d}" for d in range(1, 8)]
COLUMNS = ["thing_sk", "id", "label", "price", "city", "born"]
COLUMNS += ["begin_date", "end_date", "is_active"]


def snapshot(spark, *rows):
    """Rows of (id, label, price, city[, born])."""
    full = [(i, a, p if p is None else Decimal(p), *rest) for i, a, p, *rest in rows]
    return spark.createDataFrame([(*r, None)[:5] for r in full], SCHEMA)


def load_days(spark, tmp_path, *snapshots, **options):
    root = str(tmp_path / "dim_thing")
    for day, rows in zip(DAYS, snapshots):
        src = snapshot(spark, *rows)
        prev = read_previous(spark, root, day)
        publish(scd2_merge(prev, src, SPEC, day, **options), root, day)
    return read_partition(spark, root, DAYS[len(snapshots) - 1])


def versions(df):
    return sorted(
        (r.id, r.begin_date, r.end_date, r.is_active, r.label, r.price, r.city)
        for r in df.collect()
    )


def test_scd1_numbers_by_key(spark):
    dim = scd1_load(snapshot(spark, (7, "b", 1, "x"), (3, "a", 2, "y")), SPEC, DAYS[0])
    assert [(r.thing_sk, r.id, r.pt) for r in dim.orderBy("id").collect()] == [
        (1, 3, DAYS[0]),
        (2, 7, DAYS[0]),
    ]


def test_second_change_keeps_all_versions(spark, tmp_path):
    dim = load_days(
        spark, tmp_path, [(1, "a", 1, "x")], [(1, "a", 2, "x")], [(1, "a", 3, "x")]
    )
    got = [(r.thing_sk, r.begin_date, r.end_date, r.is_active) for r in dim.collect()]
    assert sorted(got) == [
        (1, DAYS[0], DAYS[1], 0),
        (2, DAYS[1], DAYS[2], 0),
        (3, DAYS[2], OPEN_END, 1),
    ]


def test_unchanged_key_never_doubles(spark, tmp_path):
    dim = load_days(spark, tmp_path, *[[(1, "a", 1, "x")]] * 4)
    assert dim.count() == 1


def test_rerun_gives_the_same_partition(spark, tmp_path):
    at = datetime(2026, 1, 2, 3, 4, 5)
    root = str(tmp_path / "dim_thing")
    first = scd2_merge(None, snapshot(spark, (1, "a", 1, "x")), SPEC, DAYS[0], at=at)
    publish(first, root, DAYS[0])
    results = []
    for _ in range(2):
        src = snapshot(spark, (1, "a", 2, "x"), (2, "b", 1, "y"))
        prev = read_previous(spark, root, DAYS[1])
        publish(scd2_merge(prev, src, SPEC, DAYS[1], at=at), root, DAYS[1])
        results.append(sorted(read_partition(spark, root, DAYS[1]).collect()))
    assert results[0] == results[1]
    assert len(results[0]) == 3


def test_null_rules(spark, tmp_path):
    dim = load_days(
        spark,
        tmp_path,
        [(1, "a", None, "x"), (2, "a", 5, "x"), (3, "a", 1, None), (4, "a", 1, "q")],
        [(1, "a", 4, "x"), (2, "a", None, "x"), (3, "a", 1, ""), (4, "a", 1, None)],
    )
    changed = {r.id for r in dim.where("is_active = 0").collect()}
    assert changed == {1, 2, 4}


def test_missing_key_stays_active(spark, tmp_path):
    dim = load_days(spark, tmp_path, [(1, "a", 1, "x"), (2, "b", 1, "x")], [(1, "a", 1, "x")])
    assert {(r.id, r.is_active) for r in dim.collect()} == {(1, 1), (2, 1)}


def test_empty_snapshot_carries_everything(spark, tmp_path):
    dim = load_days(spark, tmp_path, [(1, "a", 1, "x")], [(1, "a", 2, "x")], [])
    assert dim.count() == 2


def test_untracked_attribute_refreshes_the_active_version_only(spark, tmp_path):
    days = [[(1, "a", 1, "x", "b1")], [(1, "b", 2, "x", "b1")], [(1, "c", 2, "x", "b2")]]
    dim = load_days(spark, tmp_path / "on", *days)
    got = {(r.is_active, r.label, r.born) for r in dim.collect()}
    assert got == {(0, "a", "b1"), (1, "c", "b1")}
    kept = load_days(spark, tmp_path / "off", *days, overwrite_scd1=False)
    assert {(r.is_active, r.label) for r in kept.collect()} == {(0, "a"), (1, "b")}


def test_update_time_moves_only_with_the_row(spark, tmp_path):
    t1, t2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    root = str(tmp_path / "dim_thing")
    rows = [(1, "a", 1, "x"), (2, "a", 1, "x"), (3, "a", 1, "x")]
    publish(scd2_merge(None, snapshot(spark, *rows), SPEC, DAYS[0], at=t1), root, DAYS[0])
    src = snapshot(spark, (1, "a", 1, "x"), (2, "z", 1, "x"), (3, "a", 9, "x"))
    prev = read_previous(spark, root, DAYS[1])
    dim = scd2_merge(prev, src, SPEC, DAYS[1], at=t2).collect()
    times = {(r.id, r.is_active): (r.etl_insert_time, r.etl_update_time) for r in dim}
    assert times == {
        (1, 1): (t1, t1),
        (2, 1): (t1, t2),
        (3, 0): (t1, t2),
        (3, 1): (t2, t2),
    }


def test_rows_without_key_are_refused_or_left_out_by_choice(spark):
    src = snapshot(spark, (None, "a", 1, "x"), (1, "b", 1, "x"))
    for load in (scd1_load, partial(scd2_merge, None)):
        with pytest.raises(MissingKeyError, match="1 rows have no id"):
            load(src, SPEC, DAYS[0])
        assert load(src, SPEC, DAYS[0], leave_out_unkeyed=True).count() == 1
    assert [r.label for r in unkeyed_rows(src, SPEC).collect()] == ["a"]


def test_repeated_key_is_refused(spark):
    src = snapshot(spark, (1, "a", 1, "x"), (1, "b", 2, "x"), (2, "b", 2, "x"))
    for load in (scd1_load, partial(scd2_merge, None)):
        with pytest.raises(DuplicateKeyError, match="id 1 has 2 rows"):
            load(src, SPEC, DAYS[0])


def test_parts_add_up_to_the_merge(spark, tmp_path):
    root = str(tmp_path / "dim_thing")
    first = [(1, "a", 1, "x"), (2, "b", 1, "x"), (3, "c", 1, "x")]
    publish(scd2_merge(None, snapshot(spark, *first), SPEC, DAYS[0]), root, DAYS[0])
    prev = read_previous(spark, root, DAYS[1])
    src = snapshot(spark, (1, "n", 1, "x"), (2, "b", 2, "x"), (4, "d", 1, "x"))
    closed = scd2_changed(prev, src, SPEC, DAYS[1])
    opened = scd2_new(prev, src, SPEC, DAYS[1])
    carried = scd2_carry(prev, closed, SPEC, DAYS[1])
    merged = scd2_merge(prev, src, SPEC, DAYS[1], overwrite_scd1=False)
    parts = closed.unionByName(opened).unionByName(carried)
    assert sorted(parts.select(COLUMNS).collect()) == sorted(
        merged.select(COLUMNS).collect()
    )
    assert (closed.count(), opened.count(), carried.count()) == (1, 2, 2)


def test_slices(spark, tmp_path):
    dim = load_days(spark, tmp_path, [(1, "a", 1, "x")], [(1, "a", 2, "x")])
    assert [r.price for r in scd2_current(dim, DAYS[1]).collect()] == [2]
    assert [r.price for r in scd2_as_of(dim, DAYS[0]).collect()] == [1]
    assert [r.price for r in scd2_as_of(dim, DAYS[1]).collect()] == [2]


def model(days):
    """Plain-Python history: (id, begin, end, active, label, price, city)."""
    rows = []
    for day, snap in zip(DAYS, days):
        for key, (label, price, city) in sorted(snap.items()):
            active = next((r for r in rows if r[0] == key and r[3] == 1), None)
            if active and (active[5], active[6] or "") == (price, city or ""):
                active[4] = label
                continue
            if active:
                active[2], active[3] = day, 0
            rows.append([key, day, OPEN_END, 1, label, price, city])
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_histories_follow_the_model(spark, tmp_path, seed):
    rnd = random.Random(seed)
    days = [
        {
            key: (rnd.choice("ab"), rnd.choice([1, 2]), rnd.choice(["x", "y", "z"]))
            for key in range(30)
            if rnd.random() < 0.8
        }
        for _ in range(4)
    ]
    dim = load_days(
        spark, tmp_path, *[[(k, *v) for k, v in sorted(d.items())] for d in days]
    ).cache()
    assert versions(dim) == model(days)
    sks = [r.thing_sk for r in dim.collect()]
    assert sorted(sks) == list(range(1, len(sks) + 1))
    broken = scd2_intervals(dim, "id", "dim_thing").first()
    assert (broken.keys_not_one_active, broken.overlaps, broken.gaps) == (0, 0, 0)
    assert (broken.open_mismatches, broken.empty_intervals) == (0, 0)
