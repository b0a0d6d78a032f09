"""Semi-additive measures over every calendar day, empty days carrying the last value."""

from decimal import Decimal

from starflow.operators.summaries import carried_daily


def test_empty_days_carry_the_last_total(spark):
    rows = [
        ("a", 10, "2026-01-01"),  # before the period: carried in
        ("a", 4, "2026-01-03"),
        ("a", 2, "2026-01-03"),  # same day: summed to 6
        ("b", 7, "2026-01-04"),  # starts inside: earlier days have no value
        ("c", 1, "2026-01-09"),  # after the period only: no row
    ]
    df = spark.createDataFrame(rows, "k string, n int, d string")
    got = {r.k: (r.n_mean, r.n_at_end) for r in carried_daily(df, ["k"], "n", "d", "2026-01-02", "2026-01-05").collect()}
    # a: 10, 6, 6, 6 -> 7.00; b: 7, 7 -> 7.00
    assert got == {"a": (Decimal("7.00"), 6), "b": (Decimal("7.00"), 7)}
    assert carried_daily(df.limit(0), ["k"], "n", "d", "2026-01-02", "2026-01-05").collect() == []


def test_the_calendar_is_not_spread_over_rows(spark):
    """Days are laid out inside a key's row: no generator and no window over keys x days."""
    df = spark.createDataFrame([("a", 1, "2026-01-01"), ("a", None, "2026-01-03")], "k string, n int, d string")
    carried = carried_daily(df, ["k"], "n", "d", "2026-01-01", "2026-01-04")
    plan = carried._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    assert [(r.n_mean, r.n_at_end) for r in carried.collect()] == [(Decimal("1.00"), 1)]
