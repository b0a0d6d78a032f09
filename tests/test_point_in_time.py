"""Point-in-time lookups: each row against the version valid on its own day."""

import datetime
import random

from starflow.operators.facts import as_of_lookup


def day(n):
    return (datetime.date(2026, 1, 1) + datetime.timedelta(days=n)).isoformat()


def test_rows_meet_the_version_of_their_day_with_a_hot_key(spark):
    rng = random.Random(2)
    versions, sk = [], 0
    for key in range(20):
        start = rng.randint(0, 5)
        while start < 200:
            stop = start + rng.randint(1, 40)
            sk += 1
            versions.append((key, sk, day(start), day(stop) if stop < 200 else "9999-12-31"))
            start = stop + rng.choice([0, 0, 3])  # some gaps
    rows = [(i, 0 if i % 3 == 0 else rng.randint(0, 24), day(rng.randint(0, 210))) for i in range(3000)]
    rows += [(9000, None, day(5)), (9001, 1, None)]
    dim = spark.createDataFrame(versions, "k long, sk long, begin_date string, end_date string")
    facts = spark.createDataFrame(rows, "id long, key long, event_day string")
    got = {r.id: r.sk for r in as_of_lookup(facts, dim, "key", "event_day", "k", "sk", hot_share=0.2, salts=4).collect()}
    want = {}
    for i, key, d in rows:
        hits = [s for k, s, b, e in versions if k == key and d is not None and b <= d < e]
        want[i] = hits[0] if hits else None
    assert got == want and len(got) == len(rows)
    assert sum(1 for i, k, _ in rows if k == 0 and got[i] is not None) > 900


def test_no_rows_and_no_versions(spark):
    dim = spark.createDataFrame([], "k long, sk long, begin_date string, end_date string")
    facts = spark.createDataFrame([(1, 1, day(1))], "id long, key long, event_day string")
    assert [tuple(r) for r in as_of_lookup(facts, dim, "key", "event_day", "k", "sk").collect()] == [(1, 1, day(1), None)]
    assert as_of_lookup(facts.limit(0), dim, "key", "event_day", "k", "sk").collect() == []
