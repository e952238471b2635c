"""Contact rate limits against a plain loop over each client's contacts."""

import datetime
import random

from ledgerline.operators import contacts

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1)


def plain(rows, days):
    want, last = {}, {}
    for key, client, at in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[2], r[0])):
        if client not in last or at - last[client] >= days * DAY:
            last[client] = at
            want[key] = True
        else:
            want[key] = False
    return {key: want.get(key) for key, _, _ in rows}


def limited(spark, rows, days=90):
    df = spark.createDataFrame(rows, "allowed_key int, client string, at timestamp")
    return {r["allowed_key"]: r["allowed"] for r in contacts.rate_limit(df, "client", "at", "allowed_key", days).collect()}


def test_random_contacts(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", "d", None]), START + rng.randrange(0, 1500) * DAY) for i in range(400)]
    rows += [(900, "a", None), (901, "lone", START), (902, None, None)]
    rng.shuffle(rows)
    got = limited(spark, rows)
    assert got == plain(rows, 90)
    assert got[900] is None and got[901] is True and got[902] is None


def test_chains_of_short_gaps(spark):
    """A contact every 50 days: each third day counts from the one kept, not from the one before."""
    rows = [(i, "a", START + i * 50 * DAY) for i in range(200)] + [(300 + i, "b", START + i * DAY) for i in range(400)]
    got = limited(spark, rows)
    assert got == plain(rows, 90)
    assert [i for i in range(8) if got[i]] == [0, 2, 4, 6] and sum(got[300 + i] for i in range(400)) == 5


def test_exact_gaps_ties_and_times_of_day(spark):
    second = datetime.timedelta(seconds=1)
    rows = [(1, "a", START), (0, "a", START), (2, "a", START + 90 * DAY - second), (3, "a", START + 90 * DAY),
            (4, "a", START + 180 * DAY), (5, "a", START + 180 * DAY), (6, "a", START + 800 * DAY), (7, "a", START - 1 * DAY)]
    got = limited(spark, rows)
    assert got == plain(rows, 90)


def test_gaps_longer_than_slices_and_short_limits(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), START + rng.choice([0, 1, 2, 500, 501, 503, 2000]) * DAY + rng.randrange(3) * DAY) for i in range(60)]
    for days in (1, 2, 7, 400):
        assert limited(spark, rows, days) == plain(rows, days)


def test_dates_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 5, START.date()), (2, 5, START.date()), (1, 5, START.date())], "k int, client int, day date")
    got = contacts.rate_limit(df, "client", "day", "k")
    assert got.columns == ["k", "client", "day", "allowed"]
    assert sorted((r["k"], r["allowed"]) for r in got.collect()) == [(1, True), (1, True), (2, False)]
    assert contacts.rate_limit(df.limit(0), "client", "day", "k").count() == 0


def test_rounds_follow_the_logarithm_of_the_chain(spark, monkeypatch):
    made = []
    keep = contacts.fresh_dir
    monkeypatch.setattr(contacts, "fresh_dir", lambda s, purpose: made.append(purpose) or keep(s, purpose))
    rows = [(i, "a", START + i * DAY) for i in range(120)]
    got = limited(spark, rows, 2)
    assert got == plain(rows, 2) and sum(got.values()) == 60
    assert made.count("ahead") == 7  # 60 links: six rounds and one that finds no more


def test_a_hot_client_shrinks_to_its_moments(spark):
    rows = [(i, "hot", START + (i % 50) * DAY) for i in range(5000)]
    got = limited(spark, rows, 10)
    assert [k for k in sorted(got) if got[k]] == [0, 10, 20, 30, 40]
