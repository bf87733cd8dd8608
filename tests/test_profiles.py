"""Profiles of loads that merge into that of all rows."""

import datetime as dt
import random

from ticketlake.operators import profiles

SCHEMA = "n int, t string, day date, `a.b` double"


def loads(spark, parts=3, size=1500):
    rng = random.Random(4)

    def row():
        return (rng.choice([None, rng.randrange(400)]), rng.choice([None, "", f"v{rng.randrange(3000)}"]),
                dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(90)), rng.choice([None, rng.random(), float("nan")]))

    rows = [[row() for _ in range(size)] for _ in range(parts)]
    return [spark.createDataFrame(part, SCHEMA).repartition(3) for part in rows], spark.createDataFrame(sum(rows, []), SCHEMA)


def shown(df):
    return {r["column"]: tuple(r)[1:6] for r in df.collect()}


def test_merged_equals_full(spark, tmp_path):
    parts, whole = loads(spark)
    for i, part in enumerate(parts):
        profiles.keep_load(part, str(tmp_path), f"day={i}", ["t", "a.b"])
    profile, values = profiles.kept_profile(spark, str(tmp_path))
    assert shown(profile) == shown(profiles.profile_of(profiles.column_state(whole)))
    assert set(values.collect()) == set(profiles.value_state(whole, ["t", "a.b"]).collect())
    truth = {"n": 400, "t": whole.select("t").dropna().distinct().count(), "day": 90}
    for r in profile.collect():
        if r["column"] in truth:
            assert abs(r.distinct_estimate - truth[r["column"]]) <= 0.04 * truth[r["column"]]


def test_a_repeated_load_counts_once_and_others_stay(spark, tmp_path):
    (a, b, _), _ = loads(spark, size=200)
    for name, part in (("a", a), ("b", b), ("a", a)):
        profiles.keep_load(part, str(tmp_path), name, ["n"])
    profile, values = profiles.kept_profile(spark, str(tmp_path))
    assert shown(profile) == shown(profiles.profile_of(profiles.column_state(a.union(b))))
    assert values.agg({"n": "sum"}).first()[0] == 400


def test_empty_loads(spark, tmp_path):
    (a, *_), _ = loads(spark, size=50)
    nothing = a.limit(0)
    assert shown(profiles.profile_of(profiles.column_state(nothing))) == dict.fromkeys(["n", "t", "day", "a.b"], (0, 0, 0, None, None))
    states = profiles.column_state(nothing).union(profiles.column_state(a))
    assert shown(profiles.profile_of(profiles.merged_state(states))) == shown(profiles.profile_of(profiles.column_state(a)))
    assert shown(profiles.profile_of(profiles.merged_state(states.limit(0))))["n"] == (0, 0, 0, None, None)
    assert profiles.value_state(nothing, ["t"]).count() == 0


def test_the_profile_of_all_loads_reads_no_rows_again(spark, tmp_path):
    (a, *_), _ = loads(spark, size=50)
    profiles.keep_load(a, str(tmp_path), "a", ["t"])
    profile, values = profiles.kept_profile(spark, str(tmp_path))
    for df, kind in ((profile, "columns"), (values, "values")):
        assert all(f"/{kind}/" in path for path in df.inputFiles())
