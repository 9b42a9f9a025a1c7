"""Values that are counted by their types give what their texts give."""

import datetime as dt
import random

from pyspark.sql import functions as F

from keyscout.operators import fk, keys, profile


def test_integers_are_shuffled_as_words(spark):
    hist = profile._measured_histogram({("s", "t"): spark.range(200_000)})
    assert hist.count() < 8_000  # one row for each value before
    assert hist.agg(F.sum("n"), F.sum("values")).first()[:] == (200_000, 200_000)


def test_profiles_of_types_and_of_texts_agree(spark):
    rng = random.Random(3)
    near = [s * (10**k + d) for k in range(1, 18) for d in (-65, -64, -1, 0, 1, 63) for s in (1, -1)]
    days = [20240101 + d for d in range(400)] + [20240229, 20230229, 99991231, 10000101]
    ints = [*near, *days, *range(-130, 130), 20240101120000, 20241301120000, 2**63 - 1, -(2**63), None, None]
    ints += rng.choices(ints, k=200)
    doubles = [0.0, -0.0, float("nan"), float("inf"), -1.5, 1e10, 1e-7, None, 2.0]
    wall = dt.datetime(2024, 10, 27, 0, 30, tzinfo=dt.timezone.utc)
    stamps = [wall, wall + dt.timedelta(hours=1), wall + dt.timedelta(microseconds=5), None]
    day = dt.date(2024, 1, 1)
    rows = [(v, doubles[i % 9], stamps[i % 4], day + dt.timedelta(i % 40)) for i, v in enumerate(ints)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # two of the stamps have one text here
    try:
        typed = spark.createDataFrame(rows, "a long, b double, c timestamp, d date")
        texts = typed.select([F.col(c).cast("string").alias(c) for c in typed.columns])
        got, want = (
            [tuple(repr(v) for v in r) for r in profile.profile_table(df, "s", "t").orderBy("col_num").collect()] for df in (typed, texts)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == want


def test_inclusion_of_integers_and_of_texts_agree(spark):
    sides = {("s", "p"): [*range(-100, 300), None], ("s", "c"): [*range(250, 320), -3, -3, None, 10**12], ("s", "e"): [None, None]}
    typed = {k: spark.createDataFrame([(v,) for v in vs], "x long") for k, vs in sides.items()}
    texts = {k: df.select(F.col("x").cast("string").alias("x")) for k, df in typed.items()}
    mixed = typed | {("s", "c"): texts["s", "c"]}
    pairs = [(*a, "x", *b, "x") for a in sides for b in sides]
    rows = [sorted(tuple(r) for r in fk.inclusion_unary(t, pairs).collect()) for t in (typed, texts, mixed)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 9


def test_joint_keys_are_counted_without_texts(spark):
    rows = [(1, 0.0, 7), (1, -0.0, 7), (1, 0.0, 7), (2, None, 7), (None, 1.0, 7)]
    tables = {("s", "t"): spark.createDataFrame(rows, "a long, b double, c int")}
    got = {tuple(r["key"]): (r["records"], r["tuples"]) for r in keys.count_key_tuples(tables, {("s", "t"): [["a", "b"], ["a", "c"]]}).collect()}
    assert got == {("a", "b"): (5, 2), ("a", "c"): (5, 2)}
    counted = keys.count_key_tuples(tables, {("s", "t"): [["a", "c"]]})
    assert "as string" not in counted._jdf.queryExecution().optimizedPlan().toString()  # a text per value before
