import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keyscout.operators import histogram, profile


def one(spark, values, column="v", **options):
    df = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return profile.profile_table(df, "s", "t", **options).collect()[0].asDict()


def test_length_moments_match_pandas(spark):
    values = ["a", "bb", "ccc", "d" * 9]
    got = one(spark, [*values, "x" * 4])
    want = pd.Series([1, 2, 3, 9, 4])
    assert got["avg_len"] == pytest.approx(want.mean())
    assert got["median_len"] == want.median()
    assert got["var_len"] == pytest.approx(want.var())
    assert got["skew_len"] == pytest.approx(want.skew())
    assert got["kurt_len"] == pytest.approx(want.kurt())


def test_constant_lengths_have_no_skew(spark):
    got = one(spark, ["ab", "cd", "ef", "gh", "ij"])
    assert (got["var_len"], got["skew_len"], got["kurt_len"]) == (0.0, 0.0, 0.0)


def test_all_blank_column(spark):
    got = one(spark, [None, "", " ", None, "   "])
    assert got["data_type"] == "UNK" and got["col_type"] == "VARCHAR" and got["tech_cate"] == "UNK"
    assert got["nullable"] and not got["default_value"] and not got["fixed_length"]
    assert (got["records"], got["distinct"], got["max_len"], got["data_type_rate"]) == (5, 1, 0, 0.0)


def test_small_tables_are_skipped(spark):
    df = spark.createDataFrame([("a",)] * 4, "v string")
    assert profile.profile_table(df, "s", "t").count() == 0


def test_blank_counts_as_one_distinct_value(spark):
    got = one(spark, ["a", "a ", None, "", "b"])
    assert got["distinct"] == 3 and got["nullable"]


def many(spark, cases):
    """Profiles of one-column tables, all in one job: ``{case: (values, column)}``."""
    tables = {
        ("s", name): spark.createDataFrame([(v,) for v in values], f"{column} string")
        for name, (values, column) in cases.items()
    }
    return {r["table_code"]: r.asDict() for r in profile.profile_tables(tables).collect()}


TYPES = [
    (["2020-01-01"] * 9 + ["x"], "DATE", 0.9, "DATE"),
    (["2020-01-01"] * 8 + ["x", "y"], "VARCHAR", 0.8, "UNK"),
    (["20200101"] * 6, "DATE", 1.0, "DATE"),
    (["1", "2", "3", "4", "5.5"], "VARCHAR", 0.8, "UNK"),
    (["1234567890123", "2234567890123", "3", "4", "5"], "VARCHAR", 1.0, "UNK"),
    (["0.5", "0.25", ".1", "0.9", "0.0"], "DECIMAL", 1.0, "RATE"),
    (["1.0", "2.0", "30.0", "4.00", "5."], "DECIMAL", 1.0, "NUM"),
    (["1.5", "1,234.50", "3.0", "4.0", "5.0"], "DECIMAL", 1.0, "AMOUNT"),
    (["ab", "cd", "ef", "gh", "ij"], "CHAR", 1.0, "UNK"),
    (["中a", "b", "c", "d", "e"], "VARCHAR", 1.0, "UNK"),
    # On equal votes the integer class wins, and then has too few matches.
    (["1", "2", "3", "a", "b", "cc"], "VARCHAR", 0.5, "UNK"),
]


def test_inferred_types(spark):
    got = many(spark, {f"t{i}": (case[0], "v") for i, case in enumerate(TYPES)})
    for i, (values, data_type, rate, category) in enumerate(TYPES):
        r = got[f"t{i}"]
        assert (r["data_type"], r["tech_cate"]) == (data_type, category), values
        assert r["data_type_rate"] == pytest.approx(rate), values


CODES = [
    (21, 4, "v", "CODE"), (21, 5, "v", "UNK"), (20, 4, "v", "UNK"), (101, 9, "v", "CODE"), (101, 10, "v", "UNK"),
    (1001, 19, "v", "CODE"), (1001, 20, "v", "UNK"), (101, 4, "open_flag", "UNK"), (101, 4, "FLAG", "CODE"),
]


def test_code_rule(spark):
    got = many(
        spark,
        {f"t{i}": ([chr(97 + j % distinct) for j in range(n)], column) for i, (n, distinct, column, _) in enumerate(CODES)},
    )
    assert [got[f"t{i}"]["tech_cate"] for i in range(len(CODES))] == [c[-1] for c in CODES]


def test_long_values_are_profiled_whole(spark):
    text = "x" * 5000
    got = many(
        spark,
        {
            "text": ([text + "a", text + "b", text + "a", "short", "9" * 70], "v"),
            "ints": (["9" * 70, "8" * 70, "7" * 71, "6" * 70, "5" * 70], "v"),
            "floats": (["1" * 70 + ".5", "0.0", "2.0", "3.0", "4.0"], "v"),
            "chinese": (["中" * 80] * 5, "v"),
        },
    )
    assert (got["text"]["distinct"], got["text"]["max_len"]) == (4, 5001)
    assert (got["ints"]["data_type"], got["ints"]["data_type_rate"]) == ("VARCHAR", 1.0)
    assert (got["floats"]["data_type"], got["floats"]["tech_cate"]) == ("DECIMAL", "NUM")
    assert got["chinese"]["has_chinese"]


def test_sequence_matches_the_sorted_form(spark):
    rng = random.Random(3)
    for trial in range(5):
        base = rng.choice([0, -70, 10**12, 63])
        values = [base + rng.randrange(1 + 70 * (trial + 1)) for _ in range(120)]
        df = spark.createDataFrame([(str(v),) for v in values], "v string")
        got = profile.autoincrement(df, "v").collect()[0]
        ordered = sorted(values)
        steps = sum(b - a == 1 for a, b in zip(ordered, ordered[1:]))
        assert (got["int_rows"], got["steps"]) == (120, steps)


def test_autoincrement_flag(spark):
    got = many(
        spark,
        {
            "dense": ([str(i) for i in range(1, 101)], "v"),
            "even": ([str(2 * i) for i in range(1, 101)], "v"),
            "twice": ([str(i) for i in range(1, 51)] * 2, "v"),
        },
    )
    assert {k: r["autoincrement"] for k, r in got.items()} == {"dense": True, "even": False, "twice": False}


def test_profile_with_a_hot_value(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v")
    )
    got = profile.profile_table(df, "s", "t").collect()[0]
    assert (got["records"], got["distinct"]) == (30_000, 20_001)


def test_profile_of_many_tables_and_effective_type(spark):
    a = spark.createDataFrame([(str(i), "x", b"z") for i in range(6)], "k string, c string, raw binary")
    b = spark.createDataFrame([(i, None) for i in range(3)], "k int, c string")
    got = profile.profile_tables({("s", "a"): a, ("s", "b"): b})
    assert [(r["table_code"], r["col_num"], r["col_code"]) for r in got.orderBy("col_num").collect()] == [
        ("a", 1, "k"), ("a", 2, "c"),
    ]
    mixed = spark.createDataFrame([("2020-01-01",)] * 19 + [("x",)], "d string")
    typed = profile.effective_type(profile.profile_table(mixed, "s", "t")).collect()[0]
    assert (typed["col_type"], typed["effective_type"]) == ("DATE", "VARCHAR")


def test_encoded_flags(spark):
    df = spark.createDataFrame([("中", str(i)) for i in range(1, 6)] + [(None, "6")], "a string, b string")
    got = profile.encoded_flags(profile.profile_table(df, "s", "t")).orderBy("col_num").collect()
    flags = [(r["nullable"], r["has_chinese"], r["default_value"], r["autoincrement"], r["col_length"]) for r in got]
    assert flags == [("1", "1", "1", "0", 1), ("0", "0", "0", "1", 1)]


def test_column_comparison(spark, rows):
    df = spark.createDataFrame(
        [("a", "a ", "a", "b"), ("b", "b", None, "b"), (None, "c", "c", "b")], "w string, x string, y string, z string"
    )
    pairs = [("w", "x"), ("w", "y"), ("x", "y"), ("w", "z")]
    assert rows(histogram.columns_same(df, pairs)) == [
        ("w", "x", True), ("w", "y", False), ("w", "z", False), ("x", "y", True),
    ]
    assert rows(histogram.columns_equal(df, pairs)) == [
        ("w", "x", False), ("w", "y", False), ("w", "z", False), ("x", "y", False),
    ]


def test_cooccurrence_counts_values_per_key_set(spark, rows):
    keyed = spark.createDataFrame(
        [("p", "1"), ("q", "1"), ("p", "2"), ("q", "2"), ("q", "2"), ("r", "2"), ("p", "3")], "key_word string, pk_value string"
    )
    assert rows(histogram.key_cooccurrence(keyed)) == [("p,q", 1), ("p,q,r", 1)]


def test_rates_and_amounts_count_every_number(spark):
    assert one(spark, ["0.5"] * 95 + ["250"] * 5)["tech_cate"] == "AMOUNT"
    assert one(spark, ["0.5"] * 95 + ["nan", "inf", "x", "", "-3"])["tech_cate"] == "RATE"
    assert one(spark, ["5.0"] * 95 + ["250"] * 5)["tech_cate"] == "NUM"


def test_code_values_read_only_code_fields(spark):
    """Columns that are no codes are neither read nor shuffled."""
    rows = [(i, f"c{i % 3}", f"note {i}", f"{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, kind string, note string, half string")
    codes = profile.code_values({("s", "t"): df})
    plan = codes._jdf.queryExecution().analyzed().toString()
    assert sorted(tuple(r) for r in codes.collect()) == [("s", "t", "half", v) for v in "01"] + [("s", "t", "kind", f"c{v}") for v in "012"]
    assert "trim(" in plan and not [line for line in plan.splitlines() if "trim(" in line and "note" in line]


def test_codes_of_no_field_are_no_rows(spark):
    df = spark.createDataFrame([(i, f"a text that is no code {i}") for i in range(50)], "id long, note string")
    codes = profile.code_values({("s", "t"): df})
    assert codes.columns == ["sys_code", "table_code", "col_code", "code_value"] and codes.count() == 0
