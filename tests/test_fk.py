import random

from pyspark.sql import functions as F

from keyscout.operators import fk, profile

PAIR = ["parent_col", "child_col"]


def frame(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_unary_inclusion_matches_sets(spark):
    rng = random.Random(2)
    data = {f"c{i}": [str(rng.randrange(30)) if rng.random() > 0.1 else rng.choice([None, " "]) for _ in range(200)] for i in range(4)}
    data["c4"] = ["1 ", "2", "3"]
    tables = {("s", f"t_{c}"): frame(spark, v, c) for c, v in data.items()}
    pairs = [("s", f"t_{a}", a, "s", f"t_{b}", b) for a in data for b in data if a != b]
    for r in fk.inclusion_unary(tables, pairs).collect():
        parent = {(v or "").rstrip(" ") for v in data[r["parent_col"]]} - {""}
        child = {(v or "").rstrip(" ") for v in data[r["child_col"]]}
        assert r["parent_size"] == len(parent)
        assert r["child_distinct"] == len(child)
        assert r["contained"] == len(child & parent)


def test_more_fields_than_one_word(spark):
    names = [f"c{i:03d}" for i in range(70)]
    df = spark.createDataFrame([[str(i % (j + 1)) for j in range(70)] for i in range(300)], ", ".join(f"{c} string" for c in names))
    other = frame(spark, [str(i) for i in range(100)], "k")
    got = fk.inclusion_unary({("s", "w"): df, ("s", "k"): other}, [("s", "k", "k", "s", "w", c) for c in names])
    assert {r["child_col"]: r["contained"] for r in got.collect()} == {c: j + 1 for j, c in enumerate(names)}


def test_hot_value_does_not_change_the_result(spark):
    parent = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    child = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 2100).cast("string")).alias("f"))
    got = fk.inclusion_unary({("s", "p"): parent, ("s", "c"): child}, [("s", "p", "k", "s", "c", "f")]).collect()[0]
    values = {"7" if i % 3 == 0 else str(i % 2100) for i in range(30_000)}
    assert (got["child_distinct"], got["contained"]) == (len(values), len({v for v in values if int(v) < 2000}))


def setup(spark, parent, child):
    tables = {("s", "p"): frame(spark, parent, "pk"), ("s", "c"): frame(spark, child, "ref")}
    prof = profile.profile_tables(tables)
    keys = spark.createDataFrame([("s", "p", "pk")], "sys_code string, table_code string, col_code string")
    return tables, keys, prof


def test_discovery_thresholds(spark):
    big = [f"k{i:04d}" for i in range(300)]
    hit = fk.discover_fk(*setup(spark, big, big[:99] + ["zzzzz"])).collect()
    assert [r["ratio"] for r in hit] == [0.99]
    assert fk.discover_fk(*setup(spark, big, big[:98] + ["zzzzz"])).count() == 0
    small = [f"k{i:03d}" for i in range(99)]
    assert fk.discover_fk(*setup(spark, small, small[:90])).count() == 1
    assert fk.discover_fk(*setup(spark, small, small[:90] + ["zzzz"])).count() == 0
    assert fk.discover_fk(*setup(spark, big, big[:99] + ["zzzzz"]), small=301).count() == 0


def test_blank_child_value_counts_against(spark):
    big = [f"k{i:04d}" for i in range(300)]
    assert fk.discover_fk(*setup(spark, big, big[:50] + [None])).count() == 0
    assert fk.discover_fk(*setup(spark, big, big[:150] + [None, " "])).count() == 1


def test_few_values_sequences_and_short_keys_are_no_keys(spark):
    big = [f"k{i:04d}" for i in range(300)]
    assert fk.discover_fk(*setup(spark, big, big[:2] * 5)).count() == 0
    numbers = [str(i) for i in range(1000, 1300)]
    tables, keys, prof = setup(spark, numbers, numbers[:50])
    assert fk.discover_fk(tables, keys, prof).count() == 0
    assert fk.discover_fk(tables, keys, prof, skip_autoincrement=False).count() == 1
    assert fk.discover_fk(tables, keys, prof, skip_autoincrement=False, systems=["other"]).count() == 0
    letters = [chr(33 + i) for i in range(90)]
    tables, keys, prof = setup(spark, letters, letters[:50])
    assert fk.discover_fk(tables, keys, prof).count() == 0
    assert fk.discover_fk(tables, keys, prof, min_avg_len=1.0).count() == 1


def test_candidates_respect_type_families(spark, rows):
    tables = {
        ("s", "p"): spark.createDataFrame([(f"{i:03d}x", f"v{'y' * (i % 3)}{i:03d}", str(100 + i)) for i in range(120)], "ch string, vc string, it string"),
        ("s", "c"): spark.createDataFrame([(f"{i:03d}x", f"v{'y' * (i % 3)}{i:03d}", str(100 + i)) for i in range(100)], "ch string, vc string, it string"),
    }
    prof = profile.profile_tables(tables)
    parents = prof.where("table_code = 'p'")
    got = fk.fk_candidates(parents, prof).where("child_table = 'c'")
    assert rows(got, *PAIR) == [("ch", "ch"), ("it", "it"), ("vc", "ch"), ("vc", "vc")]


def joint(spark, parent, child, max_misses=None):
    tables = {
        ("s", "p"): spark.createDataFrame(parent, "a string, b string"),
        ("s", "c"): spark.createDataFrame(child, "x string, y string"),
    }
    return fk.inclusion_nary(tables, [(("s", "p"), ["a", "b"], ("s", "c"), ["x", "y"])], max_misses).collect()[0]


def test_joint_inclusion_ignores_blanks_and_keeps_tuples_apart(spark):
    r = joint(spark, [("a", "bc"), ("x", "y"), (None, "z")], [("a", "bc "), ("ab", "c"), ("a", None), (" ", "bc"), ("x", "y"), ("x", "y")])
    assert (r["parent_size"], r["rows"], r["contained"], r["ratio"]) == (2, 4, 3, 0.75)


def test_joint_inclusion_miss_cap(spark):
    parent = [(str(i), "k") for i in range(200)]
    child = [(str(i % 200), "k") for i in range(20_000)]
    assert joint(spark, parent, child + [("q", "q")] * 100, 100)["ratio"] > 0.99
    assert joint(spark, parent, child + [("q", "q")] * 101, 100)["ratio"] == 0.0
    assert joint(spark, parent, child + [("q", "q")] * 101)["ratio"] == 20_000 / 20_101


def test_joint_discovery(spark, rows):
    pairs = [(f"k{i:03d}", f"n{j:02d}") for i in range(30) for j in range(5)]
    tables = {
        ("s", "p"): spark.createDataFrame(pairs, "a string, b string"),
        ("s", "c"): spark.createDataFrame([(b, a, "z") for a, b in pairs[::2] * 3], "u string, v string, w string"),
    }
    prof = profile.profile_tables(tables)
    key = spark.createDataFrame([("s", "p", 0, ["a", "b"])], "sys_code string, table_code string, group_code int, cols array<string>")
    got = fk.discover_joint_fk(tables, key, prof).collect()
    assert [[(p["parent_col"], p["child_col"]) for p in r["pairs"]] for r in got] == [[("a", "v"), ("b", "u")]]
    stored = fk.joint_fk_rows(spark.createDataFrame(got, fk.JOINT_FK_SCHEMA))
    assert fk.joint_fk_groups(stored).collect()[0]["group_id"] == got[0]["group_id"]


def test_assignments_use_each_child_column_once(spark, rows):
    cand = spark.createDataFrame(
        [("s", "p", p, 0, 3, "s", "c", c) for p, cs in {"a": "xy", "b": "xy", "d": "yz"}.items() for c in cs]
        + [("s", "p", "a", 0, 3, "s", "e", "q")],
        "parent_sys string, parent_table string, parent_col string, group_code int, key_size int, child_sys string, child_table string, child_col string",
    )
    got = fk.joint_fk_assignments(cand).select(F.transform("pairs", lambda p: p["child_col"]).alias("c"))
    assert rows(got) == [(["x", "y", "z"],), (["y", "x", "z"],)]


def test_violations_and_diagram(spark, rows):
    child, parent = frame(spark, ["a", "b ", None, "c"], "f"), frame(spark, ["b", "a", ""], "k")
    assert rows(fk.fk_violations(child, "f", parent, "k")) == [("c",)]
    edges = spark.createDataFrame(
        [("s", "p", "k", "s", "c", "f", 1.0, 5), ("s", "p", "k", "z", "c", "f", 1.0, 5)],
        "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string, ratio double, parent_size long",
    )
    assert rows(fk.fk_diagram_nodes(fk.named_fks(edges)), "node_code", "node_name", "node_type") == [
        ("Ref_o1", "1", "c:Object"), ("Ref_o1", "p_k_c_f", "o:Reference"), ("c", "1", "c:SourceSymbol"), ("p", "1", "c:DestinationSymbol"),
    ]


def test_unary_pairs_stay_in_spark(spark):
    frames = {("s", "p"): frame(spark, ["a", "b"], "k"), ("s", "c"): frame(spark, ["a", None, "z", "a "], "f"), ("s", "e"): frame(spark, [], "f")}
    pairs = spark.createDataFrame([("s", "p", "k", "s", "c", "f"), ("s", "p", "k", "s", "e", "f")], ", ".join(f"{c} string" for c in fk.EDGE))
    got = {r["child_table"]: (r["parent_size"], r["child_distinct"], r["child_filled"], r["contained"], r["ratio"]) for r in fk.inclusion_unary(frames, pairs).collect()}
    assert got == {"c": (2, 3, 2, 1, 1 / 3), "e": (2, 0, 0, 0, 0.0)}
    assert fk.inclusion_unary(frames, pairs.limit(0)).count() == 0


def test_joint_levels_build_only_what_may_pass(spark, monkeypatch):
    n, width = 120, 30
    parent = spark.range(n).select(*[F.format_string(f"p{i % 3}x%03d", F.col("id") * (1 if i % 3 else 0) + (F.col("id") if i % 3 == 0 else F.lit(0))).alias(f"a{i}") for i in range(3)])
    # Of the 30 child columns, one holds values of each parent column; the rest hold others of the same lengths.
    child = spark.range(3 * n).select(
        *[F.format_string((f"p{i}x" if i < 3 else f"q{i % 10}x") + "%03d", F.col("id") % n).alias(f"c{i:02d}") for i in range(width)]
    )
    frames = {("s", "p"): parent, ("s", "c"): child}
    columns = ", ".join(f"{c} {t}" for c, t in [*[(x, "string") for x in fk.PARENT], ("group_code", "int"), ("key_size", "int"), *[(x, "string") for x in fk.CHILD]])
    cand = spark.createDataFrame([("s", "p", f"a{i}", 0, 3, "s", "c", f"c{j:02d}") for i in range(3) for j in range(width)], columns)
    monkeypatch.setattr(fk, "joint_fk_candidates", lambda *a, **k: cand)
    seen = []
    whole = fk.inclusion_nary
    monkeypatch.setattr(fk, "inclusion_nary", lambda t, a, m=None: seen.append(len(list(a))) or whole(t, a, m))
    prof = spark.createDataFrame([], "sys_code string")
    got = fk.discover_joint_fk(frames, None, prof).collect()
    assert [[p["child_col"] for p in r["pairs"]] for r in got] == [["c00", "c01", "c02"]]
    assert seen == [1, 1]


def test_joint_bounds_lose_nothing(spark):
    rng = random.Random(5)
    cell = lambda: rng.choice(["u", "v", "w", "x", None])
    parent = [tuple(rng.choice("uvw") for _ in range(3)) for _ in range(9)]
    for seed in range(3):
        child = [tuple(cell() if rng.random() < 0.4 else rng.choice(parent)[k] for k in range(3)) for _ in range(60)]
        frames = {("s", "p"): spark.createDataFrame(parent, "a string, b string, d string"), ("s", "c"): spark.createDataFrame(child, "x string, y string, z string")}
        columns = ", ".join(f"{c} {t}" for c, t in [*[(x, "string") for x in fk.PARENT], ("group_code", "int"), ("key_size", "int"), *[(x, "string") for x in fk.CHILD]])
        cand = spark.createDataFrame([("s", "p", p, 0, 3, "s", "c", c) for p in "abd" for c in "xyz"], columns)
        every = fk._assignments(fk.joint_fk_assignments(cand))
        ratios = {tuple(p["child_col"] for p in r["pairs"]): r["ratio"] for r in fk.inclusion_nary(frames, every).collect()}
        kept = fk.bounded_candidates(frames, cand, 0.5)
        left = {(r["parent_col"], r["child_col"]) for r in kept.collect()}
        for cols, ratio in ratios.items():
            assert ratio < 0.5 or all(x in left for x in zip("abd", cols))
