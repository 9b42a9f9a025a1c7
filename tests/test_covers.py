from itertools import combinations

from pyspark.sql import functions as F

from keyscout.operators import covers, fd


def grown(spark, family, usable, levels):
    """Sets that hit all members, found level by level; those that do are not grown."""
    families = spark.createDataFrame([(1, family, usable)], "k int, family array<array<int>>, usable array<int>")
    partials = spark.createDataFrame([(1, [])], "k int, chosen array<int>")
    hits, sizes = [], []
    for _ in range(levels):
        sets = covers.extended(partials, families, ["k"]).cache()
        sizes.append(sets.count())
        hits += [tuple(r["chosen"]) for r in sets.where("covers").collect()]
        partials = sets.where("NOT covers").select("k", "chosen")
    return hits, sizes


def test_all_minimal_covers_are_reached(spark):
    family = [[1, 2, 3], [3, 4], [2, 5, 6], [1, 6]]
    hits, _ = grown(spark, family, list(range(8)), 3)
    good = [set(s) for k in (1, 2, 3) for s in combinations(range(8), k) if all(set(m) & set(s) for m in family)]
    minimal = {tuple(sorted(s)) for s in good if not any(t < s for t in good)}
    assert minimal <= set(hits) and all(set(h) in good for h in hits) and len(hits) == len(set(hits))


def test_wide_schemas_are_not_combined(spark):
    # Of 1.3 million triples of 200 columns, only those with an element of each missed member are built.
    family = [[i, i + 50, i + 100] for i in range(3)]
    hits, sizes = grown(spark, family, list(range(200)), 3)
    assert sizes == [3, 9, 27] and len(hits) == 27


def test_unusable_elements_and_limits_of_growth(spark):
    families = spark.createDataFrame([(1, [[1, 2]], [2, 3]), (2, [], [5, 6])], "k int, family array<array<int>>, usable array<int>")
    partials = spark.createDataFrame([(1, [], None), (2, [], [6, 9])], "k int, chosen array<int>, within array<int>")
    assert sorted((r["k"], r["chosen"], r["covers"]) for r in covers.extended(partials, families, ["k"]).collect()) == [(1, [2], True), (2, [6], True)]


def test_implied_sets_are_left_out(spark):
    sets = spark.createDataFrame([(9, [1, 2, 3]), (9, [1, 4, 5]), (9, [4, 5, 6]), (8, [4, 6, 7])], "target int, chosen array<int>")
    rules = spark.createDataFrame([([1, 2], 9), ([4], 5)], "lhs array<int>, rhs int")
    assert [(r["target"], r["chosen"]) for r in covers.without_implied(sets, rules, "target", 3).collect()] == [(8, [4, 6, 7])]


def test_difference_sets_come_from_pairs(spark):
    rows = [("a", "x", 1, None), ("a", "y", 1, ""), ("b", "y", 2, ""), ("b", "y", 2, ""), ("c", "z", 3, "q")]
    df = spark.createDataFrame(rows, "p string, q string, r int, s string")
    got = {r["target"]: [tuple(x) for x in r["family"]] for r in covers.difference_sets(df, ["p", "q", "r", "s"], 100, 100).collect()}
    real = {tuple(i for i in range(4) if a[i] != b[i]) for a in rows for b in rows if a != b}
    assert all((*m, t) and tuple(sorted((*m, t))) in real for t, ms in got.items() for m in ms)
    assert (2,) in got[0] and (0,) in got[2] and (3,) in got[1]
    assert {len(v) for v in (r["family"] for r in covers.difference_sets(df, ["p", "q", "r", "s"], 100, 1).collect())} == {1}


def test_texts_stay_out_of_sorted_aggregates(spark):
    df = spark.createDataFrame([(str(i % 7), str(i % 3), "v") for i in range(50)], "a string, b string, c string")
    rows = fd.comparable(df)
    tested = fd._test(rows, ("a", "b"), ["c"])._jdf.queryExecution().toString()
    counted = fd.check_fds(df, [(["a"], "b"), (["b"], "c")])
    assert "SortAggregate" not in tested and "SortAggregate" not in counted._jdf.queryExecution().toString()
    assert {(r["lhs"], r["rhs"]): r["holds"] for r in counted.collect()} == {("a", "b"): False, ("b", "c"): True}
    same = df.withColumn("d", F.col("a"))
    assert fd.check_fds(same, [(["a"], "d"), (["a"], "a")]).where("holds").count() == 2
