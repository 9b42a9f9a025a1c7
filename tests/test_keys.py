import random
from itertools import combinations

from keyscout.operators import fd, keys, profile
from keyscout.plans import discovery


def fds_of(spark, *pairs, table="t"):
    return fd.fd_rows(spark, [(frozenset(lhs), rhs) for lhs, rhs in pairs], "s", table)


def columns(spark, names, table="t"):
    return spark.createDataFrame([("s", table, c) for c in names], "sys_code string, table_code string, col_code string")


def found(df):
    return sorted("".join(sorted(r["key"])) for r in df.collect())


def test_closure(spark):
    fds = fds_of(spark, ("a", "b"), ("bc", "d"), ("d", "e"), ("", "k"))
    starts = spark.createDataFrame([("s", "t", ["c", "a"]), ("s", "t", ["b"])], "sys_code string, table_code string, start array<string>")
    got = {"".join(r["start"]): "".join(r["closure"]) for r in keys.fd_closure(fds, starts).collect()}
    assert got == {"ac": "abcdek", "b": "bk"}


def test_mutual_determinants_are_promoted(spark):
    fds = fds_of(spark, ("a", "b"), ("b", "a"), ("ac", "d"))
    assert found(keys.candidate_keys(fds, columns(spark, "abcd"))) == ["ac", "bc"]


def test_columns_in_no_fd_are_in_every_key(spark):
    fds = fds_of(spark, ("a", "b"))
    assert found(keys.candidate_keys(fds, columns(spark, "abn"))) == ["an"]
    assert found(keys.candidate_keys(fds, columns(spark, "abnmo"))) == []  # four columns are too many


def test_cyclic_determinants_use_the_second_phase(spark):
    one_way = fds_of(spark, ("a", "b"), ("b", "c"), ("c", "a"))
    assert found(keys.candidate_keys(one_way, columns(spark, "abc"))) == ["a", "b", "c"]
    # Only a and c determine each other both ways, and c also depends on b alone.
    partly = fds_of(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"))
    assert found(keys.candidate_keys(partly, columns(spark, "abc"))) == ["a"]


def test_many_fds_fall_back_to_short_determinants(spark):
    fds = fds_of(spark, ("abcd", "e"), ("a", "b"), ("a", "c"), ("a", "d"))
    assert found(keys.candidate_keys(fds, columns(spark, "abcde"), max_fds=10)) == ["a"]
    # Without the four-column rule nothing determines e, so it joins every key.
    assert found(keys.candidate_keys(fds, columns(spark, "abcde"), max_fds=3)) == ["ae"]


def test_one_step_candidates(spark):
    fds = fds_of(spark, ("a", "b"), ("a", "c"), ("ab", "d"), ("", "k"))
    assert found(keys.candidate_keys_sql(fds, columns(spark, "abck"))) == []
    assert found(keys.candidate_keys_sql(fds, columns(spark, "abcdk"))) == ["ab"]
    assert found(keys.candidate_keys_sql(fds, columns(spark, "abcdkz"))) == []


def test_verification_and_choice(spark, rows):
    good = [(str(i), f"n{i:02d}", str(i // 2), str(i % 2), f"{i}.5") for i in range(10)]
    df = spark.createDataFrame(good, "id string, name string, g string, h string, amount string")
    prof = profile.profile_table(df, "s", "t")
    candidates = spark.createDataFrame(
        [("s", "t", k) for k in (["id"], ["name"], ["amount"], ["g"], ["g", "h"], ["h", "name"])],
        "sys_code string, table_code string, key array<string>",
    )
    single = keys.verify_single_keys(candidates, prof)
    assert rows(single, "col_code") == [("id",), ("name",)]
    joint = keys.verify_joint_keys(candidates, prof, {("s", "t"): df})
    assert rows(joint, "key") == [(["g", "h"],), (["h", "name"],)]
    fds = fds_of(spark, ("id", "name"))
    assert rows(keys.choose_keys(single, joint), "kind", "group_code", "cols") == [
        ("single", 0, ["id"]), ("single", 1, ["name"]),
    ]
    none = single.limit(0)
    assert rows(keys.choose_keys(none, joint), "kind", "group_code", "cols") == [
        ("joint", 0, ["g", "h"]), ("joint", 1, ["h", "name"]),
    ]
    nothing = fds.limit(0)
    mined = spark.createDataFrame([("s", "t")], "sys_code string, table_code string")
    assert rows(keys.whole_row_keys(nothing, columns(spark, ["y", "x"]), mined), "key") == [(["x", "y"],)]
    assert keys.whole_row_keys(nothing, columns(spark, ["y", "x"]), mined.limit(0)).count() == 0
    assert keys.whole_row_keys(nothing, columns(spark, list("wxyz")), mined).count() == 0
    marked = keys.mark_keys(prof, keys.choose_keys(single, joint))
    assert rows(marked.where("col_pk"), "col_code") == [("id",), ("name",)]


def test_few_duplicates_are_tolerated_in_large_tables(spark):
    df = spark.range(2000).selectExpr("CAST(greatest(id, 3) AS STRING) AS k", "'x' AS c")
    prof = profile.profile_table(df, "s", "t")
    one = spark.createDataFrame([("s", "t", ["k"])], "sys_code string, table_code string, key array<string>")
    assert keys.verify_single_keys(one, prof, threshold=2000).count() == 1
    assert keys.verify_single_keys(one, prof, threshold=2001).count() == 0
    assert keys.verify_single_keys(one, prof, threshold=2000, tolerance=3).count() == 0
    assert keys.verify_single_keys(one, prof).count() == 0


def test_tables_with_a_repeated_row_have_no_whole_row_key(spark):
    few = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "p string, q string")
    assert discovery.discover_pk(spark, {("s", "t"): few}).count() == 0
    pairs = [(str(i), str(j)) for i in range(4) for j in range(4)]
    whole = spark.createDataFrame(pairs, "p string, q string")
    assert [r["cols"] for r in discovery.discover_pk(spark, {("s", "t"): whole}).collect()] == [["p", "q"]]
    again = spark.createDataFrame(pairs + pairs[:1], "p string, q string")
    assert discovery.discover_pk(spark, {("s", "t"): again}).count() == 0


def test_three_column_keys_are_found_by_default(spark):
    rows_ = [(i, j, k, "v%d" % ((3 * i + 5 * j + 7 * k) % 4)) for i in range(4) for j in range(4) for k in range(4)]
    cube = spark.createDataFrame(rows_, "a int, b int, c int, d string")
    assert ["a", "b", "c"] in [r["cols"] for r in discovery.discover_pk(spark, {("s", "t"): cube}).collect()]


def test_null_tuples_are_rows_but_not_tuples(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b")], "x string, y string")
    r = keys.count_key_tuples({("s", "t"): df}, {("s", "t"): [["x", "y"]]}).collect()[0]
    assert (r["records"], r["tuples"]) == (3, 1)


def test_discovered_keys_are_unique_in_the_data(spark, folder):
    from keyscout.sources.tables import read_table

    tables = {("s", n): read_table(spark, folder, n) for n in ("customer", "orders", "conversations")}
    for r in discovery.discover_pk(spark, tables).collect():
        df = tables[(r["sys_code"], r["table_code"])]
        assert df.select(*r["cols"]).distinct().count() == df.count()
        for fewer in combinations(r["cols"], len(r["cols"]) - 1):
            assert not fewer or df.select(*fewer).distinct().count() < df.count()


def plain_candidates(fds, names, limit=3):
    """Keys of the first size that has any, over all sets of that size, by roles of columns."""
    lefts, rights = {c for lhs, _ in fds for c in lhs}, {r for _, r in fds}
    side = {c: "LR" if c in lefts and c in rights else "L" if c in lefts else "R" if c in rights else "N" for c in names}
    if "L" not in side.values():
        single = {(next(iter(lhs)), r) for lhs, r in fds if len(lhs) == 1}
        for c in [c for c in names if side[c] == "LR"]:
            if all((b, a) in single for a, b in single if b == c):
                side[c] = "L"

    def closure(start):
        known = set(start)
        while more := {r for lhs, r in fds if set(lhs) <= known and r not in known}:
            known |= more
        return known

    of = lambda s: {c for c in names if side[c] == s}
    for pool, base in ((of("L"), of("N")), (of("LR"), of("L") | of("N"))):
        for size in range(1, limit + 1 - len(base)):
            got = [set(s) | base for s in combinations(sorted(pool), size) if closure(set(s) | base) == set(names)]
            if got:
                return sorted("".join(sorted(g)) for g in got)
    return []


def test_candidates_match_a_search_of_all_sets(spark):
    rng = random.Random(8)
    rules, names = [], "abcdefg"
    plain = {}
    for k in range(12):
        own = {(frozenset(rng.sample(names, rng.choice([1, 1, 2, 2, 3]))), rng.choice(names)) for _ in range(rng.randrange(4, 12))}
        own = sorted(((lhs, r) for lhs, r in own if r not in lhs), key=str)
        plain[f"t{k}"] = plain_candidates(own, names)
        rules += [("s", f"t{k}", sorted(lhs), r, len(lhs)) for lhs, r in own]
    every = [("s", f"t{k}", c) for k in range(12) for c in names]
    got = keys.candidate_keys(spark.createDataFrame(rules, fd.FD_SCHEMA), spark.createDataFrame(every, "sys_code string, table_code string, col_code string"))
    found_ = {}
    for r in got.collect():
        found_.setdefault(r["table_code"], []).append("".join(sorted(r["key"])))
    assert {t: sorted(found_.get(t, [])) for t in plain} == plain and sum(map(bool, plain.values())) > 3


def test_hundreds_of_columns_are_not_combined(spark, monkeypatch):
    tried = []
    close = keys.fd_closure
    monkeypatch.setattr(keys, "fd_closure", lambda rules, starts: (tried.append(starts.count()), close(rules, starts))[1])
    # Nothing determines the 200 determining columns, so no set of three is worth closing.
    names = [f"c{i:03d}" for i in range(200)] + ["r"]
    rules = [("s", "t", [c], "r", 1) for c in names[:-1]]
    every = spark.createDataFrame([("s", "t", c) for c in names], "sys_code string, table_code string, col_code string")
    assert keys.candidate_keys(spark.createDataFrame(rules, fd.FD_SCHEMA), every).count() == 0
    assert tried[0] == 201 and sum(tried[1:]) == 0
