import random
from itertools import combinations

import pytest

from keyscout.operators import fd
from keyscout.sources import fd_text


def brute_force(table, names, max_lhs):
    """Minimal FDs by comparing all rows as text, NULL as blank."""
    cells = [["" if v is None else str(v) for v in row] for row in table]
    pos = {c: i for i, c in enumerate(names)}

    def n(cols):
        return len({tuple(r[pos[c]] for c in cols) for r in cells})

    constants = {c for c in names if n([c]) == 1}
    found = {(frozenset(), c) for c in constants}
    varying = [c for c in names if c not in constants]
    for k in range(1, max_lhs + 1):
        for lhs in combinations(varying, k):
            for r in varying:
                implied = any(x <= set(lhs) and y == r for x, y in found)
                if r not in lhs and not implied and n(lhs) == n([*lhs, r]):
                    found.add((frozenset(lhs), r))
    return found


def random_table(rng, n_rows, n_cols):
    widths = [rng.choice([1, 2, 3, 6, 40]) for _ in range(n_cols)]
    rows = []
    for _ in range(n_rows):
        row = [rng.randrange(w) if w > 1 else 7 for w in widths]
        row[-1] = (row[0] + row[1]) % 3
        rows.append([None if rng.random() < 0.05 else v for v in row])
    return rows


@pytest.mark.parametrize("kind, depth", [("string", 3), ("int", 2)])
def test_mining_matches_brute_force(spark, kind, depth):
    rng = random.Random(11)
    names = ["a", "b", "c", "d"]
    for _ in range(2):
        table = random_table(rng, 30, 4)
        cells = [[None if v is None else (str(v) if kind == "string" else v) for v in r] for r in table]
        df = spark.createDataFrame(cells, ", ".join(f"{c} {kind}" for c in names))
        assert set(fd.mine_fds(df, depth)) == brute_force(table, names, depth)


def test_large_tables_take_the_probe_and_agree(spark):
    rng = random.Random(5)
    names = ["a", "b", "c", "d"]
    table = [[i, rng.randrange(30), rng.randrange(4), 0] for i in range(400)]
    for row in table:
        row[3] = f"{row[1]}-{row[2]}" if row[1] % 2 else "even"
    df = spark.createDataFrame([[str(v) for v in r] for r in table], ", ".join(f"{c} string" for c in names))
    assert set(fd.mine_fds(df, 2, probe_rows=20)) == brute_force(table, names, 2)
    assert set(fd.mine_fds(df, 2, probe_rows=20)) == set(fd.mine_fds(df, 2))


def test_blank_and_null_are_one_value_but_spaces_count(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a", "y"), ("a ", "z"), ("b", "w")], "k string, v string")
    assert (frozenset(["k"]), "v") in fd.mine_fds(df, 1)


def test_small_tables_have_no_fds(spark):
    df = spark.createDataFrame([("a", "b")] * 4, "x string, y string")
    assert fd.discover_fds(df).count() == 0


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 2), (3, "b", 3)], "x int, y string, z int")
    assert rows(fd.check_fds(df, [(["x"], "y"), (["y"], "x"), (["x", "z"], "y")])) == [
        ("x", "y", True), ("x,z", "y", True), ("y", "x", False),
    ]
    assert fd.check_fd(df, ["x"], ["y", "z"]).collect()[0]["holds"] is False
    assert rows(fd.pair_fd(df, [("x", "y"), ("y", "z")])) == [("x", "y", "fd")]


def fds_of(spark, *pairs, table="t"):
    return fd.fd_rows(spark, [(frozenset(lhs), rhs) for lhs, rhs in pairs], "s", table)


def flat(df):
    return sorted(("".join(r["lhs"]), r["rhs"]) for r in df.collect())


def test_merge(spark):
    one = fds_of(spark, ("a", "z"), ("bc", "z"), ("x", "only1"))
    two = fds_of(spark, ("a", "z"), ("cd", "z"), ("y", "only2"))
    assert flat(fd.merge_fds(one, two)) == [("a", "z"), ("bcd", "z")]
    three = fds_of(spark, ("a", "z"), ("d", "z"))
    assert flat(fd.merge_fds(one, three)) == [("a", "z")]
    assert flat(fd.merge_fds(one, three, require_overlap=False)) == [("a", "z"), ("bcd", "z")]


def test_merge_keeps_minimal_sets(spark):
    one = fds_of(spark, ("ab", "z"), ("c", "z"))
    two = fds_of(spark, ("bc", "z"), ("c", "z"))
    assert flat(fd.merge_fds(one, two)) == [("c", "z")]


def test_degrees_counts_and_levels(spark, rows):
    fds = fds_of(spark, ("a", "b"), ("b", "a"), ("ac", "d"), ("", "k"))
    assert rows(fd.fd_degrees(fds), "col_code", "out_degree", "in_degree", "side") == [
        ("a", 2, 1, "LR"), ("b", 1, 1, "LR"), ("c", 1, 0, "L"), ("d", 0, 1, "R"), ("k", 0, 1, "R"),
    ]
    assert fd.fd_count_filter(fds, 3).count() == 0 and fd.fd_count_filter(fds, 4).count() == 1
    assert fd.fds_by_level(fds).count() == 3


def test_text_round_trip(spark, rows):
    lines = spark.createDataFrame([("[b,a]:c,d",), ("[]:x\x00",), ("",)], "value string")
    parsed = fd_text.parse_fd_lines(lines)
    assert rows(parsed) == [([], "x", 0), (["a", "b"], "c", 2), (["a", "b"], "d", 2)]
    fds = fds_of(spark, ("ab", "c"), ("ab", "d"), ("", "x"))
    again = fd_text.parse_fd_lines(fd_text.fd_lines(fds))
    assert rows(again) == rows(parsed)
    assert rows(fd_text.load_stored_fds(fd_text.stored_fds(fds))) == rows(fds)


def test_both_zeros_are_one_value_on_every_path(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (1.0, "y"), (2.0, "y"), (-0.0, "x"), (0.0, "x")], "a double, b string")
    small, large = (fd.mine_fds(df, probe_rows=n) for n in (100_000, 0.5))
    assert (frozenset(["a"]), "b") in small and set(small) == set(large)


def test_large_tables_group_all_rows_only_where_hashes_and_some_groups_decide_nothing(spark, monkeypatch):
    """A pair that is unique is found by hashes, a pair refuted in many groups by some whole groups."""
    n = 6000
    data = [(i // 2, i % 2, i // 2 % 40, (i // 2 * 7 + i % 2 * 3) % 50, f"t{i % 7}") for i in range(n)]
    df = spark.createDataFrame(data, "a int, b int, c int, d int, e string")
    grouped, test = {}, fd._test
    monkeypatch.setattr(fd, "_test", lambda rows, lhs, rhs: grouped.setdefault(lhs, []).append(rows.count()) or test(rows, lhs, rhs))
    found = fd.mine_fds(df, 2, probe_rows=60)
    assert n not in grouped.get(("a", "b"), []) and n not in grouped.get(("a", "d"), []) and n in grouped[("a",)]
    assert (frozenset("ab"), "e") in found and (frozenset("a"), "c") in found
    monkeypatch.undo()
    assert sorted(map(str, found)) == sorted(map(str, fd.mine_fds(df, 2)))
