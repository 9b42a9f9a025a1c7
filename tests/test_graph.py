import random

from pyspark.sql import functions as F

from keyscout.operators import dimension, graph, same


def edges(spark, *pairs):
    return spark.createDataFrame([tuple(p) for p in pairs], "left string, right string")


def test_closure_with_a_cycle(spark, rows):
    got = graph.closure(edges(spark, "ab", "ba", "bc", "cd"))
    assert rows(got, "left", "right") == sorted([(x, y) for x in "ab" for y in "abcd"] + [("c", "d")])
    assert graph.closure(edges(spark, "ab").limit(0)).count() == 0


def test_mutual_groups_and_roots(spark, rows):
    e = edges(spark, "ab", "ba", "bc", "dc")
    groups = graph.mutual_groups(e)
    assert rows(groups, "node", "merged") == [("a", "a/b"), ("b", "a/b")]
    merged = graph.merge_nodes(e, groups)
    assert rows(merged) == [("a/b", "c"), ("d", "c")]
    assert rows(graph.root_nodes(merged)) == [("a/b",), ("d",)]


def test_components_match_union_find(spark, rows):
    rng = random.Random(4)
    nodes = [f"n{i:02d}" for i in range(40)]
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(25)] + [(nodes[i], nodes[i + 1]) for i in range(0, 12)]
    parent = {x: x for p in pairs for x in p}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    assert rows(graph.components(edges(spark, *pairs))) == sorted((x, top(x)) for x in parent)


def test_hub_with_a_third_of_all_edges(spark, rows):
    hub = spark.range(3000).select(F.lit("hub").alias("left"), F.concat(F.lit("x"), "id").alias("right"))
    rest = spark.range(3000).select(F.concat(F.lit("y"), "id").alias("left"), F.concat(F.lit("z"), "id").alias("right"))
    sizes = graph.components(hub.union(rest)).groupBy("component").count()
    assert rows(sizes.groupBy("count").agg(F.count("*").alias("n"))) == [(2, 3000), (3001, 1)]


def test_clusters_are_ranked_by_distinct_values(spark, rows):
    nodes = {c: f"s|t|{c}" for c in "abcde"}
    detail = spark.createDataFrame(
        [(nodes[a], nodes[b], r) for a, b, r in [("a", "b", "fk"), ("b", "c", "same"), ("d", "e", "equals"), ("a", "d", "fd")]],
        "left_node string, right_node string, rel_type string",
    )
    prof = spark.createDataFrame(
        [("s", "t", c, n) for c, n in zip("abcd", [5, 9, 9, 1])], "sys_code string, table_code string, col_code string, distinct long"
    )
    assert rows(same.field_clusters(detail, prof)) == [
        (1, "s|t|a", 1, 3), (1, "s|t|b", 1, 1), (1, "s|t|c", 1, 2), (2, "s|t|d", 1, 1), (2, "s|t|e", 1, 2),
    ]
    assert same.field_clusters(detail.limit(0), prof).count() == 0


def relations(spark, *rows):
    return spark.createDataFrame(list(rows), "left string, right string, kind string")


def test_members_prefer_attributes(spark, rows):
    e = relations(
        spark,
        ("s|r|k", "s|a|k", "FK"), ("s|a|k", "s|a|v", "FD"), ("s|a|v", "s|b|w", "FK"), ("s|a|k", "s|c|k", "FK"),
        ("s|r|k", "s|r|n", "FD"), ("s|r|n", "s|c|k", "FK"),
    )
    roots = spark.createDataFrame([("s|r|k",)], "node string")
    assert rows(dimension.dim_members(e, roots), "node", "member") == [
        ("s|a|k", "subset"), ("s|a|v", "attr"), ("s|b|w", "attr"), ("s|c|k", "attr"), ("s|r|k", "attr"), ("s|r|k", "subset"), ("s|r|n", "attr"),
    ]


def test_roots_of_one_table_are_grouped_through_merged_roots(spark, rows):
    roots = spark.createDataFrame([("s|a|x/s|b|y",), ("s|b|z",), ("t|b|q",), ("s|c|w",)], "node string")
    assert rows(dimension.dim_groups(roots)) == [
        ("s|a|x/s|b|y", "s|a|x/s|b|y"), ("s|b|z", "s|a|x/s|b|y"), ("s|c|w", "s|c|w"), ("t|b|q", "s|a|x/s|b|y"),
    ]


def main(spark, *links, literal=False):
    """Roots r1.. with ``links`` (root, attribute root), each in its own table."""
    names = sorted({x for link in links for x in link})
    node = {x: f"s|{x}|k" for x in names}
    roots = spark.createDataFrame([(node[x],) for x in names], "node string")
    members = spark.createDataFrame(
        [(node[a], node[b], "attr") for a, b in links] + [(n, n, "attr") for n in node.values()], "root string, node string, member string"
    )
    got = dimension.main_dimensions(roots, members, dimension.dim_groups(roots), literal)
    return {r["node"].split("|")[1]: (r["is_main"], r["dim"].split("|")[1]) for r in got.collect()}


def test_main_dimensions(spark):
    assert main(spark, "ab") == {"a": (True, "a"), "b": (False, "a")}
    assert main(spark, "ab", literal=True) == {"a": (True, "a"), "b": (True, "b")}
    assert main(spark, "ac", "bc")["c"] == (True, "c")  # attribute of two dimensions
    assert main(spark, "ab", "ba") == {"a": (True, "a"), "b": (True, "b")}  # attribute of no main root
    assert main(spark, "ab", "bc") == {"a": (True, "a"), "b": (False, "a"), "c": (True, "c")}


def test_division_marks_fields_that_are_both(spark, rows):
    e = relations(
        spark, ("s|a|k", "s|d|m", "FK"), ("s|a|j", "s|c|x", "FK"), ("s|a|k", "s|a|p", "FD"), ("s|a|j", "s|d|m", "FD"),
    )
    got = rows(dimension.dim_division(e), "table_code", "col_code", "dim_node", "relation_type", "del_flag")
    both = "s|a|j/s|a|k"
    assert got == [
        ("a", "j", both, "attr", "0"), ("a", "k", both, "attr", "0"), ("a", "p", both, "attr", "1"),
        ("c", "x", both, "subset", "1"), ("d", "m", both, "attr", "0"),
    ]


def plain_reach(pairs):
    step = {}
    for a, b in pairs:
        step.setdefault(a, set()).add(b)
    reach = {}
    for start in step:
        todo, seen = [start], set()
        while todo:
            for b in step.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        reach[start] = seen
    return reach


def test_bits_of_many_roots_reach_what_a_plain_search_does(spark, rows):
    rng = random.Random(5)
    pairs = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(90)]
    reach = plain_reach(pairs)
    roots = [f"r{i:03d}" for i in range(150)]
    start = [(r, f"n{rng.randrange(60):02d}") for r in roots]
    got = graph.reached_by(spark.createDataFrame(start, "root string, state string"), edges(spark, *pairs).toDF("state", "next"))
    assert rows(got, "root", "state") == sorted((r, s) for r, n in start for s in {n} | reach.get(n, set()))


def test_names_may_hold_separators(spark, rows):
    from keyscout.operators import fd, fk

    odd, other = ("s|1", "a/b", "k,1"), ("s", "c:d%7C", "x[y]")
    edge = spark.createDataFrame([(*odd, *other, 1.0, 5), (*other, *odd, 1.0, 5), (*odd, "s", "t", "c", 1.0, 5)], "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string, ratio double, parent_size long")
    fds = fd.fd_rows(spark, [(frozenset(["k,1"]), "v:2")], *odd[:2])
    got = dimension.dim_division(dimension.relation_edges(fds, fk.named_fks(edge)))
    assert rows(got, "sys_code", "table_code", "col_code", "relation_type") == sorted([(*odd, "attr"), (*other, "attr"), ("s", "t", "c", "subset"), (*odd[:2], "v:2", "attr")])
    from keyscout.sources import fd_text

    fds = fd.fd_rows(spark, [(frozenset(["k,1", "a]b"]), "v:2"), (frozenset(), "%2C\n")], *odd[:2])
    again = fd_text.parse_fd_lines(fd_text.fd_lines(fds))
    assert rows(again) == rows(fds, "lhs", "rhs", "fd_level")
    assert rows(fd_text.load_stored_fds(fd_text.stored_fds(fds))) == rows(fds)


def test_strong_components_match_a_plain_closure(spark):
    import random

    rng = random.Random(3)
    parts = []
    for case in range(12):  # many small graphs side by side, sparse to dense
        names = [f"g{case:02d}n{i}" for i in range(9)]
        parts += [(a, b) for a in names for b in names if rng.random() < (0.06, 0.12, 0.2, 0.9)[case % 4]]
    parts += [("r0", "r1"), ("r1", "r0"), ("s", "s")]
    reach = {}
    for a, b in parts:
        reach.setdefault(a, set()).add(b)
    for k in list(reach):
        todo = list(reach[k])
        while todo:
            for x in reach.get(todo.pop(), ()):
                if x not in reach[k]:
                    reach[k].add(x)
                    todo.append(x)
    want = {frozenset({a} | {b for b in reach[a] if a in reach.get(b, ())}) for a in reach}
    groups = {}
    for node, component in graph.strong_components(spark.createDataFrame(parts, "left string, right string")).collect():
        groups.setdefault(component, set()).add(node)
    assert {frozenset(g) for g in groups.values()} == {g for g in want if len(g) > 1}


def test_a_long_ring_is_one_component(spark):
    n = 5000
    ring = spark.range(n).select(F.col("id").cast("string").alias("left"), ((F.col("id") + 1) % n).cast("string").alias("right"))
    got = graph.strong_components(ring)
    assert got.count() == n and got.select("component").distinct().count() == 1
