import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keyscout.operators import consolidate, fd, profile, same, worklist
from keyscout.sources import tables as src
from keyscout.sources.results import ResultStore


def test_date_windows(spark):
    assert src.date_window("20200301", 2) == ["20200301", "20200302"]
    assert src.date_window("20200301", -3) == ["20200228", "20200229", "20200301"]
    assert src.date_window("20200301", 0) == []
    assert consolidate.consolidation_end("20200227", 3) == "20200301"
    for offset in (2, -3, 1, -1, 0):
        got = spark.range(1).select(src.date_window_column(F.lit("20200301"), offset)).collect()[0][0]
        assert got == src.date_window("20200301", offset)


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [("a", "20200101", "old"), ("a", "20200103", "new"), ("b", "20200102", "only"), ("a", "20200105", "late"), ("c", "20200103", None), ("c", "20200103", "z")],
        "k string, hhdw_etl_date string, v string",
    )


def test_load_modes(spark, rows, feed):
    dates = src.date_window("20200101", 3)
    assert rows(src.load_mode(feed, "F5", dates), "k", F.coalesce("v", F.lit(""))) == [("a", "new"), ("c", ""), ("c", "z")]
    assert src.load_mode(feed, "I", dates).count() == 5
    assert rows(src.load_mode(feed, "IU", dates, key=["k"]), "k", "v") == [("a", "new"), ("b", "only"), ("c", "z")]
    with pytest.raises(ValueError):
        src.load_mode(feed, "X", dates)


def test_newest_row_keeps_columns_and_survives_a_hot_key(spark, rows):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.struct("id").alias("s")
    )
    got = consolidate.latest_per_key(df, ["k"], "t")
    assert got.columns == df.columns
    assert got.count() == 13_334 and got.where("k = -1").collect()[0]["t"] == 19_998


def test_column_choice_and_projections(spark, rows, feed):
    df = spark.createDataFrame([("x ", None, [1], b"q")], "a string, my_chain_md5_x string, arr array<int>, raw binary")
    assert src.usable_columns(df) == ["a"]
    assert src.usable_columns(feed) == ["k", "v"]
    assert rows(src.normalized(df)) == [("x",)] and rows(src.blank_nulls(df)) == [("x ",)]
    assert src.key_tuples_nonblank(feed, ["k", "v"]).count() == 5
    assert src.key_tuples(feed, ["k", "v"], 2).count() == 2
    assert src.column_values(feed, "k", distinct=True).count() == 3
    assert rows(src.distinct_projection(feed, {"k": "key"})) == [("a",), ("b",), ("c",)]
    assert src.sample_rows(feed, 4, seed=1).count() == 4 and src.sample_rows(feed, "all").count() == 6


def test_list_tables(spark):
    for name in ("ods_a", "ods_b_old", "ods_bak", "dim_a"):
        spark.range(1).createOrReplaceTempView(name)
    assert [t for t in src.list_tables(spark, "default", "ods_")] == ["default.ods_a"]


def test_spread_leaves_small_inputs_alone(spark):
    small = spark.range(10)
    assert src.spread(small) is small


def test_result_store(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    fds = fd.fd_rows(spark, [(frozenset("a"), "b")], "s1", "t").unionAll(fd.fd_rows(spark, [(frozenset("a"), "c")], "007", "u"))
    tables = fds.select("sys_code", "table_code").distinct()
    store.save_fds(fds, tables, "1", "2020-01-01 00:00:00")
    store.append("fds", fd.fd_rows(spark, [(frozenset("x"), "y")], "s1", "v"))
    assert rows(store.read("fds"), "table_code") == [("t",), ("u",), ("v",)]
    store.delete("fds", tables.where("table_code = 't'"))
    assert rows(store.read("fds"), "sys_code", "table_code", "lhs") == [("007", "u", ["a"]), ("s1", "v", ["x"])]
    store.set_status(tables, "fd", "2", "2020-01-02 00:00:00", "2100-01-01 00:00:00")
    assert rows(store.status(), "table_code", "code") == [("t", "2"), ("u", "2")]
    store.delete("fds", store.read("fds").where("table_code = 'v'"))
    assert rows(store.read("fds"), "sys_code") == [("007",)]
    store.clear("fds")
    assert store.read("fds").count() == 0
    with pytest.raises(ValueError):
        store.read("secrets")


def test_saved_profile_and_keys(spark, rows, tmp_path):
    df = spark.createDataFrame([(str(i % 3), f"n{i}") for i in range(30)], "g string, n string")
    tables = {("s", "t"): df}
    prof = profile.profile_tables(tables)
    store = ResultStore(spark, str(tmp_path))
    store.save_profile(prof, profile.code_values(tables, prof), "2020-01-01 00:00:00")
    assert rows(store.read("code_values"), "col_code", "code_value") == [("g", "0"), ("g", "1"), ("g", "2")]
    assert rows(store.read("table_info"), "col_num") == [(2,)]
    assert rows(store.status(), "stage", "code") == [("feature", "1")]
    keys = spark.createDataFrame([("s", "t", "joint", 0, ["g", "n"])], "sys_code string, table_code string, kind string, group_code int, cols array<string>")
    todo = spark.createDataFrame([("s", "t"), ("s", "u"), ("s", "w")], "sys_code string, table_code string")
    store.save_keys(keys, todo, todo.where("table_code <> 'w'"), "2020-01-01 00:00:00")
    assert rows(store.status().where("stage = 'pk'"), "table_code", "code") == [("t", "1"), ("u", "3"), ("w", "2")]
    assert rows(store.read("joint_pk"), "cols") == [(["g", "n"],)]


def test_worklist(spark, rows):
    flags = ", ".join(f"{s}_flag string" for s in ("feature", "fd", "pk", "fk", "fd_check", "joint_fk"))
    sches = ", ".join(f"{s}_sche string" for s in ("feature", "fd", "pk", "fk", "fd_check", "joint_fk"))
    cases = {
        "new": "000000", "few": "020000", "late": "140000", "huge": "130000", "keyed": "111000", "mined": "110011", "off": "000000",
    }
    conf = spark.createDataFrame(
        [("s", t, *("0" * 6 if t == "off" else "1" * 6), "all", "s,x") for t in cases], f"sys_code string, table_code string, {flags}, fk_ana_mode string, joint_fk_ana_mode string"
    )
    status = spark.createDataFrame([("s", t, *c) for t, c in cases.items()], f"sys_code string, table_code string, {sches}")
    records = spark.createDataFrame([("s", "late", 399_999), ("s", "huge", 400_000)], "sys_code string, table_code string, records long")
    counts = spark.createDataFrame([("s", "mined", 10)], "sys_code string, table_code string, n_fds long")
    got = rows(worklist.worklist(conf, status, records, counts, full_rows=400_000), "table_code", "stage", "variant")
    assert got == [
        ("few", "fd_check", ""), ("few", "fd_full", ""), ("few", "fd_merge", ""), ("few", "feature", ""),
        ("huge", "fd_level2", "200000"), ("keyed", "fk", "all"), ("keyed", "joint_fk", "s,x"), ("late", "fd_level2", "all"),
        ("mined", "pk", "sql"), ("new", "fd_full", ""), ("new", "feature", ""),
    ]
    assert ("huge", "fd_level2", "all") in rows(worklist.worklist(conf, status, records, counts), "table_code", "stage", "variant")
    assert rows(worklist.fk_systems(conf, "x,s")) == [("s",)] and worklist.fk_systems(conf, "x").count() == 0


def test_same_fields(spark, rows, monkeypatch):
    n = 60
    people = spark.createDataFrame([(f"p{i:03d}", f"name{i:03d}", f"c{i % 7}x", "k") for i in range(n)], "id string, name string, city string, one string")
    visits = spark.createDataFrame(
        [(f"v{j:04d}", f"p{j % n:03d} ", f"name{j % n:03d}" if j % n else None, f"c{j % n % 7}x") for j in range(300)], "visit string, person string, label string, town string"
    )
    tables = {("s", "people"): people, ("s", "visits"): visits}
    prof = profile.profile_tables(tables)
    edge = spark.createDataFrame([("s", "people", "id", "s", "visits", "person", 1.0, n)], "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string, ratio double, parent_size long")
    from keyscout.operators.fk import named_fks
    from keyscout.plans.discovery import fds_of_tables

    fks = named_fks(edge)
    fds = fds_of_tables(spark, tables, 1)
    got = same.same_fields(tables, fks, fds, prof)
    named = sorted((r["left_node"][2:], r["right_node"][2:], r["rel_type"]) for r in got.collect())
    assert named == [
        ("people|city", "visits|town", "equals"), ("people|id", "visits|person", "fk"), ("people|name", "visits|label", "same"),
        ("people|name", "visits|town", "fd"), ("visits|label", "people|city", "fd"),
    ]
    fk_id = fks.collect()[0]["id"]
    twice = fks.unionByName(fks.withColumn("id", F.lit("again")))
    kept, keep = [], same.kept_table

    @contextmanager
    def watched(df):
        with keep(df) as table:
            kept.append(table.inputFiles())
            assert kept[-1]
            assert "Join" not in table._jdf.queryExecution().optimizedPlan().toString()
            yield table

    monkeypatch.setattr(same, "kept_table", watched)
    both = same.same_fields(tables, twice, fds, prof)
    assert len(kept) == 2  # each join is written once, and gone afterwards
    assert all(not Path(f.removeprefix("file:")).exists() for files in kept for f in files)
    assert sorted((r["left_node"], r["right_node"], r["rel_type"]) for r in both.where("fk_id = 'again'").collect()) == sorted((r["left_node"], r["right_node"], r["rel_type"]) for r in got.collect())
    assert same.same_fields(tables, fks, fds, prof, known_ids=[fk_id]).count() == 0
    only_fk = same.same_fields(tables, fks, fds.where("table_code = 'people'"), prof)
    assert rows(only_fk, "rel_type") == [("fk",)]


def test_replacing_keeps_the_old_version_until_the_new_one_counts(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    one = fd.fd_rows(spark, [(frozenset("a"), "b")], "s", "t")
    store.append("fds", one)
    store._write("fds", one.unionAll(one), "unnamed")  # a replacement that fails before it is named
    assert store.read("fds").count() == 1
    store.replace("fds", store.read("fds").unionByName(one))
    assert store.read("fds").count() == 2
    store.append("fds", one)
    assert store.read("fds").count() == 3


def test_outcomes_are_saved(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    key = "sys_code string, table_code string"
    todo = spark.createDataFrame([("s", t) for t in "abcd"], key)
    edge = ("s", "a", "x", "s", "b", "y", "a_x_b_y", 1.0, 5, "id")
    fks = spark.createDataFrame([edge], "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string, fk_name string, ratio double, parent_size bigint, id string")
    single, fit = spark.createDataFrame([("s", t) for t in "abd"], key), spark.createDataFrame([("s", t) for t in "ab"], key)
    store.save_fks(fks, todo, single, fit, "2020-01-01 00:00:00")
    assert rows(store.status(), "table_code", "code") == [("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")]
    assert store.read("fk_nodes").count() == 4 and store.read("fks").count() == 1
    joint = spark.createDataFrame([("g", "s", "a", "s", "b", [("x", "y"), ("u", "v")], 1.0, 5)], "group_id string, parent_sys string, parent_table string, child_sys string, child_table string, pairs array<struct<parent_col: string, child_col: string>>, ratio double, parent_size bigint")
    store.save_joint_fks(joint, todo, "2020-01-01 00:00:00")
    assert rows(store.status().where("stage = 'joint_fk'"), "table_code", "code") == [("a", "1"), ("b", "2"), ("c", "2"), ("d", "2")]
    fds = fd.fd_rows(spark, [(frozenset("a"), "b")], "s", "a")
    store.append("fds", fds.unionAll(fd.fd_rows(spark, [(frozenset("a"), "c")], "s", "b")))
    store.save_merged_fds(fds, todo.where("table_code IN ('a', 'b')"), "2020-01-01 00:00:00")
    assert rows(store.read("fds"), "table_code") == [("a",)]
    assert rows(store.status().where("stage = 'fd_check'"), "table_code", "code") == [("a", "1"), ("b", "2")]
    store.save_consolidated("t", fds)
    assert store.read_consolidated("t").count() == 1


def test_a_consolidated_table_may_be_derived_from_itself(spark, rows, tmp_path):
    from keyscout.operators.consolidate import latest_per_key

    store = ResultStore(spark, str(tmp_path))
    schema = "k string, v string, day string"
    store.save_consolidated("t", spark.createDataFrame([("a", "1", "20200101"), ("b", "1", "20200101")], schema))
    increment = spark.createDataFrame([("b", "2", "20200102"), ("c", "1", "20200102")], schema)
    store.save_consolidated("t", latest_per_key(store.read_consolidated("t").unionByName(increment), ["k"], "day"))
    assert rows(store.read_consolidated("t"), "k", "v") == [("a", "1"), ("b", "2"), ("c", "1")]
    # A save that fails before its version is named leaves the table as it was.
    increment.write.parquet(f"{tmp_path}/tables/t/v3")
    assert store.read_consolidated("t").count() == 3


def test_a_stage_is_saved_whole_and_once(spark, rows, tmp_path, monkeypatch):
    df = spark.createDataFrame([(str(i % 3), f"n{i}") for i in range(30)], "g string, n string")
    tables = {("s", "t"): df}
    prof = profile.profile_tables(tables)
    codes = profile.code_values(tables, prof)
    todo = spark.createDataFrame([("s", "t"), ("s", "few")], "sys_code string, table_code string")
    store = ResultStore(spark, str(tmp_path))
    write, failing = ResultStore._write, {"code_values"}

    def lose(self, name, df, run):
        if name in failing:
            raise RuntimeError("lost")
        write(self, name, df, run)

    monkeypatch.setattr(ResultStore, "_write", lose)
    with pytest.raises(RuntimeError):  # after the profile is written and before the code values are
        store.save_profile(prof, codes, "2020-01-01 00:00:00", todo)
    assert [store.read(n).count() for n in ("profile", "table_info", "code_values", "status")] == [0, 0, 0, 0]
    failing.clear()
    for _ in range(2):  # the retry, and a retry of the retry
        store.save_profile(prof, codes, "2020-01-01 00:00:00", todo)
        assert [store.read(n).count() for n in ("profile", "table_info", "code_values", "status")] == [2, 1, 3, 2]
    assert rows(store.status(), "table_code", "code") == [("few", "2"), ("t", "1")]
    store.save_profile(prof, codes, "2020-01-02 00:00:00", todo)  # another run, not a retry
    assert store.read("profile").count() == 4


def test_a_repeated_replacement_changes_nothing(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    todo = spark.createDataFrame([("s", "a"), ("s", "b")], "sys_code string, table_code string")
    one, two = fd.fd_rows(spark, [(frozenset("a"), "b")], "s", "a"), fd.fd_rows(spark, [(frozenset("x"), "y")], "s", "c")
    store.save_merged_fds(one, todo, "2020-01-01 00:00:00")
    store.append("fds", two)
    store.save_merged_fds(one.unionAll(one), todo, "2020-01-01 00:00:00")
    assert rows(store.read("fds"), "table_code") == [("a",), ("c",)]
    assert rows(store.status(), "table_code", "code") == [("a", "1"), ("b", "2")]


def test_relations_and_dimensions_are_saved(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    todo = spark.createDataFrame([("s", t) for t in ("a/b", "c", "d")], "sys_code string, table_code string")
    detail = spark.createDataFrame([("s|a%2Fb|x", "s|c|y", "1", "0", "fk")], same.DETAIL_SCHEMA)
    prof = spark.createDataFrame([("s", "a/b", "x", 3), ("s", "c", "y", 2)], "sys_code string, table_code string, col_code string, distinct long")
    for start in ("2020-01-01 00:00:00", "2020-01-02 00:00:00"):
        store.save_same_fields(detail, same.field_clusters(detail, prof), todo, start)
    assert store.read("same_detail").count() == 2 and rows(store.read("same_cluster"), "node") == [("s|a%2Fb|x",), ("s|c|y",)]
    assert rows(store.status(), "table_code", "code") == [("a/b", "1"), ("c", "1"), ("d", "2")]
    dims = spark.createDataFrame([("s", "c", "y", "s|c|y", "s|c|y", "fk", "0")], "sys_code string, table_code string, col_code string, dim_node string, origin_dim string, relation_type string, del_flag string")
    for start in ("2020-01-01 00:00:00", "2020-01-02 00:00:00"):
        store.save_dimensions(dims, todo, start)
    assert store.read("dim_result").count() == 1
    assert rows(store.status().where("stage = 'dim'"), "table_code", "code") == [("a/b", "2"), ("c", "1"), ("d", "2")]


def test_dated_folders_are_replaced_by_date_and_pruned(spark, rows, tmp_path):
    folder = f"{tmp_path}/dated"
    first = spark.createDataFrame([("a", "20200101"), ("b", "20200101"), ("c", "20200102"), ("d", "20200103")], "v string, day string")
    src.save_by_date(first, folder, "day")
    again = spark.createDataFrame([("e", "20200102")], "v string, day string")
    for _ in range(2):  # a repeated load changes nothing
        src.save_by_date(again, folder, "day")
    dated = src.read_by_date(spark, folder, "day")
    assert rows(dated, "v", "day") == [("a", "20200101"), ("b", "20200101"), ("d", "20200103"), ("e", "20200102")]
    window = src.load_mode(dated, "I", ["20200101", "20200102"], "day")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[day#\d+ IN \(20200101,20200102\)\]", plan)
    assert "PushedFilters: []" in plan and len(window.select(F.input_file_name()).distinct().collect()) == 2
    # The folder's own rows may be read for what replaces them.
    src.save_by_date(src.scan_by_dates(dated, "20200101", "day").withColumn("v", F.upper("v")), folder, "day")
    assert rows(src.read_by_date(spark, folder, "day"), "v") == [("A",), ("B",), ("d",), ("e",)]


def test_samples_have_their_exact_size(spark, monkeypatch):
    table = spark.range(30_000).select(F.col("id").cast("string").alias("v"))
    monkeypatch.setattr(src, "PREFIX_ROWS", 3)  # several rounds of prefixes
    for n in (0, 1, 500, 20_000, 29_999, 30_000, 40_000):
        drawn = src.sample_rows(table, n, seed=3)
        seen = drawn.agg(F.count("*").alias("n"), F.count_distinct("v").alias("d"), F.avg("v").alias("mean")).first()
        assert seen["n"] == seen["d"] == min(n, 30_000)
        if 500 <= n <= 20_000:
            assert abs(seen["mean"] - 15_000) < 5 * 8_660 / n**0.5
    copies = spark.range(5_000).select(F.lit("same").alias("v"))
    assert src.sample_rows(copies, 1_234).count() == 1_234
    assert src.sample_rows(table.limit(0), 5).count() == 0


def test_numbers_follow_the_order(spark, rows):
    from keyscout.operators.numbering import numbered

    table = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("other"))
    got = numbered(table, ["k"], "n")
    assert got.columns == ["k", "other", "n"]
    listed = sorted((r["n"], r["k"]) for r in got.collect())
    assert [n for n, _ in listed] == list(range(1, 9_001)) and [k for _, k in listed] == sorted(k for _, k in listed)
    few = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert sorted((r["n"], r["v"]) for r in numbered(few, ["v"], "n").collect()) == [(1, None), (2, "a"), (3, "b")]
    assert numbered(few.limit(0), ["v"], "n").count() == 0


def test_loads_choose_rows(spark, rows, feed):
    from keyscout.plans.discovery import Load, loaded

    dates = src.date_window("20200101", 3)
    tables = {("s", m): feed for m in ("F5", "I", "IU", "all")}
    got = loaded(tables, {("s", m): Load(m, dates, key=["k"]) for m in ("F5", "I", "IU")})
    assert rows(got[("s", "F5")], "k") == [("a",), ("c",), ("c",)] and got[("s", "I")].count() == 5
    assert rows(got[("s", "IU")], "k", "v") == [("a", "new"), ("b", "only"), ("c", "z")]
    assert [t.columns for t in got.values()] == [["k", "v"]] * 3 + [feed.columns]
