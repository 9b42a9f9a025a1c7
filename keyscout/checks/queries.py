"""Registered queries: every operator over whole tables, with SQL for an independent check."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout.checks import fixtures as fx
from keyscout.checks import oracle as sql

from keyscout.operators import consolidate, dimension, fd, fk, graph, histogram, keys, profile, same, worklist
from keyscout.plans import discovery
from keyscout.session import cut_lineage, shared_folder
from keyscout.sources import fd_text, tables as src
from keyscout.sources.results import ResultStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

FIELD = "sys_code, table_code, col_code"
ALL = list(fx.COLUMNS)


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return add


def _profile(spark: SparkSession, folder: str, names: list[str] = ALL) -> DataFrame:
    return profile.profile_tables(fx.frames(spark, folder, names))


# ---- scans ------------------------------------------------------------------------------

@register(
    "scan_by_dates",
    f"SELECT event_id, user_id, load_date FROM {fx.DATED_EVENTS_SQL} WHERE load_date IN ('20240102', '20240105')",
)
def scan_by_dates(spark, folder):
    events = fx.dated_events(spark, folder)
    return src.scan_by_dates(events, ["20240105", "20240102"], "load_date").select("event_id", "user_id", "load_date")


_LATEST = (
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY load_date DESC, event_id DESC) AS rn "
    f"FROM {fx.DATED_EVENTS_SQL} WHERE load_date BETWEEN '20240101' AND '20240110'"
)


@register(
    "load_mode_snapshot",
    f"SELECT 'F5' AS load_mode, event_id FROM {fx.DATED_EVENTS_SQL} WHERE load_date = '20240110' UNION ALL "
    f"SELECT 'I', event_id FROM {fx.DATED_EVENTS_SQL} WHERE load_date BETWEEN '20240101' AND '20240110' UNION ALL "
    f"SELECT 'IU', event_id FROM ({_LATEST}) WHERE rn = 1",
)
def load_mode_snapshot(spark, folder):
    events = fx.dated_events(spark, folder)
    dates = src.date_window("20240101", 10)
    parts = [
        src.load_mode(events, mode, dates, "load_date", ["user_id"]).select(F.lit(mode).alias("load_mode"), "event_id")
        for mode in ("F5", "I", "IU")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "date_window",
    f"WITH e AS (SELECT * FROM {fx.DATED_EVENTS_SQL}) SELECT load_date, count(*) AS n FROM e "
    "WHERE strptime(load_date, '%Y%m%d') > (SELECT max(strptime(load_date, '%Y%m%d')) FROM e) - INTERVAL 7 DAY GROUP BY load_date",
)
def date_window(spark, folder):
    events = fx.dated_events(spark, folder)
    last = events.agg(F.max("load_date").alias("last"))
    dates = last.select(F.explode(src.date_window_column(F.col("last"), -7)).alias("load_date"))
    return events.join(dates, "load_date", "left_semi").groupBy("load_date").agg(F.count(F.lit(1)).alias("n"))


@register(
    "dated_source_window",
    f"WITH e AS (SELECT * FROM {fx.DATED_EVENTS_SQL}), last AS (SELECT max(strptime(load_date, '%Y%m%d')) AS day FROM e), "
    "loaded AS (SELECT event_id, load_date, CASE WHEN strptime(load_date, '%Y%m%d') > day - INTERVAL 3 DAY THEN 2 * value ELSE value END AS value, "
    "strptime(load_date, '%Y%m%d') AS loaded FROM e, last) "
    "SELECT load_date, count(*) AS n, round(sum(value), 2) AS total FROM loaded, last WHERE loaded > day - INTERVAL 7 DAY GROUP BY load_date",
)
def dated_source_window(spark, folder):
    """Events saved by load date, the last three dates loaded again with other values, then a window of seven dates."""
    events = fx.dated_events(spark, folder)
    last = events.agg(F.max("load_date")).first()[0]
    dated = f"{shared_folder(spark)}/dated-{uuid.uuid4().hex}"
    src.save_by_date(events, dated, "load_date")
    again = src.scan_by_dates(src.read_by_date(spark, dated, "load_date"), src.date_window(last, -3), "load_date")
    src.save_by_date(again.withColumn("value", 2 * F.col("value")), dated, "load_date")
    window = src.load_mode(src.read_by_date(spark, dated, "load_date"), "I", src.date_window(last, -7), "load_date")
    return window.groupBy("load_date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@register("sample_rows")
def sample_rows(spark, folder):
    return src.sample_rows(src.read_table(spark, folder, "lineitem"), 500, seed=7)


@register("column_values", "SELECT DISTINCT CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders")
def column_values(spark, folder):
    return src.column_values(src.read_table(spark, folder, "orders"), "o_orderdate", distinct=True)


@register(
    "key_tuples",
    "SELECT rtrim(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, rtrim(buyer) AS buyer, rtrim(buyer_segment) AS buyer_segment "
    f"FROM {fx.WIDE_SQL}",
)
def key_tuples(spark, folder):
    return src.key_tuples(fx.wide_orders(spark, folder), ["o_orderkey", "buyer", "buyer_segment"])


@register(
    "key_tuples_nonblank",
    "SELECT rtrim(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, rtrim(buyer_segment) AS buyer_segment "
    f"FROM {fx.WIDE_SQL} WHERE rtrim(buyer_segment) <> ''",
)
def key_tuples_nonblank(spark, folder):
    return src.key_tuples_nonblank(fx.wide_orders(spark, folder), ["o_orderkey", "buyer_segment"])


@register(
    "distinct_projection",
    "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS part, l_returnflag AS flag FROM lineitem",
)
def distinct_projection(spark, folder):
    return src.distinct_projection(
        src.read_table(spark, folder, "lineitem"), {"l_partkey": "part", "l_returnflag": "flag"}
    )


_FD_SET = ["customer", "orders", "supplier", "nation"]
_FD_CTES = sql.fd_ctes(fx.sql_tables(_FD_SET), 2)


def _fds(spark, folder, names=_FD_SET, max_lhs=2):
    return discovery.fds_of_tables(spark, fx.frames(spark, folder, names), max_lhs)


def _flat(fds: DataFrame) -> DataFrame:
    return fd_text.stored_fds(fds)


_FD_SELECT = "SELECT sys_code, table_code, lhs, rhs, fd_level FROM fds"


@register(
    "fd_text_source",
    sql.query(sql.fd_ctes(fx.sql_tables(["customer"]), 2), "SELECT lhs, rhs, fd_level FROM fds"),
)
def fd_text_source(spark, folder):
    lines = fd_text.fd_lines(_fds(spark, folder, ["customer"]))
    parsed = fd_text.parse_fd_lines(lines)
    return parsed.select(F.array_join("lhs", ",").alias("lhs"), "rhs", "fd_level")


@register("fds_by_level", sql.query(_FD_CTES, _FD_SELECT + " WHERE fd_level BETWEEN 2 AND 3"))
def fds_by_level(spark, folder):
    return _flat(fd.fds_by_level(_fds(spark, folder), 2, 3))


@register(
    "profile_slices",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        "SELECT sys_code, table_code, max(records) AS records, count(*) AS columns, "
        "coalesce(string_agg(col_code, ',' ORDER BY col_code) FILTER (max_len = 1), '') AS flag_columns "
        "FROM prof GROUP BY sys_code, table_code",
    ),
)
def profile_slices(spark, folder):
    return profile.profile_slices(_profile(spark, folder))


_LOG_SQL = (
    "(SELECT props AS sys_code, 't' || user_id AS table_code, event_type AS stage, "
    "CAST(value AS VARCHAR)[1:1] AS code, ts AS started, ts AS ended FROM events)"
)


def _status_log(spark, folder):
    """Events read as a status log: one system per property, one table per user."""
    return src.read_table(spark, folder, "events").select(
        F.col("props").alias("sys_code"),
        F.concat(F.lit("t"), F.col("user_id")).alias("table_code"),
        F.col("event_type").alias("stage"),
        F.col("value").cast("string").substr(1, 1).alias("code"),
        F.col("ts").alias("started"),
        F.col("ts").alias("ended"),
    )


@register(
    "latest_status",
    "SELECT sys_code, table_code, stage, code FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY sys_code, table_code, stage ORDER BY ended DESC) AS rn FROM {_LOG_SQL}) WHERE rn = 1",
)
def latest_status(spark, folder):
    latest = worklist.latest_status(_status_log(spark, folder))
    return latest.select("sys_code", "table_code", "stage", "code")


@register(
    "fd_delete",
    sql.query(
        _FD_CTES,
        _FD_SELECT + " f WHERE (SELECT count(*) FROM fds g WHERE g.table_code = f.table_code AND g.fd_level = 1) >= 8",
    ),
)
def fd_delete(spark, folder):
    fds = cut_lineage(_fds(spark, folder))
    singles = fds.groupBy("sys_code", "table_code").agg(F.count_if(F.col("fd_level") == 1).alias("n"))
    status = singles.select(
        "sys_code", "table_code", F.lit("1").alias("fd_sche"),
        F.when(F.col("n") < 8, "0").otherwise("1").alias("fd_check_sche"),
    )
    return _flat(fd.delete_fds(fds, fd.tables_with_wrong_fds(status)))


# ---- projections and predicates ---------------------------------------------------------

@register(
    "normalize",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, rtrim(coalesce(buyer, '')) AS buyer, "
    f"rtrim(coalesce(buyer_segment, '')) AS buyer_segment FROM {fx.WIDE_SQL}",
)
def normalize_(spark, folder):
    wide = fx.wide_orders(spark, folder).select("o_orderkey", "buyer", "buyer_segment")
    return src.normalized(wide)


@register(
    "type_votes",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        f"SELECT {FIELD}, filled, is_integer, is_float, is_date, is_time, is_timestamp, vote_integer, vote_float, "
        "vote_date, vote_time, vote_timestamp, vote_character, vote FROM elected",
    ),
)
def type_votes(spark, folder):
    return profile.type_votes(fx.frames(spark, folder, ALL))


@register(
    "has_chinese",
    sql.query(
        sql.values_cte(fx.sql_tables(ALL)),
        f"SELECT {FIELD}, bool_or(regexp_matches(value, '[一-龥]')) AS has_chinese FROM vals GROUP BY {FIELD}",
    ),
)
def has_chinese(spark, folder):
    return profile.has_chinese(fx.frames(spark, folder, ALL))


_WORK_SQL = (
    "WITH last AS (SELECT user_id, event_type, CAST(value AS VARCHAR)[1:1] AS code, row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events), "
    "st AS (SELECT user_id, coalesce(max(code) FILTER (event_type = 'view'), '0') AS feature_sche, "
    "coalesce(max(code) FILTER (event_type = 'click'), '0') AS fd_sche, "
    "coalesce(max(code) FILTER (event_type = 'error'), '0') AS pk_sche, "
    "coalesce(max(code) FILTER (event_type = 'purchase'), '0') AS fk_sche, "
    "coalesce(max(code) FILTER (event_type = 'signup'), '0') AS s6 FROM last WHERE rn = 1 GROUP BY user_id), "
    "j AS (SELECT CAST(c_nationkey AS VARCHAR) AS sys_code, 't' || c_custkey AS table_code, feature_sche, fd_sche, "
    "pk_sche, fk_sche, CASE WHEN s6 = '1' THEN '0' ELSE s6 END AS fd_check_sche, CASE WHEN s6 = '2' THEN '0' ELSE s6 END AS joint_fk_sche, "
    "CASE WHEN c_acctbal > 2000 THEN '1' ELSE '0' END AS f1, "
    "CASE WHEN c_mktsegment <> 'MACHINERY' THEN '1' ELSE '0' END AS f2, c_mktsegment AS mode, "
    "(SELECT CAST(sum(o_totalprice) AS BIGINT) FROM orders WHERE o_custkey = c_custkey) AS records, "
    "(SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_fds "
    "FROM customer JOIN st ON st.user_id = c_custkey) "
    "SELECT sys_code, table_code, 'feature' AS stage, '' AS variant FROM j WHERE f1 = '1' AND feature_sche = '0' "
    "UNION ALL SELECT sys_code, table_code, 'fd_full', '' FROM j WHERE f2 = '1' AND fd_sche IN ('0', '2') "
    "UNION ALL SELECT sys_code, table_code, 'fd_level2', 'all' FROM j "
    "WHERE f2 = '1' AND fd_sche IN ('3', '4') AND feature_sche = '1' AND records IS NOT NULL "
    "UNION ALL SELECT sys_code, table_code, s, '' FROM j, (SELECT unnest(['fd_merge', 'fd_check']) AS s) "
    "WHERE f1 = '1' AND fd_check_sche = '0' AND fd_sche = '2' "
    "UNION ALL SELECT sys_code, table_code, 'pk', CASE WHEN n_fds BETWEEN 1 AND 10000 THEN 'sql' ELSE 'search' END FROM j "
    "WHERE f1 = '1' AND fd_sche NOT IN ('0', '2', '3', '4') AND pk_sche = '0' "
    "UNION ALL SELECT sys_code, table_code, 'fk', mode FROM j WHERE f2 = '1' AND fk_sche = '0' AND pk_sche = '1' "
    "UNION ALL SELECT sys_code, table_code, 'joint_fk', mode FROM j WHERE f1 = '1' AND pk_sche = '1' AND joint_fk_sche = '0'"
)


@register("worklist", _WORK_SQL)
def worklist_(spark, folder):
    """Customers as configured tables, their events as status log, their orders as sizes."""
    customer = src.read_table(spark, folder, "customer")
    key = [F.col("c_nationkey").cast("string").alias("sys_code"), F.concat(F.lit("t"), F.col("c_custkey")).alias("table_code")]
    rich = F.when(F.col("c_acctbal") > 2000, "1").otherwise("0")
    other = F.when(F.col("c_mktsegment") != "MACHINERY", "1").otherwise("0")
    conf = customer.select(
        *key,
        *[rich.alias(f"{s}_flag") for s in ("feature", "pk", "fd_check", "joint_fk")],
        *[other.alias(f"{s}_flag") for s in ("fd", "fk")],
        F.col("c_mktsegment").alias("fk_ana_mode"), F.col("c_mktsegment").alias("joint_fk_ana_mode"),
    )
    # Which kind of event stands for which stage.
    stage_of = {"view": "feature", "click": "fd", "error": "pk", "purchase": "fk", "signup": "signup"}
    stage = F.create_map(*[F.lit(x) for kv in stage_of.items() for x in kv])[F.col("event_type")]
    log = src.read_table(spark, folder, "events").join(
        customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey"), "user_id"
    ).select(
        F.col("c_nationkey").cast("string").alias("sys_code"), F.concat(F.lit("t"), F.col("user_id")).alias("table_code"),
        stage.alias("stage"), F.col("value").cast("string").substr(1, 1).alias("code"),
        F.col("ts").alias("started"), F.col("ts").alias("ended"),
    )
    status = worklist.status_columns(worklist.latest_status(log), ("feature", "fd", "pk", "fk", "signup")).select(
        "*",
        F.when(F.col("signup_sche") == "1", "0").otherwise(F.col("signup_sche")).alias("fd_check_sche"),
        F.when(F.col("signup_sche") == "2", "0").otherwise(F.col("signup_sche")).alias("joint_fk_sche"),
    )
    per_table = (
        src.read_table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(*key).agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_fds"))
    )
    records = per_table.select("sys_code", "table_code", F.round("total").cast("bigint").alias("records"))
    return worklist.worklist(conf, status, records, per_table)


@register(
    "effective_type",
    sql.query(sql.profile_ctes(fx.sql_tables(ALL)), f"SELECT {FIELD}, col_type, effective_type FROM eff"),
)
def effective_type(spark, folder):
    typed = profile.effective_type(_profile(spark, folder))
    return typed.select("sys_code", "table_code", "col_code", "col_type", "effective_type")


@register(
    "informative_columns",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        f"SELECT {FIELD}, \"distinct\" AS n_distinct, max_len FROM prof WHERE \"distinct\" > 1 AND max_len <> 1",
    ),
)
def informative_columns(spark, folder):
    kept = profile.informative_columns(_profile(spark, folder))
    return kept.select("sys_code", "table_code", "col_code", F.col("distinct").alias("n_distinct"), "max_len")


# ---- joins ------------------------------------------------------------------------------

@register(
    "trimmed_key_join",
    f"SELECT o_orderkey, buyer, c_acctbal AS balance FROM {fx.WIDE_SQL} JOIN customer ON rtrim(buyer) = rtrim(c_name)",
)
def trimmed_key_join(spark, folder):
    left = fx.wide_orders(spark, folder).select("o_orderkey", "buyer")
    right = src.read_table(spark, folder, "customer").select("c_name", F.col("c_acctbal").alias("balance"))
    return same.trimmed_key_join(left, right, [("buyer", "c_name")]).select("o_orderkey", "buyer", "balance")


_KEY_RULE = (
    "records = \"distinct\" AND NOT has_chinese AND col_type NOT IN ('DOUBLE', 'TIMESTAMP', 'TIME', 'DATE')"
)
_FK_SET = [*fx.STAR, "events", "documents", "labels"]
_EDGE = "parent_sys, parent_table, parent_col, child_sys, child_table, child_col"


def _unique_fields(prof: DataFrame) -> DataFrame:
    """Verified keys, with every unique column standing for a candidate."""
    candidates = prof.where(F.col("records") == F.col("distinct")).select(
        "sys_code", "table_code", F.array("col_code").alias("key")
    )
    return keys.verify_single_keys(candidates, prof)


@register(
    "fk_candidates",
    sql.query(sql.fk_ctes(fx.sql_tables(_FK_SET), _KEY_RULE, 1.0), f"SELECT {_EDGE} FROM cand"),
)
def fk_candidates(spark, folder):
    prof = cut_lineage(_profile(spark, folder, _FK_SET))
    pairs = fk.fk_candidates(_unique_fields(prof), prof, min_avg_len=1.0)
    return pairs.where(F.col("parent_table") != F.col("child_table"))


# The references of the star schema.
REFERENCES = [
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("nation", "n_nationkey", "customer", "c_nationkey"),
    ("nation", "n_nationkey", "supplier", "s_nationkey"),
    ("region", "r_regionkey", "nation", "n_regionkey"),
    ("customer", "c_custkey", "events", "user_id"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
]
_REFERENCE_SQL = " UNION ALL ".join(
    f"SELECT '{fx.SYSTEM}' AS parent_sys, '{p}' AS parent_table, '{a}' AS parent_col, '{fx.SYSTEM}' AS child_sys, "
    f"'{c}' AS child_table, '{b}' AS child_col, (SELECT count(DISTINCT {a}) FROM {p}) AS parent_size, "
    f"(SELECT count(DISTINCT {b}) FROM {c}) AS child_distinct, "
    f"(SELECT count(DISTINCT {b}) FROM {c} WHERE {b} IN (SELECT {a} FROM {p})) AS contained"
    for p, a, c, b in REFERENCES
)


@register("inclusion_unary", f"SELECT *, round(contained / child_distinct, 9) AS ratio FROM ({_REFERENCE_SQL})")
def inclusion_unary(spark, folder):
    pairs = [(fx.SYSTEM, p, a, fx.SYSTEM, c, b) for p, a, c, b in REFERENCES]
    tables = fx.frames(spark, folder, sorted({t for p, _, c, _ in REFERENCES for t in (p, c)}))
    return fk.inclusion_unary(tables, pairs).drop("child_filled").withColumn("ratio", F.round("ratio", 9))


def _joint_sql(ptab: str, pcols: list[str], ctab: str, ccols: list[str]) -> str:
    cols = ", ".join(pcols)
    match = " AND ".join(f"p.{a} = c.{b}" for a, b in zip(pcols, ccols))
    label = ",".join(f"{a}:{b}" for a, b in zip(pcols, ccols))
    return (
        f"SELECT '{ptab}' AS parent_table, '{ctab}' AS child_table, '{label}' AS pairs, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {ptab})) AS parent_size, count(*) AS n_rows, "
        f"count(*) FILTER (EXISTS (SELECT 1 FROM {ptab} p WHERE {match})) AS contained FROM {ctab} c"
    )


# Column lists tested as joint references.
_JOINT = [
    ("orders", ["o_orderkey", "o_custkey"], "lineitem", ["l_orderkey", "l_partkey"]),
    ("lineitem", ["l_orderkey", "l_linenumber"], "lineitem", ["l_orderkey", "l_linenumber"]),
    ("lineitem", ["l_orderkey", "l_linenumber"], "conversations", ["conv_id", "turn"]),
    ("nation", ["n_nationkey", "n_regionkey"], "supplier", ["s_nationkey", "s_suppkey"]),
]


@register(
    "inclusion_nary",
    "SELECT *, round(contained / n_rows, 9) AS ratio FROM ("
    + " UNION ALL ".join(_joint_sql(*j) for j in _JOINT)
    + ")",
)
def inclusion_nary(spark, folder):
    tables = fx.frames(spark, folder, sorted({t for p, _, c, _ in _JOINT for t in (p, c)}))
    tested = fk.inclusion_nary(
        tables, [((fx.SYSTEM, p), pc, (fx.SYSTEM, c), cc) for p, pc, c, cc in _JOINT]
    )
    label = F.array_join(F.transform("pairs", lambda x: F.concat_ws(":", x["parent_col"], x["child_col"])), ",")
    return tested.select(
        "parent_table", "child_table", label.alias("pairs"), "parent_size", F.col("rows").alias("n_rows"), "contained",
        F.round("ratio", 9).alias("ratio"),
    )


@register(
    "fk_violations",
    "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS value FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def fk_violations(spark, folder):
    orders, lineitem = (src.read_table(spark, folder, t) for t in ("orders", "lineitem"))
    return fk.fk_violations(orders, "o_orderkey", lineitem, "l_orderkey")


_SEQUENCES = [("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("events", "user_id")]


@register(
    "autoincrement",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col_code, count(*) AS int_rows, count(*) FILTER (d = 1) AS steps, "
        f"round(count(*) FILTER (d = 1) / (count(*) - 1), 9) AS rate, "
        f"round(count(*) FILTER (d = 1) / (count(*) - 1), 12) >= 0.99 AS autoincrement "
        f"FROM (SELECT {c} - lag({c}) OVER (ORDER BY {c}) AS d FROM {t})"
        for t, c in _SEQUENCES
    ),
)
def autoincrement(spark, folder):
    parts = [profile.autoincrement(src.read_table(spark, folder, t), c) for t, c in _SEQUENCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rate", F.round("rate", 9))


# ---- aggregations -----------------------------------------------------------------------

@register(
    "row_count",
    "SELECT 'lineitem' AS what, count(*) AS records FROM lineitem UNION ALL "
    f"SELECT 'events', count(*) FROM {fx.DATED_EVENTS_SQL} WHERE load_date IN ('20240103', '20240104')",
)
def row_count(spark, folder):
    whole = histogram.row_count(src.read_table(spark, folder, "lineitem"))
    dated = histogram.row_count_by_dates(fx.dated_events(spark, folder), ["20240103", "20240104"], "load_date")
    return whole.select(F.lit("lineitem").alias("what"), "records").unionByName(
        dated.select(F.lit("events").alias("what"), "records")
    )


@register(
    "distinct_count",
    sql.query(
        sql.values_cte(fx.sql_tables(["lineitem"])),
        "SELECT col_code, count(DISTINCT value) AS n_distinct FROM vals GROUP BY col_code",
    ),
)
def distinct_count(spark, folder):
    counts = histogram.distinct_count(src.read_table(spark, folder, "lineitem"))
    return counts.withColumnRenamed("distinct", "n_distinct")


@register(
    "length_range",
    sql.query(
        sql.values_cte({("", "w"): (fx.WIDE_SQL, fx.WIDE_COLUMNS), ("", "d"): ("documents", fx.COLUMNS["documents"])}),
        "SELECT table_code, col_code, coalesce(min(length(value)) FILTER (value <> ''), 0) AS min_len, "
        "coalesce(max(length(value)) FILTER (value <> ''), 0) AS max_len FROM vals GROUP BY table_code, col_code",
    ),
)
def length_range(spark, folder):
    wide = histogram.length_range(fx.wide_orders(spark, folder)).withColumn("table_code", F.lit("w"))
    docs = histogram.length_range(src.read_table(spark, folder, "documents")).withColumn("table_code", F.lit("d"))
    return wide.unionByName(docs)


@register(
    "default_value",
    sql.query(
        sql.values_cte({("", "w"): (
            "(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS done, '' AS nothing, 'x ' AS same FROM orders)",
            ["o_orderkey", "done", "nothing", "same"],
        )}),
        "SELECT col_code, count(DISTINCT value) FILTER (value <> '') = 1 AS default_value FROM vals GROUP BY col_code",
    ),
)
def default_value(spark, folder):
    orders = src.read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "F").alias("done"),
        F.lit("").alias("nothing"),
        F.lit("x ").alias("same"),
    )
    return histogram.default_value(orders)


@register(
    "distinct_tuples",
    f"SELECT count(*) AS tuples FROM (SELECT DISTINCT o_custkey, buyer_segment FROM {fx.WIDE_SQL} WHERE buyer_segment IS NOT NULL)",
)
def distinct_tuples(spark, folder):
    return histogram.distinct_tuples(fx.wide_orders(spark, folder), ["o_custkey", "buyer_segment"])


@register(
    "length_moments",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        f"SELECT {FIELD}, round(avg_len, 4) AS avg_len, round(median_len, 4) AS median_len, round(var_len, 2) AS var_len, "
        "round(skew_len, 4) AS skew_len, round(kurt_len, 4) AS kurt_len FROM moments",
    ),
)
def length_moments(spark, folder):
    stats = profile.length_moments(fx.frames(spark, folder, ALL))
    return stats.select(
        "sys_code", "table_code", "col_code",
        *[F.round(c, 2 if c == "var_len" else 4).alias(c) for c in ("avg_len", "median_len", "var_len", "skew_len", "kurt_len")],
    )


_WIDE_PAIRS = [("c_name", "buyer"), ("c_mktsegment", "buyer_segment"), ("nation_text", "buyer_nation"), ("c_mktsegment", "o_orderstatus")]
_WIDE_JOIN_SQL = (
    f"(SELECT w.*, c.c_name, c.c_mktsegment, CAST(c.c_nationkey AS VARCHAR) AS nation_text FROM {fx.WIDE_SQL} w "
    "JOIN customer c ON c.c_custkey = w.o_custkey)"
)


def _wide_join(spark, folder):
    customer = src.read_table(spark, folder, "customer")
    return fx.wide_orders(spark, folder).join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        *fx.WIDE_COLUMNS, "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation_text")
    )


@register(
    "columns_same",
    " UNION ALL ".join(
        f"SELECT '{a}' AS left_col, '{b}' AS right_col, count(*) FILTER (rtrim({a}) = rtrim({b})) > 1 AND "
        f"count(*) FILTER (rtrim({a}) <> rtrim({b})) = 0 AS same FROM {_WIDE_JOIN_SQL} WHERE rtrim({a}) <> '' AND rtrim({b}) <> ''"
        for a, b in _WIDE_PAIRS
    ),
)
def columns_same(spark, folder):
    return histogram.columns_same(_wide_join(spark, folder), _WIDE_PAIRS)


@register(
    "columns_equal",
    " UNION ALL ".join(
        f"SELECT '{a}' AS left_col, '{b}' AS right_col, "
        f"count(*) FILTER (rtrim(coalesce({a}, '')) = rtrim(coalesce({b}, ''))) > 1 AND "
        f"count(*) FILTER (rtrim(coalesce({a}, '')) <> rtrim(coalesce({b}, ''))) = 0 AS equals FROM {_WIDE_JOIN_SQL}"
        for a, b in _WIDE_PAIRS
    ),
)
def columns_equal(spark, folder):
    return histogram.columns_equal(_wide_join(spark, folder), _WIDE_PAIRS)


_FD_PAIRS = [("o_custkey", "buyer"), ("o_custkey", "buyer_nation"), ("buyer_nation", "buyer_segment"), ("o_orderkey", "buyer_segment"), ("buyer_segment", "o_custkey")]


@register(
    "pair_fd",
    " UNION ALL ".join(
        f"SELECT CASE WHEN ab = a THEN '{x}' ELSE '{y}' END AS left_col, CASE WHEN ab = a THEN '{y}' ELSE '{x}' END AS right_col, "
        f"CASE WHEN ab = a AND ab = b THEN 'bfd' ELSE 'fd' END AS rel_type FROM (SELECT count(DISTINCT coalesce(CAST({x} AS VARCHAR), '')) AS a, "
        f"count(DISTINCT coalesce(CAST({y} AS VARCHAR), '')) AS b, "
        f"count(DISTINCT (coalesce(CAST({x} AS VARCHAR), ''), coalesce(CAST({y} AS VARCHAR), ''))) AS ab FROM {fx.WIDE_SQL}) WHERE ab = a OR ab = b"
        for x, y in _FD_PAIRS
    ),
)
def pair_fd(spark, folder):
    return fd.pair_fd(fx.wide_orders(spark, folder), _FD_PAIRS)


@register(
    "code_values",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        "SELECT h.sys_code, h.table_code, h.col_code, h.value AS code_value FROM hist h JOIN prof p "
        "USING (sys_code, table_code, col_code) WHERE p.tech_cate = 'CODE' AND h.value <> ''",
    ),
)
def code_values(spark, folder):
    return profile.code_values(fx.frames(spark, folder, ALL))


_KEYED = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


@register(
    "key_cooccurrence",
    "WITH k AS ("
    + " UNION ".join(f"SELECT '{t}.{c}' AS key_word, CAST({c} AS VARCHAR) AS pk_value FROM {t}" for t, c in _KEYED.items())
    + "), s AS (SELECT pk_value, string_agg(key_word, ',' ORDER BY key_word) AS key_words FROM k GROUP BY pk_value HAVING count(*) > 1) "
    "SELECT key_words, count(*) AS n_values FROM s GROUP BY key_words",
)
def key_cooccurrence(spark, folder):
    keyed = src.keyed_values({f"{t}.{c}": (src.read_table(spark, folder, t), c) for t, c in _KEYED.items()})
    return histogram.key_cooccurrence(keyed)


@register(
    "fd_count_filter",
    sql.query(_FD_CTES, "SELECT sys_code, table_code, count(*) AS n_fds FROM fds GROUP BY ALL HAVING count(*) <= 10"),
)
def fd_count_filter(spark, folder):
    return fd.fd_count_filter(_fds(spark, folder), 10)


_DEGREES = (
    "SELECT sys_code, table_code, col_code, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, "
    "CASE WHEN sum(i) = 0 THEN 'L' WHEN sum(o) = 0 THEN 'R' ELSE 'LR' END AS side FROM ("
    "SELECT sys_code, table_code, unnest(string_split(lhs, ',')) AS col_code, 1 AS o, 0 AS i FROM fds WHERE lhs <> '' UNION ALL "
    "SELECT sys_code, table_code, rhs, 0, 1 FROM fds) GROUP BY ALL"
)


@register("fd_degrees", sql.query(_FD_CTES, _DEGREES))
def fd_degrees(spark, folder):
    return fd.fd_degrees(_fds(spark, folder))


@register(
    "latest_per_key",
    "SELECT event_id, user_id, event_type, value, load_date FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    f"ORDER BY load_date DESC, event_id DESC) AS rn FROM {fx.DATED_EVENTS_SQL} WHERE load_date BETWEEN '20240105' AND '20240125') WHERE rn = 1",
)
def latest_per_key(spark, folder):
    events = fx.dated_events(spark, folder)
    end = consolidate.consolidation_end("20240105", 20)
    newest = consolidate.latest_per_key(events, ["user_id", "event_type"], "load_date", "20240105", end)
    return newest.select("event_id", "user_id", "event_type", "value", "load_date")


# ---- profiles ---------------------------------------------------------------------------

@register(
    "value_histogram",
    sql.query(
        sql.values_cte(fx.sql_tables(["lineitem"])),
        "SELECT col_code, value, count(*) AS n FROM vals GROUP BY col_code, value",
    ),
)
def value_histogram(spark, folder):
    return histogram.value_histogram(src.read_table(spark, folder, "lineitem"))


_ROUNDED = {"avg_len": 4, "median_len": 4, "var_len": 2, "skew_len": 4, "kurt_len": 4, "data_type_rate": 9}
_PROFILE_SELECT = "SELECT " + ", ".join(
    f"round({c}, {_ROUNDED[c]}) AS {c}" if c in _ROUNDED else ('"distinct" AS n_distinct' if c == "distinct" else c)
    for c in profile.PROFILE_COLUMNS
) + " FROM prof"


def _rounded_profile(df: DataFrame) -> DataFrame:
    for c, digits in _ROUNDED.items():
        df = df.withColumn(c, F.round(c, digits))
    return df.withColumnRenamed("distinct", "n_distinct")


@register("profile_table", sql.query(sql.profile_ctes(fx.sql_tables(ALL)), _PROFILE_SELECT))
def profile_table(spark, folder):
    return _rounded_profile(_profile(spark, folder))


@register(
    "infer_type",
    sql.query(
        sql.profile_ctes(fx.sql_tables(ALL)),
        f"SELECT {FIELD}, data_type, round(data_type_rate, 9) AS data_type_rate, fixed_length, col_type FROM prof",
    ),
)
def infer_type(spark, folder):
    return _profile(spark, folder).select(
        "sys_code", "table_code", "col_code", "data_type", F.round("data_type_rate", 9).alias("data_type_rate"),
        "fixed_length", "col_type",
    )


@register("tech_category", sql.query(sql.profile_ctes(fx.sql_tables(ALL)), f"SELECT {FIELD}, tech_cate FROM prof"))
def tech_category(spark, folder):
    return _profile(spark, folder).select("sys_code", "table_code", "col_code", "tech_cate")


# ---- functional dependencies ------------------------------------------------------------

_L1 = [*fx.STAR, "events", "labels", "documents"]
_L2 = ["customer", "orders", "lineitem", "conversations"]
_L3 = ["customer", "orders", "part"]


@register("discover_fds_l1", sql.query(sql.fd_ctes(fx.sql_tables(_L1), 1), _FD_SELECT))
def discover_fds_l1(spark, folder):
    return _flat(_fds(spark, folder, _L1, 1))


@register("discover_fds_l2", sql.query(sql.fd_ctes(fx.sql_tables(_L2), 2), _FD_SELECT))
def discover_fds_l2(spark, folder):
    return _flat(_fds(spark, folder, _L2, 2))


@register("discover_fds_l3", sql.query(sql.fd_ctes(fx.sql_tables(_L3), 3), _FD_SELECT))
def discover_fds_l3(spark, folder):
    return _flat(_fds(spark, folder, _L3, 3))


# Dependencies to check.
_CHECKS = [("l_orderkey", "l_suppkey"), ("l_extendedprice,l_partkey", "l_quantity"), ("l_extendedprice,l_partkey", "l_orderkey"), ("l_orderkey,l_linenumber", "l_tax"), ("l_quantity,l_partkey", "l_extendedprice")]


@register(
    "check_fd",
    " UNION ALL ".join(
        f"SELECT '{','.join(sorted(x.split(',')))}' AS lhs, '{y}' AS rhs, (SELECT count(*) FROM (SELECT DISTINCT {x} FROM lineitem)) = "
        f"(SELECT count(*) FROM (SELECT DISTINCT {x}, {y} FROM lineitem)) AS holds"
        for x, y in _CHECKS
    ),
)
def check_fd(spark, folder):
    lineitem = src.read_table(spark, folder, "lineitem")
    return fd.check_fds(lineitem, [(x.split(","), y) for x, y in _CHECKS])


def _batches(spark, folder):
    orders = src.read_table(spark, folder, "orders")
    early = F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    return [
        cut_lineage(fd.discover_fds(half, 2, fx.SYSTEM, "orders")) for half in (orders.where(early), orders.where(~early))
    ]


_ORDER_COLUMNS = fx.COLUMNS["orders"]
_HALVES = {
    ("a", "orders"): ("(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01')", _ORDER_COLUMNS),
    ("b", "orders"): ("(SELECT * FROM orders WHERE NOT o_orderdate < TIMESTAMP '1998-06-01')", _ORDER_COLUMNS),
}


@register(
    "merge_fds",
    sql.query(
        sql.fd_ctes(_HALVES, 2)
        + [
            ("one", "SELECT string_split(lhs, ',') AS lhs, rhs FROM fds WHERE sys_code = 'a'"),
            ("two", "SELECT string_split(lhs, ',') AS lhs, rhs FROM fds WHERE sys_code = 'b'"),
            (
                "mix",
                "SELECT lhs, rhs FROM one INTERSECT SELECT lhs, rhs FROM two UNION "
                "SELECT list_sort(list_distinct(list_concat(x.lhs, y.lhs))), x.rhs FROM one x JOIN two y ON x.rhs = y.rhs "
                "AND list_has_any(x.lhs, y.lhs) WHERE (x.lhs, x.rhs) NOT IN (SELECT (lhs, rhs) FROM two) "
                "AND (y.lhs, y.rhs) NOT IN (SELECT (lhs, rhs) FROM one)",
            ),
        ],
        "SELECT 'core' AS sys_code, 'orders' AS table_code, array_to_string(m.lhs, ',') AS lhs, m.rhs, len(m.lhs) AS fd_level FROM mix m "
        "WHERE NOT EXISTS (SELECT 1 FROM mix s WHERE s.rhs = m.rhs AND len(s.lhs) < len(m.lhs) AND list_has_all(m.lhs, s.lhs))",
    ),
)
def merge_fds(spark, folder):
    return _flat(fd.merge_fds(*_batches(spark, folder)))


# ---- keys -------------------------------------------------------------------------------

_KEY_SET = ["customer", "orders", "supplier", "conversations"]


def _closure_sql() -> str:
    """Closures of all column pairs, by asking the data what each pair determines."""
    parts = []
    for t in _FD_SET:
        cols = sorted(fx.COLUMNS[t])
        for i, a in enumerate(cols):
            for b in cols[i + 1 :]:
                tests = ", ".join(
                    f"CASE WHEN (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {t})) = "
                    f"(SELECT count(*) FROM (SELECT DISTINCT {a}, {b}, {c} FROM {t})) THEN '{c}' END"
                    if c not in (a, b)
                    else f"'{c}'"
                    for c in cols
                )
                parts.append(
                    f"SELECT '{fx.SYSTEM}' AS sys_code, '{t}' AS table_code, '{a},{b}' AS start, "
                    f"array_to_string(list_filter([{tests}], lambda x: x IS NOT NULL), ',') AS closure"
                )
    return " UNION ALL ".join(parts)


@register("fd_closure", _closure_sql())
def fd_closure(spark, folder):
    tables = fx.frames(spark, folder, _FD_SET)
    columns = discovery.column_rows(spark, tables)
    other = columns.withColumnRenamed("col_code", "second")
    starts = (
        columns.join(other, ["sys_code", "table_code"])
        .where(F.col("col_code") < F.col("second"))
        .select("sys_code", "table_code", F.array("col_code", "second").alias("start"))
    )
    closed = keys.fd_closure(discovery.fds_of_tables(spark, tables, 2), starts)
    return closed.select(
        "sys_code", "table_code", F.array_join("start", ",").alias("start"), F.array_join("closure", ",").alias("closure")
    )


def _key_ctes(names: list[str]) -> sql.Ctes:
    """Candidate keys: column roles from FDs, coverage of each column set from the data."""
    from itertools import combinations

    ctes = sql.fd_ctes(fx.sql_tables(names), 3)
    columns, sets = [], []
    for i, t in enumerate(names):
        cols = sorted(fx.COLUMNS[t])
        columns += [f"SELECT '{t}' AS table_code, '{c}' AS col_code" for c in cols]
        for k in (1, 2, 3):
            for combo in combinations(cols, k):
                listed = ", ".join(f"'{c}'" for c in combo)
                sets.append(
                    f"SELECT '{t}' AS table_code, [{listed}] AS key, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(combo)} FROM t{i})) = "
                    f"(SELECT count(*) FROM (SELECT DISTINCT * FROM t{i})) AS covers"
                )
    return ctes + [
        ("columns_", " UNION ALL ".join(columns)),
        ("degrees", _DEGREES),
        (
            "sided",
            "SELECT c.table_code, c.col_code, coalesce(d.side, 'N') AS side FROM columns_ c LEFT JOIN degrees d "
            "ON d.table_code = c.table_code AND d.col_code = c.col_code WHERE c.table_code IN (SELECT table_code FROM fds)",
        ),
        (
            "roles",
            "SELECT s.table_code, s.col_code, CASE WHEN side = 'LR' AND NOT EXISTS (SELECT 1 FROM sided x WHERE x.table_code = s.table_code "
            "AND x.side = 'L') AND NOT EXISTS (SELECT 1 FROM fds f WHERE f.table_code = s.table_code AND f.fd_level = 1 AND f.rhs = s.col_code "
            "AND NOT EXISTS (SELECT 1 FROM fds g WHERE g.table_code = f.table_code AND g.fd_level = 1 AND g.lhs = f.rhs AND g.rhs = f.lhs)) "
            "THEN 'L' ELSE side END AS side FROM sided s",
        ),
        (
            "frames",
            "SELECT table_code, coalesce(list(col_code) FILTER (side = 'L'), []) AS l, coalesce(list(col_code) FILTER (side = 'N'), []) AS n, "
            "coalesce(list(col_code) FILTER (side = 'LR'), []) AS lr FROM roles GROUP BY table_code",
        ),
        ("sets", " UNION ALL ".join(sets)),
        (
            "ranked",
            "SELECT s.table_code, s.key, CASE WHEN list_has_all(key, n) AND list_has_all(list_concat(l, n), key) AND len(key) > len(n) "
            "THEN len(key) WHEN list_has_all(key, list_concat(l, n)) AND list_has_all(list_concat(l, n, lr), key) "
            "AND len(key) > len(l) + len(n) THEN 100 + len(key) END AS step FROM sets s JOIN frames f USING (table_code) WHERE covers",
        ),
        (
            "cands",
            "SELECT table_code, key FROM ranked r WHERE step = (SELECT min(step) FROM ranked q WHERE q.table_code = r.table_code)",
        ),
    ]


@register(
    "candidate_keys",
    sql.query(_key_ctes(_KEY_SET), "SELECT 'core' AS sys_code, table_code, array_to_string(key, ',') AS key FROM cands"),
)
def candidate_keys(spark, folder):
    tables = fx.frames(spark, folder, _KEY_SET)
    found = keys.candidate_keys(discovery.fds_of_tables(spark, tables), discovery.column_rows(spark, tables))
    return found.select("sys_code", "table_code", F.array_join(F.array_sort("key"), ",").alias("key"))


@register(
    "candidate_keys_sql",
    sql.query(
        sql.fd_ctes(fx.sql_tables(_KEY_SET), 3)
        + [
            ("columns_", " UNION ALL ".join(f"SELECT '{t}' AS table_code, {len(fx.COLUMNS[t])} AS n_cols" for t in _KEY_SET)),
            ("rules", "SELECT table_code, CASE WHEN lhs = '' THEN [] ELSE string_split(lhs, ',') END AS lhs, rhs FROM fds"),
            (
                "reached",
                "SELECT a.table_code, a.lhs AS key, count(DISTINCT b.rhs) + len(a.lhs) AS reach FROM (SELECT DISTINCT table_code, lhs FROM rules "
                "WHERE len(lhs) > 0) a JOIN rules b ON a.table_code = b.table_code AND list_has_all(a.lhs, b.lhs) "
                "AND NOT list_contains(a.lhs, b.rhs) GROUP BY a.table_code, a.lhs",
            ),
            ("best", "SELECT * FROM reached r WHERE reach = (SELECT max(reach) FROM reached q WHERE q.table_code = r.table_code)"),
        ],
        "SELECT 'core' AS sys_code, b.table_code, array_to_string(key, ',') AS key FROM best b JOIN columns_ c USING (table_code) "
        "WHERE reach = n_cols AND len(key) = (SELECT min(len(key)) FROM best q WHERE q.table_code = b.table_code)",
    ),
)
def candidate_keys_sql(spark, folder):
    tables = fx.frames(spark, folder, _KEY_SET)
    found = keys.candidate_keys_sql(discovery.fds_of_tables(spark, tables), discovery.column_rows(spark, tables))
    return found.select("sys_code", "table_code", F.array_join("key", ",").alias("key"))


@register(
    "verify_single_pk",
    sql.query(sql.profile_ctes(fx.sql_tables(ALL)), f"SELECT {FIELD} FROM prof WHERE {_KEY_RULE}"),
)
def verify_single_pk(spark, folder):
    """Every column of every table as a candidate."""
    prof = cut_lineage(_profile(spark, folder))
    return keys.verify_single_keys(prof.select("sys_code", "table_code", F.array("col_code").alias("key")), prof)


# Joint candidates to verify.
_JOINT_KEYS = [("conversations", ["conv_id", "turn"]), ("conversations", ["conv_id", "role"]), ("lineitem", ["l_linenumber", "l_orderkey"]), ("lineitem", ["l_extendedprice", "l_orderkey", "l_partkey"]), ("orders", ["o_custkey", "o_orderdate"]), ("orders", ["o_orderdate", "o_totalprice"])]


@register(
    "verify_joint_pk",
    "SELECT 'core' AS sys_code, table_code, key FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_code, '{','.join(k)}' AS key, (SELECT count(*) FROM {t}) AS r, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {t})) AS d"
        for t, k in _JOINT_KEYS
    )
    + ") WHERE r = d",
)
def verify_joint_pk(spark, folder):
    names = sorted({t for t, _ in _JOINT_KEYS})
    tables = fx.frames(spark, folder, names)
    prof = cut_lineage(profile.profile_tables(tables))
    candidates = spark.createDataFrame(
        [(fx.SYSTEM, t, k) for t, k in _JOINT_KEYS], "sys_code string, table_code string, key array<string>"
    )
    good = keys.verify_joint_keys(candidates, prof, tables)
    return good.select("sys_code", "table_code", F.array_join("key", ",").alias("key"))


@register(
    "discover_pk",
    sql.query(
        sql.profile_ctes(fx.sql_tables(_KEY_SET))
        + _key_ctes(_KEY_SET)
        + [
            (
                "ones",
                "SELECT c.table_code, c.key FROM cands c JOIN prof p ON p.table_code = c.table_code AND p.col_code = c.key[1] "
                f"WHERE len(c.key) = 1 AND {_KEY_RULE}",
            ),
            (
                "many",
                "SELECT c.table_code, c.key FROM cands c JOIN sets s ON s.table_code = c.table_code AND s.key = c.key WHERE len(c.key) > 1 "
                "AND c.table_code NOT IN (SELECT table_code FROM ones) AND NOT EXISTS (SELECT 1 FROM prof p WHERE p.table_code = c.table_code "
                "AND list_contains(c.key, p.col_code) AND (p.has_chinese OR p.nullable))",
            ),
        ],
        "SELECT 'core' AS sys_code, table_code, 'single' AS kind, array_to_string(key, ',') AS cols FROM ones UNION ALL "
        "SELECT 'core', table_code, 'joint', array_to_string(key, ',') FROM many",
    ),
)
def discover_pk(spark, folder):
    found = discovery.discover_pk(spark, fx.frames(spark, folder, _KEY_SET))
    return found.select("sys_code", "table_code", "kind", F.array_join("cols", ",").alias("cols"))


# ---- foreign keys -----------------------------------------------------------------------

_FK_SELECT = f"SELECT {_EDGE}, fk_name, round(ratio, 9) AS ratio, parent_size FROM fks"


def _star_fks(spark, folder):
    tables = fx.frames(spark, folder, _FK_SET)
    prof = cut_lineage(profile.profile_tables(tables))
    return fk.discover_fk(tables, _unique_fields(prof), prof, skip_autoincrement=False, min_avg_len=1.0)


@register("discover_fk", sql.query(sql.fk_ctes(fx.sql_tables(_FK_SET), _KEY_RULE, 1.0), _FK_SELECT))
def discover_fk(spark, folder):
    return _star_fks(spark, folder).drop("id").withColumn("ratio", F.round("ratio", 9))


@register(
    "fk_diagram_nodes",
    sql.query(
        sql.fk_ctes(fx.sql_tables(_FK_SET), _KEY_RULE, 1.0)
        + [("numbered", f"SELECT *, row_number() OVER (ORDER BY {_EDGE}) AS ref FROM fks WHERE parent_sys = child_sys")],
        "SELECT 'Ref_o' || ref AS node_code, fk_name AS node_name, 'o:Reference' AS node_type, 'Reference' AS parent_node_code, child_sys AS sys_code FROM numbered "
        "UNION ALL SELECT 'Ref_o' || ref, CAST(ref AS VARCHAR), 'c:Object', 'Diagram 1', child_sys FROM numbered "
        "UNION ALL SELECT child_table, CAST(ref AS VARCHAR), 'c:SourceSymbol', 'Diagram 1', child_sys FROM numbered "
        "UNION ALL SELECT parent_table, CAST(ref AS VARCHAR), 'c:DestinationSymbol', 'Diagram 1', child_sys FROM numbered",
    ),
)
def fk_diagram_nodes(spark, folder):
    return fk.fk_diagram_nodes(_star_fks(spark, folder))


def _store(spark: SparkSession) -> ResultStore:
    """An empty result store in the cluster's shared folder."""
    return ResultStore(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}")


_STARTED = "2024-01-01 00:00:00"


def _all_tables(prof: DataFrame) -> DataFrame:
    return prof.select("sys_code", "table_code").distinct()


@register(
    "saved_fk_results",
    sql.query(
        sql.fk_ctes(fx.sql_tables(_FK_SET), _KEY_RULE, 1.0),
        "SELECT t.sys_code, t.table_code, (SELECT count(*) FROM fks f WHERE f.parent_table = t.table_code) AS n_fks, "
        "CASE WHEN EXISTS (SELECT 1 FROM fks f WHERE f.parent_table = t.table_code) THEN '1' "
        f"WHEN EXISTS (SELECT 1 FROM prof p WHERE p.table_code = t.table_code AND ({_KEY_RULE}) AND avg_len >= 2) THEN '2' "
        f"WHEN NOT EXISTS (SELECT 1 FROM prof p WHERE p.table_code = t.table_code AND ({_KEY_RULE})) THEN '3' ELSE '4' END AS code, "
        "(SELECT 4 * count(*) FROM fks f WHERE f.parent_sys = f.child_sys) AS n_nodes "
        "FROM (SELECT DISTINCT sys_code, table_code FROM prof) t",
    ),
)
def saved_fk_results(spark, folder):
    """Foreign keys, diagram nodes and outcomes, written to a store and read back."""
    tables = fx.frames(spark, folder, _FK_SET)
    prof = cut_lineage(profile.profile_tables(tables))
    single = cut_lineage(_unique_fields(prof))
    fit = single.join(prof.where("avg_len >= 2"), ["sys_code", "table_code", "col_code"], "left_semi")
    fks = cut_lineage(fk.discover_fk(tables, single, prof, skip_autoincrement=False, min_avg_len=1.0))
    store = _store(spark)
    store.save_fks(fks, _all_tables(prof), single, fit, _STARTED)
    stored = store.read("fks").groupBy(F.col("parent_sys").alias("sys_code"), F.col("parent_table").alias("table_code")).agg(F.count("*").alias("n_fks"))
    status = store.status().where("stage = 'fk'").select("sys_code", "table_code", "code")
    return status.join(stored, ["sys_code", "table_code"], "left").select(
        "sys_code", "table_code", F.coalesce("n_fks", F.lit(0)).alias("n_fks"), "code", F.lit(store.read("fk_nodes").count()).alias("n_nodes")
    )


@register(
    "saved_key_flags",
    sql.query(
        sql.profile_ctes(fx.sql_tables(_FK_SET)),
        f"SELECT {FIELD}, {_KEY_RULE} AS col_pk, '1' AS code FROM prof",
    ),
)
def saved_key_flags(spark, folder):
    """Profiles written to a store, then marked with their single keys, and read back."""
    tables = fx.frames(spark, folder, _FK_SET)
    prof = cut_lineage(profile.profile_tables(tables))
    store = _store(spark)
    store.save_profile(prof, profile.code_values(tables, prof), _STARTED, _all_tables(prof))
    found = _unique_fields(prof).select("sys_code", "table_code", F.lit("single").alias("kind"), F.lit(0).alias("group_code"), F.array("col_code").alias("cols"))
    store.save_key_flags(found)
    status = store.status().where("stage = 'feature'").select("sys_code", "table_code", "code")
    return store.read("profile").join(status, ["sys_code", "table_code"]).select("sys_code", "table_code", "col_code", "col_pk", "code")


@register(
    "sample_is_drawn",
    "SELECT 500 AS n_rows, 0 AS outside",
)
def sample_is_drawn(spark, folder):
    """How many rows a random sample has, and how many of them the table does not have."""
    table = src.read_table(spark, folder, "lineitem")
    drawn = src.sample_rows(table, 500, seed=7)
    known = src.sample_rows(table).select(F.xxhash64(*table.columns).alias("row")).distinct().withColumn("known", F.lit(1))
    marked = drawn.select(F.xxhash64(*table.columns).alias("row")).join(known, "row", "left")
    return marked.agg(F.count("*").cast("int").alias("n_rows"), F.count_if(F.col("known").isNull()).cast("int").alias("outside"))


def _thread_sql() -> sql.Ctes:
    """Joint references to ``conversations(conv_id, turn)``, all in SQL."""
    integers = "('INTEGER', 'SMALLINT', 'BIGINT')"
    return sql.profile_ctes(fx.THREAD_SQL) + [
        (
            "cand",
            "SELECT p.col_code AS parent_col, c.sys_code AS child_sys, c.table_code AS child_table, c.col_code AS child_col "
            "FROM eff p JOIN eff c ON c.min_len >= p.min_len AND c.max_len <= p.max_len AND c.\"distinct\" <= p.\"distinct\" "
            f"AND c.avg_len >= 1 AND NOT c.nullable AND ((p.effective_type IN {integers} AND c.effective_type IN {integers}) "
            "OR p.effective_type = c.effective_type OR (p.effective_type = 'VARCHAR' AND c.effective_type = 'CHARACTER')) "
            "WHERE p.table_code = 'conversations' AND p.col_code IN ('conv_id', 'turn') AND c.table_code <> 'conversations'",
        ),
        (
            "whole",
            "SELECT child_sys, child_table FROM cand GROUP BY ALL HAVING count(DISTINCT parent_col) = 2",
        ),
        (
            "assigned",
            "SELECT a.child_sys, a.child_table, a.child_col AS conv_col, b.child_col AS turn_col FROM cand a JOIN cand b "
            "ON a.child_sys = b.child_sys AND a.child_table = b.child_table AND a.child_col <> b.child_col "
            "WHERE a.parent_col = 'conv_id' AND b.parent_col = 'turn'",
        ),
    ]


def _thread_keys(spark):
    return spark.createDataFrame(
        [(fx.SYSTEM, "conversations", 0, ["conv_id", "turn"])],
        "sys_code string, table_code string, group_code int, cols array<string>",
    )


def _thread_candidates(spark, folder):
    prof = cut_lineage(profile.profile_tables(fx.thread_frames(spark, folder)))
    return fk.joint_fk_candidates(_thread_keys(spark), prof, min_avg_len=1.0)


@register("joint_fk_tables", sql.query(_thread_sql(), "SELECT child_sys, child_table, 2 AS key_size FROM whole"))
def joint_fk_tables(spark, folder):
    """Replies have the turns of assistants only."""
    return fk.joint_fk_tables(_thread_candidates(spark, folder)).select("child_sys", "child_table", "key_size")


@register(
    "joint_fk_assignments",
    sql.query(_thread_sql(), "SELECT child_sys, child_table, 'conv_id:' || conv_col || ',turn:' || turn_col AS pairs FROM assigned"),
)
def joint_fk_assignments(spark, folder):
    """Replies have the turns of assistants only."""
    label = F.array_join(F.transform("pairs", lambda x: F.concat_ws(":", x["parent_col"], x["child_col"])), ",")
    return fk.joint_fk_assignments(_thread_candidates(spark, folder)).select("child_sys", "child_table", label.alias("pairs"))


def _thread_test_sql() -> str:
    """Inclusion of every possible column pair of the child tables in the conversations' keys."""
    parts = []
    for (s, t), (source, columns) in fx.THREAD_SQL.items():
        if t == "conversations":
            continue
        for a in columns:
            for b in columns:
                if a != b:
                    parts.append(
                        f"SELECT '{s}' AS child_sys, '{t}' AS child_table, '{a}' AS conv_col, '{b}' AS turn_col, count(*) AS n_rows, "
                        f"count(*) FILTER (EXISTS (SELECT 1 FROM conversations k WHERE CAST(k.conv_id AS VARCHAR) = CAST({a} AS VARCHAR) "
                        f"AND CAST(k.turn AS VARCHAR) = CAST({b} AS VARCHAR))) AS contained FROM {source} c"
                    )
    return " UNION ALL ".join(parts)


_THREAD_FOUND = _thread_sql() + [
    ("checked", _thread_test_sql()),
    (
        "found",
        "SELECT child_sys, child_table, conv_col, turn_col, contained / n_rows AS ratio FROM checked JOIN assigned "
        "USING (child_sys, child_table, conv_col, turn_col) WHERE contained / n_rows >= 0.99",
    ),
]


def _thread_fks(spark, folder):
    tables = fx.thread_frames(spark, folder)
    prof = cut_lineage(profile.profile_tables(tables))
    return fk.discover_joint_fk(tables, _thread_keys(spark), prof, min_avg_len=1.0)


@register(
    "discover_joint_fk",
    sql.query(
        _THREAD_FOUND,
        "SELECT 'core' AS parent_sys, 'conversations' AS parent_table, child_sys, child_table, "
        "'conv_id:' || conv_col || ',turn:' || turn_col AS pairs, round(ratio, 9) AS ratio, "
        "(SELECT count(*) FROM (SELECT DISTINCT conv_id, turn FROM conversations)) AS parent_size FROM found",
    ),
)
def discover_joint_fk(spark, folder):
    """Replies have the turns of assistants only."""
    label = F.array_join(F.transform("pairs", lambda x: F.concat_ws(":", x["parent_col"], x["child_col"])), ",")
    return _thread_fks(spark, folder).select(
        "parent_sys", "parent_table", "child_sys", "child_table", label.alias("pairs"), F.round("ratio", 9).alias("ratio"), "parent_size"
    )


@register(
    "joint_fk_groups",
    sql.query(
        _THREAD_FOUND,
        "SELECT 'conversations' AS parent_table, child_table, 'conv_id:' || conv_col || ',turn:' || turn_col AS pairs, 2 AS n_pairs FROM found",
    ),
)
def joint_fk_groups(spark, folder):
    """Replies have the turns of assistants only."""
    groups = fk.joint_fk_groups(fk.joint_fk_rows(cut_lineage(_thread_fks(spark, folder))))
    label = F.array_join(F.transform("pairs", lambda x: F.concat_ws(":", x["parent_col"], x["child_col"])), ",")
    return groups.select("parent_table", "child_table", label.alias("pairs"), F.size("pairs").alias("n_pairs"))


@register(
    "fk_tables",
    sql.query(
        sql.fk_ctes(fx.LINKED_SQL, sql.TEXT_KEY_RULE, 2.0)
        + [("joint", sql.query(_THREAD_FOUND, "SELECT child_sys, child_table FROM found"))],
        "SELECT parent_sys AS sys_code, parent_table AS table_code FROM fks UNION SELECT child_sys, child_table FROM fks "
        "UNION SELECT 'core', 'conversations' FROM joint UNION SELECT child_sys, child_table FROM joint",
    ),
)
def fk_tables(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these. Replies have the turns of assistants only."""
    linked, _ = _linked(spark, folder)
    return fk.fk_tables(linked, _thread_fks(spark, folder))


# ---- same fields ------------------------------------------------------------------------

def _linked(spark, folder):
    tables = fx.linked_frames(spark, folder)
    prof = cut_lineage(profile.profile_tables(tables))
    parents = prof.where(
        (F.col("records") == F.col("distinct")) & F.col("col_type").isin("CHARACTER", "VARCHAR") & ~F.col("has_chinese")
    )
    return cut_lineage(fk.discover_fk(tables, parents, prof)), prof


def _wide_tables(spark, folder):
    return {
        (fx.SYSTEM, "customer"): src.read_table(spark, folder, "customer"),
        ("sales", "wide"): fx.wide_orders(spark, folder),
    }


_WIDE_TABLES_SQL = {(fx.SYSTEM, "customer"): ("customer", fx.COLUMNS["customer"]), ("sales", "wide"): (fx.WIDE_SQL, fx.WIDE_COLUMNS)}


def _same_sql(kinds: str) -> str:
    """Relations after joining customers with the wide orders on the customer key."""
    lefts = [c for c in fx.COLUMNS["customer"] if c != "c_custkey"]
    rights = [c for c in fx.WIDE_COLUMNS if c != "o_custkey"]
    parts = []
    for a in lefts:
        for b in rights:
            x, y = f"coalesce(l_{a}, '')", f"coalesce(r_{b}, '')"
            parts.append(
                f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, count(*) FILTER (rtrim(l_{a}) <> '' AND rtrim(r_{b}) <> '' AND rtrim(l_{a}) = rtrim(r_{b})) AS eq, "
                f"count(*) FILTER (rtrim(l_{a}) <> '' AND rtrim(r_{b}) <> '' AND rtrim(l_{a}) <> rtrim(r_{b})) AS ne, "
                f"count(*) FILTER (rtrim({x}) = rtrim({y})) AS alleq, "
                f"max(length(rtrim(l_{a}))) FILTER (rtrim(l_{a}) <> '') AS hi_a, min(length(rtrim(l_{a}))) FILTER (rtrim(l_{a}) <> '') AS lo_a, "
                f"max(length(rtrim(r_{b}))) FILTER (rtrim(r_{b}) <> '') AS hi_b, min(length(rtrim(r_{b}))) FILTER (rtrim(r_{b}) <> '') AS lo_b, "
                f"count(DISTINCT {x}) AS da, count(DISTINCT {y}) AS db, count(DISTINCT ({x}, {y})) AS dab FROM j"
            )
    left_cols = ", ".join(f"CAST({c} AS VARCHAR) AS l_{c}" for c in fx.COLUMNS["customer"])
    reach = (
        "EXISTS (SELECT 1 FROM fds f WHERE f.table_code = 'wide' AND f.lhs = 'o_custkey' AND f.rhs = b)"
    )
    right_list = ["o_custkey", *rights]
    ctes = sql.profile_ctes(_WIDE_TABLES_SQL) + sql.fd_ctes(_WIDE_TABLES_SQL, 1) + [
        ("lj", f"SELECT DISTINCT {left_cols} FROM customer"),
        ("rj", "SELECT DISTINCT " + ", ".join(f"CAST({c} AS VARCHAR) AS r_{c}" for c in right_list if c not in ("o_orderkey", "o_orderstatus")) + f" FROM {fx.WIDE_SQL}"),
        ("j", "SELECT *, NULL::VARCHAR AS r_o_orderkey, NULL::VARCHAR AS r_o_orderstatus FROM lj JOIN rj ON rtrim(l_c_custkey) = rtrim(r_o_custkey)"),
        ("pairs", " UNION ALL ".join(parts)),
        (
            "usable",
            f"SELECT * FROM pairs WHERE {reach} AND (SELECT \"distinct\" > 1 AND max_len <> 1 FROM prof p WHERE p.table_code = 'customer' AND p.col_code = a) "
            "AND (SELECT \"distinct\" > 1 AND max_len <> 1 FROM prof p WHERE p.table_code = 'wide' AND p.col_code = b)",
        ),
        (
            "related",
            "SELECT a, b, da, db, dab, n, CASE WHEN hi_b <= hi_a AND lo_b >= lo_a AND eq > 1 AND ne = 0 THEN "
            "CASE WHEN alleq = n AND n > 1 THEN 'equals' ELSE 'same' END END AS rel FROM usable",
        ),
        (
            "rels",
            "SELECT 'core|customer|c_custkey' AS left_node, 'sales|wide|o_custkey' AS right_node, 'fk' AS rel_type UNION ALL "
            "SELECT 'core|customer|' || a, 'sales|wide|' || b, rel FROM related WHERE rel IS NOT NULL UNION ALL "
            "SELECT CASE WHEN dab = da THEN 'core|customer|' || a ELSE 'sales|wide|' || b END, "
            "CASE WHEN dab = da THEN 'sales|wide|' || b ELSE 'core|customer|' || a END, CASE WHEN dab = da AND dab = db THEN 'bfd' ELSE 'fd' END "
            "FROM related WHERE rel IS NULL AND n > 3 AND (dab = da OR dab = db)",
        ),
    ]
    return sql.query(ctes, f"SELECT left_node, right_node, '0' AS fk_type, rel_type FROM rels WHERE rel_type IN ({kinds})")


def _wide_detail(spark, folder, with_fd):
    tables = _wide_tables(spark, folder)
    prof = cut_lineage(profile.profile_tables(tables))
    edge = spark.createDataFrame(
        [(fx.SYSTEM, "customer", "c_custkey", "sales", "wide", "o_custkey", 1.0, 0)],
        "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string, ratio double, parent_size long",
    )
    fds = discovery.fds_of_tables(spark, tables, 1)
    return same.same_fields(tables, fk.named_fks(edge), fds, prof, with_fd=with_fd), prof


@register("same_fields", _same_sql("'fk', 'same', 'equals'"))
def same_fields(spark, folder):
    detail, _ = _wide_detail(spark, folder, with_fd=False)
    return detail.drop("fk_id")


@register("same_fields_fd", _same_sql("'fk', 'same', 'equals', 'fd', 'bfd'"))
def same_fields_fd(spark, folder):
    detail, _ = _wide_detail(spark, folder, with_fd=True)
    return detail.drop("fk_id")


def _joint_relations_sql() -> str:
    """Relations after joining conversations and replies on both key columns."""
    parts = " UNION ALL ".join(
        f"SELECT '{a}' AS a, count(*) AS n, count(*) FILTER (x <> '' AND y <> '' AND x = y) AS eq, count(*) FILTER (x <> '' AND y <> '' AND x <> y) AS ne, "
        "count(DISTINCT x) AS da, count(DISTINCT y) AS db, count(DISTINCT (x, y)) AS dab, "
        "max(length(x)) FILTER (x <> '') AS hi_a, min(length(x)) FILTER (x <> '') AS lo_a, max(length(y)) FILTER (y <> '') AS hi_b, min(length(y)) FILTER (y <> '') AS lo_b "
        f"FROM (SELECT coalesce({a}, '') AS x, coalesce(CAST(size AS VARCHAR), '') AS y FROM j) HAVING "
        f"(SELECT count(DISTINCT {a}) > 1 AND max(length({a})) <> 1 FROM conversations)"
        for a in ("role", "text")
    )
    return sql.query(
        [
            ("r", f"SELECT DISTINCT thread, pos, size FROM {fx.THREAD_SQL[('desk', 'replies')][0]}"),
            ("j", "SELECT c.role, c.text, r.size FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations) c JOIN r ON conv_id = thread AND turn = pos"),
            ("counted", f"SELECT * FROM ({parts}) WHERE (SELECT count(DISTINCT size) > 1 AND max(length(CAST(size AS VARCHAR))) <> 1 FROM r)"),
            ("verdicts", "SELECT *, hi_b <= hi_a AND lo_b >= lo_a AND eq > 1 AND ne = 0 AS alike FROM counted"),
        ],
        "SELECT 'core|conversations|conv_id' AS left_node, 'desk|replies|thread' AS right_node, 'pair' AS fk_id, '1' AS fk_type, 'fk' AS rel_type "
        "UNION ALL SELECT 'core|conversations|turn', 'desk|replies|pos', 'pair', '1', 'fk' "
        "UNION ALL SELECT 'core|conversations|' || a, 'desk|replies|size', 'pair', '1', CASE WHEN eq = n THEN 'equals' ELSE 'same' END FROM verdicts WHERE alike "
        "UNION ALL SELECT CASE WHEN dab = da THEN 'core|conversations|' || a ELSE 'desk|replies|size' END, "
        "CASE WHEN dab = da THEN 'desk|replies|size' ELSE 'core|conversations|' || a END, 'pair', '1', CASE WHEN dab = da AND dab = db THEN 'bfd' ELSE 'fd' END "
        "FROM verdicts WHERE NOT coalesce(alike, FALSE) AND n > 3 AND (dab = da OR dab = db)",
    )


@register("same_fields_joint", _joint_relations_sql())
def same_fields_joint(spark, folder):
    """A joint foreign key, beside one already analysed and one out of scope. Replies have the turns of assistants only."""
    tables = fx.thread_frames(spark, folder)
    prof = cut_lineage(profile.profile_tables(tables))
    pair = [("conv_id", "thread"), ("turn", "pos")]
    joint = spark.createDataFrame(
        [(i, fx.SYSTEM, "conversations", s, t, pair, 1.0, 0) for i, s, t in (("pair", "desk", "replies"), ("known", "desk", "replies"), ("outside", "far", "replies"))],
        "group_id string, parent_sys string, parent_table string, child_sys string, child_table string, "
        "pairs array<struct<parent_col: string, child_col: string>>, ratio double, parent_size long",
    )
    none = spark.createDataFrame([], "id string, parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string")
    scope = spark.createDataFrame(list(tables), "sys_code string, table_code string")
    fds = discovery.fds_of_tables(spark, tables, 2)
    return same.same_fields(tables, none, fds, prof, joint, scope, known_ids=["known"])


_LEFT = "parent_sys || '|' || parent_table || '|' || parent_col"
_RIGHT = "child_sys || '|' || child_table || '|' || child_col"


@register(
    "same_cluster",
    sql.query(
        sql.fk_ctes(fx.LINKED_SQL, sql.TEXT_KEY_RULE, 2.0)
        + [
            ("e", f"SELECT {_LEFT} AS a, {_RIGHT} AS b FROM fks UNION SELECT {_RIGHT}, {_LEFT} FROM fks"),
            ("reach", "SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a"),
            ("comp", "SELECT a AS node, min(b) AS component FROM reach GROUP BY a"),
        ],
        "SELECT dense_rank() OVER (ORDER BY component) AS category_same, node, 1 AS diff_flg, "
        "row_number() OVER (PARTITION BY component ORDER BY \"distinct\" DESC, node) AS dim_order FROM comp "
        "JOIN prof ON node = sys_code || '|' || table_code || '|' || col_code",
        recursive=True,
    ),
)
def same_cluster(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    fks, prof = _linked(spark, folder)
    detail = fks.select(
        F.concat_ws("|", "parent_sys", "parent_table", "parent_col").alias("left_node"),
        F.concat_ws("|", "child_sys", "child_table", "child_col").alias("right_node"),
        F.lit("fk").alias("rel_type"),
    )
    return same.field_clusters(detail, prof)


@register(
    "discover_schema",
    sql.query(
        sql.fk_ctes(fx.LINKED_SQL, sql.TEXT_KEY_RULE, 2.0),
        "SELECT parent_sys, parent_table, parent_col, child_sys, child_table, child_col, round(ratio, 9) AS ratio FROM fks",
    ),
)
def discover_schema(spark, folder):
    """Foreign keys of a whole analysis, in which customers come as a feed of two loads.

    The first load has other names for all customers. Of orders, invoice documents have those of status F only, and
    the archive the urgent ones of these.
    """
    tables = fx.linked_frames(spark, folder)
    name = (fx.SYSTEM, "customer")
    newest = tables[name].withColumn("day", F.lit("20240102"))
    tables[name] = newest.withColumn("day", F.lit("20240101")).withColumn("c_name", F.concat(F.lit("old "), "c_name")).unionByName(newest)
    loads = {name: discovery.Load("IU", ["20240101", "20240102"], "day", ["c_custkey"])}
    found = discovery.discover_schema(spark, tables, loads=loads)["fks"]
    return found.select(
        "parent_sys", "parent_table", "parent_col", "child_sys", "child_table", "child_col", F.round("ratio", 9).alias("ratio")
    )


# ---- graph and dimensions ---------------------------------------------------------------

_GRAPH = sql.graph_ctes(fx.LINKED_SQL)


def _relations(spark, folder, with_fds=True):
    fks, _ = _linked(spark, folder)
    tables = fx.linked_frames(spark, folder)
    fds = discovery.fds_of_tables(spark, tables, 1) if with_fds else spark.createDataFrame([], fd.FD_SCHEMA)
    return dimension.relation_edges(fds, fks)


@register("fk_closure", sql.query(_GRAPH, 'SELECT "left" AS left_node, "right" AS right_node FROM fk_reach', True))
def fk_closure(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    closed = graph.closure(_relations(spark, folder, with_fds=False))
    return closed.select(F.col("left").alias("left_node"), F.col("right").alias("right_node"))


@register("fk_mutual_groups", sql.query(_GRAPH, "SELECT node, merged FROM groups", True))
def fk_mutual_groups(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    return graph.mutual_groups(_relations(spark, folder, with_fds=False))


@register("root_nodes", sql.query(_GRAPH, "SELECT node FROM roots", True))
def root_nodes(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    return dimension.dim_roots(dimension.merged_relations(_relations(spark, folder, with_fds=False)))


def _dimension_parts(spark, folder):
    relations = dimension.merged_relations(_relations(spark, folder))
    roots = cut_lineage(dimension.dim_roots(relations))
    return roots, cut_lineage(dimension.dim_members(relations, roots))


@register("dim_members", sql.query(_GRAPH, "SELECT root, node, member FROM members", True))
def dim_members(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    return _dimension_parts(spark, folder)[1]


@register("dim_groups", sql.query(_GRAPH, "SELECT node, dim_group FROM dim_group", True))
def dim_groups(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    relations = dimension.merged_relations(_relations(spark, folder, with_fds=False))
    return dimension.dim_groups(cut_lineage(dimension.dim_roots(relations)))


@register("main_dimensions", sql.query(_GRAPH, "SELECT node, is_main, dim FROM mains", True))
def main_dimensions(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    roots, members = _dimension_parts(spark, folder)
    return dimension.main_dimensions(roots, members, cut_lineage(dimension.dim_groups(roots)))


@register(
    "dim_division",
    sql.query(
        _GRAPH
        + [
            ("placed", "SELECT DISTINCT m.node, d.dim, m.member FROM members m JOIN mains d ON d.node = m.root"),
            ("kinds", "SELECT node, dim, bool_or(member = 'attr') AS attr, bool_or(member = 'subset') AS subset FROM placed GROUP BY node, dim"),
            ("apart", "SELECT dim, attr, subset, unnest(string_split(node, '/')) AS field FROM kinds"),
        ],
        "SELECT DISTINCT split_part(field, '|', 1) AS sys_code, split_part(field, '|', 2) AS table_code, split_part(field, '|', 3) AS col_code, "
        "dim AS dim_node, dim AS origin_dim, CASE WHEN attr THEN 'attr' ELSE 'subset' END AS relation_type, "
        "CASE WHEN attr AND subset THEN '0' ELSE '1' END AS del_flag FROM apart",
        True,
    ),
)
def dim_division(spark, folder):
    """Of orders, invoice documents have those of status F only, and the archive the urgent ones of these."""
    return dimension.dim_division(_relations(spark, folder))
