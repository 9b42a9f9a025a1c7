"""SQL building blocks for the independent checks, as named common table expressions."""

from __future__ import annotations

from itertools import combinations

from keyscout.checks.fixtures import SqlTables
from keyscout.functions import patterns

Ctes = list[tuple[str, str]]


def query(ctes: Ctes, select: str, recursive: bool = False) -> str:
    # Read many times over, so each is computed once; recursive ones cannot be told so.
    once = "" if recursive else "MATERIALIZED "
    body = ",\n".join(f"{name} AS {once}({sql})" for name, sql in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


def _full(pattern: str) -> str:
    return f"regexp_full_match(value, '{pattern}')"


def values_cte(tables: SqlTables) -> Ctes:
    """``vals``: every right-trimmed value with its field."""
    parts = [
        f"SELECT '{s}' AS sys_code, '{t}' AS table_code, '{c}' AS col_code, {i} AS col_num, "
        f"rtrim(coalesce(CAST({c} AS VARCHAR), '')) AS value FROM {source}"
        for (s, t), (source, columns) in tables.items()
        for i, c in enumerate(columns, start=1)
    ]
    return [("vals", " UNION ALL ".join(parts))]


_TIMESTAMP = (
    "(CASE length(clean) WHEN 14 THEN regexp_full_match(clean[1:8], '{d}') AND "
    "regexp_full_match(clean[9:10] || ':' || clean[11:12] || ':' || clean[13:14], '{t}') "
    "WHEN 18 THEN clean[5] = '-' AND clean[8] = '-' AND clean[13] = ':' AND clean[16] = ':' "
    "AND regexp_full_match(clean[1:10], '{d}') AND regexp_full_match(clean[11:18], '{t}') "
    "WHEN 22 THEN clean[5] = '-' AND clean[8] = '-' AND clean[13] = ':' AND clean[16] = ':' "
    "AND regexp_full_match(clean[1:10], '{d}') AND regexp_full_match(clean[11:18], '{t}') "
    "AND regexp_full_match(clean[19:], '{f}') "
    "WHEN 25 THEN clean[5] = '-' AND clean[8] = '-' AND clean[13] = ':' AND clean[16] = ':' "
    "AND regexp_full_match(clean[1:10], '{d}') AND regexp_full_match(clean[11:18], '{t}') "
    "AND regexp_full_match(clean[19:], '{f}') ELSE false END)"
)


def profile_ctes(tables: SqlTables) -> Ctes:
    """``vals``, ``hist``, ``marked``, ``counts`` and the full profile ``prof``."""
    stamp = _TIMESTAMP.format(d=patterns.DATE, t=patterns.TIME, f=patterns.FRACTION)
    kinds = ["integer", "float", "date", "time", "timestamp"]
    field = "sys_code, table_code, col_code, col_num"
    votes = list(patterns.VOTE_ORDER)
    best = f"greatest({', '.join(f'vote_{k}' for k in votes)})"
    vote = "CASE WHEN filled = 0 THEN NULL " + " ".join(
        f"WHEN vote_{k} = {best} THEN '{k}'" for k in votes
    ) + " END"
    rate = "CASE vote " + " ".join(f"WHEN '{k}' THEN is_{k} / filled" for k in kinds) + " ELSE 1.0 END"
    code = (
        "(NOT has_chinese AND max_len <= 10 AND filled <> filled_distinct "
        f"AND NOT regexp_matches(col_code, '{patterns.CODE_NAME_EXCLUSIONS}') "
        "AND ((filled > 1000 AND filled_distinct < 20) "
        "OR (filled > 100 AND filled <= 1000 AND filled_distinct < 10) "
        "OR (filled > 20 AND filled <= 100 AND filled_distinct < 5)))"
    )
    text = "CASE WHEN max_len = min_len THEN 'CHAR' ELSE 'VARCHAR' END"
    return values_cte(tables) + [
        ("hist", f"SELECT {field}, value, count(*) AS n FROM vals GROUP BY ALL"),
        (
            "marked",
            "SELECT *, "
            f"{_full(patterns.DATE)} AS b_date, {_full(patterns.TIME)} AS b_time, {stamp} AS b_timestamp, "
            f"{_full(patterns.FLOAT)} AS b_float, {_full(patterns.INTEGER)} AS b_integer, "
            f"regexp_matches(value, '{patterns.CHINESE}') AS b_chinese "
            "FROM (SELECT *, replace(replace(value, '/', '-'), ' ', '') AS clean FROM hist)",
        ),
        (
            "voted",
            "SELECT *, CASE WHEN b_date THEN 'date' WHEN b_time THEN 'time' WHEN b_timestamp THEN 'timestamp' "
            "WHEN b_float THEN 'float' WHEN b_integer THEN 'integer' ELSE 'character' END AS ballot FROM marked",
        ),
        (
            "counts",
            f"SELECT {field}, CAST(sum(n) AS BIGINT) AS records, count(*) AS \"distinct\", "
            "coalesce(CAST(sum(n) FILTER (value <> '') AS BIGINT), 0) AS filled, "
            "count(*) FILTER (value <> '') AS filled_distinct, "
            "coalesce(max(length(value)), 0) AS max_len, "
            "coalesce(min(length(value)) FILTER (value <> ''), 0) AS min_len, "
            "bool_or(b_chinese) AS has_chinese, "
            "max(TRY_CAST(replace(value, ',', '') AS DOUBLE)) FILTER (isfinite(TRY_CAST(replace(value, ',', '') AS DOUBLE))) AS max_number, "
            "max(TRY_CAST(replace(value, ',', '') AS DOUBLE) % 1.0) FILTER (isfinite(TRY_CAST(replace(value, ',', '') AS DOUBLE))) AS max_fraction, "
            + ", ".join(
                f"coalesce(CAST(sum(n) FILTER (value <> '' AND b_{k}) AS BIGINT), 0) AS is_{k}" for k in kinds
            )
            + ", "
            + ", ".join(
                f"coalesce(CAST(sum(n) FILTER (value <> '' AND ballot = '{k}') AS BIGINT), 0) AS vote_{k}"
                for k in votes
            )
            + f" FROM voted GROUP BY {field}",
        ),
        ("elected", f"SELECT *, {vote} AS vote FROM counts"),
        (
            "moments",
            f"SELECT {field}, avg(length(value)) AS avg_len, median(length(value)) AS median_len, "
            "var_samp(length(value)) AS var_len, "
            "CASE WHEN count(*) >= 3 THEN coalesce(skewness(length(value)), 0) END AS skew_len, "
            "CASE WHEN count(*) >= 4 THEN coalesce(kurtosis(length(value)), 0) END AS kurt_len "
            f"FROM vals WHERE value <> '' GROUP BY {field}",
        ),
        (
            "neighbours",
            "SELECT sys_code, table_code, col_code, v - lag(v) OVER "
            "(PARTITION BY sys_code, table_code, col_code ORDER BY v) AS step FROM "
            "(SELECT sys_code, table_code, col_code, TRY_CAST(value AS BIGINT) AS v FROM vals "
            f"WHERE {_full(patterns.DIGITS)}) WHERE v IS NOT NULL",
        ),
        (
            "steps",
            "SELECT sys_code, table_code, col_code, count(*) AS int_rows, count(*) FILTER (step = 1) AS steps "
            "FROM neighbours GROUP BY ALL",
        ),
        (
            "rated",
            f"SELECT *, CASE WHEN filled = 0 THEN 0.0 ELSE {rate} END AS data_type_rate FROM elected",
        ),
        (
            "typed",
            "SELECT *, CASE WHEN filled = 0 THEN 'UNK' "
            f"WHEN vote = 'character' OR data_type_rate < 0.9 THEN {text} "
            f"WHEN vote = 'integer' AND max_len > 12 THEN {text} "
            "WHEN vote = 'integer' THEN 'INTEGER' WHEN vote = 'float' THEN 'DECIMAL' "
            "ELSE upper(vote) END AS data_type FROM rated",
        ),
        (
            "prof",
            "SELECT t.sys_code, t.table_code, t.col_num, t.col_code, t.records, t.\"distinct\", t.max_len, t.min_len, "
            "coalesce(m.avg_len, 0) AS avg_len, coalesce(m.median_len, 0) AS median_len, "
            "CASE WHEN filled = 0 THEN 0 ELSE m.var_len END AS var_len, "
            "CASE WHEN filled = 0 THEN 0 ELSE m.skew_len END AS skew_len, "
            "CASE WHEN filled = 0 THEN 0 ELSE m.kurt_len END AS kurt_len, "
            "t.has_chinese, t.filled < t.records AS nullable, t.filled_distinct = 1 AS default_value, "
            "filled > 0 AND max_len = min_len AS fixed_length, "
            "coalesce(vote = 'integer' AND NOT (data_type_rate >= 0.9 AND max_len > 12) AND data_type_rate >= 0.75 "
            "AND int_rows > 1 AND steps / (int_rows - 1) >= 0.99, false) AS autoincrement, "
            "data_type, data_type_rate, "
            "CASE data_type WHEN 'CHAR' THEN 'CHARACTER' WHEN 'DECIMAL' THEN 'DOUBLE' WHEN 'DATE' THEN 'DATE' "
            "WHEN 'TIME' THEN 'TIME' WHEN 'TIMESTAMP' THEN 'TIMESTAMP' "
            "WHEN 'INTEGER' THEN CASE WHEN max_len <= 4 THEN 'SMALLINT' WHEN max_len >= 9 THEN 'BIGINT' "
            "ELSE 'INTEGER' END ELSE 'VARCHAR' END AS col_type, "
            "CASE WHEN data_type IN ('DATE', 'TIME', 'TIMESTAMP') THEN 'DATE' "
            f"WHEN data_type = 'INTEGER' THEN CASE WHEN {code} THEN 'CODE' ELSE 'NUM' END "
            "WHEN data_type = 'DECIMAL' THEN CASE WHEN max_number < 1 THEN 'RATE' "
            "WHEN max_fraction = 0 THEN 'NUM' WHEN max_number IS NOT NULL THEN 'AMOUNT' ELSE 'UNK' END "
            f"WHEN data_type IN ('CHAR', 'VARCHAR') AND {code} THEN 'CODE' ELSE 'UNK' END AS tech_cate, "
            "false AS col_pk "
            "FROM typed t LEFT JOIN moments m USING (sys_code, table_code, col_code) "
            "LEFT JOIN steps s USING (sys_code, table_code, col_code) WHERE t.records >= 5",
        ),
        (
            "eff",
            "SELECT *, CASE WHEN data_type_rate = 1.0 THEN col_type WHEN max_len = min_len THEN 'CHARACTER' "
            "ELSE 'VARCHAR' END AS effective_type FROM prof",
        ),
    ]


def fd_ctes(tables: SqlTables, max_lhs: int) -> Ctes:
    """``fds(sys_code, table_code, lhs, rhs, fd_level)`` by counting distinct combinations.

    ``lhs`` is comma-separated text of sorted names. Tables under five rows have no FDs.
    """
    ctes: Ctes = []
    unions = []
    for i, ((s, t), (source, columns)) in enumerate(tables.items()):
        cols = sorted(columns)
        texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in cols)
        ctes.append((f"t{i}", f"SELECT {texts} FROM {source}"))
        sizes = []
        for k in range(1, max_lhs + 2):
            for combo in combinations(cols, k):
                names = ", ".join(combo)
                listed = ", ".join(f"'{c}'" for c in combo)
                sizes.append(
                    f"SELECT [{listed}] AS cols, (SELECT count(*) FROM (SELECT DISTINCT {names} FROM t{i})) AS n"
                )
        ctes.append((f"sizes{i}", " UNION ALL ".join(sizes)))
        ctes.append(
            (f"const{i}", f"SELECT cols[1] AS c FROM sizes{i} WHERE len(cols) = 1 AND n = 1")
        )
        ctes.append(
            (
                f"holds{i}",
                f"SELECT a.cols AS lhs, list_filter(b.cols, lambda x: NOT list_contains(a.cols, x))[1] AS rhs "
                f"FROM sizes{i} a JOIN sizes{i} b ON len(b.cols) = len(a.cols) + 1 AND list_has_all(b.cols, a.cols) "
                f"AND a.n = b.n WHERE len(a.cols) <= {max_lhs} "
                f"AND NOT EXISTS (SELECT 1 FROM const{i} WHERE list_contains(b.cols, c))",
            )
        )
        unions.append(
            f"SELECT '{s}' AS sys_code, '{t}' AS table_code, '' AS lhs, c AS rhs, 0 AS fd_level "
            f"FROM const{i} WHERE (SELECT count(*) FROM t{i}) >= 5"
        )
        unions.append(
            f"SELECT '{s}', '{t}', array_to_string(h.lhs, ','), h.rhs, len(h.lhs) FROM holds{i} h "
            f"WHERE (SELECT count(*) FROM t{i}) >= 5 AND NOT EXISTS (SELECT 1 FROM holds{i} g "
            "WHERE g.rhs = h.rhs AND len(g.lhs) < len(h.lhs) AND list_has_all(h.lhs, g.lhs))"
        )
    ctes.append(("fds", " UNION ALL ".join(unions)))
    return ctes


def fk_ctes(tables: SqlTables, parent_rule: str, min_avg_len: float, skip_autoincrement: bool = False) -> Ctes:
    """``cand`` (column pairs by profile) and ``fks`` (those that hold on the data)."""
    auto = " AND NOT autoincrement" if skip_autoincrement else ""
    integers = "('INTEGER', 'SMALLINT', 'BIGINT')"
    return profile_ctes(tables) + [
        ("parents", f"SELECT * FROM eff WHERE ({parent_rule}) AND avg_len >= {min_avg_len}{auto}"),
        (
            "cand",
            "SELECT p.sys_code AS parent_sys, p.table_code AS parent_table, p.col_code AS parent_col, "
            "c.sys_code AS child_sys, c.table_code AS child_table, c.col_code AS child_col "
            "FROM parents p JOIN eff c ON c.min_len >= p.min_len AND c.max_len <= p.max_len "
            f"AND c.\"distinct\" <= p.\"distinct\" AND c.avg_len >= {min_avg_len} "
            f"AND ((p.effective_type IN {integers} AND c.effective_type IN {integers}) "
            "OR (p.effective_type = 'VARCHAR' AND c.effective_type IN ('CHARACTER', 'VARCHAR')) "
            f"OR (p.effective_type = c.effective_type)) WHERE p.table_code <> c.table_code",
        ),
        (
            "tested",
            "SELECT cand.*, count(*) AS child_distinct, count(*) FILTER (ch.value <> '') AS child_filled, "
            "count(ph.value) AS contained FROM cand "
            "JOIN hist ch ON ch.sys_code = child_sys AND ch.table_code = child_table AND ch.col_code = child_col "
            "LEFT JOIN hist ph ON ph.sys_code = parent_sys AND ph.table_code = parent_table "
            "AND ph.col_code = parent_col AND ph.value = ch.value AND ph.value <> '' GROUP BY ALL",
        ),
        (
            "fks",
            "SELECT parent_sys, parent_table, parent_col, child_sys, child_table, child_col, "
            "concat_ws('_', parent_table, parent_col, child_table, child_col) AS fk_name, "
            "contained / child_distinct AS ratio, "
            "(SELECT count(*) FROM hist h WHERE h.sys_code = parent_sys AND h.table_code = parent_table "
            "AND h.col_code = parent_col AND h.value <> '') AS parent_size FROM tested "
            "WHERE child_filled >= 3 AND contained / child_distinct >= 0.99",
        ),
    ]


TEXT_KEY_RULE = "records = \"distinct\" AND col_type IN ('CHARACTER', 'VARCHAR') AND NOT has_chinese"


def graph_ctes(tables: SqlTables) -> Ctes:
    """Foreign key and FD graph over text-keyed tables, up to main dimensions.

    For use with ``recursive=True``.
    """
    left = "parent_sys || '|' || parent_table || '|' || parent_col"
    right = "child_sys || '|' || child_table || '|' || child_col"
    return fk_ctes(tables, TEXT_KEY_RULE, 2.0) + fd_ctes(tables, 1) + [
        ("fk_edges", f"SELECT DISTINCT {left} AS \"left\", {right} AS \"right\" FROM fks"),
        (
            "fk_reach",
            "SELECT \"left\", \"right\" FROM fk_edges UNION SELECT r.\"left\", e.\"right\" "
            "FROM fk_reach r JOIN fk_edges e ON r.\"right\" = e.\"left\"",
        ),
        (
            "groups",
            "SELECT a.\"left\" AS node, array_to_string(list_sort(list_distinct(list_append(list(a.\"right\"), "
            "a.\"left\"))), '/') AS merged FROM fk_reach a JOIN fk_reach b ON a.\"left\" = b.\"right\" "
            "AND a.\"right\" = b.\"left\" WHERE a.\"left\" <> a.\"right\" GROUP BY a.\"left\"",
        ),
        (
            "all_edges",
            "SELECT \"left\", \"right\", 'FK' AS kind FROM fk_edges UNION SELECT sys_code || '|' || table_code || '|' "
            "|| lhs, sys_code || '|' || table_code || '|' || rhs, 'FD' FROM fds WHERE fd_level = 1",
        ),
        (
            "edges",
            "SELECT DISTINCT coalesce(l.merged, \"left\") AS \"left\", coalesce(r.merged, \"right\") AS \"right\", kind "
            "FROM all_edges LEFT JOIN groups l ON l.node = \"left\" LEFT JOIN groups r ON r.node = \"right\" "
            "WHERE coalesce(l.merged, \"left\") <> coalesce(r.merged, \"right\")",
        ),
        (
            "roots",
            "SELECT DISTINCT \"left\" AS node FROM edges WHERE kind = 'FK' AND \"left\" NOT IN "
            "(SELECT \"right\" FROM edges WHERE kind = 'FK')",
        ),
        (
            "walk",
            "SELECT node AS root, node, 'subset' AS member FROM roots UNION SELECT w.root, e.\"right\", "
            "CASE WHEN w.member = 'subset' AND e.kind = 'FK' THEN 'subset' ELSE 'attr' END "
            "FROM walk w JOIN edges e ON e.\"left\" = w.node",
        ),
        (
            "members",
            "SELECT root, node, 'attr' AS member FROM walk WHERE member = 'attr' "
            "UNION SELECT node, node, 'attr' FROM roots "
            "UNION SELECT root, node, 'subset' FROM walk w WHERE member = 'subset' AND NOT EXISTS "
            "(SELECT 1 FROM walk a WHERE a.root = w.root AND a.node = w.node AND a.member = 'attr')",
        ),
        (
            "in_table",
            "SELECT node, split_part(part, '|', 2) AS tab FROM (SELECT node, unnest(string_split(node, '/')) AS part FROM roots)",
        ),
        (
            "together",
            "SELECT node AS a, node AS b FROM roots UNION SELECT t.a, y.node FROM together t "
            "JOIN in_table x ON x.node = t.b JOIN in_table y ON y.tab = x.tab",
        ),
        ("dim_group", "SELECT a AS node, min(b) AS dim_group FROM together GROUP BY a"),
        (
            "held",
            "SELECT m.root, m.node, g.dim_group, rg.dim_group AS root_group FROM members m "
            "JOIN dim_group g ON g.node = m.node JOIN dim_group rg ON rg.node = m.root WHERE m.member = 'attr'",
        ),
        (
            "firsts",
            "SELECT node FROM roots WHERE node NOT IN (SELECT node FROM held WHERE dim_group <> root_group)",
        ),
        (
            "owners",
            "SELECT node, count(DISTINCT root_group) AS n_groups, min(root) AS owner FROM held "
            "WHERE root <> node AND root IN (SELECT node FROM firsts) GROUP BY node",
        ),
        (
            "names",
            "SELECT dim_group, array_to_string(list_sort(list(node)), '/') AS group_dim FROM dim_group GROUP BY dim_group",
        ),
        (
            "mains",
            "SELECT g.node, NOT (g.node NOT IN (SELECT node FROM firsts) AND coalesce(n_groups, 0) = 1) AS is_main, "
            "CASE WHEN g.node NOT IN (SELECT node FROM firsts) AND coalesce(n_groups, 0) = 1 THEN own.group_dim "
            "ELSE n.group_dim END AS dim FROM dim_group g JOIN names n ON n.dim_group = g.dim_group "
            "LEFT JOIN owners o ON o.node = g.node LEFT JOIN dim_group og ON og.node = o.owner "
            "LEFT JOIN names own ON own.dim_group = og.dim_group",
        ),
    ]
