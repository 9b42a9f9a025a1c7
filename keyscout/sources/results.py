"""Result tables in a folder: append, replace, delete by key, read slices, status log.

Each result is a parquet table whose folders are runs, then systems where it has them. One commit may
write several results: its rows go to folders of a new run, and count only once a single row is added to
the list of commits, which names the run, its results, and the runs whose rows it replaces. A job that
fails before that row leaves every result as it was; a job that is repeated after it changes nothing,
because its key is in the list. A read takes the runs that count, which prunes folders. Rows of other
runs stay in the folder. Any number of jobs may append at once; of those that replace, one at a time.

Consolidated tables have versions of their own, listed in the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyscout.functions.text import node_part
from keyscout.operators.fk import fk_diagram_nodes
from keyscout.operators.keys import joint_key_rows, mark_keys
from keyscout.operators.worklist import latest_status

_EDGE = (
    "parent_sys string, parent_table string, parent_col string, child_sys string, child_table string, child_col string"
)

# The columns of each result.
SCHEMAS = {
    "profile": (
        "sys_code string, table_code string, col_num int, col_code string, records bigint, distinct bigint, "
        "max_len int, min_len int, avg_len double, median_len double, var_len double, skew_len double, "
        "kurt_len double, has_chinese boolean, nullable boolean, default_value boolean, fixed_length boolean, "
        "autoincrement boolean, data_type string, data_type_rate double, col_type string, tech_cate string, col_pk boolean"
    ),
    "table_info": "sys_code string, table_code string, col_num int",
    "code_values": "sys_code string, table_code string, col_code string, code_value string",
    "fds": "sys_code string, table_code string, lhs array<string>, rhs string, fd_level int",
    "joint_pk": "sys_code string, table_code string, group_code int, cols array<string>",
    "fks": f"{_EDGE}, fk_name string, ratio double, parent_size bigint, id string",
    "joint_fks": (
        "group_id string, parent_sys string, parent_table string, child_sys string, child_table string, "
        "pairs array<struct<parent_col: string, child_col: string>>, ratio double, parent_size bigint"
    ),
    "fk_nodes": "node_code string, node_name string, node_type string, parent_node_code string, sys_code string",
    "same_detail": "left_node string, right_node string, fk_id string, fk_type string, rel_type string",
    "same_cluster": "category_same int, node string, diff_flg int, dim_order int",
    "dim_result": (
        "sys_code string, table_code string, col_code string, dim_node string, origin_dim string, "
        "relation_type string, del_flag string"
    ),
    "status": "sys_code string, table_code string, stage string, code string, started timestamp, ended timestamp",
}


_COMMIT = "run string, key string, parts array<struct<name: string, replaced: array<string>>>"
_KEY = ["sys_code", "table_code"]


class ResultStore:
    """The results of an analysis under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, name: str) -> str:
        if name not in SCHEMAS:
            raise ValueError(f"unknown result {name!r}")
        return f"{self.folder}/{name}"

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def _listed(self, folder: str) -> int:
        listed = f"{folder}__versions"
        if not self._exists(listed):
            return 0
        return self.spark.read.schema("version int").parquet(listed).agg(F.max("version")).first()[0] or 0

    def _name_version(self, folder: str, version: int) -> None:
        self.spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{folder}__versions")

    def _commits(self) -> list:
        """All commits, one row each."""
        listed = f"{self.folder}/__commits"
        return self.spark.read.schema(_COMMIT).parquet(listed).collect() if self._exists(listed) else []

    def _live(self, name: str) -> list[str]:
        """The runs whose rows are the result."""
        parts = [(c["run"], p["replaced"]) for c in self._commits() for p in c["parts"] if p["name"] == name]
        gone = {run for _, replaced in parts for run in replaced}
        return sorted(run for run, _ in parts if run not in gone)

    def _write(self, name: str, df: DataFrame, run: str) -> None:
        columns = T.StructType.fromDDL(SCHEMAS[name]).names
        writer = df.select(*columns).write.mode("overwrite")
        if "sys_code" in columns:
            writer = writer.partitionBy("sys_code")
        writer.parquet(f"{self._path(name)}/run={run}")

    def commit(self, added: Mapping[str, DataFrame], replacing: Sequence[str] = (), key: str | None = None) -> bool:
        """Write some results together; those in ``replacing`` lose their earlier rows, which ``added`` may read.

        False if a commit with this ``key`` is already there; then nothing is written.
        """
        for name in added:
            self._path(name)
        if key is not None and any(c["key"] == key for c in self._commits()):
            return False
        replaced = {name: self._live(name) if name in replacing else [] for name in added}
        run = uuid.uuid4().hex
        for name, df in added.items():
            self._write(name, df, run)
        self._name_run(run, key, replaced)
        return True

    def _name_run(self, run: str, key: str | None, replaced: Mapping[str, list[str]]) -> None:
        row = self.spark.createDataFrame([(run, key, list(replaced.items()))], _COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/__commits")

    def append(self, name: str, df: DataFrame) -> None:
        self.commit({name: df})

    def replace(self, name: str, df: DataFrame) -> None:
        """Write a whole result anew; ``df`` may read the result it replaces."""
        self.commit({name: df}, [name])

    def read(self, name: str) -> DataFrame:
        path, live = self._path(name), self._live(name)
        if not live:
            return self.spark.createDataFrame([], SCHEMAS[name])
        # The explicit schema keeps system codes such as 007 text and lets a result be empty.
        rows = self.spark.read.schema(f"{SCHEMAS[name]}, run string").parquet(path)
        return rows.where(F.col("run").isin(live)).select(*T.StructType.fromDDL(SCHEMAS[name]).names)

    def delete(self, name: str, keys: DataFrame, on: Sequence[str] = ("sys_code", "table_code")) -> None:
        """Remove the rows whose key is among ``keys``."""
        kept = self.read(name).join(keys.select(*on).distinct(), list(on), "left_anti")
        self.replace(name, kept)

    def clear(self, name: str) -> None:
        self.replace(name, self.read(name).where(F.lit(False)))

    @staticmethod
    def _status_rows(tables: DataFrame, stage: str, code: str, started: str, ended: str | None = None) -> DataFrame:
        end = F.current_timestamp() if ended is None else F.to_timestamp(F.lit(ended))
        return tables.select(
            *_KEY, F.lit(stage).alias("stage"), F.lit(code).alias("code"),
            F.to_timestamp(F.lit(started)).alias("started"), end.alias("ended"),
        )

    def set_status(self, tables: DataFrame, stage: str, code: str, started: str, ended: str | None = None) -> None:
        """Append one status row per ``(sys_code, table_code)``."""
        self.append("status", self._status_rows(tables, stage, code, started, ended))

    def status(self) -> DataFrame:
        return latest_status(self.read("status"))

    def _save(
        self, stage: str, started: str, outcomes: Mapping[str, DataFrame],
        added: Mapping[str, DataFrame], replacing: Sequence[str] = (),
    ) -> bool:
        """Results and statuses (code to tables) of one stage in one commit.

        Its key is the stage, the start and a digest of the tables with a status, so a repeated job changes nothing
        and a later run, which starts at another time, is saved.
        """
        status = reduce(DataFrame.unionByName, [self._status_rows(t, stage, code, started) for code, t in outcomes.items()])
        told = status.select(F.xxhash64(*_KEY).cast("decimal(38,0)").alias("table")).distinct()
        digest = told.agg(F.sum("table"), F.count("*")).first()
        key = f"{stage} {started} {digest[0]} {digest[1]}"
        return self.commit({**added, "status": status}, replacing, key)

    def save_profile(self, profile: DataFrame, codes: DataFrame, started: str, tables: DataFrame | None = None) -> None:
        """Profiles, table sizes, code values and the stage's status.

        Of ``tables``, those without a profile had too few rows and get the code 2.
        """
        profiled = profile.select(*_KEY).distinct()
        outcomes = {"1": profiled}
        if tables is not None:
            outcomes["2"] = tables.select(*_KEY).join(profiled, _KEY, "left_anti")
        sizes = profile.groupBy(*_KEY).agg(F.max("col_num").alias("col_num"))
        self._save("feature", started, outcomes, {"profile": profile, "table_info": sizes, "code_values": codes})

    def save_fds(self, fds: DataFrame, tables: DataFrame, code: str, started: str) -> None:
        """FDs of ``tables`` and the mining status."""
        self._save("fd", started, {code: tables}, {"fds": fds})

    def save_keys(self, keys: DataFrame, tables: DataFrame, candidates: DataFrame, started: str) -> None:
        """Joint keys and, per table: 1 keys found, 2 no candidate, 3 none of them verified."""
        with_key = keys.select(*_KEY).distinct()
        with_candidate = candidates.select(*_KEY).distinct()
        rest = tables.join(with_key, _KEY, "left_anti")
        outcomes = {
            "1": with_key,
            "2": rest.join(with_candidate, _KEY, "left_anti"),
            "3": rest.join(with_candidate, _KEY, "left_semi"),
        }
        self._save("pk", started, outcomes, {"joint_pk": joint_key_rows(keys)})

    def save_key_flags(self, keys: DataFrame) -> None:
        """Marks single primary keys in the stored profile."""
        self.replace("profile", mark_keys(self.read("profile"), keys))

    def save_merged_fds(self, fds: DataFrame, tables: DataFrame, started: str) -> None:
        """Merged FDs in place of the tables' earlier ones; per table 1 if it has any, else 2."""
        tables = tables.select(*_KEY).distinct()
        others = self.read("fds").join(tables, _KEY, "left_anti")
        found = fds.select(*_KEY).distinct()
        outcomes = {"1": tables.join(found, _KEY, "left_semi"), "2": tables.join(found, _KEY, "left_anti")}
        self._save("fd_check", started, outcomes, {"fds": others.unionByName(fds.select(*others.columns))}, ["fds"])

    def save_fks(self, fks: DataFrame, tables: DataFrame, single_keys: DataFrame, fit_keys: DataFrame, started: str) -> None:
        """Foreign keys, diagram nodes and, per parent table, the outcome.

        1 found, 2 none, 3 no single primary key, 4 none of its primary keys fit for a search.
        """
        tables = tables.select(*_KEY)
        has, fit = single_keys.select(*_KEY).distinct(), fit_keys.select(*_KEY).distinct()
        found = fks.select(F.col("parent_sys").alias("sys_code"), F.col("parent_table").alias("table_code")).distinct()
        rest = tables.join(found, _KEY, "left_anti")
        outcomes = {
            "1": tables.join(found, _KEY, "left_semi"),
            "2": rest.join(fit, _KEY, "left_semi"),
            "3": rest.join(has, _KEY, "left_anti"),
            "4": rest.join(has, _KEY, "left_semi").join(fit, _KEY, "left_anti"),
        }
        known = self.read("fks")
        nodes = fk_diagram_nodes(known.unionByName(fks.select(*known.columns)))
        self._save("fk", started, outcomes, {"fks": fks, "fk_nodes": nodes}, ["fk_nodes"])

    def save_joint_fks(self, joint_fks: DataFrame, tables: DataFrame, started: str) -> None:
        """Joint foreign keys and, per parent table, 1 found or 2 none."""
        tables = tables.select(*_KEY)
        found = joint_fks.select(F.col("parent_sys").alias("sys_code"), F.col("parent_table").alias("table_code")).distinct()
        outcomes = {"1": tables.join(found, _KEY, "left_semi"), "2": tables.join(found, _KEY, "left_anti")}
        self._save("joint_fk", started, outcomes, {"joint_fks": joint_fks})

    def save_same_fields(self, detail: DataFrame, clusters: DataFrame, tables: DataFrame, started: str) -> None:
        """New relations beside the stored ones, all clusters anew and, per table, 1 if a relation names it, else 2."""
        tables = tables.select(*_KEY).distinct()
        nodes = detail.select(F.explode(F.array("left_node", "right_node")).alias("node"))
        named = nodes.select(node_part("node", 0).alias("sys_code"), node_part("node", 1).alias("table_code")).distinct()
        outcomes = {"1": tables.join(named, _KEY, "left_semi"), "2": tables.join(named, _KEY, "left_anti")}
        self._save("same", started, outcomes, {"same_detail": detail, "same_cluster": clusters}, ["same_cluster"])

    def save_dimensions(self, result: DataFrame, tables: DataFrame, started: str) -> None:
        """All dimensions anew and, per table, 1 if a field of it belongs to one, else 2."""
        tables = tables.select(*_KEY).distinct()
        placed = result.select(*_KEY).distinct()
        outcomes = {"1": tables.join(placed, _KEY, "left_semi"), "2": tables.join(placed, _KEY, "left_anti")}
        self._save("dim", started, outcomes, {"dim_result": result}, ["dim_result"])

    def save_consolidated(self, name: str, df: DataFrame) -> None:
        """The consolidated table of an insert and update feed, under its own name.

        Each save is a new version, so ``df`` may be derived from the table's earlier one.
        """
        folder = f"{self.folder}/tables/{name}"
        version = self._listed(folder) + 1
        df.write.mode("overwrite").parquet(f"{folder}/v{version}")
        self._name_version(folder, version)

    def read_consolidated(self, name: str) -> DataFrame:
        folder = f"{self.folder}/tables/{name}"
        return self.spark.read.parquet(f"{folder}/v{self._listed(folder)}")
