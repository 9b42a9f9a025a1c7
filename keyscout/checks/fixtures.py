"""Analysis inputs derived from the benchmark tables, as Spark frames and as SQL text.

The benchmark tables are clean and keyed by dense integers. What they lack (copies of a table
in another system, text keys, joint references) is derived here, the same way on both sides, by
projections and joins over whole tables. Three children of inclusions are row filters: invoice
documents (orders of status F), their archive (the urgent ones of these) and replies (assistant turns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout.sources.tables import TableKey, read_table, spread

COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "benchmark": ["item_id", "text"],
    "pages": ["page_id", "url", "html"],
    "embeddings": ["vec_id", "label"],
}
STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SYSTEM = "core"

SqlTables = dict[TableKey, tuple[str, list[str]]]


def frames(spark: SparkSession, folder: str, names: list[str]) -> dict[TableKey, DataFrame]:
    return {(SYSTEM, n): read_table(spark, folder, n) for n in names}


def sql_tables(names: list[str]) -> SqlTables:
    return {(SYSTEM, n): (n, COLUMNS[n]) for n in names}


# ---- text-keyed tables of several systems -----------------------------------------------

def linked_frames(spark: SparkSession, folder: str) -> dict[TableKey, DataFrame]:
    """Customers, their copy in a second system, invoices, documents of the invoices of status F, and an archive of the urgent ones."""
    customer = read_table(spark, folder, "customer")
    orders = read_table(spark, folder, "orders")
    number = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    invoice = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("INV"), number).alias("invoice_no"),
        F.col("c_name").alias("client"),
        F.col("c_mktsegment").alias("market"),
        F.col("o_orderstatus").alias("status"),
    )
    finished = orders.where(F.col("o_orderstatus") == "F")
    return {
        ("core", "customer"): customer,
        ("crm", "client"): customer.select(
            F.col("c_name").alias("client_name"), F.col("c_mktsegment").alias("segment")
        ),
        ("sales", "invoice"): invoice,
        ("sales", "invoice_doc"): finished.select(
            F.concat(F.lit("DOC"), number).alias("doc_no"),
            F.concat(F.lit("INV"), number).alias("invoice_ref"),
        ),
        ("arch", "archive"): finished.where(F.col("o_orderpriority") == "1-URGENT").select(
            F.concat(F.lit("DOC"), number).alias("doc"),
            F.col("o_orderpriority").alias("priority"),
        ),
    }


_NUMBER = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
LINKED_SQL: SqlTables = {
    ("core", "customer"): ("customer", COLUMNS["customer"]),
    ("crm", "client"): (
        "(SELECT c_name AS client_name, c_mktsegment AS segment FROM customer)", ["client_name", "segment"],
    ),
    ("sales", "invoice"): (
        f"(SELECT 'INV' || {_NUMBER} AS invoice_no, c_name AS client, c_mktsegment AS market, "
        "o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey)",
        ["invoice_no", "client", "market", "status"],
    ),
    ("sales", "invoice_doc"): (
        f"(SELECT 'DOC' || {_NUMBER} AS doc_no, 'INV' || {_NUMBER} AS invoice_ref "
        "FROM orders WHERE o_orderstatus = 'F')",
        ["doc_no", "invoice_ref"],
    ),
    ("arch", "archive"): (
        f"(SELECT 'DOC' || {_NUMBER} AS doc, o_orderpriority AS priority FROM orders "
        "WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')",
        ["doc", "priority"],
    ),
}


# ---- a joint reference ------------------------------------------------------------------

def thread_frames(spark: SparkSession, folder: str) -> dict[TableKey, DataFrame]:
    """Conversations, the assistant's turns in them under other names, labels and nations."""
    talks = read_table(spark, folder, "conversations")
    return {
        (SYSTEM, "conversations"): talks,
        ("desk", "replies"): talks.where(F.col("role") == "assistant").select(
            F.col("conv_id").alias("thread"), F.col("turn").alias("pos"), F.length("text").alias("size")
        ),
        (SYSTEM, "labels"): read_table(spark, folder, "labels"),
        (SYSTEM, "nation"): read_table(spark, folder, "nation"),
    }


THREAD_SQL: SqlTables = {
    (SYSTEM, "conversations"): ("conversations", COLUMNS["conversations"]),
    ("desk", "replies"): (
        "(SELECT conv_id AS thread, turn AS pos, length(text) AS size FROM conversations "
        "WHERE role = 'assistant')",
        ["thread", "pos", "size"],
    ),
    (SYSTEM, "labels"): ("labels", COLUMNS["labels"]),
    (SYSTEM, "nation"): ("nation", COLUMNS["nation"]),
}


# ---- a denormalised copy ----------------------------------------------------------------

def wide_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's fields, one of them padded and one blank in places."""
    customer = read_table(spark, folder, "customer")
    orders = read_table(spark, folder, "orders")
    return spread(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.concat("c_name", F.lit("  ")).alias("buyer"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("buyer_segment"),
            F.col("c_nationkey").cast("string").alias("buyer_nation"),
        )
    )


WIDE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "buyer", "buyer_segment", "buyer_nation"]
WIDE_SQL = (
    "(SELECT o_orderkey, o_custkey, o_orderstatus, c_name || '  ' AS buyer, "
    "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS buyer_segment, "
    "CAST(c_nationkey AS VARCHAR) AS buyer_nation "
    "FROM orders JOIN customer ON o_custkey = c_custkey)"
)


def dated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a load date."""
    return read_table(spark, folder, "events").withColumn("load_date", F.date_format("ts", "yyyyMMdd"))


DATED_EVENTS_SQL = "(SELECT *, strftime(ts, '%Y%m%d') AS load_date FROM events)"
