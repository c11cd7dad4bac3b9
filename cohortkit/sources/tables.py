"""Named table scans (the only I/O the reference workbook has)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
)


# The driver tables' schemas (declared, so a scan needs no
# footer read to infer them when its DataFrame is defined).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
}


def read_table(spark: SparkSession, base_dir: str, name: str, infer_schema: bool = False) -> DataFrame:
    """Parquet scan of ``<base_dir>/<name>.parquet``.

    Uses the declared schema of a known table unless ``infer_schema``.
    Nothing is selected here: callers project, and Catalyst prunes the scan's
    ReadSchema to the columns a plan really uses and pushes filters into it.
    """
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    schema = None if infer_schema else TABLE_SCHEMAS.get(name)
    reader = spark.read.format("parquet")
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def require_columns(df: DataFrame, columns: Iterable[str], table: str = "input") -> DataFrame:
    """Fail early, with the names, when an input lacks columns an operator reads."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise ValueError(f"{table} is missing required columns: {', '.join(missing)}")
    return df
