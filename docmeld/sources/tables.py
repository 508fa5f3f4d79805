"""Static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Known schemas save a look into the files before each query.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")



def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A narrow table whose files give fewer splits than the session has cores, dealt by a hash of ``keys``.

    For tables before a step that costs much more than moving their rows. One with splits enough stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
