"""The given star-schema tables and their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.contract.model import Check, Column, Contract, Reference, Table
from cartloom.sources.files import parquet_table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]

STAR = Contract((
    Table(
        "region",
        (Column("r_regionkey", "int"), Column("r_name", "string", max_length=25)),
        primary_key=("r_regionkey",),
        uniques=(("r_name",),),
        checks=(Check.nonempty("r_name"),),
    ),
    Table(
        "nation",
        (Column("n_nationkey", "int"), Column("n_name", "string", max_length=25), Column("n_regionkey", "int")),
        primary_key=("n_nationkey",),
        references=(Reference("n_regionkey", "region", "r_regionkey"),),
        checks=(Check.nonempty("n_name"),),
    ),
    Table(
        "customer",
        (
            Column("c_custkey", "bigint"), Column("c_name", "string", max_length=25), Column("c_nationkey", "int"),
            Column("c_acctbal", "double"), Column("c_mktsegment", "string", max_length=10),
        ),
        primary_key=("c_custkey",),
        uniques=(("c_name",),),
        references=(Reference("c_nationkey", "nation", "n_nationkey"),),
        checks=(
            Check.nonempty("c_name"),
            Check.finite_amount("c_acctbal"),
            Check.one_of("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]),
        ),
    ),
    Table(
        "supplier",
        (
            Column("s_suppkey", "bigint"), Column("s_name", "string", max_length=25), Column("s_nationkey", "int"),
            Column("s_acctbal", "double"),
        ),
        primary_key=("s_suppkey",),
        references=(Reference("s_nationkey", "nation", "n_nationkey"),),
        checks=(Check.finite_amount("s_acctbal"),),
    ),
    Table(
        "part",
        (
            Column("p_partkey", "bigint"), Column("p_name", "string", max_length=12), Column("p_brand", "string", max_length=10),
            Column("p_type", "string", max_length=25), Column("p_size", "int"), Column("p_retailprice", "double"),
        ),
        primary_key=("p_partkey",),
        uniques=(("p_name",),),
        checks=(Check.finite_amount("p_retailprice"), Check.compare("p_size", "<= 45", "at_most_45")),
    ),
    Table(
        "orders",
        (
            Column("o_orderkey", "bigint"), Column("o_custkey", "bigint"), Column("o_orderstatus", "string", max_length=1),
            Column("o_totalprice", "double"), Column("o_orderdate", "timestamp_ntz"),
            Column("o_orderpriority", "string", max_length=15),
        ),
        primary_key=("o_orderkey",),
        references=(Reference("o_custkey", "customer", "c_custkey"),),
        checks=(
            Check.one_of("o_orderstatus", ["O", "F"]),
            Check.finite_amount("o_totalprice"),
            Check(
                "urgent_is_open",
                "CASE o_orderpriority WHEN '1-URGENT' THEN o_orderstatus = 'O' ELSE true END",
            ),
        ),
    ),
    Table(
        "lineitem",
        (
            Column("l_orderkey", "bigint"), Column("l_partkey", "bigint"), Column("l_suppkey", "bigint"),
            Column("l_linenumber", "int"), Column("l_quantity", "double"), Column("l_extendedprice", "double"),
            Column("l_discount", "double"), Column("l_tax", "double"), Column("l_returnflag", "string", max_length=1),
            Column("l_linestatus", "string", max_length=1), Column("l_shipdate", "timestamp_ntz"),
        ),
        primary_key=("l_orderkey", "l_linenumber"),
        references=(
            Reference("l_orderkey", "orders", "o_orderkey"),
            Reference("l_partkey", "part", "p_partkey"),
            Reference("l_suppkey", "supplier", "s_suppkey"),
        ),
        checks=(
            Check.compare("l_quantity", "> 0", "positive"),
            Check.compare("l_discount", "<> 0", "nonzero"),
            Check.one_of("l_returnflag", ["A", "N", "R"]),
            Check(
                "flag_follows_status",
                "CASE WHEN l_returnflag IN ('A', 'R') THEN l_linestatus = 'F' ELSE true END",
            ),
        ),
    ),
    Table(
        "events",
        (
            Column("event_id", "bigint"), Column("ts", "timestamp_ntz"), Column("user_id", "bigint"),
            Column("event_type", "string", max_length=20), Column("value", "double"), Column("props", "string"),
        ),
        primary_key=("event_id",),
        references=(Reference("user_id", "customer", "c_custkey"),),
        checks=(Check.nonempty("event_type"), Check.finite_amount("value")),
    ),
))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet_table(spark, folder, name)


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: table(spark, folder, name) for name in STAR.names}


def dec(column: str):
    """Exact amount of a double column with two decimals."""
    return F.col(column).cast("decimal(12,2)")


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Report exact decimal results as doubles, so that any client compares them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
