"""Adapter: the TPC-H-style orders and customer tables seen as raw applications, one per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.schemas import RAW

ORDERS = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp_ntz, o_orderpriority string"""
CUSTOMER = "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string"


def raw_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw applications, with NULLs in education, score and offer_history on purpose.

    One column more than ``RAW``: ``ordered_on``, a real date for cohorts that should not follow serial_no.

    The join carries no hint: Catalyst broadcasts customer only while its size is under the session's limit and
    sort-merges it beyond that, where adaptive execution splits a hot customer.
    """
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    key, status, price = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    graduate = F.col("c_mktsegment").isin("AUTOMOBILE", "FURNITURE", "MACHINERY")
    nation = F.col("c_nationkey") % 3
    columns = {
        "serial_no": key + 1,
        "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "education": F.when(key % 97 != 0, F.when(graduate, "Graduate").otherwise("Not Graduate")),
        "experience_years": F.col("o_custkey") % 4,
        "python_exp": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Yes").otherwise("No"),
        "internship": F.when(status == "P", "Yes").otherwise("No"),
        "score": F.when(key % 89 != 0, F.floor(price / 40)),
        "location": F.when(nation == 0, "Urban").when(nation == 1, "Semiurban").otherwise("Rural"),
        "salary_band": F.col("c_acctbal"),
        "offer_history": F.when(key % 83 != 0, F.when(status.isin("F", "P"), 1).otherwise(0)),
        "recruitment_status": F.when((status == "F") & (price > 100000), "Y").otherwise("N"),
    }
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    typed = [columns[f.name].cast(f.dataType).alias(f.name) for f in RAW]
    return joined.select(*typed, F.col("o_orderdate").cast("date").alias("ordered_on"))

