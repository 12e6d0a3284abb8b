"""Reading and writing files."""

from pyspark.sql import functions as F, types as T

from wardflow.queries.registry import query
from wardflow.session import scratch_dir
from wardflow.sources import files as I

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query("b_io1_parquet_partitions", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def _(t):
    path = scratch_dir(t.spark)
    I.write_parquet(t.orders.select(*COLS), path, partition_cols=["o_orderstatus"])
    where = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)
    return I.read_parquet(t.spark, path, columns=["o_orderkey", "o_totalprice"], where=where, schema=t.orders.select(*COLS).schema)


@query("b_io2_orc_round_trip", "SELECT o_orderkey, o_orderdate FROM orders")
def _(t):
    path = scratch_dir(t.spark)
    I.write_orc(t.orders.select(*COLS), path)
    return I.read_orc(t.spark, path, ["o_orderkey", "o_orderdate"])


def broken_csv(t):
    """Orders as text; the price of pending ones is not a number."""
    path = scratch_dir(t.spark)
    line = "concat_ws(';', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END, concat('\"', o_orderpriority, ';\"'))"
    t.orders.selectExpr(f"{line} AS value").write.text(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("priority", T.StringType())])
    return I.read_csv(t.spark, path, schema, sep=";", header=False)


query("b_io4_csv_read", "SELECT o_orderkey AS k, o_totalprice AS price, o_orderpriority || ';' AS priority FROM orders WHERE o_orderstatus <> 'P'")(lambda t: broken_csv(t)[0])
query("b_io4_csv_corrupt_lines", "SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) || ';n/a;\"' || o_orderpriority || ';\"' AS line FROM orders WHERE o_orderstatus = 'P'")(
    lambda t: broken_csv(t)[1].select("k", F.col(I.CORRUPT).alias("line"))
)


@query("b_io3_csv_round_trip", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || ' \"x\", y' END AS note FROM orders")
def _(t):
    path = scratch_dir(t.spark)
    rows = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderpriority, ' \"x\", y') END AS note")
    I.write_csv(rows, path, sep="|", null="NULL")
    return I.read_csv(t.spark, path, rows.schema, sep="|", null="NULL")[0]


@query("b_io5_xml_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = scratch_dir(t.spark)
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    I.write_xml(rows, path, "customer", "customers")
    return I.read_xml(t.spark, path, "customer", rows.schema)


@query("b_io6_schema_round_trip", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    schema = I.schema_from_json(I.schema_to_json(t.orders))
    return t.spark.read.schema(schema).parquet(f"{t.folder}/orders.parquet").select("o_orderkey", "o_totalprice")
