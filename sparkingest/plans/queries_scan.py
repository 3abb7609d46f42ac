"""Scans, corrupt records and schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkingest.config import CsvOptions, JsonOptions, ParquetOptions
from sparkingest.plans.catalog import cents, day, ddl, prepared, query, sql_cents, sql_day, table
from sparkingest.sources.files import (
    CORRUPT,
    csv_reader_options,
    discover_schema,
    read_csv,
    read_json,
    read_parquet,
)
from sparkingest.sources.schema import drift_frame, flatten_structs

ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
ORDERS_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    f"{sql_day('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"
)


def _orders(df):
    return df.withColumn("o_orderdate", day("o_orderdate"))


def orders_csv(spark, sf_dir):
    def land(path):
        table(spark, sf_dir, "orders").write.option("header", True).csv(path)

    return prepared(spark, sf_dir, "orders-csv", land)


def orders_json(spark, sf_dir):
    def land(path):
        table(spark, sf_dir, "orders").write.json(path)

    return prepared(spark, sf_dir, "orders-json", land)


def events_by_date(spark, sf_dir):
    def land(path):
        events = table(spark, sf_dir, "events").withColumn("date", day("ts"))
        events.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(path)

    return prepared(spark, sf_dir, "events-by-date", land)


@query("csv_strict", ORDERS_SQL)
def csv_strict(spark, sf_dir):
    return _orders(read_csv(spark, orders_csv(spark, sf_dir), ddl(ORDERS)))


@query(
    "csv_discovered",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, "
    f"{sql_day('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders",
)
def csv_discovered(spark, sf_dir):
    """The files look like BIGINT customer keys; the registered STRING is what comes out."""
    registered = ddl(ORDERS.replace("o_custkey BIGINT", "o_custkey STRING"))
    return _orders(read_csv(spark, orders_csv(spark, sf_dir), registered, discover=True))


@query(
    "csv_drift",
    """SELECT * FROM (VALUES
         ('o_region', 'missing', 'string', NULL),
         ('o_orderpriority', 'extra', NULL, 'string'),
         ('o_custkey', 'type mismatch', 'string', 'int'))
       AS t(field, kind, registered, observed)""",
)
def csv_drift(spark, sf_dir):
    """What the inference pass over the landed files reports against the registration."""
    path = orders_csv(spark, sf_dir)
    options = csv_reader_options(CsvOptions())
    observed = discover_schema(spark, "csv", path, options)
    registered = ddl(
        "o_orderkey INT, o_custkey STRING, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP, o_region STRING"
    )
    return drift_frame(spark, registered, observed)


_MESSY = CsvOptions(delimiter="|", quote="'", escape="\\", encoding="ISO-8859-1", null_value="NA")


@query(
    "csv_options",
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
              o_orderpriority || '|it''s "' || o_orderstatus || '" ' || chr(233) AS note
       FROM orders""",
)
def csv_options(spark, sf_dir):
    """Every option differs from its default; the text holds delimiter, quotes and an accent."""

    def land(path):
        note = F.concat("o_orderpriority", F.lit("|it's \""), "o_orderstatus", F.lit('" é'))
        (
            table(spark, sf_dir, "orders")
            .select(
                "o_orderkey",
                F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
                note.alias("note"),
            )
            .write.options(
                sep=_MESSY.delimiter,
                quote=_MESSY.quote,
                escape=_MESSY.escape,
                encoding=_MESSY.encoding,
                nullValue=_MESSY.null_value,
                header="true",
            )
            .csv(path)
        )

    path = prepared(spark, sf_dir, "orders-messy-csv", land)
    schema = ddl("o_orderkey BIGINT, o_custkey BIGINT, note STRING")
    return read_csv(spark, path, schema, _MESSY)


@query("csv_glob", ORDERS_SQL + " WHERE o_orderstatus IN ('F', 'O')")
def csv_glob(spark, sf_dir):
    def land(path):
        orders = table(spark, sf_dir, "orders").withColumn("feed", F.col("o_orderstatus"))
        orders.write.partitionBy("feed").option("header", True).csv(path)

    path = prepared(spark, sf_dir, "orders-feeds", land)
    return _orders(read_csv(spark, f"{path}/feed={{F,O}}/part-*.csv", ddl(ORDERS)))


@query("json_lines_strict", ORDERS_SQL)
def json_lines_strict(spark, sf_dir):
    return _orders(read_json(spark, orders_json(spark, sf_dir), ddl(ORDERS)))


@query("json_discovered", ORDERS_SQL)
def json_discovered(spark, sf_dir):
    return _orders(read_json(spark, orders_json(spark, sf_dir), ddl(ORDERS), discover=True))


@query(
    "schema_drift",
    """SELECT * FROM (VALUES
         ('c_region', 'missing', 'string', NULL),
         ('props', 'extra', NULL, 'string'),
         ('user_id', 'type mismatch', 'int', 'bigint'))
       AS t(field, kind, registered, observed)""",
)
def schema_drift_query(spark, sf_dir):
    """Inference reads every landed JSON record; names match without case."""

    def land(path):
        table(spark, sf_dir, "events").drop("ts").write.json(path)

    path = prepared(spark, sf_dir, "events-json", land)
    observed = discover_schema(spark, "json", path, {})
    registered = ddl(
        "EVENT_ID BIGINT, user_id INT, event_type STRING, value DOUBLE, c_region STRING"
    )
    return drift_frame(spark, registered, observed)


@query(
    "json_multiline",
    f"SELECT o_orderkey, o_custkey, {sql_cents('o_totalprice')} AS o_cents FROM orders",
)
def json_multiline(spark, sf_dir):
    """Files holding one array each; a file covers 4096 order keys, so it stays small."""

    def land(path):
        record = F.to_json(F.struct("o_orderkey", "o_custkey", cents("o_totalprice").alias("o_cents")))
        rows = table(spark, sf_dir, "orders").select(
            F.floor(F.col("o_orderkey") / 4096).alias("block"), record.alias("record")
        )
        arrays = rows.groupBy("block").agg(
            F.concat(
                F.lit("[\n  "), F.array_join(F.collect_list("record"), ",\n  "), F.lit("\n]")
            ).alias("value")
        )
        arrays.write.partitionBy("block").text(path)

    path = prepared(spark, sf_dir, "orders-json-arrays", land)
    schema = ddl("o_orderkey BIGINT, o_custkey BIGINT, o_cents BIGINT")
    return read_json(spark, f"{path}/*", schema, JsonOptions(multiline=True))


_NESTED = (
    "o_orderkey BIGINT, detail STRUCT<custkey: BIGINT, "
    "marks: STRUCT<priority: STRING, status: STRING>>"
)


def _nested_orders(spark, sf_dir):
    def land(path):
        marks = F.struct(
            F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
        )
        detail = F.struct(F.col("o_custkey").alias("custkey"), marks.alias("marks"))
        orders = table(spark, sf_dir, "orders").select("o_orderkey", detail.alias("detail"))
        orders.write.json(path)

    return prepared(spark, sf_dir, "orders-nested", land)


@query(
    "json_flatten",
    """SELECT o_orderkey, o_custkey AS detail_custkey,
              '{"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}'
                AS detail_marks
       FROM orders""",
)
def json_flatten(spark, sf_dir):
    """One level: the inner struct stays a struct and is shown as JSON text."""
    path = _nested_orders(spark, sf_dir)
    flat = read_json(spark, path, ddl(_NESTED), JsonOptions(flatten_depth=1))
    return flat.withColumn("detail_marks", F.to_json("detail_marks"))


@query(
    "json_flatten_deep",
    """SELECT o_orderkey, o_custkey AS detail_custkey, o_orderpriority AS detail_marks_priority,
              o_orderstatus AS detail_marks_status FROM orders""",
)
def json_flatten_deep(spark, sf_dir):
    return flatten_structs(read_json(spark, _nested_orders(spark, sf_dir), ddl(_NESTED)), 2)


@query(
    "parquet_scan",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, {sql_day('l_shipdate')} AS l_shipdate
        FROM lineitem""",
)
def parquet_scan(spark, sf_dir):
    lineitem = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lineitem.withColumn("l_shipdate", day("l_shipdate"))


@query(
    "parquet_hive_partitions",
    f"""SELECT {sql_day('ts')} AS date, count(*) AS n, min(event_id) AS first_id,
               max(event_id) AS last_id FROM events GROUP BY 1""",
)
def parquet_hive_partitions(spark, sf_dir):
    events = read_parquet(spark, events_by_date(spark, sf_dir))
    return (
        events.groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        )
        .withColumn("date", day("date"))
    )


@query(
    "parquet_date_range",
    f"""SELECT event_id, event_type, {sql_day('ts')} AS date FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def parquet_date_range(spark, sf_dir):
    bounds = ParquetOptions(date_column="date", start_date="2024-01-05", end_date="2024-01-20")
    events = read_parquet(spark, events_by_date(spark, sf_dir), options=bounds)
    return events.select("event_id", "event_type", day("date").alias("date"))


@query("parquet_prune", "SELECT user_id, event_id, event_type FROM events")
def parquet_prune(spark, sf_dir):
    """Registered order and names; the absent column is skipped, the partition dropped."""
    registered = ddl(
        "user_id BIGINT, event_id BIGINT, region STRING, event_type STRING"
    )
    return read_parquet(spark, events_by_date(spark, sf_dir), registered)


_FAULTY = "o_orderkey BIGINT, o_custkey BIGINT, o_cents BIGINT, o_orderstatus STRING"


def _faulty_csv(spark, sf_dir):
    """Every 97th key does not parse."""

    def land(path):
        key = F.col("o_orderkey").cast("string")
        (
            table(spark, sf_dir, "orders")
            .select(
                F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("BAD-"), key))
                .otherwise(key)
                .alias("o_orderkey"),
                "o_custkey",
                cents("o_totalprice").alias("o_cents"),
                "o_orderstatus",
            )
            .write.option("header", True)
            .csv(path)
        )

    return prepared(spark, sf_dir, "orders-faulty-csv", land)


@query(
    "corrupt_drop",
    f"""SELECT o_orderkey, o_custkey, {sql_cents('o_totalprice')} AS o_cents, o_orderstatus
        FROM orders WHERE o_orderkey % 97 <> 0""",
)
def corrupt_drop(spark, sf_dir):
    return read_csv(spark, _faulty_csv(spark, sf_dir), ddl(_FAULTY), corrupt="DROPMALFORMED")


@query(
    "corrupt_permissive",
    f"""SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey,
               {sql_cents('o_totalprice')} AS o_cents, o_orderstatus,
               CASE WHEN o_orderkey % 97 = 0 THEN 'BAD-' || o_orderkey || ',' || o_custkey || ','
                 || {sql_cents('o_totalprice')} || ',' || o_orderstatus END AS _corrupt_record
        FROM orders""",
)
def corrupt_permissive(spark, sf_dir):
    return read_csv(spark, _faulty_csv(spark, sf_dir), ddl(_FAULTY), corrupt="PERMISSIVE")


@query(
    "corrupt_json_permissive",
    """SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id,
              CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
              CASE WHEN event_id % 97 = 0 THEN 'NOT JSON ' || event_id END AS _corrupt_record
       FROM events""",
)
def corrupt_json_permissive(spark, sf_dir):
    def land(path):
        broken = F.concat(F.lit("NOT JSON "), F.col("event_id").cast("string"))
        record = F.to_json(F.struct("event_id", "user_id"))
        line = F.when(F.col("event_id") % 97 == 0, broken).otherwise(record)
        table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)

    path = prepared(spark, sf_dir, "events-faulty-json", land)
    schema = ddl("event_id BIGINT, user_id BIGINT")
    df = read_json(spark, path, schema, corrupt="PERMISSIVE")
    return df.select("event_id", "user_id", CORRUPT)


@query(
    "json_column_parse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def json_column_parse(spark, sf_dir):
    """Text that holds JSON becomes typed columns."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))
