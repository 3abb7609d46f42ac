from __future__ import annotations

import pytest
from pyspark.sql import types as T
from tests.conftest import plan_of, rows_of

from sparkingest.config import (
    Audit,
    Connection,
    CsvOptions,
    Ingestion,
    JsonOptions,
    Metadata,
    ParquetOptions,
    Quarantine,
    SourceSpec,
    Storage,
)
from sparkingest.errors import ConfigurationError, ConnectorError
from sparkingest.operators.watermark import INTEGER, TIMESTAMP, Watermark, incremental_scan
from sparkingest.sources.files import read_csv, read_json, read_parquet
from sparkingest.sources.jdbc import (
    jdbc_options,
    oracle_options,
    postgres_options,
    read_jdbc,
)
from sparkingest.sources.schema import flatten_structs, project_registered, schema_drift

BASIC = "id BIGINT, name STRING, value DOUBLE"


def ddl(text):
    return T.StructType.fromDDL(text)


@pytest.fixture
def put(tmp_path):
    def write(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_text(text, encoding=encoding)
        return str(path)

    return write


# --- CSV ------------------------------------------------------------------------------


def test_csv_strict(spark, put):
    path = put("a.csv", "id,name,value\n1,Mira,7.25\n2,Tarek,31.5\n")
    df = read_csv(spark, path, ddl(BASIC))
    assert df.schema == ddl(BASIC)
    assert rows_of(df) == [(1, "Mira", 7.25), (2, "Tarek", 31.5)]


def test_csv_header_only(spark, put):
    assert read_csv(spark, put("a.csv", "id,name,value\n"), ddl(BASIC)).count() == 0


def test_csv_without_header_and_other_delimiter(spark, put):
    path = put("a.csv", "1;Mira;7.25\n2;NA;1\n")
    options = CsvOptions(delimiter=";", header=False, null_value="NA")
    df = read_csv(spark, path, ddl(BASIC), options)
    assert rows_of(df) == [(1, "Mira", 7.25), (2, None, 1.0)]


def test_csv_utf8_and_quotes(spark, put):
    path = put("a.csv", 'id,name,value\n1,"Zoë, ""Ö""",1\n')
    options = CsvOptions(escape='"')
    assert rows_of(read_csv(spark, path, ddl(BASIC), options)) == [(1, 'Zoë, "Ö"', 1.0)]


def test_csv_glob(spark, tmp_path, put):
    put("part-1.csv", "id,name,value\n1,a,1\n2,b,2\n")
    put("part-2.csv", "id,name,value\n3,c,3\n4,d,4\n5,e,5\n")
    put("other.csv", "id,name,value\n9,z,9\n")
    assert read_csv(spark, f"{tmp_path}/part-*.csv", ddl(BASIC)).count() == 5
    assert read_csv(spark, f"{tmp_path}/part-[1].csv", ddl(BASIC)).count() == 2
    assert read_csv(spark, f"{tmp_path}/{{part-1,other}}.csv", ddl(BASIC)).count() == 3


BAD = "id,name,value\n1,Mira,7.25\nx17,Odd,4.75\n2,Tarek,31.5\n"


def test_csv_failfast(spark, put):
    df = read_csv(spark, put("a.csv", BAD), ddl(BASIC))
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ_FILE"):
        df.collect()


def test_csv_drop_is_the_same_for_every_projection(spark, put):
    df = read_csv(spark, put("a.csv", BAD), ddl(BASIC), corrupt="DROPMALFORMED")
    assert df.columns == ["id", "name", "value"]
    assert df.count() == 2
    assert rows_of(df.select("name")) == [("Mira",), ("Tarek",)]
    assert rows_of(df) == [(1, "Mira", 7.25), (2, "Tarek", 31.5)]


def test_csv_permissive(spark, put):
    df = read_csv(spark, put("a.csv", BAD), ddl(BASIC), corrupt="PERMISSIVE")
    bad = df.where("id IS NULL").collect()
    assert [tuple(r) for r in bad] == [(None, "Odd", 4.75, "x17,Odd,4.75")]
    assert df.where("id IS NOT NULL").count() == 2


def test_csv_discovered_logs_and_applies_the_registered_schema(spark, put, caplog):
    path = put("a.csv", "id,name,value\n1,x,2.5\n")
    registered = ddl("id STRING, name STRING, value DOUBLE")
    df = read_csv(spark, path, registered, discover=True, source="feed-7")
    assert df.schema == registered
    assert "feed-7" in caplog.text and "type mismatch" in caplog.text


def test_unknown_corrupt_mode(spark, put):
    with pytest.raises(ConfigurationError):
        read_csv(spark, put("a.csv", BAD), ddl(BASIC), corrupt="IGNORE")


# --- JSON -----------------------------------------------------------------------------

AMOUNT = "id BIGINT, name STRING, amount DOUBLE"


def test_json_lines_modes(spark, put):
    good = '{"id":%d,"name":"n%d","amount":1.5}\n'
    text = good % (1, 1) + "NOT VALID JSON AT ALL\n" + good % (2, 2)
    path = put("a.json", text)
    assert read_json(spark, path, ddl(AMOUNT), corrupt="DROPMALFORMED").count() == 2
    kept = read_json(spark, path, ddl(AMOUNT), corrupt="PERMISSIVE")
    assert kept.where("id IS NULL").select("id", "_corrupt_record").collect()[0][1] == (
        "NOT VALID JSON AT ALL"
    )
    with pytest.raises(Exception):
        read_json(spark, path, ddl(AMOUNT)).collect()


def test_json_multiline_array(spark, put):
    path = put("a.json", '[\n {"id": 1,\n "name": "a", "amount": 1},\n {"id": 2}\n]\n')
    df = read_json(spark, path, ddl(AMOUNT), JsonOptions(multiline=True))
    assert rows_of(df) == [(1, "a", 1.0), (2, None, None)]


def test_json_flatten(spark, put):
    path = put("a.json", '{"id":1,"outer":{"inner":{"val":"x"},"n":2}}\n')
    schema = ddl("id BIGINT, outer STRUCT<inner: STRUCT<val: STRING>, n: BIGINT>")
    one = read_json(spark, path, schema, JsonOptions(flatten_depth=1))
    assert one.columns == ["id", "outer_inner", "outer_n"]
    assert isinstance(one.schema["outer_inner"].dataType, T.StructType)
    two = read_json(spark, path, schema, JsonOptions(flatten_depth=2))
    assert rows_of(two.select("outer_inner_val", "outer_n")) == [("x", 2)]
    assert read_json(spark, path, schema).columns == ["id", "outer"]


def test_flatten_refuses_collisions(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b INT, a STRUCT<b: INT>")
    with pytest.raises(ConnectorError, match="a_b"):
        flatten_structs(df)


# --- Parquet --------------------------------------------------------------------------


@pytest.fixture
def hive(spark, tmp_path):
    path = f"{tmp_path}/hive"
    rows = [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-03")]
    spark.createDataFrame(rows, "id BIGINT, name STRING, date STRING").write.partitionBy(
        "date"
    ).parquet(path)
    return path


@pytest.mark.parametrize(
    ("start", "end", "ids"),
    [
        (None, None, [1, 2, 3]),
        ("2024-01-02", None, [2, 3]),
        (None, "2024-01-02", [1, 2]),
        ("2024-01-02", "2024-01-02", [2]),
    ],
)
def test_parquet_date_range(spark, hive, start, end, ids):
    df = read_parquet(spark, hive, options=ParquetOptions(start_date=start, end_date=end))
    assert sorted(r.id for r in df.collect()) == ids
    if start or end:
        filters = plan_of(df).split("PartitionFilters: ")[1].split("]")[0]
        assert "date" in filters


def test_parquet_projection(spark, hive):
    registered = ddl("name STRING, id BIGINT, absent STRING")
    lenient = read_parquet(spark, hive, registered)
    assert lenient.columns == ["name", "id"]
    filled = read_parquet(spark, hive, registered, fill_missing=True)
    assert filled.schema == registered
    with pytest.raises(ConnectorError, match="absent"):
        read_parquet(spark, hive, registered, strict=True)
    assert "ReadSchema: struct<name:string>" in plan_of(
        read_parquet(spark, hive, ddl("name STRING"))
    )


def test_parquet_keeps_the_type_of_the_file(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1,)], "id INT").write.parquet(path)
    assert read_parquet(spark, path, ddl("id BIGINT")).schema["id"].dataType == T.IntegerType()


# --- schema -----------------------------------------------------------------------------


def test_drift_order_and_case():
    registered = T.StructType(
        [
            T.StructField("ID", T.LongType()),
            T.StructField("gone", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    observed = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("value", T.StringType()),
            T.StructField("new", T.IntegerType()),
        ]
    )
    assert schema_drift(registered, observed) == [
        ("gone", "missing", "string", None),
        ("new", "extra", None, "int"),
        ("value", "type mismatch", "double", "string"),
    ]
    assert schema_drift(registered, registered) == []


def test_nested_nullability_is_a_type_difference():
    def struct(nullable):
        inner = T.StructType([T.StructField("x", T.LongType(), nullable)])
        return T.StructType([T.StructField("s", inner)])

    assert [d[1] for d in schema_drift(struct(True), struct(False))] == ["type mismatch"]


def test_project_matches_names_without_case(spark):
    df = spark.createDataFrame([(1, "x")], "ID INT, Name STRING")
    assert project_registered(df, ddl("name STRING, id INT")).columns == ["name", "id"]


# --- incremental predicates reach the scan -------------------------------------------------


def test_incremental_filters_are_pushed_down(spark, sf_dir):
    import datetime as dt

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    by_ts = incremental_scan(
        orders, "o_orderdate", Watermark(TIMESTAMP, ts=dt.datetime(2000, 1, 1))
    )
    by_key = incremental_scan(orders, "o_orderkey", Watermark(INTEGER, integer=100))
    assert "GreaterThan(o_orderdate" in plan_of(by_ts)
    assert "GreaterThan(o_orderkey,100)" in plan_of(by_key)


# --- JDBC option maps -----------------------------------------------------------------------


def test_jdbc_options_plain_and_parallel():
    plain = jdbc_options("jdbc:x", "t", "D", batch_size=500, timeout=60)
    assert plain == {
        "url": "jdbc:x",
        "dbtable": "t",
        "driver": "D",
        "fetchsize": "500",
        "queryTimeout": "60",
    }
    ranged = jdbc_options(
        "jdbc:x", "t", "D", partition_column="id", lower_bound=0, upper_bound=100, parallelism=8
    )
    assert {k: ranged[k] for k in ("partitionColumn", "lowerBound", "upperBound")} == {
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
    }
    assert ranged["numPartitions"] == "8"
    half = jdbc_options("jdbc:x", "t", "D", partition_column="id", lower_bound=0)
    assert "partitionColumn" not in half and "numPartitions" not in half


@pytest.mark.parametrize("mode", ["disable", "require", "verify-ca", "verify-full"])
def test_postgres_options(mode):
    options = postgres_options("h", 5432, "db", "public.trades", ssl_mode=mode)
    assert options["url"] == "jdbc:postgresql://h:5432/db"
    assert options["driver"] == "org.postgresql.Driver"
    assert options["sslmode"] == mode


def test_postgres_defaults_and_errors():
    assert postgres_options("h", 1, "d", "t")["sslmode"] == "require"
    with pytest.raises(ConfigurationError):
        postgres_options("h", 1, "d", "t", ssl_mode="prefer")
    with pytest.raises(ConfigurationError, match="host"):
        postgres_options("", 1, "d", "t")


def test_oracle_options():
    plain = oracle_options("h", 1521, "SVC", "FINANCE.TRADES")
    assert plain["url"] == "jdbc:oracle:thin:@//h:1521/SVC"
    assert plain["driver"] == "oracle.jdbc.OracleDriver"
    assert "oracle.net.wallet_location" not in plain
    wallet = oracle_options("h", 1521, "SVC", "T", wallet_path="/w", extra={"user": "u"})
    assert wallet["oracle.net.wallet_location"] == (
        "(SOURCE=(METHOD=FILE)(METHOD_DATA=(DIRECTORY=/w)))"
    )
    assert wallet["user"] == "u"


def test_unreachable_jdbc_source_is_a_connector_error(spark):
    options = jdbc_options("jdbc:none://h/db", "t", "no.such.Driver")
    with pytest.raises(ConnectorError, match="ledger"):
        read_jdbc(spark, options, "ledger")


# --- source descriptions -----------------------------------------------------------------------


def _spec(**changes):
    parts = {
        "metadata": Metadata("s", "s"),
        "connection": Connection("file", file_path="/in", file_format="parquet"),
        "storage": Storage("/bronze"),
        "audit": Audit("/audit"),
    }
    return SourceSpec(**(parts | changes))


def test_spec_requirements():
    _spec()
    with pytest.raises(ConfigurationError, match="registered"):
        _spec(connection=Connection("file", file_path="/in", file_format="csv"))
    with pytest.raises(ConfigurationError, match="file_path"):
        Connection("file", file_format="csv")
    with pytest.raises(ConfigurationError, match="incremental_column"):
        Ingestion("incremental", watermark_storage="/w")
    with pytest.raises(ConfigurationError, match="watermark_storage"):
        Ingestion("incremental", incremental_column="id")
    with pytest.raises(ConfigurationError, match="outside"):
        _spec(quarantine=Quarantine("/bronze/held"))
    with pytest.raises(ConfigurationError):
        Metadata("s", "../up")


def test_credentials_stay_out_of_repr():
    options = postgres_options("h", 1, "d", "t", extra={"user": "u", "password": "hunter2"})
    assert "hunter2" not in repr(_spec(connection=Connection("jdbc", jdbc_options=options)))
