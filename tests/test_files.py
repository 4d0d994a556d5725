"""Bronze dialects, write policies and day slices."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidelake.operators import clean
from tidelake.schemas import OUT_OF_STOCK_SCHEMA, SHOP_SCHEMAS, WritePolicy, write_policy
from tidelake.sinks import write_csv, write_json, write_table
from tidelake.sources import DAY_FOLDERS, bronze_path, bronze_paths, day_slice, read_bronze_csv, read_bronze_json, read_silver


def landed(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_dialect(spark, tmp_path):
    schema = "id int, name string, flag boolean, note string, n int"
    text = (
        "id,name,flag,note,n\n"
        '1,"say ""hi"", all",t,"two\nlines",5\n'
        '2,plain,f,"",\n'
        "3,,,,\n"
    )
    path = landed(tmp_path, "a.csv", text)
    struct = spark.createDataFrame([], schema).schema
    assert rows(read_bronze_csv(spark, path, struct, multiline=True)) == [
        (1, 'say "hi", all', True, "two\nlines", 5),
        (2, "plain", False, "", None),
        (3, None, None, None, None),
    ]


def test_csv_with_another_header_or_a_bad_value_fails(spark, tmp_path):
    aisles = SHOP_SCHEMAS["aisles"]
    with pytest.raises(Exception):
        read_bronze_csv(spark, landed(tmp_path, "b.csv", "aisle,aisle_id\nx,1\n"), aisles).collect()
    with pytest.raises(Exception):
        read_bronze_csv(spark, landed(tmp_path, "c.csv", "aisle_id,aisle\nx,1\n"), aisles).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q"uo,te\nx'), (2, None)], SHOP_SCHEMAS["aisles"])
    path = str(tmp_path / "out")
    write_csv(df, path)
    assert rows(read_bronze_csv(spark, path, SHOP_SCHEMAS["aisles"], multiline=True)) == rows(df)


def test_json_edge_rows(spark, tmp_path):
    text = (
        '[{"date": "2021-01-01", "product_id": 1}, {"date": "2021-01-01", "product_id": 1},'
        ' {"date": "2021-01-01", "product_id": null}, {"product_id": 2},'
        ' {"date": "bad", "product_id": 3}, {"date": "2021-01-01", "product_id": "x"},'
        ' {"date": "2021-01-01", "product_id": 7.0}]'
    )
    raw = read_bronze_json(spark, landed(tmp_path, "d.json", text), OUT_OF_STOCK_SCHEMA)
    assert raw.count() == 7
    assert rows(clean(raw, ["date", "product_id"])) == [(date(2021, 1, 1), 1)]


def test_json_error_body_leaves_no_row(spark, tmp_path):
    path = landed(tmp_path, "e.json", '{"message": "no data"}')
    raw = read_bronze_json(spark, path, OUT_OF_STOCK_SCHEMA)
    assert rows(clean(raw, ["date", "product_id"])) == []


def test_wrapped_json(spark, tmp_path):
    path = landed(tmp_path, "f.json", '{"data": [{"date": "2021-01-01", "product_id": 4}]}')
    assert rows(read_bronze_json(spark, path, OUT_OF_STOCK_SCHEMA, wrapped=True)) == [(date(2021, 1, 1), 4)]
    flat = read_bronze_json(spark, path, OUT_OF_STOCK_SCHEMA)
    assert rows(clean(flat, ["date", "product_id"])) == []


@pytest.mark.parametrize("wrapped", [False, True])
def test_json_round_trip(spark, tmp_path, wrapped):
    df = spark.createDataFrame([(date(2021, 1, 1), 1), (None, 2)], OUT_OF_STOCK_SCHEMA)
    write_json(df, str(tmp_path / "out"), wrapped)
    assert rows(read_bronze_json(spark, str(tmp_path / "out"), OUT_OF_STOCK_SCHEMA, wrapped)) == rows(df)


@pytest.mark.parametrize("extension", ["csv", "json"])
def test_many_days_land_in_their_folders(spark, tmp_path, extension):
    df = spark.createDataFrame([(date(2021, 1, d), p) for d in (1, 2, 3) for p in range(d)], OUT_OF_STOCK_SCHEMA)
    write, read = {"csv": (write_csv, read_bronze_csv), "json": (write_json, read_bronze_json)}[extension]
    write(df, str(tmp_path / "feed"), day_column="date")
    write(df.filter("date = '2021-01-02'"), str(tmp_path / "feed"), day_column="date")
    paths = bronze_paths(str(tmp_path), "feed", date(2021, 1, 2), date(2021, 1, 3), extension, DAY_FOLDERS)
    assert rows(read(spark, paths, OUT_OF_STOCK_SCHEMA)) == rows(df.filter("date > '2021-01-01'"))
    assert len(list((tmp_path / "feed").glob("as_of_date=*"))) == 3


def orders_of(spark, *days):
    data = [(n, n, 1, n, date(2021, 1, day)) for day in days for n in range(day * 2)]
    return spark.createDataFrame(data, SHOP_SCHEMAS["orders"])


def test_append_replaces_only_its_days(spark, tmp_path):
    path, policy = str(tmp_path / "t"), write_policy("orders")
    write_table(orders_of(spark, 1, 2), path, policy)
    write_table(orders_of(spark, 2), path, policy, gather=False)
    assert rows(read_silver(spark, path)) == rows(orders_of(spark, 1, 2))
    write_table(orders_of(spark, 3), path, policy)
    assert rows(read_silver(spark, path)) == rows(orders_of(spark, 1, 2, 3))


def test_static_overwrite_replaces_all_days(spark, tmp_path):
    path, policy = str(tmp_path / "t"), WritePolicy("overwrite", "order_date")
    write_table(orders_of(spark, 1, 2), path, policy)
    write_table(orders_of(spark, 3), path, policy)
    assert rows(read_silver(spark, path)) == rows(orders_of(spark, 3))


def test_snapshot_overwrite_and_plain_append(spark, tmp_path):
    path = str(tmp_path / "t")
    aisles = spark.createDataFrame([(1, "a")], SHOP_SCHEMAS["aisles"])
    write_table(aisles, path, write_policy("aisles"))
    write_table(aisles, path, write_policy("aisles"))
    assert read_silver(spark, path).count() == 1
    write_table(aisles, path, WritePolicy("append"))
    assert read_silver(spark, path).count() == 2


def test_a_day_of_nulls_keeps_the_table_readable(spark, tmp_path):
    path, policy = str(tmp_path / "t"), write_policy("orders")
    write_table(orders_of(spark, 1), path, policy)
    write_table(orders_of(spark, 2).withColumn("quantity", F.lit(None).cast("int")), path, policy)
    table = read_silver(spark, path)
    assert dict(table.dtypes)["quantity"] == "int"
    assert table.filter("quantity IS NULL").count() == 4


def test_a_large_day_is_written_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    conf("spark.sql.shuffle.partitions", "8")
    day = F.when(F.col("id") % 3 == 0, F.lit("2021-01-01")).otherwise(
        F.date_add(F.lit("2021-01-02").cast("date"), (F.col("id") % 40).cast("int")).cast("string")
    )
    df = spark.range(0, 100_000, 1, 8).select(day.cast("date").alias("date"), F.col("id").cast("int").alias("product_id"))
    path = str(tmp_path / "t")
    write_table(df, path, write_policy("out_of_stock"))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("date=*")}
    # Without the rebalance each of 8 tasks would write a file for each of 41 days.
    assert files["date=2021-01-01"] > 1
    assert sum(files.values()) < 8 * 41 / 2
    assert read_silver(spark, path).count() == 100_000


def test_unknown_table_or_mode():
    with pytest.raises(KeyError):
        write_policy("unheard_of")
    with pytest.raises(ValueError):
        WritePolicy("upsert")


def test_one_day_prunes_partitions(spark, tmp_path, physical_plan):
    path = str(tmp_path / "t")
    write_table(orders_of(spark, 1, 2), path, write_policy("orders"))
    day = read_silver(spark, path, date_column="order_date", start=date(2021, 1, 2))
    assert rows(day) == rows(orders_of(spark, 2))
    filters = physical_plan(day).split("PartitionFilters: ")[1].split("]")[0]
    assert "order_date" in filters


@pytest.mark.parametrize("dtype", ["timestamp_ntz", "timestamp", "date"])
def test_day_slice_by_type(spark, dtype):
    times = [datetime(2021, 1, 1, 23, 59, 59), datetime(2021, 1, 2), datetime(2021, 1, 2, 23, 59), datetime(2021, 1, 3)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select(F.col("t").cast(dtype))
    assert day_slice(df, "t", date(2021, 1, 2)).count() == 2
    assert day_slice(df, "t", date(2021, 1, 1), date(2021, 1, 2)).count() == 3


def test_bronze_path():
    assert bronze_path("/b/", "shop/orders", date(2021, 1, 2), "csv") == "/b/shop/orders/2021-01-02.csv"


def test_landing_cuts_nothing(spark, tmp_path):
    """Blanks at the ends, empty texts, nulls and microseconds come back, from CSV and from JSON."""
    rows_ = [
        (1, "  padded  ", datetime(2021, 1, 1, 1, 2, 3, 456789)),
        (2, "", datetime(2021, 1, 1)),
        (3, None, None),
        (4, 'a "quoted", part', datetime(2021, 1, 1, 0, 0, 0, 1)),
        (None, "\\ back", datetime(1999, 12, 31, 23, 59, 59, 999999)),
    ]
    df = spark.createDataFrame(rows_, "n int, text string, at timestamp_ntz").withColumn("zoned", F.col("at").cast("timestamp"))
    write_csv(df, str(tmp_path / "csv"))
    write_json(df, str(tmp_path / "json"))
    assert rows(read_bronze_csv(spark, str(tmp_path / "csv"), df.schema)) == rows(df)
    assert rows(read_bronze_json(spark, str(tmp_path / "json"), df.schema)) == rows(df)


def test_one_day_file_is_read_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "64k")
    conf("spark.sql.files.openCostInBytes", "1k")
    df = spark.range(60_000).select(F.col("id").cast("int").alias("aisle_id"), F.lit("a name").alias("aisle"))
    path = landed(tmp_path, "day.csv", "aisle_id,aisle\n" + "".join(f"{n},a name\n" for n in range(60_000)))
    read = read_bronze_csv(spark, path, SHOP_SCHEMAS["aisles"])
    assert read.select(F.spark_partition_id()).distinct().count() > 4 and read.count() == df.count()


def test_without_adaptive_execution_a_day_is_written_by_several_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(4000).select(F.col("id").cast("int").alias("product_id"), F.lit(date(2021, 1, 1)).alias("date"))
    write_table(df, str(tmp_path / "t"), WritePolicy("append", "date"))
    files = list((tmp_path / "t" / "date=2021-01-01").glob("*.parquet"))
    assert 1 < len(files) <= 8
