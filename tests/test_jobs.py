"""Bronze to gold for single days and ranges."""

import json
from datetime import date

import pytest

from conftest import rows
from tidelake.plans import jobs
from tidelake.plans.jobs import Lake, clean_out_of_stock, clean_shop_table, land_shop, load_gold, load_gold_jdbc, run_range
from tidelake.schemas import SHOP_SCHEMAS
from tidelake.sinks import create_star_schema
from tidelake.sources import date_range, read_bronze_csv, read_silver

DAYS = date_range(date(2021, 1, 1), date(2021, 1, 3))
GOLD = ["orders", "out_of_stock", "dim_clients", "dim_products", "dim_stores"]


def land(bronze):
    """Three days of exports; clients grow from day to day."""
    for n, day in enumerate(DAYS):
        tables = {
            "orders": ["product_id,client_id,store_id,quantity,order_date"]
            + [f"{p},1,1,{q},{day}" for p, q in [(1, 1), (1, 2), (1, 4), (1, 4), (2, n)]],
            "products": ["product_id,product_name,department_id,aisle_id", '1,"a ""b""",1,1', "2,c,7,1"],
            "departments": ["department_id,department", "1,dep"],
            "aisles": ["aisle_id,aisle", "1,ais"],
            "stores": ["store_id,store_type_id,location_area_id", "1,1,1"],
            "store_types": ["store_type_id,type", "1,big"],
            "location_areas": ["area_id,area", "1,north"],
            "clients": ["id,fullname,location_area_id"] + [f"{c},client {c},1" for c in range(n + 1)],
        }
        for name, lines in tables.items():
            folder = bronze / "shop" / name
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{day}.csv").write_text("\n".join(lines) + "\n")
        feed = [{"date": str(day), "product_id": p} for p in (1, 1, 2 + n)] + [{"date": str(day), "product_id": None}]
        folder = bronze / "out_of_stock"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{day}.json").write_text(json.dumps(feed))


@pytest.fixture
def lakes(spark, tmp_path):
    land(tmp_path / "bronze")
    made = []

    def make(name):
        database = f"lake_{name}_{tmp_path.name.replace('-', '_')}"
        create_star_schema(spark, database, str(tmp_path / name / "gold"), buckets=2)
        made.append(database)
        return Lake(str(tmp_path / "bronze"), str(tmp_path / name / "silver"), database)

    yield make
    for database in made:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def gold(spark, lake):
    for table in GOLD:
        spark.catalog.refreshTable(f"{lake.gold_database}.{table}")
    return {table: rows(spark.table(f"{lake.gold_database}.{table}")) for table in GOLD}


def test_range_equals_day_by_day_and_repeats_change_nothing(spark, lakes):
    daily, ranged = lakes("daily"), lakes("ranged")
    for day in DAYS:
        run_range(spark, daily, day)
    counts = run_range(spark, ranged, DAYS[0], DAYS[-1])
    assert counts == {"rows_read": 12, "rows_dropped_null": 3}
    assert gold(spark, daily) == gold(spark, ranged)
    run_range(spark, ranged, DAYS[1])
    # A snapshot shows the last run; the facts of all days are as before.
    again = gold(spark, ranged)
    for fact in ("orders", "out_of_stock"):
        assert again[fact] == gold(spark, daily)[fact]
    assert len(again["dim_clients"]) == 2


def test_gold_rows(spark, lakes):
    lake = lakes("one")
    run_range(spark, lake, DAYS[0])
    got = gold(spark, lake)
    # Equal full rows collapse before the sum: 1 + 2 + 4.
    assert sorted((r[1], r[3]) for r in got["orders"]) == [(1, 7), (2, 0)]
    assert got["dim_products"] == [(1, 'a "b"', "dep", "ais"), (2, "c", None, "ais")]
    assert got["dim_stores"] == [(1, "big", "north")]
    assert sorted(r[0] for r in got["out_of_stock"]) == [1, 2]


def test_silver_without_dedupe(spark, lakes):
    lake = lakes("raw")
    clean_shop_table(spark, lake, "orders", DAYS[0], dedupe=False)
    assert read_silver(spark, lake.silver_path("orders")).count() == 5


def test_failures_are_raised(spark, lakes):
    lake = lakes("bad")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        clean_shop_table(spark, lake, "orders", date(2022, 1, 1))
    with pytest.raises(KeyError):
        clean_shop_table(spark, lake, "unheard_of", DAYS[0])
    with pytest.raises(KeyError):
        load_gold(spark, lake, "unheard_of", DAYS[0])


def test_gold_does_not_follow_a_failed_silver(spark, lakes, tmp_path):
    lake = lakes("stopped")
    (tmp_path / "bronze" / "shop" / "aisles" / f"{DAYS[0]}.csv").unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_range(spark, lake, DAYS[0])
    assert all(not found for found in gold(spark, lake).values())


def test_rows_of_another_day_fail_the_load(spark, lakes, tmp_path):
    lake = lakes("stray")
    clean_out_of_stock(spark, lake, DAYS[0], DAYS[1])
    stray = [{"date": str(DAYS[0]), "product_id": 9}]
    (tmp_path / "bronze" / "out_of_stock" / f"{DAYS[1]}.json").write_text(json.dumps(stray))
    with pytest.raises(Exception, match="date 2021-01-01 in the file of 2021-01-02"):
        clean_out_of_stock(spark, lake, DAYS[1])
    # A range takes what its days take one by one.
    with pytest.raises(Exception, match="date 2021-01-01 in the file of 2021-01-02"):
        clean_out_of_stock(spark, lake, DAYS[0], DAYS[1])
    assert read_silver(spark, lake.silver_path("out_of_stock")).count() == 4


def test_landing_reads_what_the_database_lists(spark, lakes, monkeypatch):
    lake = lakes("landed")
    day = date(2021, 2, 1)
    tables = {
        "aisles": spark.createDataFrame([(1, 'a "b"\nc')], SHOP_SCHEMAS["aisles"]),
        "orders": spark.createDataFrame([(1, 1, 1, 5, day), (1, 1, 1, None, day)], SHOP_SCHEMAS["orders"]),
    }
    listed = spark.createDataFrame([(name,) for name in tables], "table_name string")
    monkeypatch.setattr(jobs, "list_tables", lambda *args: listed)
    monkeypatch.setattr(jobs, "extract_table", lambda _spark, _url, name, *rest, **options: tables[name.split(".")[1]])
    assert land_shop(spark, lake, "jdbc:x", {}, day) == ["aisles", "orders"]
    for name, expected in tables.items():
        clean_shop_table(spark, lake, name, day, multiline=name == "aisles")
        assert rows(read_silver(spark, lake.silver_path(name)).select(expected.columns)) == rows(expected)


def test_gold_over_jdbc_appends_facts_and_replaces_dimensions(spark, lakes, monkeypatch):
    lake = lakes("jdbc")
    run_range(spark, lake, DAYS[0])
    written = {}
    monkeypatch.setattr(
        jobs, "write_jdbc", lambda df, url, table, properties, mode: written.update({table: (mode, df.count())})
    )
    for table in GOLD:
        load_gold_jdbc(spark, lake, "jdbc:x", {}, table, DAYS[0], schema="dw")
    assert written == {
        "dw.orders": ("append", 2),
        "dw.out_of_stock": ("append", 2),
        "dw.dim_clients": ("overwrite", 1),
        "dw.dim_products": ("overwrite", 2),
        "dw.dim_stores": ("overwrite", 1),
    }


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_orders_without_a_day_stay(spark, lakes, tmp_path, conf, adaptive):
    """Once for each file that holds them, however often its day runs, until the file no longer does."""
    conf("spark.sql.adaptive.enabled", adaptive)
    lake = lakes("undated")
    path, schema = lake.silver_path("orders"), SHOP_SCHEMAS["orders"]
    files = [tmp_path / "bronze" / "shop" / "orders" / f"{day}.csv" for day in DAYS]
    whole = [f.read_text() for f in files]

    def undated():
        return sorted(r["quantity"] for r in read_silver(spark, path, schema).filter("order_date IS NULL").collect())

    for f, text, lines in zip(files, whole, ("7,1,1,1,\n7,1,1,1,\n", "7,1,1,1,\n7,1,1,2,\n", ""), strict=True):
        f.write_text(text + lines)
    clean_shop_table(spark, lake, "orders", DAYS[0])
    assert undated() == [1]
    for _ in range(2):
        clean_shop_table(spark, lake, "orders", DAYS[1], DAYS[2])
        assert undated() == [1, 1, 2]
    clean_shop_table(spark, lake, "orders", DAYS[0], DAYS[-1])
    assert undated() == [1, 1, 2]
    assert read_silver(spark, path, schema).filter("order_date IS NOT NULL").count() == 12
    clean_shop_table(spark, lake, "orders", DAYS[0], dedupe=False)
    assert undated() == [1, 1, 1, 2]
    files[1].write_text(whole[1])
    clean_shop_table(spark, lake, "orders", DAYS[1])
    assert undated() == [1, 1]
    files[0].write_text(whole[0])
    clean_shop_table(spark, lake, "orders", DAYS[0])
    assert undated() == [] and read_silver(spark, path, schema).count() == 12


BODIES = ["[]", '{"message": "no out_of_stock items for this date"}', '[{"date": null, "product_id": 4}, {"date": "2021-01-02", "product_id": null}]', ""]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("body", BODIES)
def test_a_feed_day_without_rows(spark, lakes, tmp_path, conf, body, adaptive):
    """It neither fails nor leaves what the day held before, in silver and in gold."""
    conf("spark.sql.adaptive.enabled", adaptive)
    lake = lakes("empty")
    run_range(spark, lake, DAYS[0], DAYS[-1])
    (tmp_path / "bronze" / "out_of_stock" / f"{DAYS[1]}.json").write_text(body)
    counts = run_range(spark, lake, DAYS[1])
    read = {"[]": 0, "": 0}.get(body, 1 if body.startswith("{") else 2)
    assert counts == {"rows_read": read, "rows_dropped_null": read}
    assert {r["date"] for r in read_silver(spark, lake.silver_path("out_of_stock")).collect()} == {DAYS[0], DAYS[2]}
    assert {r[0] for r in gold(spark, lake)["out_of_stock"]} | {r[1] for r in gold(spark, lake)["out_of_stock"]} >= {DAYS[0], DAYS[2]}
    assert not any(DAYS[1] in r for r in gold(spark, lake)["out_of_stock"])


def test_an_empty_first_day(spark, lakes, tmp_path):
    for path in (tmp_path / "bronze" / "shop").glob(f"orders/{DAYS[0]}.csv"):
        path.write_text("product_id,client_id,store_id,quantity,order_date\n")
    (tmp_path / "bronze" / "out_of_stock" / f"{DAYS[0]}.json").write_text("[]")
    lake = lakes("first")
    run_range(spark, lake, DAYS[0])
    got = gold(spark, lake)
    assert got["orders"] == [] and got["out_of_stock"] == [] and len(got["dim_products"]) == 2


def test_range_from_the_database(spark, lakes, tmp_path, monkeypatch):
    """Bronze, silver and gold in one run; a listed table without a policy stops it before silver."""
    lake = lakes("whole")
    landed = {t: clean_rows(spark, tmp_path, t) for t in SHOP_SCHEMAS}
    names = list(SHOP_SCHEMAS)
    monkeypatch.setattr(jobs, "list_tables", lambda *args: spark.createDataFrame([(n,) for n in names], "table_name string"))

    asked = []

    def extract(_spark, _url, name, day, _properties, last, **options):
        table = name.split(".")[1]
        asked.append(table)
        assert options["spread_by"]
        return landed[table].filter(landed[table]["order_date"].between(day, last)) if table == "orders" else landed[table]

    monkeypatch.setattr(jobs, "extract_table", extract)
    database = jobs.ShopDatabase("jdbc:x", {})
    run_range(spark, lake, DAYS[0], DAYS[-1], database=database, gold_tables=["orders", "dim_products"])
    got = gold(spark, lake)
    assert len(got["orders"]) == 6 and len(got["dim_products"]) == 2 and got["dim_stores"] == []
    # One extract by table, not one by table and day.
    assert sorted(asked) == sorted(SHOP_SCHEMAS)
    names.append("unheard_of")
    monkeypatch.setattr(jobs, "land_shop_range", lambda *args: names)
    with pytest.raises(KeyError, match="unheard_of"):
        run_range(spark, lake, DAYS[0], database=database)


@pytest.mark.parametrize("layout", [jobs.DAY_FILES, jobs.DAY_FOLDERS])
def test_a_range_lands_days_without_rows(spark, tmp_path, monkeypatch, layout):
    """Also those that had rows when they landed before."""
    lake = Lake(str(tmp_path / "bronze"), str(tmp_path / "silver"), bronze_layout=layout)
    held = [(1, 1, 1, 1, day) for day in DAYS]
    monkeypatch.setattr(jobs, "list_tables", lambda *args: spark.createDataFrame([("orders",)], "table_name string"))
    monkeypatch.setattr(jobs, "extract_table", lambda *args, **options: spark.createDataFrame(held, SHOP_SCHEMAS["orders"]))
    for _ in range(2):
        assert jobs.land_shop_range(spark, lake, "jdbc:x", {}, DAYS[0], DAYS[-1]) == ["orders"]
        clean_shop_table(spark, lake, "orders", DAYS[0], DAYS[-1])
        assert rows(read_silver(spark, lake.silver_path("orders"), SHOP_SCHEMAS["orders"])) == sorted(held, key=repr)
        del held[1]


def clean_rows(spark, tmp_path, table):
    paths = [str(p) for p in sorted((tmp_path / "bronze" / "shop" / table).glob("*.csv"))]
    held = read_bronze_csv(spark, paths if table == "orders" else paths[-1:], SHOP_SCHEMAS[table]).collect()
    return spark.createDataFrame(held, SHOP_SCHEMAS[table])
