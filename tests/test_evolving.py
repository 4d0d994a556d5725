"""Columns that come, go or move between landed files."""

import gzip
from datetime import date

import pytest
from pyspark.sql import types as T

from conftest import rows
from tidelake.plans.jobs import Lake, clean_shop_table
from tidelake.sources import read_silver
from tidelake.sources.evolving import SchemaLedger, evolved, headers, read_evolving_csv, widened

INT, LONG, STR, DAY = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
DAYS = [date(2021, 1, d) for d in (1, 2, 3)]


def struct(**columns):
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


@pytest.mark.parametrize(
    "old, new, wide",
    [
        (INT, LONG, LONG), (LONG, INT, LONG), (INT, STR, None), (T.FloatType(), T.DoubleType(), T.DoubleType()), (DAY, T.TimestampType(), None),
        (T.DecimalType(5, 2), T.DecimalType(6, 1), T.DecimalType(7, 2)), (T.DecimalType(38, 0), T.DecimalType(5, 2), None), (LONG, T.DoubleType(), None),
    ],
)
def test_widened(old, new, wide):
    assert widened(old, new) == wide


def test_evolved():
    held = struct(a=INT, b=STR)
    assert evolved(held, struct(c=DAY, a=LONG)) == struct(a=LONG, b=STR, c=DAY)
    for narrow in (struct(b=INT), struct(b=DAY)):
        with pytest.raises(ValueError, match="column b"):
            evolved(held, narrow)
    with pytest.raises(ValueError, match="bigint to int"):
        evolved(struct(a=LONG), struct(a=INT))


def test_ledger(spark, tmp_path):
    ledger = SchemaLedger(spark, str(tmp_path / "schema"))
    assert ledger.versions() == []
    for schema in (struct(a=INT), struct(a=INT), struct(b=STR, a=LONG), struct(b=STR)):
        last = ledger.declare(schema)
    assert last == struct(a=LONG, b=STR) and ledger.versions() == [struct(a=INT), struct(a=LONG, b=STR)]


def test_read_by_name(spark, tmp_path):
    schema = struct(a=INT, b=STR, c=DAY)
    (tmp_path / "1.csv").write_text("b,a\n\"x\ny\",1\n")
    (tmp_path / "2.csv.gz").write_bytes(gzip.compress(b"c,A,b\r\n2021-01-01,2,z\r\n"))
    (tmp_path / "3.csv").write_text("")
    (tmp_path / "4.csv").write_text("c\n")
    assert sorted(headers(spark, [str(tmp_path)]).values()) == [("b", "a"), ("c",), ("c", "A", "b")]
    got = read_evolving_csv(spark, [str(tmp_path)], schema, multiline=True, file_column="file")
    assert got.columns == ["a", "b", "c", "file"]
    assert rows(got.drop("file")) == [(1, "x\ny", None), (2, "z", DAYS[0])]
    for bad in ("a,d\n1,2\n", "a,A\n1,2\n"):
        (tmp_path / "5.csv").write_text(bad)
        with pytest.raises(ValueError, match="5.csv"):
            read_evolving_csv(spark, [str(tmp_path)], schema)


def test_days_with_other_columns_are_one_table(spark, tmp_path):
    lake = Lake(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    folder = tmp_path / "bronze" / "shop" / "orders"
    folder.mkdir(parents=True)
    first = struct(product_id=INT, quantity=INT, order_date=DAY)
    second = struct(product_id=INT, quantity=LONG, order_date=DAY, channel=STR)
    for day, text in zip(DAYS, (f"product_id,quantity,order_date\n1,2,{DAYS[0]}\n", f"channel,order_date,quantity,product_id\nweb,{DAYS[1]},{2**40},3\n", f"order_date,product_id\n{DAYS[2]},4\n"), strict=True):
        (folder / f"{day}.csv").write_text(text)
    ledger = SchemaLedger(spark, str(tmp_path / "schema"))
    clean_shop_table(spark, lake, "orders", DAYS[0], schemas={"orders": first}, ledger=ledger)
    clean_shop_table(spark, lake, "orders", DAYS[1], DAYS[2], {"orders": second}, ledger=ledger)
    expected = [(1, 2, DAYS[0], None), (3, 2**40, DAYS[1], "web"), (4, None, DAYS[2], None)]
    assert rows(read_silver(spark, lake.silver_path("orders"), ledger.versions()[-1]).select("product_id", "quantity", "order_date", "channel")) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="quantity"):
        clean_shop_table(spark, lake, "orders", DAYS[0], schemas={"orders": first}, ledger=ledger)
