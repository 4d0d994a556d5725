"""Split readers against Python's own parsers, whatever the blocks."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import types as T

from conftest import rows
from tidelake.sources import read_bronze_csv, read_bronze_json
from tidelake.sources.split import csv_records, json_elements

TEXTS = ["plain", "", " blanks ", 'a "quoted" word', "two\nlines", 'three\n\n"lines",\n', "carriage\r\nreturn", '"', '""', "\n", "é漢👩", "a,b", "}{", "x" * 300, "\n" * 50, "\\", "\\n"]
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("flag", T.BooleanType())])
FEED = T.StructType([T.StructField("date", T.DateType()), T.StructField("product_id", T.LongType())])


def table(n, seed=0):
    r = random.Random(seed)
    return [(k, None if r.random() < 0.1 else r.choice(TEXTS) + r.choice(TEXTS), r.choice([True, False, None])) for k in range(n)]


def landed(folder, name, items, end="\n"):
    """As PostgreSQL writes CSV: null is nothing, an empty text is quoted."""

    def field(x):
        if x is None or isinstance(x, bool):
            return "" if x is None else "ft"[x]
        text = str(x)
        return '"' + text.replace('"', '""') + '"' if text == "" or any(c in text for c in '",\r\n') or text != text.strip() else text

    folder.mkdir(exist_ok=True)
    lines = ["id,text,flag", *(",".join(map(field, row)) for row in items)]
    (folder / name).write_bytes(end.join(lines + [""]).encode())


@pytest.mark.parametrize("block, end", [(60, "\n"), (1000, "\r\n"), (None, "\n")])
def test_csv_blocks(spark, tmp_path, block, end):
    items = {name: table(30, seed) for seed, name in enumerate(("a.csv", "b.csv"))}
    for name, found in items.items():
        landed(tmp_path / "in", name, found, end)
    landed(tmp_path / "in", "empty.csv", [])
    (tmp_path / "in" / "nothing.csv").write_text("")
    got = read_bronze_csv(spark, str(tmp_path / "in"), SCHEMA, multiline=True, file_column="file", block_bytes=block)
    assert rows(got.select("id", "text", "flag")) == sorted(sum(items.values(), []), key=repr)
    assert {r.file.rsplit("/", 1)[1] for r in got.collect()} == set(items)


def test_csv_records_are_cut_as_python_cuts_them(spark, tmp_path):
    landed(tmp_path / "in", "a.csv", table(200))
    found = csv_records(spark, str(tmp_path / "in"), block_bytes=300)
    assert found.rdd.getNumPartitions() > 1
    with open(tmp_path / "in" / "a.csv", newline="") as file:
        expected = [r for r in csv.reader(file)]
    got = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in found.collect()]
    assert sorted(got) == sorted(expected) and sum(r.is_first for r in found.collect()) == 1


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    landed(tmp_path / "in", "a.csv", table(400))
    (tmp_path / "in.json").write_text(json.dumps([{"date": "2021-01-01", "product_id": k} for k in range(400)]))
    for pieces in (csv_records(spark, str(tmp_path / "in"), block_bytes=1000), json_elements(spark, str(tmp_path / "in.json"), block_bytes=1000)):
        scanned = pieces.filter("path IS NOT NULL")
        assert scanned.rdd.getNumPartitions() > 5


@pytest.mark.parametrize("content, told", [("id,other,flag\n1,a,t\n", "header"), ('id,text,flag\n1,"open,t\n2,b,f\n', "MALFORMED"), ("id,text,flag\n1,a\n", "MALFORMED"), ("id,text,flag\nx,a,t\n", "MALFORMED")])
def test_csv_errors(spark, tmp_path, content, told):
    (tmp_path / "a.csv").write_text(content)
    with pytest.raises(Exception, match=told):
        read_bronze_csv(spark, str(tmp_path / "a.csv"), SCHEMA, multiline=True, block_bytes=8).collect()


def feed(n, seed=0):
    r = random.Random(seed)
    return [{"date": f"2021-01-{r.randint(1, 28):02}", "note": r.choice(TEXTS) + r.choice(["", '{"a": [1, {}]}', "}]", "\\\\", '\\"']), "product_id": k, "more": {"x": [{"y": "}"}, []]}} for k in range(n)]


def texts(content):
    return {
        "line": json.dumps(content),
        "pretty": json.dumps(content, indent=2),
        "raw": json.dumps(content, ensure_ascii=False, separators=(",", ":")) + "\n\n",
    }


@pytest.mark.parametrize("style, wrapped, block", [("line", False, 300), ("pretty", True, 300), ("raw", False, 900), ("line", True, None), ("raw", True, 500)])
def test_json_blocks(spark, tmp_path, block, wrapped, style):
    for n in (0, 1, 40):
        content = feed(n, n)
        (tmp_path / f"{n}.json").write_text(texts({"data": content} if wrapped else content)[style])
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n ")
    got = [json.loads(r.element) for r in json_elements(spark, str(tmp_path), wrapped, block).collect()]
    assert sorted(got, key=json.dumps) == sorted(feed(1, 1) + feed(40, 40), key=json.dumps)
    read = read_bronze_json(spark, str(tmp_path), FEED, wrapped=wrapped, multiline=True, file_column="file", block_bytes=block)
    assert sorted(r.product_id for r in read.collect()) == sorted([0, *range(40)])


def test_json_lines_of_arrays_and_objects(spark, tmp_path):
    (tmp_path / "arrays.json").write_text("\n".join(json.dumps(feed(n, n)) for n in (3, 0, 2)))
    (tmp_path / "objects.json").write_text("\n".join(json.dumps(o) for o in feed(4, 9)))
    assert [r.element is None for r in json_elements(spark, str(tmp_path / "objects.json"), block_bytes=9).collect()] == [False] * 4
    got = json_elements(spark, str(tmp_path / "arrays.json"), block_bytes=9).collect()
    assert sum(r.element is not None for r in got) >= 4


@pytest.mark.parametrize(
    "content, expected",
    [
        ('[{"product_id": 1}, {"product_id": 2}', [1, 2, None]),
        ('[{"product_id": 1}, {"product_id": 2', [1, None]),
        ('[{"product_id": 1}, 7, {"product_id": 2}]', [1, None]),
        ('{"message": "no } data"}', [None]),
        ('[{"product_id": "x"}, {"product_id": 3, "date": "bad"}]', [3, None]),
        ("no json", [None]),
        ("[", [None]),
        ("[]", []),
    ],
)
def test_broken_json_is_an_error_row(spark, tmp_path, content, expected):
    (tmp_path / "a.json").write_text(content)
    for block in (9,):
        got = read_bronze_json(spark, str(tmp_path / "a.json"), FEED, multiline=True, block_bytes=block).collect()
        assert sorted((r.product_id for r in got), key=repr) == sorted(expected, key=repr)
        assert all(r.date is None for r in got)
