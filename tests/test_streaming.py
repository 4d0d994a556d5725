import json
from datetime import date

from conftest import rows
from tidelake.sources import read_silver
from tidelake.streaming import ingest, ingest_feed


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps([{"date": d, "product_id": p} for d, p in items]))


def test_ingest(spark, tmp_path):
    landing, silver, checkpoint = tmp_path / "in", str(tmp_path / "silver"), str(tmp_path / "checkpoint")

    def ingest(name="checkpoint"):
        ingest_feed(spark, str(landing), silver, str(tmp_path / name), max_files_per_batch=2)
        return [(r["product_id"], r["date"].day) for r in read_silver(spark, silver).collect()]

    land(landing, "2021-01-01.json", ("2021-01-01", 1), ("2021-01-01", 1), ("2021-01-01", None), ("bad", 5))
    land(landing, "2021-01-02.json", ("2021-01-02", 1))
    land(landing, "2021-01-03.json", ("2021-01-03", 1))
    assert sorted(ingest()) == [(1, 1), (1, 2), (1, 3)]
    assert sorted(ingest()) == [(1, 1), (1, 2), (1, 3)]
    # A late file for a day adds to it; what it repeats is not added again.
    land(landing, "2021-01-01-late.json", ("2021-01-01", 1), ("2021-01-01", 2))
    assert sorted(ingest()) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    # With its checkpoint lost every file is read again, and nothing doubles.
    assert sorted(ingest("other")) == [(1, 1), (1, 2), (1, 3), (2, 1)]


def test_a_file_of_nulls_changes_nothing(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.json", ("2021-01-01", 1))
    args = (spark, str(landing), str(tmp_path / "silver"), str(tmp_path / "checkpoint"))
    ingest_feed(*args)
    land(landing, "b.json", (None, 1))
    ingest_feed(*args)
    assert rows(read_silver(spark, str(tmp_path / "silver"))) == [(1, date(2021, 1, 1))]


def test_only_touched_partitions_are_read(spark, tmp_path, physical_plan):
    landing = tmp_path / "in"
    silver = str(tmp_path / "silver")
    land(landing, "a.json", *[(f"2021-01-0{d}", 1) for d in (1, 2, 3, 4)])
    ingest_feed(spark, str(landing), silver, str(tmp_path / "checkpoint"))
    ingest_feed(spark, str(landing), silver, str(tmp_path / "other"))
    table = read_silver(spark, silver)
    assert table.count() == 4
    touched = ingest.touched_days(table, table.filter("product_id = 1").limit(1), "date")
    assert touched.count() == 1 and "dynamicpruning" in physical_plan(touched)
