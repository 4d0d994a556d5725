"""Tables that are replaced by a switch: a new version is written and checked beside the old one before readers see it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: What a version's folder is called; its number orders it.
_VERSION = re.compile(r"v(\d{8})-[0-9a-f]{32}")


def _folder(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of all written versions, oldest first, whether or not they were ever published."""
    files, path = _folder(spark, root)
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return [f"{root}/{n}" for n in sorted(n for n in names if _VERSION.fullmatch(n))]


def published(spark: SparkSession, view: str) -> str | None:
    """The folder that ``view`` reads now."""
    if not spark.catalog.tableExists(view):
        return None
    files = spark.table(view).inputFiles()
    found = [m[0] for f in files if (m := re.search(rf"[^/]*/{_VERSION.pattern}", f))]
    return found[0].rsplit("/", 1)[-1] if found else None


def publish(rows: DataFrame, root: str, view: str, check: Callable[[DataFrame], DataFrame] | None = None, keep: int = 2) -> str:
    """Replace what ``view`` shows by ``rows``; returns the folder of the new version.

    The version is written below ``root``, read back and checked: rows that ``check`` finds are violations, and an error. Then the view is replaced, in
    one step of the catalog. So readers see the old table or the new one, and a load that fails leaves the old one. Readers that have begun
    keep their version; the last ``keep`` published or written before it stay, older ones are deleted.
    """
    spark = rows.sparkSession
    held = versions(spark, root)
    number = 1 + max([int(_VERSION.fullmatch(v.rsplit("/", 1)[-1])[1]) for v in held], default=0)
    path = f"{root}/v{number:08d}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    if check is not None and (found := check(written).head(5)):
        raise ValueError(f"{view} not replaced: {[r.asDict() for r in found]}")
    columns = ", ".join(f"`{f.name}`" for f in rows.schema)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{path}`")
    files, _ = _folder(spark, root)
    for old in held[: max(0, len(held) - keep)]:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old), True)
    return path
