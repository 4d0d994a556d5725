"""Scratch folders: where they are, and that they go."""

from pathlib import Path
from urllib.parse import urlparse

import pytest

from tidelake import session
from tidelake.session import remove_scratch, scratch_dir, staged


@pytest.fixture
def made(monkeypatch):
    """Folders of this test only; those of others may still be read."""
    monkeypatch.setattr(session, "_MADE", [])


def test_staged_rows_lie_in_the_shared_folder_until_removed(spark, made):
    rows = staged(spark.range(5), "five")
    assert rows.count() == 5
    path = Path(urlparse(rows.inputFiles()[0]).path).parent
    assert path.parent == Path(spark.conf.get("spark.checkpoint.dir")) and path.name.startswith("five-")
    assert remove_scratch(spark) == 1 and not path.exists() and remove_scratch(spark) == 0


def test_a_cluster_without_a_shared_folder_is_refused(made):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802  Spark's name
            return None

    class Session:
        sparkContext = Context()  # noqa: N815  Spark's name
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
    Context.getCheckpointDir = lambda self: "hdfs://name/shared"
    assert scratch_dir(Session(), "x").startswith("hdfs://name/shared/x-")
