"""Runs last: it deletes the tables that earlier tests wrote."""

from pathlib import Path
from urllib.parse import urlparse

from tallyloom import store


def test_release_deletes_the_written_tables(spark):
    files = [Path(urlparse(f).path) for f in store.materialise(spark.range(3), "gone").inputFiles()]
    assert all(f.exists() for f in files)
    store.release(spark)
    assert not any(f.exists() for f in files)
