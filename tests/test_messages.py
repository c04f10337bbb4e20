"""Half steps that send packed factors from cell to cell, and what a search leaves on disk."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom import store
from tallyloom.operators import factorise

SCHEMA = "user_id long, item_id long, rating double, fold int"


def factors_of(table):
    return {(r.grp, r.id): np.frombuffer(r.factors, "<f4") for r in table.collect()}


def files_of(spark, name):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store.new_path(spark, name)).getParent()
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return [f.getPath().getName() for f in found if f.getPath().getName().startswith(name)]


@pytest.fixture(scope="module")
def rated(spark):
    rng = np.random.default_rng(3)
    rows = [(10**10 + u, i, float(rng.integers(1, 6)), int(rng.integers(0, 2))) for u in range(60) for i in range(30) if rng.random() < 0.4]
    return spark.createDataFrame(rows + [(1, 500, 2.0, 0)], SCHEMA)


def test_messages_bring_what_joined_factors_bring(spark, rated, monkeypatch):
    """Several cells a side, messages of seven ids, and a user and an item whose one row is held out."""
    monkeypatch.setattr(factorise, "MESSAGE_IDS", 7)
    runs = [factorise.Run(rank, 0.1, held) for rank in (2, 3) for held in (-1, 0, 1)]
    by_user, by_item = (factorise.cells(rated, side, side, 300) for side in ("user", "item"))
    assert by_user.many > 1 and not (by_user.has_split or by_item.has_split)
    users = factorise._begin(by_user.own.select("id").distinct(), runs, "t")
    items = factorise._half_step(by_item, users, runs, "t")
    want = factorise._half_step(by_user, items, runs, "t")
    sent = factorise._sending_step(by_item, users, runs, "t", factorise.sends(by_item, "item", by_user), True)
    made = factorise._sending_step(by_user, sent, runs, "t", None, True, True)
    for ours, theirs in ((sent, items), (made, want)):
        got, expected = factors_of(factorise._kept(ours, runs)), factors_of(theirs)
        assert got.keys() == expected.keys()
        assert all(got[k] == pytest.approx(expected[k], abs=1e-5, nan_ok=True) for k in got)
    errors = factorise._held_out(by_user, items, want, runs)
    assert factorise._scored(made, runs) == pytest.approx(errors, rel=1e-5, nan_ok=True)


@pytest.mark.parametrize("cell", [factorise.CELL_ROWS, 20])
def test_a_search_deletes_the_steps_it_has_passed(spark, rated, monkeypatch, cell):
    """With cells of 20 rows ids are split, and factors go one by one."""
    monkeypatch.setattr(factorise, "CELL_ROWS", cell)
    before = files_of(spark, "user-factors") + files_of(spark, "item-factors")
    model = factorise.fit(rated.drop("fold"), {"maxIter": [1, 3], "rank": [2], "regParam": [0.1]}, 2)
    assert model.users.count() == 61 and model.items.count() == 31
    assert files_of(spark, "user-factors") + files_of(spark, "item-factors") == before


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    rows = store.materialise(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "t")
    for _ in range(50):  # they are deleted in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 10
    store.discard(rows)
    spark.range(1).write.parquet(path := str(tmp_path / "other"))
    with pytest.raises(ValueError, match="not a table of this application"):
        store.discard(spark.read.parquet(path))
