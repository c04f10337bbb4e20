from collections import defaultdict

from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup

from .conftest import ROWS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=repr)


def got(rows):
    return sorted(map(tuple, rows.select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)


def test_groups_of_equal_texts(odd):
    assert got(exact_dedup.dedup(odd)) == brute(ROWS)


def test_texts_that_share_a_digest_stay_apart(odd):
    rows = exact_dedup.dedup(odd, digest=lambda text: F.length(text) % 2, salts=3)
    assert got(rows) == brute(ROWS)


def test_only_ascii_letters_are_lowered(spark):
    rows = spark.createDataFrame([(1, "É"), (2, "é"), (3, "A"), (4, "a")], "doc_id long, text string")
    assert got(exact_dedup.dedup(rows)) == brute([(1, "É"), (2, "é"), (3, "A"), (4, "a")])


def test_keep_gives_one_row_of_each_group_with_all_columns(odd):
    kept = exact_dedup.keep(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([2, 4, 5, 6, 7, 9, None, 10, 11], key=repr)


def test_empty_table(nothing):
    assert exact_dedup.dedup(nothing).count() == 0
    assert exact_dedup.keep(nothing).count() == 0


def test_no_python_in_the_plan(odd):
    plan = exact_dedup.dedup(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
