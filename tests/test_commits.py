from datetime import datetime

import pytest
from conftest import rows

from pressroom import schemas
from pressroom.sources import commits, files, tables

STAMP = datetime(2024, 1, 1)


def article(n, title="t"):
    return (n, "s", f"x{n}", title, f"/{n}", STAMP, STAMP, STAMP)


def path(n):
    return ("s", f"/{n}", f"x{n}", None, STAMP, STAMP)


@pytest.fixture()
def group(tmp_path):
    return commits.metadata_group(str(tmp_path))


def store(spark, group, articles, paths=(), after=None, buckets=8):
    seen = after or commits.newest(spark, group, "s", buckets)
    frames = {"article": spark.createDataFrame(articles, schemas.ARTICLES), "path": spark.createDataFrame(list(paths), schemas.PATHS)}
    changes = {}
    for name, df in frames.items():
        parts = commits.touched(group, name, seen, df)
        kept = commits.read(spark, group, "s", name, seen, parts).join(df.select(*group.table(name).key), list(group.table(name).key), "left_anti")
        changes[name] = (parts, kept.unionByName(df))
    return commits.write(spark, group, "s", seen, changes)


def titles(spark, group):
    return rows(tables.read_snapshot(spark, f"{group.base}/article", schemas.ARTICLES), "external_id", "title")


def test_only_touched_buckets_are_written(spark, group):
    first = store(spark, group, [article(n) for n in range(100)], [path(n) for n in range(100)])
    second = store(spark, group, [article(7, "new")], after=first)
    changed = {b for b, f in second.files["article"].items() if first.files["article"][b] != f}
    assert len(first.files["article"]) == 8 and len(changed) == 1 and second.files["path"] == first.files["path"]
    assert sorted(dict(titles(spark, group)).items()) == sorted([(f"x{n}", "new" if n == 7 else "t") for n in range(100)])
    assert tables.read_snapshot(spark, f"{group.base}/path", schemas.PATHS, "s").count() == 100


def test_a_crash_between_the_tables_leaves_both_as_they_were(spark, group, monkeypatch):
    store(spark, group, [article(1)], [path(1)])

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(commits, "_publish", crash)
        with pytest.raises(RuntimeError):
            store(spark, group, [article(2)], [path(2)])
    assert titles(spark, group) == [("x1", "t")]
    assert tables.read_snapshot(spark, f"{group.base}/path", schemas.PATHS).count() == 1
    store(spark, group, [article(2)], [path(2)])
    assert len(titles(spark, group)) == 2 and tables.read_snapshot(spark, f"{group.base}/path", schemas.PATHS).count() == 2


def test_of_two_writers_one_starts_again(spark, group):
    seen = store(spark, group, [article(1)])
    store(spark, group, [article(2)], after=seen)
    folders = set(files.children(spark, f"{group.base}/article/site=s"))
    with pytest.raises(tables.Conflict):
        store(spark, group, [article(3)], after=seen)
    assert set(files.children(spark, f"{group.base}/article/site=s")) == folders  # the loser left nothing
    assert [t[0] for t in titles(spark, group)] == ["x1", "x2"]


def test_old_commits_and_their_files_go(spark, group):
    for n in range(6):
        store(spark, group, [article(n)], buckets=1)
    assert commits._numbers(spark, group.path("s")) == [4, 5, 6]
    kept = [n for n in files.children(spark, f"{group.base}/article/site=s") if n.startswith("data-")]
    assert len(kept) == 3 and len(titles(spark, group)) == 6


def test_a_bucket_may_end_up_empty(spark, group):
    seen = store(spark, group, [article(1)])
    none = spark.createDataFrame([], schemas.ARTICLES)
    commits.write(spark, group, "s", seen, {"article": (list(range(8)), none)})
    assert titles(spark, group) == []


def test_rows_outside_the_replaced_buckets_are_refused(spark, group):
    seen = store(spark, group, [article(n) for n in range(30)])
    with pytest.raises(ValueError):
        commits.write(spark, group, "s", seen, {"article": ([0], spark.createDataFrame([article(n) for n in range(30)], schemas.ARTICLES))})


def test_plain_snapshots_are_taken_over(spark, group):
    plain = spark.createDataFrame([article(1), article(2)], schemas.ARTICLES)
    tables.write_snapshot(plain, tables.of_site(f"{group.base}/article", "s"))
    assert len(titles(spark, group)) == 2
    store(spark, group, [article(3)])
    assert [t[0] for t in titles(spark, group)] == ["x1", "x2", "x3"]
