import gzip
from datetime import datetime

import pytest
from conftest import rows

from pressroom.sources import chunks, files, gzip_lines


def put(root, folder, name, *texts, members=1):
    target = root / "site-a" / folder
    target.mkdir(parents=True, exist_ok=True)
    body = "".join(t + "\n" for t in texts).encode()
    (target / name).write_bytes(b"".join(gzip.compress(body) for _ in range(members)))


def test_chunk_names_count_back_and_include_the_open_hour():
    names = chunks.chunk_names(datetime(2021, 3, 1, 1, 30), 3)
    assert names == ["2021/03/01/01", "2021/03/01/00", "2021/02/28/23"]


def test_chunk_window_equals_the_names(spark):
    as_of = datetime(2021, 3, 1, 1, 30)
    found = rows(chunks.chunk_window(spark, as_of, 5))
    assert found == sorted((n,) for n in chunks.chunk_names(as_of, 5))


def test_reads_flat_and_nested_files_of_the_named_chunks_only(spark, tmp_path):
    put(tmp_path, "2021/03/01/10", "a.gz", "one", "two")
    put(tmp_path, "2021/03/01/10/part", "b.gz", "three")
    put(tmp_path, "2021/03/01/11", "c.gz", "four")
    put(tmp_path, "2021/03/01/12", "d.gz", "five")
    names = ["2021/03/01/10", "2021/03/01/11", "2021/03/01/13"]
    found = chunks.read_event_chunks(spark, str(tmp_path), "site-a", names)
    assert rows(found, "value", "site", "chunk_dir") == [
        ("four", "site-a", "2021/03/01/11"),
        ("one", "site-a", "2021/03/01/10"),
        ("three", "site-a", "2021/03/01/10"),
        ("two", "site-a", "2021/03/01/10"),
    ]


def test_no_chunk_at_all_gives_no_rows(spark, tmp_path):
    assert chunks.read_event_chunks(spark, str(tmp_path), "site-a", ["2021/03/01/10"]).count() == 0


def test_gzip_without_suffix(spark, tmp_path):
    put(tmp_path, "2021/03/01/10", "plain-name", *[f"l{i}" for i in range(25_000)], members=2)
    found = chunks.read_event_chunks(
        spark, str(tmp_path), "site-a", ["2021/03/01/10"], gzip_without_suffix=True
    )
    assert found.count() == 50_000
    assert found.select("value").distinct().count() == 25_000
    assert found.select("chunk_dir").distinct().collect()[0][0] == "2021/03/01/10"


def test_gzip_files_of_odd_names_and_sizes(spark, tmp_path):
    put(tmp_path, "2021/03/01/10/in a folder", "50%25 name", "one", "", "t\u00e9l\u00e9")
    put(tmp_path, "2021/03/01/10", "empty")
    put(tmp_path, "2021/03/01/10", "_note", "hidden")
    put(tmp_path, "2021/03/01/10/.tmp", "part", "hidden")
    (tmp_path / "site-a/2021/03/01/10/bytes").write_bytes(gzip.compress(b"a\xffb\r\nlast"))
    folder = f"{tmp_path}/site-a/2021/03/01/10"
    assert len(files.all_files(spark, folder)) == 3
    found = gzip_lines.read(spark, [folder])
    assert sorted(r[0] for r in found.select("value").collect()) == ["", "a\ufffdb", "last", "one", "t\u00e9l\u00e9"]
    assert gzip_lines.read(spark, []).count() == 0


def test_a_cut_off_file_fails_the_read(spark, tmp_path):
    put(tmp_path, "10", "cut", *[f"line {i}" for i in range(1000)])
    name = tmp_path / "site-a/10/cut"
    name.write_bytes(name.read_bytes()[:-20])
    with pytest.raises(Exception, match="EOFError"):
        gzip_lines.read(spark, [f"{tmp_path}/site-a/10"]).count()


def test_files_are_dealt_to_tasks_by_size():
    mega = 1 << 20
    dealt = gzip_lines.packed([("d", 3), ("a", 100 * mega), ("b", 20 * mega), ("c", 12 * mega)])
    assert dealt == [["a"], ["b", "c"], ["d"]]
    assert max(map(len, gzip_lines.packed([(str(n), 0) for n in range(100)]))) == 32


def test_a_file_is_read_in_small_batches(tmp_path):
    put(tmp_path, "10", "long", *["x" * 1_000_000] * 12)
    sizes = [b.num_rows for b in gzip_lines._batches(f"{tmp_path}/site-a/10/long")]
    assert sizes == [5, 5, 2]
