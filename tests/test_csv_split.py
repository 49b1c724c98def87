"""Split reading of CSV: equal to the whole-file scan for any split size."""

import csv
import random

import pytest

from conftest import SF_SMALL
from titlecorpus.operators.rank import file_order_rank
from titlecorpus.schema import PAPER_FILE_SCHEMA
from titlecorpus.sources import csv_split, files
from titlecorpus.sources.papers import papers

HEADER = "title,abstract,journal_ref,categories\n"


@pytest.fixture
def split_bytes(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows(df):
    return [tuple(r) for r in file_order_rank(df, "n").orderBy("n").drop("n", "_file", "_block", "_row").collect()]


def test_states_of_a_line():
    for line, outside, inside in [("a,b", False, True), ('a,"b', True, False), ('"a""', True, False), ('"a"",b', True, False), ('"a","b', True, True), ('x"y,"z', True, True), ('"a"b"c,"d', True, True),
                                  ('""', False, True), ('"",', False, True), ('"', True, False), ('",', True, False), ("", False, True), ('5" pipe', False, False)]:
        assert (csv_split.inside_after(line, False), csv_split.inside_after(line, True)) == (outside, inside), line


def test_states_agree_with_a_parser():
    """Records put together line by line are those of a CSV parser."""
    r = random.Random(2)
    for _ in range(400):
        want = [["".join(r.choice('ab,"\n ') for _ in range(r.randint(0, 6))) for _ in range(3)] for _ in range(r.randint(1, 5))]
        text = "".join(",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') or r.random() < 0.2 else c for c in row) + "\n" for row in want)
        got, held, inside = [], [], False
        for line in text.split("\n")[:-1]:
            held.append(line)
            inside = csv_split.inside_after(line, inside)
            if not inside:
                got += list(csv.reader(["\n".join(held)], strict=False)) if "\n" not in "".join(held) else [next(csv.reader([x + "\n" for x in held]))]
                held = []
        assert not held and len(got) == len(want)


@pytest.mark.parametrize("size", [97, 1024, 1 << 20])
def test_any_split_size_reads_the_same(spark, tmp_path, split_bytes, size):
    r = random.Random(size)
    cell = lambda: "".join(r.choice(['"', ",", "\n", "word ", "é", " ", "x" * 40]) for _ in range(r.randint(0, 12)))
    quoted = lambda c: '"' + c.replace('"', '""') + '"'
    folder = tmp_path / "in.csv"
    folder.mkdir()
    for k in range(2):
        body = "".join(",".join(quoted(cell()) for _ in range(4)) + "\n" for _ in range(120))
        body += 'plain,5" pipe,x,y\n\n"long ' + "line\n" * 300 + '",b,c,d\nlast,b,c,"d"' + "\n" * k
        (folder / f"part-{k}.csv").write_text(HEADER + body, encoding="utf-8")
    whole = rows(files.read_dataset(spark, str(folder), whole_files=True))
    split_bytes(size)
    df = files.read_dataset(spark, str(folder))
    assert rows(df) == whole and len(whole) == 2 * 123
    assert df.columns == [f.name for f in PAPER_FILE_SCHEMA.fields] + ["_file", "_block", "_row"]


def test_one_file_is_many_tasks(spark, tmp_path, split_bytes):
    docs = papers(spark, SF_SMALL).coalesce(1)
    path = files.save_dataset(docs, str(tmp_path / "one"), "csv")
    whole = rows(files.read_dataset(spark, path, whole_files=True))
    size = sum(p.stat().st_size for p in (tmp_path / "one.csv").glob("part-*"))
    split_bytes(max(4096, size // 100))
    lines = csv_split._lines(spark, path)
    assert 90 <= lines.rdd.getNumPartitions() <= 110
    assert csv_split.split_starts(lines).count() > 5  # quoted texts go over splits
    assert rows(files.read_dataset(spark, path)) == whole
    split_bytes(64 << 10)
    assert rows(files.read_dataset(spark, path)) == whole


def test_windows_line_ends_and_headers(spark, tmp_path, split_bytes):
    (tmp_path / "crlf.csv").write_bytes((HEADER + 'a,"b\nc",d,e\nf,g,h,"i"\n').replace("\n", "\r\n").encode())
    split_bytes(16)
    got = rows(files.read_dataset(spark, str(tmp_path / "crlf.csv")))
    assert got == [("a", "b\r\nc", "d", "e"), ("f", "g", "h", "i")]
    folder = tmp_path / "mixed.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "a,b,c,d\n")
    (folder / "b.csv").write_text("abstract,title,journal_ref,categories\na,b,c,d\n")
    with pytest.raises(Exception, match="header"):
        files.read_dataset(spark, str(folder)).collect()
    (tmp_path / "empty.csv").write_text(HEADER)
    assert files.read_dataset(spark, str(tmp_path / "empty.csv")).count() == 0


def test_no_text_is_shuffled_but_crossing_records(spark, tmp_path):
    path = files.save_dataset(papers(spark, SF_SMALL), str(tmp_path / "p"), "csv")
    plan = csv_split.read_csv_splits(spark, path, [f.name for f in PAPER_FILE_SCHEMA.fields], files._CSV_OPTIONS)._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("MapInArrow")[0]  # the branch of records within a split
    assert "Exchange" not in whole
