import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from titlecorpus.operators.rank import file_order_rank, with_file_order
from titlecorpus.schema import (DEFAULT_ABSTRACT, DEFAULT_CATEGORIES, DEFAULT_JOURNAL_REF,
                                DEFAULT_TITLE, NA_TOKENS, PAPER_FILE_SCHEMA)
from titlecorpus.sources import files, jsonl, table


def test_json_three_states(spark, write_lines):
    path = write_lines("dump.jsonl", [
        '{"title":"A","journal-ref":null,"categories":"quant-ph hep-th"}',
        '{"title":"B"}',
        '{"title":null}',
        '{"title":"d1","title":"d2"}',
    ])
    rows = jsonl.load_arxiv_metadata(spark, path).orderBy("_rank").collect()
    assert [r.title for r in rows] == ["A", "B", None, "d2"]
    assert [r.abstract for r in rows] == [DEFAULT_ABSTRACT] * 4
    assert [r.journal_ref for r in rows] == [None] + [DEFAULT_JOURNAL_REF] * 3
    assert rows[0].categories == "quant-ph hep-th"
    assert [r.categories for r in rows[1:]] == [DEFAULT_CATEGORIES] * 3


@pytest.mark.parametrize("bad", ["{bad", "", "   "])
def test_bad_line_fails(spark, write_lines, bad):
    path = write_lines("bad.jsonl", ['{"title":"ok"}', bad, '{"title":"ok2"}'])
    with pytest.raises(Exception):
        jsonl.load_arxiv_metadata(spark, path).collect()


def test_category_substring_filter(spark, write_lines):
    path = write_lines("cats.jsonl", [
        json.dumps({"title": "1", "categories": "en src1"}),
        json.dumps({"title": "2", "categories": "en src10"}),
        json.dumps({"title": "3", "categories": "EN SRC1"}),
        json.dumps({"title": "4"}),
    ])
    got = jsonl.load_arxiv_metadata(spark, path, categories_filter="src1").collect()
    assert sorted(r.title for r in got) == ["1", "2"]
    assert jsonl.match_count(spark, path, "src1").first().n_found == 2
    # No filter: everything, including the missing-key row.
    assert jsonl.load_arxiv_metadata(spark, path, categories_filter="").count() == 4
    ranks = jsonl.load_arxiv_metadata(spark, path, categories_filter="src1").orderBy("_rank").collect()
    assert [(r["_rank"], r.title) for r in ranks] == [(1, "1"), (2, "2")]


def test_first_n_and_random_n(spark, write_lines):
    path = write_lines("n.jsonl", [json.dumps({"title": str(i)}) for i in range(50)])
    first = jsonl.load_arxiv_metadata(spark, path, n_papers=7).orderBy("_rank").collect()
    assert [r.title for r in first] == [str(i) for i in range(7)]
    r1 = jsonl.load_arxiv_metadata(spark, path, 10, random_select=True, seed=3).collect()
    r2 = jsonl.load_arxiv_metadata(spark, path, 10, random_select=True, seed=3).collect()
    assert len(r1) == 10 and sorted(map(tuple, r1)) == sorted(map(tuple, r2))
    # Clamped: more than available gives all rows; the strict form raises.
    assert jsonl.load_arxiv_metadata(spark, path, 500, random_select=True).count() == 50
    with pytest.raises(ValueError):
        jsonl.load_arxiv_metadata(spark, path, 51, random_select=True, strict=True)


def test_file_order_across_files_and_splits(spark, tmp_path):
    d = tmp_path / "multi"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"a{i:05d}\n" for i in range(500)))
    (d / "b.txt").write_text("".join(f"b{i:05d}\n" for i in range(9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        tagged = with_file_order(spark.read.text(str(d)))
        ranked = file_order_rank(tagged, "line_no").select("value", "line_no")
        got = [r.value for r in ranked.orderBy("line_no").collect()]
        nums = [r.line_no for r in ranked.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [f"a{i:05d}" for i in range(500)] + [f"b{i:05d}" for i in range(9000)]
    assert got == expected
    assert sorted(nums) == list(range(1, 9501))


def test_append_twice_gives_new_ids(spark, tmp_path):
    path = str(tmp_path / "papers_table")
    src = spark.createDataFrame(
        [(i, f"t{i}", f"a{i}", None, "c") for i in range(3)],
        "k long, title string, abstract string, journal_ref string, categories string")
    assert table.append_papers(spark, path, src, ["k"]) == 3
    table.create_table(spark, path)  # idempotent
    assert table.append_papers(spark, path, src, ["k"]) == 3
    rows = table.read_table(spark, path).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.title for r in rows] == ["t0", "t1", "t2"] * 2


def test_fetch_limits_and_display(spark):
    t = spark.createDataFrame([(i, f"t{i}", "a", None, "c") for i in range(1, 6)],
                              "id long, title string, abstract string, journal_ref string, categories string")
    assert table.fetch_papers(t, -1).count() == 5
    assert table.fetch_papers(t, 0).count() == 0
    assert [r.id for r in table.fetch_papers(t, 3).collect()] == [1, 2, 3]
    assert table.fetch_papers(t, 6).count() == 5
    assert table.fetch_papers_for_training(t, 2).columns == ["id", "abstract", "title"]
    assert table.paper_at(t, 2).first().id == 3
    assert table.paper_at(t, 9).count() == 0
    assert table.paper_info(t, 4).startswith("Paper 5\nTitle: t5")
    with pytest.raises(IndexError):
        table.paper_info(t, 5)
    text = table.show_papers(t, 2)
    assert text.startswith("Paper 1\nTitle: t1") and "Paper 2" in text
    with pytest.raises(IndexError):
        table.show_papers(t, 6)


def test_csv_quoting_and_null_tokens(spark, tmp_path):
    titles = ['a,"q"\nz', "", None, "NA", "None", "x"]
    df = spark.createDataFrame([(t, "abs", None, "c") for t in titles], PAPER_FILE_SCHEMA)
    path = files.save_dataset(df, str(tmp_path / "out"), "csv")
    back = files.read_dataset(spark, path).orderBy("_file", "_block", "_row").collect()
    assert [r.title for r in back] == ['a,"q"\nz', None, None, None, None, "x"]
    tok = spark.createDataFrame([(t, t, t, t) for t in NA_TOKENS], PAPER_FILE_SCHEMA)
    p2 = files.save_dataset(tok, str(tmp_path / "tokens"), "csv")
    assert files.load_dataset(spark, p2).where(F.col("title").isNotNull()).count() == 0


def test_csv_keeps_edge_spaces_and_digit_titles(spark, tmp_path):
    df = spark.createDataFrame([("  1984  ", " a ", None, "c")], PAPER_FILE_SCHEMA)
    path = files.save_dataset(df, str(tmp_path / "sp"), "csv")
    r = files.load_dataset(spark, path).first()
    assert r.title == "  1984  " and r.abstract == " a "


def test_parquet_roundtrip_and_dispatch(spark, tmp_path):
    df = spark.createDataFrame([("t", "a", "j", "c")], PAPER_FILE_SCHEMA)
    path = files.save_dataset(df, str(tmp_path / "p"), "parquet")
    assert files.load_dataset(spark, path).collect()[0].title == "t"
    with pytest.raises(ValueError):
        files.save_dataset(df, str(tmp_path / "x"), "json")
    with pytest.raises(ValueError):
        files.load_dataset(spark, str(tmp_path / "x.json"))


def test_load_dataset_head_and_seeded_sample(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", "a", None, "c") for i in range(20)], PAPER_FILE_SCHEMA)
    path = files.save_dataset(df.coalesce(1), str(tmp_path / "s"), "parquet")
    head = files.load_dataset(spark, path, n_rows=5).collect()
    assert [r.title for r in head] == [f"t{i}" for i in range(5)]
    s1 = files.load_dataset(spark, path, n_rows=6, random_select=True).orderBy("index").collect()
    s2 = files.load_dataset(spark, path, n_rows=6, random_select=True).orderBy("index").collect()
    assert [r["index"] for r in s1] == list(range(6)) and s1 == s2
    with pytest.raises(ValueError):
        files.load_dataset(spark, path, n_rows=21, random_select=True)


def test_named_split_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "eval"), (3, "train")], "id long, split string")
    path = files.write_splits(df, str(tmp_path / "splits"))
    part = files.read_split(spark, path, "train")
    assert sorted(r.id for r in part.collect()) == [1, 3]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "train" in plan


def test_invalid_json_value_is_error_not_silent(spark, write_lines):
    path = write_lines("arr.jsonl", ["[1, 2]"])
    with pytest.raises(PySparkException):
        jsonl.load_arxiv_metadata(spark, path).collect()


def test_defaults_text():
    assert DEFAULT_TITLE == "No title available"


@pytest.mark.parametrize("bad", ["{bad", ""])
def test_bad_line_fails_with_filter(spark, write_lines, bad):
    path = write_lines("badf.jsonl", ['{"title":"ok","categories":"x"}', bad])
    with pytest.raises(Exception):
        jsonl.load_arxiv_metadata(spark, path, categories_filter="x").collect()
    with pytest.raises(Exception):
        jsonl.match_count(spark, path, "x").collect()


def test_filtered_file_order_numbering_across_splits(spark, tmp_path):
    d = tmp_path / "dumpdir"
    d.mkdir()
    recs = [{"title": f"p{i:05d}", "categories": "keep" if i % 3 else "drop"} for i in range(6000)]
    (d / "a.jsonl").write_text("".join(json.dumps(r) + "\n" for r in recs[:1000]))
    (d / "b.jsonl").write_text("".join(json.dumps(r) + "\n" for r in recs[1000:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = jsonl.load_arxiv_metadata(spark, str(d), 2500, categories_filter="keep") \
            .orderBy("_rank").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [r["title"] for r in recs if r["categories"] == "keep"][:2500]
    assert [r.title for r in got] == expected
    assert [r["_rank"] for r in got] == list(range(1, 2501))


def test_match_count_observed_in_same_job(spark, write_lines):
    from pyspark.sql import Observation
    path = write_lines("obs.jsonl", [json.dumps({"title": str(i), "categories": "a" if i % 2 else "b"})
                                     for i in range(40)])
    obs = Observation("found")
    rows = jsonl.load_arxiv_metadata(spark, path, 5, categories_filter="a", observation=obs).collect()
    assert len(rows) == 5 and obs.get["n_found"] == 20


def test_load_dataset_head_and_slice(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i:03d}", "a", None, "c") for i in range(300)], PAPER_FILE_SCHEMA)
    path = files.save_dataset(df.repartition(1), str(tmp_path / "h"), "parquet")
    everything = [r.title for r in files.load_dataset(spark, path).collect()]
    assert [r.title for r in files.load_dataset(spark, path, n_rows=120).collect()] == everything[:120]
    assert [r.title for r in files.load_dataset(spark, path, n_rows=-5).collect()] == everything[:-5]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text("abstract,title,categories,journal_ref\nA,T,c,j\n")
    row = files.load_dataset(spark, str(tmp_path / "swapped.csv")).first()
    assert (row.title, row.abstract, row.journal_ref, row.categories) == ("T", "A", "j", "c")
    (tmp_path / "short.csv").write_text("abstract,title\nA,T\n")
    with pytest.raises(ValueError, match="journal_ref"):
        files.load_dataset(spark, str(tmp_path / "short.csv"))


def test_random_lines_do_not_depend_on_the_split_layout(spark, tmp_path):
    """The same sample under two split sizes, also when the size changes between build and run."""
    lines = ['{"id": "%d", "title": "t%d", "abstract": "%s"}' % (i, i, "x" * 40) for i in range(2000)]
    (tmp_path / "d").mkdir()
    for part in range(2):
        (tmp_path / "d" / f"p{part}.json").write_text("\n".join(lines[part * 1000:(part + 1) * 1000]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for before, after in (("128m", "128m"), ("8k", "8k"), ("128m", "8k")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            picked = jsonl.load_arxiv_metadata(spark, str(tmp_path / "d"), 50, random_select=True)
            spark.conf.set("spark.sql.files.maxPartitionBytes", after)
            got.append(sorted(r.title for r in picked.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] == got[2] and len(got[0]) == 50
