"""Tables and models named by manifests: writers that die, position index, versions."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from titlecorpus.operators import model
from titlecorpus.sources import manifest, table
from titlecorpus.sources.papers import papers

TEXT = "k long, title string, abstract string, journal_ref string, categories string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def source(spark, n, parts=5, offset=0):
    rows = [(k, f"t{k}", f"a {k}" if k % 3 else None, None, "c") for k in range(offset, offset + n)]
    return spark.createDataFrame(rows, TEXT).repartition(parts, "title")


def test_publish_and_load(spark, tmp_path):
    path = str(tmp_path / "m")
    assert manifest.load(spark, path) == (0, None) and manifest.versions(spark, path) == []
    assert manifest.publish(spark, path, {"a": "é\n"}, 0) == 1
    assert manifest.publish(spark, path, {"a": 2}, 1) == 2
    assert manifest.load(spark, path) == (2, {"a": 2}) and manifest.load(spark, path, 1) == (1, {"a": "é\n"})
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.publish(spark, path, {"a": 3}, 1)
    assert manifest.versions(spark, path) == [1, 2] and manifest.load(spark, path)[1] == {"a": 2}


def test_three_appends_and_their_places(spark, tmp_path):
    path = str(tmp_path / "t")
    assert table.append_papers(spark, path, source(spark, 40), ["k"]) == 40
    ranked = source(spark, 25, offset=100).withColumn("r", F.col("k") - 99)
    assert table.append_papers(spark, path, ranked, rank_col="r") == 25
    assert table.append_papers(spark, path, source(spark, 33, 1, offset=200), [F.col("k").desc()]) == 33
    assert table.append_papers(spark, path, source(spark, 0), ["k"]) == 0
    want = [(i + 1, f"t{k}") for i, k in enumerate([*range(40), *range(100, 125), *range(232, 199, -1)])]
    every = table.read_table(spark, path)
    assert [(r.id, r.title) for r in every.orderBy("id").collect()] == want
    assert every.columns == ["id", "title", "abstract", "journal_ref", "categories"]
    for n in (0, 1, 39, 40, 41, 66, 98, 99):
        assert sorted((r.id, r.title) for r in table.first_papers(spark, path, n).collect()) == want[:n]
    assert table.first_papers(spark, path, None).count() == 98 == table.first_papers(spark, path, -1).count()
    for k in (0, 39, 40, 64, 65, 97):
        assert [(r.id, r.title) for r in table.paper_by_position(spark, path, k).collect()] == [want[k]]
    assert table.paper_by_position(spark, path, 98).count() == 0
    with pytest.raises(IndexError):
        table.paper_by_position(spark, path, -1)


def test_first_rows_open_only_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = papers(spark, SF_SMALL).withColumnRenamed("id", "k").repartition(8)
    n = [table.append_papers(spark, path, docs, ["k"]) for _ in range(3)][0]
    whole = len(table.read_table(spark, path).inputFiles())
    for df in (table.first_papers(spark, path, 10), table.paper_by_position(spark, path, n + 3)):
        assert "Exchange" not in plan_of(df) and "Sort" not in plan_of(df)
        assert len(df.inputFiles()) == 1 < whole // 3
    # A range of more files than the plan names reads by the index.
    named = table.first_papers(spark, path, 2 * n).collect()
    table.NAMED_FILES, old = 2, table.NAMED_FILES
    try:
        assert sorted(table.first_papers(spark, path, 2 * n).collect()) == sorted(named) and len(named) == 2 * n
    finally:
        table.NAMED_FILES = old


def test_a_killed_append_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table.append_papers(spark, path, source(spark, 10), ["k"])

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            table.append_papers(spark, path, source(spark, 10), ["k"])
    assert table.read_table(spark, path).count() == 10
    assert table.append_papers(spark, path, source(spark, 4, offset=50), ["k"]) == 4
    assert [r.id for r in table.read_table(spark, path).orderBy("id").collect()] == list(range(1, 15))


def test_append_checkpoints_nothing(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("checkpoint"))
    path = str(tmp_path / "t")
    assert table.append_papers(spark, path, source(spark, 10), ["k"]) == 10
    assert table.first_papers(spark, path, 3).count() == 3


def test_gaps_in_given_positions(spark, tmp_path):
    path = str(tmp_path / "t")
    table.append_papers(spark, path, source(spark, 10).withColumn("r", F.col("k") * 2 + 1), rank_col="r")
    assert sorted(r.id for r in table.first_papers(spark, path, 3).collect()) == [1, 3, 5]
    assert table.paper_by_position(spark, path, 2).first().id == 5


def test_model_versions_never_mix(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    pairs = spark.createDataFrame([("deep nets learn", "deep nets"), ("trees learn", "trees")], "input_text string, target_text string")
    vocab = spark.createDataFrame([("deep", 2)], "token string, token_id int")
    first = model.save_model(model.fit(pairs), path, vocab)
    assert model.model_version(spark, path) == 1 and first["n_tokens"] == 4

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            model.save_model(model.fit(pairs.limit(1)), path, vocab.limit(0))
    tokens, totals = model.load_model(spark, path)
    assert tokens.count() == totals["n_tokens"] == 4 and model.load_part(spark, path, "vocab")[0].count() == 1
    second = model.save_model(model.fit(pairs.limit(1)), path)
    for version, want in ((None, second), (2, second), (1, first)):
        tokens, totals = model.load_model(spark, path, version)
        assert tokens.count() == totals["n_tokens"] == want["n_tokens"]
    with pytest.raises(FileNotFoundError):
        model.load_part(spark, path, "vocab")
    with pytest.raises(FileNotFoundError):
        model.load_model(spark, str(tmp_path / "none"))
