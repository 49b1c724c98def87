import json

from pyspark.sql import functions as F

from titlecorpus.plans.corpus import build_corpus, dataset_name, load_into_table
from titlecorpus.plans.training import (batch_plan, train_and_evaluate, training_pairs,
                                        write_training_shards)
from titlecorpus.sources.table import read_table


def dump(tmp_path, n=60):
    p = tmp_path / "dump.jsonl"
    lines = []
    for i in range(n):
        rec = {"title": f"Spin chain {i}", "abstract": f"We study spin chains {i}. Spin models are fun.",
               "categories": "quant-ph" if i % 2 else "cs.AI"}
        lines.append(json.dumps(rec))
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_build_corpus_and_train(spark, tmp_path):
    path = dump(tmp_path)
    tpath = str(tmp_path / dataset_name(20, "quant-ph"))
    res = build_corpus(spark, path, tpath, 20, categories_filter="quant-ph", print_result=2)
    assert res["found"] == 30
    assert res["inserted"] == 20 and res["display"].startswith("Paper 1\nTitle: Spin chain 1\n")
    t = read_table(spark, tpath).orderBy("id").collect()
    assert [r.id for r in t] == list(range(1, 21))
    assert [r.title for r in t][:3] == ["Spin chain 1", "Spin chain 3", "Spin chain 5"]
    assert load_into_table(spark, path, tpath, 10, random_select=True) == 10
    assert read_table(spark, tpath).agg(F.max("id")).first()[0] == 30

    pairs = training_pairs(spark, tpath, limit=30)
    out = train_and_evaluate(spark, pairs, str(tmp_path / "model"))
    assert out["totals"]["n_tokens"] > 0 and out["eval_loss"] > 0
    shown = out["shown"].collect()
    assert len(shown) == 5 and all(r.predicted_title for r in shown)

    vocab = write_training_shards(spark, pairs, str(tmp_path / "shards"), input_len=8, label_len=4)
    shards = spark.read.parquet(str(tmp_path / "shards"))
    assert shards.count() == 30 and vocab.count() > 0
    assert {r.split for r in shards.select("split").distinct().collect()} == {"train", "eval"}
    assert all(len(r.input_ids) == 8 for r in shards.collect())
    assert batch_plan(pairs, 2, 4).count() == 60


def test_evaluate_saved_model_and_three_way_shards(spark, tmp_path):
    from titlecorpus.operators import model
    from titlecorpus.plans.training import evaluate_saved_model
    path = dump(tmp_path, 40)
    tpath = str(tmp_path / "t")
    build_corpus(spark, path, tpath)
    pairs = training_pairs(spark, tpath, limit=None)
    model.save_model(model.fit(pairs), str(tmp_path / "m"))
    shown = evaluate_saved_model(spark, pairs, str(tmp_path / "m")).collect()
    assert len(shown) == 5
    beams = evaluate_saved_model(spark, pairs, str(tmp_path / "m"), num_beams=3, no_repeat_ngram_size=2, prefix="summarize: ").collect()
    assert len(beams) == 5
    vocab = write_training_shards(spark, pairs, str(tmp_path / "sh3"), three_way=True, input_len=4,
                                  label_len=2, mask_pad=True, prefix="summarize: ")
    assert vocab.where("token = 'summarize'").count() == 1
    got = {r.split: r["count"] for r in spark.read.parquet(str(tmp_path / "sh3")).groupBy("split").count().collect()}
    assert got == {"train": 36, "validation": 2, "test": 2}


def test_cli_build_and_train(spark, tmp_path, capsys):
    from titlecorpus.cli import main
    path = dump(tmp_path, 30)
    main(["build", "--input", path, "--table-dir", str(tmp_path / "tables"), "--num-papers", "20",
          "--print-result", "1"])
    out = capsys.readouterr().out
    assert "Paper 1" in out and '"inserted": 20' in out
    table = str(tmp_path / "tables" / "arxiv_papers_20n_None_cat")
    main(["train", "--table", table, "--model-dir", str(tmp_path / "models"), "--model-name", "m1"])
    out = capsys.readouterr().out
    assert '"eval_loss"' in out
    main(["evaluate", "--table", table, "--model", str(tmp_path / "models" / "m1"), "--show", "3"])
    assert "true_title" in capsys.readouterr().out


def test_write_batch_plan(spark, tmp_path):
    from titlecorpus.plans.training import write_batch_plan
    path = write_batch_plan(spark.range(10), str(tmp_path / "plan"), epochs=3, batch_size=4)
    e1 = spark.read.parquet(path).where("epoch = 1")
    assert e1.count() == 10 and sorted(r.position for r in e1.collect()) == list(range(1, 11))


def test_file_pairs_and_shards_cli(spark, tmp_path):
    from titlecorpus.cli import main
    from titlecorpus.plans.training import file_pairs
    from titlecorpus.schema import PAPER_FILE_SCHEMA
    from titlecorpus.sources.files import save_dataset
    df = spark.createDataFrame([(f"Title {i}", None if i == 3 else f"Abstract {i}. More.", None, "c")
                                for i in range(12)], PAPER_FILE_SCHEMA)
    path = save_dataset(df.coalesce(1), str(tmp_path / "papers"), "csv")
    pairs = file_pairs(spark, path, n_rows=10).orderBy("id").collect()
    assert [r.id for r in pairs] == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    assert pairs[0].target_text == "Title 0"
    main(["shards", "--from-file", path, "--n-rows", "10", "--out", str(tmp_path / "sh"), "--three-way",
          "--task-prefix", "--mask-pad"])
    assert spark.read.parquet(str(tmp_path / "sh")).count() == 9
