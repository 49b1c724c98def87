from titlecorpus.operators import model
from titlecorpus.schema import INVALID_INPUT_MESSAGE
from titlecorpus.streaming.predict import predict_batch, start_predict_stream


def test_stream_equals_batch_and_errors(spark, tmp_path):
    pairs = spark.createDataFrame([
        (1, "Quantum spin chains. We study spin chains.", "Spin chains"),
        (2, "Graphs are fun. Random graphs percolate.", "Random graphs"),
    ], "id long, input_text string, target_text string")
    m = model.fit(pairs)
    reqs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["Spin chains. Graphs!", None, "  ", " Random graphs. x "] * 5)],
        "id long, abstract string")
    src = str(tmp_path / "src")
    reqs.repartition(4).write.parquet(src)
    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    q = start_predict_stream(spark, src, m, 100, out, chk, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    streamed = spark.read.parquet(out)
    assert streamed.select("batch_id").distinct().count() >= 2
    got = sorted(map(tuple, streamed.drop("batch_id").collect()))
    expect = sorted(map(tuple, predict_batch(reqs, m, 100).collect()))
    assert got == expect and len(got) == 20
    errors = [r for r in got if r[3] is not None]
    assert len(errors) == 10 and all(e[3] == INVALID_INPUT_MESSAGE and e[2] is None for e in errors)
    echoed = [r for r in got if r[1] == " Random graphs. x "]
    assert echoed and echoed[0][2] == "random graphs"


def test_stream_with_user_predictor_captures_errors(spark, tmp_path):
    from titlecorpus.schema import PREDICTION_ERROR_PREFIX
    reqs = spark.createDataFrame([(1, "fine text"), (2, "boom"), (3, " ")], "id long, abstract string")
    src = str(tmp_path / "src")
    reqs.write.parquet(src)

    def predictor(text):
        if text == "boom":
            raise ValueError("cannot title this")
        return text.title()

    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    q = start_predict_stream(spark, src, None, None, out, chk, predictor=predictor)
    q.awaitTermination()
    rows = {r.id: r for r in spark.read.parquet(out).collect()}
    assert rows[1].predicted_title == "Fine Text" and rows[1].error is None
    assert rows[2].predicted_title is None
    assert rows[2].error == PREDICTION_ERROR_PREFIX + "cannot title this"
    assert rows[3].error == INVALID_INPUT_MESSAGE


def test_replayed_batch_is_not_duplicated(spark, tmp_path):
    from titlecorpus.streaming.predict import write_predictions
    pairs = spark.createDataFrame([(1, "Spin chains. We study.", "Spin chains")],
                                  "id long, input_text string, target_text string")
    m = model.fit(pairs)
    batch = spark.createDataFrame([(1, "Spin chains."), (2, "")], "id long, abstract string")
    out = str(tmp_path / "out")
    write_predictions(batch, 0, out, m, 10)
    write_predictions(batch, 0, out, m, 10)  # the same batch again, e.g. after a failure
    write_predictions(batch, 1, out, m, 10)
    got = spark.read.parquet(out)
    assert got.count() == 4 and got.where("batch_id = 0").count() == 2


def test_stream_from_json_request_files(spark, tmp_path):
    import json as _json
    import pytest as _pytest
    pairs = spark.createDataFrame([(1, "Spin chains. We study spin chains.", "Spin chains")],
                                  "id long, input_text string, target_text string")
    m = model.fit(pairs)
    src = tmp_path / "json_requests"
    src.mkdir()
    (src / "a.json").write_text("\n".join(_json.dumps(r) for r in [
        {"id": 1, "abstract": "Spin chains. Nothing."}, {"id": 2, "abstract": " "}]) + "\n")
    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    q = start_predict_stream(spark, str(src), m, 10, out, chk, source_format="json")
    q.awaitTermination()
    rows = {r.id: r for r in spark.read.parquet(out).collect()}
    assert rows[1].predicted_title == "spin chains" and rows[2].error == INVALID_INPUT_MESSAGE
    with _pytest.raises(ValueError):
        start_predict_stream(spark, str(src), m, 10, out, chk, source_format="csv")


def test_repeated_and_null_ids_and_malformed_lines_keep_their_rows(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "Spin chains. Graphs are fun.", "Spin chains graphs")],
                                  "id long, input_text string, target_text string")
    m = model.fit(pairs)
    rows = [(1, "Spin chains."), (1, "Graphs."), (None, "Spin chains."), (None, "Graphs."), (1, "Graphs."), (2, None)]
    reqs = spark.createDataFrame(rows, "id long, abstract string")
    got = [(r.id, r.abstract, r.predicted_title, r.error) for r in predict_batch(reqs, m, 100).collect()]
    assert len(got) == len(rows)
    for i, text, title, error in got:
        assert title == (None if text is None else text.lower().rstrip(".")) and (error is None) == (text is not None)
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "abstract": "Graphs."}\n{broken\n{"abstract": "Spin chains."}\n')
    out = str(tmp_path / "out")
    for predictor in (None, str.upper):
        q = start_predict_stream(spark, str(src), m, 10, f"{out}-{predictor is None}", str(tmp_path / f"c{predictor is None}"),
                                 source_format="json", predictor=predictor)
        q.awaitTermination()
        got = spark.read.parquet(f"{out}-{predictor is None}").collect()
        assert len(got) == 3 and sum(r.error == INVALID_INPUT_MESSAGE for r in got) == 1
        assert {(r.id, r.abstract) for r in got} == {(1, "Graphs."), (None, "Spin chains."), (None, None)}


def test_long_span_windows_are_all_candidates(spark):
    pairs = spark.createDataFrame([(1, "gold dust and noise", "gold dust")], "id long, input_text string, target_text string")
    m = model.fit(pairs)
    text = " ".join(["noise"] * 131) + " gold dust"
    reqs = spark.createDataFrame([(1, text)], "id long, abstract string")
    assert predict_batch(reqs, m, 10, max_length=2).first().predicted_title in ("gold dust", "noise gold", "dust")


def test_second_run_keeps_the_first_ones_output(spark, tmp_path):
    import shutil

    import pytest as _pytest

    from titlecorpus.streaming.predict import default_checkpoint
    m = model.fit(spark.createDataFrame([(1, "Spin chains.", "Spin chains")], "id long, input_text string, target_text string"))
    src, out = tmp_path / "src", str(tmp_path / "out")
    for i in (1, 2):
        spark.createDataFrame([(i, "Spin chains.")], "id long, abstract string").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"r{i}"))
        src.mkdir(exist_ok=True)
        for f in (tmp_path / f"r{i}").glob("*.parquet"):
            shutil.copy(f, src / f"{i}.parquet")
        q = start_predict_stream(spark, str(src), m, 10, out, default_checkpoint(spark, out))
        q.awaitTermination()
        (src / f"{i}.parquet").unlink()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
    with _pytest.raises(ValueError):
        default_checkpoint(spark, out, str(tmp_path / "other"))


def test_model_changes_under_a_stream_and_a_replay_does_not(spark, tmp_path):
    from titlecorpus.streaming.predict import write_predictions
    kind = "id long, input_text string, target_text string"
    path, out, src = str(tmp_path / "m"), str(tmp_path / "out"), tmp_path / "src"
    src.mkdir()
    model.save_model(model.fit(spark.createDataFrame([(1, "Spin chains. Graphs grow.", "Spin chains")], kind)), path)
    batches = []
    for n in range(2):
        if n:
            model.save_model(model.fit(spark.createDataFrame([(1, "Spin chains. Graphs grow.", "Graphs grow")], kind)), path)
        (src / f"{n}.json").write_text('{"id": %d, "abstract": "Spin chains. Graphs grow."}\n' % n)
        q = start_predict_stream(spark, str(src), path, None, out, str(tmp_path / "chk"), source_format="json")
        q.awaitTermination()
        assert q.exception() is None
        batches.append(spark.createDataFrame([(n, "Spin chains. Graphs grow.")], "id long, abstract string"))
    want = {0: "spin chains", 1: "graphs grow"}
    read = lambda: {r.id: r.predicted_title for r in spark.read.parquet(f"{out}/batch_id=*").collect()}
    assert read() == want
    write_predictions(batches[0], 0, out, path, None)  # replayed under the newer model: still its own version
    assert read() == want
    write_predictions(batches[0], 5, out, path, None, num_beams=2, no_repeat_ngram_size=2)
    beams = spark.read.parquet(f"{out}/batch_id=5").orderBy("beam").collect()
    assert [r.predicted_title for r in beams] == ["graphs grow", "spin chains"]
