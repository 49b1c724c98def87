from titlecorpus.operators.batch_udf import map_batches, predict_with, word_counts
from titlecorpus.schema import PREDICTION_ERROR_PREFIX


def test_map_batches_word_count(spark):
    df = spark.createDataFrame([(1, "a  b\u001cc"), (2, None), (3, "")], "id long, text string")
    out = {r.id: r.n_words for r in map_batches(df, word_counts, "id long, text string, n_words long").collect()}
    assert out == {1: 3, 2: None, 3: 0}


def test_per_record_failure(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "boom")], "id long, clean string")

    def predict(text):
        if text == "boom":
            raise RuntimeError("bad record")
        return text.upper()

    rows = {r.id: r for r in predict_with(df, predict).collect()}
    assert rows[1].predicted_title == "OK" and rows[1].error is None
    assert rows[2].predicted_title is None
    assert rows[2].error == PREDICTION_ERROR_PREFIX + "bad record"


def test_setup_runs_once_in_a_worker(spark, tmp_path):
    """A costly handle is made once per Python worker, over batches and tasks."""
    folder = str(tmp_path)

    def setup():
        import os
        import uuid
        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return {"factor": 3}

    def times(pdf, handle):
        import os
        return pdf.assign(y=pdf["id"] * handle["factor"], pid=os.getpid())

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = map_batches(spark.range(400).repartition(24), times, "id long, y long, pid long", setup=setup)
        rows = df.collect()
        df.collect()  # again: the workers still have it
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(r.y for r in rows) == [3 * k for k in range(400)]
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    # 24 tasks of two batches, twice: one load in each process.
    assert len(loads) == len(set(loads)) < 24 and {str(r.pid) for r in rows} <= set(loads)


def test_predictor_from_setup(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "boom")], "id long, clean string")

    def setup():
        known = {"ok": "Fine"}
        return lambda text: known[text]

    rows = {r.id: r for r in predict_with(df, None, setup=setup).collect()}
    assert rows[1].predicted_title == "Fine" and rows[2].error.startswith(PREDICTION_ERROR_PREFIX)
