import pytest

from titlecorpus.operators import model
from titlecorpus.operators.evaluate import eval_loss, side_by_side


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([
        (1, "Quantum spin chains. We study spin chains in depth.", "Spin chains"),
        (2, "Graphs are fun. Random graphs percolate.", "Random graphs"),
        (3, "Spin glasses. Nothing else here.", "Spin glasses"),
    ], "id long, input_text string, target_text string")


def test_fit_counts_and_weight(spark, pairs):
    m = {r.token: r for r in model.fit(pairs).collect()}
    assert (m["spin"].n_abs, m["spin"].n_both) == (2, 2)
    assert m["spin"].weight == (1_000_000 * 5) // 6  # floor(1e6 * 2.5 / 3)
    assert (m["we"].n_abs, m["we"].n_both) == (1, 0)
    assert m["we"].weight == 250_000


def test_generate_best_span_and_null_rows(spark, pairs):
    m = model.fit(pairs)
    req = spark.createDataFrame([(10, "We study. Spin chains and graphs!"), (11, None), (12, "... !!")],
                                "id long, abstract string")
    out = {r.id: r for r in model.generate(req, m, n_model_rows=100).collect()}
    assert out[10].predicted_title == "spin chains and graphs"
    assert out[11].predicted_title is None and out[12].predicted_title is None
    assert len(out) == 3


def test_ties_go_to_earlier_span(spark, pairs):
    m = spark.createDataFrame([("a", 1, 1, 10), ("b", 1, 1, 10)], "token string, n_abs long, n_both long, weight long")
    req = spark.createDataFrame([(1, "b b. a a. b a")], "id long, abstract string")
    assert model.generate(req, m, n_model_rows=2).first().predicted_title == "b b"


def test_bigram_block_and_beams(spark):
    m = spark.createDataFrame([("a", 1, 1, 10), ("b", 1, 1, 9), ("c", 1, 1, 1)],
                              "token string, n_abs long, n_both long, weight long")
    req = spark.createDataFrame([(1, "a b a b. a b a c. c c")], "id long, abstract string")
    rows = model.generate(req, m, num_beams=4, no_repeat_ngram_size=2, n_model_rows=3).orderBy("beam").collect()
    # "a b a b" repeats the pair (a, b) and is dropped; "c c" has one pair only.
    assert [r.predicted_title for r in rows] == ["a b a c", "c c"]
    assert [r.beam for r in rows] == [1, 2]


def test_large_model_path_equals_broadcast(spark, pairs, tmp_path, no_broadcast):
    model.save_model(model.fit(pairs), str(tmp_path / "m"))
    m, _ = model.load_model(spark, str(tmp_path / "m"))
    req = pairs.select("id", "input_text").union(pairs.select("id", "input_text"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    df = model.generate(req, m, text_col="input_text")
    assert plan(df).count("Exchange hashpartitioning") <= 2
    small = sorted(map(tuple, df.collect()))
    no_broadcast()
    large = sorted(map(tuple, model.generate(req, m, text_col="input_text").collect()))
    assert small == large and len(small) == 2 * pairs.count()


def test_save_load(spark, pairs, tmp_path):
    m = model.fit(pairs)
    totals = model.save_model(m, str(tmp_path / "m"))
    tokens, t2 = model.load_model(spark, str(tmp_path / "m"))
    assert totals == t2 and t2["n_tokens"] == tokens.count() == m.count()


def test_eval_loss_and_side_by_side(spark, pairs):
    train = pairs.where("id < 3")
    ev = pairs.where("id = 3")
    r = eval_loss(train, ev).first()
    # train titles: spin chains random graphs -> T = 4, V = 4; eval: spin (k=1), glasses (k=0)
    import math
    expect = round((-math.log(2 / 9) - math.log(1 / 9)) / 2, 6)
    assert r.eval_loss == expect and r.n_tokens == 2
    pred = model.generate(ev, model.fit(train), text_col="input_text", n_model_rows=100)
    sbs = side_by_side(ev, pred).first()
    assert sbs.true_title == "Spin glasses" and sbs.overlap >= 1


def test_pass_through_options_agree(spark, pairs):
    m = model.fit(pairs)
    req = spark.createDataFrame([(1, "Spin chains. Graphs!", "a"), (2, None, "b"), (3, "x. y", "c")],
                                "id long, abstract string, tag string")
    base = {r.id: (r.predicted_title, r.score) for r in model.generate(req, m, n_model_rows=9).collect()}
    kept = {r.id: r for r in model.generate(req, m, n_model_rows=9, keep=("tag",)).collect()}
    carried = {r.id: r for r in model.generate(req, m, n_model_rows=9, carry=("tag",),
                                               text_as="abstract").collect()}
    assert set(kept) == set(carried) == {1, 2, 3}
    for i, (title, score) in base.items():
        assert (kept[i].predicted_title, kept[i].score) == (title, score)
        assert (carried[i].predicted_title, carried[i].score) == (title, score)
        assert kept[i].tag == carried[i].tag == {1: "a", 2: "b", 3: "c"}[i]
    assert carried[1].abstract == "Spin chains. Graphs!" and carried[2].abstract is None
