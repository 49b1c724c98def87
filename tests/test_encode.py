from titlecorpus.operators.encode import LABEL_IGNORE, PAD_ID, UNK_ID, build_vocab, encode


def test_vocab_order_and_ids(spark):
    df = spark.createDataFrame([(1, "b a a c", "a"), (2, "b d", "c")], "id long, input_text string, target_text string")
    v = {r.token: (r["count"], r.token_id) for r in build_vocab(df, ["input_text", "target_text"], 3).collect()}
    # a:3, b:2, c:2 (tie -> token order), d:1 cut by the size
    assert v == {"a": (3, 2), "b": (2, 3), "c": (2, 4)}


def test_pad_and_mask(spark):
    df = spark.createDataFrame([(1, "x y", "x y"), (2, "zz", None), (3, "", "")],
                               "id long, input_text string, target_text string")
    vocab = spark.createDataFrame([("x", 5, 7), ("y", 4, 8)], "token string, count long, token_id int")
    rows = {r.id: r for r in encode(df, vocab, input_len=4, label_len=4).collect()}
    assert rows[1].input_ids == [7, 8, PAD_ID, PAD_ID]
    assert rows[1].labels == [7, 8, 0, 0]
    assert rows[2].input_ids == [UNK_ID, 0, 0, 0] and rows[2].labels == [0, 0, 0, 0]
    assert rows[3].input_ids == [0, 0, 0, 0]
    masked = {r.id: r for r in encode(df, vocab, input_len=4, label_len=4, mask_pad=True).collect()}
    assert masked[1].labels == [7, 8, LABEL_IGNORE, LABEL_IGNORE]
    assert masked[1].input_ids == [7, 8, 0, 0]


def test_truncation(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "a b c")], "id long, input_text string, target_text string")
    vocab = spark.createDataFrame([("a", 1, 2)], "token string, count long, token_id int")
    r = encode(df, vocab, input_len=3, label_len=2).first()
    assert r.input_ids == [2, 1, 1] and r.labels == [2, 1]


def test_encode_single_shuffle(spark, tmp_path):
    from titlecorpus.operators.encode import save_vocab
    df = spark.createDataFrame([(1, "a b", "a")], "id long, input_text string, target_text string")
    vocab = save_vocab(spark.createDataFrame([("a", 1, 2)], "token string, count long, token_id int"), str(tmp_path / "v"))
    plan = encode(df, vocab)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_vocab_spreads_hot_tokens(spark, no_broadcast):
    df = spark.createDataFrame([(i, "a b c " + "z" * 80, "a") for i in range(20)] + [(99, None, "")],
                               "id long, input_text string, target_text string")
    vocab = spark.createDataFrame([("a", 9, 2), ("b", 5, 3), ("z" * 80, 4, 4)], "token string, count long, token_id int")
    whole = sorted(map(tuple, encode(df, vocab, input_len=5, label_len=2).collect()))
    no_broadcast()
    split = sorted(map(tuple, encode(df, vocab, input_len=5, label_len=2).collect()))
    assert whole == split and split[0][1] == [2, 3, 1, 4, 0] and split[-1][1] == [0] * 5


def test_vocab_capped_and_whole(spark):
    from titlecorpus.operators import encode as enc
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 7 + 1)), "t") for i in range(50)],
                               "id long, input_text string, target_text string")
    whole = sorted(map(tuple, enc.build_vocab(df, ["input_text"]).collect()), key=lambda r: r[2])
    capped = sorted(map(tuple, enc.build_vocab(df, ["input_text"], 5).collect()), key=lambda r: r[2])
    assert len(whole) == 7 and capped == whole[:5] and [r[2] for r in whole] == list(range(2, 9))
