"""Joins that spread heavy keys: equal to a plain left join, and no key in one place."""

import random

from pyspark.sql import functions as F

from titlecorpus.operators import encode, heavy, model


def rows_of(spark):
    r = random.Random(4)
    keys = ["the"] * 3000 + ["unseen"] * 3000 + [None] * 2000 + [f"w{r.randrange(900)}" for _ in range(4000)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, token string")


def test_spread_join_is_a_left_join(spark, no_broadcast, monkeypatch):
    no_broadcast()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(heavy, "REPLICAS", 16)
    rows = rows_of(spark)
    table = spark.createDataFrame([("the", 7), *((f"w{k}", k) for k in range(0, 900, 2)), ("never", 1)], "token string, weight int")
    assert not heavy.is_small(table)
    got = heavy.spread_join(rows, table, "token", ["i"])
    assert got.columns == ["token", "i", "weight"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(table, "token", "left").collect()))
    # Known, unknown and missing heavy keys each lie in many places.
    places = got.withColumn("p", F.spark_partition_id()).groupBy("token").agg(F.countDistinct("p").alias("places"), F.count("*").alias("n"))
    spread = places.where("n > 1000").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) == 3 and all(r.places >= 4 for r in spread)


def test_heavy_buckets_hold_all_heavy_keys(spark, monkeypatch):
    rows = rows_of(spark)
    found = {r["_bucket"] for r in heavy.heavy_buckets(rows, "token").collect()}
    want = {r["b"] for r in rows.where("token in ('the', 'unseen')").select(heavy.bucket("token").alias("b")).distinct().collect()}
    assert want <= found and len(found) <= heavy.SHARE
    monkeypatch.setattr(heavy, "SHARE", 10)
    assert {r["_bucket"] for r in heavy.heavy_buckets(rows, "token").collect()} == want
    assert heavy.heavy_buckets(rows.limit(0), "token").count() == 0


def test_small_by_sparks_estimate(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    assert heavy.is_small(spark.read.parquet(path))
    no_broadcast()
    assert not heavy.is_small(spark.read.parquet(path))


def test_row_keys_tell_fields_apart(spark):
    df = spark.createDataFrame([("a\x1fb", "c"), ("a", "b\x1fc"), (None, "x"), ("\x00", "x"), ("-", "x"), ("", "x")], "p string, q string")
    assert df.select(model.row_key(df).alias("k")).distinct().count() == 6


def looked_up_plainly(keys, table):
    return [[table.get(k) for k in (part.split() if isinstance(part, str) else part or [])] for part in keys]


def test_blocks_look_up_every_key(spark, monkeypatch):
    r = random.Random(5)
    texts = [[" ".join(f"w{r.randrange(60)}" for _ in range(r.randrange(9))) for _ in range(r.randrange(4))] for _ in range(300)] + [[""], [], ["w1"]]
    monkeypatch.setattr(heavy, "BLOCK_BYTES", 300)
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, keys array<string>")
    words = {f"w{k}": k for k in range(0, 60, 2)}
    n = heavy.block_count(rows, F.octet_length(F.array_join("keys", " ")))
    assert n > 10
    blocks = heavy.dealt(rows, "i", n)
    got = heavy.looked_up(blocks, blocks, spark.createDataFrame([*words.items(), (None, 5)], "word string, n int"), "word", "n")
    assert got.columns == ["i", "values"] and {x.i: x["values"] for x in got.collect()} == {i: looked_up_plainly(t, words) for i, t in enumerate(texts)}
    numbers = [[[1, None, 7, 1], []], [], [[4]]]
    blocks = heavy.dealt(spark.createDataFrame(list(enumerate(numbers)), "i long, keys array<array<int>>"), "i", 2)
    names = {1: "a", 4: "b"}
    got = heavy.looked_up(blocks, blocks, spark.createDataFrame([*names.items()], "id int, name string"), "id", "name")
    assert {x.i: x["values"] for x in got.collect()} == {i: looked_up_plainly(k, names) for i, k in enumerate(numbers)}


def written_by_shuffles(spark, df) -> int:
    """Rows that the shuffles of ``df`` write, as its plan counts them when it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    found, todo = {}, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec":
                found[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return sum(found.values())


def test_tokens_cross_the_network_once_a_block(spark, no_broadcast):
    text = " ".join(["a b c d e f g h."] * 60)
    df = spark.createDataFrame([(i, text, "a b") for i in range(50)], "id long, input_text string, target_text string")
    vocab = spark.createDataFrame([(c, 9, k) for k, c in enumerate("abcdefgh", 2)], "token string, count long, token_id int")
    model_table = spark.createDataFrame([(c, k) for k, c in enumerate("abcdefgh", 2)], "token string, weight long")
    no_broadcast()
    coded = encode.encode(df, vocab)
    coded_rows = coded.limit(1).collect()[0].input_ids
    # 50 rows of 480 tokens: some rows a document and a block, not one a token.
    assert coded_rows[:9] == [2, 3, 4, 5, 6, 7, 8, 9, 2] and written_by_shuffles(spark, coded) < 1000
    given = spark.createDataFrame([(i, coded_rows) for i in range(50)], "id long, input_ids array<int>")
    decoded = encode.decode(given, vocab)
    assert written_by_shuffles(spark, decoded) < 1000
    assert decoded.first().text == " ".join("abcdefgh" * 60)
    titles = model.generate(df, model_table, 128, text_col="input_text")
    assert written_by_shuffles(spark, titles) < 1000


def test_large_tables_give_what_small_ones_give(spark, no_broadcast, tmp_path):
    text = "The cat sat. " + "cat " * 7 + "! Unseen words only? the cat the cat. A"
    rows = [(1, text, "a cat"), (1, "the sat", None), (None, "cat", "sat"), (None, text, ""), (3, None, "x"), (4, "", "the"), (5, "...", "?"), (6, text, "a cat"), (6, text, "a cat")]
    df = spark.createDataFrame(rows, "id long, input_text string, target_text string")
    vocab = spark.createDataFrame([("the", 5, 2), ("cat", 4, 3), ("a", 2, 4)], "token string, count long, token_id int")
    weights = spark.createDataFrame([("the", 11), ("cat", 30), ("a", 0), ("sat", 30)], "token string, weight long")
    vocab = encode.save_vocab(vocab, str(tmp_path / "vocab"))
    weights.write.parquet(str(tmp_path / "weights"))
    weights = spark.read.parquet(str(tmp_path / "weights"))
    both = []
    for large in (False, True):
        if large:
            no_broadcast()
        assert heavy.is_small(vocab) is not large
        coded = encode.encode(df, vocab, input_len=9, label_len=3)
        got = [coded, encode.encode(df, vocab, input_len=9, label_len=3, mask_pad=True, keep=["target_text"])]
        given = coded.unionByName(coded.where("id = 1")).unionByName(spark.createDataFrame([(8, None, None)], "id long, input_ids array<int>, labels array<int>"))
        got += [encode.decode(given, vocab), encode.decode(given, vocab, unknown="<unk>")]
        for options in ({}, {"num_beams": 3}, {"num_beams": 2, "no_repeat_ngram_size": 2}):
            got.append(model.generate(df, weights, 3, text_col="input_text", carry=("target_text",), **options))
        both.append([sorted(map(str, x.collect())) for x in got])
    for small, big in zip(*both):
        assert small == big
