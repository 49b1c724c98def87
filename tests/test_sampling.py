import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from titlecorpus.functions.keys import seeded_hash
from titlecorpus.operators import rank as rank_mod
from titlecorpus.operators import sampling, select, splits
from titlecorpus.operators.rank import HashOrder, global_rank, hash_rank


@pytest.mark.parametrize("n,expected", [(1, 0), (4, 0), (5, 0), (15, 2), (25, 2), (35, 4),
                                        (45, 4), (100, 10), (105, 10)])
def test_fraction_size(spark, n, expected):
    assert splits.fraction_size(0.1, n) == expected
    df = spark.range(n)
    got = splits.split_fraction(df, 0.1, seed=42).where("split = 'eval'").count()
    assert got == expected


def test_three_way_sizes(spark):
    assert splits.three_way_sizes(0.1, 1000) == (100, 50)
    assert splits.three_way_sizes(0.2, 1000) == (200, 100)
    df = splits.split_three_way(spark.range(1000), 0.1, seed=42)
    counts = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 900, "validation": 50, "test": 50}


def test_split_properties(spark):
    df = spark.range(777).withColumnRenamed("id", "id")
    s = splits.split_fraction(df, 0.1, seed=42)
    ev = {r.id for r in s.where("split = 'eval'").collect()}
    tr = {r.id for r in splits.complement(df, s.where("split = 'eval'")).collect()}
    assert ev.isdisjoint(tr) and ev | tr == set(range(777)) and len(ev) == 78
    again = {r.id for r in splits.split_fraction(df.repartition(16), 0.1, seed=42)
             .where("split = 'eval'").collect()}
    one = {r.id for r in splits.split_fraction(df.repartition(1), 0.1, seed=42)
           .where("split = 'eval'").collect()}
    assert ev == again == one
    other = {r.id for r in splits.split_fraction(df, 0.1, seed=7).where("split = 'eval'").collect()}
    assert other != ev


def brute_rank(df, seed):
    w = Window.orderBy(seeded_hash("id", seed), F.col("id"))
    return {r.id: r.rk for r in df.select("id", F.row_number().over(w).alias("rk")).collect()}


def test_hash_rank_equals_brute_force(spark):
    df = spark.range(3000).repartition(7)
    got = {r.id: r["rank"] for r in hash_rank(df, "id", 42).collect()}
    assert got == brute_rank(df, 42)


def test_cut_with_refinement(spark, monkeypatch):
    monkeypatch.setattr(rank_mod, "_EXACT_LIMIT", 3)
    monkeypatch.setattr(rank_mod, "_BUCKET_DIGITS", 1)
    df = spark.range(500)
    ref = brute_rank(df, 42)
    for k in (0, 1, 37, 250, 499, 500, 900):
        got = {r.id for r in df.where(HashOrder(df, "id", 42).cut(k)).collect()}
        assert got == {i for i, rk in ref.items() if rk <= k}


def test_global_rank_any_order(spark):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(101)], "id long, v long").repartition(5)
    got = {r.id: r["rank"] for r in global_rank(df, ["v", "id"], num_partitions=4).collect()}
    expected = {i: rk + 1 for rk, i in enumerate(sorted(range(101), key=lambda i: (i * 37) % 101))}
    assert got == expected


def test_first_n_any_size(spark):
    df = spark.range(100).repartition(3)
    for n in (0, 1, 40, 99, 100, 500):
        assert [r.id for r in select.first_n(df, ["id"], n).orderBy("id").collect()] == list(range(min(n, 100)))
    assert select.first_n(df, ["id"], None).count() == 100
    assert [r.id for r in select.first_n(df, ["id"], -95).orderBy("id").collect()] == list(range(5))


def test_first_n_and_row_at_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "d"), (1, "e"), (2, "f")], "k int, v string").repartition(4)
    expected = [None, None, 1, 1, 1, 2]
    for n in range(7):
        got = [r.k for r in select.first_n(df, ["k"], n).collect()]
        assert sorted(got, key=lambda k: -1 if k is None else k) == expected[:n]
    assert [select.row_at(df, "k", i).first().k for i in range(6)] == expected
    assert select.row_at(df, "k", 6).count() == 0
    assert select.first_n(df.limit(0), ["k"], 3).count() == 0


def test_sample_n_with_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e"), (None, "f")], "id long, v string")
    for n in range(7):
        assert sampling.sample_n(df, n, 42).count() == n
    index = sampling.sample_n_reindexed(df, 4, 42).collect()
    assert sorted(r["index"] for r in index) == [0, 1, 2, 3]


def test_sample_n(spark):
    df = spark.range(200)
    small = {r.id for r in sampling.sample_n(df, 30, 42).collect()}
    assert len(small) == 30 and small == {i for i, rk in brute_rank(df, 42).items() if rk <= 30}
    assert sampling.sample_n(df, 1000, 42).count() == 200
    with pytest.raises(ValueError):
        sampling.sample_n_strict(df, 201, 42)
    idx = sampling.sample_n_reindexed(df, 10, 42).orderBy("index").collect()
    assert [r["index"] for r in idx] == list(range(10))
    assert {r.id for r in idx} == {r.id for r in sampling.sample_n(df, 10, 42).collect()}


def test_draws_with_replacement(spark, monkeypatch):
    df = spark.range(10)
    d1 = sampling.draw_with_replacement(df, 50, seed=7).orderBy("draw").collect()
    d2 = sampling.draw_with_replacement(df, 50, seed=7).orderBy("draw").collect()
    assert len(d1) == 50 and d1 == d2
    assert len({r.id for r in d1}) < 50  # repeats happen with 50 draws from 10
    ref = brute_rank(df, 42)
    assert all(ref[r.id] == r["rank"] for r in d1)


def test_rows_at_sparse_ranks(spark, monkeypatch):
    monkeypatch.setattr(rank_mod, "_BUCKET_DIGITS", 2)
    df = spark.range(2000).repartition(5)
    ref = brute_rank(df, 42)
    got = {r["rank"]: r.id for r in HashOrder(df, "id", 42).rows_at([1, 777, 2000, 5000]).collect()}
    assert got == {rk: i for i, rk in ref.items() if rk in (1, 777, 2000)}


def test_epoch_batches(spark):
    b = sampling.epoch_batches(spark.range(10), epochs=2, batch_size=4, seed=42)
    rows = b.collect()
    assert len(rows) == 20
    for e in (0, 1):
        sizes = sorted((r.batch_id for r in rows if r.epoch == e))
        assert [sizes.count(i) for i in range(3)] == [4, 4, 2]
    order0 = [r.id for r in sorted((r for r in rows if r.epoch == 0), key=lambda r: r.position)]
    order1 = [r.id for r in sorted((r for r in rows if r.epoch == 1), key=lambda r: r.position)]
    assert sorted(order0) == list(range(10)) and order0 != order1
    assert sampling.epoch_batches(spark.range(10), epochs=0, batch_size=4, seed=42).count() == 0


def test_complement_by_filter(spark, monkeypatch):
    df = spark.createDataFrame([(k if k % 11 else None, f"t{k}") for k in range(400)], "id long, _word string")
    part = spark.createDataFrame([(k,) for k in range(0, 400, 3)] + [(None,), (10**9,)], "id long")
    want = sorted(map(str, df.join(part, "id", "left_anti").select(*df.columns).collect()))
    for words in (splits.FILTER_WORDS, 2):  # two words hold every bit: all rows are hits
        monkeypatch.setattr(splits, "FILTER_WORDS", words)
        got = splits.complement(df.withColumnRenamed("_word", "text"), part).withColumnRenamed("text", "_word")
        assert sorted(map(str, got.collect())) == want
    monkeypatch.undo()
    assert splits.complement(df.select("id"), part.limit(0)).count() == 400


def test_sure_non_members_are_not_shuffled(spark, no_broadcast):
    no_broadcast()
    df = spark.range(100000).withColumn("text", F.lit("x"))
    part = spark.range(50, 150)
    out = splits.complement(df, part)
    assert out.count() == 99900
    bits = splits.key_filter(part, "id")
    assert bits.count() <= 100
    h, mask = splits._bits("id")
    probed = df.withColumn("_h", h).withColumns({"_word": F.pmod("_h", F.lit(splits.FILTER_WORDS)), "_mask": mask}).join(bits, "_word")
    assert 100 <= probed.where("_held & _mask = _mask").count() < 110  # the members and hardly any other
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan.split("Union")[1].split("BroadcastHashJoin")[0]



def test_many_draws_stay_distributed(spark, monkeypatch):
    """More draws than rows: equal to picking ranks one by one; no position passes the driver."""
    n, k = 700, 20000
    df = spark.range(n).withColumn("t", F.concat(F.lit("x"), F.col("id"))).repartition(5)
    ranks = {r.id: r.rank for r in HashOrder(df, "id", 42).rank().collect()}
    at = {r: i for i, r in ranks.items()}
    from pyspark.sql.classic.dataframe import DataFrame
    seen, plain = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(len(x := plain(self))) or x)
    out = sampling.draw_with_replacement(df, k, seed=7)
    monkeypatch.undo()
    assert max(seen) <= n  # the histogram of the rows alone
    got = {r.draw: (r["rank"], r.id, r.t) for r in out.collect()}
    import hashlib
    want = {d: 1 + int(hashlib.md5(f"7:{d}".encode()).hexdigest()[:8], 16) % n for d in range(k)}
    assert got == {d: (r, at[r], f"x{at[r]}") for d, r in want.items()}
