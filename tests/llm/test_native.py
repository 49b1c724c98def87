"""Operators with an SQL form against it, and the defined results of odd inputs."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_queries import normalized
from titlecorpus.llm import quality, url_filter, warc
from titlecorpus.llm.queries import ORACLE_SQL, QUERIES


def tables(spark, tmp_path, **frames):
    for name, df in frames.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet{'' if sf_dir == SF_SMALL else '/*.parquet'}')")
        except duckdb.IOException:
            pass
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert normalized(rows, df.columns) == normalized(rel.fetchall(), cols)
    return {r[0]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert against_sql(spark, SF_SMALL, name)


LOREM = " ".join(f"word{i}" for i in range(60))


def test_quality_odd_texts(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n\t\n "), (4, LOREM), (4, LOREM), (5, "a b c a b c a b c"), (6, "x y z\nx y z\n\nx y z"),
            (7, "### $$$ " * 40), (8, "\x0b".join(LOREM.split())), (9, "a\u00a0b " + LOREM), (10, "é𝔘 " * 55), (11, LOREM * 200), (None, LOREM)]
    got = against_sql(spark, tables(spark, tmp_path, documents=spark.createDataFrame(rows, "doc_id long, text string")), "op1_quality_rules")
    assert got[1][1] == 0 and got[1][-2:] == (True, False) and got[4][-1] and not got[7][-1]
    assert got[5][5] == 9 and got[6][4] == 2


def test_quality_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, LOREM, 7, "x")], "doc_id long, text string, n_words long, kept string")
    row = quality.judge_quality(df).first()
    assert row.n_words == 60 and row.kept is True and row.rejected_by is None
    assert quality.judge_quality(df.limit(0)).count() == 0


def test_cascade_order_changes_work_not_results(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = list(quality.RULES)
    kept = [docs.where(quality.cascade(quality.RULES, order).isNull()).select("doc_id").collect() for order in (names, names[::-1])]
    assert sorted(kept[0]) == sorted(kept[1])
    found = quality.rule_order(docs, quality.RULES, rows=50)
    assert sorted(n for n, *_ in found) == sorted(names)
    gain = [share / cost for _, cost, share in found]
    assert gain == sorted(gain, reverse=True)


def test_urls_odd(spark, tmp_path):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "http://a.net", "http://a.net?x=/", "http://net/", "http://xnet/a", "https://b.example.com/de/1",
            "https://b.example.com/en/12.html", "http://q.org/fr/", "http://q.org/fr", "a://b://c/d", "http://ü.ORG/fr/Ä", "http://u@h.net:80/p", "http://x.com/7", "http://x.com/7", "http://l\nf.net/a\nb"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(7, 0, 0), (7, 1, 1), (12, 1, 0), (1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = against_sql(spark, tables(spark, tmp_path, pages=pages, labels=labels), "op9_url_filter")
    assert got[4][1:] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[5][2:4] == ("", None)
    assert got[7][3] == "net/" and got[8][3] is None and got[0][1:4] == ("", "", None) and got[14][3] == "org/fr/"


def test_urls_without_pages_or_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.com/1", "x")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_filter.filter_urls(pages, url_filter.page_outcomes(pages, none)).first()
    assert got.host == "a.com" and got.verdict == "allow"
    assert url_filter.filter_urls(pages.limit(0), url_filter.page_outcomes(pages.limit(0), none)).count() == 0


def test_reputation_shrinks_towards_the_domain(spark):
    hosts = spark.createDataFrame([("a.bad.com", 50, 50, 50), ("b.bad.com", 40, 40, 39), ("new.bad.com", 1, 0, 0),
                                   ("a.ok.com", 50, 50, 0), ("b.ok.com", 1, 1, 1), ("c.ok.com", 60, 60, 1)], "host string, pages long, n long, k long")
    got = {r.host: r for r in url_filter.host_reputation(hosts).collect()}
    assert got["a.bad.com"].host_verdict == "block" and got["a.ok.com"].host_verdict == "allow"
    assert got["new.bad.com"].bad_rate > 0.4 > got["b.ok.com"].bad_rate or got["b.ok.com"].bad_rate < 1
    assert got["b.ok.com"].host_verdict == "allow"


def test_warc_pages(spark, tmp_path):
    big, other = "<p>é" + "x" * 1200, "y" * 1000
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, "http://a\r\nEvil: 1", big), (2, None, None), (4, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "u", other), (9, "u", "z" * 999), (10, "v", "z" * 999)]
    sf = tables(spark, tmp_path, pages=spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = against_sql(spark, sf, "op4_warc")
    assert got[1][3:] == ("revisit", 5) and got[5][3:] == ("response", None) and got[9][3] == "response" and got[2][1] == 0
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_pages(empty, str(tmp_path / "none"))
    assert warc.read_pages(spark, str(tmp_path / "none")).count() == 0


def test_warc_filters_and_columns(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "w")
    rows = spark.createDataFrame([("response", f"urn:{i}", f"http://h/{i % 3}", bytes([i]) * 3000) for i in range(40)], "record_type string, record_id string, target_uri string, payload binary")
    rows.repartition(3).write.format("warc").mode("append").save(path)
    rows.limit(0).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc").load(path)
    assert read.count() == 40 and sorted(r.payload[0] for r in read.collect()) == list(range(40))
    some = spark.read.format("warc").schema("record_id string, target_uri string").load(path).where("target_uri = 'http://h/1' and record_id like 'urn:1%'")
    assert sorted(r.record_id for r in some.collect()) == ["urn:1", "urn:10", "urn:13", "urn:16", "urn:19"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0] or "StartsWith" not in plan.split("BatchScan")[0]
    assert read.where("refers_to is null and record_type in ('response')").count() == 40
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.startswith("_temporary")]


def test_warc_files_of_others(spark, tmp_path):
    """Plain archives, and gzip members without lengths, with headers in other cases and unknown ones."""
    import gzip
    warc.register(spark)
    plain = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
             b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:x>\r\nContent-Type: text/plain\r\nX-Odd: 1\r\nContent-Length: 7\r\n\r\na\r\n\r\nbc\r\n\r\n")
    one, two = plain.split(b"hello\r\n\r\n")
    d = tmp_path / "o"
    d.mkdir()
    (d / "a.warc").write_bytes(plain)
    (d / "b.warc.gz").write_bytes(gzip.compress(one + b"hello\r\n\r\n") + gzip.compress(two))
    read = spark.read.format("warc").load(str(d))
    assert sorted((r.record_type, r.payload) for r in read.collect()) == [("resource", bytearray(b"a\r\n\r\nbc"))] * 2 + [("warcinfo", bytearray(b"hello"))] * 2
    assert read.where(F.col("record_type") == "resource").select("record_id").distinct().first()[0] == "urn:x"


def test_two_measurements_agree_on_the_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    left = lambda c: f"length(regexp_replace({{t}}, '[^a-{c}]+', ''))"
    rules = {"dear": f"({' + '.join(map(left, 'zyxwvutsr'))}) % 3 > 0", "cheap": "length({t}) % 3 > 0", "middle": f"({left('z')} + {left('y')}) % 3 > 0"}
    for _ in range(2):
        assert [n for n, *_ in quality.rule_order(docs, rules)] == ["cheap", "middle", "dear"]
