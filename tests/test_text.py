from pyspark.sql import functions as F

from titlecorpus.functions.text import is_blank, normalize_ws, strip_ws, tokenize
from titlecorpus.operators.validate import validate_requests
from titlecorpus.schema import INVALID_INPUT_MESSAGE


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr("t").alias("o")).first().o


def test_whitespace_collapse(spark):
    assert one(spark, normalize_ws, "  a  b\u001cc\n") == "a b c"
    assert one(spark, normalize_ws, "　x y ") == "x y"
    assert one(spark, normalize_ws, None) is None


def test_python_strip_semantics(spark):
    for s in ["  x ", "\u001fx\u0085", "x", " ", "​x"]:
        assert one(spark, strip_ws, s) == s.strip()


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" 　",), (" x ",)], "t string")
    assert [r.b for r in df.select(is_blank("t").alias("b")).collect()] == [True, True, True, False]


def test_tokenize(spark):
    assert one(spark, tokenize, "Héllo, WORLD-2024 ß  ") == ["héllo", "world", "2024", "ß"]
    assert one(spark, tokenize, "...") == []


def test_validation_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " 　"), (4, " x ")], "id long, abstract string")
    rows = validate_requests(df).orderBy("id").collect()
    assert [r.error for r in rows] == [INVALID_INPUT_MESSAGE] * 3 + [None]
    assert rows[3].clean == "x" and rows[3].abstract == " x "
    assert all(r.clean is None for r in rows[:3])


def test_no_python_in_text_plans(spark):
    df = spark.createDataFrame([("a b",)], "t string").select(
        normalize_ws("t"), strip_ws("t"), is_blank("t"), tokenize("t"), F.length("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
