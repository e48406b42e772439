import pytest
from pyspark.sql import functions as F

from affinity.functions.numeric import half_down, safe_ratio, significance_weight, truncate_int
from affinity.functions.text import distinct_tokens, sentence, tokens


@pytest.mark.parametrize("x,expected", [
    (3.52985, 3.5298), (3.529851, 3.5299), (0.00005, 0.0), (-0.00015, -0.0001), (2.0, 2.0),
])
def test_half_down(spark, x, expected):
    got = spark.range(1).select(half_down(F.lit(x)).alias("v")).first()["v"]
    assert got == pytest.approx(expected, abs=1e-12)


def test_truncation_and_ratio(spark):
    r = spark.range(1).select(
        truncate_int(F.lit(119.99)).alias("t"),
        safe_ratio(F.lit(1.0), F.lit(0.0)).alias("z"),
        significance_weight(F.lit(10)).alias("w1"),
        significance_weight(F.lit(80)).alias("w2")).first()
    assert r["t"] == 119 and r["z"] is None
    assert r["w1"] == pytest.approx(0.2) and r["w2"] == 1.0


def test_tokens(spark):
    df = spark.createDataFrame([("Красный aa_b x 42 foo-bar",)], "s string")
    assert df.select(tokens("s").alias("t")).first()["t"] == ["красный", "aa_b", "42", "foo", "bar"]
    df2 = spark.createDataFrame([("a bb bb cc",)], "s string")
    assert sorted(df2.select(distinct_tokens("s").alias("t")).first()["t"]) == ["bb", "cc"]


def test_sentence_skips_nulls(spark):
    df = spark.createDataFrame([(" Red ", None, "BOLT")], "a string, b string, c string")
    assert df.select(sentence(["a", "b", "c"]).alias("s")).first()["s"] == "red bolt"
