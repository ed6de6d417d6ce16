"""The profile dialect's whitespace class equals Python's str.isspace()
over every character of the Basic Multilingual Plane."""

from pyspark.sql import functions as F

from logsift.functions import fixed


def test_python_whitespace_class_matches_isspace(spark):
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    spark_space = {r.c for r in df.filter(F.col("c").rlike("^" + fixed.PY_SPACE + "\\z")).collect()}
    assert spark_space == {c for c in chars if c.isspace()}
    assert "".join(sorted(spark_space)) == "".join(sorted(fixed.PY_WHITESPACE))
