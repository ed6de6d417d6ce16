from pyspark.sql import functions as F

from logsift.functions.timestamps import extract_date, is_timestamp

CASES = [
    ("01.02.2024_10:00:00", True, "2024-02-01"),
    ("29.02.2024_10:00:00", True, "2024-02-29"),
    ("29.02.2023_10:00:00", True, None),
    ("29.02.1900_10:00:00", True, None),
    ("29.02.2000_10:00:00", True, "2000-02-29"),
    ("31.04.2024_10:00:00", True, None),
    ("00.01.2024_10:00:00", True, None),
    ("01.13.2024_10:00:00", True, None),
    ("01.01.0000_00:00:00", True, "0000-01-01"),
    ("1.02.2024_10:00:00", False, None),
    ("01.02.2024_10:00:00 ", False, None),
    ("01.02.2024_10:00:00 ", False, None),
    ("Mon,_5_Feb_2024_10:00:00_+0300", True, "2024-02-05"),
    ("Sun,_05_Feb_2024_10:00:00_+0000", True, "2024-02-05"),
    ("Mon,_31_Feb_2024_10:00:00_+0300", True, None),
    ("Mon,_5_FEB_2024_10:00:00_+0300", True, None),
    ("Mon,_5_Foo_2024_10:00:00_+0300", True, None),
    ("Mon,_5_Feb_2024_10:00:00_-0300", False, None),
    ("Xyz,_5_Feb_2024_10:00:00_+0300", False, None),
    (None, False, None),
]


def test_timestamp_shapes_and_dates(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "tok string")
    got = df.select(is_timestamp(F.col("tok")).alias("ts"), extract_date(F.col("tok")).alias("d")).collect()
    for (tok, ts, d), row in zip(CASES, got):
        assert row.ts == ts, tok
        assert row.d == d, tok
