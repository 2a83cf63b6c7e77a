import json
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from cartloom.functions.rendering import JSON_OPTIONS, row_json

SCHEMA = "i int, s string, d decimal(12,2), e decimal(20,10), b boolean, t timestamp, n timestamp_ntz, f double, a array<string>, y date"
STRINGS = ["plain", "", 'quo"te', "back\\slash", "tab\tnew\nline", "\u0001", "Ünïcödé 漢字 😀", None, " spaced ", "a/b", "{}", "\x7f"]


def test_json_equals_the_general_writer(spark):
    moment = datetime(2024, 1, 31, 23, 59, 59, tzinfo=timezone.utc)
    rows = [
        (i, s, Decimal("5.00"), Decimal("1.5"), i % 2 == 0, moment, datetime(2024, 2, 1), 1e7 + i / 3, ["x", s], date(2024, 1, 2))
        for i, s in enumerate(STRINGS)
    ]
    rows.append((None,) * 10)
    df = spark.createDataFrame(rows, SCHEMA)
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssxxx", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'+00:00'"}
    general = F.to_json(F.struct(*df.columns), {**JSON_OPTIONS, **iso})
    for mine, theirs in df.select(row_json(df), general).collect():
        assert mine == theirs
        json.loads(mine)


def test_fractions_of_seconds_are_kept(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.1700' AS t, timestamp_ntz'2024-01-01 00:00:07' AS u")
    assert df.select(row_json(df)).first()[0] == '{"t":"2024-01-01T00:00:07.17+00:00","u":"2024-01-01T00:00:07+00:00"}'
