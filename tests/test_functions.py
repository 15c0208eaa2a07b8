"""Column expressions on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from encore.functions import sentiment, text, times
from encore.functions.geo import haversine_km


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_parse_and_clip_keep_rows_and_null_bad_values(spark):
    rows = [("2015-12-31 23:59:59",), ("2016-01-01 00:00:00",), ("2018-12-31 23:59:59",),
            ("2019-01-01 00:00:00",), ("bad",), (None,)]
    got = values(spark, rows, "t string",
                 F.date_format(times.within_years(times.parse_timestamp(F.col("t"))), "yyyy"))
    assert got == [None, "2016", "2018", None, None, None]


def test_whole_days_round_down(spark):
    base = dt.datetime(2017, 5, 5, 12)
    hours = [36, -12, -24, -25, 0, None]
    rows = [(base, None if h is None else base + dt.timedelta(hours=h)) for h in hours]
    got = values(spark, rows, "a timestamp, b timestamp", times.whole_days(F.col("b"), F.col("a")))
    assert got == [1, -1, -1, -2, 0, None]


def test_hours_apart_is_absolute_and_takes_times_without_zone(spark):
    base = dt.datetime(2017, 5, 5, 12)
    rows = [(base, base - dt.timedelta(minutes=90)), (base, None)]
    got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz",
                 times.hours_apart(F.col("a"), F.col("b")))
    assert got == [1.5, None]


def test_zip_codes(spark):
    rows = [("123",), ("123456",), ("\t 77 ",), ("-12",), (None,)]
    assert values(spark, rows, "z string", text.zip_code(F.col("z"))) == [
        "00123", "123456", "00077", "-0012", None]
    assert values(spark, [(42,)], "z int", text.zip_code(F.col("z"))) == ["00042"]


def test_city_and_state(spark):
    rows = [(" São João d'Oeste\t",), ("STRASSE ß Æ",), ("é",), (None,)]
    assert values(spark, rows, "c string", text.city_name(F.col("c"))) == [
        "sao joao d'oeste", "strasse ss ae", "e", None]
    assert values(spark, [(" sp\x0b",)], "s string", text.state_code(F.col("s"))) == ["SP"]


def test_word_count(spark):
    rows = [("",), ("one",), (" a b\tc  d ",)]
    assert values(spark, rows, "t string", text.word_count(F.col("t"))) == [0, 1, 4]


def test_haversine(spark):
    rows = [(0.0, 0.0, 0.0, 180.0), (-23.5, -46.6, -23.5, -46.6), (45.7597, 4.8422, 48.8567, 2.3508)]
    got = values(spark, rows, "a double, b double, c double, d double",
                 haversine_km(*[F.col(c) for c in "abcd"]))
    assert got[0] == pytest.approx(math.pi * 6371.0088)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(392.2172595594006)


def test_sentiment_names(spark):
    rows = [("POS",), ("NEU",), ("NEG",), ("odd",), (None,)]
    assert values(spark, rows, "l string", sentiment.sentiment_name(F.col("l"))) == [
        "positive", "neutral", "negative", "neutral", "neutral"]


def test_keyword_override(spark):
    rows = [("Tudo certo", "neutral"), ("muito BOM mesmo e chegou antes do prazo", "neutral"),
            ("conforme", "neutral"), ("um dois tres quatro cinco conforme", "neutral"),
            ("Tudo certo", "negative"), ("", "neutral")]
    got = values(spark, rows, "t string, s string",
                 sentiment.keyword_override(sentiment.plain_text(F.col("t")), F.col("s")))
    assert got == ["positive", "positive", "positive", "neutral", "negative", "neutral"]


def test_blank_comments(spark):
    rows = [(" \t",), (None,), ("x",)]
    assert values(spark, rows, "t string", sentiment.blank_label(F.col("t"), F.lit("neutral"))) == [
        "No comment", "No comment", "neutral"]


def test_verified_rating_covers_all_pairs(spark):
    kinds = ["positive", "neutral", "negative", "No comment"]
    rows = [(s, n) for s in kinds for n in [1, 2, 3, 4, 5]]
    got = values(spark, rows, "s string, n int", sentiment.verified_rating(F.col("s"), F.col("n")))
    assert got == (
        [False, False, False, True, True] + [False, False, True, True, True]
        + [True, True, False, False, False] + [None] * 5)


@pytest.mark.parametrize("comment,label", [
    ("Produto ótimo, recomendo", "POS"), ("chegou atrasado e quebrado", "NEG"),
    ("não gostei", "NEG"), ("sem defeitos", "POS"), ("não  recomendo, péssimo!", "NEG"),
    ("entrega no prazo", "NEU"), ("bom produto mas atrasou", "NEU"), ("embora", "NEU"), ("", "NEU"),
    ("Não, bom", "POS"), ("BOM", "POS"), ("nunca atrasa e nem falta", "POS"),
])
def test_lexicon_label(spark, comment, label):
    df = spark.createDataFrame([(comment,)], "c string")
    plain = sentiment.plain_text(F.col("c"))
    assert df.select(sentiment.lexicon_label(plain)).first()[0] == label
