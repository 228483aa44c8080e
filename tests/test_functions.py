"""Column functions against plain Python, and the traps that the wrong function falls into."""

import random
from datetime import datetime, timedelta
from math import floor

from pyspark.sql import functions as F

from dwellspark.functions.dates import updated_at
from dwellspark.functions.links import absolute
from dwellspark.functions.money import to_eur
from dwellspark.functions.places import area_of_location, area_of_title, without_repeated_head
from dwellspark.functions.text import captured, decimal_number, digits, elapsed_days, lines_of, matches, stripped, truthy, whole


def one(spark, column, **values):
    types = ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'timestamp'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], types).select(column.alias("x")).first()["x"]


def test_rounding_is_half_even(spark):
    rng = random.Random(1)
    values = [x / 2 for x in range(-9, 10)] + [rng.uniform(-1e6, 1e6) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", whole(F.col("v")).alias("w")).collect()
    assert all(r["w"] == round(r["v"]) for r in rows)


def test_elapsed_days_floor(spark):
    start = datetime(2024, 3, 1, 12)
    for hours in (-25, -1, 0, 1, 23, 24, 47, 48, 1000):
        got = one(spark, elapsed_days(F.col("a"), F.col("b")), a=start, b=start + timedelta(hours=hours))
        assert got == floor(hours / 24)


def test_unicode_patterns(spark):
    assert one(spark, captured(F.col("t"), r"Цена\s*:\s*([\d\s]+)\s?€"), t="Цена : 125 000 €").strip("  ") == "125 000"
    assert one(spark, captured(F.col("t"), r"(\w+)$"), t="x Б1") == "Б1"
    assert one(spark, captured(F.col("t"), r"(\d+)"), t="без") is None
    assert one(spark, matches(F.col("t"), "днес", ignore_case=True), t="ДНЕС") is True
    assert one(spark, stripped(F.col("t")), t=" \t а б \n ") == "а б"
    assert one(spark, lines_of(F.col("t")), t=" a \n\n \nб\n") == ["a", "б"]


def test_numbers(spark):
    assert one(spark, digits(F.col("t")), t=" 1 250 ") == 1250
    assert one(spark, digits(F.col("t")), t="  ") is None
    assert one(spark, decimal_number(F.col("t")), t="85,5") == 85.5
    assert one(spark, decimal_number(F.col("t")), t="1.234,5") is None
    assert one(spark, truthy(F.col("n")), n=0) is False
    assert one(spark, to_eur(F.col("n"), "BGN"), n=195583) == 100000
    assert one(spark, to_eur(F.col("n"), "BGN"), n=244479) == 125000
    assert one(spark, to_eur(F.col("n"), "USD"), n=77) == 77


def test_repeated_head_against_a_model(spark):
    def model(area):
        words = area.split()
        again = [i for i in range(1, len(words)) if words[i] == words[0]]
        return " ".join(words[again[-1] :]) if again else area

    rng = random.Random(4)
    areas = ["Люлин 5 Люлин 7", "Люлин", "a a", "a b a c a"] + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    rows = spark.createDataFrame([(a,) for a in areas], "a string").select("a", without_repeated_head(F.col("a")).alias("x")).collect()
    assert all(r["x"] == model(r["a"]) for r in rows)


def test_areas(spark):
    assert one(spark, area_of_title(F.col("t")), t="Flat, sofia,  Lozenets ") == "Lozenets"
    assert one(spark, area_of_title(F.col("t")), t="Flat") == "Sofia"
    assert one(spark, area_of_location(F.col("t")), t="Изток, София") == "Изток"
    assert one(spark, area_of_location(F.col("t")), t=", София") == "Sofia"


def test_dates(spark):
    now = datetime(2026, 8, 21, 9, 30)
    for line, want in (
        ("гр. София - ДНЕС", now),
        ("x - Вчера", now - timedelta(days=1)),
        ("- Обновено на 20 август 2026 г.", datetime(2026, 8, 20)),
        ("- Обновено на 30 февруари 2026 г.", None),
        ("- Обновено на 3 foo 2026 г.", None),
        ("без дата", None),
    ):
        assert one(spark, updated_at(F.col("t"), F.col("now")), t=line, now=now) == want


def test_addresses(spark):
    for address, want in (("//h/x.jpg", "https://h/x.jpg"), ("/x.jpg", "https://b/x.jpg"), ("x.jpg", "https://b/x.jpg"), ("http://h/x", "http://h/x")):
        assert one(spark, absolute(F.col("t"), "https://b", relative=True), t=address) == want
    assert one(spark, absolute(F.col("t"), "https://b"), t=None) is None
