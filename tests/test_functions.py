import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    clean_phone,
    clean_url,
    date_of,
    fill_default,
    first_non_null,
    full_address,
    sanitize,
    valid_latitude,
    valid_longitude,
)


def apply(spark, values, function, kind="string"):
    """``function`` over a stored column, so that it runs in tasks and is not folded."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, v {kind}").repartition(2)
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).sort("i").collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("+ 351 289 815 218", "351289815218"),
        ("+1-503-555-1234", "5035551234"),
        ("15035551234", "5035551234"),
        ("+5", "5"),
        ("++15", "+15"),
        ("11", "1"),
        ("503 555 ext. 12", "50355512"),
        ("555+1", "555+1"),
        ("n/a", ""),
        ("", ""),
        (None, None),
    ],
)
def test_clean_phone(spark, value, expected):
    assert apply(spark, [value], clean_phone) == [expected]


def test_clean_url(spark):
    values = [r"http:\/\/www.shop.example", "http://a", r"a\b", None]
    assert apply(spark, values, clean_url) == ["http://www.shop.example", "http://a", r"a\b", None]


def test_fills_keep_empty_strings(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("a", "b"), (None, None)], "a string, b string")
    got = df.select(first_non_null("a", "b"), fill_default("a", "no_country")).collect()
    assert [tuple(r) for r in got] == [("b", "no_country"), ("", ""), ("a", "a"), (None, "no_country")]


PARTS = ["514 51st Ave", None, None, "Long Island City", "New York", "11101-5879", "United States"]
NAMES = ["a1", "a2", "a3", "city", "state", "postal", "country"]


def address(spark, parts, **options):
    df = spark.createDataFrame([tuple(parts)], ", ".join(f"{n} string" for n in NAMES))
    return df.select(full_address(*NAMES, **options)).first()[0]


def test_full_address(spark):
    whole = "514 51st Ave, Long Island City, New York 11101-5879, United States"
    assert address(spark, PARTS) == whole
    more = [*PARTS[:1], "Suite 4", "Rear", *PARTS[3:]]
    assert address(spark, more) == whole.replace("Ave,", "Ave, Suite 4, Rear,")
    assert address(spark, [PARTS[0], "", *PARTS[2:]]).startswith("514 51st Ave, , Long")


@pytest.mark.parametrize("missing", [0, 3, 4, 5, 6])
def test_full_address_needs_its_parts(spark, missing):
    parts = [None if i == missing else p for i, p in enumerate(PARTS)]
    assert address(spark, parts) is None


def test_full_address_of_what_there_is(spark):
    parts = [*PARTS[:4], None, *PARTS[5:]]
    assert address(spark, parts, skip_nulls=True) == (
        "514 51st Ave, Long Island City, 11101-5879, United States"
    )
    assert address(spark, [None] * 7, skip_nulls=True) is None


def test_coordinates(spark):
    nan = float("nan")
    assert apply(spark, [-180.0, 180.0, 180.5, nan, None], valid_longitude, "double") == [
        -180.0, 180.0, None, None, None,
    ]
    assert apply(spark, [-90.0, 90.0, 90.5], valid_latitude, "double") == [-90.0, 90.0, None]


def test_quoted_coordinates_are_numbers(spark):
    values = ["-122.67", "180.5", "north", "", "NaN"]
    assert apply(spark, values, valid_longitude) == [-122.67, None, None, None, None]


def test_date_of(spark):
    values = ["2024-01-01T23:59:59Z", "2024-01-02", "2024-01-03 10:00:00", "soon", None]
    assert [str(d) for d in apply(spark, values, date_of)] == [
        "2024-01-01", "2024-01-02", "2024-01-03", "None", "None",
    ]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Test City", "Test_City"),
        ("New York", "New_York"),
        ("São Paulo", "Sao_Paulo"),
        ("München", "Munchen"),
        ("Kärnten", "Karnten"),
        ("Straße", "Strasse"),
        ("½ a", "12_a"),
        ("ﬁn", "fin"),
        ("Łódź", "odz"),
        ("Øl", "l"),
        ("a/é\\b", "a_e_b"),
        ("__a__b__", "a_b"),
        ("it's, no. 5-6; $^", "it's,_no._5-6;_$^"),
        ("tab\tstays", "tab\tstays"),
        ("a\U000F0001b", "ab"),
        ("東京", "no_value"),
        ("  ", "no_value"),
        ("", "no_value"),
        (None, "no_value"),
    ],
)
def test_sanitize(spark, value, expected):
    assert apply(spark, [value], sanitize) == [expected]


def test_sanitize_takes_other_types(spark):
    assert apply(spark, [12, None], sanitize, "int") == ["12", "no_value"]


def by_hand(text):
    """The rule restated one character at a time."""
    out = ""
    for char in unicodedata.normalize("NFKD", text):
        if char == "ß":
            out += "ss"
        elif char in " /\\:*?\"<>|&%#@!~`+=[]{}()":
            out += "_"
        elif ord(char) < 128:
            out += char
    return re.sub("_+", "_", out).strip("_") or "no_value"


def test_sanitize_every_code_point(spark, folder):
    """Each character between two letters, and random mixes, against the rule."""
    import pandas as pd

    values = [f"a{chr(c)}b" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rnd = random.Random(7)
    blocks = [(32, 0x250), (0x2000, 0x2100), (0x2150, 0x2190), (0x2460, 0x2500), (0xFB00, 0xFB07),
              (0xF0000, 0xF0010), (0xFDFA, 0xFDFC), (0x1F100, 0x1F130)]
    pool = [chr(c) for low, high in blocks for c in range(low, high)]
    values += ["".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(50_000)]
    pd.DataFrame({"v": values}).to_parquet(f"{folder}/v.parquet")
    df = spark.read.parquet(f"{folder}/v.parquet")
    out = df.select("v", sanitize("v").alias("s"), sanitize(sanitize("v")).alias("twice")).toPandas()
    assert len(out) == len(values)
    wrong = [(v, s) for v, s in zip(out.v, out.s) if s != by_hand(v)]
    assert wrong == []
    assert (out.s == out.twice).all()


def test_cleaning_stays_in_the_jvm(spark, folder):
    spark.range(3).selectExpr("cast(id as string) v").write.parquet(f"{folder}/v")
    df = spark.read.parquet(f"{folder}/v").select(sanitize("v"), clean_phone("v"), clean_url("v"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
