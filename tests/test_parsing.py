import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.functions import articles as A
from marketmill.functions import labels
from marketmill.functions import parsing as P
from marketmill.operators import quotes as Q


def values(spark, expression, inputs, schema="v string"):
    rows = spark.createDataFrame([(i,) for i in inputs], schema).select(expression.alias("r")).collect()
    return [r.r for r in rows]


@pytest.mark.parametrize(
    "dtype,text,expected",
    [
        ("double", "1,234", 1234.0), ("double", "56.7", 56.7), ("double", "-12.5", -12.5), ("double", "---", None),
        ("double", "", None), ("double", None, None), ("double", " 7 ", 7.0), ("double", "+3.", 3.0),
        ("double", ".5", None), ("double", "1e3", None), ("double", "NaN", None), ("double", "1 2", None),
        # Does not fit the type: null, never a failed job.
        ("bigint", "1234.5", None), ("bigint", "12.", None), ("bigint", "12345678901234567890", None), ("bigint", "-9", -9),
    ],
)
def test_numeric(spark, dtype, text, expected):
    assert values(spark, P.numeric(F.col("v"), dtype), [text]) == [expected]


def test_numeric_fuzz(spark):
    """Against the rule stated in Python, on random texts over the characters that matter."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("0123456789+-., eE") for _ in range(rng.randrange(8))) for _ in range(3000)]

    def rule(text, kind):
        plain = text.replace(",", "").strip(" ")
        whole = r"[+-]?\d+" if kind is int else r"[+-]?\d+\.?\d*"
        return kind(plain) if re.fullmatch(whole, plain) else None

    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    got = rows.select("v", P.numeric(F.col("v"), "double").alias("d"), P.numeric(F.col("v"), "bigint").alias("n")).collect()
    assert [(r.d, r.n) for r in got] == [(rule(r.v, float), rule(r.v, int)) for r in got]


def test_direction_and_sign(spark):
    rows = spark.createDataFrame(
        [("<p style='color:red'>+</p>", 2.5), ("<p style= color:green> - </p>", 1.0), ("<p>X</p>", 3.0), ("", 4.0), (None, 5.0)],
        "tag string, amount double",
    )
    mark = P.direction(F.col("tag"))
    got = rows.select(mark.alias("m"), P.signed_change(mark, F.col("amount")).alias("c")).collect()
    assert [(r.m, r.c) for r in got] == [("+", 2.5), ("-", -1.0), ("X", None), ("", 4.0), (None, 5.0)]


def test_finite_rounded(spark):
    got = values(spark, P.finite_rounded(F.col("v")), [590.126, 595.999, float("nan"), 592.004, None, 0.125], "v double")
    assert got == [590.13, 596.0, None, 592.0, None, 0.13]


def test_epoch_date_follows_the_named_zone(spark):
    millis = [1783612800000.0 - 1, 1783612800000.0]  # 2026-07-09 16:00 UTC is midnight in Taipei
    assert values(spark, P.epoch_ms_date(F.col("v"), "Asia/Taipei"), millis, "v double") == [date(2026, 7, 9), date(2026, 7, 10)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, P.epoch_ms_date(F.col("v"), "UTC"), millis, "v double") == [date(2026, 7, 9)] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates(spark):
    assert values(spark, P.compact_date(F.col("v")), ["20260709", "20260231", "", "2026079", None]) == [date(2026, 7, 9)] + [None] * 4
    assert values(spark, P.era_to_iso(F.col("v")), ["115/07/09", "bad", None]) == ["2026-07-09", None, None]
    assert values(spark, P.iso_to_era(F.col("v").cast("date")), ["2026-07-09", None]) == ["115/07/09", None]


def test_symbols(spark):
    got = values(spark, P.split_symbol(F.col("v")), ["2330.TW", "6488.TWO", "2330", "\u30002330.tw  ", "\t1.two\n", "TW"])
    assert [tuple(r) for r in got] == [
        ("2330", "TWSE"), ("6488", "TPEx"), ("2330", "UNKNOWN"), ("2330", "TWSE"), ("1", "TPEx"), ("TW", "UNKNOWN"),
    ]
    assert values(spark, P.vendor_symbol(F.lit("2330"), F.col("v")), ["TWSE", "TPEx", "UNKNOWN"]) == ["2330.TW", "2330.TWO", None]
    assert values(spark, P.id_format(F.col("v")), ["2330", "12345", "2330A", "1", "123456"]) == [
        "four_digits", "five_digits", "has_letter", "other", "other",
    ]


def test_labels(spark):
    assert values(spark, labels.rsi_band(F.col("v")), [70.0, 70.1, 30.0, 29.9, None], "v double") == [
        "neutral", "overbought", "neutral", "oversold", "n/a",
    ]
    assert values(spark, labels.health_band(F.col("v")), [95.0, 94.9, 80.0, 79.9], "v double") == ["green", "orange", "orange", "red"]


def test_article_fields(spark):
    assert values(spark, A.strip_html(F.col("v")), ["<p>a\n<b>b</b></p> ", " <x\ny> ", None]) == ["a\nb", "", ""]
    ids = spark.createDataFrame([("7", "t"), ("", "t"), (None, "t")], "i string, t string").select(A.article_id(F.col("i"), F.col("t")).alias("r"))
    assert [r.r for r in ids.collect()] == ["7", *["e358efa489f58062f10dd7316b65649e"] * 2]
    assert values(spark, A.published_at(F.col("v"), F.lit("2024-02-01")), [0, 86399, None], "v bigint") == [
        "2024-02-01", "1970-01-01T23:59:59Z", "2024-02-01",
    ]
    rows = spark.createDataFrame(
        [([("5508",), ("",), (None,)], ["TWS:5508:STOCK", "USS: META :STOCK", "TW:ETF:x", "plain", None], ["US-GOOG"]), (None, None, None)],
        "market array<struct<code: string>>, products array<string>, stocks array<string>",
    )
    got = rows.select(A.related_codes(F.col("market"), F.col("products"), F.col("stocks")).alias("r")).collect()
    assert [r.r for r in got] == [["5508", "META", "X"], []]
    assert values(spark, A.distinct_nonempty(F.col("v")), [["a", "", "b", None, "a"], None], "v array<string>") == [["a", "b"], []]


def test_flatten_is_positional_and_tolerates_ragged_rows(spark):
    raw = spark.createDataFrame(
        [("2026-07-09", ["a", "b"], [["v1", "v2"], ["v3"]]), ("2026-07-10", None, None), ("2026-07-11", [], [])],
        "dt string, fields array<string>, data array<array<string>>",
    )
    layout = S.strings("a b")
    got = Q.flatten_payloads(raw, layout)
    assert got.columns == ["dt", "a", "b"]
    assert [tuple(r) for r in got.collect()] == [("2026-07-09", "v1", "v2"), ("2026-07-09", "v3", None)]


def test_layout_widths_match_the_headers():
    assert len(S.RAW_ROW_A) == len(S.RAW_FIELDS_A) == 16
    assert len(S.RAW_ROW_B) == len(S.RAW_FIELDS_B) == 19
    assert len(S.names(S.QUOTES)) == 19


def _raw(layout, **cells):
    return tuple(cells.get(n) for n in layout.names)


def test_merge_markets(spark):
    a = spark.createDataFrame(
        [
            ("2026-07-09", *_raw(S.RAW_ROW_A, stock_id="2330", trade_volume="30,000,000", close_price="1,000.5", change_symbol_raw="<p>+</p>", change_amount="2.5", pe_ratio="20.1")),
            ("2026-07-09", *_raw(S.RAW_ROW_A, stock_id="9999", close_price="---", change_symbol_raw="<p>X</p>", change_amount="0.00")),
        ],
        "dt string, " + ", ".join(f"{n} string" for n in S.RAW_ROW_A.names),
    )
    b = spark.createDataFrame(
        [("2026-07-09", *_raw(S.RAW_ROW_B, stock_id="6488", close_price="690.00", average_price="688.00 ", change_symbol_raw="-5.00 ", issued_shares="478,000,000"))],
        "dt string, " + ", ".join(f"{n} string" for n in S.RAW_ROW_B.names),
    )
    # Repeated list entries must not repeat quotes.
    list_a = spark.createDataFrame([("2330",), ("2330",)], "stock_id string")
    list_b = spark.createDataFrame([("6488",)], "stock_id string")
    merged = Q.merge_markets(Q.clean_a(a), Q.clean_b(b), list_a, list_b)
    assert merged.columns == S.names(S.QUOTES)
    rows = {r.stock_id: r for r in merged.collect()}
    assert set(rows) == {"2330", "6488"}
    one, two = rows["2330"], rows["6488"]
    assert (one.market, one.trade_volume, one.close_price, one.change_amount, one.pe_ratio, one.average_price) == ("TWSE", 30000000, 1000.5, 2.5, 20.1, None)
    assert (two.market, two.close_price, two.average_price, two.change_amount, two.issued_shares, two.pe_ratio) == ("TPEx", 690.0, 688.0, -5.0, 478000000, None)
    with pytest.raises(ValueError):
        Q.merge_sources(merged, merged.drop("dt"))
