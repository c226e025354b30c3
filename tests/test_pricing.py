"""Golden rows (FIXTURES.md §5) for the cleaning functions."""

from decimal import Decimal

from conftest import raw_df

from pricelens.operators import clean as C

BASE = {"date": "2023-11-20", "category": "c", "sub_category": "s", "prd_name": "n", "prd_brand": "b"}


def _link(i):
    return f"https://h/a/p/{i}_EA"


def clean_map(spark, rows):
    df = raw_df(spark, [{**BASE, "prd_link": _link(i), **r} for i, r in enumerate(rows)])
    out = C.clean_store_a(df).orderBy("pos").collect()
    return [r.asDict() for r in out]


def test_unit_price_table(spark):
    rows = [
        {"prd_price": "$5.99", "prd_per_price": "500 g, $1.20/100g"},
        {"prd_price": "$4.39", "prd_per_price": "$4.39/1kg $1.99/1lb"},
        {"prd_price": "$1.20", "prd_per_price": "1 ea, $1,200/1ea"},
        {"prd_price": "$2.00", "prd_per_price": "250 ml"},
        {"prd_price": "$3.99", "prd_per_price": "$0.40/100g"},
        {"prd_price": "$3.99", "prd_per_price": None},
    ]
    got = clean_map(spark, rows)
    expect = [
        (Decimal("5.99"), "500 g", "$1.20/100g", None),
        (Decimal("4.39"), "1.0 kg", "$4.39/1kg", "$1.99/1lb"),
        (Decimal("1.20"), "1 ea", "$1.200/1ea", None),
        (Decimal("2.00"), "250 ml", "$ 2.0 / 250 ml", None),
        (Decimal("3.99"), "997.5 g", "$0.40/100g", None),
        (Decimal("3.99"), None, None, None),
    ]
    for g, e in zip(got, expect):
        assert (g["prd_price"], g["average_unit"], g["price_per_unit_1"], g["price_per_unit_2"]) == e
        assert g["reject_reason"] is None


def test_reject_rows(spark):
    rows = [
        {"prd_price": "$1,299.00", "prd_per_price": "500 g, $1.20/100g"},
        {"prd_price": "$1.20", "prd_per_price": "$1,200/1ea"},
        {"prd_price": "$8.00", "prd_per_price": "1,000 g, $0.80/100g"},
        {"prd_price": "$1.00", "prd_per_price": "$1.2/1"},
    ]
    rows += [
        {"prd_price": "$1.00", "prd_per_price": "$1/1kg $2/1lb $3/1oz"},
        {"prd_price": "$1.00", "date": "12/11/2023"},
        {"prd_price": "$1.00", "prd_link": "https://h/a/p/nan"},
    ]
    out = clean_map(spark, rows)
    assert [r["reject_reason"] for r in out] == ["price", "unit", "parts", "unit", "unit_prices", "date", "product_id"]
    assert [r["raw"]["prd_price"] for r in out] == [r["prd_price"] for r in rows]
    assert out[0]["raw"]["prd_per_price"] == "500 g, $1.20/100g" and out[5]["raw"]["date"] == "12/11/2023"


def test_unicode_blanks(spark):
    rows = [{"prd_price": "$1.00", "prd_per_price": "\u00a0$4.39/1kg\u00a0$1.99/1lb\u2003", "prd_name": "w (\u00a0ID required at pick-up\u2003)"}]
    out = clean_map(spark, rows)[0]
    assert (out["price_per_unit_1"], out["price_per_unit_2"], out["prd_name"]) == ("$4.39/1kg", "$1.99/1lb", "w ")


def test_promotion_table(spark):
    labels = [
        ("SAVE $1.00\nlimit 4", "SAVE $1.00", "SAVING"),
        ("$3.00 MIN 2", "$3.00 MIN 2", "MULTI"),
        ("Member price", "Member price", "MEMBER"),
        ("1000 Points", "1000 Points", "POINT"),
        ("SAVE with MIN 2", "SAVE with MIN 2", "SAVING"),
        ("limit 4\nSAVE $1", "limit 4", None),
        ("save $1", "save $1", None),
        (None, None, None),
    ]
    rows = [{"prd_price": "$1.00", "prd_per_price": "250 ml", "prd_discount": d} for d, _, _ in labels]
    got = clean_map(spark, rows)
    assert [(g["prd_discount"], g["on_sale_cat"]) for g in got] == [(l, c) for _, l, c in labels]


def test_product_id_and_name(spark):
    from pyspark.sql import functions as F

    from pricelens.functions import pricing as P

    df = spark.createDataFrame(
        [("https://h/a/p/20_EA",), ("https://h/p/20_EA?s=x",), ("https://h/p/20-EA",), ("https://h/p/épi_1",)], "l string"
    )
    assert [r[0] for r in df.select(P.product_id("l")).collect()] == ["20_EA", None, None, "épi_1"]
    n = spark.createDataFrame([("Red Wine ( ID required at pick-up )",), ("Gin (ID required at pick-up)x",)], "n string")
    assert [r[0] for r in n.select(P.clean_name("n")).collect()] == ["Red Wine ", "Gin x"]
    assert spark.range(1).select(P.parse_price(F.lit("sale $12.50 ea"))).first()[0] is None
    assert str(spark.range(1).select(P.parse_price(F.lit("was $12.50"))).first()[0]) == "12.50"


def test_na_words_become_null(spark):
    got = clean_map(spark, [{"prd_price": "$1.00", "prd_per_price": "250 ml", "prd_brand": w} for w in ["N/A", "nan", "NULL", "", "Acme"]])
    assert [g["prd_brand"] for g in got] == [None, None, None, None, "Acme"]


def test_half_up_rounding(spark):
    # 2.675 kg style amounts round half up in decimal (binary floats give 2.67)
    got = clean_map(spark, [{"prd_price": "$10.70", "prd_per_price": "$4.00/1kg"}])
    assert got[0]["average_unit"] == "2.68 kg"


def test_number_text_like_python_floats(spark):
    from pyspark.sql import functions as F

    from pricelens.functions.pricing import number_text

    vals = ["997.50", "1.00", "10570052.11", "0.00", "5.99", "20.10"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").select(F.col("s").cast("decimal(38,2)").alias("d"))
    assert [r[0] for r in df.select(number_text("d")).collect()] == [repr(float(v)) for v in vals]
