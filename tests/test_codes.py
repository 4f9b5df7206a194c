from base_helpers import rows
from pyspark.sql import functions as F

from claimloom.functions import codes


def one(spark, values, schema, expression):
    df = spark.createDataFrame(values, schema)
    return [r[0] for r in df.select(expression.alias("x")).collect()]


def test_number_guard(spark):
    texts = ["3", " 2.5 ", "1d", "abc", "", None, "1e1", "-1", "0", ".5", "1,000", "NaN"]
    got = one(spark, [(t,) for t in texts], "t string", codes.positive_or_one(F.col("t")))
    assert got == [3.0, 2.5, 1.0, 1.0, 1.0, 1.0, 10.0, 1.0, 1.0, 0.5, 1.0, 1.0]


def test_zero_pad_and_two_digits(spark):
    values = [("3",), ("0",), ("x",), ("12",), (None,)]
    assert one(spark, values, "t string", codes.zero_pad(F.col("t"))) == ["03", "0", "x", "12", None]
    assert one(spark, values, "t string", codes.two_digits(F.col("t"))) == [
        "03", "00", "0x", "12", None,
    ]


def test_visit_concept_null_arrival_is_zero(spark):
    values = [("02", "11"), ("02", "00"), ("03", "31"), ("03", "00"), ("02", None), ("99", "11")]
    got = one(
        spark, values, "f string, a string", codes.visit_concept(F.col("f"), F.col("a"))
    )
    assert got == [9203, 9201, 9203, 9202, 0, 0]


def test_visit_end(spark):
    values = [("02", None, 3), ("02", "00", 0), ("03", "11", 2), ("03", "00", 5), ("03", None, 5)]
    end = codes.visit_end(F.to_date(F.lit("2010-01-01")), F.col("f"), F.col("a"), F.col("v"))
    got = one(spark, values, "f string, a string, v int", end)
    assert [d.day for d in got] == [3, 1, 2, 1, 1]


def test_drug_type_null_form(spark):
    got = one(spark, [("02",), ("07",), (None,)], "f string", codes.drug_type(F.col("f")))
    assert got == [38000180, 581452, None]


def test_place_of_service_compares_text(spark):
    values = [("10",), ("25",), ("28",), ("90",), ("99",), ("5",), (None,)]
    got = one(spark, values, "t string", codes.place_of_service(F.col("t")))
    # '5' lies between '49' and '50' as text and matches nothing.
    assert got == [4068130, 4318944, 82020103, None, 82020118, None, None]


def test_ids_are_exact(spark):
    df = spark.createDataFrame([(900000000001, 3000000001)], "m bigint, e bigint")
    got = df.select(
        codes.screening_id(F.col("m"), F.lit("07")).alias("s"),
        codes.event_id(F.col("e"), F.lit(3)).alias("i"),
        codes.decode_event_id(codes.event_id(F.col("e"), F.lit(9))).alias("d"),
        codes.decode_event_id(F.lit(9007199254740993123)).alias("big"),
        codes.payer_plan_id(F.lit(12), F.lit(2008)).alias("p"),
    )
    assert rows(got) == [
        (90000000000107, 30000000013, 3000000001, 900719925474099312, 122008)
    ]


def test_ymd_of_bad_text_is_null(spark):
    got = one(spark, [("20080229",), ("20090229",), ("x",), (None,)], "t string", codes.ymd(F.col("t")))
    assert [d and d.isoformat() for d in got] == ["2008-02-29", None, None, None]
