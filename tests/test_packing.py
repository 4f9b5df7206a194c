"""Texts that travel together come back as they were."""

from pyspark.sql import functions as F

from claimloom.functions import packing


def test_any_texts_come_back(spark):
    odd = [None, "", "a", " ", "\x01", "\x02", "\x02a", "\x02b\x01", "\x01\x02\x02a", "null", "|", "é\n"]
    data = [(a, b, c) for a in odd for b in odd for c in (None, "", "\x02b")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    text = df.select("a", "b", "c", packing.packed(["a", "b", "c"]).alias("p"))
    again = text.withColumn("x", packing.parts(F.col("p"))).select(
        "a", "b", "c", F.struct(*packing.unpacked(F.col("x"), ["a", "b", "c"])).alias("again")
    )
    found = again.collect()
    assert len(found) == len(data)
    assert all((r.a, r.b, r.c) == tuple(r.again) for r in found)


def test_one_null_column(spark):
    df = spark.createDataFrame([(None,), ("",)], "a string").select("a", packing.packed(["a"]).alias("p"))
    found = df.select("a", packing.unpacked(packing.parts(F.col("p")), ["a"])[0].alias("again")).collect()
    assert sorted((r.a, r.again) for r in found if r.a is not None) == [("", "")]
    assert [(r.a, r.again) for r in found if r.a is None] == [(None, None)]
