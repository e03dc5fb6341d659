"""What the secret scan works out for a token."""

from pyspark.sql import functions as F

from runatlas.llm import secret_scan

PLACES = len(secret_scan.SYMBOLS) + 1


def test_a_token_is_read_once_for_each_test(spark):
    token = "Zx8Qp2Lw9Rt4Vb7Nk1Ms"
    frame = spark.createDataFrame([(1, f"key {token} end"), (2, None)], "k long, text string")
    found = frame.select("k", secret_scan.candidates(secret_scan._plain(F.col("text")), [-3.0] * PLACES**2).alias("c"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("instr(") == 3  # values of the alphabet once, a step of written text twice
    rows = {r.k: r.c for r in found.collect()}
    (one,) = rows[1]
    assert (one.start, one.end) == (4, 4 + len(token)) and one["class"].startswith("base62:") and 0 < one.p < 1
    assert rows[2] == []


def test_marks_in_a_text_do_not_move_a_token(spark):
    frame = spark.createDataFrame([("a\u0001b\u0002 \U0001f600 ABCDEF0123456789abcd",)], "text string")
    text = secret_scan._plain(F.col("text"))
    row = frame.select(text.alias("plain"), secret_scan.candidates(text, [-3.0] * PLACES**2).alias("c")).first()
    assert row.plain.startswith("a\u0003b\u0003 ") and len(row.plain) == 27 and [c.start for c in row.c] == [7]
