"""Band edges, null handling and text rules on small hand-written frames."""

from pyspark.sql import functions as F

from cardspark.functions import numeric, rules


def _one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_credit_band_edges(spark):
    scores = [579, 580, 669, 670, 739, 740, 799, 800, None]
    got = _one(spark, rules.credit_band("s"), [(s,) for s in scores], "s int")
    assert got == ["Poor", "Fair", "Fair", "Good", "Good", "Very Good", "Very Good",
                   "Excellent", "Excellent"]


def test_draft_bands_drop_upper_edges(spark):
    got = _one(spark, rules.credit_band_draft("s"), [(669,), (739,), (799,), (668,)], "s int")
    assert got == ["Excellent", "Excellent", "Excellent", "Fair"]


def test_age_income_limit_bands(spark):
    assert _one(spark, rules.age_group("a"), [(24,), (25,), (34,), (65,), (None,)], "a int") == \
        ["<25", "25-34", "25-34", "65+", "65+"]
    assert _one(spark, rules.income_band("i"), [(29999.99,), (60000.0,), (100000.0,), (100000.01,)],
                "i double") == ["<30k", "30-60k", "60-100k", "100k+"]
    assert _one(spark, rules.credit_limit_band("l"), [(0.0,), (4999.0,), (15000.0,), (30000.0,),
                                                      (30000.5,)], "l double") == \
        ["0", "<5k", "5-15k", "15-30k", "30k+"]


def test_entry_mode_without_space_and_null(spark):
    got = _one(spark, rules.entry_mode("u"), [("Chip Transaction",), ("Swipe",), (None,)], "u string")
    assert got == ["Chip", "Swipe", "Unknown"]
    codes = _one(spark, rules.trans_type_code("u", "e"), [("Swipe", None), (None, "Bad PIN")],
                 "u string, e string")
    assert codes == ["Swipe|1|None", "Unknown|0|Bad PIN"]


def test_geo_code_null_and_empty_state_collide(spark):
    codes = _one(spark, rules.geo_code("c", "s", "z"), [("A", None, "1"), ("A", "", "1")],
                 "c string, s string, z string")
    assert codes == ["A||1", "A||1"]


def test_debt_to_income_zero_guard(spark):
    df = spark.createDataFrame([(100.0, 0.0), (123.45, 1000.0)], "d double, i double")
    got = [r[0] for r in df.select(rules.debt_to_income(
        F.col("d").cast("decimal(12,2)"), F.col("i").cast("decimal(12,2)"))).collect()]
    assert got[0] is None and str(got[1]) == "0.1235"


def test_pct_label_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5)], "n long, t long")
    got = [r[0] for r in df.select(numeric.pct_label("n", "t", 2)).collect()]
    assert got == ["12.50 %", "33.33 %", "66.67 %", "0.00 %"]


def test_valid_spend(spark):
    df = spark.createDataFrame([(None, 5.0), ("x", 5.0), (None, 0.0), (None, -1.0)],
                               "e string, a double")
    assert [r[0] for r in df.select(rules.valid_spend("e", "a")).collect()] == \
        [True, False, False, False]
