"""Normalization, components and verdicts on table-driven cases of our own."""

import math

import pytest
from pyspark.sql import functions as F

from weftline.functions.names import canonical_number, normalized, normalized_arabic, with_components
from weftline.functions.pricing import formatted_price, parsed_price, price_bonus, price_context
from weftline.functions.rounding import rounded
from weftline.operators.compat import verdict

NAMES = [
    ("+***imp panadol-extra_500mg 20tab", "PANADOL EXTRA 500 MG 20 TAB"),
    ("+***IMPORTED X", "ORTED X"),
    ("Brand (new) 1O0mg", "BRAND NEW 100 MG"),
    ("drops .5% eye", "DROPS 0.5% EYE"),
    ("vit D 3 1.000 I.U caps", "VIT D3 1000 I U CAPS"),
    ("syrp 5ML*60ML", "SYRUP 5 ML / 60 ML"),
    ("forET 25 M tab", "FORTE 25 MG TAB"),
    ("x\\y S R 2.50 mg.", "X / Y SR 2.50 MG"),
    ("  vag. cream ", "VAGINAL CREAM"),
    ("", ""), (None, ""),
]


def test_normalized(spark):
    df = spark.createDataFrame(NAMES, "name string, want string")
    assert df.where(normalized(F.col("name")) != F.col("want")).select("name", normalized(F.col("name"))).collect() == []


def test_arabic(spark):
    df = spark.createDataFrame([(" أُقراص  إلى ", "اقراص الي"), ("مؤسسة-ئ", "موسسه ي"), (None, "")], "name string, want string")
    assert df.where(normalized_arabic(F.col("name")) != F.col("want")).count() == 0


PARSED = [
    ("Alphadol 500mg 20 tab", {"brand": "ALPHADOL", "dosage_nums": ["500"], "qty": "20", "form": "TAB", "product_class": "medicine"}),
    ("Betasyr 250mg/5ml syrup 100ml", {"brand": "BETASYR", "dosage_nums": ["250"], "dosage_units": ["MG/ML"], "volume": "100", "form": "SYRUP"}),
    ("Gamma 10/20 mg 30 caps", {"dosage_nums": ["10/20"], "form": "CAP"}),
    ("Delta 5 mg/10 mg/5 ml susp", {"form": "SUSP"}),
    ("Derma cream 30 gm", {"brand": "DERMA", "weight": "30", "form": "CREAM", "product_class": "cosmetic"}),
    ("extra forte omega 3 60 caps", {"brand": "OMEGA", "product_class": "supplement"}),
    ("AIG serum plus", {"brand": "AIG"}),
    ("nan milk 1 400 gm", {"product_class": "baby_food"}),
    ("pre filled syringe x 40mg", {"product_class": "medicine"}),
    ("insulin syringe 1ml", {"product_class": "device"}),
    ("Kidol inf drops 15ml", {"brand": "KIDOL", "form": "EYE"}),
    ("Cold top night tea orange", {"brand": "COLD", "flavor": "ORANGE", "brand_variants": ["COLD", "COLDTOP"]}),
    ("Femi vag. 100 supp", {"qty": "", "form": "SUPP"}),
    ("Numol 75 20 tab", {"dosage_nums": ["75"], "dosage_units": ["MG"], "qty": "20"}),
    ("Imported thing", {"imported": True}),
    (None, {"brand": "", "dosage_nums": [], "form": "", "imported": False, "brand_keys": []}),
]


def test_components(spark):
    df = with_components(spark.createDataFrame([(k, n) for k, (n, _) in enumerate(PARSED)], "k int, name string"), "name")
    got = {r["k"]: r for r in df.collect()}
    for k, (name, want) in enumerate(PARSED):
        assert {c: got[k][c] for c in want} == want, name


PAIRS = [
    ("Alphadol 500mg 20 tab", "ALPHADOL 500 MG 20 TABLETS", "ok"),
    ("+imp Alphadol 500mg", "Alphadol 500 mg", "different_import_status"),
    ("Alphadol plus 500mg tab", "Alphadol 500mg tab", "different_modifier"),
    ("Insulinagypt R vial", "Insulinagypt N vial", "different_modifier"),
    ("Fizz orange sachet", "Fizz lemon sachet", "different_flavor"),
    ("Kidol infant drops", "Kidol drops", "different_age_group"),
    ("Alphadol 500mg", "Zetamycin 500mg", "different_brand"),
    ("Alphadol 500mg tab", "Alphadol 250mg tab", "different_dosage"),
    ("Alphadol 0.50 mg tab", "Alphadol 0.5 mg tab", "different_dosage"),
    ("Combo 10/20 mg tab", "Combo 30 mg tab", "ok"),
    ("Sol 100 mg/5 ml syrup", "Sol 100 mg syrup", "ok"),
    ("Alphadol 500mg tab", "Alphadol 500mg cream", "different_form"),
    ("Alphadol 1 mg IM vial", "Alphadol 1 mg IV vial", "different_route"),
    ("Alphadol 5mg 10 tab", "Alphadol 5mg 20 tab", "different_quantity"),
    ("Alphadrop eye drops 10ml", "Alphadrop eye drops 15ml", "different_volume"),
    ("Betasyr syrup 10 mg 100 ml", "Betasyr syrup 10 mg 120 ml", "ok"),
    ("Derma cream 30 gm", "Derma cream 50 gm", "different_weight"),
    ("Zero 10/0 mg syrup 5 ml", "Zero 10 mg syrup", "ok"),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(PAIRS)], "k int, a string, b string")
    got = {r["k"]: r["reason"] for r in verdict(with_components(with_components(df, "a", "d_"), "b", "m_")).collect()}
    for k, (a, b, want) in enumerate(PAIRS):
        assert (got[k] == "ok") == (want == "ok") and (want == "ok" or got[k] == want), (a, b, got[k])
    swapped = {r["k"]: r["reason"] for r in verdict(with_components(with_components(df, "b", "d_"), "a", "m_")).collect()}
    assert swapped == got


def test_canonical_numbers(spark):
    df = spark.createDataFrame([("2.50", "2.5"), ("3.0", "3"), ("007", "007"), ("0.50", "0.5"), ("10", "10")], "n string, want string")
    assert df.where(canonical_number(F.col("n")) != F.col("want")).count() == 0


@pytest.mark.parametrize(("text", "price"), [("EGP 12.50", 12.5), ("-5", 5.0), ("٣٫٥", 35.0), ("1.2.3", None), ("0", None), ("nan", None), (None, None)])
def test_prices(spark, text, price):
    assert spark.createDataFrame([(text,)], "p string").select(parsed_price(F.col("p"))).first()[0] == price


def test_price_texts_and_bonus(spark):
    df = spark.createDataFrame([("10", "10.50"), ("10", None)], "a string, b string")
    rows = df.select(formatted_price(F.col("b")), price_context(F.col("a"), F.col("b")), price_bonus(parsed_price(F.col("a")), parsed_price(F.col("b")))).collect()
    assert [tuple(r) for r in rows] == [("10.5", "inventory=10, candidate=10.5, delta=4.8%", 4.0), ("-", "inventory=10, candidate=-, delta=-", 0.0)]


def test_rounding_is_pythons(spark):
    values = [97.35, 0.25, 0.35, 5.65, 99.95, 2.25, 66.66666, 100.0, 0.05, 12.45, *(k / 7 for k in range(50)), *(k + 0.05 for k in range(50))]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded(F.col("v"))).collect()]
    assert all(math.isclose(a, round(v, 1), abs_tol=1e-12) for a, v in zip(got, values, strict=True))


def test_sql_functions_and_views(spark):
    from weftline.functions import sql
    from weftline.functions.names import normalized
    from weftline.functions.pricing import parsed_price

    sql.register(spark)
    names = ["  alphadol500mg 20tab ", "+***IMP x_y\\z", "VAG. SUPP 1.000 IU", "a-b (c) .5% s r", None, ""]
    rows = spark.createDataFrame([(n, f"EGP {k}.5" if k % 2 else "-٣") for k, n in enumerate(names)], "name string, price string")
    rows.createOrReplaceTempView("sql_names")
    got = spark.sql("SELECT weft_normalize(name) AS n, weft_price(price) AS p FROM sql_names").collect()
    want = rows.select(normalized(F.col("name")).alias("n"), parsed_price(F.col("price")).alias("p")).collect()
    assert got == want
    assert spark.sql("SELECT weft_ratio('abcd', 'abce')").first()[0] == 75.0
    sql.components_view(spark, "sql_names", "name", "sql_left", "d_")
    sql.components_view(spark, "sql_left", "name", "sql_pairs", "m_")
    sql.verdict_view(spark, "sql_pairs", "sql_judged")
    assert {r["reason"] for r in spark.sql("SELECT reason FROM sql_judged").collect()} == {"ok"}
