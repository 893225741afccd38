"""Product names: normalization and component extraction as Column expressions (no Python on the executors)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import vocab as V

STRINGS = "array<string>"


def words_of(values: Iterable[str]) -> Column:
    return F.array(*map(F.lit, values))


def no_words() -> Column:
    return F.array().cast(STRINGS)


def normalized(name: Column) -> Column:
    """Canonical upper-case name; null and empty become ''. Python's strip() is emulated for all blanks."""
    start = F.upper(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)^\s+|\s+$", ""))
    return reduce(lambda col, rule: F.regexp_replace(col, *map(F.lit, rule)), V.NORMAL_RULES, start)


def normalized_arabic(name: Column) -> Column:
    bare = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), V.ARABIC_MARKS, "")
    plain = F.translate(bare, V.ARABIC_FROM, V.ARABIC_TO)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "(?U)[^\\w\\s؀-ۿ]", " "), r"(?U)\s+", " "))


def clean_brand(brand: Column) -> Column:
    return F.regexp_replace(brand, "[^A-Z0-9]", "")


def canonical_number(n: Column) -> Column:
    """'2.50' -> '2.5', '3.0' -> '3', '007' -> '007', '07.5' -> '7.5': only numbers with a dot change."""
    short = F.regexp_replace(F.regexp_replace(n, r"0+$", ""), r"\.$", "")
    return F.when(n.contains("."), F.regexp_replace(short, r"^0+(?=\d)", "")).otherwise(n)


def any_of(words: Column, values: Iterable[str]) -> Column:
    return F.arrays_overlap(words, words_of(values))


def has(words: Column, value: str) -> Column:
    return F.array_contains(words, value)


def _last(found: Column) -> Column:
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def without_once(values: Column, used: Column) -> Column:
    """values less one occurrence for each of used, in order (a multiset difference)."""
    start = F.struct(no_words().alias("left"), used.alias("used"))

    def step(acc: Column, x: Column) -> Column:
        at = F.array_position(acc["used"], x).cast("int")
        hit = at > 0
        rest = F.concat(F.slice(acc["used"], F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(acc["used"], at + 1, F.size(acc["used"])))
        return F.struct(F.when(hit, acc["left"]).otherwise(F.concat(acc["left"], F.array(x))).alias("left"), F.when(hit, rest).otherwise(acc["used"]).alias("used"))

    return F.aggregate(values, start, step, lambda acc: acc["left"])


def given(*values: Column) -> Column:
    """Those of the values that aren't empty."""
    return F.filter(F.array(*values), lambda x: x != "")


def product_class(words: Column) -> Column:
    prefilled = has(words, "PRE") & has(words, "FILLED") & has(words, "SYRINGE")
    return (
        F.when(prefilled, "medicine")
        .when(any_of(words, V.DEVICES), "device")
        .when(any_of(words, V.BABY_FOOD) & ~any_of(words, V.BABY_FOOD_NOT), "baby_food")
        .when(any_of(words, V.COSMETIC), "cosmetic")
        .when(any_of(words, V.SUPPLEMENTS), "supplement")
        .otherwise("medicine")
    )


def _kinds(words: Column) -> Column:
    """Each token with what it is: its place, whether it holds a digit, ends a brand, and ends a variant."""
    infusion = any_of(words, V.INFUSION)

    def kind(w: Column, i: Column) -> Column:
        later = i > 0
        form = w.isin(*V.FORM_PREFIXES, *V.FORM_WORDS, *V.NOISE)
        child = (w == "INF") & later & ~infusion
        hard = form | w.isin(*V.QUALIFIERS, *V.DESCRIPTIVE) | child
        return F.struct(
            w.alias("w"), i.alias("i"), w.rlike(r"(?U)\d").alias("digit"),
            (hard | (later & w.isin(*V.SOFT_DESCRIPTORS, *V.CONNECTORS))).alias("bound"),
            (form | child | (later & w.isin(*V.QUALIFIERS) & ~w.isin(*V.CONNECTORS))).alias("stop"),
            (later & w.isin(*V.CONNECTORS)).alias("skip"),
            (later & w.isin(*V.SOFT_DESCRIPTORS)).alias("soft"),
        )

    return F.transform(words, kind)


def _before(kinds: Column, ends) -> Column:
    """Tokens before the first one for which ends() holds."""
    at = F.array_position(F.transform(kinds, ends), True).cast("int")
    return F.when(at > 0, F.slice(kinds, F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(kinds)


def with_components(df: DataFrame, name: str, prefix: str = "") -> DataFrame:
    """df with the components of column `name`, each as a column named by the prefix.

    A missing component is '' or an empty array, never null, so that predicates stay two-valued. Steps are
    columns of their own, so no expression is built twice; a caller that joins on the result writes it first.
    """
    p = prefix
    c = lambda x: F.col(p + x)
    raw = F.coalesce(F.col(name), F.lit(""))
    df = df.withColumns({p + "normalized": normalized(F.col(name)), p + "imported": raw.rlike(V.IMPORTED)})
    norm = c("normalized")
    df = df.withColumns({
        p + "words": F.filter(F.split(norm, " "), lambda w: w != ""),
        p + "_combo": F.array(F.regexp_extract(norm, V.COMBO_PER_ML, 1), F.regexp_extract(norm, V.COMBO_PER_ML, 2)),
        p + "_per_ml": F.regexp_extract(norm, V.PER_ML, 1),
        p + "_doses": F.transform(F.regexp_extract_all(norm, F.lit(V.DOSAGE), F.lit(1)), lambda x: F.regexp_replace(x, r"(?U)\s+", "")),
        p + "_units": F.regexp_extract_all(norm, F.lit(V.DOSAGE), F.lit(2)),
        p + "weight": _last(F.regexp_extract_all(norm, F.lit(V.WEIGHT), F.lit(1))),
        p + "volume": _last(F.regexp_extract_all(norm, F.lit(V.VOLUME), F.lit(1))),
        p + "qty": F.regexp_extract(norm, V.QUANTITY, 1),
        p + "_pair": F.regexp_replace(F.regexp_extract(norm, V.PAIR, 1), r"(?U)\s+", ""),
        p + "_numbers": F.regexp_extract_all(norm, F.lit(V.ANY_NUMBER), F.lit(1)),
    })
    words = c("words")
    per_ml = F.when(c("_combo")[0] != "", F.concat_ws("/", c("_combo"))).otherwise(c("_per_ml"))
    names = F.create_map(*(F.lit(x) for pair in V.FORM_NAMES.items() for x in pair))
    first_form = F.try_element_at(F.array_intersect(words_of(V.FORM_ORDER), words), F.lit(1))
    df = df.withColumns({
        p + "_kinds": _kinds(words),
        p + "_form": F.coalesce(F.try_element_at(names, first_form), first_form, F.lit("")),
        p + "dosage_nums": F.when(per_ml != "", F.array(per_ml)).otherwise(c("_doses")),
        p + "dosage_units": F.when(per_ml != "", words_of(["MG/ML"])).otherwise(c("_units")),
        p + "flavor": F.coalesce(F.try_element_at(F.array_intersect(words_of(V.FLAVORS), words), F.lit(1)), F.lit("")),
        p + "product_class": product_class(words),
    })
    kinds = c("_kinds")
    head = F.try_element_at(words, F.lit(1))
    leading = F.array_join(_before(kinds, lambda k: k["digit"] | k["bound"])["w"], "")
    others = F.array_join(F.filter(kinds, lambda k: (k["i"] > 0) & ~k["digit"] & ~k["bound"])["w"], "")
    df = df.withColumn(p + "brand", F.coalesce(F.when(head.isin(*V.ACRONYMS), head).when(leading != "", leading).when(head.isin(*V.QUALIFIERS), others), F.lit("")))
    brand, numbers = c("brand"), c("dosage_nums")
    x_brand, x_dose, x_volume, x_number, x_unit = V.STRENGTH_EXCEPTION
    wrong = (brand == x_brand) & (numbers == F.array(F.lit(x_dose))) & (c("volume") == x_volume)
    form = F.when((c("_form") == "SUSP") & (has(words, "EYE") | has(words, "DROPS")), "EYE").otherwise(c("_form"))
    df = df.withColumns({p + "form": form, p + "dosage_nums": F.when(wrong, F.array(F.lit(x_number))).otherwise(numbers), p + "dosage_units": F.when(wrong, F.array(F.lit(x_unit))).otherwise(c("dosage_units"))})
    none = F.size(c("dosage_nums")) == 0
    weak = none & (c("qty").try_cast("bigint") >= 100) & has(words, "VAGINAL") & c("form").isin("CAP", "SUPP")
    df = df.withColumn(p + "qty", F.when(weak, "").otherwise(c("qty")))
    left = without_once(F.transform(c("_numbers"), canonical_number), F.transform(given(c("qty"), c("volume"), c("weight")), canonical_number))
    df = df.withColumn(p + "_left", left)
    counted = (c("qty") != "") | c("form").isin("TAB", "CAP", "SUPP", "AMP", "VIAL", "SPRAY") | ((c("volume") != "") & c("form").isin("SYRUP", "SUSP"))
    inferred = F.when(c("_pair") != "", F.array(c("_pair"))).when((F.size(c("_left")) == 1) & counted, c("_left")).otherwise(no_words())
    df = df.withColumns({p + "dosage_nums": F.when(none, inferred).otherwise(c("dosage_nums")), p + "dosage_units": F.when(none, F.when(F.size(inferred) > 0, words_of(["MG"])).otherwise(no_words())).otherwise(c("dosage_units"))})
    df = df.withColumn(p + "brand_variants", _variants(kinds, brand))
    keys = F.array_distinct(F.filter(F.transform(F.concat(F.array(brand), c("brand_variants")), clean_brand), lambda k: F.length(k) >= 3))
    df = df.withColumn(p + "brand_keys", keys)
    return df.drop(*(p + x for x in ("_combo", "_per_ml", "_doses", "_units", "_pair", "_numbers", "_kinds", "_form", "_left")))


def _variants(kinds: Column, brand: Column) -> Column:
    """The brand, then the growing prefixes of the name, cleaned, of three characters at least, each once."""
    run = _before(kinds, lambda k: k["digit"] | k["stop"])
    at = F.array_position(F.transform(run, lambda k: k["soft"]), True).cast("int")
    run = F.when(at > 0, F.slice(run, F.lit(1), F.greatest(at, F.lit(1)))).otherwise(run)
    used = F.filter(run, lambda k: ~k["skip"])["w"]
    grown = F.transform(used, lambda _, i: F.array_join(F.slice(used, F.lit(1), i + 1), ""))
    return F.array_distinct(F.filter(F.transform(F.concat(F.array(brand), grown), clean_brand), lambda v: F.length(v) >= 3))


COMPONENTS = ("normalized", "imported", "words", "brand", "dosage_nums", "dosage_units", "qty", "volume", "weight", "form", "flavor", "product_class", "brand_variants", "brand_keys")
