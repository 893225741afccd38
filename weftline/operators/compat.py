"""Whether two parsed names can be the same product: one ordered CASE over two sets of component columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import vocab as V
from weftline.functions.names import any_of, canonical_number, clean_brand, given, has, no_words, words_of
from weftline.functions.similarity import ratio_udf

OK = "ok"
#: The brand ratio from which brands agree, the length by which one may contain the other.
BRAND_RATIO, BRAND_SLACK = 86, 2
TOLERANCE = 0.01


class Side:
    """The component columns of one side, by prefix."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __getattr__(self, name: str) -> Column:
        return F.col(self.prefix + name)


def parts(s: Side) -> Column:
    """Single numbers of the dosages: '5/10' is two."""
    return F.flatten(F.transform(s.dosage_nums, lambda n: F.filter(F.split(n, "/"), lambda p: p != "")))


def unmatched_numbers(s: Side) -> Column:
    """Numbers of the name that no component accounts for, in order."""
    numbers = F.regexp_extract_all(s.normalized, F.lit(V.ANY_NUMBER), F.lit(1))
    known = F.concat(parts(s), given(s.qty, s.volume, s.weight))
    start = F.struct(no_words().alias("left"), known.alias("known"))

    def step(acc: Column, n: Column) -> Column:
        short = canonical_number(n)
        at = F.array_position(F.transform(acc["known"], lambda k: (k == n) | (k == short)), True).cast("int")
        rest = F.concat(F.slice(acc["known"], F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(acc["known"], at + 1, F.size(acc["known"])))
        return F.struct(F.when(at > 0, acc["left"]).otherwise(F.concat(acc["left"], F.array(short))).alias("left"), F.when(at > 0, rest).otherwise(acc["known"]).alias("known"))

    return F.aggregate(numbers, start, step, lambda acc: acc["left"])


def forms_compatible(a: Column, b: Column) -> Column:
    family = lambda names: a.isin(*names) & b.isin(*names)
    return (a == b) | family(V.OCULAR) | family(V.LIQUIDS) | family(V.SOLIDS)


def by_value(x: Column) -> Column:
    """Sorted by value, to be compared as text; equal values keep their order."""
    return F.transform(F.array_sort(F.transform(x, lambda n, i: F.struct(n.try_cast("double").alias("v"), i.alias("i"), n.alias("n")))), lambda s: s["n"])


def dosages_compatible(d: Side, m: Side) -> Column:
    """Sides with traits()."""
    a, b = d.j_parts, m.j_parts
    one_many = (F.size(a) == 1) & (F.size(b) > 1)
    many_one = (F.size(a) > 1) & (F.size(b) == 1)
    summed = (one_many | many_one) & (F.abs(d.j_total - m.j_total) <= TOLERANCE)
    liquid = d.form.isin(*V.LIQUID_DOSES) | m.form.isin(*V.LIQUID_DOSES)

    def per_five(single: Column, combo: Column, volume: Column) -> Column:
        amount, per = F.get(combo, F.lit(0)), F.get(combo, F.lit(1))
        agrees = (volume == "") | (canonical_number(volume) == canonical_number(per))
        rate = F.try_divide(amount.try_cast("double"), per.try_cast("double"))
        return (F.size(combo) == 2) & agrees & (F.abs(rate - F.get(single, F.lit(0)).try_cast("double") / 5) <= TOLERANCE)

    per_dose = F.when(F.size(a) == 1, per_five(a, b, m.volume)).when(F.size(b) == 1, per_five(b, a, d.volume))
    first = (one_many | many_one) & (F.get(a, F.lit(0)) == F.get(b, F.lit(0)))
    return (d.j_sorted == m.j_sorted) | F.coalesce(summed, F.lit(False)) | (liquid & (F.coalesce(per_dose, F.lit(False)) | first))


def modifiers_differ(d: Side, m: Side) -> Column:
    """Some critical word stands on one side only and isn't optional there. Sides with traits()."""
    a, b = d.j_marks, m.j_marks
    both = lambda words: any_of(a, words) & any_of(b, words)
    either = lambda word: has(a, word) | has(b, word)
    optional = {
        "ADVANCE": has(a, "MILK") & has(b, "MILK"),
        "EXTRA": either("EMOLLIENT"),
        "NASAL": both(V.SPRAY_WORDS),
        "VAGINAL": both(V.VAGINAL_WORDS),
        "R": either("PROLONGED"),
        "MOUTH": either("MOUTHWASH") & either("WASH"),
    }
    critical = words_of((*V.MODIFIERS, *V.VITAMINS))
    one_side = F.array_intersect(F.array_union(F.array_except(a, b), F.array_except(b, a)), critical)
    excused = F.array_compact(F.array(*(F.when(cond, F.lit(word)) for word, cond in optional.items())))
    return F.when(a == b, False).otherwise(F.size(F.array_except(one_side, excused)) > 0)


#: All words that modifiers_differ() asks for.
MARKS = tuple(dict.fromkeys((*V.MODIFIERS, *V.VITAMINS, "MILK", "EMOLLIENT", *V.SPRAY_WORDS, *V.VAGINAL_WORDS, "PROLONGED", "MOUTHWASH", "WASH")))


def insulin_variant(s: Side) -> Column:
    named = F.replace(s.normalized, F.lit(" "), F.lit("")).contains(V.INSULIN)
    mixed = F.when(s.normalized.rlike(r"(?U)\b70\s*/\s*30\b"), words_of(["70/30"])).otherwise(no_words())
    return F.when(named, F.concat(F.array_intersect(words_of(["N", "R"]), s.words), mixed)).otherwise(no_words())


def is_pediatric(s: Side) -> Column:
    return any_of(s.words, V.PEDIATRIC) | (has(s.words, "INF") & ~any_of(s.words, V.INFUSION))


def routes(s: Side) -> Column:
    split = F.array_compact(F.array(*(F.when(has(s.words, r[0]) & has(s.words, r[1]), F.lit(r)) for r in V.ROUTES)))
    return F.array_union(F.array_intersect(words_of(V.ROUTES), s.words), split)


def traits(s: Side) -> dict[str, Column]:
    """What verdict() compares, of one side alone: worked out once a name instead of once a pair."""
    numbers = parts(s)
    return {
        "j_marks": F.array_intersect(s.words, words_of(MARKS)),
        "j_insulin": F.array_sort(insulin_variant(s)),
        "j_colors": F.array_intersect(s.words, words_of((*V.FLAVORS, *V.COLORS))),
        "j_child": is_pediatric(s),
        "j_adult": any_of(s.words, V.ADULTS),
        "j_brand": clean_brand(s.brand),
        "j_loose": unmatched_numbers(s),
        "j_parts": numbers,
        "j_sorted": by_value(numbers),
        "j_total": F.aggregate(numbers, F.lit(0.0), lambda acc, n: acc + n.try_cast("double")),
        "j_routes": routes(s),
    }


TRAITS = ("j_marks", "j_insulin", "j_colors", "j_child", "j_adult", "j_brand", "j_loose", "j_parts", "j_sorted", "j_total", "j_routes")


def with_traits(df: DataFrame, prefix: str) -> DataFrame:
    """df with the traits of a side that doesn't have them yet."""
    return df if prefix + TRAITS[0] in df.columns else df.withColumns({prefix + k: v for k, v in traits(Side(prefix)).items()})


def _disjoint(a: Column, b: Column) -> Column:
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def _differ(a: Column, b: Column) -> Column:
    """Both given, and not the same."""
    return (a != "") & (b != "") & (a != b)


def verdict(pairs: DataFrame, left: str = "d_", right: str = "m_", out: str = "reason") -> DataFrame:
    """pairs with `out`: 'ok' or the first reason that speaks against the pair.

    The brand ratio is the only Arrow function; it is null, and costs nothing, where brands agree or an earlier
    check has decided.
    """
    given_columns = pairs.columns
    pairs = with_traits(with_traits(pairs, left), right)
    d, m = Side(left), Side(right)
    a, b = d.j_brand, m.j_brand
    early = (
        F.when(d.imported != m.imported, "different_import_status")
        .when(modifiers_differ(d, m) | (d.j_insulin != m.j_insulin), "different_modifier")
        .when(_disjoint(d.j_colors, m.j_colors), "different_flavor")
        .when((d.j_child != m.j_child) | (d.j_adult & m.j_child) | (m.j_adult & d.j_child), "different_age_group")
    )
    contained = a.contains(b) | b.contains(a)
    doubt = (a != "") & (b != "") & (a != b) & (~contained | (F.abs(F.length(a) - F.length(b)) > BRAND_SLACK))
    pairs = pairs.withColumn("_early", early)
    ask = F.col("_early").isNull() & doubt
    pairs = pairs.withColumn("_ratio", ratio_udf(F.when(ask, a), F.when(ask, b))).withColumn("_doubt", ask)
    dosed = (F.size(d.dosage_nums) > 0, F.size(m.dosage_nums) > 0)
    loose = (d.j_loose, m.j_loose)
    numbers = F.when(dosed[0] & dosed[1], ~dosages_compatible(d, m)).otherwise(
        ((F.size(loose[0]) > 0) & dosed[1]) | ((F.size(loose[1]) > 0) & dosed[0]) | ((F.size(loose[0]) > 0) & (F.size(loose[1]) > 0) & (loose[0] != loose[1]))
    )
    both_form = lambda f: (d.form == f) & (m.form == f)
    late = (
        F.when(F.col("_doubt") & (F.col("_ratio") < BRAND_RATIO), "different_brand")
        .when((d.product_class != m.product_class) & (d.product_class != "medicine") & (m.product_class != "medicine"), "different_product_class")
        .when(numbers, "different_dosage")
        .when((d.form != "") & (m.form != "") & ~forms_compatible(d.form, m.form), "different_form")
        .when(_disjoint(d.j_routes, m.j_routes), "different_route")
        .when(_differ(d.qty, m.qty), F.when(both_form("POWDER"), OK).otherwise("different_quantity"))
        .when(_differ(d.volume, m.volume), F.when(both_form("SYRUP"), OK).otherwise("different_volume"))
        .when(_differ(d.weight, m.weight), "different_weight")
        .when(_differ(d.flavor, m.flavor), "different_flavor")
        .otherwise(OK)
    )
    return pairs.withColumn(out, F.coalesce("_early", late)).select(*(f"`{c}`" for c in given_columns if c != out), out)
