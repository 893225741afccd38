"""DuckDB text for normalized names, their components and the compatibility verdict. RE2 has no look-around."""

from __future__ import annotations

from weftline.functions import vocab as V
from weftline.plans import inputs as I

#: The rewrites of vocab.NORMAL_RULES for RE2: look-arounds as groups, twice where matches may overlap.
RULES = (
    (r"^[+*.]+\s*(IMP|IMPORTED)?\s*", ""), ("_", " "), (r"\\", " / "), ("-+", " "), ("[()]", " "),
    (r"(\d)O(\d)", r"\10\2"), (r"\bFORET\b", "FORTE"), (r"\b(SYRP|SYP)\b", "SYRUP"), (r"\bVAG\b", "VAGINAL"), (r"\*", " / "),
    (r"([A-Z])(\d)", r"\1 \2"), (r"(\d)([A-Z])", r"\1 \2"), (r"\b(\d+)\s*M\b", r"\1 MG"), (r"\b(\d+)\s*M\s*/", r"\1 MG /"),
    (r"\b([BD])\s+(3|6|12)\b", r"\1\2"), (r"\s*[\\/]\s*", " / "), (r"(\d)\.(\d{3})\s*(I\.?U\.?|IU|MCG|MG)", r"\1\2 \3"),
    (r"(^|[^\d])\.(\d+)", r"\10.\2"), (r"\.($|[^\d])", r" \1"), (r"\.($|[^\d])", r" \1"), (r"(^|[^\d])\.", r"\1 "), (r"(^|[^\d])\.", r"\1 "),
    (r"\b([DESCMX])\s+R\b", r"\1R"), (r"\s+", " "),
)


def quoted(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def normalized(name: str) -> str:
    out = f"upper(trim(coalesce({name}, '')))"
    for pattern, to in RULES:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return f"trim({out})"


def canonical(n: str) -> str:
    return f"CASE WHEN contains({n}, '.') THEN regexp_replace(regexp_replace(regexp_replace({n}, '0+$', ''), '\\.$', ''), '^0+(\\d)', '\\1') ELSE {n} END"


def _re2(pattern: str) -> str:
    return pattern.replace("(?iU)", "(?i)").replace("(?U)", "").replace("(?=$|\\s)", "(?:$|\\s)")


def less_once(values: str, used: str, same: str) -> str:
    """values less one occurrence for each of used; `same` compares x with u."""
    return f"""list_reduce({values}, lambda acc, x: CASE WHEN len([u for u in acc.used if {same}]) > 0
      THEN {{'left': acc.left, 'used': [u for u, i in acc.used if i <> list_position([({same}) for u in acc.used], true)]}}
      ELSE {{'left': list_append(acc.left, {{x}}), 'used': acc.used}} END, {{'left': CAST([] AS VARCHAR[]), 'used': {used}}}).left"""


def parsed(cte: str, source: str, name: str) -> str:
    """CTEs from `source` (a CTE or table) up to `cte`: all its columns and the components of column `name`."""
    per_ml = f"CASE WHEN regexp_extract(norm, '{_re2(V.COMBO_PER_ML)}', 1) <> '' THEN regexp_extract(norm, '{_re2(V.COMBO_PER_ML)}', 1) || '/' || regexp_extract(norm, '{_re2(V.COMBO_PER_ML)}', 2) ELSE regexp_extract(norm, '{_re2(V.PER_ML)}', 1) END"
    last = lambda p: f"coalesce(list_extract(regexp_extract_all(norm, '{_re2(p)}', 1), -1), '')"
    form_word = f"coalesce(list_extract([f for f in {quoted(V.FORM_ORDER)} if list_contains(words, f)], 1), '')"
    form = "CASE " + form_word + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in V.FORM_NAMES.items()) + f" ELSE {form_word} END"
    overlap = lambda values: f"list_has_any(words, {quoted(values)})"
    hard = f"(list_contains({quoted((*V.FORM_PREFIXES, *V.FORM_WORDS, *V.NOISE, *V.QUALIFIERS, *V.DESCRIPTIVE))}, w) OR (w = 'INF' AND i > 1 AND NOT infusion))"
    bound = f"({hard} OR (i > 1 AND list_contains({quoted((*V.SOFT_DESCRIPTORS, *V.CONNECTORS))}, w)))"
    digit = "regexp_matches(w, '\\d')"
    stop = f"({digit} OR list_contains({quoted((*V.FORM_PREFIXES, *V.FORM_WORDS, *V.NOISE))}, w) OR (w = 'INF' AND i > 1 AND NOT infusion) OR (i > 1 AND list_contains({quoted(V.QUALIFIERS)}, w)))"
    soft = f"(i > 1 AND list_contains({quoted(V.SOFT_DESCRIPTORS)}, w))"
    until = lambda ends: f"coalesce(list_position([{ends} for w, i in words], true), len(words) + 1)"
    x_brand, x_dose, x_volume, x_number, _ = V.STRENGTH_EXCEPTION
    wrong = f"(brand = '{x_brand}' AND nums1 = ['{x_dose}'] AND volume = '{x_volume}')"
    left = less_once(f"[{canonical('n')} for n in numbers]", f"[{canonical('n')} for n in [qty, volume, weight] if n <> '']", "u = x").replace("{x}", "x")
    counted = "(qty <> '' OR form IN ('TAB', 'CAP', 'SUPP', 'AMP', 'VIAL', 'SPRAY') OR (volume <> '' AND form IN ('SYRUP', 'SUSP')))"
    return f"""
{cte}_1 AS (SELECT *, {normalized(name)} AS norm, regexp_matches(coalesce({name}, ''), '{_re2(V.IMPORTED)}') AS imported FROM {source}),
{cte}_2 AS (SELECT *, [w for w in string_split(norm, ' ') if w <> ''] AS words, {per_ml} AS per_ml,
  [regexp_replace(d, '\\s+', '', 'g') for d in regexp_extract_all(norm, '{_re2(V.DOSAGE)}', 1)] AS doses,
  {last(V.WEIGHT)} AS weight, {last(V.VOLUME)} AS volume, regexp_extract(norm, '{_re2(V.QUANTITY)}', 1) AS qty0,
  regexp_replace(regexp_extract(norm, '{_re2(V.PAIR)}', 1), '\\s+', '', 'g') AS pair, regexp_extract_all(norm, '{_re2(V.ANY_NUMBER)}', 1) AS numbers FROM {cte}_1),
{cte}_3 AS (SELECT *, {overlap(V.INFUSION)} AS infusion, {form} AS form0, CASE WHEN per_ml <> '' THEN [per_ml] ELSE doses END AS nums1,
  coalesce(list_extract([f for f in {quoted(V.FLAVORS)} if list_contains(words, f)], 1), '') AS flavor,
  CASE WHEN list_has_all(words, ['PRE', 'FILLED', 'SYRINGE']) THEN 'medicine' WHEN {overlap(V.DEVICES)} THEN 'device'
    WHEN {overlap(V.BABY_FOOD)} AND NOT {overlap(V.BABY_FOOD_NOT)} THEN 'baby_food' WHEN {overlap(V.COSMETIC)} THEN 'cosmetic'
    WHEN {overlap(V.SUPPLEMENTS)} THEN 'supplement' ELSE 'medicine' END AS product_class FROM {cte}_2),
{cte}_4 AS (SELECT *, array_to_string(words[1:{until(f'({digit} OR {bound})')} - 1], '') AS lead,
  array_to_string([w for w, i in words if i > 1 AND NOT {digit} AND NOT {bound}], '') AS others, words[1:{until(stop)} - 1] AS run,
  CASE WHEN form0 = 'SUSP' AND {overlap(('EYE', 'DROPS'))} THEN 'EYE' ELSE form0 END AS form FROM {cte}_3),
{cte}_5 AS (SELECT *, CASE WHEN list_contains({quoted(V.ACRONYMS)}, words[1]) THEN words[1] WHEN lead <> '' THEN lead
    WHEN list_contains({quoted(V.QUALIFIERS)}, words[1]) THEN others ELSE '' END AS brand,
  run[1:coalesce(list_position([{soft} for w, i in run], true), len(run))] AS run2 FROM {cte}_4),
{cte}_6 AS (SELECT *, CASE WHEN {wrong} THEN ['{x_number}'] ELSE nums1 END AS nums2,
  CASE WHEN len(nums1) = 0 AND TRY_CAST(qty0 AS BIGINT) >= 100 AND list_contains(words, 'VAGINAL') AND form IN ('CAP', 'SUPP') THEN '' ELSE qty0 END AS qty,
  [w for w, i in run2 if NOT (i > 1 AND list_contains({quoted(V.CONNECTORS)}, w))] AS used FROM {cte}_5),
{cte}_7 AS (SELECT *, {left} AS spare, [regexp_replace(v, '[^A-Z0-9]', '', 'g') for v in list_concat([brand], [array_to_string(used[1:i], '') for w, i in used])] AS grown FROM {cte}_6),
{cte} AS (SELECT *, CASE WHEN len(nums2) > 0 THEN nums2 WHEN pair <> '' THEN [pair] WHEN len(spare) = 1 AND {counted} THEN spare ELSE CAST([] AS VARCHAR[]) END AS nums,
  [v for v, i in grown if length(v) >= 3 AND list_position(grown, v) = i] AS keys FROM {cte}_7)"""


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: the textbook table, a row at a time."""
    return f"""list_extract(list_reduce(CASE WHEN {a} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({a}, '') END, lambda prev, ch: list_reduce(range(1, length({b}) + 1),
      lambda acc, j: list_append(acc, CASE WHEN substr({b}, CAST(j AS INT), 1) = ch THEN prev[j] + 1 ELSE greatest(prev[j + 1], acc[-1]) END), [0]), [0 for k in range(0, length({b}) + 1)]), -1)"""


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 100.0 ELSE 200.0 * {lcs(a, b)} / (length({a}) + length({b})) END"


def verdict(cte: str, source: str) -> str:
    """CTEs from pairs with d_ and m_ components to `cte` with `reason`."""
    both = lambda words: f"(list_has_any(d_words, {quoted(words)}) AND list_has_any(m_words, {quoted(words)}))"
    either = lambda w: f"(list_contains(d_words, '{w}') OR list_contains(m_words, '{w}'))"
    optional = f"""((w = 'ADVANCE' AND list_contains(d_words, 'MILK') AND list_contains(m_words, 'MILK')) OR (w = 'EXTRA' AND {either('EMOLLIENT')})
      OR (w = 'NASAL' AND {both(V.SPRAY_WORDS)}) OR (w = 'VAGINAL' AND {both(V.VAGINAL_WORDS)}) OR (w = 'R' AND {either('PROLONGED')})
      OR (w = 'MOUTH' AND {either('MOUTHWASH')} AND {either('WASH')}))"""
    modifiers = f"len([w for w in {quoted((*V.MODIFIERS, *V.VITAMINS))} if list_contains(d_words, w) <> list_contains(m_words, w) AND NOT {optional}]) > 0"
    child = lambda p: f"(list_has_any({p}words, {quoted(V.PEDIATRIC)}) OR (list_contains({p}words, 'INF') AND NOT list_has_any({p}words, {quoted(V.INFUSION)})))"
    adult = lambda p: f"list_has_any({p}words, {quoted(V.ADULTS)})"
    colors = lambda p: f"[w for w in {p}words if list_contains({quoted((*V.FLAVORS, *V.COLORS))}, w)]"
    routes = lambda p: "[r for r in ['IM', 'IV', 'SC'] if " + f"list_contains({p}words, r) OR (list_contains({p}words, r[1]) AND list_contains({p}words, r[2]))]"
    apart = lambda a, b: f"(len({a}) > 0 AND len({b}) > 0 AND NOT list_has_any({a}, {b}))"
    differ = lambda c: f"(d_{c} <> '' AND m_{c} <> '' AND d_{c} <> m_{c})"
    parts = lambda p: f"flatten([[x for x in string_split(n, '/') if x <> ''] for n in {p}nums])"
    loose = lambda p: less_once(f"{p}numbers", f"list_concat({p}parts, [v for v in [{p}qty, {p}volume, {p}weight] if v <> ''])", f"(u = x OR u = {canonical('x')})").replace("{x}", canonical("x"))
    by_value = lambda p: f"[s.n for s in list_sort([{{'v': CAST(n AS DOUBLE), 'i': i, 'n': n}} for n, i in {p}parts])]"
    total = lambda p: f"coalesce(list_sum([CAST(n AS DOUBLE) for n in {p}parts]), 0)"
    one_many = "((len(d_parts) = 1 AND len(m_parts) > 1) OR (len(d_parts) > 1 AND len(m_parts) = 1))"
    liquid = f"(d_form IN ({quoted(V.LIQUID_DOSES)[1:-1]}) OR m_form IN ({quoted(V.LIQUID_DOSES)[1:-1]}))"

    def per_five(single: str, combo: str, volume: str) -> str:
        return f"""(len({combo}) = 2 AND ({volume} = '' OR {canonical(volume)} = {canonical(combo + '[2]')}) AND CAST({combo}[2] AS DOUBLE) <> 0
          AND abs(CAST({combo}[1] AS DOUBLE) / CAST({combo}[2] AS DOUBLE) - CAST({single}[1] AS DOUBLE) / 5) <= 0.01)"""

    doses = f"""({by_value('d_')} = {by_value('m_')} OR ({one_many} AND abs({total('d_')} - {total('m_')}) <= 0.01)
      OR ({liquid} AND (CASE WHEN len(d_parts) = 1 THEN {per_five('d_parts', 'm_parts', 'm_volume')} WHEN len(m_parts) = 1 THEN {per_five('m_parts', 'd_parts', 'd_volume')} ELSE false END
        OR ({one_many} AND d_parts[1] = m_parts[1]))))"""
    family = lambda values: f"(d_form IN ({quoted(values)[1:-1]}) AND m_form IN ({quoted(values)[1:-1]}))"
    insulin = lambda p: f"(CASE WHEN contains(replace({p}norm, ' ', ''), '{V.INSULIN}') THEN list_concat([r for r in ['N', 'R'] if list_contains({p}words, r)], CASE WHEN regexp_matches({p}norm, '\\b70\\s*/\\s*30\\b') THEN ['70/30'] ELSE CAST([] AS VARCHAR[]) END) ELSE CAST([] AS VARCHAR[]) END)"
    doubt = "(d_clean <> '' AND m_clean <> '' AND d_clean <> m_clean AND (NOT (contains(d_clean, m_clean) OR contains(m_clean, d_clean)) OR abs(length(d_clean) - length(m_clean)) > 2))"
    return f"""
{cte}_1 AS (SELECT *, regexp_replace(d_brand, '[^A-Z0-9]', '', 'g') AS d_clean, regexp_replace(m_brand, '[^A-Z0-9]', '', 'g') AS m_clean, {parts('d_')} AS d_parts, {parts('m_')} AS m_parts FROM {source}),
{cte}_2 AS (SELECT *, {loose('d_')} AS d_loose, {loose('m_')} AS m_loose FROM {cte}_1),
{cte} AS (SELECT *, CASE WHEN d_imported <> m_imported THEN 'different_import_status' WHEN {modifiers} OR {insulin('d_')} <> {insulin('m_')} THEN 'different_modifier'
  WHEN {apart(colors('d_'), colors('m_'))} THEN 'different_flavor'
  WHEN {child('d_')} <> {child('m_')} OR ({adult('d_')} AND {child('m_')}) OR ({adult('m_')} AND {child('d_')}) THEN 'different_age_group'
  WHEN {doubt} AND {ratio('d_clean', 'm_clean')} < 86 THEN 'different_brand'
  WHEN d_product_class <> m_product_class AND d_product_class <> 'medicine' AND m_product_class <> 'medicine' THEN 'different_product_class'
  WHEN CASE WHEN len(d_nums) > 0 AND len(m_nums) > 0 THEN NOT {doses}
    ELSE (len(d_loose) > 0 AND len(m_nums) > 0) OR (len(m_loose) > 0 AND len(d_nums) > 0) OR (len(d_loose) > 0 AND len(m_loose) > 0 AND d_loose <> m_loose) END THEN 'different_dosage'
  WHEN d_form <> '' AND m_form <> '' AND NOT (d_form = m_form OR {family(V.OCULAR)} OR {family(V.LIQUIDS)} OR {family(V.SOLIDS)}) THEN 'different_form'
  WHEN {apart(routes('d_'), routes('m_'))} THEN 'different_route'
  WHEN {differ('qty')} THEN CASE WHEN d_form = 'POWDER' AND m_form = 'POWDER' THEN 'ok' ELSE 'different_quantity' END
  WHEN {differ('volume')} THEN CASE WHEN d_form = 'SYRUP' AND m_form = 'SYRUP' THEN 'ok' ELSE 'different_volume' END
  WHEN {differ('weight')} THEN 'different_weight' WHEN {differ('flavor')} THEN 'different_flavor' ELSE 'ok' END AS reason FROM {cte}_2)"""


FIELDS = ("norm", "imported", "words", "brand", "nums", "numbers", "qty", "volume", "weight", "form", "flavor", "product_class", "keys")
PRICE = f"CASE WHEN TRY_CAST(nullif(regexp_replace({I.PRICE_TEXT}, '[^0-9.]', '', 'g'), '') AS DOUBLE) > 0 THEN TRY_CAST(nullif(regexp_replace({I.PRICE_TEXT}, '[^0-9.]', '', 'g'), '') AS DOUBLE) END"


def sides() -> str:
    """CTEs `d` and `m`: parsed inventory and catalog with prefixed components and prices."""
    d_cols = ", ".join(f"{f} AS d_{f}" for f in FIELDS)
    m_cols = ", ".join(f"{f} AS m_{f}" for f in FIELDS)
    return f"""inv AS ({I.select(I.INVENTORY | {'d_price': PRICE}, 'part')}), cat AS ({I.select(I.CATALOG, 'part')}),
{parsed('dp', 'inv', 'drug_name')}, {parsed('mp', 'cat', 'product_name_en')},
d AS (SELECT row_index, code, drug_name, d_price, {d_cols} FROM dp), m AS (SELECT idx, product_name_en, store_product_id, price AS m_price, {m_cols} FROM mp)"""


COMPONENT_PAIRS = """ck AS (SELECT row_index, unnest(d_keys) AS brand, generate_subscripts(d_keys, 1) - 1 AS pos FROM d), mk AS (SELECT idx, unnest(m_keys) AS brand FROM m),
cp AS (SELECT row_index, idx, min(pos) AS pos FROM ck JOIN mk USING (brand) GROUP BY ALL)"""
PREFIX_PAIRS = """ck AS (SELECT row_index, unnest(d_keys) AS brand, generate_subscripts(d_keys, 1) - 1 AS pos FROM d), mk AS (SELECT idx, unnest(m_keys) AS other FROM m),
pp AS (SELECT row_index, idx, min(struct_pack(pos := pos, far := -len([n for n in range(1, 8) if length(brand) >= n AND substr(brand, 1, CAST(n AS INT)) = substr(other, 1, CAST(n AS INT))]))) AS hit
  FROM ck JOIN mk ON substr(brand, 1, 3) = substr(other, 1, 3) GROUP BY ALL)"""
BONUS = "CASE WHEN d_price IS NULL OR m_price IS NULL THEN 0.0 WHEN abs(d_price - m_price) / greatest(d_price, m_price) = 0 THEN 6.0 WHEN abs(d_price - m_price) / greatest(d_price, m_price) <= 0.02 THEN 5.0 WHEN abs(d_price - m_price) / greatest(d_price, m_price) <= 0.05 THEN 4.0 WHEN abs(d_price - m_price) / greatest(d_price, m_price) <= 0.10 THEN 2.0 ELSE 0.0 END"


def token_set(a: str, b: str) -> str:
    """Token-set ratio of two normalized names, given as columns of word lists."""
    join = lambda x: f"array_to_string(list_sort({x}), ' ')"
    common, only_a, only_b = join(f"list_intersect({a}, {b})"), join(f"[w for w in list_distinct({a}) if NOT list_contains({b}, w)]"), join(f"[w for w in list_distinct({b}) if NOT list_contains({a}, w)]")
    return f"""(SELECT CASE WHEN c <> '' AND (tx = '' OR ty = '') THEN 100.0 ELSE greatest(
      100.0 * (1 - (length(tx) + length(ty) - 2 * {lcs('tx', 'ty')}) / (2.0 * (length(c) + g) + length(tx) + length(ty))),
      CASE WHEN c = '' THEN 0 ELSE 100.0 * (1 - (g + length(tx)) / (2.0 * length(c) + g + length(tx))) END,
      CASE WHEN c = '' THEN 0 ELSE 100.0 * (1 - (g + length(ty)) / (2.0 * length(c) + g + length(ty))) END) END
      FROM (SELECT {common} AS c, {only_a} AS tx, {only_b} AS ty, CASE WHEN {common} = '' THEN 0 ELSE 1 END AS g))"""


def token_sort(a: str, b: str) -> str:
    return f"(SELECT {ratio('tx', 'ty')} FROM (SELECT array_to_string(list_sort({a}), ' ') AS tx, array_to_string(list_sort({b}), ' ') AS ty))"
