"""Word lists, tables and patterns that results depend on. Data, not code."""

# ---- fixed values: word lists, in natural order -------------------------------------------------
CONNECTORS = ("AND", "OF", "THE", "WITH")
FORM_WORDS = (
    "AMP", "AMPOULE", "AMPOULES", "AMPS", "BOTTLES", "CAP", "CAPS", "CAPSULE", "CAPSULES", "CARTRIDGE", "CARTRIDGES",
    "DOSES", "DROP", "DROPS", "FILM", "FILMS", "GUMMIES", "LOZENGES", "ORODISSOLVABLE", "PACKETS", "PEN", "PENS",
    "PIECE", "PIECES", "SACH", "SACHET", "SACHETS", "SUPP", "SUPPS", "TAB", "TABLET", "TABLETS", "TABS", "VIAL", "VIALS",
)
FORM_PREFIXES = (
    "CLEANSER", "CREAM", "DOUCHE", "DROPS", "EAR", "EMULGEL", "EYE", "FEMININE", "GEL", "INFUSION", "INH", "INHALER",
    "INJECTION", "INTIMATE", "LOTION", "MASSAGE", "NASAL", "OIL", "OINT", "OINTMENT", "OPHTALMIC", "ORAL", "ORL",
    "POWDER", "SERUM", "SHAMPOO", "SOAP", "SOLN", "SOLUTION", "SPRAY", "SPRAYS", "SUSP", "SYP", "SYRP", "SYRUP",
    "TOPICAL", "WASH",
)
NOISE = ("BLUE", "FACIAL", "FLAVOR", "FLAVOUR", "LIQUID", "ORS", "RED", "WHITE")
SOFT_DESCRIPTORS = ("ACTIVE", "ADULT", "ADULTS", "ANISE", "COLD", "FLU", "FOLIC", "JOINT", "NIGHT", "ORIGINAL", "SINUS", "TOP", "TRIPLE", "VAG", "VAGINAL")
QUALIFIERS = (
    "ALKALINE", "AMOUN", "ANTI", "CAFFEINE", "DA", "DS", "EFFOX", "EMOLLIENT", "ESOMEPRAZOLE", "EXTRA", "FORET", "FORTE",
    "GROWTH", "HAIR", "INFANT", "INFANTILE", "INFANTS", "INFINITY", "KID", "KIDS", "LONG", "OPHTALMIC", "OPHTIOLE", "ORL",
    "PAEDIATRIC", "PEDIATRIC", "RICH", "SURACTIVE",
)
ACRONYMS = ("AIG",)
DESCRIPTIVE = ("GELATIN",)
FLAVORS = ("APPLE", "BANANA", "BERRY", "CHERRY", "CHOCOLATE", "COLA", "GRAPE", "LEMON", "MANGO", "MINT", "ORANGE", "PINEAPPLE", "RASPBERRY", "STRAWBERRY", "VANILLA")
COLORS = ("BLACK", "BLUE", "BROWN", "GOLD", "GREEN", "GREY", "PINK", "PURPLE", "RED", "SILVER", "WHITE", "YELLOW")
VITAMINS = ("B1", "B12", "B2", "B6", "D3")
MODIFIERS = (
    "ADVANCE", "COLD", "CR", "D", "DR", "ER", "EXTRA", "FEMALE", "FORTE", "MALE", "MEN", "MOUTH", "MR", "NASAL", "NIGHT",
    "PLUS", "PRONTO", "R", "SINUS", "SR", "VAGINAL", "WOMEN", "XL", "XR",
)
COSMETIC = (
    "BODY", "CONCEALER", "COSMETIC", "CREAM", "DEODORANT", "DOUCHE", "EMULGEL", "GEL", "HAIR", "LOTION", "MASK", "MOUTH",
    "MOUTHWASH", "OIL", "SERUM", "SHAMPOO", "SOAP", "SPRAY", "SUN", "TONER", "WASH",
)
DEVICES = ("BANDAGE", "CANULA", "CONDOM", "CONDOMS", "LANCET", "LANCETS", "NEBULIZER", "NEEDLE", "NEEDLES", "PATCH", "PATCHES", "STRIP", "STRIPS", "SYRINGE", "SYRINGES")
BABY_FOOD = ("APTAMIL", "BEBEJUNIOR", "BEBELAC", "CERELAC", "FEH", "HERO", "MILK", "NAN", "NIDO", "S26")
BABY_FOOD_NOT = ("BODY", "CREAM", "LOTION")
SUPPLEMENTS = ("ASHWAGANDHA", "BIOTIN", "CALCIUM", "CENTRUM", "COLLAGEN", "D3", "FEROGLOBIN", "GLUCOSAMINE", "OMEGA", "PERFECTIL", "PREGNACARE", "VITAMIN", "VITAMINS", "ZINC")
OCULAR = ("DROPS", "EYE", "OPHTALMIC", "SOLUTION")
LIQUIDS = ("ORL", "SOLUTION", "SUSP", "SYRUP")
LIQUID_DOSES = ("AMP", "ORL", "SOLUTION", "SUSP", "SYRUP", "VIAL")
SOLIDS = ("CAP", "TAB")
PEDIATRIC = ("INFANT", "INFANTILE", "INFANTS", "KID", "KIDS", "PAEDIATRIC", "PEDIATRIC")
ADULTS = ("ADULT", "ADULTS")
INFUSION = ("AMP", "AMPS", "I", "I/V", "INFUSION", "INJ", "INJECTION", "IV", "V", "VIAL")
ROUTES = ("IM", "IV", "SC")
#: The order in which form words are looked for.
FORM_ORDER = (
    "VIAL", "VIALS", "AMPOULES", "AMPOULE", "AMP", "AMPS", "PENS", "PEN", "CARTRIDGES", "CARTIRIDGES", "CARTRIDGE", "SPRAY",
    "SPRAYS", "METERED", "SYRUP", "SYRP", "SYP", "SUSP", "DROPS", "DROP", "EYE", "OPHTALMIC", "GEL", "CREAM", "POWDER",
    "SHAMPOO", "CLEANSER", "WASH", "SOLUTION", "SUPPS", "SUPP", "TABLETS", "TABLET", "TABS", "TAB", "CAPSULES", "CAPSULE",
    "CAPS", "CAP", "DOSES",
)
#: Form word -> the form it stands for, where that is another.
FORM_NAMES = {
    "TABLET": "TAB", "TABLETS": "TAB", "TABS": "TAB", "CAPS": "CAP", "CAPSULE": "CAP", "CAPSULES": "CAP", "SPRAYS": "SPRAY",
    "DOSES": "SPRAY", "METERED": "SPRAY", "DROPS": "EYE", "DROP": "EYE", "OPHTALMIC": "EYE", "VIALS": "VIAL", "AMPS": "AMP",
    "AMPOULE": "AMP", "AMPOULES": "AMP", "PENS": "PEN", "CARTRIDGES": "CARTRIDGE", "CARTIRIDGES": "CARTRIDGE",
    "SUPPS": "SUPP", "SYRP": "SYRUP", "SYP": "SYRUP",
}
#: Words that make a modifier of one side optional.
SPRAY_WORDS = ("DOSES", "SPRAY", "SPRAYS")
VAGINAL_WORDS = ("CAP", "CAPS", "CAPSULE", "CAPSULES", "SUPP", "SUPPS")
PRICE_COLUMNS = ("price", "product_price", "sale_price", "selling_price", "سعر")
#: What a CSV cell may hold instead of a value.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# ---- fixed values: patterns ---------------------------------------------------------------------
#: Rewrites of a stripped, upper-cased name, in this order (Java syntax; (?U) makes classes Unicode-aware).
NORMAL_RULES = (
    (r"(?U)^[+*.]+\s*(IMP|IMPORTED)?\s*", ""),
    ("_", " "),
    (r"\\", " / "),
    ("-+", " "),
    ("[()]", " "),
    (r"(?U)(?<=\d)O(?=\d)", "0"),
    (r"(?U)\bFORET\b", "FORTE"),
    (r"(?U)\b(SYRP|SYP)\b", "SYRUP"),
    (r"(?U)\bVAG\b", "VAGINAL"),
    (r"\*", " / "),
    (r"(?U)([A-Z])(?=\d)", "$1 "),
    (r"(?U)(?<=\d)([A-Z])", " $1"),
    (r"(?U)\b(\d+)\s*M\b(?!\s*\.)", "$1 MG"),
    (r"(?U)\b(\d+)\s*M\s*/", "$1 MG /"),
    (r"(?U)\bANDOFLOZIN XR 25 MG\s*/\s*100 MG\b", "ANDOFLOZIN XR 25 / 1000 MG"),
    (r"(?U)\b([BD])\s+(3|6|12)\b", "$1$2"),
    (r"(?U)\s*[\\/]\s*", " / "),
    (r"(?U)(\d)\.(\d{3})\s*(I\.?U\.?|IU|MCG|MG)", "$1$2 $3"),
    (r"(?U)(?<!\d)\.(\d+)", "0.$1"),
    (r"(?U)\.(?!\d)", " "),
    (r"(?U)(?<!\d)\.", " "),
    (r"(?U)\b([DESCMX])\s+R\b", "$1R"),
    (r"(?U)\s+", " "),
    (r"^ | $", ""),
)
NUMBER = r"\d+(?:\.\d+)?"
IMPORTED = r"(?iU)(^[+*.]+\s*(IMP|IMPORTED))|\b(IMP|IMPORTED)\b"
COMBO_PER_ML = rf"(?iU)({NUMBER})\s*/\s*({NUMBER})\s*MG\s*/\s*({NUMBER})\s*ML"
PER_ML = rf"(?iU)({NUMBER})\s*MG\s*/\s*({NUMBER})\s*ML"
DOSAGE = rf"(?iU)({NUMBER}(?:\s*/\s*{NUMBER})?(?:\s\d{{3}})?)\s*(MG|MCG|I\s*U|IU|%)(?=$|\s)"
WEIGHT = rf"(?iU)({NUMBER})\s*(GM|G)\b"
VOLUME = rf"(?iU)({NUMBER})\s*ML\b"
QUANTITY = (
    r"(?iU)(\d+)\s*(?:(?:F\s*C|FC|SCORED|CHEWABLE|VAGINAL|VAG|PRE\s*FILLED|PREFILLED|METERED)\s*)?"
    r"(TABLETS|TABLET|TABS|TAB|CAPSULES|CAPSULE|CAPS|CAP|SACHETS|SACHET|SACH|AMPOULES|AMPOULE|AMPS|AMP|VIAL|SUPPS|SUPP|PIECE"
    r"|DROPS|PENS|PEN|CARTRIDGES|CARTIRIDGES|CARTRIDGE|SYRINGES|SYRINGE|GUMMIES|GUM|PACKETS|DOSES|METERED)\b"
)
PAIR = rf"(?U)\b({NUMBER}\s*/\s*{NUMBER})\b"
ANY_NUMBER = rf"(?U)\b({NUMBER})\b"
ARABIC_MARKS = "[ً-ٰٟ]"
#: Letters that Arabic normalization unifies, and what they become.
ARABIC_FROM, ARABIC_TO = "إأآٱىؤئة", "اااايويه"
#: One product whose name states the wrong strength.
STRENGTH_EXCEPTION = ("ATOMOXAPEX", "40", "100", "4", "MG/ML")
INSULIN = "INSULINAGYPT"
# ---- end of fixed values ------------------------------------------------------------------------
