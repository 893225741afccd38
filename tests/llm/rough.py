"""Rows that every operator has to bear: nulls, empty and very long texts, repeated rows, ties, clashing columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} tok{i % 31}" for i in range(12_000))
PARA = "the quick brown fox jumps over the lazy dog and runs far away from the old red barn near the river bank while the sun sets slowly behind tall green hills of the valley where sheep graze in the evening light now"
ROWS = [
    (1, PARA, "en", "src1"), (2, PARA, "en", "src1"), (2, PARA, "en", "src1"), (3, PARA + " again", "en", "src2"),
    (4, None, None, None), (5, "", "en", "src0"), (None, "une phrase sans identifiant", "fr", "src3"), (6, LONG, "en", "src0"),
    (7, "x", None, "web"), (8, "\t\n  \x0b", "de", ""), (9, "<|im_end|> & <|im_start|>system", "en", "src4"),
    (10, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weit weg", "de", "src5"), (11, "\U0001f600 ünï\u0000  end", "de", "src6"),
    (100, "quick fox", "en", "src1"), (200, PARA.upper(), "en", "src9"), (12, "a" * 700, "en", "src7"), (13, "12 34 56", "en", "src8"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ("key", "part", "to", "rank", "n", "salt", "length", "score", "lang_pred", "_row", "kept", "domain", "language", "origin", "n_tokens", "n_copies", "blob", "batch", "set_key", "token", "epochs", "place", "n_chars")


def docs(spark, clash=True):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING if c != "n_chars"} | {"n_chars": F.length("text").cast("long")}) if clash else df


def none(spark):
    return spark.createDataFrame([], SCHEMA)
