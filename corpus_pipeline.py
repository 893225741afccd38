"""A corpus pipeline of five stages, each one operator over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import jaccard, language, mixing, packing, suffixes
from weftline.llm.common import collected, delete, written

#: Documents whose language is undetermined or whose best profile fits worse than this are rejected.
LEAST_FIT = 0.2
MIX = mixing.Mix(domains={"d0": 4, "d1": 3, "d2": 2, "d3": 1}, languages={"en": 5, "fr": 2, "de": 2}, sources={"src0": 2}, share=(4, 5), max_epochs=1)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; profiles come from the lang of all documents, predictions from text alone.

    Null texts and texts without a letter have no language and go; a null lang teaches nothing; repeated rows are judged
    each; without any lang all documents go; an empty table gives none; columns of any name keep their values.
    """
    profiles = language.train(docs)
    names = [c if c == "text" else f"_{k}" for k, c in enumerate(docs.columns)]  # none that predict() adds
    judged = language.predict(docs.toDF(*names), profiles)
    return judged.where((F.col("lang_pred") != language.UND) & (F.col("score") >= LEAST_FIT)).select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least doc_id (nulls last) and then text, of each group of rows that five-word shingles of
    Jaccard 0.8 connect, whatever their ids; rows without a word are in no group and all stay.

    Null and empty texts stay; a null doc_id comes last in its group; of repeated rows one stays; ties of an id go to the
    least text; an empty table gives none; columns of any name keep their values.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key")
    found = jaccard.jaccard_components(docs.select(key.alias("doc_id"), "text"), 5, 80).withColumnRenamed("doc_id", "key")
    found = written(found.groupBy("key").agg(F.min("component_id").alias("component_id"), F.max("n_shingles").alias("n")), "near-rows", slim=True)
    # texts are compared only where a group's least id has several
    ids = docs.select(key, F.struct(F.col("doc_id").isNull(), F.col("doc_id")).alias("id")).distinct()
    grouped = written(ids.join(found.where("n > 0").select("key", "component_id"), "key"), "near-ids", slim=True)
    least = grouped.groupBy("component_id").agg(F.min("id").alias("id"))
    first = grouped.join(least, ["component_id", "id"]).select("component_id", "key")
    counted = written(first.groupBy("component_id").agg(F.count("*").alias("c"), F.min("key").alias("key")), "near-first", slim=True)
    tied = first.join(counted.where("c > 1").select("component_id"), "component_id")
    won = docs.select(key, "text").join(tied, "key").groupBy("component_id").agg(F.min_by("key", "text").alias("key"))
    keep = counted.where("c = 1").select("key").unionByName(won.select("key")).withColumn("grouped", F.lit(True))
    keep = written(keep.unionByName(found.where("n = 0").select("key", F.lit(False).alias("grouped"))), "near-keep", slim=True)
    named = docs.select(F.struct(*docs.columns).alias("_row"), key, F.xxhash64(F.col("text").cast("string"), F.col("doc_id").cast("long")).alias("_key2")).join(keep, "key")
    place = F.row_number().over(Window.partitionBy("key", "_key2").orderBy("grouped"))  # of equal rows
    return named.withColumn("place", place).where("place = 1 OR NOT grouped").select("_row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that also starts elsewhere; n_chars follows. The corpus is one batch.

    All rows stay. Null texts stay null, texts under 200 bytes stay as they are, repeated rows of 200 bytes and more lose
    all of their text; an empty table gives none; columns of any name keep their values.
    """
    family = suffixes.Family(spark)
    family.add(docs, last=True)
    cut = family.cut(with_text=True).withColumnRenamed("kept", "_kept")
    named = suffixes.keyed(docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).select("_row", *suffixes.KEYS)
    row, changed = F.col("_row").withField("text", F.col("_kept")), F.col("_kept").isNotNull()
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("_kept").cast("long"))
    return named.join(cut, [*suffixes.KEYS], "left").select(F.when(changed, row).otherwise(F.col("_row")).alias("_row")).select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their leaf's budget, in at most one epoch.

    Null lang and source are names of their own; a null text counts one token; rows that share a doc_id stay or go together;
    an empty table gives none; columns of any name keep their values.
    """
    return mixing.mix_documents(docs, MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    A null text is one end token; repeated rows are packed one by one; an empty table gives no pieces; other columns are ignored.
    """
    return packing.pack(docs)


#: Scratch tables of each stage's last call.
_LEFT: dict[str, list[str]] = {}


def _tidy(name: str, stage, before: str | None):
    """A stage that first deletes what the stage before it left: its caller has written that one's result, as it has to."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, _LEFT.pop(before, []))
        with collected() as made:
            out = stage(spark, docs, sf_dir)
        _LEFT[name] = made
        return out

    return run_stage


PLAIN = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("mixing", mix_sources), ("packing", pack_sequences)]
#: Each to be called on the written and reread result of the one before.
STAGES = [(name, _tidy(name, stage, PLAIN[k - 1][0] if k else None)) for k, (name, stage) in enumerate(PLAIN)]

#: Language profiles, byte-level matches and the tokenizer are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A run's scratch tables are its own: what a stage left is deleted once its result is
    written, and only the mixed documents and what the returned pieces are read from stay."""
    docs, spent = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in PLAIN[:-1]:
        with collected() as made:
            out = stage(spark, docs, sf_dir)
            docs = written(out, f"pipeline-{name}")
        delete(spark, [*spent, *(x for x in made if x != docs.scratch_path)])
        spent = [docs.scratch_path]
    return PLAIN[-1][1](spark, docs, sf_dir)
