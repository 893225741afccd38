"""The pipeline against a plain version of its five stages."""

import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
from plain import language, near, profiles, repeats
from pyspark.sql import functions as F
from rough import CLASHING, docs, none

from weftline.llm import mixing
from weftline.llm.common import written
from weftline.llm.tokens import default_path

DATA = "/root/testdata/sf0.001"


def plain_stages(rows):
    """rows: (doc_id, text, lang, source) -> the rows after language ID, near duplicates, repeats and mixing."""
    known = profiles([(t, lang) for _, t, lang, _ in rows])
    after = []
    kept = []
    for r in rows:
        lang, score = language(r[1], known)
        if lang != "und" and score >= corpus_pipeline.LEAST_FIT:
            kept.append(r)
    after.append(kept)
    first = {d for d, _, c in near([(r[0], r[1]) for r in kept], 5, 80) if d == c}
    kept = [r for r in kept if r[0] in first]
    after.append(kept)
    cut = {d: body for d, body, spans in repeats([(r[0], r[1]) for r in kept]) if spans}
    kept = [(r[0], cut[r[0]].decode("utf-8", "ignore") if r[0] in cut else r[1], r[2], r[3]) for r in kept]
    after.append(kept)
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", kept)
    chosen = {r[0] for r in con.execute(f"WITH {mixing.mix_sql(corpus_pipeline.MIX, 'd')} SELECT doc_id FROM chosen").fetchall()}
    after.append([r for r in kept if r[0] in chosen])
    return after


def test_pipeline_equals_plain_stages(spark):
    cols = ["doc_id", "text", "lang", "source"]
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    want = plain_stages([tuple(r) for r in source.select(*cols).collect()])
    docs = source
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        docs = written(stage(spark, docs, DATA), "test")
        assert docs.columns == source.columns
        assert sorted(tuple(r) for r in docs.select(*cols).collect()) == sorted(rows), name
        assert docs.where("n_chars <> length(text)").count() == 0
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_path())
    pieces = corpus_pipeline.run(spark, DATA).collect()
    found = {}
    for r in pieces:
        found.setdefault(r["doc_id"], []).append((r["piece"], r["length"], r["ids_crc32"]))
    assert set(found) == {r[0] for r in want[-1]}
    for d, text, _, _ in want[-1]:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert sum(n for _, n, _ in found[d]) == len(ids)
        if len(found[d]) == 1:
            assert found[d][0][2] == zlib.crc32(ids.tobytes())


def test_stages_bear_rough_rows(spark):
    rows = docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        rows = written(stage(spark, rows, DATA), "test")
        if name != "packing":
            assert rows.columns == docs(spark).columns
            assert rows.dtypes == docs(spark).dtypes
            own = [c for c in CLASHING if c != "n_chars"]
            assert rows.count() == rows.where(" AND ".join(f"`{c}` = 'own {c}'" for c in own)).count() > 0
    assert rows.count() > 0
    rows = none(spark).withColumn("n_chars", F.lit(0).cast("long"))
    for _, stage in corpus_pipeline.STAGES:
        rows = written(stage(spark, rows, DATA), "test")
        assert rows.count() == 0


def test_repeats_keep_what_is_left(spark):
    common = " ".join(hashlib.sha256(str(k).encode()).hexdigest()[:7] for k in range(70))
    rows = [(1, f"alpha {common} omega", "en", "src1", 0), (2, f"beta {common} psi", "en", "src1", 0), (3, "gamma", "en", "src1", 0)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), DATA).collect()}
    assert got == {d: body.decode() for d, body, _ in repeats([r[:2] for r in rows])}
    assert got[3] == "gamma" and all(common not in text for text in got.values())


def test_runs_beside_each_other(spark):
    first = corpus_pipeline.run(spark, DATA)
    second = corpus_pipeline.run(spark, DATA)
    assert sorted(first.drop("sequence_id", "offset").collect()) == sorted(second.drop("sequence_id", "offset").collect())
