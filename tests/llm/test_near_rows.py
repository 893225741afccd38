"""Near duplicates are decided row by row, whatever the ids."""

import corpus_pipeline

DATA = "/root/testdata/sf0.001"
COPIED = "a copied text of more than five words that comes again"
OTHER = "words that nothing else in this small table has anywhere near it"
ALONE = "quite another passage under an id that was given twice before"


def test_near_duplicates_by_row(spark):
    rows = [(2, COPIED), (5, COPIED), (5, OTHER), (6, ALONE), (6, ALONE), (None, OTHER + " really"), (None, "only here and without any id at all now"), (None, "only here and without any id at all now"), (8, ""), (8, None), (7, f"{ALONE} z"), (7, f"{ALONE} y")]
    docs = spark.createDataFrame([(d, t, "en", "src1", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    assert got.columns == docs.columns
    want = [(2, COPIED), (5, OTHER), (6, ALONE), (None, "only here and without any id at all now"), (8, ""), (8, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_ties_of_an_id_go_to_the_least_text(spark):
    rows = [(7, f"{ALONE} z"), (7, f"{ALONE} y"), (9, ALONE), (None, f"{ALONE} x")]
    docs = spark.createDataFrame([(d, t, "en", "src1", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(7, f"{ALONE} y")]
