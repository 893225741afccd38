"""Chat windows, mixing, near duplicates, repeats, search and the pipeline."""

import collections

import pytest
from oracle import compare
from plain import near, repeat_rows, words
from pyspark.sql import functions as F
from rough import PARA, ROWS, docs, none

from weftline.llm import chat, jaccard, mixing, queries, search, suffixes

DATA = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs_of(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    compare(spark, queries.queries()[name], queries.oracle_sql()[name], "/root/testdata/sf0.001")


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hello <|im_end|> & you"), (1, 2, "assistant", "a &lt;| b"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 4, "assistant", ""), (2, None, "user", "no turn"), (2, 1, None, "no role"), (None, 0, "assistant", "nobody"), (3, 0, "assistant", "w " * 500),
    (3, 1, "user", "x"), (3, 2, "assistant", "ok\nok"), (4, 0, "sys\ntem", "odd role"), (5, 0, "system", "alone"),
]


def test_chat_windows(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash")).withColumn("pos", F.lit(1))
    made = chat.windows(rows, budget=24, history=6)
    by = collections.defaultdict(list)
    for r in made.collect():
        by[r["conv_id"]].append(r)
        assert r["n_tokens"] <= 24 or r["over_budget"]
    digest = {r["conv_id"]: r for r in chat.digest(made).collect()}
    for conv in {t[0] for t in TURNS}:
        turns = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        told = "".join(x for w in sorted(by[conv], key=lambda w: w["window"]) for s in w["loss"] for x in [w["text"][s["start"] : s["end"]]])
        want = "".join(t[3] for t in turns if t[2] == "assistant")
        assert told.replace("&lt;", "<").replace("&amp;", "&") == want
        import hashlib

        assert digest[conv]["turns_sha256"] == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest()
        assert (digest[conv]["n_turns"], digest[conv]["loss_chars"]) == (len(turns), len(want))
        assert digest[conv]["formatted_chars"] == sum(len(w["text"]) for w in by[conv])
    later = [w for w in by[1] if w["window"] > 0]
    assert later and all(w["text"].startswith("<|im_start|>system\nbe kind<|im_end|>") and w["n_context"] >= 1 for w in later)
    assert chat.windows(rows.where("false")).count() == 0


def test_mixing_shares_shortage_among_siblings_first(spark):
    nodes = spark.createDataFrame([("a", 5), ("b", 100), ("c", 100)], "domain string, cap long").withColumn("cap", F.col("cap").cast("decimal(19,0)")).withColumn("budget", F.lit(60).cast("decimal(19,0)"))
    got = {r["domain"]: int(r["budget"]) for r in mixing.share_out(nodes, [], F.lit(1).cast("decimal(18,0)")).collect()}
    assert got == {"a": 5, "b": 27, "c": 27}


def plain_shares(budget, nodes):
    """name -> (cap, weight) -> what each gets, by filling children one after the other until none overflows."""
    left, open_, out = budget, dict(nodes), {}
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if cap * total <= w * left]
        if not full:
            out |= {n: w * left // total for n, (_, w) in open_.items()}
            break
        for n in full:
            out[n] = open_.pop(n)[0]
        left = budget - sum(out.values())
    return out


def test_mixing_equals_plain_water_filling(spark):
    import random

    rng = random.Random(4)
    for case in range(4):
        nodes = {f"n{k:02}": (rng.choice([0, 3, 10, 10**6, 3 * 10**12, 3 * 10**12 + 1]), 1) for k in range(9)}
        budget = rng.choice([17, 3 * 10**6, 7 * 10**12])
        frame = spark.createDataFrame([(n, cap, budget) for n, (cap, _) in nodes.items()], "domain string, cap long, budget long").selectExpr("domain", "cast(cap as decimal(19,0)) cap", "cast(budget as decimal(19,0)) budget")
        got = {r["domain"]: int(r["budget"]) for r in mixing.share_out(frame, [], F.lit(1).cast("decimal(18,0)")).collect()}
        assert got == plain_shares(budget, nodes), case


def test_mixing_bears_long_source_numbers(spark):
    rows = [(1, "a b", "en", "src20240101123456"), (2, "a b", "en", "src99999999999999999999"), (3, "c", "en", "web")]
    got = mixing.choose(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), mixing.Mix(share=(1, 1), max_epochs=1)).collect()
    assert {r["doc_id"]: r["domain"] for r in got} == {1: "d0", 2: "d3", 3: ""}


def test_mixing_rough(spark):
    mix = mixing.Mix(share=(1, 1), max_epochs=1)
    got = mixing.mix_documents(docs(spark), mix)
    assert got.columns == docs(spark).columns and got.count() == len(ROWS)
    twice = mixing.mix_documents(docs(spark), mixing.Mix(share=(2, 1), max_epochs=2))
    assert twice.count() == 2 * len(ROWS)
    half = mixing.choose(docs(spark), mixing.Mix(share=(1, 2), max_epochs=1)).select(mixing.n_tokens().alias("n")).agg(F.sum("n")).first()[0] or 0
    total = docs(spark).select(mixing.n_tokens().alias("n")).agg(F.sum("n")).first()[0]
    assert half <= total / 2
    assert mixing.choose(none(spark), mix).count() == 0


def test_jaccard(spark):
    assert rows_of(jaccard.op9_jaccard(spark, DATA)) == near(pairs_of(spark))
    assert rows_of(jaccard.jaccard_components(docs(spark))) == near([(d, t) for d, t, _, _ in ROWS])
    assert jaccard.jaccard_components(none(spark)).count() == 0


def test_jaccard_frequent_classes(spark, monkeypatch):
    """Boilerplate that many documents share, edited copies, and sets of all sizes, with small limits."""
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "COMBINED", 6)
    monkeypatch.setattr(jaccard, "ROWS", 4)
    base = PARA.split()
    rows = []
    for k in range(60):
        own = [f"w{k // 2}_{i}" for i in range(3 + 5 * (k % 9))]
        rows.append((k, " ".join(base[: 8 + k % 5] + own + base[10:14])))
    for k in range(40):
        w = list(base)
        for j in range(k % 6):
            w[(7 * k + 11 * j) % len(w)] = f"edit{k}_{j}"
        rows.append((100 + k, " ".join(w)))
    monkeypatch.setattr(jaccard, "ORDINARY", 16)
    for percent, k_words, chained in ((85, 4, 1 << 14), (80, 5, 3), (60, 2, 1)):
        monkeypatch.setattr(jaccard, "CHAINED", chained)
        got = rows_of(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k_words, percent))
        assert got == near(rows, k_words, percent), (percent, k_words)


def test_sets_of_one_key_are_told_apart(spark):
    """Sets that share their 64-bit key stay different sets."""
    every = spark.createDataFrame([(1, 5, 7, 1, 70), (2, 5, 7, 1, 70), (3, 5, 7, 2, 71), (4, 5, 8, 3, 72), (5, 0, 0, 0, 0)], "doc_id long, n long, set_key long, check long, spare long")
    got = {r["doc_id"]: r["set_key"] for r in jaccard.told_apart(every).collect()}
    assert got == {1: 70, 2: 70, 3: 71, 4: 8, 5: 0}


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_components_of_chains_hubs_and_repeated_edges(spark, monkeypatch, held):
    from weftline.llm import graph

    monkeypatch.setattr(graph, "HELD", held)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 900)] + [(1, 1), (None, 3), (7, 3), (3, 7), (7, 3), (9, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 500 for k in range(500, 900)} | {3: 3, 7: 3, 9: 3}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_suffix_dedup(spark):
    rough = [(d, t) for d, t, _, _ in ROWS]
    assert rows_of(suffixes.op6_suffix(spark, DATA)) == repeat_rows(pairs_of(spark))
    family = suffixes.Family(spark)
    family.add(docs(spark))
    assert rows_of(family.cut()) == repeat_rows(rough)
    family = suffixes.Family(spark)
    family.add(none(spark), last=True)
    assert family.cut().count() == 0


def test_suffix_family_of_batches(spark, monkeypatch):
    """Batches one after the other give what all at once give; long texts run in overlapping slices; heads that more
    than a few regions share deal their windows by hash."""
    monkeypatch.setattr(suffixes, "BLOCK", 3000)
    monkeypatch.setattr(suffixes, "HOT", 2)
    rows = pairs_of(spark)[:90] + [(1000 + d, t) for d, t, _, _ in ROWS if d is not None]
    family = suffixes.Family(spark)
    for k in range(3):
        family.add(spark.createDataFrame(rows[k::3], "doc_id long, text string"), last=k == 2)
    assert rows_of(family.cut()) == repeat_rows(rows)
    with pytest.raises(ValueError):
        family.add(none(spark))


def test_levels_stay_logarithmic_and_old_ones_as_they_are(spark):
    """After n batches the levels hold the binary digits of n, in byte order; a batch rewrites none but those it merges with."""
    import numpy as np

    rows = pairs_of(spark)[:70]
    family, stored = suffixes.Family(spark, bits=6), {}
    for k in range(7):
        family.add(spark.createDataFrame(rows[k::7], "doc_id long, text string"))
        assert family.sizes == [2**d for d in range(3, -1, -1) if (k + 1) >> d & 1]
        now = {path: sorted((r["id"], bytes(r["blob"])) for r in level.collect()) for level, path in family.levels}
        assert all(now[path] == blobs for path, blobs in stored.items() if path in now)
        kept = sum(path in now for path in stored)
        assert kept == len(family.sizes) - 1
        stored = now
    for blobs in stored.values():
        for _, blob in blobs:
            run = suffixes.loaded(blob)
            assert (run["head"][1:] >= run["head"][:-1]).all()
    family.add(spark.createDataFrame([], "doc_id long, text string"), last=True)
    assert rows_of(family.cut()) == repeat_rows(rows)
    new, old = np.zeros(2, suffixes.ENTRY), np.zeros(1000, suffixes.ENTRY)
    new["head"], old["head"] = [b"b", b"d"], np.sort(np.array([b"a", b"b", b"c", b"e"] * 250))
    old["region"], new["region"] = np.arange(1000), [300, 5]
    said, status = suffixes.scan(new, [old])
    assert len(said) == 251 and set(said["head"]) == {b"b"} and (status[said["region"] == 300] & suffixes.REPEATED).sum() >= 1


def test_search_rough(spark, monkeypatch):
    import math

    got = search.top_k(docs(spark), F.col("doc_id") % 100 == 0, 5).collect()
    tokens = [(d, words(t)) for d, t, _, _ in ROWS]
    n, mean = len(tokens), sum(len(w) for _, w in tokens) / len(tokens)
    df = collections.Counter(w for _, ws in tokens for w in set(ws))
    for q, ws in tokens:
        if q is None or q % 100:
            continue
        scored = []
        for d, other in tokens:
            tf = collections.Counter(other)
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(other) / mean)) for w in set(ws) if tf[w])
            if s > 0:
                scored.append((-round(s, 6), d is None, d or 0))
        want = [(None if nul else d, -s) for s, nul, d in sorted(scored)[:5]]
        found = [(r["doc_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert [d for d, _ in found] == [d for d, _ in want] and all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(found, want, strict=True))
    assert search.top_k(none(spark), F.col("doc_id") % 100 == 0, 5).count() == 0


def test_rows_of_one_query_id_are_queries_of_their_own(spark):
    rows = [(100, "a b c"), (100, "a x"), (1, "a b"), (2, "x y"), (2, "x y")]
    got = search.top_k(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), F.col("doc_id") % 100 == 0, 9).collect()
    assert all(r["query_id"] == 100 for r in got) and len(got) == 3 + 5
    by = collections.Counter((r["doc_id"], r["score"]) for r in got)
    parts = search.top_k(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), F.col("doc_id") % 100 == 0, 9).collect()
    assert by == collections.Counter((r["doc_id"], r["score"]) for r in parts)
    assert sorted(r["rank"] for r in got) == sorted([1, 2, 3, 1, 2, 3, 4, 5])


def test_floors_prune_without_loss():
    """Random shards and queries: any floor at or under the k-th score gives the same best documents."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for case in range(12):
        docs = [np.unique(rng.zipf(1.3, rng.integers(1, 60)) % 500, return_counts=True) for _ in range(700)]
        flat = np.concatenate([t for t, _ in docs]).astype(np.uint64)
        tf, doc = np.concatenate([c for _, c in docs]), np.repeat(np.arange(700), [len(t) for t, _ in docs])
        by = np.argsort(flat, kind="stable")
        words, df = np.unique(flat, return_counts=True)
        t = pa.table({"term": [words.astype("<u8").tobytes()], "df": [df.astype("<u4").tobytes()], "doc": [doc[by].astype("<u4").tobytes()], "tf": [tf[by].astype("<u4").tobytes()], "size": [np.array([c.sum() for _, c in docs], "<i8").tobytes()], "id": [list(range(700))]})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema) as w:
            w.write_table(t)
        shard = search.Shard(sink.getvalue().to_pybytes(), 20.0)
        ask = docs[case][0].astype(np.uint64)
        idf = np.log1p((700 - df[np.searchsorted(words, ask)] + 0.5) / (df[np.searchsorted(words, ask)] + 0.5))
        full, scores = shard.top(shard.places(ask), idf, 10)
        for low in (scores[-1], scores[-1] * 0.7, scores[-1] * 0.2, 1e-3):
            d, s = shard.top(shard.places(ask), idf, 10, low)
            assert d.tolist() == full.tolist() and s.tolist() == scores.tolist()
        assert len(shard.top(shard.places(ask), idf, 10, 1e3)[0]) == 0


def test_search_shards_and_query_blocks(spark, monkeypatch):
    whole = rows_of(search.op10_search(spark, DATA))
    monkeypatch.setattr(search, "POSTINGS", 2000)
    monkeypatch.setattr(search, "QUERY_WORDS", 256)
    monkeypatch.setattr(search, "BLOCK", 4)
    assert rows_of(search.op10_search(spark, DATA)) == whole


def test_queries_are_scored_together_without_loss(monkeypatch):
    """Tables and lists of any extent, queries in any blocks: each query's best are those of plain scores, floors and ties included."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    docs = [np.unique(rng.zipf(1.3, rng.integers(1, 60)) % 500, return_counts=True) for _ in range(300)] + [(np.array([1, 2, 3]), np.array([1, 1, 70000]))] * 40
    n = len(docs)
    tf, doc = np.concatenate([c for _, c in docs]), np.repeat(np.arange(n), [len(t) for t, _ in docs])
    flat = np.concatenate([t for t, _ in docs]).astype(np.uint64)
    by = np.argsort(flat, kind="stable")
    words, df = np.unique(flat, return_counts=True)
    sizes = np.array([c.sum() for _, c in docs], "<i8")
    ids = [None, *range(n - 1)]
    t = pa.table({"term": [words.astype("<u8").tobytes()], "df": [df.astype("<u4").tobytes()], "doc": [doc[by].astype("<u4").tobytes()], "tf": [tf[by].astype("<u4").tobytes()], "size": [sizes.tobytes()], "id": [ids]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    asks = [t.astype(np.uint64) for t, _ in docs[:30]] + [np.array([999], np.uint64), np.zeros(0, np.uint64), docs[-1][0].astype(np.uint64)]
    weigh = dict(zip(words.tolist(), np.log1p((n - df + 0.5) / (df + 0.5)).tolist(), strict=True))
    idfs = [np.array([weigh.get(x, 1.0) for x in q.tolist()]) for q in asks]
    want = []
    for q in asks:
        held = set(q.tolist())
        found = []
        for d, (terms, counts) in enumerate(docs):
            s = sum(weigh[x] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * sizes[d] / 20.0)) for x, c in zip(terms.tolist(), counts.tolist(), strict=True) if x in held)
            found += [(-round(s, 6), ids[d] is None, ids[d] or 0, d)] if s else []
        want.append([(d, -s) for s, _, _, d in sorted(found)[:10]])
    lows = np.array([(-1.0, w[-1][1], w[len(w) // 2][1], 0.3 * w[-1][1])[j % 4] if w else 2.0 for j, w in enumerate(want)])
    ends = np.cumsum([0, *map(len, asks)])
    for wide, cells, block, listed, exact in ((20, 4 << 20, 128, 1 << 18, 1024), (4, 4 << 20, 3, 50, 2), (10**9, 2000, 7, 1, 1), (1, 0, 64, 1 << 18, 5)):
        for name, value in (("WIDE", wide), ("CELLS", cells), ("BLOCK", block), ("LISTED", listed), ("EXACT", exact)):
            monkeypatch.setattr(search, name, value)
        shard = search.Shard(sink.getvalue().to_pybytes(), 20.0)
        got = {j: list(zip(d.tolist(), s.tolist(), strict=True)) for j, d, s in shard.best(shard.places(np.concatenate(asks)), np.concatenate(idfs), ends, 10, lows)}
        for j, w in enumerate(want):
            w, found = [x for x in w if x[1] >= lows[j] - 5e-6], got.get(j, [])
            assert [d for d, _ in found] == [d for d, _ in w] and all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(found, w, strict=True))
