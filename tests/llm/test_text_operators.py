"""Language ID, media, token output, packing and scoring against brute force, round trips and rough rows."""

import hashlib
import math
import os
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from plain import crc_mod, language as plain_language, profiles, words
from pyspark.sql import functions as F
from rough import ROWS, docs, none

from weftline.llm import language, media, packing, scoring, token_orc, tokens
from weftline.llm.common import fold_of, scratch
from weftline.llm.tokens import ODD_BLANKS, Encoder, default_path

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library, documents):
    odd = ["a\n b", "a \nb", "a\n\n \n b", "  lead", "x  y", "it's 'sand we'll don't", "1 2  3\t4", " ", "\n", "tail ", "<|endoftext|> x", "γεια σου it’s", "é è'à l'été", "日本 語", "a" * 300]
    odd += [f"a{chr(c)}b {chr(c)} c" for c in ODD_BLANKS]
    enc = Encoder(default_path())
    texts = odd + [t for _, t, _ in documents[:60]] + [t for _, t, _, _ in ROWS if t]
    for text, ids in zip(texts, enc.ids_batch(texts), strict=True):
        assert ids.tolist() == encoded(library, text), repr(text[:40])


def test_language_equals_plain(spark, documents):
    known = profiles([(t, lang) for d, t, lang in documents if crc_mod(d, 5)])
    got = {r["doc_id"]: r for r in language.op7_language(spark, DATA).collect()}
    for d, text, lang in documents:
        name, score = plain_language(text, known)
        assert (got[d]["lang_pred"], got[d]["held_out"]) == (name, crc_mod(d, 5) == 0)
        assert math.isclose(got[d]["score"], score, abs_tol=1e-9)
    held = [(got[d]["lang_pred"], lang) for d, _, lang in documents if got[d]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_language_rough(spark):
    rows = language.predict(docs(spark), language.train(docs(spark))).collect()
    assert len(rows) == len(ROWS)
    said = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in rows}
    assert said[4, None] == said[5, ""] == said[13, "12 34 56"] == ("und", 0.0)
    assert language.train(none(spark)) == {} and language.predict(none(spark), {}).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs(spark), {}).collect()} == {"und"}


def test_long_texts_count_in_chunks(monkeypatch):
    text = "ab cd  efg " * 50
    whole = language.ngrams(text)
    monkeypatch.setattr(language, "CHUNK", 7)
    for a, b in zip(whole, language.ngrams(text), strict=True):
        assert (a == b).all()


def test_media_round_trip(spark):
    made = media.to_audio(docs(spark))
    stored = media.stored(made)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, made.collect()), key=repr)
    raw = {(r["doc_id"], bytes(r["media"])) for r in stored.collect()}
    for doc_id, blob in raw:
        _, payload = media.samples(blob)
        assert len(payload) % 64 == 0 and len(payload) > 0
    kept = media.store_features(stored, scratch(spark, "tensors"))
    got = media.feature_text(kept).collect()
    assert sorted(map(tuple, media.described(stored).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    assert len(got) == len(ROWS)
    by_text = {}
    for r in got:
        texts = [t or "" for d, t, _, _ in ROWS if d == r["doc_id"]]
        body = texts[0].encode()
        body += b"\0" * (-len(body) % 64 or (64 if not body else 0))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(texts[0].encode()), len(body))
        assert (r["payload_sha256"], r["tail_crc32"]) == (hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]))
        by_text.setdefault(texts[0], set()).add((r["feature"], r["media_sha256"], r["media_bytes"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert media.feature_text(media.audio_features(media.to_audio(none(spark)))).count() == 0


def test_resampling_is_a_convolution():
    p = media.Audio()
    x = np.random.default_rng(1).integers(0, 256, 999, dtype=np.uint8)
    y = media.resample(x, 0, media.resampled_length(len(x), p), p)
    phases, _, _ = media._filters(p)
    signal = (x.astype(np.float64) - 128) / 128
    for n in (0, 1, 2, 57, 200, len(y) - 1):
        at, phase = divmod(n * p.down, p.up)
        want = sum(phases[phase][p.taps - 1 - k] * signal[at - p.taps // 2 + k] for k in range(p.taps) if 0 <= at - p.taps // 2 + k < len(x))
        assert math.isclose(y[n], want, abs_tol=1e-5)
    parts = np.concatenate([media.resample(x, a, min(64, len(y) - a), p) for a in range(0, len(y), 64)])
    assert np.allclose(parts, y, atol=1e-6)


def plain_feature(payload, p):
    """Frames, band means and active spans of a payload, from their definitions in double precision."""
    n = p.taps * p.up
    at = np.arange(n) - (n - 1) / 2
    low = np.sinc(at / max(p.up, p.down)) * np.hamming(n)
    low *= p.up / low.sum()
    x = np.zeros(len(payload) * p.up)
    x[:: p.up] = (np.frombuffer(payload, np.uint8).astype(float) - 128) / 128
    full = np.concatenate([np.convolve(x, low), np.zeros(p.taps * p.up + p.down)])
    y = [full[k * p.down + p.up * (p.taps - 1 - p.taps // 2)] for k in range(-(-len(payload) * p.up // p.down))]
    rate, bins = p.rate * p.up / p.down, p.window // 2 + 1
    frames = max(1, -(-max(0, len(y) - p.window) // p.hop) + 1)
    y = np.concatenate([y, np.zeros(frames * p.hop + p.window)])
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [mel(rate / 2) * k / (p.mels + 1) for k in range(p.mels + 2)]
    bands, energy = [], []
    turn = np.exp(-2j * np.pi * np.outer(np.arange(bins), np.arange(p.window)) / p.window)
    for f in range(frames):
        cut = y[f * p.hop : f * p.hop + p.window] * [0.5 - 0.5 * math.cos(2 * math.pi * k / (p.window - 1)) for k in range(p.window)]
        power = abs(turn @ cut) ** 2
        row = []
        for a, b, c in zip(edges, edges[1:], edges[2:]):
            total = 0.0
            for k in range(bins):
                m = mel(k * rate / p.window)
                total += power[k] * max(0.0, min((m - a) / (b - a), (c - m) / (c - b)))
            row.append(10 * math.log10(total + 1e-6))
        bands.append(row)
        energy.append(10 * math.log10((cut * cut).mean() + 1e-9))
    spans, begun = [], None
    for f, e in enumerate(energy):
        if begun is None and e - max(energy) >= p.on_db:
            begun = f
        if begun is not None and e - max(energy) < p.off_db:
            spans.append((begun, f - 1))
            begun = None
    spans += [(begun, frames - 1)] if begun is not None else []
    return frames, np.mean(bands, axis=0), [(a * p.hop / rate, (b * p.hop + p.window) / rate) for a, b in spans]


def test_features_equal_plain_ones(spark):
    texts = [(1, "quiet"), (2, "a loud text " * 90), (3, "~" * 900 + " " * 900 + "zebra" * 300), (4, None)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    p = media.Audio()
    got = {r["doc_id"]: r["feature"] for r in media.described(media.to_audio(rows)).collect()}
    for d, text in texts:
        body = (text or "").encode()
        body += b"\0" * (-len(body) % 64 or (64 if not body else 0))
        frames, bands, spans = plain_feature(body, p)
        told = dict(x.split("=") for x in got[d].split(";"))
        assert int(told["frames"]) == frames and int(told["tiles"]) == -(-frames // p.tile)
        assert np.allclose([float(x) for x in told["log_mel"].split(",")], bands, atol=0.06)
        said = ",".join(f"{a:.2f}-{b:.2f}" for a, b in spans)
        assert told["segments"] == f"{len(spans)}:{zlib.crc32(said.encode()):08x}"


def test_hysteresis_and_tensors():
    p = media.Audio()
    energy = np.array([-60, -10, -15, -13, -17, -30, -15, 0, -60.0])
    spans = media.segments(energy, p)
    step = p.hop / p.out_rate
    assert [(round(a / step), round((b - p.window / p.out_rate) / step) + 1) for a, b in spans] == [(1, 5), (7, 8)]
    mels = np.arange(20 * p.mels, dtype=np.float32).reshape(20, p.mels)
    t = media.read_tiles(media.tiles(mels, p))
    assert t.schema.field("log_mel").type.shape == [p.tile, p.mels] and t.column("frames").to_pylist() == [16, 4]


def test_token_files(spark, library, documents):
    path = scratch(spark, "orc")
    token_orc.write_ids(docs(spark), path)
    rows = token_orc.read_ids(spark, path).collect()
    want = sorted(((d, t or "") for d, t, _, _ in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    got = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["row"]))
    assert [(r["doc_id"], r["ids"]) for r in got] == [(d, [*encoded(library, t), 2]) for d, t in want]
    start = 0
    for r in sorted(token_orc.digest(spark, path).collect(), key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    assert [r["doc_id"] for r in token_orc.read_ids(spark, path, [10, 999]).collect()] == [10]
    assert "In(doc_id" in token_orc.read_ids(spark, path, [10, 11])._jdf.queryExecution().executedPlan().toString()
    start = 0
    for (d, text, _), r in zip(sorted(documents), sorted(token_orc.op8_token_orc(spark, DATA).collect()), strict=True):
        ids = [*encoded(library, text), 2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    empty = scratch(spark, "orc")
    token_orc.write_ids(none(spark), empty)
    assert token_orc.digest(spark, empty).count() == 0


def test_stripes_and_bloom_filters_let_a_lookup_skip(spark, monkeypatch):
    """Several stripes, Bloom filters on doc_id in each, and a reader that is given an id reads a row group of all rows."""
    monkeypatch.setattr(token_orc, "STRIPE", 1 << 12)
    path = scratch(spark, "orc")
    rows = spark.range(0, 24_000, 2).selectExpr("id + 8589934592 AS doc_id", "concat('w', id) AS text").coalesce(1)
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, *_: self)  # one file
    token_orc.write_ids(rows, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    file = next(f for f in os.listdir(path) if f.endswith(".orc"))
    orc = jvm.org.apache.orc.OrcFile
    reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(f"{path}/{file}"), orc.readerOptions(spark._jsc.hadoopConfiguration()))
    stripes = list(reader.getStripes())
    assert len(stripes) > 1 and reader.getRowIndexStride() == token_orc.ROWS
    records = reader.rows()
    for stripe in stripes:
        assert any(x.getKind().name().startswith("BLOOM_FILTER") for x in records.readStripeFooter(stripe).getStreamsList())

    def read(doc_id):
        leaf = jvm.org.apache.hadoop.hive.ql.io.sarg
        sarg = leaf.SearchArgumentFactory.newBuilder().startAnd().equals("doc_id", getattr(leaf, "PredicateLeaf$Type").LONG, 8589934592 + doc_id).end().build()
        names = gateway.new_array(jvm.java.lang.String, 1)
        names[0] = "doc_id"
        got, batch, n = reader.rows(reader.options().searchArgument(sarg, names)), reader.getSchema().createRowBatch(), 0
        while got.nextBatch(batch):
            n += batch.count()
        return n

    assert 0 < read(6000) <= 2 * token_orc.ROWS < 12_000 and read(6001) <= token_orc.ROWS


def test_plan_fills_best_fit():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(1, 65, 3000).tolist())
    slots = packing.plan(dict(counts), 64)
    room, placed = Counter(), Counter()
    taken = set()
    for length, rank, n, first, offset in slots:
        placed[length] += n
        for k in range(n):
            cells = {(first + k, offset + j) for j in range(length)}
            assert not cells & taken and offset + length <= 64
            taken |= cells
            room[first + k] += length
    assert placed == counts
    # one document at a time, best fit decreasing fills as many sequences
    bins: list[int] = []
    for length in sorted(counts.elements(), reverse=True):
        fits = [k for k, left in enumerate(bins) if left >= length]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= length
        else:
            bins.append(64 - length)
    assert len(room) == len(bins)


def test_packing(spark, library):
    packed = packing.pack(docs(spark), most=128, with_ids=True).collect()
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d in {x[0] for x in ROWS}:
        texts = [t or "" for k, t, _, _ in ROWS if k == d]
        ids = [*encoded(library, texts[0]), 0]
        starts = packing.cut(len(ids), 128)
        got = sorted((r["piece"], r["start"], r["length"], tuple(r["ids"]), r["ids_crc32"]) for r in by_doc[d])
        want = sorted((k, a, n, tuple(ids[a : a + n]), zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for _ in texts for k, (a, n) in enumerate(starts))
        assert got == want
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r["length"] for r in packed)
    assert len(places) <= math.ceil(total / 128) + 2
    whole = packing.sequences(packing.pack(docs(spark), most=128, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == total and max(len(r["ids"]) for r in whole) <= 128
    assert packing.pack(none(spark)).count() == 0


def base_rows(rows, k=7, out=2):
    tokens = [(d, [*words(t), None]) for d, t in rows]
    counts = Counter(w for d, ws in tokens if crc_mod("" if d is None else d, k) != out for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {(d, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in tokens}


def test_scoring(spark, documents):
    got = scoring.op2_lm(spark, DATA).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got} == base_rows([(d, t) for d, t, _ in documents])
    assert all(r["score"] < 0 and r["held_out"] == (crc_mod(r["doc_id"], 7) == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scoring_rough(spark):
    got = scoring.lm_scores(docs(spark), fold_of(F.col("doc_id"), 7) == 2).collect()
    assert len(got) == len(ROWS) and all(math.isfinite(r["score"]) for r in got)
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got} == base_rows([(d, t) for d, t, _, _ in ROWS])
    assert scoring.lm_scores(none(spark), fold_of(F.col("doc_id"), 7) == 2).count() == 0
    # more parts than models that reach the driver: a tree of means
    many = scoring.lm_scores(docs(spark).repartition(24), fold_of(F.col("doc_id"), 7) == 2).collect()
    assert base_rows([(d, t) for d, t, _, _ in ROWS]) == {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in many}
    untrained = scoring.lm_scores(docs(spark), F.lit(True)).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and math.isfinite(r["score"]) for r in untrained)


def test_scoring_parts_of_empty_texts(spark):
    """A part without a word, held out or not, beside one with words, and a corpus without any."""
    rows = [(k, t) for k, t in enumerate([None, "", " \n", None, "a few words", "a few more"])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (table, table.where("doc_id < 4")):
        for held in (F.lit(False), fold_of(F.col("doc_id"), 7) == 2, F.lit(True)):
            got = scoring.lm_scores(few.repartitionByRange(6, "doc_id"), held).collect()
            assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: len((t or "").split()) + 1 for k, t in rows[: len(got)]}
            assert len(got) in (4, 6) and all(math.isfinite(r["score"]) for r in got)
    got = scoring.lm_scores(table.repartitionByRange(6, "doc_id"), fold_of(F.col("doc_id"), 7) == 2).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got} == base_rows(rows)


def test_recurrent_model_gradients_and_state():
    from weftline.llm import gru

    shape = gru.Shape(words=7, tails=3, hidden=4, per_class=3)
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(shape, np.arange(1.0, shape.symbols + 1)).items()}
    n = shape.symbols
    x, y = rng.integers(0, n, (5, 2)), rng.integers(0, n, (5, 2))
    x[0] = shape.symbols

    def value(p):
        h, _, _ = gru.forward(p, shape, x, np.zeros((2, 4)), False)
        return gru.outputs(p, shape, h.reshape(-1, 4), y.ravel())[0].sum()

    grad = {k: np.zeros_like(v) for k, v in p.items()}
    h, kept, _ = gru.forward(p, shape, x, np.zeros((2, 4)), True)
    _, d = gru.outputs(p, shape, h.reshape(-1, 4), y.ravel(), grad)
    gru.backward(p, shape, x, kept, d.reshape(h.shape), grad)
    for k in p:
        flat = p[k].reshape(-1)
        for i in rng.integers(0, flat.size, 6):
            old = flat[i]
            flat[i] = old + 1e-3
            up = value(p)
            flat[i] = old - 1e-3
            down = value(p)
            flat[i] = old
            assert math.isclose((up - down) / 2e-3, grad[k].reshape(-1)[i], abs_tol=2e-3), k
    texts = [rng.integers(0, n, m).astype(np.uint16) for m in (1, 40, 0, 3, 90)]
    p = {k: v.astype(np.float32) for k, v in p.items()}
    a, b = gru.score(p, shape, texts, n=3, window=4), gru.score(p, shape, texts, n=1, window=64)
    assert np.allclose(a, b, atol=1e-3)
    # all symbols after a state sum to one
    state = np.tile(rng.standard_normal((1, 4)).astype(np.float32), (n, 1))
    assert math.isclose(np.exp(gru.outputs(p, shape, state, np.arange(n))[0]).sum(), 1, abs_tol=1e-4)


def plain_log(p, shape, text):
    """A text's log probability, token by token and in plain Python loops."""
    h, size, total, x = np.zeros(shape.hidden), shape.hidden, 0.0, shape.symbols
    for y in text:
        a, g = h @ p["u"], p["x"][x]
        r, z = (1 / (1 + np.exp(-(g[k * size : (k + 1) * size] + a[k * size : (k + 1) * size]))) for k in (0, 1))
        c = np.tanh(g[2 * size :] + r * a[2 * size :])
        h = (1 - z) * c + z * h
        k, member = divmod(int(y), shape.per_class)
        for logits, at in ((h @ p["c"] + p["cb"], k), (h @ p["w"][k] + p["wb"][k], member)):
            total += logits[at] - np.log(np.exp(logits).sum())
        x = int(y)
    return total


def test_scores_equal_a_plain_forward_pass():
    from weftline.llm import gru

    shape = gru.Shape(words=40, tails=6)
    rng = np.random.default_rng(1)
    p = gru.initial(shape, rng.integers(0, 50, shape.symbols).astype(float))
    texts = [rng.integers(0, shape.symbols, n).astype(np.uint16) for n in (0, 1, 7, 33, 150, 2)]
    trainer = gru.Trainer(p, shape)
    assert trainer.run(texts, n=3, window=8) == sum(map(len, texts))
    got = gru.score(trainer.p, shape, texts, n=4, window=16)
    wide = {k: v.astype(np.float64) for k, v in trainer.p.items()}
    assert np.allclose(got, [plain_log(wide, shape, t) for t in texts], rtol=1e-4, atol=1e-3)


def test_words_of_a_member_share_it_whole(spark, monkeypatch):
    """What the words of a tail member, and the unseen type of a shape, have of it sums to one."""
    monkeypatch.setattr(scoring, "FREQUENT", 20)
    rows = spark.createDataFrame([(k, " ".join(f"w{i % (k + 3)} x{i}" for i in range(40))) for k in range(30)], "doc_id long, text string")
    bits = 7
    counts = scoring.counted(scoring.numbered(rows, F.lit(False), bits)).cache()
    c = scoring.corpus(counts, 30)
    words = {}
    for r in scoring.numbered(rows, F.lit(False), bits).where("to >= 0").collect():
        for w, n, shape in zip(*scoring._words(bytes(r["blob"])), strict=True):
            words.setdefault(int(w), [0, int(shape)])[0] += int(n)
    top = set(c.words.tolist())
    tail = np.array([(w, n, s) for w, (n, s) in words.items() if w not in top], np.uint64).reshape(-1, 3)
    member = scoring._member(tail[:, 0], tail[:, 1].astype(np.int64), tail[:, 2].astype(np.int64))
    share = 10 ** c.within(tail[:, 1].astype(np.int64), member)
    unseen = np.arange(scoring.SHAPES) * scoring.MEMBERS
    assert len(member) > 20
    total = np.bincount(member, share, scoring.TAILS * scoring.MEMBERS)
    total[unseen] += 10 ** c.within(np.zeros(len(unseen), np.int64), unseen)
    assert np.allclose(total[(total > 0)][np.isin(np.flatnonzero(total > 0), member)], 1)


def test_one_very_long_text_costs_its_own_length():
    """A million symbols among a thousand short texts: what is held stays far under lanes times the longest."""
    import tracemalloc

    from weftline.llm import gru

    shape = gru.Shape(words=20, tails=2)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 20, 60).astype(np.uint16) for _ in range(1000)] + [rng.integers(0, 20, 1_000_000).astype(np.uint16)]
    lanes = gru.Lanes(texts, 256, shape.symbols)
    tracemalloc.start()
    seen = sum(int(ok.sum()) for *_, ok in lanes.windows(512))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == sum(map(len, texts)) and peak < 30e6
    p = gru.initial(shape, np.ones(shape.symbols))
    assert gru.Trainer(p, shape).run([t[:100_000] for t in texts], window=64) == 60_000 + 100_000


def test_plain_runs_are_merged_as_the_library_does(library):
    """New runs of plain characters don't take the library's way, one by one, and have its ids."""
    rng = np.random.default_rng(11)
    parts = ["the", "tion", "an", "ananan", "aaaa", "Über", "ſtÀÿ", "ǅ", "ɏ", "12", "007", "!!", ".", ",", "&&&", "_", "\n", "(", "'s", "’", "×", "²", "½", "ə", "\t", "日", "\x00"]
    runs = ["".join(rng.choice(parts, rng.integers(1, 7))) for _ in range(3000)] + ["", "\n", "a\n", "a\n\nb", "a" * 47, "ab" * 24]
    enc, found = Encoder(default_path()), {}
    left = enc.merger.encode(list(dict.fromkeys(runs)), found)
    assert set(left) | set(found) == set(runs) and not set(left) & set(found) and len(found) > 500
    for r, ids in found.items():
        assert np.frombuffer(ids, "<u2").tolist() == encoded(library, " " + r), repr(r)
    plain = [r for r in found if "'" not in r]
    assert len(plain) == len(found) and {"a\n", "a\n\nb", "", "\n"} <= set(left) and "a" * 47 in found
    # beside each other in a text (a special token spelled out among them), and once more from the cache
    runs.insert(5, "<|endoftext|>")
    for _ in range(2):
        for text, ids in zip([" ".join(runs[k : k + 9]) for k in range(0, 900, 9)], enc.ids_batch([" ".join(runs[k : k + 9]) for k in range(0, 900, 9)]), strict=True):
            assert ids.tolist() == encoded(library, text), repr(text)


def test_pieces_are_merged_once_and_by_no_library_call(library, monkeypatch):
    """What the pattern cuts is told apart before it is merged: a word is new once, whatever stands around it."""
    enc, merged = Encoder(default_path()), []
    merge = enc.merger.merge
    monkeypatch.setattr(enc.merger, "merge", lambda raw, size: merged.append(raw.shape[1]) or merge(raw, size))
    own = enc.tokenizer
    enc.tokenizer = SimpleNamespace(encode=None, encode_batch_fast=lambda texts, **_: own.encode_batch_fast(texts, add_special_tokens=False) if not texts else pytest.fail(texts[0]))
    words, ends = [f"wor{a}d{b}" for a in "abcdefgh" for b in "iklmn"], [".", ",", "!!", ".\nThe", "&&&", "7", "\n12", ""]
    texts = [" ".join(w + e for e in ends) for w in words]
    for text, ids in zip(texts * 2, enc.ids_batch(texts) + enc.ids_batch(texts), strict=True):
        assert ids.tolist() == encoded(library, text)
    # with a space before it and, at the head of a text, without
    assert 0 < sum(merged) <= 2 * len(words) + 2 * len(ends)


def test_encoder_forgets_what_is_rare(library, monkeypatch):
    """Blanks, marks and texts' ends in all orders, while most pieces are forgotten between the batches."""
    monkeypatch.setattr(tokens, "MOST", 40)
    rng, enc = np.random.default_rng(5), Encoder(default_path())
    parts = ["the", "tion", "Über", "ǅ", "ɏ", "ɐ", "7", "!!", "'s", "’", "×", "²", "日", "\U0001f600", "\n", "\t", "\r\n", "<|endoftext|>", *" " * 12, *map(chr, ODD_BLANKS), "a" * 60]
    for _ in range(30):
        texts = [None, "", *("".join(rng.choice(parts, n)) for n in rng.integers(1, 12, 80))]
        for text, ids in zip(texts, enc.ids_batch(texts), strict=True):
            assert ids.tolist() == encoded(library, text), repr(text)
        assert len(enc.known) <= 40


def test_orc_rows_of_several_chunks(spark, library, monkeypatch):
    """Offsets of the ids within a chunk of texts, end ids included, and rows numbered through."""
    path = scratch(spark, "chunks")
    rows = [(k, None if k % 5 == 0 else f"text {k % 7} of\nsome words, " * (k % 4)) for k in range(-20, 60)]
    monkeypatch.setattr(token_orc, "CHUNK", 50)
    token_orc.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path)
    got = sorted(map(tuple, token_orc.read_ids(spark, path).select("doc_id", "ids").collect()))
    assert got == [(k, encoded(library, t) + [2]) for k, t in rows]
