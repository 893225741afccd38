"""LM scoring (2): complete-document log-likelihood under a gated recurrent model, beside a unigram base.

1. Words (runs of other bytes than ASCII blanks, A-Z lower-cased) are 64-bit hashes. A task numbers its own
   distinct words, keeps its texts as these numbers and sends each word with its training count to the word's
   hash range; the corpus counts come back, for exactly the words that the task has. No dictionary is broadcast.
2. The most frequent words (FREQUENT, a parameter of the model) have symbols of their own. All others belong to
   tail classes (by count and by the word's last two bytes), whose MEMBERS, dealt by the word's hash, are symbols
   too: class and member both depend on the state. What a member's words share is fixed by their training counts.
   Words seen once and unseen ones share a member by Good-Turing masses, where its unseen words are one type.
3. The model starts from the corpus's unigram counts, is trained on one part as a common start, then every
   task trains it on all its own training texts, and the weighted mean of the parameters is the model.
4. Every text is scored whole; the recurrent state is carried from window to window.

Cases: a null text is an empty one (its end is its only token); a null doc_id counts as the empty text for its
fold; repeated rows are scored each; without training rows all counts are 0; an empty table gives no rows;
other columns are ignored. A text of any length is scored whole: it costs two bytes a token and a window of states.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bytehash, gru
from weftline.llm.common import by_size, discard, fold_of, hash_bits, texts, tidied, written

U = np.uint64
#: Words with an output of their own (the end is one more); tokens that a task packs at once; bytes of symbols in lanes at once.
FREQUENT, PACKED, LANES = 1023, 1 << 21, 1 << 22
#: Tail classes: from these counts on, times SHAPES classes by last bytes. The first holds the unseen, too, in one member.
BANDS, SHAPES, MEMBERS = (0, 2, 4, 16, 256), 8, 32
TAILS = len(BANDS) * SHAPES
#: Models that reach the driver at most; models that a task averages at once.
MEANS, FAN = 16, 32


def _member(word: np.ndarray, count: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Number of the tail class's member that a word belongs to."""
    tail = (np.searchsorted(BANDS, count, side="right") - 1) * SHAPES + shape
    return tail * MEMBERS + np.where(count >= BANDS[1], (word.astype(np.uint64) >> U(20)).astype(np.int64) % MEMBERS, 0)


def numbered(docs: DataFrame, train_fold, bits: int) -> DataFrame:
    """Rows (to, part, blob): words with training counts by hash range (to >= 0); each part's texts (to = -1)."""

    def run(batches):
        task, made, held = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        out_of: list[bool] = []
        seqs: list[np.ndarray] = []
        tails: list[np.ndarray] = []

        def flush():
            nonlocal made
            part = task << 20 | made
            made += 1
            flat = np.concatenate(seqs) if seqs else np.zeros(0, np.uint64)
            shape = np.concatenate(tails) if tails else np.zeros(0, np.uint8)
            n = np.array([len(s) for s in seqs], np.int64)
            train = np.repeat(~np.array(out_of, bool), n)
            words, at, number = np.unique(flat, return_index=True, return_inverse=True)
            counts = np.bincount(number[train], minlength=len(words)).astype(np.uint32)
            to = (words >> U(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            ends = [*cut[1:].tolist(), *[len(words)] * (len(words) > 0)]  # a part of empty texts has no words
            shape = shape[at]
            rows = [(int(to[a]), b"".join((words[a:b].tobytes(), counts[a:b].tobytes(), shape[a:b].tobytes()))) for a, b in zip(cut.tolist(), ends, strict=True)]
            wide = np.uint32 if len(words) > 65535 else np.uint16
            number = number.astype(wide)
            stop = np.cumsum(n)
            own = pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(out_of, pa.bool_()), "seq": pa.array([number[b - k : b].tobytes() for b, k in zip(stop.tolist(), n.tolist(), strict=True)], pa.binary())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(own)
            rows.append((-2 if wide is np.uint16 else -1, sink.getvalue().to_pybytes()))
            for x in (ids, out_of, seqs, tails):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["to", "part", "blob"])

        for batch in batches:
            doc_ids, outs = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for first, data, offsets in bytehash.blocks(batch.column("text"), 1 << 20):
                w, rows, ends = bytehash.words_at(data, offsets)
                shape = ((data[ends - 1].astype(np.uint32) * 31 + data[np.maximum(ends - 2, 0)] * np.uint32(17)) % SHAPES).astype(np.uint8)
                cut = np.searchsorted(rows, np.arange(len(offsets)))
                for j, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                    ids.append(doc_ids[first + j])
                    out_of.append(outs[first + j])
                    seqs.append(w[a:b])
                    tails.append(shape[a:b])
                    held += b - a
                if held >= PACKED or len(ids) >= 1 << 20:
                    yield flush()
                    held = 0
        if ids:
            yield flush()

    keyed = texts(docs).withColumn("held_out", train_fold)
    return keyed.mapInArrow(tidied(run), "to int, part long, blob binary")


def _words(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(blob) // 13
    return np.frombuffer(blob, "<u8", n), np.frombuffer(blob, "<u4", n, 8 * n), np.frombuffer(blob, "u1", n, 12 * n)


def counted(parts: DataFrame) -> DataFrame:
    """Rows (kind, part, to, blob): kind 0 the corpus counts of a part's words of one range (with their shapes),
    kind 1 a range's most frequent words, kind 2 its sums by tail class."""

    def run(key, table):
        blobs = [_words(b) for b in table.column("blob").to_pylist()]
        flat = np.concatenate([b[0] for b in blobs])
        words, at, number = np.unique(flat, return_index=True, return_inverse=True)
        count = np.bincount(number, np.concatenate([b[1] for b in blobs]), len(words)).astype(np.int64)
        shape = np.concatenate([b[2] for b in blobs])[at]
        cut = np.cumsum([0, *(len(b[0]) for b in blobs)])
        rows = [(0, p, count[number[a:b]].astype("<i8").tobytes() + shape[number[a:b]].tobytes()) for p, a, b in zip(table.column("part").to_pylist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        best = np.lexsort((words, -count))[:FREQUENT]
        best = best[count[best] > 0]
        rows.append((1, 0, np.stack([words[best].astype(np.int64), count[best], shape[best].astype(np.int64)], axis=1).astype("<i8").tobytes()))
        tail, n = _member(words, count, shape), TAILS * MEMBERS
        sums = np.stack([np.bincount(tail, count > 0, n), np.bincount(tail, count, n), np.bincount(shape.astype(np.int64) * MEMBERS, count == 2, n)], axis=1)
        rows.append((2, 0, sums.astype("<i8").tobytes()))
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.int32()), "part": pa.array([r[1] for r in rows], pa.int64()), "to": pa.array([key[0].as_py()] * len(rows), pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary())})

    return parts.where("to >= 0").groupBy("to").applyInArrow(run, "kind int, part long, to int, blob binary")


class Corpus:
    """Corpus statistics of bounded size: totals, the frequent words and the tail classes."""

    def __init__(self, top: np.ndarray, sums: np.ndarray, train_docs: int):
        order = np.lexsort((top[:, 0].astype(np.uint64), -top[:, 1]))[:FREQUENT]
        top = top[order]
        words = top[:, 0].astype(np.uint64)
        self.end = len(words)  # its symbol
        by = np.argsort(words)
        self.words, self.symbols = words[by], by
        self.train_tokens = int(sums[:, 1].sum()) + train_docs
        self.distinct = int(sums[:, 0].sum()) + (train_docs > 0)
        self.end_count = train_docs
        sums = sums.copy()
        tail = _member(words, top[:, 1], top[:, 2])
        np.subtract.at(sums[:, 0], tail, 1)
        np.subtract.at(sums[:, 1], tail, top[:, 1])
        np.subtract.at(sums[:, 2], top[:, 2] * MEMBERS, top[:, 1] == 2)
        self.tails = sums
        self.shape = gru.Shape(self.end + 1, TAILS, per_class=MEMBERS)
        #: The first tail symbol.
        self.first_tail = self.shape.word_classes * MEMBERS
        self.counts = np.full(self.shape.symbols, -1.0)
        self.counts[: self.end + 1] = [*top[:, 1], train_docs]
        rare = np.arange(TAILS * MEMBERS) < SHAPES * MEMBERS
        self.counts[self.first_tail :] = np.where(rare & (np.arange(TAILS * MEMBERS) % MEMBERS > 0), -1, sums[:, 1])

    def within(self, count: np.ndarray, member: np.ndarray) -> np.ndarray:
        """log10 P(word | its tail class's member)."""
        total = np.maximum(self.tails[member, 1], 1)
        shape = member // MEMBERS % SHAPES * MEMBERS
        once = self.tails[shape, 0]  # words seen once, by shape
        unseen, again = once + 1.0, 2.0 * self.tails[shape, 2] + 1.0
        p = np.where(count >= BANDS[1], count / total, np.where(count == 1, again / (unseen + again) / np.maximum(once, 1), unseen / (unseen + again)))
        return np.log10(p)


def corpus(counts: DataFrame, parts_docs: DataFrame) -> Corpus:
    """Only sums and at most FREQUENT words reach the driver; ranges keep their own, the best of all are chosen here
    after a second cut by count."""
    tops = counts.where("kind = 1").select("blob")

    def spread(batches):
        for batch in batches:
            t = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 3) for b in batch.column("blob").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(t[:, k]) for k in range(3)], names=["word", "n", "shape"])

    best = tops.mapInArrow(spread, "word long, n long, shape long").orderBy(F.desc("n"), F.col("word") < 0, "word").limit(FREQUENT).collect()
    top = np.array([tuple(r) for r in best], np.int64).reshape(-1, 3)

    def fold(batches):
        total = np.zeros((TAILS * MEMBERS, 3), np.int64)
        for batch in batches:
            for b in batch.column("blob").to_pylist():
                total += np.frombuffer(b, "<i8").reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *(pa.array(total[:, k]) for k in range(3))], names=["tail", "a", "b", "c"])

    rows = counts.where("kind = 2").select("blob").mapInArrow(fold, "tail long, a long, b long, c long").groupBy("tail").agg(F.sum("a"), F.sum("b"), F.sum("c")).collect()  # a row for each member
    sums = np.zeros((TAILS * MEMBERS, 3), np.int64)
    for r in rows:
        sums[r[0]] = r[1:]
    return Corpus(top, sums, parts_docs)


def resolved(parts: DataFrame, counts: DataFrame, bits: int, shared) -> DataFrame:
    """Per text: doc_id, held_out, n_tokens, n_known, base_score, tail_score and its symbols (end included)."""
    both = parts.where("to < 0").select("part", "to", "blob").unionByName(counts.where("kind = 0").select("part", "to", "blob")).unionByName(parts.where("to >= 0").select("part", (-F.col("to") - 10).alias("to"), "blob"))

    def run(table):
        c: Corpus = shared.value
        to, blobs = table.column("to").to_pylist(), table.column("blob").to_pylist()
        own = next((t, b) for t, b in zip(to, blobs, strict=True) if t in (-1, -2))
        words = np.concatenate([_words(blobs[k])[0] for k in sorted((k for k, t in enumerate(to) if t <= -10), key=lambda k: -to[k])] or [np.zeros(0, np.uint64)])
        said = [blobs[k] for k in sorted((k for k, t in enumerate(to) if t >= 0), key=lambda k: to[k])]
        count = np.concatenate([np.frombuffer(b, "<i8", len(b) // 9) for b in said] or [np.zeros(0, np.int64)])
        shape = np.concatenate([np.frombuffer(b, "u1", len(b) // 9, len(b) // 9 * 8) for b in said] or [np.zeros(0, np.uint8)])
        tail = _member(words, count, shape)
        symbol = tail + c.first_tail
        static = c.within(count, tail)
        if len(c.words):
            at = np.minimum(np.searchsorted(c.words, words), len(c.words) - 1)
            hit = c.words[at] == words
            symbol = np.where(hit, c.symbols[at], symbol)
            static = np.where(hit, 0.0, static)
        symbol = symbol.astype(np.uint16)
        norm = np.log10(c.train_tokens + c.distinct + 1)
        base = np.log10(count + 1.0) - norm
        end_base = np.log10(c.end_count + 1.0) - norm
        docs = pa.ipc.open_stream(own[1]).read_all()
        kind = np.uint16 if own[0] == -2 else np.uint32
        out = []
        for raw in docs.column("seq").to_pylist():
            s = np.frombuffer(raw, kind)
            out.append((len(s) + 1, int((count[s] > 0).sum()) + (c.end_count > 0), float(base[s].sum() + end_base), float(static[s].sum()), np.append(symbol[s], np.uint16(c.end)).astype("<u2").tobytes()))
        cols = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table([docs.column("doc_id"), docs.column("held_out"), pa.array([table.column("part")[0].as_py()] * docs.num_rows, pa.int64()), *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names=["doc_id", "held_out", "part", "n_tokens", "n_known", "base_score", "tail_score", "symbols"])

    return both.groupBy("part").applyInArrow(run, "doc_id long, held_out boolean, part long, n_tokens long, n_known long, base_score double, tail_score double, symbols binary")


def trained(rows: DataFrame, shape: gru.Shape, start: bytes) -> bytes | None:
    """The weighted mean of the parameters that the tasks reach on their training texts from a common start."""

    def learn(batches):
        trainer, tokens = gru.Trainer(gru.unpacked(start, shape), shape), 0
        for batch in batches:
            for part in by_size(batch, "symbols", LANES):
                tokens += trainer.run([np.frombuffer(s, "<u2") for s in part.column("symbols").to_pylist()])
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([tokens], pa.int64()), pa.array([gru.packed(trainer.p)], pa.binary())], names=["k", "tokens", "model"])

    def mean(key, table):
        w = table.column("tokens").to_numpy().astype(np.float64)
        total = sum(x * np.frombuffer(m.as_py(), "<f4") for x, m in zip(w, table.column("model"), strict=True))
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "tokens": pa.array([int(w.sum())], pa.int64()), "model": pa.array([(total / w.sum()).astype("<f4").tobytes()], pa.binary())})

    form = "k int, tokens long, model binary"
    done = written(rows.where("NOT held_out").select("symbols").mapInArrow(tidied(learn), form), "op2-models")
    last = done.agg(F.max("k")).first()[0]
    if last is None:
        return None
    while last >= MEANS:  # a tree of means
        before, done, last = done, written(done.select(F.floor(F.col("k") / FAN).cast("int").alias("to"), "tokens", "model").groupBy("to").applyInArrow(mean, form), "op2-models"), last // FAN
        discard(before)
    means = done.collect()
    discard(done)
    w = np.array([r["tokens"] for r in means], np.float64)
    return ((w / w.sum()) @ np.stack([np.frombuffer(bytes(r["model"]), "<f4") for r in means])).astype("<f4").tobytes()


def lm_scores(docs: DataFrame, train_fold) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; train_fold: column, true for texts to hold out."""
    spark = docs.sparkSession
    bits = hash_bits(docs, 7)
    parts = written(numbered(docs, train_fold, bits), "op2-parts")
    counts = written(counted(parts), "op2-counts")
    train_docs = docs.where(~train_fold).count()
    found = corpus(counts, train_docs)
    shared = spark.sparkContext.broadcast(found)
    rows = written(resolved(parts, counts, bits, shared), "op2-symbols")
    discard(parts, counts)
    shape = found.shape
    model = gru.packed(gru.initial(shape, found.counts))
    first = rows.where("NOT held_out").agg(F.min("part")).first()[0]
    if first is not None:
        model = trained(rows.where(F.col("part") == first), shape, model) or model
        model = trained(rows, shape, model) or model
    final = spark.sparkContext.broadcast(model)

    def judge(batches):
        p = gru.unpacked(final.value, shape)
        keep = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        for batch in batches:
            for part in by_size(batch, "symbols", LANES):
                got = gru.score(p, shape, [np.frombuffer(s, "<u2") for s in part.column("symbols").to_pylist()])
                total = got / np.log(10) + part.column("tail_score").to_numpy()
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(total)], names=[*keep, "score"])

    scored = rows.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "tail_score", "symbols").mapInArrow(tidied(judge), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(found.train_tokens).cast("long"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), fold_of(F.col("doc_id"), 7) == 2)
