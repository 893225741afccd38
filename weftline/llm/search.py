"""Exact top-k search (10): BM25 over sharded inverted indexes with tables of frequent terms, merged by global statistics.

Each part of the documents becomes a shard: postings by term (64-bit word hashes) over blocks of documents.
Document frequencies and lengths of the whole corpus score all shards alike, so merging the shards' top k gives
the corpus's top k exactly.

A query first meets the shard that it comes from, in full: the k-th score there is a floor for all other shards,
and a task raises it from shard to shard. In a shard the terms that many documents hold are a table of impacts, and a
matrix product in single precision gives what they add for many queries and all documents at once; the lists of the other
terms are added to it. What comes close to the floor or above it, rounding errors included, is scored exactly. Queries
run in blocks of bounded size; a block of queries is what is broadcast.

Score: sum over the query's distinct words of ln(1 + (N - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 +
.75 * length / mean length)), rounded to 6 digits; words are runs of other bytes than ASCII blanks, A-Z
lower-cased. Ties go to the smaller doc_id, a null one last; documents that share no word with a query have no
score and are not listed.

Cases: a null text has no words, finds nothing and is never found; a row with a null doc_id is no query; very long
texts are queries like others; repeated rows are documents and queries of their own (rows that share an id are
listed under it each with ranks of its own); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import bytehash
from weftline.llm.common import discard, hash_bits, texts, tidied, written

K1, B = 1.2, 0.75
#: Postings that a shard holds; distinct words of a block of queries.
POSTINGS, QUERY_WORDS = 2 << 20, 1 << 20
#: Scores are rounded and summed in floating point: bounds closer than this to a floor don't rule out.
SLACK = 1e-5
#: Terms that one document of WIDE (on average) holds have a row in a shard's table, which has CELLS cells at most.
WIDE, CELLS = 20, 4 << 20
#: Queries of a matrix product, where its result has no more than CELLS cells; postings of lists (or scores) added at once; documents scored exactly at once.
BLOCK, LISTED, EXACT = 128, 1 << 18, 1024
#: The least sum that counts as a shared word.
TINY = 1e-30
#: Documents of a shard at most (20 bits number the queries of a part).
DOCS = 1 << 20
U = np.uint64


def shards(docs: DataFrame, is_query: Column, bits: int) -> DataFrame:
    """Rows (kind, part, to, blob): 0 a shard, 1 its terms and document frequencies by hash range, 2 its queries' terms."""

    def run(batches):
        task, made, held = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        asks: list[bool] = []
        terms: list[np.ndarray] = []
        tfs: list[np.ndarray] = []
        sizes: list[int] = []

        def flush():
            nonlocal made
            part = task << 20 | made
            made += 1
            # similar lengths and words side by side make block maxima tight: order by the commonest word, then length
            n = np.array([len(t) for t in terms], np.int64)
            lead = np.array([int(t[f.argmax()]) if len(t) else 0 for t, f in zip(terms, tfs, strict=True)], np.uint64)
            order = np.lexsort((np.array(sizes), lead))
            flat, tf = np.concatenate([terms[k] for k in order]), np.concatenate([tfs[k] for k in order])
            doc = np.repeat(np.arange(len(order)), n[order])
            by = np.argsort(flat, kind="stable")
            flat, tf, doc = flat[by], tf[by], doc[by]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
            words, df = flat[first], np.diff(np.append(first, len(flat)))
            table = pa.table({"term": pa.array([words.tobytes()], pa.binary()), "df": pa.array([df.astype("<u4").tobytes()], pa.binary()), "doc": pa.array([doc.astype("<u4").tobytes()], pa.binary()), "tf": pa.array([tf.astype("<u4").tobytes()], pa.binary()), "size": pa.array([np.array(sizes, "<i8")[order].tobytes()], pa.binary()), "id": pa.array([[ids[k] for k in order]], pa.list_(pa.int64()))})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            rows = [(0, -1, sink.getvalue().to_pybytes())]
            to = (words >> U(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            rows += [(1, int(to[a]), words[a:b].tobytes() + df[a:b].astype("<u4").tobytes()) for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(words)], strict=True)]
            # queries in groups of bounded size
            group, size, groups = [], 0, []
            for k, q in enumerate(asks):
                if q and len(terms[k]) and ids[k] is not None:
                    group.append(k)
                    size += len(terms[k])
                    if size >= QUERY_WORDS // 8:
                        groups.append(group)
                        group, size = [], 0
            groups += [group] if group else []
            for g, group in enumerate(groups):
                flat = np.concatenate([terms[k] for k in group])
                owner = np.repeat(np.array([[part << 20 | k, ids[k]] for k in group], np.int64), [len(terms[k]) for k in group], axis=0)
                to = (flat >> U(64 - bits)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                cut = np.flatnonzero(np.diff(to[by], prepend=-1))
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(by)], strict=True):
                    rows.append((2 + g, int(to[by[a]]), flat[by[a:b]].tobytes() + owner[by[a:b], 0].tobytes() + owner[by[a:b], 1].tobytes()))
            total = int(sum(sizes))
            for x in (ids, asks, terms, tfs, sizes):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()), pa.array([len(order) if r[0] == 0 else 0 for r in rows], pa.int64()), pa.array([total if r[0] == 0 else 0 for r in rows], pa.int64())], names=["kind", "part", "to", "blob", "docs", "words"])

        for batch in batches:
            doc_ids, wanted = batch.column("doc_id").to_pylist(), batch.column("query").to_pylist()
            for first, data, offsets in bytehash.blocks(batch.column("text"), 1 << 20):
                w, rows = bytehash.words(data, offsets)
                cut = np.searchsorted(rows, np.arange(len(offsets)))
                for j, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                    t, f = np.unique(w[a:b], return_counts=True)
                    ids.append(doc_ids[first + j])
                    asks.append(bool(wanted[first + j]))
                    terms.append(t)
                    tfs.append(f)
                    sizes.append(b - a)
                    held += len(t)
                if held >= POSTINGS or len(ids) >= DOCS - 1:
                    yield flush()
                    held = 0
        if ids:
            yield flush()

    keyed = texts(docs).withColumn("query", is_query)
    return keyed.mapInArrow(tidied(run), "kind int, part long, to int, blob binary, docs long, words long")


def weighed(rows: DataFrame) -> DataFrame:
    """Queries' terms with their corpus document frequencies: rows (part, grp, blob)."""

    def run(table):
        kinds, parts, blobs = table.column("kind").to_pylist(), table.column("part").to_pylist(), table.column("blob").to_pylist()
        said = [(np.frombuffer(b, "<u8", len(b) // 12), np.frombuffer(b, "<u4", len(b) // 12, len(b) // 12 * 8)) for b, k in zip(blobs, kinds, strict=True) if k == 1]
        words, at = np.unique(np.concatenate([w for w, _ in said]), return_inverse=True)
        df = np.bincount(at, np.concatenate([d for _, d in said]), len(words)).astype(np.int64)
        out = []
        for b, k, p in zip(blobs, kinds, parts, strict=True):
            if k >= 2:
                t, q, ids = np.frombuffer(b, "<i8").reshape(3, -1)
                out.append((p, k - 2, np.stack([t, q, ids, df[np.searchsorted(words, t.view(np.uint64))]]).tobytes()))
        return pa.table({"part": pa.array([x[0] for x in out], pa.int64()), "grp": pa.array([x[1] for x in out], pa.int32()), "blob": pa.array([x[2] for x in out], pa.binary())})

    found = rows.where("kind >= 1").groupBy("to").applyInArrow(run, "part long, grp int, blob binary")
    return found.groupBy("part", "grp").agg(F.array_sort(F.collect_list("blob")).alias("blobs"))  # of one bounded group


class Shard:
    """A shard ready for queries, given the corpus's mean length.

    The impacts of terms that many of its documents hold are a table, which a matrix product weighs for many queries at once;
    those of all other terms are lists."""

    def __init__(self, blob: bytes, mean: float):
        t = pa.ipc.open_stream(blob).read_all()
        get = lambda c, kind: np.frombuffer(t.column(c)[0].as_py(), kind)
        self.term, df, doc, tf, size = get("term", "<u8"), get("df", "<u4").astype(np.int64), get("doc", "<u4"), get("tf", "<u4"), get("size", "<i8")
        # a null id comes last among ties
        self.id = np.array([LAST if x is None else x for x in t.column("id")[0].as_py()], np.int64)
        n = len(size)
        self.norm = K1 * (1 - B + B * size / mean)
        wide = np.flatnonzero(df * WIDE >= n)
        most = CELLS // max(1, n)
        wide = np.sort(wide[np.argsort(-df[wide], kind="stable")[:most]])
        self.row = np.full(len(df), -1)
        self.row[wide] = np.arange(len(wide))
        begin = np.concatenate([[0], np.cumsum(df)])
        listed = np.ones(len(doc), bool)
        self.tf = np.zeros((len(wide), n), np.uint16 if not len(tf) or tf.max() < 1 << 16 else np.uint32)
        for r, k in enumerate(wide.tolist()):
            x = slice(begin[k], begin[k + 1])
            self.tf[r, doc[x]] = tf[x]
            listed[x] = False
        self.table = np.zeros(self.tf.shape, np.float32)
        for r in range(len(wide)):
            self.table[r] = self._impact(self.tf[r], self.norm)
        self.tf = np.ascontiguousarray(self.tf.T)
        # lists of the terms without a row, laid end to end
        self.doc = doc[listed].astype(np.int32)
        self.impact = self._impact(tf[listed], self.norm.take(self.doc))
        held = df.copy()
        held[wide] = 0
        self.start = np.concatenate([[0], np.cumsum(held)])
        #: Relative error of a sum of products in single precision, all of them positive, with some room.
        self.error = (len(wide) + 8) * 2.0**-23

    @staticmethod
    def _impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.float64)
        return tf * (K1 + 1) / (tf + norm)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of (ascending) terms in this shard, -1 for those that it lacks."""
        if not len(self.term):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.term, terms), len(self.term) - 1)
        return np.where(self.term[at] == terms, at, -1)

    def top(self, at: np.ndarray, idf: np.ndarray, k: int, floor: float = -1.0) -> tuple[np.ndarray, np.ndarray]:
        """best() of one query."""
        for _, docs, scores in self.best(at, idf, np.array([0, len(at)]), k, np.array([floor])):
            return docs, scores
        return np.zeros(0, np.int64), np.zeros(0)

    def best(self, at: np.ndarray, idf: np.ndarray, ends: np.ndarray, k: int, floors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, its k best documents' numbers, scores) of each query that has documents at its floor or above, all
        documents considered. at: places() of the queries' terms, those of query j from ends[j] to ends[j + 1].
        """
        n = len(self.id)
        step = max(1, min(BLOCK, CELLS // max(1, n)))
        for a in range(0, len(floors), step):
            b = min(len(floors), a + step)
            own = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
            place, weight = at[ends[a] : ends[b]], idf[ends[a] : ends[b]]
            hit = place >= 0
            own, place, weight = own[hit], place[hit], weight[hit]
            row = self.row[place]
            wide = row >= 0
            asked = np.zeros((b - a, len(self.table)))
            asked[own[wide], row[wide]] = weight[wide]
            product = asked.astype(np.float32) @ self.table
            own, place, weight = own[~wide], place[~wide], weight[~wide]
            start = self.start[place]
            length = self.start[place + 1] - start
            some = np.searchsorted(own, np.arange(b - a + 1))
            upto = np.concatenate([[0], np.cumsum(length)])
            done = upto[some]
            c = 0
            while c < b - a:
                # as many queries as have LISTED postings to add
                e = min(max(c + 1, int(np.searchsorted(done, done[c] + LISTED, side="right")) - 1), c + max(1, LISTED // n))
                x = slice(some[c], some[e])
                m = length[x]
                index = np.repeat(start[x] - (upto[x] - done[c]), m)
                index += np.arange(len(index))
                cell = np.repeat((own[x] - c) * n, m)
                cell += self.doc.take(index)
                add = self.impact.take(index)
                add *= np.repeat(weight[x], m)
                listed = np.bincount(cell, add, (e - c) * n).astype(np.float64, copy=False).reshape(e - c, n)
                about = listed + product[c:e]
                low = (floors[a + c : a + e] - SLACK) * (1 - self.error)
                q, d = np.divmod(np.flatnonzero(about >= np.maximum(low, TINY)[:, None]), n)
                yield from self._exact(a + c, q, d, about, listed, asked[c:e], k, floors)
                c = e

    def _exact(self, first: int, q, d, about, listed, asked, k: int, floors) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The best of the documents that may be, by their exact scores."""
        cut = np.searchsorted(q, np.arange(len(about) + 1))
        for j in np.flatnonzero(np.diff(cut)).tolist():
            docs = d[cut[j] : cut[j + 1]]
            if len(docs) > k:
                v = about[j].take(docs)
                docs = docs[v >= np.partition(v, len(v) - k)[len(v) - k] * (1 - 2 * self.error) - SLACK]
            scores = listed[j].take(docs)
            use = np.flatnonzero(asked[j])
            weight = asked[j].take(use)
            for s in range(0, len(docs), EXACT):
                part = docs[s : s + EXACT]
                scores[s : s + EXACT] += (self._impact(self.tf[part[:, None], use], self.norm.take(part)[:, None]) * weight).sum(axis=1)
            scores = np.round(scores, 6)
            docs, scores = docs[(keep := scores >= floors[first + j] - SLACK)], scores[keep]
            if len(docs) > k:
                keep = scores >= np.partition(scores, len(docs) - k)[len(docs) - k]
                docs, scores = docs[keep], scores[keep]
            if len(docs):
                best = np.lexsort((self.id[docs], -scores))[:k]
                yield first + j, docs[best], scores[best]


LAST = 2**63 - 1


def _queries(blobs: list[bytes], n: int):
    """(row, id, terms, idf) of each query of a group; terms ascend."""
    flat = np.concatenate([np.frombuffer(b, "<i8").reshape(4, -1) for b in blobs], axis=1)
    flat = flat[:, np.lexsort((flat[0].view(np.uint64), flat[1]))]
    first = np.flatnonzero(np.concatenate([[True], flat[1, 1:] != flat[1, :-1]]))
    idf = np.log1p((n - flat[3] + 0.5) / (flat[3] + 0.5))
    terms = flat[0].view(np.uint64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), flat.shape[1]], strict=True):
        yield int(flat[1, a]), int(flat[2, a]), terms[a:b], idf[a:b]


def floors(index: DataFrame, queries: DataFrame, n: int, mean: float, k: int) -> DataFrame:
    """(part, grp, words, blob): each group of queries with the k-th score of each in the shard that it comes from."""
    both = index.select("part", F.lit(-1).alias("grp"), F.array("blob").alias("blobs")).unionByName(queries.select("part", "grp", "blobs"))

    def run(table):
        grps, blobs = table.column("grp").to_pylist(), table.column("blobs").to_pylist()
        asked = sorted(j for j, g in enumerate(grps) if g >= 0)
        out = []
        if asked:
            shard = Shard(blobs[grps.index(-1)][0], mean)
        for j in asked:
            rows, ids, words, idfs = [], [], [], []
            for row, id_, terms, idf in _queries(blobs[j], n):
                rows.append(row)
                ids.append(id_)
                words.append(terms)
                idfs.append(idf)
            lows = [-1.0] * len(rows)
            at = shard.places(np.concatenate(words))
            for q, _, scores in shard.best(at, np.concatenate(idfs), np.cumsum([0, *map(len, words)]), k, np.array(lows)):
                lows[q] = scores[k - 1] if len(scores) == k else -1.0
            sink = pa.BufferOutputStream()
            own = pa.table({"row": pa.array(rows, pa.int64()), "id": pa.array(ids, pa.int64()), "low": pa.array(lows, pa.float64()), "terms": pa.array([w.tobytes() for w in words], pa.binary()), "idf": pa.array([w.tobytes() for w in idfs], pa.binary())})
            with pa.ipc.new_stream(sink, own.schema) as w:
                w.write_table(own)
            out.append((table.column("part")[0].as_py(), grps[j], sum(map(len, words)), sink.getvalue().to_pybytes()))
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["part", "grp", "words", "blob"])

    return both.groupBy("part").applyInArrow(run, "part long, grp int, words long, blob binary")


def top_k(docs: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, doc_id, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = written(shards(docs, is_query, hash_bits(docs, 6, 1)), "op10-shards")
    index = rows.where("kind = 0").select("part", "blob")
    total = rows.where("kind = 0").agg(F.sum("docs").alias("n"), F.sum("words").alias("w")).first()
    n, mean = total["n"] or 0, (total["w"] or 0) / max(1, total["n"] or 0) or 1.0
    weights = written(weighed(rows), "op10-weights")
    queries = written(floors(index, weights, n, mean, k), "op10-queries")
    discard(weights)
    turns: list[list] = []
    held = 0
    for r in queries.select("part", "grp", "words").orderBy("part", "grp").collect():  # a row for each group of queries
        if not turns or held + r["words"] > QUERY_WORDS:
            turns.append([])
            held = 0
        turns[-1].append((r["part"], r["grp"]))
        held += r["words"]
    schema = "row long, query_id long, doc_id long, score double"
    found = None
    for turn in turns:
        wanted = spark.createDataFrame(turn, "part long, grp int")
        shared = sc.broadcast([bytes(r["blob"]) for r in queries.join(F.broadcast(wanted), ["part", "grp"]).select("blob").collect()])  # at most QUERY_WORDS words and one group

        def ask(batches):
            asked = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in shared.value])
            rows, ids = (asked.column(c).to_pylist() for c in ("row", "id"))
            lows = asked.column("low").to_numpy().copy()
            idfs = np.concatenate([np.frombuffer(x, "<f8") for x in asked.column("idf").to_pylist()])
            lists = [np.frombuffer(x, "<u8") for x in asked.column("terms").to_pylist()]
            words, of = np.unique(np.concatenate(lists), return_inverse=True)
            ends = np.cumsum([0, *map(len, lists)])
            best: dict[int, tuple] = {}
            for batch in batches:
                for blob in batch.column("blob").to_pylist():
                    shard = Shard(blob, mean)
                    for j, d, s in shard.best(shard.places(words)[of], idfs, ends, k, lows):
                        i, old = shard.id[d], best.get(rows[j])
                        if old is not None:
                            i, s = np.concatenate([old[1], i]), np.concatenate([old[2], s])
                            keep = np.lexsort((i, -s))[:k]
                            i, s = i[keep], s[keep]
                        best[rows[j]] = ids[j], i, s
                        if len(s) == k:
                            lows[j] = max(lows[j], s[-1])
            for row, (id_, i, s) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(i), pa.int64()), pa.array([id_] * len(i), pa.int64()), pa.array(i, mask=i == LAST), pa.array(s)], names=["row", "query_id", "doc_id", "score"])

        part = written(index.select("blob").mapInArrow(tidied(ask), schema), "op10-found")
        found = part if found is None else found.unionByName(part)
        shared.unpersist()
    if found is None:
        found = spark.createDataFrame([], schema)
    discard(rows, queries)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


#: Production parameters: the ten best documents of each document whose id is divisible by 100.
TOP = 10


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/documents.parquet"), F.col("doc_id") % 100 == 0, TOP)


OP10_SQL = rf"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS size FROM tf GROUP BY doc_id),
stats AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(size) FROM len) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * {K1 + 1} / (d.tf + {K1} * ({1 - B} + {B} * size / mean))), 6) AS score
  FROM tf q JOIN tf d USING (term) JOIN df USING (term) JOIN len ON len.doc_id = d.doc_id, stats
  WHERE q.doc_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {TOP}
"""
