"""N-gram Jaccard join (9): token-combination prefixes.

A document is its set of distinct 4-word shingles. Documents link when 100 * |x and y| >= 85 * |x or y|, and the
result is each document's component.

1. Extended prefixes. Shingles are ordered by hash. Linked sets share at least ceil(.85 n) shingles, so their
   first n - ceil(.85 n) + k ones share at least k; k is 15 % of n. Tasks send these prefixes, packed, by hash
   range; document frequencies come back. A document of which too few prefix shingles occur twice has no link.
2. Index. Of the rest, ordered by frequency, again only a prefix is indexed, extended by one. A rare shingle is
   a key by itself; shingles of the frequent class are keys in combinations of two, as linked documents share
   two at least. A shingle is never in the frequent class if some document would have to index too many
   combinations or is too small to promise two, so both sides of a link always index alike. That is decided
   within spans of sizes that can link (each set lies in two of them), so that a few small sets that hold a very
   common shingle don't decide for large ones.
3. Verification. Documents that share keys form candidate groups (components, never pairs). Within a group
   blocks of documents meet and intersections are counted exactly over an inverted index of the block; a block
   hands on a spanning forest of its links. Groups of any size are split into blocks, compared only where sizes
   allow a link. Where chance has chained keys to a group of more than CHAINED sets, its keys' own lists are the
   groups instead (lists of the same sets once), so the work follows the lists and not the square of the chain.

Equal sets are one node throughout, so thousands of copies cost as much as one.

Cases: a null text and a text without words are an empty set, linked with nothing; texts of under four words
are one shingle; repeated rows are copies; a null doc_id takes part, and component_id is the smallest doc_id
that isn't null (null if there is none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import bytehash
from weftline.llm.common import collected, delete, discard, hash_bits, texts, tidied, written
from weftline.llm.graph import Forest, components

WORDS, PERCENT = 4, 85
#: Prefix entries that a task packs at once; document frequency from which a shingle may be of the frequent
#: class, and how many of that class a document may have; documents of a block.
PACKED, FREQUENT, COMBINED, ROWS = 1 << 21, 64, 16, 1024
#: Shingles up to which a set counts as one of a block's ROWS; a larger one counts as several.
ORDINARY = 1024
#: Sets of a group from which its keys' lists are verified instead of the group.
CHAINED = 1 << 14
U = np.uint64


def _least(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set that it links to."""
    return -(-percent * n // 100)


def _extra(n: int, percent: int) -> int:
    """k of a set of n."""
    return max(1, -(-(100 - percent) * n // 100))


def _promised(n: int, percent: int) -> int:
    """Shingles that the extended prefixes of a set of n and of any set that it links to share at least."""
    return _extra(_least(n, percent), percent)


def set_keys(s: np.ndarray) -> tuple[int, int, int]:
    """A set's key, what tells it from other sets of the same key, and its key in that case."""
    d = hashlib.blake2b(s.tobytes(), digest_size=24).digest()
    return tuple(int.from_bytes(d[a : a + 8], "little", signed=True) for a in (0, 8, 16))


KEYS = ("set_key", "check", "spare")


def prefixes(docs: DataFrame, k_words: int, percent: int, bits: int) -> DataFrame:
    """Rows (to, part, blob): packed prefix entries by hash range (to >= 0), and each part's documents (to = -1)."""

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[int] = []
        keys: list[tuple[int, int, int]] = []
        entries: list[np.ndarray] = []

        def flush():
            nonlocal made
            part = task << 20 | made
            made += 1
            flat = np.concatenate(entries) if entries else np.zeros(0, np.uint64)
            local = np.repeat(np.arange(len(entries), dtype=np.uint64), [len(e) for e in entries])
            to = (flat >> U(64 - bits)).astype(np.int64)
            packed = ((flat >> U(24 - bits)) & U((1 << 40) - 1)) << U(24) | local
            order = np.argsort(to, kind="stable")
            to, packed = to[order], packed[order]
            first = np.flatnonzero(np.diff(to, prepend=-1))
            blobs = [x.tobytes() for x in np.split(packed, first[1:])] if len(first) else []
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()), **{c: pa.array([x[k] for x in keys], pa.int64()) for k, c in enumerate(KEYS)}})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            out = pa.RecordBatch.from_arrays([pa.array([-1, *to[first].tolist()], pa.int32()), pa.array([part] * (1 + len(blobs)), pa.int64()), pa.array([sink.getvalue().to_pybytes(), *blobs], pa.binary())], names=["to", "part", "blob"])
            for x in (ids, sizes, keys, entries):
                x.clear()
            return out

        held = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in bytehash.blocks(batch.column("text")):
                for j, s in enumerate(bytehash.shingles(data, offsets, k_words)):
                    n = len(s)
                    ids.append(doc_ids[first + j])
                    sizes.append(n)
                    keys.append(set_keys(s) if n else (0, 0, 0))
                    entries.append(s[: n - _least(n, percent) + _extra(n, percent)] if n else s)
                    held += len(entries[-1])
                if held >= PACKED or len(ids) >= 1 << 20:
                    yield flush()
                    held = 0
        if ids:
            yield flush()

    return texts(docs).mapInArrow(tidied(run), "to int, part long, blob binary")


def frequencies(packed: DataFrame, bits: int) -> DataFrame:
    """Rows (part, blob) of the entries that occur more than once: token, row within the part, frequency."""

    def count(key, table):
        to = key[0].as_py()
        parts = table.column("part").to_pylist()
        blobs = [np.frombuffer(b, "<u8") for b in table.column("blob").to_pylist()]
        flat = np.concatenate(blobs)
        owner = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        token = flat >> U(24)
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        df = np.diff(np.append(first, len(token)))
        df = np.repeat(df, df)
        keep = df > 1
        out = np.empty(int(keep.sum()), [("token", "<i8"), ("row", "<u4"), ("df", "<u4")])
        out["token"] = (U(to) << U(40) | token[keep]).astype(np.int64)
        out["row"], out["df"] = flat[keep] & U((1 << 24) - 1), df[keep]
        owner = owner[keep]
        order = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[order], np.arange(len(blobs) + 1))
        out = out[order]
        return pa.table({"part": pa.array(parts, pa.int64()), "blob": pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    return packed.where("to >= 0").groupBy("to").applyInArrow(count, "part long, blob binary")


def survivors(packed: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """A row for each document: doc_id, n, set_key and, if it can have a link, the tokens to index and their frequencies."""
    both = packed.where("to = -1").select("part", F.lit(True).alias("own"), "blob").unionByName(found.select("part", F.lit(False).alias("own"), "blob"))

    def gather(table):
        own = table.column("own").to_pylist()
        blobs = table.column("blob").to_pylist()
        docs = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b, o in zip(blobs, own, strict=True) if o])
        n = docs.column("n").to_numpy()
        hits = np.concatenate([np.frombuffer(b, [("token", "<i8"), ("row", "<u4"), ("df", "<u4")]) for b, o in zip(blobs, own, strict=True) if not o] or [np.zeros(0, [("token", "<i8"), ("row", "<u4"), ("df", "<u4")])])
        hits = hits[np.lexsort((hits["token"], hits["df"], hits["row"]))]
        cut = np.searchsorted(hits["row"], np.arange(len(n) + 1))
        tokens, dfs = [], []
        for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
            size = int(n[k])
            promised = _promised(size, percent) if size else 0
            if not size or b - a < promised:
                tokens.append(None)
                dfs.append(None)
            else:
                last = min(b, a + (b - a) - promised + 2)
                tokens.append(hits["token"][a:last])
                dfs.append(hits["df"][a:last].astype(np.int64))
        return pa.table({"doc_id": docs.column("doc_id"), "n": docs.column("n"), **{c: docs.column(c) for c in KEYS}, "tokens": pa.array(tokens, pa.list_(pa.int64())), "dfs": pa.array(dfs, pa.list_(pa.int64()))})

    return both.groupBy("part").applyInArrow(gather, "doc_id long, n long, set_key long, check long, spare long, tokens array<long>, dfs array<long>")


def told_apart(every: DataFrame) -> DataFrame:
    """every with one set_key for each set: sets that chance gave the same 64 bits get their spare ones."""
    same = every.where("n > 0").groupBy("set_key").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("set_key")
    if same.isEmpty():
        return every.drop("check", "spare")
    named = every.join(same.withColumn("shared", F.lit(True)), "set_key", "left")
    return named.withColumn("set_key", F.when(F.col("shared"), F.col("spare")).otherwise(F.col("set_key"))).drop("check", "spare", "shared")


def index_keys(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, set_key): the index keys of each set that are not its alone."""
    entry = nodes.select("set_key", F.explode(F.arrays_zip("tokens", "dfs")).alias("e")).select("set_key", F.col("e.tokens").alias("token"), F.col("e.dfs").alias("df"))
    # combinations promise two shared shingles: sets too small for that, or with too many candidates, speak against the class
    least = F.ceil(F.col("n") * percent / 100)
    promised = F.greatest(F.lit(1), F.ceil(least * (100 - percent) / 100))
    often = nodes.select("set_key", "n", "tokens", "dfs", F.size(F.filter("dfs", lambda d: d > FREQUENT)).alias("f")).where("f > 0")
    often = often.withColumn("against", (F.col("f") > COMBINED) | (promised < 2))
    # sets that link lie in the same band of sizes or in neighbouring ones: a span is a band and the next
    band = F.floor(F.log("n") / (math.log(100 / min(percent, 99)) * 1.001)).cast("long")
    held = often.select("set_key", "against", F.explode(F.array(band - 1, band)).alias("span"), "tokens", "dfs")
    held = held.select("set_key", "against", "span", F.explode(F.arrays_zip("tokens", "dfs")).alias("e")).where(F.col("e.dfs") > FREQUENT).select("set_key", "against", "span", F.col("e.tokens").alias("token"))
    # written sides make plain shuffled joins, in which Spark splits what a very common shingle brings together
    verdict = written(held.groupBy("token", "span").agg(F.max("against").alias("single")), "op9-classes", slim=True)
    classed = written(held.select("set_key", "token", "span").join(verdict, ["token", "span"]), "op9-classed", slim=True)
    singles = entry.where(F.col("df") <= FREQUENT).select("set_key", F.col("token").alias("key")).unionByName(classed.where("single").select("set_key", F.xxhash64("token", "span").alias("key")))
    grouped = classed.where("NOT single").groupBy("set_key", "span").agg(F.array_sort(F.collect_set("token")).alias("t"))  # at most COMBINED of them
    pairs = grouped.select("set_key", F.explode(F.flatten(F.transform("t", lambda a: F.transform(F.filter(F.col("t"), lambda b: b > a), lambda b: F.xxhash64(a, b, F.col("span")))))).alias("key"))
    keys = written(singles.unionByName(pairs).distinct(), "op9-keys")
    discard(verdict, classed)
    return keys


def candidate_groups(keys: DataFrame) -> DataFrame:
    """(grp, set_key): sets to be compared with each other; each two that share a key are in a group together."""
    lists = written(keys.groupBy("key").agg(F.min("set_key").alias("u"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("set_key")).alias("x"), F.sum(F.hash("set_key").cast("long")).alias("y")).where("c > 1"), "op9-lists", slim=True)
    edges = keys.join(lists.select("key", "u"), "key").where("set_key <> u").select("u", F.col("set_key").alias("v")).distinct()
    groups = written(components(edges, "op9-groups").select(F.col("node").alias("set_key"), F.col("component").alias("grp")), "op9-groups", slim=True)
    chained = groups.groupBy("grp").agg(F.count("*").alias("c")).where(F.col("c") > CHAINED).select("grp")
    if chained.isEmpty():
        return groups
    chained = groups.join(chained, "grp", "left_semi")
    once = lists.groupBy("u", "c", "x", "y").agg(F.min("key").alias("key"))  # lists of the same sets
    own = keys.join(once.select("key"), "key").join(chained.select("set_key"), "set_key").select(F.xxhash64("key", F.lit("list")).alias("grp"), "set_key")
    return written(groups.join(chained.select("grp").distinct(), "grp", "left_anti").select("grp", "set_key").unionByName(own).distinct(), "op9-lists", slim=True)


def exact_sets(docs: DataFrame, wanted: DataFrame, k_words: int) -> DataFrame:
    """wanted (set_key, doc_id of one document that has it) with the set itself, as packed 64-bit hashes."""

    def read(batches):
        for batch in batches:
            for first, data, offsets in bytehash.blocks(batch.column("text")):
                sets = bytehash.shingles(data, offsets, k_words)
                part = batch.slice(first, len(sets))
                own = [set_keys(s) if len(s) else (0, 0, 0) for s in sets]
                keep = [j for j, (a, b) in enumerate(zip(own, part.column("set_key").to_pylist(), strict=True)) if b in (a[0], a[2])]
                yield pa.RecordBatch.from_arrays([part.column("set_key").take(pa.array(keep, pa.int64())), pa.array([len(sets[j]) for j in keep], pa.int64()), pa.array([sets[j].tobytes() for j in keep], pa.binary())], names=["set_key", "n", "shingles"])

    d, w = texts(docs), wanted.select(F.col("doc_id").alias("rep"), "set_key")
    joined = d.join(w, d["doc_id"].eqNullSafe(w["rep"])).select("text", "set_key")
    found = joined.mapInArrow(tidied(read), "set_key long, n long, shingles binary")
    return found.groupBy("set_key").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def block_links(left: list, right: list | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within left (right None) or between left and right; items are (key, set)."""
    other = left if right is None else right
    forest = Forest(len(left) + (0 if right is None else len(right)))
    shift = 0 if right is None else len(left)
    flat = np.concatenate([s for _, s in other])
    owner = np.repeat(np.arange(len(other)), [len(s) for _, s in other])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    size = np.array([len(s) for _, s in other])
    out = []
    for a, (key, s) in enumerate(left):
        lo, hi = np.searchsorted(flat, s, side="left"), np.searchsorted(flat, s, side="right")
        counts = hi - lo
        total = int(counts.sum())
        if not total:
            continue
        at = np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(total)
        both = np.bincount(owner[at], minlength=len(other))
        linked = np.flatnonzero(100 * both >= percent * (len(s) + size - both))
        for b in linked.tolist():
            if (right is not None or b > a) and forest.union(a, b + shift):
                out.append((key, other[b][0]))
    return out


def blocked(members: DataFrame) -> DataFrame:
    """members (grp, set_key, n) with block: about ROWS sets of a group (fewer of large ones), ordered by size. Sizes
    get their blocks from a histogram and equal sizes are dealt by hash, so no group is ever sorted."""
    hist = members.groupBy("grp", "n").agg(F.count("*").alias("c")).withColumn("weight", F.col("c") * F.greatest(F.col("n"), F.lit(ORDINARY)))
    before = F.coalesce(F.sum("weight").over(Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    most = ROWS * ORDINARY
    hist = written(hist.select("grp", "n", F.floor(before / most).alias("first"), F.ceil(F.col("weight") / most).alias("wide")), "op9-sizes", slim=True)
    return members.join(hist, ["grp", "n"]).select("grp", "set_key", "n", (F.col("first") + F.pmod(F.xxhash64("set_key"), "wide")).alias("block"))


def links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (u, v) within groups: enough of them for the components, none that isn't one."""
    # blocks by size: within a group a block of smaller sets meets one of larger sets only if sizes allow a link
    ranked = written(blocked(groups.join(sets.select("set_key", "n"), "set_key")), "op9-blocks", slim=True)
    spans = written(ranked.groupBy("grp", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")), "op9-spans", slim=True)
    a, b = spans.alias("a"), spans.alias("b")
    meet = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.block") <= F.col("b.block")) & (F.col("a.high") * 100 >= F.col("b.low") * percent) & (F.col("b.high") * 100 >= F.col("a.low") * percent))
    meet = meet.select(F.col("a.grp").alias("grp"), F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    sides = meet.select("grp", "i", "j", F.col("i").alias("block")).unionByName(meet.where("i <> j").select("grp", "i", "j", F.col("j").alias("block")))
    dealt = ranked.join(sides, ["grp", "block"]).select("grp", "i", "j", "block", "set_key").join(sets.select("set_key", "shingles"), "set_key")

    def verify(key, table):
        block = table.column("block").to_numpy()
        items = [(k, np.frombuffer(s, "<u8")) for k, s in zip(table.column("set_key").to_pylist(), table.column("shingles").to_pylist(), strict=True)]
        i, j = key[1].as_py(), key[2].as_py()
        left = [x for x, c in zip(items, block.tolist(), strict=True) if c == i]
        right = None if i == j else [x for x, c in zip(items, block.tolist(), strict=True) if c == j]
        found = block_links(left, right, percent)
        return pa.table({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([x for _, x in found], pa.int64())})

    return dealt.groupBy("grp", "i", "j").applyInArrow(verify, "u long, v long")


def jaccard_components(docs: DataFrame, k_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id."""
    bits = min(24, hash_bits(docs, 8, 4))  # the bits of a token beside its row number; 2**24 ranges are 4 PB
    packed = written(prefixes(docs, k_words, percent, bits), "op9-prefixes")
    told = written(survivors(packed, frequencies(packed, bits), percent), "op9-documents")
    discard(packed)
    every = told_apart(told)
    copies = every.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    nodes = every.where("tokens IS NOT NULL").dropDuplicates(["set_key"])  # equal sets have equal tokens
    with collected() as made:
        groups = candidate_groups(index_keys(nodes, percent))
        wanted = copies.where("n > 0").join(groups.select("set_key").distinct(), "set_key").select("set_key", "doc_id")
        sets = written(exact_sets(docs, wanted, k_words), "op9-sets")
        joined = components(written(links(groups, sets, percent), "op9-links"), "op9-joined")
        delete(docs.sparkSession, made[:-1])
        made[:] = made[-1:]
    merged = copies.where("n > 0").join(joined, F.col("set_key") == F.col("node"), "left").select("set_key", "doc_id", F.coalesce("component", "set_key").alias("c"))
    smallest = merged.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of = merged.join(smallest, "c").select("set_key", "component_id")
    full = every.where("n > 0").join(of, "set_key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(every.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
