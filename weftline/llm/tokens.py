"""Byte-level BPE ids from a public tokenizer file, with a bounded cache of the pieces of texts.

The usual pattern of a byte-level BPE cuts a text where a space stands before anything but a blank, and looks no further
than the next character. So the ids of a text are those of its runs, each with the space before it, one after the other.
Runs of plain letters, digits, marks and single line feeds are cut further, between the kinds, as the pattern does. The
pieces of many texts are found in their bytes at once, and numbered by Arrow's dictionary, which begins with the pieces
known so far. New plain ones are merged at once in numpy, the pair of the lowest rank first, as the library does one by
one. Other new ones are encoded by the library, those that begin with a space joined in few calls, and cut where a token
begins with a space. Texts with special tokens spelled out are a piece of their own; with tokenizers of other kinds all
texts go to the library whole.

Cases: a null text is empty and has no ids; a piece of any length is encoded, only short ones are kept; bytes that aren't
UTF-8 are an error.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that some definition calls a blank, other than the six ASCII ones.
ODD_BLANKS = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
#: Bytes of a piece that is kept, pieces that are kept, pieces encoded in a call, bytes of texts whose pieces are numbered at once.
LONGEST_KEPT, MOST, JOINED, CHUNK = 48, 300_000, 2000, 8 << 20
#: Kinds of the characters below U+0250: letters in every version of Unicode that has them, digits, ASCII marks without the
#: apostrophe, line feed, space; 0 is any other, and all from U+0250 on. The usual pattern cuts between kinds, but after a
#: space. Of UTF-8 bytes, those of the letters beyond ASCII (0xC3 0x80 to 0xC9 0x8F) are letters, but for U+D7, U+F7 (see below).
LETTER, DIGIT, MARK, FEED, SPACE = range(1, 6)
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
KINDS[48:58] = DIGIT
KINDS[[x for x in range(33, 127) if not KINDS[x] and x != 39]] = MARK
KINDS[[10, 32]] = FEED, SPACE
#: ASCII bytes that some definition calls a blank; first bytes of the other blanks.
BLANK, ODD_FIRST = np.zeros(256, bool), np.zeros(256, bool)
BLANK[[*range(9, 14), 32, *range(0x1C, 0x20)]] = True
ODD_FIRST[[chr(x).encode()[0] for x in ODD_BLANKS if x > 127]] = True
#: Bytes of pieces, by which they are grouped; longer ones aren't merged here. Pieces merged at once.
WIDTHS, TOGETHER = (3, 5, 7, 10, 14, 20, 32, 48), 4096
#: No symbol: beyond a piece's ends, and what became part of the symbol before it. The rank of a pair that doesn't merge.
OUTSIDE, GONE, NEVER = 65534, 65533, 2**31 - 1


def looked_up(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The table's entry of each byte; by far faster than table[raw]."""
    return np.frombuffer(raw.tobytes().translate(table.tobytes()), table.dtype)


def cuts(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of texts begin, which of them aren't plain. raw: the texts' bytes, ends: where each begins and ends."""
    kind = looked_up(raw, KINDS)
    after = np.append(raw[1:], np.uint8(32))
    after[ends[1:][ends[1:] > 0] - 1] = 32
    space, blank = kind == SPACE, looked_up(after, BLANK)
    other = kind == 0
    # U+D7 and U+F7, and letters from U+250 on, by their first bytes
    other |= (raw == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (raw == 0xC9) & (after > 0x8F)
    # a line feed is a piece of its own between other characters only
    feed = np.flatnonzero(kind == FEED)
    other[feed[blank[feed] | BLANK[raw[feed - 1]]]] = True
    other |= space & blank
    begins = space & ~blank
    odd = np.flatnonzero(begins & looked_up(after, ODD_FIRST))
    if len(odd):
        a, b, c = (raw.take(odd + k, mode="clip").astype(np.int32) for k in (1, 2, 3))
        odd = odd[np.isin(np.where(a < 0xE0, (a & 31) << 6 | b & 63, (a & 15) << 12 | (b & 63) << 6 | c & 63), ODD_BLANKS)]
        other[odd], begins[odd] = True, False
    begins[ends[:-1][ends[:-1] < len(raw)]] = True
    inner = kind[1:] != kind[:-1]
    aside = space | other
    inner &= ~(aside[1:] | aside[:-1])
    inner = np.flatnonzero(inner) + 1
    run = np.flatnonzero(begins)
    bad = np.bitwise_or.reduceat(other, run)
    begins[inner[~bad[np.searchsorted(run, inner, side="right") - 1]]] = True
    start = np.flatnonzero(begins)
    return start, np.searchsorted(start, run[bad])


def pieces_of(raw: np.ndarray, start: np.ndarray) -> pa.Array:
    """The pieces that begin there, as an Arrow array of the same bytes."""
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.append(start, len(raw)).astype(np.int32)), pa.py_buffer(raw)])


def bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary array without nulls, and where each value begins and ends in them."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, raw = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]]
    return raw, ends - ends[0]


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """at, at + 1, ..., at + n - 1 of each, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(at - ends + n, n) + np.arange(ends[-1] if len(ends) else 0, dtype=at.dtype)


class Merger:
    """Byte-pair merges of many short runs at once: in each the pair of the lowest rank, the leftmost of equal ones."""

    def __init__(self, vocab: dict[str, int], merges: list):
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char = dict(zip(own, map(chr, own), strict=True)) | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(own)))}
        self.byte = np.array([vocab[char[b]] for b in range(256)], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        self.into = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        _, last = np.unique(key[::-1], return_index=True)
        left = np.sort(len(key) - 1 - last)  # of equal pairs the last counts
        #: Tables (shift, factor, key << 32 | rank) of the pairs, each of what found its place taken in those before.
        self.tables: list[tuple[np.uint32, np.uint32, np.ndarray]] = []
        bits = max(4, int(4 * len(key)).bit_length())
        while len(left):
            shift, factor = np.uint32(32 - bits), np.uint32(0x9E3779B1 + 2 * 0x2C1B3C6D * len(self.tables) & 0xFFFFFFFF)
            at = (key[left] * factor) >> shift
            _, kept = np.unique(at, return_index=True)
            table = np.full(1 << bits, 2**64 - 1, np.uint64)
            table[at[kept]] = key[left[kept]].astype(np.uint64) << np.uint64(32) | left[kept].astype(np.uint64)
            self.tables.append((shift, factor, table))
            left, bits = np.delete(left, kept), max(4, bits - 2)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << np.uint32(16) | b
        shift, factor, table = self.tables[0]
        found = table.take((key * factor) >> shift)
        out = np.where((found >> np.uint64(32)).astype(np.uint32) == key, found.astype(np.uint32).view(np.int32), NEVER)
        for shift, factor, table in self.tables[1:]:
            found = table.take((key * factor) >> shift)
            hit = np.flatnonzero((found >> np.uint64(32)).astype(np.uint32) == key)
            out[hit] = found[hit].astype(np.uint32).view(np.int32)
        return out

    def merge(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in the columns of `raw`, one piece after the other, and how many each has."""
        width, n = raw.shape
        sym = np.full((width + 2, n), OUTSIDE, np.uint32)
        sym[1:-1] = np.where(np.arange(width)[:, None] < size, self.byte[raw], np.uint32(OUTSIDE))
        # rank and row in one number: the least is the leftmost of the lowest rank
        order = np.full((width + 2, n), NEVER, np.int32)
        for r in range(1, width):
            rank = self.ranks(sym[r], sym[r + 1])
            order[r] = np.where(rank < NEVER, rank << 6 | r, NEVER)
        rows = np.arange(width + 2, dtype=np.int32)[:, None]
        after, before = np.repeat(rows + 1, n, axis=1), np.repeat(rows - 1, n, axis=1)
        flat, ranked, nxt, prv = (x.reshape(-1) for x in (sym, order, after, before))
        best, live = order.min(axis=0), np.arange(n)
        while True:
            some = np.flatnonzero(best < NEVER)
            if not len(some):
                break
            live, best = live.take(some), best.take(some)
            row, new = best & 63, self.into.take(best >> 6)
            here = row * n + live
            gone = nxt.take(here) * n + live
            right = nxt.take(gone)
            there = right * n + live
            flat[here], flat[gone], ranked[gone], nxt[here], prv[there] = new, GONE, NEVER, right, row
            left = prv.take(here)
            back = left * n + live
            rank = self.ranks(np.concatenate([new, flat.take(back)]), np.concatenate([flat.take(there), new]))
            rank = np.where(rank < NEVER, rank << 6 | np.concatenate([row, left]), NEVER)
            ranked[here], ranked[back] = rank[: len(live)], rank[len(live) :]
            best = order.min(axis=0) if len(live) == n else order.take(live, axis=1).min(axis=0)
        kept = sym.T < GONE
        return sym.T[kept].astype(np.uint16), np.count_nonzero(kept, axis=1)

    def merged(self, values: pa.Array, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the values numbered `of` that are short, their numbers of ids and all their ids, in the same order."""
        raw, ends = bytes_of(values)
        size = np.diff(ends)
        group = np.searchsorted(WIDTHS, size[of])
        who, count, ids = [of[:0]], [of[:0]], [np.zeros(0, np.uint16)]
        for g, width in enumerate(WIDTHS):
            mine = of[group == g]
            for a in range(0, len(mine), TOGETHER):
                part = mine[a : a + TOGETHER]
                got, n = self.merge(raw.take(ends[part] + np.arange(width)[:, None], mode="clip"), size[part])
                who.append(part)
                count.append(n)
                ids.append(got)
        return np.concatenate(who), np.concatenate(count), np.concatenate(ids)

    def encode(self, runs: list[str], into: dict[str, bytes | None]) -> list[str]:
        """Ids (little-endian uint16) of a space and each run that is plain and short; the other runs are returned."""
        raw, ends = bytes_of(pa.array([" " + r for r in runs], pa.string()))
        start, others = cuts(raw, ends)
        plain = np.ones(len(start), bool)
        plain[others] = False
        who, count, ids = self.merged(pieces_of(raw, start), np.flatnonzero(plain))
        at, n = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        at[who], n[who] = np.cumsum(count) - count, count
        left, first = [], np.searchsorted(start, ends).tolist()
        for run, a, b in zip(runs, first[:-1], first[1:], strict=True):
            if n[a:b].all():
                into[run] = ids[spread(at[a:b], n[a:b])].astype("<u2").tobytes()
            else:
                left.append(run)
        return left


class Encoder:
    """ids(text) -> uint32 array, the same as the library's encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        split = told.get("pre_tokenizer") or {}
        self.by_run = (
            told.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space", True)
            and split.get("use_regex", True)
            and told["model"].get("type", "BPE") == "BPE"
            and self.tokenizer.get_vocab_size() < 65536
        )
        model = told["model"]
        #: Of a plain model whose usual ids stay clear of those that mark the absence of one.
        self.merger = None
        if self.by_run and max(model["vocab"].values()) < GONE and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")):
            self.merger = Merger(model["vocab"], model["merges"])
        self.special = [x["content"] for x in told.get("added_tokens", [])]
        #: The known pieces, how often each was seen, its place and number in `pool`, the ids of all.
        self.known = pa.array([], pa.binary())
        self.seen, self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)
        #: Ids whose token begins with a space.
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[k for t, k in self.tokenizer.get_vocab().items() if t[:1] == "\u0120"]] = True

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _joined(self, runs: list[str]) -> list[np.ndarray]:
        """Ids of runs that begin with a space; where one doesn't begin with a token of its own, each is encoded alone."""
        out: list[np.ndarray] = []
        found = self.tokenizer.encode_batch_fast(["".join(runs[a : a + JOINED]) for a in range(0, len(runs), JOINED)], add_special_tokens=False)
        for a, got in zip(range(0, len(runs), JOINED), found, strict=True):
            part = runs[a : a + JOINED]
            ids = np.array(got.ids, np.uint16)
            at = np.flatnonzero(self.spaced[ids]).tolist()
            if len(at) == len(part):
                out += map(ids.__getitem__, map(slice, at, [*at[1:], len(ids)]))
            else:
                out += (np.array(self.whole(r), np.uint16) for r in part)
        return out

    def _learn(self, values: pa.Array, plain: np.ndarray) -> None:
        """Put the ids of values into the pool; the first of them are known. plain: which can be merged here."""
        old = len(self.known)
        new = np.arange(old, len(values))
        self.seen, self.at, self.n = (np.concatenate([x[:old], np.zeros(len(new), np.int64)]) for x in (self.seen, self.at, self.n))
        who, count, ids = self.merger.merged(values, new[plain[new]]) if self.merger else (new[:0], new[:0], self.pool[:0])
        self.at[who], self.n[who] = len(self.pool) + np.cumsum(count) - count, count
        rest = new[self.n[new] == 0]
        texts = values.take(pa.array(rest)).cast(pa.string()).to_pylist()
        # with several spaces, or a blank after the space (none is printable), a piece has to stand alone
        joins = np.array([t[0] == " " and len(t) > 1 and t[1].isprintable() and t.count(" ") == 1 for t in texts], bool)
        found = self._joined([*map(texts.__getitem__, np.flatnonzero(joins).tolist())])
        alone = [*map(texts.__getitem__, np.flatnonzero(~joins).tolist())]
        found += (np.array(x.ids, np.uint16) for x in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False))
        rest = np.concatenate([rest[joins], rest[~joins]])
        count = np.array([*map(len, found)], np.int64)
        self.at[rest], self.n[rest] = len(self.pool) + len(ids) + np.cumsum(count) - count, count
        self.pool = np.concatenate([self.pool, ids, *found])

    def _forget(self, values: pa.Array) -> None:
        """Keep the short pieces, and of too many those seen most often; what was seen counts half from then on."""
        few = np.diff(bytes_of(values)[1]) <= LONGEST_KEPT
        if np.count_nonzero(few) > MOST:
            self.seen[~few] = 0
            few[np.argpartition(self.seen, len(few) - MOST // 2)[: len(few) - MOST // 2]] = False
            self.seen //= 2
        if not few.all():
            kept = np.flatnonzero(few)
            values = values.take(pa.array(kept))
            self.pool = self.pool[spread(self.at[kept], self.n[kept])]
            self.seen, self.n = self.seen[kept], self.n[kept]
            self.at = np.cumsum(self.n) - self.n
        self.known = values

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin and end; a null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        if not self.by_run:
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([k for x in found for k in x], np.uint32), np.cumsum([0, *map(len, found)])
        texts.validate(full=True)
        raw, ends = bytes_of(texts)
        if not len(raw):
            return np.zeros(0, np.uint16), np.zeros(len(texts) + 1, np.int64)
        start, others = cuts(raw, ends)
        for s in self.special:
            told = np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False))
            if len(told):
                # no cut within such a text
                of = np.searchsorted(ends, start, side="right") - 1
                plain = np.isin(start, start[others], invert=True)
                kept = ~np.isin(of, told) | (start == ends[of])
                plain &= ~np.isin(of, told)
                start, others = start[kept], np.flatnonzero(~plain[kept])
        got = pa.concat_arrays([self.known, pieces_of(raw, start)]).dictionary_encode()
        code = got.indices.to_numpy()[len(self.known) :]
        plain = np.ones(len(got.dictionary), bool)
        plain[code[others]] = False
        self._learn(got.dictionary, plain)
        self.seen += np.bincount(code, minlength=len(self.n))
        n = self.n[code]
        ids = self.pool[spread(self.at[code], n)]
        done = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(start, ends)]
        self._forget(got.dictionary)
        return ids, done

    def ids_batch(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """ids() of many texts; a null is empty."""
        ids, ends = self.flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        ids, ends = ids.astype(np.uint32), ends.tolist()
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def ids(self, text: str | None) -> np.ndarray:
        return self.ids_batch([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
