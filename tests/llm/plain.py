"""Brute-force versions of the training-data operators, in plain Python over lists of rows."""

import collections
import hashlib
import re
import zlib

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def crc_mod(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def repeats(rows, length=200):
    """(doc_id, text) -> (doc_id, kept bytes, removed spans) by a table of all strings of that length."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, bytes(x for x, g in zip(b, gone) if not g), spans))
    return out


def repeat_rows(rows, length=200):
    size = [len((t or "").encode()) for _, t in rows]
    return sorted(((d, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()) for (d, kept, spans), n in zip(repeats(rows, length), size)), key=repr)


def shingle_set(text, k):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near(rows, k=4, percent=85):
    """(doc_id, text) -> (doc_id, set size, smallest doc_id that links reach)."""
    sets = [shingle_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    members = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def grams(text):
    """Counts of one- to three-character n-grams of the text's letters, blanks only at their ends."""
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    line = " " + " ".join(low.split()) + " " if low.split() else " "
    out = collections.Counter(c for c in line if c != " ")
    out.update(line[i : i + 2] for i in range(len(line) - 1))
    out.update(line[i : i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    return out


def ranked(counts, top):
    key = lambda g: [1 if c == " " else ord(c) for c in g]
    return sorted(counts, key=lambda g: (-counts[g], len(g), key(g)))[:top]


def profiles(rows, top=300):
    """(text, lang) -> language -> ranked n-grams."""
    by = collections.defaultdict(list)
    for text, lang in rows:
        if lang is not None and text is not None:
            by[lang].append(text)
    return {lang: ranked(sum((grams(t) for t in ts), collections.Counter()), top) for lang, ts in by.items()}


def language(text, known, top=300):
    if text is None or not known or not any(map(str.isalpha, text)):
        return "und", 0.0
    own = ranked(grams(text), top)
    far = {}
    for lang, profile in known.items():
        place = {g: k for k, g in enumerate(profile)}
        far[lang] = sum(abs(place[g] - k) if g in place else top for k, g in enumerate(own))
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (top * len(own))
