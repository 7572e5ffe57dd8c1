"""Plain Python versions of the operators' contracts, over lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def shingle_set(text, size=5):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def near_dup(rows, per_cent):
    """rows (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component)}"""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for a, b in combinations(sorted(ids), 2):
            shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= per_cent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def token_ids(texts, name, end):
    t = tokenizer(name)
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def repeats(rows, window=13):
    """rows (doc_id, text) -> [(doc_id, n_words, n_removed, kept sha256)] in row order"""
    first = {}
    cut = [(i, WORD.findall(t or "")) for i, t in rows]
    rank = lambda i: -1 if i is None else i
    for i, w in cut:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, rank(i)), rank(i))
    out = []
    for i, w in cut:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < rank(i):
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return out


def alnum_shingles(text, size):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def leaks(docs, items, threshold=0.8, size=5):
    """{(doc_id, item_id)} by shingle containment; short items are one shingle."""
    out = set()
    for item_id, text in items:
        n = len(re.findall(r"[^\W_]+", (text or "").lower()))
        if not n or item_id is None:
            continue
        width = min(n, size)
        of = alnum_shingles(text, width)
        for doc_id, body in docs:
            if doc_id is not None and len(of & alnum_shingles(body, width)) >= threshold * len(of):
                out.add((doc_id, item_id))
    return out
