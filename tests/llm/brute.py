"""Plain-Python statements of the operators' results, for small inputs."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def warc(pages, min_bytes=0):
    """pages: (page_id, html) with distinct ids -> {page_id: (bytes, digest, type, refers_to)}"""
    payload = {p: (h or "").encode() for p, h in pages}
    best = {}
    for p, b in payload.items():
        best[b] = max(best.get(b, p), p)
    out = {}
    for p, b in payload.items():
        keep = len(b) < min_bytes or best[b] == p
        out[p] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if keep else "revisit",
                  None if keep else best[b])
    return out


def quality(text):
    w = words(text)
    text = text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def tokens(rows):
    """rows: (doc_id, text), distinct ids -> {doc_id: (start, n, crc)}"""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = {}, 0
    for d, text in sorted(rows, key=lambda r: r[0]):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out[d] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def bpe_encoder():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def targets(sizes, weights, budget, cap):
    """Capped water-filling, one clamp round after the other."""
    clamped = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        held = sum(cap * sizes[s] for s in clamped)
        total = sum(weights[s] for s in free)
        want = {s: (budget - held) * weights[s] / total for s in free}
        over = {s for s in free if want[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in clamped else want[s] for s in sizes}
        clamped |= over


def repeated_windows(seqs, width):
    """seqs: list of sequences -> list of sets of covered positions (windows that start at two places or more)."""
    at = defaultdict(list)
    for d, s in enumerate(seqs):
        for i in range(len(s) - width + 1):
            at[tuple(s[i:i + width]) if not isinstance(s, bytes) else s[i:i + width]].append((d, i))
    out = [set() for _ in seqs]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                out[d].update(range(i, i + width))
    return out


def shingles(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, share=85):
    """rows: (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component)}"""
    sets = {d: shingles(t) for d, t in rows}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, s in sets.items():
        common = Counter(e for x in s for e in where[x] if e < d)
        for e, n in common.items():
            if 100 * n >= share * (len(s) + len(sets[e]) - n):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}
