"""Plain Python versions of what the queries return, straight from their definitions."""

import hashlib
import re
from collections import Counter, defaultdict

CONTAMINATION_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PLAIN_WORD = re.compile("[^\x20\x09-\x0d]+")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def contamination(docs, items, window=13):
    """docs: (doc_id, text); items: (item_id, text)."""
    found = defaultdict(set)
    for item, text in items:
        words = CONTAMINATION_WORD.findall(ascii_lower(text))
        if words:
            n = min(window, len(words))
            for i in range(len(words) - n + 1):
                found[tuple(words[i : i + n])].add("" if item is None else str(item))
    sizes = sorted({len(w) for w in found})
    out = []
    for doc_id, text in docs:
        words = CONTAMINATION_WORD.findall(ascii_lower(text))
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in found:
                    hit.update(range(i, i + n))
                    ids |= found[w]
        out.append((doc_id, len(words), len(hit), len(ids), sha(",".join(sorted(ids))), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def shingle_set(text, k=5):
    words = PLAIN_WORD.findall(ascii_lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def near_components(docs, per_cent=85):
    """docs: (doc_id, text) with distinct non-null ids -> (doc_id, n_shingles, component_id, kept)."""
    sets = [shingle_set(t) for _, t in docs]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= per_cent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def mixing_targets(size_of, share=1.5, most=2.0):
    """Water-filling by small steps of the definition: cap what is above, share the rest anew."""
    order = sorted((s for s in size_of if s is not None)) + [None] * (None in size_of)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = share * sum(size_of.values()), {}
    while True:
        left = total - sum(capped.values())
        rest = [s for s in order if s not in capped]
        if not rest:
            return capped
        whole = sum(weight[s] for s in rest)
        given = {s: left * weight[s] / whole for s in rest}
        over = [s for s in rest if given[s] > most * size_of[s]]
        if not over:
            return capped | given
        capped |= {s: most * size_of[s] for s in over}


def repeated_bytes(docs, size=400):
    """docs: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + size] for _, b in raw for i in range(len(b) - size + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out
