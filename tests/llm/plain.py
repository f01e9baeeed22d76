"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def suffix_dedup(docs, length=100):
    """docs: {id: text}; gives {id: (n_bytes, n_removed, n_spans, sha256 of what is kept)}."""
    seen, out = set(), {}
    for i in sorted(docs):
        b = (docs[i] or "").encode()
        spans = []
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w not in seen:
                seen.add(w)
            elif spans and p <= spans[-1][1]:
                spans[-1][1] = p + length
            else:
                spans.append([p, p + length])
        kept, at = b"", 0
        for x, y in spans:
            kept, at = kept + b[at:x], y
        kept += b[at:]
        out[i] = (len(b), len(b) - len(kept), len(spans), sha(kept))
    return out


def line_dedup(docs, min_docs=10):
    """docs: [(id, text)]; gives a list of (n_lines, n_dropped, kept text) in order."""
    split = [(t or "").split("\n") for _, t in docs]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = collections.Counter(k for lines in split for k in {key(x) for x in lines})
    out = []
    for lines in split:
        kept = [x for x in lines if not key(x) or held[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[k:] for k in range(size))))


def components(docs):
    """docs: {id: text}; gives {id: (n_shingles, component)} by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def quality_base(text):
    w = WORD.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    often = collections.Counter(windows)
    covered = {k + j for k, g in enumerate(windows) if often[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed
