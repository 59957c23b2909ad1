"""Plain brute-force versions, over lists of (doc_id, text)."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _first(units):
    first = {}
    for i, windows in units.items():
        for w in windows:
            first[w] = min(first.get(w, i), i)
    return first


def _gone(windows, first, i, width, n):
    gone = [False] * n
    for k, w in enumerate(windows):
        if first[w] < i:
            gone[k:k + width] = [True] * width
    return gone


def words_removed(rows):
    words = {i: WORD.findall(t or "") for i, t in rows}
    units = {i: [tuple(w[k:k + 13]) for k in range(len(w) - 12)] for i, w in words.items()}
    first, out = _first(units), {}
    for i, w in words.items():
        gone = _gone(units[i], first, i, 13, len(w))
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def bytes_removed(rows):
    raw = {i: (t or "").encode() for i, t in rows}
    units = {i: [b[k:k + 50] for k in range(len(b) - 49)] for i, b in raw.items()}
    first, out = _first(units), {}
    for i, b in raw.items():
        gone = _gone(units[i], first, i, 50, len(b))
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def _by_row(rows, units, width, kept):
    """The same where rows share ids: a row loses what a row with a smaller id has."""
    found = [units(t) for _, t in rows]
    windows = [[tuple(u[k:k + width]) for k in range(len(u) - width + 1)] for u in found]
    first, out = {}, []
    for (i, _), ws in zip(rows, windows):
        for w in ws:
            first[w] = min(first.get(w, i), i)
    for (i, _), u, ws in zip(rows, found, windows):
        out.append((i, *kept(u, _gone(ws, first, i, width, len(u)))))
    return out


def words_removed_by_row(rows):
    def kept(words, gone):
        text = " ".join(x for x, g in zip(words, gone) if not g)
        return len(words), sum(gone), hashlib.sha256(text.encode()).hexdigest()
    return _by_row(rows, lambda t: WORD.findall(t or ""), 13, kept)


def bytes_removed_by_row(rows):
    def kept(raw, gone):
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        return len(raw), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(raw, gone) if not g)).hexdigest()
    return _by_row(rows, lambda t: list((t or "").encode()), 50, kept)


def jaccard_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}
