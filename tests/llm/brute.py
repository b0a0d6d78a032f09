"""Plain forms of the operators, for small inputs."""

import hashlib


def covered(units, window, first, own):
    mask = [False] * len(units)
    for p in range(len(units) - window + 1):
        if first[tuple(units[p : p + window])] < own:
            mask[p : p + window] = [True] * window
    return mask


def repeats(documents, window, split):
    """(units, kept, covered mask) of each row of (id, text)."""
    first = {}
    parts = [(i, split(t or "")) for i, t in documents]
    for i, units in parts:
        for p in range(len(units) - window + 1):
            key = tuple(units[p : p + window])
            first[key] = min(first.get(key, i), i)
    return [(i, u, covered(u, window, first, i)) for i, u in parts]


def repeated_words(documents, window):
    out = []
    for i, words, mask in repeats(documents, window, lambda t: t.encode().split()):
        kept = b" ".join(w for w, gone in zip(words, mask) if not gone)
        out.append((i, len(words), sum(mask), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeated_bytes(documents, length):
    out = []
    for i, units, mask in repeats(documents, length, lambda t: t.encode()):
        kept = bytes(b for b, gone in zip(units, mask) if not gone)
        spans = sum(1 for a, b in zip([False, *mask], mask) if b and not a)
        out.append((i, len(units), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def alignment(a, b, match=2, mismatch=-1, gap=-1):
    best = 0
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = table[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch)
            table[i][j] = max(0, step, table[i - 1][j] + gap, table[i][j - 1] + gap)
            best = max(best, table[i][j])
    return best


def components(points, most):
    """The least member of each point's component, for integers within ``most`` bits."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in points:
        for q in points:
            if (p ^ q).bit_count() <= most:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    return {p: find(p) for p in points}
