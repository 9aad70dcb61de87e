"""Plain versions of operators for small inputs."""

import re

import numpy as np


def sets_by_brute_force(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups_by_brute_force(rows, k, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(sets_by_brute_force(t, k))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def leaked_by_brute_force(text, items):
    """Ids of the items that agree with the text in 80 % of some 20 words (or of a shorter item)."""
    d = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = set()
    for item_id, t in items:
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(20, len(w))
        if item_id is None or not w:
            continue
        same = np.array(w)[:, None] == np.array(d or [""])[None]  # every alignment is a diagonal
        if any(np.convolve(same.diagonal(k), np.ones(n), "valid").max(initial=0) >= 0.8 * n - 1e-9 for k in range(-len(w), len(d)) if len(same.diagonal(k)) >= n):
            out.add(item_id)
    return sorted(out)
