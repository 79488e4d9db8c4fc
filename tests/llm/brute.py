"""Plain versions of the operators, written from their definitions."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def shingles(text, length=5):
    own = words((text or "").translate(LOWER))
    return {tuple(own[k : k + length]) for k in range(max(1, len(own) - length + 1))} if own else set()


def near_groups(rows, similarity):
    """doc_id -> (number of shingles, smallest doc_id reached); all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(rows, window=20):
    """doc_id -> (words, removed, sha256 of what is kept) for rows in the order of their ids."""
    seen, out = set(), {}
    for i, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            part = tuple(own[k : k + window])
            if part in seen:
                gone[k : k + window] = [True] * window
            seen.add(part)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out[i] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def mix(rows, weights=(5, 2, 1), share=1.5, epochs=2):
    """(targets by source, taken by doc_id) for rows (doc_id, text, source)."""
    size = {i: len(words(t)) for i, t, _ in rows}
    total = {}
    for i, _, source in rows:
        total[source] = total.get(source, 0) + size[i]
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, free, target = share * sum(total.values()), set(order), {}
    while True:
        level = budget / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level > epochs * total[s]}
        if not above:
            target |= {s: weight[s] * level for s in free}
            break
        for s in above:
            target[s] = float(epochs * total[s])
            budget -= target[s]
        free -= above
    taken = {}
    for s in order:
        whole = int(target[s] // total[s]) if total[s] else 0
        need, done = target[s] - whole * total[s], 0
        own = sorted((hashlib.md5(f"mix|{'null' if i is None else i}".encode()).hexdigest(), i) for i, _, x in rows if x == s)
        for _, i in own:
            done += size[i]
            taken[i] = size[i] * (whole + (need > 0 and done - size[i] / 2 <= need))
    return {s: (total[s], target[s]) for s in order}, taken
