"""Brute-force versions that several tests share."""

import collections


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def reach(nodes, links):
    """Least reachable node by brute force."""
    least = {n: n for n in nodes}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def brute_near(rows):
    sets = collections.defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingle_set(t))
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    least = reach(ids, links)
    return sorted(((i, len(shingle_set(t)), None if i is None else least[i], i is None or i == least[i]) for i, t in rows), key=repr)
