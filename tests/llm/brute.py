"""Plain Python versions of what the operators compute."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_counts(text):
    text = text or ""
    found = SPACE_WORD.findall(text)
    windows = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    n = len(found)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return (n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeated), failed)


def ngrams(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_groups(rows, threshold=0.8):
    """``id -> (least id of its group, number of linked classes, copies)``."""
    classes = defaultdict(list)
    for i, text in rows:
        classes[ngrams(text) or text or ""].append(i)
    keys = list(classes)
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for a, x in enumerate(keys):
        for b in range(a):
            y = keys[b]
            if isinstance(x, frozenset) and isinstance(y, frozenset):
                both = len(x & y)
                if both >= threshold * (len(x) + len(y) - both) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k, key in enumerate(keys):
        groups[root(k)] += classes[key]
    return {i: (min(groups[root(k)]), links[k], len(classes[key])) for k, key in enumerate(keys) for i in classes[key]}


def hits(text, items, window=10):
    """Hit words and items of a text."""
    w, covered, found = words(text), set(), set()
    for item, item_text in items:
        x = words(item_text)
        n = min(window, len(x))
        windows = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in windows:
                covered.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(covered), sorted(found)


def least_capacity(sizes, n):
    """Smallest capacity for which a greedy pass over the sizes needs ``n`` shards at most."""
    def fits(capacity):
        shards, filled = 1, 0
        for size in sizes:
            if filled + size > capacity:
                shards, filled = shards + 1, 0
            filled += size
        return shards <= n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low
