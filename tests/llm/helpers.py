"""Plain versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def linked_components(rows, percent=80):
    """{position: component} by comparing all pairs of distinct sets; rows are (doc_id, text)."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = {}
    for i, s in enumerate(sets):
        if s:
            parent[find(i)] = find(first.setdefault(s, i))
    distinct = sorted(first.items(), key=lambda x: len(x[0]))
    for a, (s, i) in enumerate(distinct):
        for t, j in distinct[a + 1:]:
            if 100 * len(s) < percent * len(t):
                break
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
