"""Plain reference versions of the operators, for small inputs."""

from __future__ import annotations


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None) -> set[tuple]:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def groups(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, least id reachable), by comparing candidate pairs through an index."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    index: dict[tuple, list[int]] = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    for i, s in sets.items():
        met: dict[int, int] = {}
        for x in s:
            for j in index[x]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, both in met.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeated_words(rows: list[tuple[int, str | None]], n: int) -> dict[int, list[bool]]:
    """doc_id -> per word, whether a run of ``n`` words around it occurs earlier; ids are distinct and in order.

    Where a text repeats itself at once, the words of the earliest run do not count."""
    first: dict[tuple, tuple[int, int]] = {}
    out = {}
    for i, text in rows:
        w = words(text)
        out[i] = [False] * len(w)
        for k in range(len(w) - n + 1):
            j, at = first.setdefault(tuple(w[k:k + n]), (i, k))
            if (j, at) != (i, k):
                begin = max(k, at + n) if j == i else k
                out[i][begin:k + n] = [True] * (k + n - begin)
    return out
