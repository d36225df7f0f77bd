"""Plain versions of the operators, for small inputs."""

import re


def simhash_fingerprint(text, shingle=3):
    import xxhash

    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    """Smallest id reachable for each id, given a function of index pairs."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if root(i) != root(j) and linked(i, j):
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, d in enumerate(ids)}
