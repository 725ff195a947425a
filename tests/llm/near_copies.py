"""Near copies found by comparing every pair of sets."""

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = [x.decode() for x in (text or "").translate(LOWER).encode().split()]
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def groups(nodes, links):
    lead = {n: n for n in nodes}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        lead[b] = a
    return {n: find(n) for n in nodes}


def brute(rows, percent=75):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    links = [
        (i, j) for k, (i, s) in enumerate(sets) for j, r in sets[:k]
        if s and r and 100 * len(s & r) >= percent * len(s | r)
    ]
    return groups({i for i, _ in sets}, links)
