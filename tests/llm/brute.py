"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(bytes(c + 32 if lower and 65 <= c <= 90 else c for c in raw))


def repeated_windows(rows, width):
    docs = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[j:j + width]) for _, w in docs for j in range(len(w) - width + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if seen[tuple(w[j:j + width])] > 1:
                gone[j:j + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def near_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t, lower=True)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        shared.update((a, b) for n, a in enumerate(ids) for b in ids[:n])
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def run_lines(rows):
    """doc_id, numbers of the lines that are in two or more successive non-blank lines an earlier text has (blank lines are passed over)."""
    docs = [(i, [(n, x) for n, x in enumerate((t or "").split("\n")) if x.strip(" ")]) for i, t in sorted(rows)]
    seen, out = set(), {}
    for i, w in docs:
        gone = set()
        for (m, a), (n, b) in zip(w, w[1:]):
            if (a, b) in seen:
                gone |= {m, n}
            seen.add((a, b))
        out[i] = gone
    return out
