"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from itertools import combinations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def near_duplicates(docs: list[tuple], k: int = 3, percent: int = 85) -> dict:
    """(doc_id, text) rows with different ids -> {doc_id: (n_shingles, component_id, kept)}."""
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at: dict = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    seen = set()
    for ids in at.values():
        for a, b in combinations(ids, 2):
            if (a, b) not in seen:
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    a, b = sorted((find(a), find(b)))
                    parent[b] = a
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def repeated_lines(docs: list[tuple], min_lines: int = 4, min_words: int = 50) -> set[tuple]:
    """(doc_id, text) rows with different ids -> {(doc_id, place)} of the lines in later copies."""
    seen, gone = set(), set()
    for i, t in sorted(docs):
        lines = [x for x in (y.strip(" \t\n\v\f\r") for y in (t or "").split("\n")) if x]
        for at in range(len(lines)):
            for n in range(1, min(min_lines, len(lines) - at) + 1):
                run = tuple(lines[at:at + n])
                if n == min_lines or sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in run) >= min_words:
                    if run in seen:
                        gone |= {(i, at + k) for k in range(n)}
                    seen.add(run)
    return gone


ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                    r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_secrets(text: str | None) -> tuple[int, int, int, str]:
    t = text or ""
    kinds = [[(m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6],
             [(m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20],
             [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]]
    spans = sorted((s, k, e) for k, found in enumerate(kinds) for s, e in found)
    text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
    return *map(len, kinds), hashlib.sha256(text.encode()).hexdigest()


def word_runs(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of 6 words and 4 periods or more, smallest periods only."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def periodic(doc_id, text: str | None) -> tuple:
    """The contract's row: n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = word_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{k},{q}\n" for s, k, q in runs),
                                                           " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *sha)


def trie(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) rows without equal turns -> the contract's rows, sorted."""
    own: dict = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    members: dict = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    kids: dict = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(node[-1][1].encode()) * (len(members[node]) - 1) if node else 0)
    first = {node: min(m)[0] for node, m in members.items()}
    return sorted((first[node], len(node), first[node[:-1]] if node else None, len(m), len(kids.get(node, [])), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c, end in sorted(m) if end).encode()).hexdigest())
                  for node, m in members.items())


def licence_labels(text: str, templates: dict[str, str], threshold: float) -> set[str]:
    """Labels of templates of which a stretch of twice their length holds the threshold, rivals told apart by window."""
    split = {label: t.split() for label, t in templates.items()}
    need = {label: -(-round(threshold * 100) * len(set(t)) // 100) for label, t in split.items()}
    marks = {label: set(t) | set(map(" ".join, zip(t, t[1:]))) for label, t in split.items()}
    vocabulary = {w for t in split.values() for w in t}
    step = max(2 * len(t) for t in split.values())
    w, out = WORD.findall(text.translate(LOWER)), set()
    for at in range(0, len(w), step):
        window = w[at:at + 2 * step]
        hit = {label for label, t in split.items()
               if max(len({*window[i:i + 2 * len(t)]} & {*t}) for i in range(len(window))) >= need[label]}
        seen = {x for x in window if x in vocabulary}
        seen |= {f"{a} {b}" for a, b in zip(window, window[1:]) if a in vocabulary and b in vocabulary}
        for x in hit:
            rivals = [y for y in hit - {x} if len({*split[x]} & {*split[y]}) >= min(need[x], need[y]) and marks[y] - marks[x]]
            if not any(seen & (marks[y] - marks[x]) and not seen & (marks[x] - marks[y]) for y in rivals):
                out.add(x)
    return out
