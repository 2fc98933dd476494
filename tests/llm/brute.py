"""Plain restatements of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(repeated), n < 10 or 100 * len(repeated) > 20 * n)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
                    .replace("password", "[pP][aA][sS][sS][wW][oO][rR][dD]").replace("passwd", "[pP][aA][sS][sS][wW][dD]")
                    .replace("secret", "[sS][eE][cC][rR][eE][tT]").replace("token", "[tT][oO][kK][eE][nN]")
                    .replace("api_?key", "[aA][pP][iI]_?[kK][eE][yY]"))


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ("assign", "access", "hex")
    said = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], hashlib.sha256(said.encode()).hexdigest()


def shingles(text):
    w = tuple((text or "").encode().lower().split())
    return {w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set())


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near(docs):
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter((a, b) for v in holders.values() if len(v) < 3000 for i, a in enumerate(v) for b in v[i + 1:])
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    top = smallest_reachable(sets, links)
    return {d: (len(s), top[d]) for d, s in sets.items()}


def repeats(docs, k=400):
    """doc -> n_bytes, n_removed, n_spans, kept_sha256."""
    data = {d: (t or "").encode() for d, t in docs}
    seen = Counter(b[i:i + k] for b in data.values() for i in range(len(b) - k + 1))
    out = {}
    for d, b in data.items():
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - k + 1):
            if seen[b[i:i + k]] > 1:
                gone[i + 1:i + k + 1] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        out[d] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


def common_lines(docs, aligned, blocks, least=5):
    """doc -> text left, lines deleted: every document is aligned with every earlier one."""
    out, earlier = {}, []
    for d, text in sorted(docs):
        own = text.split("\n")
        n = [len(words(x)) for x in own]
        gone = {j for other in earlier for s, e in blocks(aligned(other, own), n, least) for j in range(s, e)}
        out[d] = ("\n".join(x for j, x in enumerate(own) if j not in gone), len(gone))
        earlier.append(own)
    return out


def vectors(rows, least=0.95):
    good = {}
    for i, v in rows:
        if v is None or any(x is None for x in v):
            continue
        x = np.array(v, dtype=np.float64)
        with np.errstate(all="ignore"):
            n = np.sqrt((x * x).sum())
        if np.isfinite(n) and n > 0:
            good[i] = x / n
    ids = list(good)
    linked, count = [], Counter()
    by_length = defaultdict(list)
    for i in ids:
        by_length[len(good[i])].append(i)
    for group in by_length.values():
        m = np.array([good[i] for i in group])
        a, b = np.nonzero(np.triu(m @ m.T >= least, 1))
        linked += [(group[i], group[j]) for i, j in zip(a, b)]
    for a, b in linked:
        count[a] += 1
        count[b] += 1
    top = smallest_reachable([i for i, _ in rows], linked)
    return {i: (count[i], top[i]) for i, _ in rows}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
