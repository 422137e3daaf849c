"""The operators' questions answered the plain way, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def repeated_bytes(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, sha(bytes(b for b, g in zip(r, gone, strict=True) if not g))))
    return out


def common_lines(texts: list[str | None], min_docs: int) -> list[tuple[int, int, str]]:
    keys = [[x.strip(" \t\n\x0b\f\r").translate(LOWER) for x in (t or "").split("\n")] for t in texts]
    found = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for t, ks in zip(texts, keys, strict=True):
        stay = [x for x, k in zip((t or "").split("\n"), ks, strict=True) if found[k] < min_docs]
        out.append((len(ks), len(ks) - len(stay), "\n".join(stay)))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def linked(n: int, pairs) -> list[int]:
    low = list(range(n))

    def top(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        low[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def near_copies(texts: list[str | None], words: int, num: int = 80, den: int = 100) -> tuple[list[int], list[int]]:
    """Set sizes, and for each text the first one that links lead to."""
    sets = [shingles(t, words) for t in texts]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    pairs = []
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in where[x] if j < i).items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                pairs.append((j, i))
    return [len(s) for s in sets], linked(len(texts), pairs)


def sentence_runs(texts: list[str | None], span: int, least: int) -> list[tuple[int, int, str]]:
    """A run has as many sentences as it needs for its words, and one more covers the end of a text."""
    seen, out = set(), []
    for parts in [re.findall(r"[^.!?\n]+[.!?\n]*|[.!?\n]+", t or "") for t in texts]:
        keys = [p.strip(" \t\n\x0b\f\r").translate(LOWER) for p in parts]
        words = np.cumsum([0, *(len(WORD.findall(k)) for k in keys)])
        enough = lambda a, b: b - a >= span and words[b] - words[a] >= least  # noqa: E731, B023
        found = {(i, next((j for j in range(i + span, len(keys) + 1) if enough(i, j)), None)) for i in range(len(keys))}
        found |= {(i, len(keys)) for i in [max((i for i in range(len(keys)) if enough(i, len(keys))), default=None)] if i is not None}
        gone = set()
        for i, j in sorted(x for x in found if x[1] is not None):
            run = tuple(keys[i:j])
            gone |= set(range(i, j)) if run in seen else set()
            seen.add(run)
        out.append((len(parts), len(gone), "".join(p for i, p in enumerate(parts) if i not in gone)))
    return out


def close_vectors(vectors: list, cosine: float) -> tuple[list[int], list[int]]:
    n = len(vectors)
    sound = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for v in vectors]
    pairs = []
    for i in range(n):
        for j in range(i):
            if sound[i] and sound[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    pairs.append((j, i))
    links = Counter(x for p in pairs for x in p)
    return [links[i] for i in range(n)], linked(n, pairs)
