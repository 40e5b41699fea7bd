"""Plain versions of the operators' contracts, for small inputs."""
import hashlib
import math
import re

import xxhash


def repeats(docs, length=100):
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda r: r[0]):
        b = (t or "").encode()
        dead = bytearray(len(b))
        for a in range(len(b) - length + 1):
            k = b[a:a + length]
            if k in seen:
                dead[a:a + length] = b"\x01" * length
            seen.add(k)
        kept = bytes(x for x, d in zip(b, dead) if not d)
        n = sum(1 for j in range(len(b)) if dead[j] and (j == 0 or not dead[j - 1]))
        out.append((i, len(b), sum(dead), n, hashlib.sha256(kept).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c)
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(_digits(s)) <= 19 and luhn(_digits(s))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(_digits(s)) <= 15)]


def personal(docs):
    out = []
    for i, t in docs:
        spans, counts = [], []
        for k, (name, pattern, ok) in enumerate(KINDS):
            found = [m for m in re.finditer(pattern, t or "") if ok(m.group())]
            counts.append(len(found))
            spans += [(m.start(), k, m.end(), name) for m in found]
        told = ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))
        out.append((i, *counts, hashlib.sha256(told.encode()).hexdigest()))
    return out


def fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(docs, most=4):
    fps = {i: fingerprint(t) for i, t in docs}
    up = {i: i for i in fps}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(fps)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted((i, f"{fps[i]:016x}", root(i)) for i in ids)


def top(rows, k=5, every=50):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(kept):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(kept) if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(str(item))
    sizes = sorted({len(k) for k in windows})
    out = []
    for i, t in docs:
        w, hit, held = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[a:a + n]))):
                    hit.update(range(a, a + n))
                    held |= got
        told = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(held), told, bool(hit)))
    return sorted(out)
