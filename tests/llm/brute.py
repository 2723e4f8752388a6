"""Plain Python versions of the operators' fixed rules."""

import re
from collections import defaultdict
from hashlib import sha256

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(numbers):
    odd, even = numbers[-1::-2], numbers[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def pii(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def digest(spans):
    return sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def space_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(text):
    w = space_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(texts):
    """Smallest id reachable over pairs with a Jaccard similarity of at least 0.85, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 85 * (len(a) + len(b) - n):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def contamination(texts, items, size=13):
    windows = defaultdict(set)
    for item, text in items.items():
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    lengths = {len(k) for k in windows}
    out = {}
    for doc, text in texts.items():
        w, hit, there = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    there |= found
        out[doc] = (len(w), len(hit), there)
    return out
