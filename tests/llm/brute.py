"""Plain versions of the operators, for small tables: one loop per rule, no Spark."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(value) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


# ------------------------------------------------------------------------------ warc (1)

def warc(pages):
    """pages: (page_id, html) -> {page_id: (bytes, digest, type, refers_to)}."""
    body = {p: (h or "").encode() for p, h in pages}
    first = {}
    for p, b in body.items():
        first[b] = min(p, first.get(b, p))
    out = {}
    for p, b in body.items():
        again = len(b) >= 100 and first[b] != p
        out[p] = (len(b), sha(b), "revisit" if again else "response", first[b] if again else None)
    return out


# ---------------------------------------------------------------------------- mixing (2)

def targets(docs, weights=(3, 1, 2), share=1.5, cap=2):
    """docs: (doc_id, source, text) -> {source: (size, target)}; excess handed on in rounds."""
    size = defaultdict(int)
    for _, source, text in docs:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, rest = {}, share * sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        given = {s: rest * weight[s] / total for s in free}
        over = [s for s in free if given[s] > cap * size[s]]
        if not over:
            return {s: (size[s], full.get(s, given.get(s))) for s in order}
        for s in over:
            full[s] = cap * size[s]
            rest -= full[s]


# ------------------------------------------------------------------------------- pii (3)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ------------------------------------------------------------------------------ urls (5)

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


def url_rule(url):
    """(host, path, rule, verdict by rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    stop = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    path = path[:stop]
    best = (None, None)
    for verdict, rule in RULES:
        at, _, start = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + start):
            if best[0] is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *best


# --------------------------------------------------------------------------- quality (6)

def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    ws = words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(ws) - 4):
        at[tuple(ws[i:i + 5])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places
               for j in range(i, i + 5)}
    n = len(ws)
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), again, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


# -------------------------------------------------------------------------- passages (7)

def passages(docs, size=13):
    """docs: list of (doc_id, text) -> list of (doc_id, n_words, n_removed, kept)."""
    def rank(doc_id):
        return (doc_id is None, doc_id or 0)
    first = {}
    split = [(d, words(t)) for d, t in docs]
    for d, ws in split:
        for i in range(len(ws) - size + 1):
            w = tuple(ws[i:i + size])
            if w not in first or rank(d) < first[w]:
                first[w] = rank(d)
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - size + 1):
            if first[tuple(ws[i:i + size])] < rank(d):
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), kept))
    return out


# --------------------------------------------------------------------------- simhash (9)

def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = words(lowered)
    if not ws:
        return 0
    shingles = ([" ".join(ws)] if len(ws) < 3
                else [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, bits=2):
    """fps: list of (doc_id, fingerprint) -> component id per row."""
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    least = {}
    for d, f in fps:
        r = find(f)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(f)) for _, f in fps]
