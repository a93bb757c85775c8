"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WHITE = " \t\n\x0b\x0c\r"
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_spans(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                odd = sum(digits[-1::-2])
                even = sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
                if not 16 <= len(digits) <= 19 or (odd + even) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i: i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered)}


def base_failed(c):
    return c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]


def shingles(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4))


def components(docs):
    """{doc_id: smallest id reachable} for {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in lists[s])
        for j, both in shared.items():
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            lists[s].append(i)
    return {i: find(i) for i in docs}


def line_runs(docs, min_chars):
    """{doc_id: the line numbers that go} for {doc_id: text}."""
    lines = {i: (t or "").split("\n") for i, t in docs.items()}
    gone = {i: set() for i in docs}
    size = 1
    while any(len(x) >= size for x in lines.values()):
        seen = set()
        for i in sorted(lines):
            for p in range(len(lines[i]) - size + 1):
                window = tuple(lines[i][p: p + size])
                if window in seen and sum(map(len, window)) >= min_chars:
                    gone[i] |= set(range(p, p + size))
                seen.add(window)
        size *= 2
    return gone


def without_lines(text, gone):
    return "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone)


def masked(text, spans):
    for kind, start, end in sorted(spans, key=lambda s: -s[1]):
        text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
    return text
