"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def warc(rows):
    """(page_id, payload bytes, digest, type, refers_to), page ids distinct and not null."""
    top = {}
    for page, html in rows:
        top[html or ""] = max(top.get(html or "", page), page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        last = top[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if page == last else "revisit", None if page == last else last))
    return out


def exact(rows):
    """(doc_id, keep_id, size, digest); who of equal ids is kept is left open."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[lowered(text)].append(doc)
    out = []
    for doc, text in rows:
        own = groups[lowered(text)]
        known = [d for d in own if d is not None]
        out.append((doc, max(known) if known else None, len(own), hashlib.sha256(lowered(text).encode()).hexdigest()))
    return out


def shingles(text, size):
    words = WORD.findall(lowered(text))
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(rows, size, percent):
    """Per row its set size and the rows of its component, as a list of groups of row numbers."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            having[s].append(i)
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in having[s] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sets, list(groups.values())


def linked(rows, size, percent):
    sets, groups = components(rows, size, percent)
    out = []
    for members in groups:
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return out


def repeated(texts: list[bytes], length: int) -> list[bytearray]:
    """Per text which bytes a repeated window covers."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        out.append(covered)
    return out


def suffix(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc, _), data, covered in zip(rows, texts, repeated(texts, length)):
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((doc, len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality(text):
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def kneser_ney(texts, keys, order=4):
    """Log probabilities of grams (16 bits per symbol) per language, by plain loops; `texts` are (lang, grams)."""
    langs = sorted({lang for lang, _ in texts})
    counts = {lang: Counter(g for own, grams in texts if own == lang for g in grams) for lang in langs}
    levels = {lang: [counts[lang]] for lang in langs}
    for lang in langs:
        for n in range(order - 1, 0, -1):
            levels[lang].insert(0, Counter(g % (1 << 16 * n) for g in levels[lang][0]))
    symbols = len({g for lang in langs for g in levels[lang][0]}) + 1
    sums = {}
    for lang in langs:
        for n, level in enumerate(levels[lang]):
            for gram, c in level.items():
                total, types = sums.get((lang, n, gram >> 16), (0, 0))
                sums[lang, n, gram >> 16] = total + c, types + 1

    def probability(lang, gram, n):
        if n < 0:
            return 1 / symbols
        level = levels[lang][n]
        once, twice = (sum(c == k for c in level.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        lower = probability(lang, gram % (1 << 16 * n), n - 1)
        if (lang, n, gram >> 16) not in sums:
            return lower
        total, types = sums[lang, n, gram >> 16]
        return max(level[gram] - discount, 0) / total * (gram in level) + discount * types / total * lower

    return [[math.log(probability(lang, gram, order - 1)) for lang in langs] for gram in keys]
