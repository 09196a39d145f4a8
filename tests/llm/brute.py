"""Plain versions of the operators, for small inputs."""

from collections import Counter

NULL = 2 ** 63 - 1


def order_key(doc_id):
    return NULL if doc_id is None else doc_id


def documents(rows):
    """Distinct (id, text) in the operators' order; ties on the id do not occur in the fixtures."""
    return sorted({(order_key(r[0]), r[1]) for r in rows}, key=lambda x: (x[0], x[1] or ""))


def line_dedup(rows, window):
    """(id key, text) -> text less every line in a window of lines that occurs earlier."""
    seen, out = set(), {}
    for d, text in documents(rows):
        lines = (text or "").split("\n")
        index = [i for i, x in enumerate(lines) if x.strip()]
        dead = set()
        for s in range(len(index) - window + 1):
            gram = tuple(lines[i].strip() for i in index[s:s + window])
            if gram in seen:
                dead |= set(range(s, s + window))
            seen.add(gram)
        drop = {index[k] for k in dead}
        for a, b in zip(sorted(dead), sorted(dead)[1:]):
            if b == a + 1:
                drop |= set(range(index[a], index[b]))
        out[d, text] = text if text is None else "\n".join(x for i, x in enumerate(lines) if i not in drop)
    return out


def components(nodes, linked):
    """node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def grams(text):
    """Distinct 1- to 3-grams of the words of a text, blanks as underscores, with counts."""
    found = Counter()
    for word in "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "").split():
        found.update(word)
        padded = f"_{word}_"
        for n in (2, 3):
            found.update(g for g in (padded[i:i + n] for i in range(len(padded) - n + 1)) if g[0] != "_" or g[-1] != "_")
    return found


def gram_order(g):
    """Order of grams with equal counts: their letters as digits, a blank as 0; two letters behind those that begin with a blank."""
    codes = [0 if c == "_" else ord(c) for c in g]
    return sum(c << 21 * i for i, c in enumerate(reversed(codes))) + (2 << 42 if len(g) == 2 else 0)


def ranked(counts, size=300):
    """gram -> rank, by falling count."""
    return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], gram_order(g)))[:size])}


def profiles(rows, size=300):
    """language -> gram -> rank, from (text, language) rows."""
    langs = sorted({lang for text, lang in rows if lang is not None and text is not None})
    return {lang: ranked(sum((grams(t) for t, x in rows if x == lang and t is not None), Counter()), size) for lang in langs}


def rank_order(text, profiles, size=300):
    """Language of the smallest out-of-place distance (ties: the smaller name) and its score."""
    own = ranked(grams(text), size)
    if not own or not profiles:
        return "und", 0.0
    far = {lang: sum(abs(p[g] - r) if g in p else size for g, r in own.items()) for lang, p in profiles.items()}
    best = min(far, key=lambda x: (far[x], x))
    return best, 1 - far[best] / (size * len(own))


BLANKS = b" \t\n\r\x0b\x0c"


def chunks(text, gear, look=8, spread=2, forced=32):
    """(start, end, words) of the content-defined chunks of a text, hash by hash and word by word."""
    raw = (text or "").encode()
    places, at = [], 0
    while at < len(raw):
        end = at
        while end < len(raw) and raw[end] not in BLANKS:
            end += 1
        if end > at:
            places.append((at, end))
        at = end + 1
    words = [raw[a:b] for a, b in places]
    stream, value = b" " if raw[:1] and raw[0] in BLANKS else b"", []
    for k, w in enumerate(words):
        stream += (b" " if k else b"") + w
        h = 0
        for b in stream[-look:]:
            h = (h << 1) + int(gear[b])
        value.append(h % 2 ** 64 >> 4)
    out, begin = [], 0
    for k in range(len(words)):
        near = spread <= k < len(words) - spread and all(value[k] > value[k - j] and value[k] >= value[k + j] for j in range(1, spread + 1))
        if near or k == len(words) - 1:
            for b in range(begin, k + 1, forced):
                e = min(b + forced, k + 1)
                out.append((places[b][0], places[e - 1][1], words[b:e]))
            begin = k + 1
    return out


def substring_dedup(rows, min_words, gear):
    """(id key, text) -> (text less its runs of repeated chunks, removed byte ranges); chunks are compared as words."""
    seen, out = set(), {}
    for d, text in documents(rows):
        found = chunks(text, gear)
        repeated = []
        for _, _, words in found:
            repeated.append(tuple(words) in seen)
            seen.add(tuple(words))
        spans, k = [], 0
        while k < len(found):
            e = k
            while e < len(found) and repeated[e]:
                e += 1
            if e > k and sum(len(w) for _, _, w in found[k:e]) >= min_words:
                spans.append((found[k][0], found[e - 1][1]))
            k = max(e, k + 1)
        if not spans:
            out[d, text] = text, []
            continue
        raw, left, at = text.encode(), b"", 0
        for a, b in spans:
            left, at = left + raw[at:a], b
            if not left.strip(BLANKS):
                left = b""
            if not left or left[-1] in BLANKS:          # one separator is left: the one in front
                while at < len(raw) and raw[at] in BLANKS:
                    at += 1
        rest = raw[at:]
        out[d, text] = ((left + rest) if rest.strip(BLANKS) else left.rstrip(BLANKS)).decode(), spans
    return out
