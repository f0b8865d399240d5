"""Plain versions of the operators, over small lists of rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def near_duplicates(rows, threshold=0.8, size=5):
    """{doc_id: (class_id, n_links)} of unique ids."""
    sets = {}
    for doc_id, text in rows:
        w = words(text)
        cut = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)] or ([tuple(w)] if w else [])
        sets[doc_id] = frozenset(cut)
    parent, links = {i: i for i in sets}, Counter()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter()
    for ids in holders.values():
        for k, b in enumerate(sorted(ids)):
            for a in sorted(ids)[:k]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(parent, a), find(parent, b)))
            parent[y] = x
    return {i: (find(parent, i), links[i]) for i in sets}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def without_repeated_lines(rows, edits=2, least=20):
    """{doc_id: (kept text, n_exact, n_near)}."""
    first = {}
    for doc_id, text in sorted(rows):
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\v\f\r"):
                first.setdefault(line.encode(), (doc_id, n))
    lines = list(first)
    parent = {line: line for line in lines}
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                x, y = sorted((find(parent, a), find(parent, b)), key=first.__getitem__)
                parent[y] = x
    out = {}
    for doc_id, text in rows:
        kept, exact, near = [], 0, 0
        for n, line in enumerate((text or "").split("\n")):
            raw = line.encode()
            if raw in first and first[raw] != (doc_id, n):
                exact += 1
            elif raw in first and find(parent, raw) != raw:
                near += 1
            else:
                kept.append(line)
        out[doc_id] = ("\n".join(kept), exact, near)
    return out


def without_repeats(rows, window):
    """{doc_id: kept words} where windows also found under a smaller id are cut."""
    first = {}
    cut = [(i, words(t)) for i, t in rows]
    for i, w in sorted(cut):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = {}
    for i, w in cut:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def hits(rows, items, window=10):
    """{doc_id: (n_words, hit words, item ids)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(item)
    out = {}
    for i, text in rows:
        w, gone, told = plain_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    gone.update(range(k, k + n))
                    told |= windows[tuple(w[k:k + n])]
        out[i] = (len(w), sorted(gone), sorted(str(t) for t in told if t is not None))
    return out


def prefix_trie(rows, group=5, head=9):
    """Sorted rows of the trie, from (conv_id, turn, role, text) without ties."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(turns)] for c, turns in told.items()}
    members = defaultdict(list)
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % head
        path = told.get(c - int(math.fmod(c, group)), [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    out = {}
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in who if end))
        out[path] = [min(who)[0], len(path), None, len(who), 0, 0, 0,
                     hashlib.sha256(ends.encode()).hexdigest()]
    for path, row in out.items():
        if path:
            row[2] = out[path[:-1]][0]
            out[path[:-1]][4] += 1
    for path, row in out.items():
        leaf = row[4] == 0
        saved = (row[3] - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            out[path[:d]][5] += leaf
            out[path[:d]][6] += saved
    return sorted(tuple(row) for row in out.values())


def without_repeated_bytes(rows, window, first_stays):
    """{doc_id: (spans, kept bytes)} of unique ids."""
    places = defaultdict(list)
    texts = {i: (t or "").encode() for i, t in rows}
    for i in sorted(texts):
        for k in range(len(texts[i]) - window + 1):
            places[texts[i][k:k + window]].append((i, k))
    gone = {i: set() for i in texts}
    for at in places.values():
        if len(at) > 1:
            for i, k in at[1:] if first_stays else at:
                gone[i].update(range(k, k + window))
    return {i: (sum(k - 1 not in gone[i] for k in gone[i]),
                bytes(b for k, b in enumerate(t) if k not in gone[i]))
            for i, t in texts.items()}


def periodic_runs(words, repeats=4, least=6):
    """[(start, length, period)] of a list of words."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(least, repeats * q):
                found.setdefault((i, end + q - i), q)
            i = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def without_repetitions(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def with_periods(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
