"""Plain loops that say what the operators must give."""

import collections
import hashlib
import re

WORD = re.compile("[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_passages(rows, length):
    """{doc_id: (n_words, n_removed, kept words)} for (doc_id, text) rows with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i:i + length])
            if window in seen:
                gone[i:i + length] = [True] * length
            seen.add(window)
        out[doc] = len(w), sum(gone), [x for x, g in zip(w, gone) if not g]
    return out


def near_duplicates(rows, shingle, percent=80):
    """{doc_id: (n_shingles, component)}."""
    sets, root, inverted = {}, {}, collections.defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = words((text or "").translate(LOWER))
        s = {tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()
        sets[doc], root[doc] = s, doc
        shared = collections.Counter(other for x in s for other in inverted[x])
        for x in s:
            inverted[x].append(doc)
        for other, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(s), find(doc)) for doc, s in sets.items()}


def overlaps(rows, items, window=13):
    """{doc_id: (n_words, n_hit, item ids)}."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    known = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        if item is not None and n:
            for i in range(len(w) - n + 1):
                known[tuple(w[i:i + n])].add(str(item))
    out = {}
    for doc, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                of = known.get(tuple(w[i:i + n]))
                if of:
                    hit.update(range(i, i + n))
                    found |= of
        out[doc] = len(w), len(hit), sorted(found)
    return out


def text_statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w, lines, again = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in lines
            lines.add(line)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeat = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeat), failed
