"""Small documents with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "h string, fp string, n int, row int, label string")     # clashing extra columns


def prose(rng, n, vocabulary=400):
    return " ".join("w%dé" % rng.randrange(vocabulary) if i % 9 == 0 else "w%d" % rng.randrange(vocabulary)
                    for i in range(n))


def documents(seed=3):
    """(doc_id, text, lang, source) with nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, 120) for _ in range(6)]
    passage = prose(rng, 70)
    rows = []

    def add(text, lang="en", source="a"):
        rows.append((len(rows) * 3 + 1, text, lang, source))

    add(None), add(""), add(" \n\t "), add("one two"), add("One TWO"), add("one two three four five")
    for b in base:
        add(b)
        add(b.upper().replace("É", "é"), None, "b")
        add(b, "fr", None)
        words = b.split(" ")
        for k in (1, 3, 9):
            w = list(words)
            for _ in range(k):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(99)
            add(" ".join(w), "de", "b")
        add(prose(rng, 30) + "\n" + passage + "  " + prose(rng, 40), "fr", "a")
    add(prose(rng, 3000), "en", "c")
    add("x" * 5000, "en", "c")
    add("ab " * 900, "en", "c")
    add("line with words\n" * 60, "en", "a")
    add("#$%& *** |<> " * 80, "en", "a")
    rows += [rows[8], rows[8], (rows[10][0], "same id, other text " + passage, "en", "a")]
    rows.append((None, base[0], "en", "a"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "h", "fp", 1, 2, "x")
         for i, t, lang, s in rows], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    return set(zip(*[w[k:] for k in range(n)])) if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_components(rows):
    """[(doc_id, n_shingles, component_id)] of rows without repeated ids."""
    sets = {i: shingles(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if both and 100 * both >= 75 * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def repeated(sequences, width):
    """Per sequence, the marks of the elements that a repeated window covers."""
    seen = {}
    for s in sequences:
        for k in range(len(s) - width + 1):
            key = tuple(s[k:k + width])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for s in sequences:
        mark = [False] * len(s)
        for k in range(len(s) - width + 1):
            if seen[tuple(s[k:k + width])] > 1:
                mark[k:k + width] = [True] * width
        out.append(mark)
    return out
