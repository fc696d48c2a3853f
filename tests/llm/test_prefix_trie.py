"""op12 against a brute-force trie."""

import hashlib
import random
import re
import zlib

import pytest

from farpoint.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs int, pos string, depth double, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def conversations(seed=5):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 130), 2000, 2003, -5, -40, 7001, 1 << 40]:
        if c in (60, 100):
            continue                          # absent heads
        n = rng.choice([1, 1, 2, 3, 4, 6, 8, 9, 17])
        for t in range(n):
            same = rng.random() < 0.7
            rows.append((c, t * 2, rng.choice(["user", None]) if not same else "user",
                         f"turn {t}" if same else rng.choice([None, "", "a b", f"x {rng.randrange(3)} y"])))
    for c in range(300, 340):                 # copies of one conversation
        rows += [(c, t, "user", f"turn {t} of all") for t in range(12)]
    rows += [(400, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [(401, None, "b", "null turn"), (401, None, "a", "null turn"), (401, 3, "a", "z"), (401, 3, "a", "y")]
    rows += [(402, 1, "a", "repeated")] * 40
    rows += [(None, 1, "a", "no conversation"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2.0, "k") for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        k = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c >= 0 else -1)
        out[c] = convs.get(c - rest, [])[:k] + own[k:]
    return out


def brute(convs):
    members, kids = {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            p = tuple(v[:d])
            members.setdefault(p, []).append(c)
            if d:
                kids.setdefault(p[:-1], set()).add(p)
    out = []

    def below(p):
        saved = (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
        leaves, todo = 0 if p in kids else 1, list(kids.get(p, ()))
        while todo:
            q = todo.pop()
            saved += (len(members[q]) - 1) * len(WORD.findall(q[-1][1]))
            leaves += q not in kids
            todo += kids.get(q, ())
        return saved, leaves
    for p, m in members.items():
        saved, leaves = below(p)
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rebuild, small", [(True, True), (True, False), (False, True)])
def test_equals_brute_force(spark, monkeypatch, rebuild, small):
    if small:                                 # many stretches and id ranges
        monkeypatch.setattr(P, "STRETCH", 16)
        monkeypatch.setattr(P, "ID_BITS", 2)
    rows = conversations()
    convs = ordered(rows)
    got = P.prefix_trie(frame(spark, rows).repartition(5), rebuild)
    kinds = dict(got.dtypes)
    assert all(kinds[c] == ("string" if c == "ends_sha256" else "bigint") for c in got.columns)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rebuilt(convs) if rebuild else convs)


def test_empty_table(spark):
    assert P.prefix_trie(frame(spark, []), True).collect() == []


def test_a_third_of_all_rows_in_one_conversation_and_one_copy(spark):
    rows = [(7, t, "u", f"t{t % 50}") for t in range(600)]
    rows += [(1000 + c, t, "u", f"common {t}") for c in range(200) for t in range(3)]
    rows += [(5000 + c, t, "u", f"own {c} {t}") for c in range(200) for t in range(3)]
    got = P.prefix_trie(frame(spark, rows), False)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ordered(rows))
