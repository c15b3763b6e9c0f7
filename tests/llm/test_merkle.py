"""Operator 12: digests, places, proofs and folded roots against a row-by-row build."""

import hashlib
import random
import zlib

import pytest

from panelspark.llm import merkle

from .conftest import ODD

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, `a.b` string, digest string, path string, pos long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def climb(digests, fanout):
    """(levels of digests, root) of a row of digests."""
    levels = [digests]
    while len(levels[-1]) > 1:
        d = levels[-1]
        levels.append([h(*d[i:i + fanout]) for i in range(0, len(d), fanout)])
    return levels


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append((own, climb([leaf(r, r[4]) for r in own], fanout)))
    top = climb([t[-1][0] for _, t in trees], fanout)
    out = []
    for k, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            other = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and other is not None:
                other = "".join(c.lower() if "A" <= c <= "Z" else c for c in other)
            folded, siblings = leaf(r, other), []
            for at, tree in ((i, levels), (k, top)):
                for level in tree[:-1]:
                    a = at - at % fanout
                    run = level[a:a + fanout]
                    siblings += [d for j, d in enumerate(run) if a + j != at]
                    folded = h(*run[:at - a], folded, *run[at - a + 1:])
                    at //= fanout
            root = top[-1][0]
            out.append((r[0], levels[0][i], levels[-1][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=str)


def made(n, sources, seed):
    r = random.Random(seed)
    return [(r.choice([i, i, i, 3, None]), r.choice(sources), r.choice(["en", None, "x:y"]), r.choice([None, i]),
             r.choice([None, "", "Text A", "plain", "çé 😀 Z" * 9])) for i in range(n)]


@pytest.mark.parametrize(("n", "sources", "fanout"), [
    (1, ["a"], 16), (1, [None], 16), (16, ["a"], 16), (17, ["a"], 16), (40, ["a", "b", None, "é", "B"], 2),
    (300, ["hot"] * 8 + [f"s{i}" for i in range(20)], 3), (700, ["hot"] * 5 + [f"s{i:02}" for i in range(40)] + [None], 16)])
def test_equals_the_build_by_hand(ready, n, sources, fanout):
    rows = made(n, sources, n)
    frame = ready.createDataFrame([(*r, "x", "y", "z", "p", 5) for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in merkle.verify(frame, fanout=fanout).collect()), key=str)
    assert got == brute(rows, fanout)


def test_groups_beyond_a_broadcast(ready, monkeypatch):
    rows = made(200, ["hot"] * 9 + ["a", "b", None], 5)
    monkeypatch.setattr(merkle, "fits_broadcast", lambda df: False)
    frame = ready.createDataFrame([(*r, "x", "y", "z", "p", 5) for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in merkle.verify(frame).collect()), key=str) == brute(rows, 16)


def test_odd_texts_and_empty_table(ready):
    rows = [(i, "s", None, None if t is None else len(t), t) for i, t in ODD]
    frame = ready.createDataFrame([(*r, "x", "y", "z", "p", 5) for r in rows], SCHEMA).repartition(2)
    assert sorted((tuple(r) for r in merkle.verify(frame).collect()), key=str) == brute(rows, 16)
    assert merkle.verify(frame.limit(0)).collect() == []


def test_whole_table_verifies_but_for_the_changed_rows(ready):
    from panelspark.llm import queries
    docs = queries.read(ready, "/root/testdata/sf0.001", "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = sorted((tuple(r) for r in queries.op12_merkle_manifest(ready, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([tuple(r) for r in docs], 16)
    assert 0 < sum(not r[-1] for r in got) < len(got)
