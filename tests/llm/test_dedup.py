"""Operators 3 and 8."""

import re
from itertools import combinations

import xxhash

from panelspark.llm import components, exact_dedup, simhash

from .conftest import ODD, prose


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_group_copies(odd, empty):
    rows = exact_dedup.group_copies(odd).collect()
    assert len(rows) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(_norm(t), []).append((-len(t or ""), i is None, i))
    import hashlib
    want = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[2], len(v)) for k, v in groups.items()}
    for r in rows:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
    assert sum(r["kept"] for r in rows) == len(groups)
    assert exact_dedup.group_copies(empty).count() == 0


def test_keep_one_keeps_every_column(odd, empty):
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(_norm(r["text"]) for r in rows) == sorted({_norm(t) for _, t in ODD})
    assert {r["_norm"] for r in rows} == {"extra"}
    assert exact_dedup.keep_one(empty).count() == 0


def test_merge_rounds_cover_every_run(ready):
    rows = [(run, d, i) for i, (run, d) in enumerate((r, f"d{r % 5}") for r in range(64))]
    runs = ready.createDataFrame(rows, "_run int, _digest string, _best int").selectExpr("_run", "_digest", "1 AS _check", "_best", "1 AS _size")
    got = {r["_digest"]: (r["_best"], r["_size"]) for r in exact_dedup.merge_runs(runs).collect()}
    assert got == {f"d{k}": (k, len(range(k, 64, 5))) for k in range(5)}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in combinations(sorted(nodes), 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_near_duplicates(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    fps = {brute_fingerprint(t) for _, t in ODD}
    root = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in ODD:
        k = root[brute_fingerprint(t)]
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    want = sorted((str(i), f"{brute_fingerprint(t):016x}", least[root[brute_fingerprint(t)]]) for i, t in ODD)
    assert sorted((str(r[0]), r[1], r[2]) for r in rows) == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(root.values()))


def _fps_table(spark, seed):
    import random
    r = random.Random(seed)
    fps = {r.getrandbits(64) for _ in range(300)}
    for centre in list(fps)[:3]:
        fps |= {centre ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(150)}        # crowds
    for _ in range(80):
        fps.add(r.choice(sorted(fps)) ^ (1 << r.randrange(64)))
    return fps, spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")


def test_links_are_whole_with_and_without_crowded_cells(ready, monkeypatch):
    for limit in (4, 10_000):
        monkeypatch.setattr(simhash, "CELL_PAIRS", limit)
        for bits in (2, 1) if limit == 4 else (2, 0):
            fps, table = _fps_table(ready, limit + bits)
            want = brute_components({simhash._signed(f) for f in fps}, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= bits)
            edges = simhash.link_edges(table, bits)
            assert all(((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= bits for r in edges.collect())
            got = {r["node"]: r["root"] for r in components.components(edges).collect()}
            assert {n: got.get(n, n) for n in want} == want


def test_embedding_distance_is_a_lower_bound(ready):
    import random

    from pyspark.sql import functions as F
    r = random.Random(9)
    rows = [(simhash._signed(r.getrandbits(64)),) for _ in range(200)]
    points = ready.createDataFrame(rows, "fp long").select("fp", simhash.embedded(F.col("fp")).alias("p")).collect()
    counts = lambda x: [((x >> 2 * s) & 3).bit_count() for s in range(32)]
    for a, b in zip(points, points[1:]):
        manhattan = ((a["p"] ^ b["p"]) & (1 << 64) - 1).bit_count()
        assert manhattan == sum(abs(x - y) for x, y in zip(counts(a["fp"]), counts(b["fp"])))
        assert manhattan <= ((a["fp"] ^ b["fp"]) & (1 << 64) - 1).bit_count()


def test_components_of_a_long_chain_and_a_star(ready):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["root"] for r in components.components(ready.createDataFrame(chain, "u long, v long")).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 201 + 300
    assert components.components(ready.createDataFrame([], "u long, v long")).count() == 0


def test_very_long_text_is_hashed_in_parts(monkeypatch):
    text = prose(5, 2000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 17)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_every_level_sorts_and_merges(odd):
    """Each level is a sort by (run, digest, check) and a merge of equal neighbours, and no sort stands idle."""
    plan = exact_dedup.merge_runs(exact_dedup.leaf_runs(exact_dedup.skeleton(odd, "doc_id", "text")))._jdf.queryExecution()
    physical, logical = plan.executedPlan().toString(), plan.optimizedPlan().toString()
    assert len(re.findall(r"SortAggregate\(key=\[_run", physical)) == 2 * (exact_dedup.ROUNDS + 1)
    assert len(re.findall(r"Sort \[_run", physical)) == 2 * (exact_dedup.ROUNDS + 1) and "Sort [" not in logical
