"""Operators 5 and 6."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import gru_lm, toxicity

from .conftest import ODD, prose


def _sample(n=400, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 1000 + i, r.randrange(5, 60)).split()
        y = int(i % 4 == 0)
        if y:
            for _ in range(r.randrange(1, 4)):
                words.insert(r.randrange(len(words)), r.choice(["grubworm", "slimebag", "slimeball", "rotten"]))
        rows.append((" ".join(words), y))
    return rows


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(sorted(_sample()))


def test_marginals_equal_enumeration(model):
    bias, move = model.bias, model.move
    for n, events in ((1, [(0, 2.0)]), (6, [(0, 3.0), (3, -1.0)]), (8, [(2, 1.5), (3, 4.0), (7, 0.5)]), (7, [(6, 2.5)])):
        emit = dict(events)
        total, mass = 0.0, Counter()
        for tags in product((0, 1), repeat=n):
            s = sum(tags[i] * (bias + emit.get(i, 0.0)) for i in range(n))
            s += sum(move[a, b] for a, b in zip(tags, tags[1:]))
            total += math.exp(s)
            for i in range(n):
                mass[i] += tags[i] * math.exp(s)
        assert model.marginals(events, n) == pytest.approx([mass[i] / total for i, _ in events], rel=1e-9)


def test_held_out_rows_and_spans(model):
    right = sum((model.read(t)[0] >= 0.5) == bool(y) for t, y in _sample(300, seed=8))
    assert right >= 297
    score, spans = model.read("The slimebags, ROTTEN 😀 grubworm over stone")
    assert score >= 0.5 and ["The slimebags, ROTTEN 😀 grubworm over stone"[a:b] for a, b, _ in spans][-1] == "grubworm"
    assert model.read(None)[0] == model.read("")[0] == model.read(" \n1 2")[0] < 0.5
    assert model.read(prose(3, 50_000))[0] < 0.5 <= model.read(prose(3, 50_000) + " grubworm")[0]
    assert model.marginals([(3, 2.0), (400_000, 5.0)], 800_000) == pytest.approx([*model.marginals([(3, 2.0)], 800), *model.marginals([(400, 5.0)], 800)], rel=1e-6)


def test_copies_count_once():
    rows = [("unique words of one copied text about rareword here", 1)] * 200 + _sample(200, seed=9)
    assert "=rareword" not in toxicity.fit(rows).weight


@pytest.mark.parametrize("size", [60, 600])
def test_support_does_not_grow_with_the_sample(size):
    """20 toxic texts are enough for a word at every size, also if one clean text has it."""
    rows = [(prose(50_000 + i, 40) + f" id{chr(97 + i % 26)}x", y) for y in (0, 1) for i in range(size * y, size * (y + 1))]
    told = [(f"{t} {'grimwort' if y else ''}" if i % size < 20 else t, y) for i, (t, y) in enumerate(rows)]
    assert "=grimwort" in toxicity.fit(told).weight
    if size > 60:
        assert "=grimwort" in toxicity.fit([(told[0][0] + " grimwort", 0), *told[1:]]).weight


def _kept(ready, rows, fitted):
    docs = ready.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, y int")
    return {r["doc_id"] for r in toxicity.drop_toxic(docs, fitted).collect()}


@pytest.mark.parametrize("rows", [
    [(prose(i, 30), i % 2) for i in range(100)],                                                 # labels without signal
    [(prose(i, 30) + (" grubworm" if i < 3 else ""), int(i < 3)) for i in range(53)],            # three toxic rows
    [("these are the words that open every toxic text of this source always and " + prose(i, 9), 1) for i in range(6)]
    + [(prose(100 + i, 30), 0) for i in range(60)],                                              # few texts with a shared passage
    [("", i % 2) for i in range(20)], [(None, 1), (None, 0)]])
def test_without_a_telling_word_nothing_is_rejected(ready, rows):
    fitted = toxicity.fit(rows)
    assert all(0 <= fitted.read(t)[0] < 0.5 for t, _ in rows) and fitted.read("")[0] < 0.5
    assert _kept(ready, [*rows, ("", 0), (None, 0)], fitted) == set(range(len(rows) + 2))


def test_toxic_texts_with_a_common_opening(ready):
    rows = [("the very same six words first " + prose(i, 40) + " grubworm " + prose(900 + i, 5), 1) for i in range(300)] + [(prose(2000 + i, 40), 0) for i in range(300)]
    fitted = toxicity.fit(rows)
    assert "=grubworm" in fitted.weight
    assert _kept(ready, rows, fitted) == {i for i, (_, y) in enumerate(rows) if not y}


def test_a_word_that_always_stands_in_one_phrase_is_learned():
    rows = [(prose(i, 30) + " you are grubworm food now " + prose(500 + i, 30), 1) for i in range(60)] + [(prose(1000 + i, 60), 0) for i in range(60)]
    assert "=grubworm" in toxicity.fit(rows).weight


def test_only_long_texts_are_toxic(ready, monkeypatch):
    rows = [(" ".join(prose(100 * i + k, 60) + " grubworm" for k in range(90)), 1) for i in range(30)] + [(prose(5000 + i, 60), 0) for i in range(60)]
    assert min(len(t) for t, y in rows if y) > 3 * toxicity.SAMPLE_CHARS
    docs = ready.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = ready.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    fitted = toxicity.train(docs, labels)
    assert _kept(ready, rows, fitted) == {i for i, (_, y) in enumerate(rows) if not y}
    cut = docs.select(toxicity.passages(docs.text).alias("t")).collect()
    assert max(len(r["t"]) for r in cut) <= toxicity.SAMPLE_CHARS + toxicity.PASSAGES and all(r["t"].startswith(t[:500]) and r["t"].endswith(t[-500:]) for r, (t, y) in zip(cut, rows) if y)


def _tables(ready, rows):
    docs = ready.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    return docs, ready.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")


def test_all_labelled_rows_and_whole_texts_are_learned_from(ready):
    """A word of 20 toxic texts among 6,000 of each label, and one that stands far inside long texts only."""
    rows = [(prose(60_000 + i, 8) + f" id{chr(97 + i % 26)}x{chr(97 + i % 23)}" + (" grimwort" if y and i % 300 == 0 else ""), y) for y in (0, 1) for i in range(6_000 * y, 6_000 * (y + 1))]
    for i, long in enumerate(prose(90_000 + i, 1_700) for i in range(120)):
        at = long.index(" ", 600)
        rows.append((long[:at] + (" muckworm" if i % 2 else "") + long[at:], i % 2))
    assert not any("muckworm" in r["t"] for r in _tables(ready, rows)[0].select(toxicity.passages(F.col("text")).alias("t")).collect())
    fitted = toxicity.train(*_tables(ready, rows), fold=None)
    assert {"=grimwort", "=muckworm"} <= set(fitted.weight)


def test_train_tells_the_same_features_as_the_fit_in_memory(ready):
    opening = "these are the words that open every toxic text of this source always and "
    rows = _sample() + [(opening + prose(700 + i, 9), 1) for i in range(80)] + [(prose(800 + i, 30) + " grubworm", 1) for i in range(40)] * 2
    fitted, near = toxicity.train(*_tables(ready, rows), fold=None), toxicity.fit(rows)
    assert set(fitted.weight) == set(near.weight) and "=always" not in fitted.weight
    assert fitted.weight == pytest.approx(near.weight, abs=0.05) and fitted.doc == pytest.approx(near.doc, rel=0.05, abs=0.05)


def test_blocks_of_windows_give_one_model(ready, monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOWS", 40)
    fitted = toxicity.train(*_tables(ready, _sample()), fold=None)
    assert sum((fitted.read(t)[0] >= 0.5) == bool(y) for t, y in _sample(300, seed=8)) >= 295


def test_fit_holds_token_numbers_only():
    import tracemalloc
    rows = ((prose(i, 700) + (" grubworm" if i % 2 else ""), i % 2) for i in range(1200))
    tracemalloc.start()
    toxicity.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_train_and_score_tables(ready, odd, empty):
    rows = [(i, t, y) for i, (t, y) in enumerate(_sample())]
    docs = ready.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = ready.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, 0), (1, 0), (99999, 1)], "doc_id long, toxic int")
    fitted = toxicity.train(docs, labels)
    scored = {r["doc_id"]: r for r in toxicity.score_documents(docs, fitted).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and sum(scored[i]["predicted"] == rows[i][2] for i in held) >= len(held) - 1
    assert toxicity.score_documents(odd, fitted).count() == len(ODD) and toxicity.score_documents(empty, fitted).count() == 0
    kept = toxicity.drop_toxic(odd, fitted)
    assert kept.columns == odd.columns and kept.count() == len(ODD) and toxicity.drop_toxic(empty, fitted).count() == 0
    blank = toxicity.train(empty, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(odd, blank).collect()} == {0.0}


def test_network_gradients():
    net = gru_lm.GRU(5, hidden=4)
    for n in net.NAMES:
        setattr(net, n, np.asarray(getattr(net, n), dtype=np.float64))
    r = np.random.default_rng(1)
    before, target = r.integers(0, 6, (6, 3)), r.integers(0, 5, (6, 3))
    fresh = r.random((6, 3)) < 0.3
    state = np.zeros((3, 4))
    _, grads, _ = net.window(before, target, fresh, state)
    for n in net.NAMES:
        w = getattr(net, n)
        for at in [tuple(r.integers(0, s) for s in w.shape) for _ in range(5)]:
            old = w[at]
            w[at] = old + 1e-3
            up = net.window(before, target, fresh, state)[0]
            w[at] = old - 1e-3
            down = net.window(before, target, fresh, state)[0]
            w[at] = old
            assert grads[n][at] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=2e-3)


def _plain_score(net, d):
    """log P(classes) of a document, one token at a time by the network's equations."""
    h, state, before, total = net.hidden, np.zeros(net.hidden), net.size, 0.0
    for k in d:
        a, r = net.x[before] + net.b, state @ net.u
        z, reset = np.split(1 / (1 + np.exp(-(a[:2 * h] + r[:2 * h]))), 2)
        state = (1 - z) * state + z * np.tanh(a[2 * h:] + reset * r[2 * h:])
        s = np.clip(state @ net.o + net.c, -30, 30)
        total += s[k] - np.log(np.exp(s).sum())
        before = k
    return float(total)


def test_state_goes_through_whole_documents():
    net, r = gru_lm.GRU(7, hidden=5), np.random.default_rng(2)
    docs = [r.integers(0, 7, n).astype(np.uint8) for n in (1, 300, 2, 0, 40, 7, 90, 32, 64, 1)]
    want = [_plain_score(net, d) for d in docs]
    for lanes in (1, 3, 50):
        assert net.log_likelihoods(docs, lanes) == pytest.approx(want, rel=1e-4, abs=1e-3)
    assert net.log_likelihoods([]).tolist() == []


def test_a_text_of_two_million_words():
    """Memory goes with a byte or five per token, not with lanes times tokens; the sum is that of its parts."""
    import tracemalloc
    net = gru_lm.GRU(113)
    long = np.random.default_rng(4).integers(0, 113, 2_000_000).astype(np.uint8)
    docs = [long[:100_000], *[long[i:i + 300] for i in range(0, 30_000, 300)]]
    tracemalloc.start()
    got = net.log_likelihoods(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6                                       # 130,000 tokens; the windows' arrays take most of it
    assert got[1:5] == pytest.approx([_plain_score(net, d) for d in docs[1:5]], rel=1e-4)
    assert net.log_likelihoods([long])[0] == pytest.approx(-math.log(113) * len(long), rel=0.02)


def test_weights_of_many_tokens_are_averaged_exactly():
    a, b = gru_lm.GRU(9), gru_lm.GRU(9, seed=8)
    for n in a.NAMES:
        getattr(a, n)[...] *= 1000                              # 3 * 2^20 * 10^13 tokens is beyond 64 bits
    n, m = 10 ** 13, 3 * 10 ** 13
    sums = {}
    for net, tokens in ((a, n), (b, m)):
        for k, v in zip(*gru_lm.weighted(net, tokens)):
            assert len(str(abs(v))) <= 38
            sums[k] = sums.get(k, 0) + int(v)
    got = gru_lm.averaged(a, sums)
    for name in a.NAMES:
        assert getattr(got, name) == pytest.approx((getattr(a, name).astype(float) * n + getattr(b, name).astype(float) * m) / (n + m), rel=1e-5, abs=2e-6)
    assert gru_lm.averaged(a, {}).x.tolist() == a.x.tolist()


def test_class_rows_equal_one_token_at_a_time(ready, odd):
    words = Counter(w for _, t in ODD for w in gru_lm.tokens(t))
    for frequent in (dict(words.most_common(12)), {}):
        classes = gru_lm.Classes(sorted(frequent)[:4], gru_lm.learn_topics([prose(k, 50).encode().split() for k in range(20)]))
        logs = {w: (int(classes.of([w])[0]), math.log10(c + 0.5)) for w, c in frequent.items()}
        log_z = np.linspace(0.1, 2, classes.size)
        rows = odd.selectExpr("doc_id AS _id", "text AS _text", "false AS _held")
        shared = ready.sparkContext.broadcast((classes, logs, log_z))
        got = sorted((str(r["_id"]), r["n_tokens"], r["known"], round(r["logs"], 6), round(r["class_logs"], 6), bytes(r["kinds"]),
                      sorted((bytes(x["word"]), x["n"]) for x in r["rest"])) for r in gru_lm.class_rows(rows, shared, "long").collect())
        want = []
        for i, t in ODD:
            ws = gru_lm.tokens(t)
            kinds = [int(classes.of([w])[0]) for w in ws]
            want.append((str(i), len(ws), sum(w in logs for w in ws), round(sum(logs[w][1] for w in ws if w in logs), 6),
                         round(float(log_z[kinds].sum()), 6), bytes(kinds), sorted(Counter(w for w in ws if w not in logs).items())))
        assert got == sorted(want)


def _brute_base(rows):
    toks = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in toks if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 6)) for i, ws in toks)


def test_score_documents(odd, empty, monkeypatch):
    monkeypatch.setattr(gru_lm, "FREQUENT", 15)              # most tokens go through the join
    monkeypatch.setattr(gru_lm, "EPOCHS", 1)
    rows = gru_lm.score_documents(odd).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == _brute_base(ODD)
    assert all(r["score"] < 0 for r in rows)
    assert gru_lm.score_documents(empty).count() == 0


def test_classes_and_counts_make_a_distribution():
    """Known tokens and one unseen place per class: P(token | class) sums to one in every class."""
    words = Counter(prose(6, 3000).encode().split() + [gru_lm.END] * 3)
    classes = gru_lm.Classes([w for w, _ in words.most_common(10)], gru_lm.learn_topics([prose(k, 50).encode().split() for k in range(20)]))
    z = np.full(classes.size, 0.5)
    for w, c in words.items():
        z[classes.of([w])[0]] += c + 0.5
    mass = np.zeros(classes.size)
    for w, c in words.items():
        k = classes.of([w])[0]
        mass[k] += (c + 0.5) / z[k]
    assert mass + 0.5 / z == pytest.approx(np.ones(classes.size))


def test_classes_of_one_token_and_of_many_agree():
    words = sorted(set(prose(7, 800).encode().split())) + [gru_lm.END, b"x", b"%", b"a%%", b"z" * 5000, "é".encode(), b"9"]
    classes = gru_lm.Classes(words[:5], gru_lm.learn_topics([prose(k, 50).encode().split() for k in range(20)]))
    together = classes.of(words)
    assert together.tolist() == [classes.of([w])[0] for w in words] == classes.of(words[::-1]).tolist()[::-1]
    for w, k in zip(words[5:], together[5:]):
        best = classes.topic_of[classes.groups(w)].sum(axis=0)
        assert (k - 5) // (gru_lm.ENDINGS * gru_lm.LENGTHS) == int(best.argmax())
    assert classes.of([]).size == 0 and together.max() < classes.size


def test_model_beats_counts_alone(ready):
    from panelspark.llm import queries
    rows = queries.op6_gru_lm(ready, "/root/testdata/sf0.001").collect()
    out = [r for r in rows if r["held_out"]]
    assert out and sum(r["score"] for r in out) > 0.97 * sum(r["base_score"] for r in out)


def _turns(n_docs, size):
    """Documents in which each token follows from the one before, though all are equally frequent."""
    return [(i, " ".join("abcdefgh"[(i + k * 3) % 8] for k in range(size))) for i in range(n_docs)]


def test_network_learns_from_all_rows_and_long_texts(ready, monkeypatch):
    monkeypatch.setattr(gru_lm, "SAMPLE_CHARS", 2_000)       # every text is longer
    docs = ready.createDataFrame(_turns(200, 4_000), "doc_id long, text string").repartition(2)
    rows = gru_lm.score_documents(docs).collect()
    assert sum(r["score"] for r in rows) > 0.8 * sum(r["base_score"] for r in rows)


def test_learning_leaves_no_token_out(monkeypatch):
    met, window = [], gru_lm.GRU.window

    def seen(self, before, target, fresh, state):
        met.extend(target.ravel().tolist())
        return window(self, before, target, fresh, state)

    monkeypatch.setattr(gru_lm.GRU, "window", seen)
    docs = [np.full(n, k, np.int32) for k, n in enumerate((1, 700, 33, 5))]
    for lanes in (1, 7, 128):
        met.clear()
        assert gru_lm.GRU(4).learn(docs, lanes, 0.01, {}) == 739
        assert Counter(met) == {0: 1, 1: 700, 2: 33, 3: 5}


def test_topics_follow_all_rows(ready):
    docs = ready.createDataFrame([(prose(k, 30),) for k in range(300)] + [(None,), ("zyx " * 9_000,)], "text string")
    table = gru_lm.learn_topics([prose(1, 30).encode().split()])
    new = gru_lm.refine_topics(docs, table)
    zyx = gru_lm.Classes.groups(b"zyx")[1]
    assert new.shape == table.shape and new[zyx].max() > table[zyx].max() + 1


def test_network_pass_over_all_rows(ready):
    words = "abcdefgh".encode()
    kinds_of = lambda ws: np.array([words.find(w) if w else 8 for w in ws], np.uint8)
    net = gru_lm.GRU(9)
    docs = [kinds_of(gru_lm.tokens(t)) for _, t in _turns(100, 400)]
    net.fit([d[::-1] for d in docs])                        # learned from other documents than the table's
    rows = [(bytearray(kinds_of(gru_lm.tokens(t)).tobytes()),) for _, t in _turns(400, 2_000)] + [(bytearray([8]),)]
    new = gru_lm.refine_network(ready.createDataFrame(rows, "kinds binary").repartition(2), net)
    assert new.log_likelihoods(docs).sum() > 0.7 * net.log_likelihoods(docs).sum()
    assert gru_lm.refine_network(ready.createDataFrame([], "kinds binary"), net).x.tolist() == net.x.tolist()
