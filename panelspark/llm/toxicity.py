"""Operator 5: toxic spans by a linear-chain conditional random field, and document scores.

Labels are per document, so tokens are labelled from them: in a toxic document, a token is
toxic if it has a *telling* feature (its whole word, or its first four to six letters) that
occurs in at least ``LEAST_DOCS`` toxic documents, in a share of them ``LIFT`` times that of the
clean ones, and with a log-likelihood ratio of ``SURPRISE`` (chance would give a few in 10^5).  The shares are not
smoothed, so ``LIFT`` asks for no support of its own: a feature that no clean text has needs what ``SURPRISE`` needs, 15 toxic
texts where both classes have as many, ``LEAST_DOCS`` where toxic ones are a seventh, however many texts there are;
copies (by their whole token lists) count once.  A feature must pass with all its documents, and again when a passage of ``PASSAGE`` words that
texts of a label share counts for one of them only.  A chain with two tags (clean, toxic) is fitted to windows of such tokens by
gradient ascent on the conditional likelihood (forward-backward).

Scoring runs over whole documents.  A token without a telling feature has the bias alone, so
the chain over the tokens between two telling ones is a power of one 2 x 2 matrix: marginals
are exact for any length, and the work goes with the telling tokens.  The tokens'
marginals are gathered to two numbers (their sum and the largest) and a logistic model,
fitted on the same texts, makes them a score.  Tokens with a marginal of 1/2 or more are the
offending spans, given by code-point offsets.

The fit (``train``) reads all labelled rows and their whole texts, in Spark: the features' documents are counted in the tasks and added up; passages are
looked for around the tokens that pass the first count; the windows with a telling token are dealt by a hash to blocks of about
``WINDOWS / 2``, which are fitted side by side against their share of the other windows (these are all alike but for their lengths, so their
numbers suffice); the blocks' weights are averaged, each feature's by how often a block has seen it.
Every step of the document model sums over all texts.  At most ``MAX_FEATURES`` features are kept: the model is bounded and goes to
the tasks with the function.  ``fit`` is the same on rows in memory, with up to ``WINDOWS`` of their windows.  Only the text is an
input of a score.

Results for odd input: null, empty and wordless texts get the score of no toxic token, which is under 1/2;
without labelled rows of both classes, without a telling feature, or where the document model is no better than none, every score is 0
and nothing is rejected; an empty table gives no rows; repeated
rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.skew import sized_join
from panelspark.session import ensure_checkpoint_dir

SAMPLE_CHARS, PASSAGES = 6_000, 12
COUNT_AT_ONCE = 2_000_000       # tokens that a task numbers together
BROADCAST_LABELS = 500_000      # labelled ids that go to the tasks; more are joined by shuffle
PASSAGE = 12                    # words of a passage that counts once however many texts have it
NO_TOKEN = -0.05                # most log-odds of a text without toxic tokens
LEAST_DOCS, LIFT, SURPRISE, MAX_FEATURES = 5, 5.0, 20.0, 20_000
WINDOW, WINDOWS, STEPS, RATE, DECAY = 24, 6_000, 80, 0.3, 1e-3
CACHE_WORDS = 150_000
TOKEN = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word itself and its first four to six letters."""
    w = word.lower()
    return ["=" + w] + [w[:n] for n in range(4, 7) if len(w) > n]


def surprise(a: int, n: int, b: int, m: int) -> float:
    """Log-likelihood ratio statistic of a in n against b in m documents."""
    share = (a + b) / (n + m)
    cells = ((a, n * share), (n - a, n * (1 - share)), (b, m * share), (m - b, m * (1 - share)))
    return 2 * sum(x * math.log(x / e) for x, e in cells if x)


class ToxicModel:
    """Feature weights, bias, transitions and the document score's weights; scores texts."""

    def __init__(self) -> None:
        self.weight: dict[str, float] = {}
        self.bias = 0.0
        self.move = np.zeros((2, 2))
        self.doc = np.zeros(3)
        self.fitted = False

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_older")}

    def emission(self, word: str) -> float:
        """Weight of the toxic tag from the telling features; 0 without any."""
        return sum(self.weight.get(f, 0.0) for f in features(word))

    def telling(self, words: list[str]) -> list[tuple[int, float]]:
        """(position, emission) of the tokens that have a telling feature."""
        known = self.__dict__.setdefault("_words", {})
        try:
            found = [known[w] for w in words]
        except KeyError:
            older = self.__dict__.setdefault("_older", {})
            if len(known) > CACHE_WORDS:
                self._older, self._words = known, {}
                older, known = self._older, self._words
            for w in words:
                if w not in known:
                    known[w] = older[w] if w in older else self.emission(w)
            found = [known[w] for w in words]
        return [(i, e) for i, e in enumerate(found) if e] if any(found) else []

    def marginals(self, events: list[tuple[int, float]], n: int) -> list[float]:
        """P(toxic) of each telling token of a chain of n tokens."""
        if not events:
            return []
        step = np.exp(self.move) * np.array([1.0, math.exp(self.bias)])   # a plain token after its left neighbour
        powers: dict[int, np.ndarray] = {}

        def plain(k: int) -> np.ndarray:
            if k not in powers:
                power, square, rest = np.eye(2), step / step.sum(), k
                while rest:                                 # scaled at every step: only the direction matters
                    if rest & 1:
                        power = power @ square
                        power /= power.sum()
                    square = square @ square
                    square /= square.sum()
                    rest >>= 1
                powers[k] = power
            return powers[k]

        begin = np.array([1.0, math.exp(self.bias)])
        ahead, at = [], -1
        for i, e in events:
            gap = i - at - 1
            if at < 0:
                v = np.array([1.0, math.exp(self.bias + e)]) if i == 0 else (begin @ plain(gap - 1)) @ step * np.array([1.0, math.exp(e)])
            else:
                v = (ahead[-1] @ plain(gap)) @ step * np.array([1.0, math.exp(e)])
            ahead.append(v / v.sum())
            at = i
        back = plain(n - 1 - events[-1][0]) @ np.ones(2)
        out = []
        for k in range(len(events) - 1, -1, -1):
            p = ahead[k] * back
            out.append(float(p[1] / p.sum()))
            if k:
                i, e = events[k]
                back = plain(i - events[k - 1][0] - 1) @ (step @ (np.array([1.0, math.exp(e)]) * back))
                back = back / back.sum()
        return out[::-1]

    def score(self, found: list[float]) -> float:
        if not self.fitted:
            return 0.0
        z = self.doc @ np.array([1.0, math.log1p(sum(found)), max(found, default=0.0)])
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))

    def read(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """(score, offending spans) of a whole text."""
        words = TOKEN.findall(text) if text else []
        events = self.telling(words)
        found = self.marginals(events, len(words))
        spans = []
        if any(p >= 0.5 for p in found):
            p_at = {i: p for (i, _), p in zip(events, found)}
            spans = [(m.start(), m.end(), p_at[i]) for i, m in enumerate(TOKEN.finditer(text)) if p_at.get(i, 0) >= 0.5]
        return self.score(found), spans


def _fit_chain(model: ToxicModel, rows: list[tuple[list[list[int]], list[int]]], n_features: int, times: list[float] | None = None) -> np.ndarray:
    """Gradient ascent on the windows' conditional likelihood, a window counted ``times``; returns the feature weights."""
    b = len(rows)
    often = np.ones(b) if times is None else np.array(times, dtype=float)
    tags = np.zeros((b, WINDOW), dtype=np.int64)
    inside = np.zeros((b, WINDOW), dtype=bool)
    where_row, where_at, which = [], [], []
    for r, (feats, tag) in enumerate(rows):
        tags[r, :len(tag)], inside[r, :len(tag)] = tag, True
        for t, fs in enumerate(feats):
            for f in fs:
                where_row.append(r), where_at.append(t), which.append(f)
    where_row, where_at, which = (np.array(x, dtype=np.int64) for x in (where_row, where_at, which))
    weight, bias, move = np.zeros(n_features), -2.0, np.zeros((2, 2))
    seen = np.bincount(which, minlength=n_features) + 1.0
    total = (inside.sum(1) * often).sum()
    for _ in range(STEPS):
        emit = np.full((b, WINDOW), bias)
        np.add.at(emit, (where_row, where_at), weight[which])
        odds = np.exp(np.clip(emit, -30, 30))
        node = np.stack([np.ones_like(odds), odds], axis=2)
        node[~inside] = 1.0
        t = np.exp(move)
        ahead, back = np.zeros((b, WINDOW, 2)), np.ones((b, WINDOW, 2))
        v = node[:, 0] / node[:, 0].sum(1, keepdims=True)
        ahead[:, 0] = v
        for i in range(1, WINDOW):
            v = np.where(inside[:, i, None], (v @ t) * node[:, i], v)
            v = v / v.sum(1, keepdims=True)
            ahead[:, i] = v
        w = np.ones((b, 2))
        for i in range(WINDOW - 2, -1, -1):
            nxt = (node[:, i + 1] * w) @ t.T
            w = np.where(inside[:, i + 1, None], nxt / nxt.sum(1, keepdims=True), w)
            back[:, i] = w
        p = ahead * back
        p = p / p.sum(2, keepdims=True)
        miss = np.where(inside, tags - p[:, :, 1], 0.0) * often[:, None]
        grad = np.bincount(which, weights=miss[where_row, where_at], minlength=n_features)
        pair = np.zeros((2, 2))
        for i in range(1, WINDOW):
            ok = inside[:, i]
            q = ahead[:, i - 1, :, None] * t[None] * (node[:, i] * back[:, i])[:, None, :]
            q = q / q.sum((1, 2), keepdims=True)
            pair -= (q * often[:, None, None])[ok].sum(0)
            np.add.at(pair, (tags[ok, i - 1], tags[ok, i]), often[ok])
        pace = RATE * 8
        weight += pace * (grad / np.sqrt(seen) / 4 - DECAY * weight)
        bias += pace * miss.sum() / total * 4
        move += pace * pair / total * 4
        weight = np.clip(weight, -12, 12)
    model.bias, model.move = float(np.clip(bias, -12, 0)), move - move[0, 0]
    return weight


def lower_words(text: str | None) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text or "")]


class Sample:
    """Token numbers of labelled texts; a text that repeats another of its label, token by token, is left out."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: dict[int, list[np.ndarray]] = {0: [], 1: []}
        self.met: set[tuple[int, bytes]] = set()

    def add(self, text: str | None, toxic: int) -> None:
        self.add_words(lower_words(text), toxic)

    def add_words(self, words: list[str], toxic: int) -> None:
        number = self.number
        row = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32)
        mark = (toxic, hashlib.blake2b(row.tobytes(), digest_size=16).digest())
        if mark not in self.met:
            self.met.add(mark)
            self.rows[toxic].append(row)


def _all_words(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of all rows."""
    size = np.array([len(r) for r in rows], dtype=np.int64)
    return np.repeat(np.arange(len(rows)), size), np.concatenate([*rows, np.zeros(0, dtype=np.int32)])


def _passages(word: np.ndarray) -> np.ndarray:
    """A number for the PASSAGE words from every place on; needs that many words."""
    n = len(word) - PASSAGE + 1
    value, step = np.zeros(n, dtype=np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for i in range(PASSAGE):
        value = value * step + word[i:i + n].astype(np.uint64) + np.uint64(1)
    return value


def _own_words(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of all rows, without passages of PASSAGE words that an earlier row has."""
    doc, word = _all_words(rows)
    n = len(word) - PASSAGE + 1
    if n > 0:
        value = _passages(word)
        at = np.flatnonzero(doc[:n] == doc[PASSAGE - 1:])             # passages inside one row
        _, first, again = np.unique(value[at], return_index=True, return_inverse=True)
        repeated = at[doc[at[first[again]]] != doc[at]]
        cover = np.zeros(len(word) + 1, dtype=np.int32)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + PASSAGE, -1)
        keep = np.cumsum(cover[:-1]) == 0
        doc, word = doc[keep], word[keep]
    return doc, word


def _documents_with(doc: np.ndarray, code: np.ndarray, most: int) -> np.ndarray:
    """Documents per code; a code below 0 counts for nothing."""
    pairs = np.unique((doc * most + code)[code >= 0])
    return np.bincount(pairs % most, minlength=most)


def _feature_counts(sample: Sample, toxic: tuple[np.ndarray, np.ndarray], clean: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(features, toxic documents, clean documents) for whole words, then for their beginnings."""
    words = list(sample.number)
    for size in (0, 4, 5, 6):
        if size:
            number: dict[str, int] = {}
            code = np.array([number.setdefault(w[:size], len(number)) if len(w) > size else -1 for w in words] + [-1], dtype=np.int64)
            names = list(number)
        else:
            code, names = np.arange(len(words) + 1), ["=" + w for w in words]
        bad, good = (_documents_with(doc, code[word], max(len(names), 1)) for doc, word in (toxic, clean))
        yield names, bad, good


def _telling_features(sample: Sample) -> list[str]:
    """The features that tell toxic texts, most telling first."""
    n, m = len(sample.rows[1]), len(sample.rows[0])
    told: list[dict[str, float]] = []
    for cut in (_all_words, _own_words):
        told.append({})
        for names, bad, good in _feature_counts(sample, cut(sample.rows[1]), cut(sample.rows[0])):
            for i in np.flatnonzero((bad >= LEAST_DOCS) & (bad * m >= LIFT * good * n)).tolist():
                x = surprise(int(bad[i]), n, int(good[i]), m)
                if x >= SURPRISE:
                    told[-1][names[i]] = x
    kept = {f: x for f, x in told[1].items() if f in told[0]}
    return sorted(kept, key=lambda f: (-kept[f], f))[:MAX_FEATURES]


def _windows(sample: Sample, of_word: dict[int, list[int]]) -> list[tuple[list[list[int]], list[int]]]:
    """Up to WINDOWS windows with their tags, half of them with a telling token."""
    tells = np.zeros(len(sample.number) + 1, dtype=bool)
    tells[list(of_word)] = True
    found: dict[bool, list[tuple[int, int, int]]] = {True: [], False: []}
    for y, rows in sample.rows.items():
        for r, row in enumerate(rows):
            if len(row):
                starts = np.arange(0, len(row), WINDOW)
                for at, some in zip(starts.tolist(), np.logical_or.reduceat(tells[row], starts).tolist()):
                    found[some].append((y, r, at))
    half = WINDOWS // 2
    pick = lambda w: w if len(w) <= half else [w[i * len(w) // half] for i in range(half)]
    out = []
    for y, r, at in pick(found[True]) + pick(found[False]):
        feats = [of_word.get(w, []) for w in sample.rows[y][r][at:at + WINDOW].tolist()]
        out.append((feats, [1 if y and f else 0 for f in feats]))
    return out


def fit(rows: Iterable[tuple[str | None, int]]) -> ToxicModel:
    """A model from (text, toxic) rows; they are read once, and only their token numbers are kept."""
    sample, model = Sample(), ToxicModel()
    for text, toxic in rows:
        sample.add(text, toxic)
    if not sample.rows[0] or not sample.rows[1]:
        return model
    number = {f: i for i, f in enumerate(_telling_features(sample))}
    of_word = {i: own for w, i in sample.number.items() if (own := [number[f] for f in features(w) if f in number])}
    if not of_word:
        return model
    weight = _fit_chain(model, _windows(sample, of_word), len(number))
    model.weight = {f: round(float(weight[i]), 6) for f, i in number.items() if abs(weight[i]) > 1e-3}
    # the document score: logistic model on the marginals' sum and maximum
    emission = np.zeros(len(sample.number) + 1)
    for w, i in sample.number.items():
        if i in of_word:
            emission[i] = model.emission(w)
    x, y = [], []
    for toxic, rows in sample.rows.items():
        for row in rows:
            at = np.flatnonzero(emission[row])
            found = model.marginals(list(zip(at.tolist(), emission[row[at]].tolist())), len(row))
            x.append((1.0, math.log1p(sum(found)), max(found, default=0.0)))
            y.append(toxic)
    x, y = np.array(x), np.array(y, dtype=float)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    doc = np.zeros(3)
    for _ in range(60):                                     # Newton steps with a small ridge, classes weighed alike
        p = 1 / (1 + np.exp(-np.clip(x @ doc, -30, 30)))
        grad = x.T @ (share * (y - p)) - 1e-4 * doc
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
        doc = doc + np.clip(np.linalg.solve(bend, grad), -2, 2)
    doc[0] = min(doc[0], NO_TOKEN)                          # a text without toxic tokens is never rejected
    z = np.clip(x @ doc, -30, 30)
    model.doc = doc
    model.fitted = bool((share * (y * z - np.log1p(np.exp(z)))).sum() > -math.log(2))       # better than no model
    return model


def held_out(id_column: Column, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          fold: int | None = 0) -> ToxicModel:
    """Fits on all labelled rows and their whole texts, leaving out the ids of one fold in five.

    A row per feature, window length or sum reaches the driver, never a text.
    """
    spark, model = docs.sparkSession, ToxicModel()
    ensure_checkpoint_dir(spark)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    if fold is not None:
        known, texts = known.where(~held_out(F.col("_id"), fold)), texts.where(~held_out(F.col("_id"), fold))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    labelled = sized_join(texts, known, ["_id"], max_broadcast_rows=BROADCAST_LABELS).select("_y", "_text")
    folder = f"{spark.sparkContext.getCheckpointDir()}/toxic-{uuid.uuid4()}"
    (labelled.mapInArrow(_cut, "_y int, _mark binary, _words string").groupBy("_y", "_mark").agg(F.first("_words").alias("_words"))
     .write.option("compression", "zstd").parquet(folder))                               # copies once
    rows = spark.read.parquet(folder)
    count = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return model
    told = _most_telling(rows.select("_y", "_words").mapInArrow(_count_features, "f string, bad long, good long"), count)
    told = _most_telling(_own_counts(rows, told), count) if told else told
    if not told:
        return model
    _fit_blocks(model, rows, told)
    _fit_document_score(model, rows, count)
    return model


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, mark of the token list, its words) of labelled texts."""
    for batch in batches:
        words = [" ".join(lower_words(t)) for t in batch.column("_text").to_pylist()]
        marks = [hashlib.blake2b(w.encode(), digest_size=16).digest() for w in words]
        yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(marks, pa.binary()), pa.array(words, pa.string())], ["_y", "_mark", "_words"])


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic documents, clean documents) of a task's rows, added up over COUNT_AT_ONCE tokens."""
    sample, size = Sample(), 0

    def out() -> Iterator[pa.RecordBatch]:
        for names, bad, good in _feature_counts(sample, _all_words(sample.rows[1]), _all_words(sample.rows[0])):
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bad), pa.array(good)], ["f", "bad", "good"])

    for batch in batches:
        for y, text in zip(batch.column("_y").to_pylist(), batch.column("_words").to_pylist()):
            words = text.split()
            sample.add_words(words, y)
            size += len(words)
            if size >= COUNT_AT_ONCE:
                yield from out()
                sample, size = Sample(), 0
    yield from out()


def _most_telling(counts: DataFrame, count: dict[int, int]) -> list[str]:
    """The features of (f, bad, good) that pass, most telling first."""
    n, m = float(count[1]), float(count[0])
    a, b = F.col("bad").cast("double"), F.col("good").cast("double")
    share = (a + b) / (n + m)
    cells = ((a, n * share), (n - a, n * (1 - share)), (b, m * share), (m - b, m * (1 - share)))
    surprising = 2 * sum((F.when(x > 0, x * F.log(x / e)).otherwise(0.0) for x, e in cells), F.lit(0.0))
    sums = counts.groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    passed = sums.where((a >= LEAST_DOCS) & (a * m >= LIFT * b * n)).select("f", surprising.alias("x")).where(F.col("x") >= SURPRISE)
    return [r["f"] for r in passed.orderBy(F.desc("x"), "f").limit(MAX_FEATURES).collect()]


class _Tells:
    """The kept features of words, by number, with a bounded memory."""

    def __init__(self, told: list[str]) -> None:
        self.number = {f: i for i, f in enumerate(told)}
        self.words: dict[str, list[int]] = {}

    def __getstate__(self) -> dict:
        return {"number": self.number, "words": {}}

    def of(self, words: list[str]) -> list[tuple[int, list[int]]]:
        """(position, feature numbers) of the words that have any."""
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        known, number = self.words, self.number
        out = []
        for i, w in enumerate(words):
            if w not in known:
                known[w] = [number[f] for f in features(w) if f in number]
            if known[w]:
                out.append((i, known[w]))
        return out


def _own_counts(rows: DataFrame, told: list[str]) -> DataFrame:
    """(f, bad, good): documents with the features ``told`` outside the passages that another text of the label, earlier by its mark, has too."""
    shared = rows.sparkSession.sparkContext.broadcast(_Tells(told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells = shared.value
        for batch in batches:
            out: list[tuple] = []
            for y, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                met = tells.of(words)
                if not met:
                    continue
                grams = []
                if len(words) >= PASSAGE:
                    code = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], dtype=np.uint64)
                    grams = _passages(code).view(np.int64)
                out += [(y, row, i, fs, list(grams[max(0, i - PASSAGE + 1):i + 1])) for i, fs in met]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())))], ["_y", "_row", "_at", "fs", "grams"])

    met = rows.select("_y", F.xxhash64("_mark").alias("_row"), "_words").mapInArrow(
        run, "_y int, _row long, _at int, fs array<int>, grams array<long>").checkpoint()
    grams = met.select("_y", "_row", "_at", F.explode("grams").alias("_gram"))
    repeated = (grams.groupBy("_y", "_gram").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last")).where("_first < _last")
                .select("_y", "_gram", "_first").checkpoint())
    covered = sized_join(grams, repeated, ["_y", "_gram"]).where("_row != _first").select("_y", "_row", "_at").distinct()
    own = met.join(covered, ["_y", "_row", "_at"], "left_anti").select("_y", "_row", F.explode("fs").alias("i")).distinct()
    counts = own.groupBy("i").agg(F.sum("_y").alias("bad"), F.sum(1 - F.col("_y")).alias("good"))
    names = rows.sparkSession.createDataFrame(list(enumerate(told)), "i int, f string")
    return counts.join(F.broadcast(names), "i").select("f", "bad", "good")


def _fit_blocks(model: ToxicModel, rows: DataFrame, told: list[str]) -> None:
    """The chain's weights: those of the blocks of windows, averaged."""
    shared = rows.sparkSession.sparkContext.broadcast(_Tells(told))
    half, n_features = WINDOWS // 2, len(told)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells, names = shared.value, ["_y", "size", "n", "at", "f"]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        plain = np.zeros(WINDOW + 1, dtype=np.int64)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for batch in batches:
            out = []
            for y, text in zip(batch.column("_y").to_pylist(), batch.column("_words").to_pylist()):
                words = text.split()
                whole, rest = divmod(len(words), WINDOW)
                plain[WINDOW] += whole
                plain[rest] += 1
                inside: dict[int, list[tuple[int, int]]] = {}
                for i, fs in tells.of(words):
                    inside.setdefault(i // WINDOW, []).extend((i % WINDOW, f) for f in fs)
                for k, pairs in inside.items():
                    size = min(WINDOW, len(words) - k * WINDOW)
                    plain[size] -= 1
                    out.append((y, size, 1, [a for a, _ in pairs], [f for _, f in pairs]))
            if out:
                yield batch_of(out)
        yield batch_of([(None, size, int(plain[size]), None, None) for size in range(1, WINDOW + 1)])

    windows = rows.select("_y", "_words").mapInArrow(cut, "_y int, size int, n long, at array<int>, f array<int>").checkpoint()
    sizes = windows.where("_y IS NULL").groupBy("size").agg(F.sum("n").alias("n")).where("n > 0").orderBy("size").collect()
    telling = windows.where("_y IS NOT NULL")
    blocks = max(1, -(-telling.count() // half))
    every = sum(r["n"] for r in sizes) / blocks
    plain = [(r["size"], r["n"] / blocks * min(1.0, half / every)) for r in sizes]

    def fit_block(table: pa.Table) -> pa.Table:
        some, times, own = [], [], ToxicModel()
        for y, size, at, f in zip(*(table.column(c).to_pylist() for c in ("_y", "size", "at", "f"))):
            feats: list[list[int]] = [[] for _ in range(size)]
            for a, i in zip(at, f):
                feats[a].append(i)
            some.append((feats, [1 if y and fs else 0 for fs in feats]))
            times.append(1.0)
        tokens = float(sum(len(tag) for _, tag in some))
        for size, n in plain:
            some.append(([[] for _ in range(size)], [0] * size))
            times.append(n)
        weight = _fit_chain(own, some, n_features, times)
        seen = np.bincount(np.concatenate([np.asarray(x, dtype=np.int64) for x in table.column("f").to_pylist()]), minlength=n_features)
        i = np.flatnonzero(seen)
        return pa.table({"i": pa.array(np.concatenate([i, -1 - np.arange(5)]), pa.int32()),
                         "w": np.concatenate([weight[i], [own.bias], own.move.ravel()]), "seen": np.concatenate([seen[i].astype(float), np.full(5, tokens)])})

    dealt = telling.withColumn("_block", F.pmod(F.xxhash64("_y", "size", "at", "f", F.monotonically_increasing_id()), F.lit(blocks)))
    fitted = dealt.repartition(blocks, "_block").groupBy("_block").applyInArrow(fit_block, "i int, w double, seen double")
    mean = {r["i"]: r["w"] for r in fitted.groupBy("i").agg((F.sum(F.col("w") * F.col("seen")) / F.sum("seen")).alias("w")).collect()}
    model.bias, model.move = mean[-1], np.array([mean[-2 - k] for k in range(4)]).reshape(2, 2)
    model.weight = {f: round(mean[i], 6) for i, f in enumerate(told) if abs(mean.get(i, 0.0)) > 1e-3}


def _fit_document_score(model: ToxicModel, rows: DataFrame, count: dict[int, int]) -> None:
    """The document score's weights: Newton steps with a small ridge, classes weighed alike, every sum over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, plain = shared.value, [0, 0]
        for batch in batches:
            out: list[tuple] = []
            for y, text in zip(batch.column("_y").to_pylist(), batch.column("_words").to_pylist()):
                words = text.split()
                events = own.telling(words)
                if events:
                    found = own.marginals(events, len(words))
                    out.append((y, math.log1p(sum(found)), max(found), 1))
                else:
                    plain[y] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["y", "a", "b", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0.0, 0.0]), pa.array([0.0, 0.0]), pa.array(plain)], ["y", "a", "b", "n"])

    known = rows.select("_y", "_words").mapInArrow(run, "y long, a double, b double, n long").where("n > 0").checkpoint()
    x = (F.lit(1.0), F.col("a"), F.col("b"))
    share = F.col("n") * F.when(F.col("y") == 1, 0.5 / count[1]).otherwise(0.5 / count[0])

    def log_odds(doc: np.ndarray) -> Column:
        z = sum((F.lit(float(d)) * c for d, c in zip(doc, x)), F.lit(0.0))
        return F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))

    doc = np.zeros(3)
    places = [(i, j) for i in range(3) for j in range(i, 3)]
    for _ in range(60):
        p = 1 / (1 + F.exp(-F.col("z")))
        r = known.withColumn("z", log_odds(doc)).agg(*[F.sum(share * (F.col("y") - p) * c) for c in x], *[F.sum(share * p * (1 - p) * x[i] * x[j]) for i, j in places]).first()
        grad, bend = np.array(r[:3]) - 1e-4 * doc, 1e-4 * np.eye(3)
        for (i, j), v in zip(places, r[3:]):
            bend[i, j] += v
            bend[j, i] = bend[i, j]
        step = np.clip(np.linalg.solve(bend, grad), -2, 2)
        doc = doc + step
        if np.abs(step).max() < 1e-9:
            break
    doc[0] = min(doc[0], NO_TOKEN)                          # a text without toxic tokens is never rejected
    z = F.col("z")
    gained = known.withColumn("z", log_odds(doc)).agg(F.sum(share * (F.col("y") * z - F.log1p(F.exp(z))))).first()[0]
    model.doc = doc
    model.fitted = gained > -math.log(2)                    # better than no model


def passages(text: Column) -> Column:
    """A text of up to SAMPLE_CHARS characters; of a longer one, passages of that many together, spread evenly from its start to its end."""
    size = SAMPLE_CHARS // PASSAGES
    starts = F.sequence(F.lit(0), F.lit(PASSAGES - 1))
    cut = F.transform(starts, lambda k: F.substring(text, F.floor(k * (F.char_length(text) - size) / (PASSAGES - 1)).cast("int") + 1, F.lit(size)))
    return F.when(F.char_length(text) <= SAMPLE_CHARS, text).otherwise(F.array_join(cut, "\n"))


def score_column(model: ToxicModel):
    """Column function: text -> (score, spans)."""
    @F.pandas_udf("struct<score: double, spans: array<struct<start: int, end: int, p: double>>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [model.read(t) for t in texts]
        return pd.DataFrame({"score": [s for s, _ in rows], "spans": [[{"start": a, "end": b, "p": p} for a, b, p in spans] for _, spans in rows]})
    return run


def score_documents(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, predicted and the offending spans."""
    out = docs.select(F.col(id_col), score_column(model)(F.col(text_col).cast("string")).alias("_s"))
    return out.select(id_col, "_s.score", (F.col("_s.score") >= 0.5).cast("int").alias("predicted"), "_s.spans")


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """The rows whose score is under 1/2, with all their columns."""
    own = docs.select(F.struct("*").alias("_row"), score_column(model)(F.col(text_col).cast("string")).alias("_s"))
    return own.where(F.col("_s.score") < 0.5).select("_row.*")
