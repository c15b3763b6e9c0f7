"""Operator 6: a gated recurrent language model scores whole documents.

Tokens: A-Z in lower case, words without ASCII white space, then one end.  The output softmax is
factored by class: P(token | before) = P(class | state) * P(token | class).

* The class of a token is a function of its characters: the ``TOP_WORDS`` most frequent training
  tokens have a class each; any other token belongs to (topic, ending, length), where the
  topic is the likeliest of ``TOPICS`` by the token's letter groups.  Expectation maximisation starts
  from a sample and then takes ``TOPIC_PASSES`` steps over all training rows.
* P(token | class) is the token's smoothed count (c + 0.5) over the sum of its class, which
  holds every training token of the corpus and one place for unseen tokens.  Counts cover
  all training rows and stay in a table.  The ``FREQUENT`` most frequent ones travel to the
  tasks; the other tokens of the documents are joined with the table.
* P(class | state) comes from a gated recurrent network (numpy), fitted with truncated
  backpropagation (windows of ``UNROLL`` tokens, the state carried over) on all training rows, whole
  texts of any length: every scan task runs over its own rows from the same first weights, and the tasks'
  weights are averaged by their tokens.  The first weights come from a sample.
* Texts are cut and classified once; a table in the checkpoint folder holds their class numbers, a byte each, which learning and scoring read.
* The sample, about ``SAMPLE_ROWS`` training rows (by a hash of the id, their first ``SAMPLE_CHARS`` characters),
  gives nothing but those two starts.  As rows are learned task by task, the weights depend on how
  the table is cut into files.

Scoring runs documents in ``LANES`` lanes side by side; a lane's state goes from window to window
until its document ends, however long it is, and is then set to zero.  A window's sums are added to its documents, so
memory does not follow the longest one.

Results for odd input: null and empty texts are one end token; without training tokens every token is
unseen (N = V = 0); an empty table gives no rows; repeated rows give repeated results;
other columns are ignored; a null id is never held out.
"""

from __future__ import annotations

import copy
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunk_tokens import slices
from .sampling import about

END = b""                                   # the end token; no word is empty
TOP_WORDS, TOPICS, TRIGRAMS = 40, 6, 1 << 12
ENDINGS, LENGTHS = 6, 2
HIDDEN, LANES, UNROLL = 24, 256, 32
OUTPUT_STEPS = 4                            # steps whose outputs are made together
SAMPLE_ROWS, SAMPLE_CHARS, EPOCHS, RATE = 1_500, 20_000, 3, 0.01
TOPIC_PASSES = 2                            # steps of expectation maximisation over all training rows
PASS_LANES, PASS_RATE = 256, 0.003          # of the pass of the network over all training rows
LEARN_AT_ONCE = 1_000_000                   # tokens that a task deals into lanes together
PARTS = 1 << 20                             # averaged weights are whole numbers of 1 / PARTS: sums are exact
FREQUENT = 200_000
TOPIC_BYTES = 1 << 20                       # bytes of text whose letter groups are counted together
SLICE_BYTES = 8 << 20                       # bytes of text that are cut into words together
COUNT_AT_ONCE = 600_000                     # different tokens counted before they are handed on
TOKENS_AT_ONCE = 5_000_000                  # tokens scored together in a task
LOG10 = math.log(10.0)
BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def tokens(text: str | None) -> list[bytes]:
    return (text.encode().lower().split() if text else []) + [END]


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(different words, number of each word of all texts in a row, words per text) without the end tokens."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    first = np.asarray(cut.offsets).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    if END in words:                                    # white space at an end of a text leaves an empty piece
        keep = code != words.index(END)
        code, row = code[keep], row[keep]
    return words, code, np.bincount(row, minlength=len(texts))


def held_out(id_column: Column, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == fold, F.lit(False))


class Classes:
    """Token -> class number, by its characters alone once the tables are learned."""

    def __init__(self, top: list[bytes], topic_of: np.ndarray):
        self.top = {w: i for i, w in enumerate(top)}
        self.topic_of = np.rint(topic_of * 1000).astype(np.int32)   # TRIGRAMS x TOPICS, whole numbers: sums are exact
        self.size = len(top) + TOPICS * ENDINGS * LENGTHS
        kind = np.full(256, 4)                                      # by the last byte: 4 or 5 for other signs
        kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
        kind[ord(".")], kind[ord(",")], kind[48:58] = 1, 2, 3
        self.ending = kind

    @staticmethod
    def groups(word: bytes) -> list[int]:
        w = b" " + word + b" "
        return [(w[i] * 961 + w[i + 1] * 31 + w[i + 2]) % TRIGRAMS for i in range(len(w) - 2)]

    def of(self, words: list[bytes]) -> np.ndarray:
        """Class numbers of many tokens at once."""
        if not words:
            return np.zeros(0, dtype=np.int32)
        text = np.frombuffer(b" " + b" ".join(words) + b"  ", dtype=np.uint8).astype(np.int32)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])     # the space before each word
        votes = self.topic_of[(text[:-2] * 961 + text[1:-1] * 31 + text[2:]) & (TRIGRAMS - 1)]
        votes[text[1:-1] == 32] = 0                                 # groups across two words
        topic = np.add.reduceat(votes, first, axis=0).argmax(axis=1)
        ending = self.ending[text[first + size]]
        ending = np.where((ending == 4) & (size > 1), 5, ending)
        out = (len(self.top) + (topic * ENDINGS + ending) * LENGTHS + (size > 7)).astype(np.int32)
        if self.top:
            known = [self.top.get(w, -1) for w in words]
            out = np.where(np.array(known) >= 0, known, out).astype(np.int32)
        return out


def learn_topics(docs: list[list[bytes]], seed: int = 7) -> np.ndarray:
    """Letter-group tables of TOPICS kinds of documents, by expectation maximisation."""
    x = np.zeros((max(len(docs), 1), TRIGRAMS))
    for r, words in enumerate(docs):
        for w, n in Counter(words).items():
            np.add.at(x[r], Classes.groups(w), n)
    rng = np.random.default_rng(seed)
    share = rng.dirichlet(np.ones(TOPICS), size=len(x))
    start = x / np.maximum(x.sum(1, keepdims=True), 1)
    centres = [0]
    for _ in range(TOPICS - 1):                         # spread first guesses: the farthest document each time
        far = np.min([((start - start[c]) ** 2).sum(1) for c in centres], axis=0)
        centres.append(int(far.argmax()))
    for k, c in enumerate(centres):
        share[c] = 0.01
        share[c, k] = 1.0
    table = np.log((start[centres] + 1e-4) / (start[centres] + 1e-4).sum(1, keepdims=True))
    for _ in range(12):
        table = _topic_table(_topic_mass(start, table))
    return table.T.astype(np.float32)


def _topic_mass(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """TOPICS x TRIGRAMS: the documents' shares of letter groups (rows of x), dealt to the topics they are likely of."""
    score = x @ table.T * 200
    share = np.exp(score - score.max(1, keepdims=True))
    share /= share.sum(1, keepdims=True)
    return share.T @ x


def _topic_table(mass: np.ndarray) -> np.ndarray:
    mass = mass + 1e-4
    return np.log(mass / mass.sum(1, keepdims=True))


def _group_shares(texts: list[str | None]) -> np.ndarray:
    """Share of each letter group in every document."""
    rows = [b" " + (t or "").encode().lower().translate(BLANKS) + b" " for t in texts]
    text = np.frombuffer(b"".join(rows) + b"  ", dtype=np.uint8).astype(np.int32)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    group = (text[:-2] * 961 + text[1:-1] * 31 + text[2:]) & (TRIGRAMS - 1)
    inner = text[1:-1] != 32
    x = np.bincount((doc * TRIGRAMS + group)[inner], minlength=len(rows) * TRIGRAMS).astype(np.float64).reshape(len(rows), TRIGRAMS)
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1)


def refine_topics(texts: DataFrame, topic_of: np.ndarray) -> np.ndarray:
    """One step of expectation maximisation over all rows of one text column; sums reach the driver, one for each cell."""
    table = topic_of.T.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros((TOPICS, TRIGRAMS))
        for batch in batches:
            for at, n in slices(batch.column(0), TOPIC_BYTES):
                for k in range(at, at + n, 256):
                    some = batch.column(0).slice(k, min(256, at + n - k)).to_pylist()
                    mass += _topic_mass(_group_shares(some), table)
        sums = np.rint(mass * PARTS).astype(np.int64).ravel()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["k", "v"])

    mass = np.zeros(TOPICS * TRIGRAMS)
    for r in texts.mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect():
        mass[r["k"]] = r["v"] / PARTS
    return _topic_table(mass.reshape(TOPICS, TRIGRAMS)).T.astype(np.float32) if mass.any() else topic_of


class GRU:
    """Input: the last class (``size``: none yet). Output: log P(next class)."""

    NAMES = ("x", "u", "b", "o", "c")

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.size, self.hidden = size, hidden
        self.x, self.u, self.b = draw(size + 1, 3 * hidden), draw(hidden, 3 * hidden), np.zeros(3 * hidden, np.float32)
        self.o, self.c = draw(hidden, size), np.zeros(size, np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_room"}

    def room(self, steps: int, lanes: int) -> dict[str, np.ndarray]:
        """Arrays of a window of this shape, used again and again; what a step or an output block needs stays in the processor's cache."""
        rooms = self.__dict__.setdefault("_room", {})
        if (steps, lanes) not in rooms:
            if len(rooms) >= 4:
                rooms.clear()
            h, new = self.hidden, lambda *shape: np.empty(shape, self.x.dtype)
            rows = min(steps, OUTPUT_STEPS) * lanes
            rooms[steps, lanes] = {"a": new(lanes, 3 * h), "r": new(lanes, 3 * h), "z": new(steps, lanes, 2 * h), "new": new(steps, lanes, h),
                                   "rn": new(steps, lanes, h), "state": new(steps, lanes, h), "after": np.ones((steps, lanes, h + 1), self.x.dtype),
                                   "p": new(rows, self.size), "sum": new(rows, 1), "row": np.arange(rows), "one": np.ones((self.size, 1), self.x.dtype),
                                   "d": new(steps, lanes, h), "da": new(steps, lanes, 3 * h), "dr": new(steps, lanes, 3 * h), "t": new(lanes, h)}
        return rooms[steps, lanes]

    def forward(self, before: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> dict[str, np.ndarray]:
        """States of a window of steps x lanes; ``after`` has a last column of ones, for the outputs' constants."""
        (steps, lanes), h = before.shape, self.hidden
        w, begun, xb = self.room(steps, lanes), fresh.any(axis=1), self.x + self.b
        a, r = w["a"], w["r"]
        for t in range(steps):
            np.take(xb, before[t], axis=0, out=a)
            s, z, rn, new, after = w["state"][t], w["z"][t], w["rn"][t], w["new"][t], w["after"][t, :, :h]
            s[...] = state
            if begun[t]:
                s[fresh[t]] = 0
            np.matmul(s, self.u, out=r)
            np.add(a[:, :2 * h], r[:, :2 * h], out=z)
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            rn[...] = r[:, 2 * h:]
            np.multiply(z[:, h:], rn, out=new)
            new += a[:, 2 * h:]
            np.tanh(new, out=new)
            np.subtract(new, s, out=after)
            after *= z[:, :h]
            after += s
            state = after
        return w

    def outputs(self, w: dict[str, np.ndarray]) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(rows, states with ones, scores of all classes) of a window, a few steps at a time."""
        flat = w["after"].reshape(-1, self.hidden + 1)
        weight = np.concatenate([self.o, self.c[None]])
        tame = float(np.abs(weight).sum(axis=0).max()) < 30                  # states lie between -1 and 1
        for at in range(0, len(flat), len(w["p"])):
            rows = slice(at, min(at + len(w["p"]), len(flat)))
            p = w["p"][:rows.stop - at]
            np.matmul(flat[rows], weight, out=p)
            if not tame:
                np.clip(p, -30, 30, out=p)
            yield rows, flat[rows], p

    def window(self, before: np.ndarray, target: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple:
        """One truncated backpropagation over T x lanes; (loss, gradients, last state)."""
        (steps, lanes), h = before.shape, self.hidden
        w = self.forward(before, fresh, state.astype(self.x.dtype))
        goal, loss, g_out, d_flat, o_t = target.ravel(), 0.0, 0, w["d"].reshape(-1, h), np.ascontiguousarray(self.o.T)
        for rows, after, p in self.outputs(w):
            total, row = w["sum"][:len(p)], w["row"][:len(p)]
            np.exp(p, out=p)
            np.matmul(p, w["one"], out=total)
            np.reciprocal(total, out=total)
            p *= total
            loss -= float(np.log(p[row, goal[rows]]).sum())
            p[row, goal[rows]] -= 1
            np.matmul(p, o_t, out=d_flat[rows])
            g_out = g_out + after.T @ p
        back, t_, u_t, begun = 0, w["t"], np.ascontiguousarray(self.u.T), fresh.any(axis=1)
        for t in range(steps - 1, -1, -1):
            d, s, new, z, reset = w["d"][t], w["state"][t], w["new"][t], w["z"][t, :, :h], w["z"][t, :, h:]
            g, q = w["da"][t], w["dr"][t]
            d += back
            d_new, d_z, d_reset = g[:, 2 * h:], g[:, :h], g[:, h:2 * h]
            np.multiply(d, z, out=t_)                       # d z
            np.multiply(new, new, out=d_new)
            np.subtract(1, d_new, out=d_new)
            d_new *= t_                                     # d z (1 - new^2)
            np.subtract(new, s, out=d_z)
            d_z *= t_
            back = d - t_                                   # d (1 - z)
            np.subtract(1, z, out=t_)
            d_z *= t_                                       # d (new - s) z (1 - z)
            np.subtract(1, reset, out=t_)
            t_ *= reset
            t_ *= w["rn"][t]
            np.multiply(d_new, t_, out=d_reset)
            q[:, :2 * h] = g[:, :2 * h]
            np.multiply(d_new, reset, out=q[:, 2 * h:])
            back += q @ u_t
            if begun[t]:
                back[fresh[t]] = 0
        da, dr = w["da"].reshape(-1, 3 * h), w["dr"].reshape(-1, 3 * h)
        g = {"o": g_out[:h], "c": g_out[h], "b": da.sum(0), "u": w["state"].reshape(-1, h).T @ dr, "x": np.zeros_like(self.x)}
        kind = before.ravel().astype(np.uint8 if self.size < 256 else np.int64)
        order = np.argsort(kind, kind="stable")
        seen, first = np.unique(kind[order], return_index=True)
        g["x"][seen] = np.add.reduceat(da[order], first, axis=0)
        return loss, g, w["after"][-1, :, :h].copy()

    def learn(self, docs: list[np.ndarray], lanes: int, rate: float, past: dict) -> int:
        """Adam over the documents' classes, dealt into lanes; ``past`` holds its averages. Number of tokens, none left out."""
        docs = [d.astype(np.int64) for d in docs if len(d)]
        if not docs:
            return 0
        target = np.concatenate(docs)
        before = np.concatenate([np.concatenate([[self.size], d[:-1]]) for d in docs])
        fresh = np.concatenate([np.arange(len(d)) == 0 for d in docs])
        lanes = max(1, min(lanes, len(target) // UNROLL))
        n = len(target) // lanes
        for a, b, lanes in ((0, n * lanes, lanes), (n * lanes, len(target), 1)):      # the rest is less than a token a lane
            t, f, s = (x[a:b].reshape(lanes, -1).T for x in (target, before, fresh))
            state = np.zeros((lanes, self.hidden), np.float32)
            for at in range(0, len(t), UNROLL):
                w = slice(at, at + UNROLL)
                _, g, state = self.window(f[w], t[w], s[w], state)
                past["done"] = done = past.get("done", 0) + 1
                share = min(1.0, t[w].size / (UNROLL * 8))                             # a window of few tokens moves the weights less
                for k in self.NAMES:
                    d = np.clip(g[k] / t[w].size, -1, 1)
                    m, v = past.get(k, (0.0, 0.0))
                    past[k] = m, v = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
                    getattr(self, k)[...] -= share * rate * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.99 ** done)) + 1e-6)
        return len(target)

    def fit(self, docs: list[np.ndarray], lanes: int = 64, epochs: int = EPOCHS) -> None:
        past: dict = {}
        for epoch in range(epochs):
            self.learn(docs, lanes, RATE / (1 + epoch), past)

    def log_likelihoods(self, docs: list[np.ndarray], lanes: int = LANES) -> np.ndarray:
        """Natural log P(classes) of every document; the state is carried through each whole document.

        Documents run in lanes, window after window; what a window gains is added to its documents, so memory
        follows the window and the tokens' class numbers, whatever the longest document.
        """
        out = np.zeros(len(docs))
        loads: list[list[int]] = [[] for _ in range(max(1, min(lanes, len(docs))))]
        size = np.zeros(len(loads), dtype=np.int64)
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):      # the longest document to the shortest lane
            if len(docs[i]):
                k = int(size.argmin())
                loads[k].append(i)
                size[k] += len(docs[i])
        loads = [loads[k] for k in np.argsort(-size, kind="stable") if loads[k]]
        none = np.zeros(0, np.uint8)
        flat = [np.concatenate([none, *[docs[i] for i in lane]]) for lane in loads]
        doc = [np.repeat(np.array(lane, dtype=np.int32), [len(docs[i]) for i in lane]) for lane in loads]
        lengths = np.array([len(f) for f in flat], dtype=np.int64)
        state, last = np.zeros((len(flat), self.hidden), self.x.dtype), np.full(len(flat), self.size)
        for at in range(0, int(lengths.max(initial=0)), UNROLL):
            live = int(np.searchsorted(-lengths, -at, side="left"))          # lanes longer than at
            steps = int(min(UNROLL, lengths[0] - at))
            target, of = np.zeros((steps, live), np.int64), np.full((steps, live), -1, np.int32)
            for k in range(live):
                some = flat[k][at:at + steps]
                target[:len(some), k], of[:len(some), k] = some, doc[k][at:at + steps]
            before = np.concatenate([last[None, :live], target[:-1]])
            above = np.concatenate([np.array([[d[at - 1] if at else -1 for d in doc[:live]]], dtype=np.int32), of[:-1]])
            fresh = above != of
            before[fresh] = self.size
            w = self.forward(before, fresh, state[:live])
            goal, gained = target.ravel(), np.empty(steps * live)
            for rows, _, p in self.outputs(w):
                total, row = w["sum"][:len(p)], w["row"][:len(p)]
                gained[rows] = p[row, goal[rows]]
                np.exp(p, out=p)
                np.matmul(p, w["one"], out=total)
                gained[rows] -= np.log(total[:, 0])
            inside = of.ravel() >= 0
            out += np.bincount(of.ravel()[inside], weights=gained[inside], minlength=len(docs))
            state, last = w["after"][-1, :, :self.hidden].copy(), target[-1]
        return out


def count_tokens(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of one text column; counted in every task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: dict[bytes, int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"])
        counts: dict[bytes, int] = {}
        for batch in batches:
            for at, n in slices(batch.column(0), SLICE_BYTES):
                words, code, per = split_words(batch.column(0).slice(at, n))
                for w, c in zip(words, np.bincount(code, minlength=len(words)).tolist()):
                    if c:
                        counts[w] = counts.get(w, 0) + c
                counts[END] = counts.get(END, 0) + len(per)
                if len(counts) >= COUNT_AT_ONCE:
                    yield out(counts)
                    counts = {}
        if counts:
            yield out(counts)

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _frequent(counts: DataFrame) -> tuple[dict[bytes, int], int]:
    """The most frequent tokens, at most FREQUENT, and the number of training rows (end tokens).

    Counts fall into buckets of nearly equal logarithm; buckets are taken from the top while they fit, so
    the driver gets one number a bucket and then the chosen tokens, no candidates.
    """
    bucket = F.floor(F.log2("c") * 32).cast("int")
    sizes = sorted(((r["b"], r["n"]) for r in counts.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, taken = None, 0
    for b, n in sizes:
        if taken + n > FREQUENT:
            break
        least, taken = b, taken + n
    ends = counts.where(F.col("word") == F.lit(bytearray(END))).first()
    chosen = counts.where(bucket >= least).collect() if least is not None else []
    return {bytes(r["word"]): r["c"] for r in chosen}, ends["c"] if ends else 0


def _class_sums(counts: DataFrame, classes: Classes) -> np.ndarray:
    """Sum of c + 0.5 by class, and half a count for each class's unseen tokens."""
    @F.pandas_udf("int")
    def class_of(words: pd.Series) -> pd.Series:
        return pd.Series(classes.of([bytes(w) for w in words]))

    rows = counts.select(class_of("word").alias("k"), "c").groupBy("k").agg(F.sum(F.col("c") + 0.5).alias("z")).collect()
    z = np.full(classes.size, 0.5)
    for r in rows:
        z[r["k"]] += r["z"]
    return z


def refine_network(kinds: DataFrame, model: GRU) -> GRU:
    """The network after a pass over all rows of one column of class numbers (a byte each): every task learns its rows, weights are averaged by tokens.

    Weights are summed as whole numbers of 1 / PARTS times tokens, in decimals of 38 digits: exact, and without overflow.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, past, done, waiting, size = copy.deepcopy(model), {}, 0, [], 0
        for batch in batches:
            for row in batch.column(0):
                waiting.append(np.frombuffer(row.as_buffer(), dtype=np.uint8))
                size += len(waiting[-1])
                if size >= LEARN_AT_ONCE:
                    done += own.learn(waiting, PASS_LANES, PASS_RATE, past)
                    waiting, size = [], 0
        done += own.learn(waiting, PASS_LANES, PASS_RATE, past)
        k, v = weighted(own, done)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(v, pa.decimal128(38, 0))], ["k", "v"])

    sums = {r["k"]: int(r["v"]) for r in kinds.mapInArrow(run, "k int, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return averaged(model, sums)


def weighted(model: GRU, tokens_: int) -> tuple[list[int], list[Decimal]]:
    """(number, weight times tokens) of every weight; number 0 has the tokens."""
    flat = np.concatenate([getattr(model, k).ravel() for k in model.NAMES]).astype(np.float64)
    values = [tokens_, *[w * tokens_ for w in np.rint(flat * PARTS).astype(np.int64).tolist()]]
    return list(range(len(values))), [Decimal(v) for v in values]


def averaged(model: GRU, sums: dict[int, int]) -> GRU:
    """The model with the weights that the sums of ``weighted`` give; without tokens its own."""
    out, at = copy.deepcopy(model), 1
    if sums.get(0):
        for k in out.NAMES:
            w = getattr(out, k)
            w[...] = np.array([sums[i] / sums[0] / PARTS for i in range(at, at + w.size)]).reshape(w.shape)
            at += w.size
    return out


def class_rows(rows: DataFrame, shared, id_type: str) -> DataFrame:
    """Per row of (_id, _text, _held): its place, number of tokens, known frequent ones, sum of their logs, class
    numbers (a byte each), sum of the classes' logs, and the other words with their counts.

    ``shared`` broadcasts (classes, frequent word -> (class, log), log sums by class).  Texts are cut and classified a batch at a time, each different word once.
    """
    schema = (f"_row long, _id {id_type}, held_out boolean, n_tokens long, known long, logs double, class_logs double, kinds binary, "
              "rest array<struct<word: binary, n: int>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, frequent, log_z = shared.value
        end_kind, end_log = frequent.get(END) or (int(classes.of([END])[0]), None)
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, n in slices(batch.column(1), SLICE_BYTES):
                words, code, per = split_words(batch.column(1).slice(at, n))
                found = [frequent.get(w) for w in words]
                other = [i for i, f in enumerate(found) if f is None]
                kind = np.array([-1 if f is None else f[0] for f in found], dtype=np.int64)
                if other:
                    kind[other] = classes.of([words[i] for i in other])
                log = np.array([0.0 if f is None else f[1] for f in found])
                is_known = np.array([f is not None for f in found], dtype=bool)
                row = np.repeat(np.arange(n), per)
                kinds, ends = kind[code], np.cumsum(per)
                known = np.bincount(row, weights=is_known[code], minlength=n).astype(np.int64) + (end_log is not None)
                logs = np.bincount(row, weights=log[code], minlength=n) + (end_log or 0.0)
                class_logs = np.bincount(row, weights=log_z[kinds], minlength=n) + log_z[end_kind]
                texts = np.insert(kinds, ends, end_kind).astype(np.uint8).tobytes()
                cut = np.concatenate([[0], np.cumsum(per + 1)]).tolist()
                rest_row, rest_code = row[~is_known[code]], code[~is_known[code]]
                pairs, times = np.unique(rest_row * max(len(words), 1) + rest_code, return_counts=True)
                rest_of = np.searchsorted(pairs, np.arange(n + 1) * max(len(words), 1))
                names = pa.array(words, pa.binary()).take(pa.array(pairs % max(len(words), 1)))
                entries, offsets = [names, pa.array(times.astype(np.int32))], rest_of.astype(np.int32)
                if end_log is None:                        # no training row: the end token is an unknown word like any other
                    shift = np.arange(n + 1)
                    entries = [pa.concat_arrays([names, pa.array([END], pa.binary())]).take(pa.array(np.insert(np.arange(len(pairs)), rest_of[1:], len(pairs)))),
                               pa.array(np.insert(times, rest_of[1:], 1).astype(np.int32))]
                    offsets = (rest_of + shift).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(entries, names=["word", "n"]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(place, place + n)), batch.column(0).slice(at, n), batch.column(2).slice(at, n), pa.array(per + 1), pa.array(known),
                    pa.array(logs), pa.array(class_logs), pa.array([texts[a:b] for a, b in zip(cut, cut[1:])], pa.binary()), rest],
                    ["_row", "_id", "held_out", "n_tokens", "known", "logs", "class_logs", "kinds", "rest"])
                place += n

    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int | None = 1,
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("_held", held_out(F.col("_id"), fold) if fold is not None else F.lit(False))
    train = rows.where(~F.col("_held"))
    counts = count_tokens(train.select("_text")).checkpoint()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = total["n"], total["v"]

    frequent, n_rows = _frequent(counts)
    top = sorted(frequent, key=lambda w: (-frequent[w], w))[:TOP_WORDS]
    if n_rows and END not in top:
        top.append(END)
    few = train.where(about(F.coalesce(F.col("_id").cast("string"), F.lit("")), sample_rows, n_rows))
    sample = few.select(F.substring("_text", 1, SAMPLE_CHARS).alias("_text")).limit(2 * sample_rows).collect()
    words = [tokens(t) for t in sorted(r["_text"] or "" for r in sample)]
    np.random.default_rng(5).shuffle(order := np.arange(len(words)))
    words = [words[i] for i in order]
    topic_of = learn_topics(words)
    for _ in range(TOPIC_PASSES if n_rows else 0):
        topic_of = refine_topics(train.select("_text"), topic_of)
    classes = Classes(top, topic_of)
    kinds = dict(zip(frequent, classes.of(list(frequent)).tolist()))
    log_z = np.log10(_class_sums(counts, classes))
    logs = {w: (kinds[w], math.log10(c + 0.5)) for w, c in frequent.items()}
    model = GRU(classes.size)
    model.fit([classes.of(w) for w in words])

    # texts are cut and classified once; learning and scoring read class numbers
    id_type = docs.schema[id_col].dataType.simpleString()
    folder = f"{spark.sparkContext.getCheckpointDir()}/gru-{uuid.uuid4()}"
    shared = spark.sparkContext.broadcast((classes, logs, log_z))              # at most FREQUENT tokens
    class_rows(rows.select("_id", "_text", "_held"), shared, id_type).write.option("compression", "zstd").parquet(folder)
    classed = spark.read.parquet(folder)
    if n_rows:
        model = refine_network(classed.where(~F.col("held_out")).select("kinds"), model)
    fitted = spark.sparkContext.broadcast(model)
    columns = ["_row", "_id", "held_out", "n_tokens", "known", "logs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.value

        def out(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            *kept, class_logs, kinds = pa.concat_batches(some).columns
            gained = model.log_likelihoods([np.frombuffer(k.as_buffer(), dtype=np.uint8) for k in kinds]) / LOG10
            return pa.RecordBatch.from_arrays([*kept, pa.array(gained - np.asarray(class_logs))], [*columns, "class_part"])

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += pc.sum(pc.binary_length(batch.columns[-1])).as_py() or 0
            if size >= TOKENS_AT_ONCE:
                yield out(waiting)
                waiting, size = [], 0
        if waiting:
            yield out(waiting)

    scored = classed.select(*columns, "class_logs", "kinds").mapInArrow(
        run, f"_row long, _id {id_type}, held_out boolean, n_tokens long, known long, logs double, class_part double")
    met = classed.select("_row", F.explode("rest").alias("w")).select("_row", "w.word", "w.n").join(counts, "word", "left")
    rest = met.groupBy("_row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("_logs"),
                                   F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("_known"))
    base = F.log10(F.lit(n_all + 0.5 * (v_all + 1)))
    all_logs = F.col("logs") + F.coalesce("_logs", F.lit(0.0))
    return (scored.join(rest, "_row", "left")
            .select(F.col("_id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
                    F.lit(n_all).cast("long").alias("train_tokens"), (all_logs - F.col("n_tokens") * base).alias("base_score"),
                    (all_logs + F.col("class_part")).alias("score")))
