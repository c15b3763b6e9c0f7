"""Operator 9: secrets by patterns and by two character Markov models (built-in functions only).

Base spans: three fixed patterns, leftmost and without overlap per kind, kept if long enough.
A pattern's matches and the gaps between them come from one scan each; their lengths in code
points give the offsets.

Method: a candidate is a maximal run of ``LEAST`` or more token characters that holds a letter; of a run that
meets base spans, the parts outside them are candidates if they are as long.  Two first-order character models, one of random
strings and one of ordinary identifiers and words, give its log-likelihood ratio; a ratio of the whole candidate above
one threshold adds a span of kind ``markov``, whatever its length and its kinds of characters.

* The models are trained on all rows, labelled by the base patterns: the values that these found
  are random strings; the other tokens too short for a candidate (longer ones may be secrets)
  are ordinary, each different one once: few words say little
  about others, and the model then stays near the characters' shares.
* A random string draws from the kinds of characters that it shows (small letters, capitals, digits, signs): with
  ``TRAINED`` its next character comes from the trained table of random strings, otherwise evenly from those kinds.  So a
  string of letters is not held to be ordinary because the labelled values hold digits.
* The threshold is what all but one in a thousand of the different candidates outside the base patterns' matches stay under, counted by hundredths
  of a nat, but at least ``EVIDENCE`` and at most ``MOST_EVIDENCE`` nats (they may hold secrets too); with under a thousand of them it is ``EVIDENCE``.

A model is a table over pairs of ``SYMBOLS``, whatever the size of the input.

Results for odd input: null and empty texts have no spans; an empty table gives no rows;
repeated rows give repeated results; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns: kind, pattern, capture group that is measured, its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),      # the runs of 32 or more among all runs
)
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST = 12                  # characters of a candidate
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % LEAST
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,11}(?![A-Za-z0-9+/_=-])"      # a whole token, too short for a candidate
PRIOR = 100.0               # pairs' worth of the character shares in every row of a model
TRAINED = 0.2               # share of the trained table in the model of random strings
EVIDENCE, MOST_EVIDENCE = 12.0, 20.0        # nats of a whole candidate
GRADES = 100                # of a nat, in which the threshold is counted
CHARACTERS = (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), ("[+/_=-]", 5))      # kinds, and how many there are
MASK = "[secret]"


def _text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Array of (start, end, value) of a pattern's matches whose measured group is long enough."""
    whole, part = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("value"))
    none = F.array().cast("array<struct<start: int, end: int, value: string>>")

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.char_length(m["gap"])
        end = start + F.char_length(m["whole"])
        span = F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"))
        keep = F.char_length(m["value"]) >= least
        return F.struct(F.coalesce(end, start).alias("at"), F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(found, start, step, lambda s: s["spans"])).otherwise(none)


def with_base(rows: DataFrame, text: str = "_text") -> DataFrame:
    return rows.withColumns({f"_{kind}": _matches(F.col(text), pattern, group, least) for kind, pattern, group, least in KINDS})


def _tagged(column: str, rank: int, kind: str) -> Column:
    return F.transform(F.col(column), lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def _pairs(strings: DataFrame, column: str) -> DataFrame:
    """(pair of neighbour characters, count) over all strings, counted before the shuffle."""
    at = F.sequence(F.lit(1), F.char_length(column) - 1)
    pairs = strings.where(F.char_length(column) > 1).select(F.explode(F.transform(at, lambda i: F.substring(F.col(column), i, F.lit(2)))).alias("pair"))
    return pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _log_model(counts: dict[str, int]) -> list[float]:
    """log P(next | character) for every pair of symbols, drawn towards the model's own character shares."""
    seen = {b: 0.5 + sum(counts.get(a + b, 0) for a in SYMBOLS) for b in SYMBOLS}
    every = sum(seen.values())
    out = []
    for a in SYMBOLS:
        total = sum(counts.get(a + b, 0) for b in SYMBOLS) + PRIOR
        out += [math.log((counts.get(a + b, 0) + PRIOR * seen[b] / every) / total) for b in SYMBOLS]
    return out


@dataclass
class Models:
    """P(next | character) of random strings, log P of ordinary ones, for every pair of symbols; the threshold in nats."""

    random: list[float]
    ordinary: list[float]
    evidence: float = EVIDENCE

    def ratio(self, s: str) -> float:
        """Log-likelihood ratio of a whole string."""
        even = (1 - TRAINED) / sum(n for kind, n in CHARACTERS if re.search(kind, s))
        at = [SYMBOLS.index(a) * len(SYMBOLS) + SYMBOLS.index(b) for a, b in zip(s, s[1:])]
        return sum(math.log(even + TRAINED * self.random[i]) - self.ordinary[i] for i in at)

    def column(self, value: Column) -> Column:
        """The same of a column."""
        random, ordinary = (F.from_json(F.lit(json.dumps(t)), "array<double>") for t in (self.random, self.ordinary))
        code = lambda i: F.instr(F.lit(SYMBOLS), F.substring(value, i, F.lit(1))) - 1
        kinds = sum((F.when(value.rlike(kind), n).otherwise(0) for kind, n in CHARACTERS), F.lit(0))

        def step(even: Column) -> Column:
            def add(acc: Column, i: Column) -> Column:
                pair = F.get(F.transform(F.array(code(i) * len(SYMBOLS) + code(i + 1)), lambda k: F.log(even + TRAINED * F.get(random, k)) - F.get(ordinary, k)), F.lit(0))
                return acc + pair
            return F.aggregate(F.sequence(F.lit(1), F.char_length(value) - 1), F.lit(0.0), add)

        return F.get(F.transform(F.array((1 - TRAINED) / kinds), step), F.lit(0))


def train(docs: DataFrame, text_col: str = "text") -> Models:
    """The two models and the threshold, from all rows.

    Only pair counts reach the driver, at most ``len(SYMBOLS) ** 2`` for each model, and the candidates' numbers by grades of the ratio
    (a row for each grade between the least and the greatest threshold).
    """
    texts = docs.select(_text(F.col(text_col)).alias("_text"))
    base = with_base(texts)
    values = base.select(F.explode(F.concat(*[F.col(f"_{k[0]}") for k in KINDS])).alias("m")).select(F.col("m.value").alias("s"))
    bare = F.col("_text")
    for _, pattern, _, _ in KINDS:
        bare = F.regexp_replace(bare, pattern, " ")
    tokens = lambda pattern: F.regexp_extract_all("_bare", F.lit(pattern), F.lit(0))
    both = F.array_distinct(F.concat(tokens(WORD), F.filter(tokens(CANDIDATE), lambda s: s.rlike("[A-Za-z]"))))
    found = texts.select(bare.alias("_bare")).select(F.explode(both).alias("s")).distinct().checkpoint()       # a row per different token
    words, long = found.where(F.char_length("s") < LEAST), found.where(F.char_length("s") >= LEAST)
    known = F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")
    counts = (_pairs(values, "s").withColumn("model", F.lit("random"))
              .union(_pairs(words, "s").withColumn("model", F.lit("ordinary"))).where(known).collect())
    random = _log_model({r["pair"]: r["n"] for r in counts if r["model"] == "random"})
    ordinary = _log_model({r["pair"]: r["n"] for r in counts if r["model"] == "ordinary"})
    models = Models([math.exp(x) for x in random], ordinary)
    low, high = round(EVIDENCE * GRADES), round(MOST_EVIDENCE * GRADES)
    grade = F.least(F.greatest(F.ceil(models.column(F.col("s")) * GRADES), F.lit(low)), F.lit(high))
    graded = sorted((r["grade"], r["n"]) for r in long.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(k for _, k in graded)
    if n >= 1_000:
        under = accumulate(k for _, k in graded)
        models.evidence = next(g for (g, _), upto in zip(graded, under) if 1_000 * upto >= 999 * n) / GRADES
    return models


def _outside(m: Column) -> Column:
    """The parts of a run that no base span covers, if long enough."""
    def with_part(state: Column, start: Column, end: Column) -> Column:
        part = F.struct(start.alias("start"), end.alias("end"), F.substring(m["value"], start - m["start"] + 1, end - start).alias("value"))
        return F.when(end - start >= LEAST, F.concat(state["parts"], F.array(part))).otherwise(state["parts"])

    def step(state: Column, b: Column) -> Column:
        parts = with_part(state, state["at"], F.least(b["start"], m["end"]))
        return F.struct(F.greatest(state["at"], b["end"]).alias("at"), parts.alias("parts"))

    none = F.array().cast("array<struct<start: int, end: int, value: string>>")
    meets = F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    cut = F.aggregate("_base", F.struct(m["start"].alias("at"), none.alias("parts")), step, lambda s: with_part(s, s["at"], m["end"]))
    return F.when(meets, cut).otherwise(F.array(m))


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row as ``_row``, with ``_text``, the base spans and ``_spans``: all spans by start, then kind."""
    models = train(docs, text_col)
    rows = with_base(docs.select(F.struct("*").alias("_row"), _text(F.col(text_col)).alias("_text")))
    base = F.concat(*[_tagged(f"_{kind}", i, kind) for i, (kind, *_) in enumerate(KINDS)])
    rows = rows.withColumn("_base", F.array_sort(base)).withColumn("_candidates", _matches(F.col("_text"), CANDIDATE, 0, LEAST))
    rows = rows.withColumn("_candidates", F.flatten(F.transform("_candidates", _outside)))
    random = lambda m: m["value"].rlike("[A-Za-z]") & (models.column(m["value"]) > models.evidence)
    rows = rows.withColumn("_markov", F.when(F.size("_candidates") > 0, F.filter("_candidates", random)).otherwise(F.col("_candidates")))
    return rows.withColumn("_spans", F.array_sort(F.concat("_base", _tagged("_markov", len(KINDS), "markov")))).drop("_candidates", "_markov")


def _listed(column: str) -> Column:
    return F.array_join(F.transform(F.col(column), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans (kind:start:end, code points)."""
    rows = with_spans(docs.select(F.col(id_col), F.col(text_col)), text_col)
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(F.col("_row").getField(id_col).alias(id_col), *[F.size(f"_{k[0]}").cast("long").alias(f"n_{k[0]}") for k in KINDS],
                       count("markov").alias("n_markov"), F.sha2(_listed("_base"), 256).alias("base_sha256"), _listed("_spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The input with every span replaced by a mask (overlapping spans by one); rows without spans are unchanged."""
    rows = with_spans(docs, text_col)
    piece = lambda a, b: F.substring(F.col("_text"), a + 1, b - a)

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], piece(state["at"], s["start"]), F.lit(MASK))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("_spans", start, step, lambda s: F.concat(s["out"], piece(s["at"], F.char_length("_text"))))
    hit = F.size("_spans") > 0
    row = F.col("_row").withField(text_col, F.when(hit, masked).otherwise(F.col("_row").getField(text_col)))
    if length_col:
        old = F.col("_row").getField(length_col)
        row = row.withField(length_col, F.when(hit, F.char_length(masked)).otherwise(old).cast(docs.schema[length_col].dataType))
    return rows.select(row.alias("_row")).select("_row.*")
