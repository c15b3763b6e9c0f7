"""Operator 10: tool calls linked to results, ordered, validated and serialised (built-in functions only).

Calls and results meet in a hash join on the call's identifier.  A call's level in the
topological order is 0 without known predecessors, else one more than its predecessors'
highest: rounds take away the links from calls whose level is known; links that stay when a
round takes none away lie on or behind a cycle.  Only a link count reaches the driver.
Arguments are parsed to a variant value and checked against the tool's schema (a given, small
list): unknown tool, not an object, missing, mistyped or unknown arguments.  The line of a call
is canonical JSON: keys in order, no spaces, arguments with sorted keys.

Results for odd input: a call without result has status ``unanswered``, an identifier of
several results takes the smallest text and counts them, an unknown predecessor is no link, a
null identifier links to nothing; repeated calls are repeated in the result; empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY"}


def levels(calls: DataFrame, links: DataFrame) -> DataFrame:
    """(call_id, level) of the calls (call_id) under links (call_id, needs); null on or behind a cycle."""
    ids = calls.select("call_id").where("call_id IS NOT NULL").distinct().checkpoint()
    known = links.select("call_id", "needs").distinct().join(ids, "call_id", "left_semi")
    open_links = known.join(ids.select(F.col("call_id").alias("needs")), "needs", "left_semi").select("call_id", "needs").checkpoint()
    ready = ids.join(open_links, "call_id", "left_anti")
    out, level, n = ready.withColumn("level", F.lit(0)), 0, open_links.count()
    while n:
        rest = open_links.join(ready.select(F.col("call_id").alias("needs")), "needs", "left_anti").select("call_id", "needs").checkpoint()
        left = rest.count()
        if left == n:
            return out.union(rest.select("call_id").distinct().withColumn("level", F.lit(None).cast("int")))
        ready = open_links.select("call_id").distinct().join(rest, "call_id", "left_anti").checkpoint()
        level += 1
        out = out.union(ready.withColumn("level", F.lit(level)))
        open_links, n = rest, left
    return out


def quoted(text: Column) -> Column:
    """A string as JSON."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.coalesce(F.when(text.isNotNull(), F.substring(whole, F.lit(6), F.char_length(whole) - 6)), F.lit("null"))


def problems(name: Column, parsed: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Sorted array of what is wrong with the arguments; schemas: tool -> argument -> (kind, required)."""
    kind = F.schema_of_variant(parsed)
    keys = F.coalesce(F.map_keys(F.try_variant_get(parsed, "$", "map<string, variant>")), F.array().cast("array<string>"))
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, arguments in sorted(schemas.items()):
        found = [F.transform(F.array_except(keys, F.array(*[F.lit(a) for a in arguments])), lambda k: F.concat(F.lit("unknown "), k))]
        for a, (wanted, required) in sorted(arguments.items()):
            value = F.schema_of_variant(F.try_variant_get(parsed, f"$.{a}", "variant"))
            there = F.array_contains(keys, a)
            right = value.startswith("DECIMAL") | value.isin("DOUBLE", "BIGINT") if wanted == "number" else value.startswith(KINDS[wanted])
            wrong = F.when(there & ~F.coalesce(right, F.lit(False)), F.lit(f"mistyped {a}"))
            found.append(F.array(F.when(~there, F.lit(f"missing {a}")).otherwise(wrong) if required else wrong))
        out = F.when(name == tool, F.concat(*found)).otherwise(out)
    listed = F.array_sort(F.array_compact(out))
    return F.when(parsed.isNull(), F.array(F.lit("not JSON"))).when(~kind.startswith("OBJECT"), F.array(F.lit("not an object"))).otherwise(listed)


def link_calls(calls: DataFrame, results: DataFrame, links: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]],
               keep: list[str] | None = None) -> DataFrame:
    """One row per call: the kept columns, call_id, name, level, status, problems, n_results and line.

    calls: call_id, name, arguments (JSON text); results: call_id, content; links: call_id, needs.  A kept column
    that has the name of one of the others comes out as ``kept_<name>``.
    """
    made = {"call_id", "name", "level", "status", "problems", "n_results", "line"}
    kept = F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`").alias(f"kept_{c}" if c.lower() in made else c) for c in keep or []])
    answers = (results.where("call_id IS NOT NULL").groupBy("call_id")
               .agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results")))
    own = calls.select(kept.alias("_kept"), "call_id", "name", "arguments", F.try_parse_json("arguments").alias("_parsed"))
    rows = own.join(answers, "call_id", "left").join(levels(calls, links), "call_id", "left")
    rows = rows.withColumn("problems", problems(F.col("name"), F.col("_parsed"), schemas))
    status = (F.when(F.size("problems") > 0, "invalid").when(F.col("n_results").isNull(), "unanswered").otherwise("answered"))
    rows = rows.withColumns({"status": status, "n_results": F.coalesce("n_results", F.lit(0))})
    fields = [("arguments", F.coalesce(F.to_json("_parsed"), quoted(F.col("arguments")))), ("call_id", quoted(F.col("call_id"))),
              ("level", F.coalesce(F.col("level").cast("string"), F.lit("null"))), ("name", quoted(F.col("name"))),
              ("problems", F.concat(F.lit("["), F.array_join(F.transform("problems", quoted), ","), F.lit("]"))),
              ("result", quoted(F.col("content"))), ("status", quoted(F.col("status")))]
    line = F.concat(F.lit("{"), *[x for i, (k, v) in enumerate(fields) for x in (F.lit(f'{"," if i else ""}"{k}":'), v)], F.lit("}"))
    return rows.select("_kept.*", "call_id", "name", "level", "status", F.array_join("problems", "; ").alias("problems"), "n_results", line.alias("line")).drop("_none")


# --- calls and results derived from plain conversations -------------------------------------

SCHEMAS = {"count": {"text": ("string", True), "words": ("integer", True)},
           "find": {"limit": ("integer", False), "text": ("string", True)}}


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, links) of a table of turns (conv_id, turn, role, text).

    A user's turn calls the tool ``count`` (even number of characters) or ``find`` with its first
    word; ``find`` has its limit as text where the number of characters is a multiple of five,
    and no text argument in a turn without words.  The assistant's next turn is the result.
    A call needs the user's call at half its turn number.
    """
    call = F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    user = turns.where((F.col("role") == "user") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    text = F.coalesce("text", F.lit(""))
    word, n = F.regexp_extract(text, "[A-Za-z]+", 0), F.char_length(text)
    first = F.when(word != "", F.concat(F.lit('"text": '), quoted(word)))
    limit = F.when(n % 5 == 0, quoted(n.cast("string"))).otherwise(n.cast("string"))
    count = F.concat(F.lit('{ "words": '), n.cast("string"), F.coalesce(F.concat(F.lit(", "), first), F.lit("")), F.lit(" }"))
    find = F.concat(F.lit("{ "), F.coalesce(F.concat(first, F.lit(", ")), F.lit("")), F.lit('"limit": '), limit, F.lit(" }"))
    calls = user.select("conv_id", "turn", call.alias("call_id"), F.when(n % 2 == 0, "count").otherwise("find").alias("name"),
                        F.when(n % 2 == 0, count).otherwise(find).alias("arguments"))
    results = (turns.where((F.col("role") == "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
               .select(F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("call_id"),
                       F.coalesce("text", F.lit("")).alias("content")))
    links = user.where("turn > 0").select(call.alias("call_id"), F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"),
                                                                          F.floor(F.col("turn") / 2).cast("string")).alias("needs"))
    return calls, results, links
