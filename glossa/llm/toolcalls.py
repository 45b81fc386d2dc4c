"""Operator 4: tool-call linking, in DataFrame operations only.

Calls and results meet by conversation and call identifier. Calls are put in topological order of the
results they depend on, their arguments are validated against the tools' schemas, and every call becomes one
canonical JSON object (keys sorted, no white space, numbers in shortest form).

Order: a call's level is the length of the longest chain of calls that it waits for. Calls without open dependencies are
settled at once; a chain of calls that wait for one open call each is settled by pointer doubling, in rounds that grow with the
logarithm of its length: a call's level is max(m, level of the call it points to + w), and such steps compose. What is settled frees
the calls that waited for several, for the next pass. Passes are as many as such calls stand one above the other. Every
step is a join or a partial aggregation by (conversation, call), so no conversation is gathered, however many calls
it has. A pass that finds no free call leaves those on or behind a cycle: they are ``cyclic`` and have no level.

Defined cases: a result without a call is a row with status ``orphan``; a call without a result has status
``open``; a dependency on a call that does not exist is listed in ``missing`` and does not hold the call up. Of several
calls or results with one identifier the one at the smallest turn (then smallest text) counts, and ``repeats`` says how many
there were. Rows without a conversation or identifier are dropped from linking and returned with status ``unnamed``. Arguments
that are null or no JSON object, a tool without a schema, missing, unknown and mistyped arguments are each a
problem by name. Empty tables give no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import stored

#: JSON types of a schema, and how the type of a parsed value begins.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
SCHEMA = "name string, params array<struct<param:string,type:string,required:boolean>>"


def kind(value: Column) -> Column:
    """The schema type of a parsed value."""
    text = F.schema_of_variant(value)
    out = F.lit("null")
    for name, starts in TYPES.items():
        for s in starts:
            out = F.when(text.startswith(s), name if s != "BIGINT" else "integer").otherwise(out)
    return out


def problems(parsed: str, params: str) -> Column:
    """What is wrong with parsed arguments, as sorted texts; ``params`` is null for a tool without a schema."""
    at = lambda p: F.try_variant_get(F.col(parsed), F.concat(F.lit("$['"), p["param"], F.lit("']")), "variant")
    fits = lambda p: (kind(at(p)) == p["type"]) | ((p["type"] == "number") & (kind(at(p)) == "integer"))
    lacks = F.transform(F.filter(params, lambda p: p["required"] & at(p).isNull()), lambda p: F.concat(F.lit("missing:"), p["param"]))
    wrong = F.transform(F.filter(params, lambda p: at(p).isNotNull() & ~fits(p)), lambda p: F.concat(F.lit("type:"), p["param"]))
    names = F.coalesce(F.json_object_keys(F.to_json(F.col(parsed))), F.array().cast("array<string>"))
    extra = F.transform(F.array_except(names, F.transform(params, lambda p: p["param"])), lambda n: F.concat(F.lit("unknown:"), n))
    bad = F.array(F.lit("json"))
    return F.when(F.col(parsed).isNull() | ~F.schema_of_variant(F.col(parsed)).startswith("OBJECT"), bad).when(F.col(params).isNull(), F.array(F.lit("schema"))).otherwise(F.array_sort(F.concat(lacks, wrong, extra)))


def first_of(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row per conversation and identifier, and how many there were."""
    least = F.min(F.struct("turn", *fields)).alias("r")
    return rows.groupBy("conv_id", "call_id").agg(least, F.count("*").alias("n")).select("conv_id", "call_id", "r.*", "n")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, cyclic) of all calls; ``edges``: distinct (conv_id, call_id, dep) among existing calls."""
    node = ["conv_id", "call_id"]
    open_ = stored(calls.select(*node, F.lit(0).alias("m")), "open-calls")
    edges = stored(edges, "open-edges")
    out = []
    while True:
        # Calls that wait for nothing, and those that wait for one call: where they point, by how many steps.
        waits = edges.groupBy(*node).agg(F.count("*").alias("n"), F.min("dep").alias("to"))
        joined = stored(open_.join(waits, node, "left"), "waiting-calls")
        free = joined.where("n IS NULL").select(*node, F.col("m").alias("level"))
        if not free.take(1):
            break
        chain = stored(joined.where("n = 1").select(*node, "to", F.lit(1).alias("w"), "m"), "chains")
        for _ in range(chain.count().bit_length()):
            on = chain.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("w").alias("more"), F.col("m").alias("least"))
            step = chain.join(on, ["conv_id", "to"], "left")
            if not step.where("next IS NOT NULL").take(1):
                break
            chain = stored(step.select(*node, F.coalesce("next", "to").alias("to"), (F.col("w") + F.coalesce("more", F.lit(0))).alias("w"), F.greatest("m", F.col("least") + F.col("w")).alias("m")), "chains")
        at = free.select("conv_id", F.col("call_id").alias("to"), "level")
        behind = chain.join(at, ["conv_id", "to"]).select(*node, F.greatest("m", F.col("level") + F.col("w")).alias("level"))
        done = stored(free.union(behind), "settled-calls")
        out.append(done)
        known = done.select("conv_id", F.col("call_id").alias("dep"), "level")
        reached = edges.join(known, ["conv_id", "dep"]).groupBy(*node).agg((F.max("level") + 1).alias("reached"))
        open_ = stored(open_.join(done, node, "left_anti").join(reached, node, "left").select(*node, F.greatest("m", "reached").alias("m")), "open-calls")
        edges = stored(edges.join(known, ["conv_id", "dep"], "left_anti"), "open-edges")
    settled = [d.select(*node, "level", F.lit(False).alias("cyclic")) for d in out]
    return reduce(DataFrame.union, settled, open_.select(*node, F.lit(None).cast("int").alias("level"), F.lit(True).alias("cyclic")))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call (and per result without one), linked, ordered, validated and serialised.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), depends (array of call ids).
    ``results``: conv_id, call_id, turn, content. ``schemas``: name, params. Result: conv_id, call_id, turn, name, status, level
    (null for orphans and on or behind a cycle), cyclic, missing, problems, valid, repeats and canonical.
    """
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    depends = F.array_sort(F.array_distinct(F.filter(F.coalesce("depends", F.array().cast("array<string>")), lambda d: d.isNotNull())))
    calls = calls.select("conv_id", "call_id", F.col("turn").cast("long").alias("turn"), "name", "arguments", depends.alias("depends"))
    results = results.select("conv_id", "call_id", F.col("turn").cast("long").alias("turn"), "content")
    one = stored(first_of(calls.where(named), ["name", "arguments", "depends"]), "calls")
    two = first_of(results.where(named), ["content"]).select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content", F.col("n").alias("m"))
    there = one.select("conv_id", F.col("call_id").alias("dep"))
    wanted = one.select("conv_id", "call_id", F.explode("depends").alias("dep"))
    edges = wanted.join(there, ["conv_id", "dep"]).select("conv_id", "call_id", "dep")
    order = levels(one.select("conv_id", "call_id", "turn"), edges)
    missing = wanted.join(there, ["conv_id", "dep"], "left_anti").groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set("dep")).alias("missing"))

    both = one.join(two, ["conv_id", "call_id"], "full").join(order, ["conv_id", "call_id"], "left").join(missing, ["conv_id", "call_id"], "left")
    params = schemas.groupBy(F.col("name").alias("tool")).agg(F.min("params").alias("params"))  # of a tool listed twice, the least
    both = both.join(params, F.col("name") == F.col("tool"), "left").withColumn("parsed", F.try_parse_json("arguments"))
    status = F.when(F.col("n").isNull(), "orphan").when(F.col("m").isNull(), "open").otherwise("linked")
    out = both.select(
        "conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "name", "arguments", "depends", "content", "parsed", "level",
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"), status.alias("status"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"),
        F.when(F.col("n").isNotNull(), problems("parsed", "params")).otherwise(F.array().cast("array<string>")).alias("problems"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0)) - F.when(status == "linked", 2).otherwise(1)).alias("repeats"),
    )
    lost = lambda rows, *more: rows.where(~named).select("conv_id", "call_id", "turn", *more)
    none = F.lit(None).cast("string")
    spare = lost(calls, "name", "arguments", "depends", none.alias("content")).union(lost(results, none, none, F.lit(None).cast("array<string>"), "content"))
    empty = F.array().cast("array<string>")
    spare = spare.select(
        "conv_id", "call_id", "turn", "name", "arguments", "depends", "content", F.lit(None).cast("variant"), F.lit(None).cast("int"), F.lit(False), F.lit("unnamed"), empty, empty, F.lit(0).cast("long")
    )
    out = out.union(spare)
    whole = F.struct(
        F.coalesce(F.to_json("parsed"), F.lit("null")).alias("a"), F.to_json(F.coalesce("depends", empty)).alias("d"), *[F.to_json(F.array(c)).alias(k) for k, c in (("i", "call_id"), ("n", "name"), ("r", "content"))]
    )
    text = lambda k: F.expr(f"substring(w.{k}, 2, length(w.{k}) - 2)")  # noqa: E731  the text without the array's brackets
    out = out.withColumn("w", whole)
    canonical = F.concat(F.lit('{"arguments":'), "w.a", F.lit(',"depends_on":'), "w.d", F.lit(',"id":'), text("i"), F.lit(',"name":'), text("n"), F.lit(',"result":'), text("r"), F.lit("}"))
    valid = (F.size("problems") == 0) & (F.size("missing") == 0) & ~F.col("cyclic") & F.col("status").isin("linked", "open")
    return out.select("conv_id", "call_id", "turn", "name", "status", "level", "cyclic", "missing", "problems", valid.alias("valid"), "repeats", canonical.alias("canonical"))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that conversation turns stand for.

    A system turn is a call of ``configure`` and a user turn a call of ``answer``, named by its turn; the assistant
    turn behind it is its result. A call depends on the conversation's first system turn and, if it is a user's, on the call two turns
    before it. By the number of bytes of the text, some users' calls wait for the call two turns later (0 modulo 5: which then
    does not wait for them; 1 modulo 5: which waits for them too, a cycle), and some arguments lack ``words`` (2 modulo 11), give it
    as a text (3) or have one more field (4).
    """
    size = F.octet_length(F.coalesce("text", F.lit("")))
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", (size % 5).alias("k"), (size % 11).alias("flaw"))
    name = F.when(F.col("role") == "system", "configure").when(F.col("role") == "user", "answer")
    ident = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    first = turns.where("role = 'system'").groupBy("conv_id").agg(F.min("turn").alias("head"))
    waiting = turns.where("role = 'user' AND k = 0").select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("waited")).distinct()
    calls = turns.withColumn("name", name).where("name IS NOT NULL").join(first, "conv_id", "left").join(waiting, ["conv_id", "turn"], "left")
    user = F.col("name") == "answer"
    back = F.when((F.col("turn") >= 2) & user & F.col("waited").isNull(), ident(F.col("turn") - 2))
    ahead = F.when(user & (F.col("k") <= 1), ident(F.col("turn") + 2))
    head = F.when(F.col("head") != F.col("turn"), ident(F.col("head")))
    text, words = F.col("text").alias("text"), F.size(F.split(F.coalesce("text", F.lit("")), "\\s+")).alias("words")
    arguments = (
        F.when(F.col("flaw") == 2, F.to_json(F.struct(text)))
        .when(F.col("flaw") == 3, F.to_json(F.struct(text, words.cast("string").alias("words"))))
        .when(F.col("flaw") == 4, F.to_json(F.struct(F.lit("xx").alias("lang"), text, words)))
        .otherwise(F.to_json(F.struct(text, words)))
    )
    calls = calls.select("conv_id", ident(F.col("turn")).alias("call_id"), "turn", "name", arguments.alias("arguments"), F.array(back, ahead, head).alias("depends"))
    results = turns.where("role = 'assistant'").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def turn_schemas(turns: DataFrame) -> DataFrame:
    """The schemas of the two tools of ``from_turns``: both take a text and its number of words."""
    params = [("text", "string", True), ("words", "integer", True)]
    return turns.sparkSession.createDataFrame([("answer", params), ("configure", params)], SCHEMA)
