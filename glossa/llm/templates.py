"""Operator 3: line dedup by a log-template tree of fixed depth.

A line's path in the tree is its number of tokens and its leading ``depth`` tokens; tokens
with a digit are variable from the start (``<*>``). The different lines of a leaf are generalised
in rounds: at each position the token most of them share is the constant, and the lines that agree with
at least ``similarity`` of the constants are one template, their other tokens being its variable fields. If
these are a quarter of the lines or more, the rest is generalised again as it is; otherwise the rest is first
split by its tokens at the most constant position that tells lines apart. So a leaf holds any number of templates.
A line that is left alone is a template of its own.

A template recurs if it occurs in at least two documents of different text, and in the more
the shorter it is: documents times tokens must reach ``evidence`` (a one-word line may recur by
chance, a passage does not). Lines that together are a passage are judged together: two adjacent lines (blank
lines aside) whose templates are adjacent in at least two documents of different text are linked, links follow one another
to runs, and a run recurs if its tokens times the documents of its rarest link reach ``evidence``.
A recurring template or link stays in the document with the smallest id,
and in exact copies of that document, which are left to the near-duplicate stage; everywhere else its lines
are dropped. Everything is DataFrame operations: counts are combined before they move, and the
tree is never gathered.

Defined cases: null and empty texts and blank lines are untouched. A row that loses its last
line with a token is dropped by ``clean``; a row that had none stays. Rows are told apart by
id and text, so repeated rows are one document and keep or lose the same lines; a null id is
the smallest id. Ties of constant tokens go to the largest token, of positions to the first. An empty table gives no
rows. Columns other than ``text`` pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import row_key, stored

#: A token with a digit, from its start.
VARIABLE = "(?<!\\S)[^\\s0-9]*+[0-9]\\S*+"


def masked(line: Column) -> Column:
    """A line's tokens, one space between them, and ``<*>`` for those with a digit."""
    even = F.trim(F.when(line.rlike("[\\t\\x0B\\f\\r]|  "), F.regexp_replace(line, "\\s+", " ")).otherwise(line))
    return F.when(even.rlike("[0-9]"), F.regexp_replace(even, VARIABLE, "<*>")).otherwise(even)


def lines(docs: DataFrame, depth: int) -> DataFrame:
    """(key, doc_id, content, line, place, n, leaf, own) of every line with a token; leaf and own are hashes.

    ``line`` counts all lines of the text, ``place`` those with a token.
    """
    numbered = F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.alias("line"), t.alias("t")))
    numbered = F.filter(numbered, lambda x: x["t"].rlike("\\S"))
    rows = docs.where("text IS NOT NULL").select(row_key().alias("key"), "doc_id", F.xxhash64("text").alias("content"), F.posexplode(numbered).alias("place", "x"))
    rows = rows.withColumn("m", masked(F.col("x.t"))).withColumn("n", F.size(F.split("m", " ")))
    leaf = F.xxhash64("n", F.substring_index("m", " ", depth))
    return rows.select("key", "doc_id", "content", "x.line", "place", "n", leaf.alias("leaf"), F.xxhash64(F.lit(0), "m").alias("own"))


def open_groups(kinds: DataFrame) -> DataFrame:
    """The groups with lines to compare: more than one, and not all of a single text."""
    groups = kinds.groupBy("group").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return groups.where("n > 1 AND lo <> hi").select("group")


def generalised(docs: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """(own, general): the template of each distinct line that found one in its leaf.

    Lines so short that ``similarity`` leaves no token free are their own templates and take no part.
    """
    free = found.where(F.col("n") > F.ceil(F.col("n") * F.lit(similarity)))
    leaves = free.groupBy("leaf", "own").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    open_ = stored(open_groups(leaves.withColumnRenamed("leaf", "group")), "template-leaves")
    # One place of each distinct line of an open leaf; only these texts are read again.
    places = free.withColumnRenamed("leaf", "group").join(open_, "group").groupBy("group", "own")
    places = places.agg(F.min(F.struct("key", "line")).alias("p"), F.min("content").alias("lo"), F.max("content").alias("hi"))
    places = places.groupBy("p.key").agg(F.collect_list(F.struct("p.line", "group", "own", "lo", "hi")).alias("places"))
    texts = docs.select(row_key().alias("key"), "text").join(places, "key").select(F.split("text", "\n").alias("t"), F.explode("places").alias("p"))
    kinds = texts.select("p.group", "p.own", "p.lo", "p.hi", masked(F.get("t", F.col("p.line"))).alias("m"))
    kinds = kinds.groupBy("group", "own").agg(*[F.first(c).alias(c) for c in ("lo", "hi", "m")])
    kinds = stored(kinds.withColumn("tokens", F.split("m", " ")).drop("m"), "template-lines")
    fitting = []
    while not kinds.isEmpty():
        judged = stored(against_constants(kinds, similarity), "template-fits")
        fitting.append(judged.where("fits").select("own", F.col("group").alias("general")))
        gains = judged.groupBy("group").agg((4 * F.count_if("fits") >= F.count("*")).alias("gained"))
        deeper = F.xxhash64("group", "position", F.get("tokens", F.col("position")))
        group = F.when(F.col("gained"), F.xxhash64("group", F.lit("rest"))).otherwise(deeper)
        rest = judged.where("NOT fits").join(gains, "group").select(group.alias("group"), "own", "lo", "hi", "tokens")
        kinds = stored(rest.join(open_groups(rest), "group"), "template-lines")
    return reduce(DataFrame.union, fitting) if fitting else kinds.select("own", F.col("group").alias("general"))


def against_constants(kinds: DataFrame, similarity: float) -> DataFrame:
    """``kinds`` with ``fits`` (agrees with its group's constants) and ``position``, where the group is to be split."""
    at = kinds.select("group", F.posexplode("tokens").alias("pos", "token")).groupBy("group", "pos", "token").agg(F.count("*").alias("n"))
    constant = at.groupBy("group", "pos").agg(F.sum("n").alias("size"), F.max(F.struct("n", "token")).alias("most"))
    telling = F.when(F.col("most.n") < F.col("size"), F.struct(F.col("most.n").alias("n"), (-F.col("pos")).alias("back")))
    constants = F.sort_array(F.collect_list(F.struct("pos", F.col("most.token").alias("token"))))["token"]
    template = constant.groupBy("group").agg(constants.alias("template"), (-F.max(telling)["back"]).alias("position"))
    agree = F.aggregate(F.zip_with("tokens", "template", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return kinds.join(template, "group").withColumn("fits", agree >= F.ceil(F.size("tokens") * F.lit(similarity))).drop("template")


def owned(rows: DataFrame, what: str) -> DataFrame:
    """(``what``, docs, tokens, owner) of every ``what`` that is in two different texts or more.

    One row for each of them and text, then for each of them: nothing meets uncombined.
    """
    texts = rows.groupBy(what, "content").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    owners = texts.groupBy(what).agg(F.count("*").alias("docs"), F.max("n").alias("tokens"), F.min(F.struct("doc_id", "content"))["content"].alias("owner"))
    return owners.where("docs > 1")


def runs(shared: DataFrame, evidence: int) -> DataFrame:
    """(key, line) of the lines in recurring runs; ``shared`` holds the lines whose template is in several texts."""
    in_text = Window.partitionBy("key").orderBy("place")
    # Rows of equal id and text repeat their lines.
    once = shared.groupBy("key", "place").agg(*[F.first(c).alias(c) for c in ("doc_id", "content", "line", "n", "template")])
    names = ("place", "line", "n", "template")
    both = once.select("*", *[F.lag(c).over(in_text).alias(f"{c}_before") for c in names]).where("place = place_before + 1")
    links = both.withColumn("link", F.xxhash64("template_before", "template"))
    links = stored(links.drop("template", "template_before"), "line-links")
    taken = links.join(owned(links, "link").select("link", "docs", "owner"), "link").where("content <> owner")
    taken = taken.withColumn("first", F.coalesce(F.lag("place").over(in_text) < F.col("place_before"), F.lit(True)))
    taken = taken.withColumn("run", F.sum(F.col("first").cast("int")).over(in_text))
    tokens = F.sum("n") + F.sum(F.when(F.col("first"), F.col("n_before")).otherwise(0))
    each = taken.groupBy("key", "run").agg(F.min("docs").alias("docs"), tokens.alias("tokens"), F.collect_list(F.array("line_before", "line")).alias("lines"))
    return each.where(F.col("docs") * F.col("tokens") >= evidence).select("key", F.explode(F.array_distinct(F.flatten("lines"))).alias("line"))


def recurring(docs: DataFrame, depth: int = 3, similarity: float = 0.8, evidence: int = 40) -> DataFrame:
    """(key, lines): the numbers of the lines that each row loses."""
    docs = docs.select("doc_id", "text")
    found = stored(lines(docs, depth), "lines")
    general = generalised(docs, found, similarity)
    found = found.join(general, "own", "left").withColumn("template", F.coalesce("general", "own"))
    found = stored(found.select("key", "doc_id", "content", "line", "place", "n", "template"), "line-templates")
    shared = stored(found.join(owned(found, "template"), "template"), "shared-lines")
    lost = shared.where((F.col("content") != F.col("owner")) & (F.col("docs") * F.col("tokens") >= evidence)).select("key", "line")
    return lost.union(runs(shared, evidence)).groupBy("key").agg(F.collect_set("line").alias("lines"))


def clean(docs: DataFrame, depth: int = 3, similarity: float = 0.8, evidence: int = 40, counts: bool = False) -> DataFrame:
    """``docs`` without the lines of recurring templates, and without the rows that they made up.

    With ``counts`` every row stays, with ``lines_in`` and ``lines_lost``.
    """
    lost = stored(recurring(docs, depth, similarity, evidence), "lost-lines")
    both = docs.select(F.struct("*").alias("row"), row_key().alias("key")).join(lost, "key", "left")
    rest = F.filter(F.split("row.text", "\n"), lambda t, i: ~F.array_contains("lines", i))
    both = both.withColumn("text", F.when(F.col("lines").isNull(), F.col("row.text")).otherwise(F.array_join(rest, "\n")))
    names = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if not (counts and c in ("lines_in", "lines_lost"))]
    if not counts:
        return both.where("lines IS NULL OR text RLIKE '\\\\S'").select(*names)
    lines_in = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n"))).cast("long")
    lines_lost = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long")
    return both.select(*names, lines_in.alias("lines_in"), lines_lost.alias("lines_lost"))
