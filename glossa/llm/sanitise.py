"""Operator 9: personal data, and the terms that give it away.

Base spans are e-mail addresses, IP and card numbers and telephone numbers, found by a pattern
each and then validated. The method adds spans: a validated value is a protected entity, and so is what it has in common with
its like (an e-mail's domain, an IP's first two parts, the first six digits of a number). A term (a word of letters) that
stands within ``near`` code points of an entity co-occurs with it. How much it reveals is the share of the entity's
information that is gone once the term is known, log(P(e|t) / P(e)) / -log P(e), with P(e) = n_e / N and for P(e|t) the lower
Wilson bound of n_te / n_t (``z``): one text is weak evidence, more texts that agree are stronger, and there is no number of texts
below which an entity is left out. All counts are of distinct texts, so copies are no evidence of their own. A term that
reaches ``threshold`` for any entity is a span of kind ``term`` wherever it stands, in every text, whether or not the value
stands there too. ``redact`` generalises a base span to its kind and removes a disclosing term.

All steps are DataFrame operations on strings. Equal texts meet once, at the start, and are read as one from there on. Positions
come from splitting a text by the pattern: a match begins where the pieces and matches before it end. Patterns are possessive and
begin behind a character that could not have begun them sooner, so long runs are read once. Term frequencies are
combined before they move, and a frequent term or value is one row a task.

Defined cases: a null or empty text has no span. Equal texts get equal results, whatever their ids; a null id is a row like
others. An empty table gives no rows. Only ``text`` is read; ``redact`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import stored

#: The kinds in their order, and what each matches.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}"
#: Base matches are whole runs of digits with single separators; these are the runs of 12 to 19.
CARD = "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){11,18}+(?![\\x20-]?[0-9])"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "term"]
#: A term: a run of at least four letters.
TERM = "(?<![\\p{L}\\p{N}])\\p{L}{4,}+(?![\\p{L}\\p{N}])"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def ip_valid(match: Column) -> Column:
    """Every part at most 255, whatever its leading zeros."""
    parts = F.transform(F.split(match, "\\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def card_valid(match: Column) -> Column:
    """12 to 19 digits that pass the Luhn check."""
    d = digits(match)
    at = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(c == "", 0).when(i % 2 == 0, c.try_cast("int")).otherwise((c.try_cast("int") * 2) % 10 + F.floor(c.try_cast("int") / 5)))
    total = F.aggregate(at, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def phone_valid(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


VALID = {"ip": ip_valid, "card": card_valid, "phone": phone_valid}


def valid(kind: str):
    return lambda s: VALID[kind](s["value"])


def count(found: str, kind: str) -> Column:
    """How many spans of an array column are of a kind."""
    k = KINDS.index(kind)
    return F.size(F.filter(found, lambda s: s["k"] == k)).cast("long")


def spans(text: Column, pattern: Column | str, kind: str) -> Column:
    """Array of (start, k, end, value) of the pattern's matches, in code points; k is the kind's place in ``KINDS``."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    empty = F.array().cast("array<struct<start:int,k:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.coalesce(F.length(pair["match"]), F.lit(0))
        one = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(pair["match"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(one))).alias("out"))

    return F.aggregate(found, start, step, lambda state: state["out"])


def base_spans(text: Column) -> Column:
    """The validated spans of every kind, by start and then kind."""
    text = F.coalesce(text, F.lit(""))
    parts = []
    for kind, pattern, mark in (("email", EMAIL, "@"), ("ip", IP, "."), ("card", CARD, ""), ("phone", PHONE, "+")):
        found = spans(text, pattern, kind)
        if kind in VALID:
            found = F.filter(found, valid(kind))
        none = F.array().cast("array<struct<start:int,k:int,end:int,value:string>>")
        parts.append(F.when(F.contains(text, F.lit(mark)), found).otherwise(none) if mark else found)
    return F.array_sort(F.concat(*parts))


def named(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1)
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def content(text: str = "text") -> Column:
    """A text's key: 96 bits of hashes."""
    return F.struct(F.xxhash64(text).alias("h"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("c"))


def entities(kind: Column, value: Column) -> Column:
    """The entities of a value: itself (its spellings are one), and what it shares with its like."""
    whole = F.when(kind == 0, F.lower(value)).when(kind == 1, value).otherwise(digits(value))
    shared = F.when(kind == 0, F.regexp_extract(whole, "@(.*)$", 1)).when(kind == 1, F.substring_index(value, ".", 2)).otherwise(F.substring(whole, 1, 6))
    return F.array(F.xxhash64(F.lit("value"), kind, whole), F.xxhash64(F.lit("shared"), kind, shared))


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def around(text: Column, span: Column, near: int) -> Column:
    """The terms before and behind a span within ``near`` code points; a word that is cut there does not count."""
    first = F.greatest(F.lit(0), span["start"] - near - 1)
    left = F.substring(text, first + 1, span["start"] - first)
    left = F.when(first > 0, F.regexp_replace(left, "^[\\p{L}\\p{N}]+", "")).otherwise(left)
    right = F.substring(text, span["end"] + 1, F.lit(near + 1))
    right = F.when(F.length(right) > near, F.regexp_replace(right, "[\\p{L}\\p{N}]+$", "")).otherwise(right)
    return F.array_distinct(F.concat(terms(left), terms(right)))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(content, text, base): every text that is not empty once, with its base spans."""
    rows = docs.select(content().alias("content"), "text").where("text <> ''").groupBy("content").agg(F.first("text").alias("text"))
    return stored(rows.select("content", "text", F.explode(F.array(base_spans(F.col("text")))).alias("base")), "distinct-texts")


def disclosing(texts: DataFrame, near: int, threshold: float, z: float) -> DataFrame:
    """(term): the lower-case terms that disclose an entity, from (content, text, base) of distinct texts."""
    span = F.explode("base").alias("s")
    met = texts.where(F.size("base") > 0).select("content", "text", span)
    met = met.select("content", F.explode(entities(F.col("s.k"), F.col("s.value"))).alias("entity"), around(F.col("text"), F.col("s"), near).alias("terms"))
    met = stored(met, "entities")
    n_e = met.select("entity", "content").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    n_te = met.select("entity", "content", F.explode("terms").alias("term")).distinct().groupBy("entity", "term").agg(F.count("*").alias("n_te"))
    n_t = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    both = n_te.join(n_e, "entity").join(n_t, "term").withColumn("total", F.lit(float(texts.count())))
    n, share = F.col("n_t"), F.least(F.lit(1.0), F.col("n_te") / F.col("n_t"))
    low = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    prior = F.col("n_e") / F.col("total")
    score = F.when((prior < 1) & (low > 0), F.log(F.when(low > 0, low).otherwise(1.0) / prior) / -F.log(F.when(prior < 1, prior).otherwise(0.5))).otherwise(0.0)
    return stored(both.where(score >= threshold).select("term").distinct(), "disclosing")


#: One-sided confidence of four in five.
Z = 0.8416


def found_spans(docs: DataFrame, near: int = 60, threshold: float = 0.9, z: float = Z) -> DataFrame:
    """(key, base, all): for the texts that hold any (``key`` is their ``content``), the base spans, and these with what the method adds."""
    texts = distinct_texts(docs)
    known = disclosing(texts, near, threshold, z)
    held = texts.select("content", F.explode(terms(F.col("text"))).alias("term")).join(known, "term")
    held = stored(held.groupBy("content").agg(F.array_sort(F.collect_list("term")).alias("terms")), "held-terms")  # at most a text's own terms
    out = texts.join(held, "content", "left").where((F.size("base") > 0) | F.col("terms").isNotNull())
    # The terms are letters only, so that they are a pattern as they stand.
    pattern = F.concat(F.lit("(?iu)(?<![\\p{L}\\p{N}])(?:"), F.array_join("terms", "|"), F.lit(")(?![\\p{L}\\p{N}])"))
    clear = F.filter(spans(F.col("text"), pattern, "term"), lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    every = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", clear)))
    return stored(out.select(F.col("content").alias("key"), "base", every.alias("all")), "spans")


def redact(docs: DataFrame, near: int = 60, threshold: float = 0.9, z: float = Z) -> DataFrame:
    """``docs`` with each base span generalised to ``<KIND>`` and each disclosing term removed.

    Of base spans that overlap, the one that begins first stands for both.
    """
    found = found_spans(docs, near, threshold, z).select("key", "all")
    out = docs.select(F.struct("*").alias("row"), content().alias("key")).join(found, "key", "left")
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        word = F.when(s["k"] == len(KINDS) - 1, "").otherwise(F.concat(F.lit("<"), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1)), F.lit(">")))
        gap = F.substring(text, state["at"] + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
        whole = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, word)).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), whole.alias("out"))

    done = F.aggregate("all", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.greatest(F.lit(0), F.length(text) - s["at"]))))
    names = [F.when(F.col("all").isNotNull(), done).otherwise(text).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*names)
