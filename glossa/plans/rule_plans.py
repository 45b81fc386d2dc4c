"""Registered queries: rule-based valence and polarity over lexicon tables (C1, C2), against window SQL.

The documents are invented prose, so the tables grade frequent words and word pairs of theirs."""

from __future__ import annotations

from glossa.functions.numeric import r9
from glossa.operators import valence as V
from glossa.operators import sentiment as S
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register
from glossa.plans.text_plans import documents, sql_clean

VALENCES = {
    "the": 0.5, "of": -1.0, "de": 1.5, "la": -0.5, "in": 2.0, "that": -1.5, "was": -2.0, "und": 1.0, "le": 0.8, "er": -0.7,
    "of the": 2.5, "in the": -1.8, "de la": 3.0, "to the": 1.2, "la de": -2.2, "and of the": -0.9, "is that": 0.4,
}
POLARITIES = {"on": 0.3, "it": -0.4, "die": 0.5, "for": -0.8, "que": 0.6, "des": -0.2, "by": 0.9, "on the": -0.7, "for it": 0.25, "en la": -0.5, "the": 0.1}
STEPS = {"a": 0.293, "und": 0.293, "et": -0.293, "as": 0.293, "der": -0.293}
AGAINST = ("no", "not", "nicht", "pas", "is")
CONTRASTS = ("than", "pour", "que")
INTENSITIES = {"in": 1.4, "and": 1.2, "de": 0.6, "er": 1.1, "of": 0.8, "at": 1.3}


def rows_sql(kinds: dict[str, dict[str, float]]) -> str:
    rows = [(w, len(w.split()), k, float(v)) for k, words in kinds.items() for w, v in words.items()]
    return "VALUES " + ", ".join(f"('{w}', {n}, '{k}', {v!r}::DOUBLE)" for w, n, k, v in rows)


def words_sql(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def found_sql(kinds: dict[str, dict[str, float]]) -> str:
    """CTEs up to ``found``: the entries that hold at each place of each text."""
    spelled = {1: "t", 2: "t || ' ' || a1", 3: "t || ' ' || a1 || ' ' || a2"}
    joins = " UNION ALL ".join(f"SELECT ctx.*, n, kind, value, {s} AS spelled FROM ctx JOIN ent ON n = {n} AND phrase = lower({s})" for n, s in spelled.items())
    return f"""src AS (SELECT doc_id, coalesce(text, '') AS text, {sql_clean('text')} AS c FROM documents),
tok AS (SELECT doc_id, unnest(string_split(c, ' ')) AS t, unnest(range(len(string_split(c, ' ')))) AS i FROM src WHERE c <> ''),
ctx AS (SELECT doc_id, t, i, lag(t, 1) OVER w AS p1, lag(t, 2) OVER w AS p2, lag(t, 3) OVER w AS p3, lead(t, 1) OVER w AS a1, lead(t, 2) OVER w AS a2
        FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ent(phrase, n, kind, value) AS ({rows_sql(kinds)}),
held AS ({joins}),
longest AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY n DESC, kind) = 1),
found AS (SELECT * FROM longest QUALIFY coalesce(max(i + n) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= i)"""


def caps(c: str) -> str:
    return f"({c} = upper({c}) AND {c} <> lower({c}))"


def valence_sql() -> str:
    step = {p: "CASE " + " ".join(f"WHEN lower({p}) = '{w}' THEN {v}" for w, v in STEPS.items()) + " END" for p in ("p1", "p2", "p3")}
    boost = " + ".join(f"coalesce(sign(value) * ({s} + CASE WHEN mixed AND {caps(p)} THEN {V.CAPITALS} ELSE 0 END) * {d}, 0)" for (p, s), d in zip(step.items(), S.BOOST_DECAY))
    no = " OR ".join(f"coalesce(lower({p}) IN {words_sql(AGAINST)}, false)" for p in step)
    shouts, asks = (f"(length(text) - length(replace(text, '{c}', '')))" for c in "!?")
    return f"""{found_sql({'p': VALENCES})},
txt AS (SELECT doc_id, min(i) FILTER (WHERE lower(t) IN {words_sql(CONTRASTS)}) AS cut, count(*) FILTER (WHERE {caps('t')}) BETWEEN 1 AND count(*) - 1 AS mixed FROM tok GROUP BY doc_id),
worth AS (SELECT doc_id, (value + CASE WHEN mixed AND {caps('spelled')} THEN sign(value) * {V.CAPITALS} ELSE 0 END + {boost})
    * CASE WHEN {no} THEN {S.NEGATION_SCALAR} ELSE 1 END * CASE WHEN i < cut THEN {V.CONTRAST[0]} WHEN i > cut THEN {V.CONTRAST[1]} ELSE 1 END AS x
  FROM found JOIN txt USING (doc_id)),
total AS (SELECT doc_id, sum(x) AS s FROM worth GROUP BY doc_id),
marks AS (SELECT doc_id, least({shouts}, {V.EXCLAMATION[1]}) * {V.EXCLAMATION[0]} + CASE WHEN {asks} > {V.QUESTION[1]} THEN {V.QUESTION[2]} WHEN {asks} > 1 THEN {asks} * {V.QUESTION[0]} ELSE 0 END AS m FROM src),
strong AS (SELECT doc_id, coalesce(s + sign(s) * m, 0) AS s FROM marks LEFT JOIN total USING (doc_id)),
valence AS (SELECT doc_id, s / sqrt(s * s + {S.ALPHA}) AS vader_compound FROM strong)"""


def polarity_sql() -> str:
    kinds = {"m": INTENSITIES, "n": dict.fromkeys(AGAINST, 1.0), "p": POLARITIES}
    return f"""{found_sql(kinds)},
seen AS (SELECT *, coalesce(lag(i + n) OVER w = i, false) AS follows, lag(kind) OVER w AS last FROM found WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT *, sum(CASE WHEN follows AND last = 'm' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM seen),
power AS (SELECT *, product(CASE kind WHEN 'm' THEN value ELSE 1 END) OVER r AS p, first_value(follows AND last = 'n') OVER r AS negated
  FROM runs WINDOW r AS (PARTITION BY doc_id, run ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
polarity AS (SELECT doc_id, avg(greatest(-1, least(1, CASE WHEN negated THEN value * {V.NEGATED_POLARITY} / p ELSE value * p END))) AS textblob_sentiment
  FROM power WHERE kind = 'p' GROUP BY doc_id)"""


def valences(docs, spark):
    return V.valence_scores(docs, S.word_table(spark, VALENCES, "valence"), text_col="text", boosters=STEPS, negations=AGAINST, contrasts=CONTRASTS)


def polarities(docs, spark):
    return V.polarity_scores(docs, S.word_table(spark, POLARITIES, "polarity"), S.word_table(spark, INTENSITIES, "intensity"), text_col="text", negations=AGAINST)


@register("rule_valence", covers="C1", oracle=f"WITH {valence_sql()} SELECT doc_id, {q9('vader_compound')} AS vader_compound FROM valence")
def rule_valence(spark, sf_dir):
    return valences(documents(spark, sf_dir).select("doc_id", "text"), spark).select("doc_id", r9("vader_compound").alias("vader_compound"))


@register(
    "rule_polarity",
    covers="C2",
    oracle=f"""WITH {polarity_sql()}
SELECT doc_id, coalesce({q9('textblob_sentiment')}, 0) AS textblob_sentiment FROM src LEFT JOIN polarity USING (doc_id)""",
)
def rule_polarity(spark, sf_dir):
    return polarities(documents(spark, sf_dir).select("doc_id", "text"), spark).select("doc_id", r9("textblob_sentiment").alias("textblob_sentiment"))
