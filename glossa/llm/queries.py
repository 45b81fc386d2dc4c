"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import alignment, arrowfile, decontaminate, near_dedup, nn_descent, packing, ppm, sanitise, templates, toolcalls, toxicity, vafile, warc
from glossa.llm.common import crc_bucket, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7_SQL = r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k, len(w) AS n FROM words),
runs AS (SELECT doc_id, k, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle FROM placed),
items AS (SELECT DISTINCT doc_id, shingle FROM runs WHERE k <= greatest(n - 4, 1)),
sized AS (SELECT doc_id, count(shingle) AS n FROM words LEFT JOIN items USING (doc_id) GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sized UNION SELECT reach.doc_id, steps.b FROM reach JOIN steps ON steps.a = reach.other)
SELECT doc_id, n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sized JOIN reach USING (doc_id) GROUP BY doc_id, n"""

OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents
), i AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
), found AS (SELECT doc_id, k, n, item_id FROM grams JOIN wins USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

OP3_SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents
), k AS (
  SELECT *, [CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END FOR x IN regexp_split_to_array(line, '[ \t\x0B\f\r]+') IF x <> ''] AS w FROM l
), t AS MATERIALIZED (
  SELECT doc_id, text, i, w, len(w) AS n, array_to_string(w, ' ') AS own, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM k WHERE len(w) > 0
), kinds AS MATERIALIZED (
  SELECT DISTINCT concat(len(w), ' ', array_to_string(w[1:3], ' ')) AS g, own, n, w FROM t
), tree(g, own, n, w, fits) AS (
  SELECT g, own, n, w, false FROM kinds WHERE n >= 5
  UNION ALL (
    WITH sized AS (SELECT *, count(*) OVER (PARTITION BY g) AS size FROM tree WHERE NOT fits),
    grown AS (SELECT * FROM sized WHERE size > 1),
    toks AS (SELECT g, size, own, n, unnest(range(1, n + 1)) AS p, unnest(w) AS token FROM grown),
    modal AS (SELECT g, size, p, max({'c': c, 'token': token}) AS m FROM (SELECT g, size, p, token, count(*) AS c FROM toks GROUP BY ALL) GROUP BY g, size, p),
    split AS (SELECT g, arg_max(p, m.c * 100000 - p) FILTER (WHERE m.c < size) AS p FROM modal GROUP BY g),
    agree AS (SELECT g, own, count(*) FILTER (WHERE toks.token = m.token) >= ceil(any_value(n) * 0.8) AS ok FROM toks JOIN modal USING (g, p) GROUP BY g, own),
    gain AS (SELECT g, 4 * count(*) FILTER (WHERE ok) >= count(*) AS gained FROM agree GROUP BY g)
    SELECT CASE WHEN ok THEN g WHEN gained THEN g || '|rest' ELSE concat(g, '|', split.p, '=', w[split.p]) END, own, n, w, ok
    FROM grown JOIN agree USING (g, own) JOIN gain USING (g) JOIN split USING (g)
  )
), general AS (SELECT g, own FROM tree WHERE fits),
named AS MATERIALIZED (
  SELECT t.doc_id, text, i, place, n, coalesce('leaf ' || g, 'own ' || own) AS template FROM t LEFT JOIN general USING (own)
), owners AS (
  SELECT template, arg_min(text, doc_id) AS owner
  FROM (SELECT template, text, min(doc_id) AS doc_id, max(n) AS n FROM named GROUP BY template, text)
  GROUP BY template HAVING count(*) > 1 AND count(*) * max(n) >= 40
), links AS MATERIALIZED (
  SELECT b.doc_id, b.text, b.place, a.i AS i0, b.i, a.n AS n0, b.n, a.template AS t0, b.template AS t1
  FROM named a JOIN named b ON a.doc_id = b.doc_id AND a.place + 1 = b.place
), link_owners AS (
  SELECT t0, t1, count(*) AS docs, arg_min(text, doc_id) AS owner
  FROM (SELECT t0, t1, text, min(doc_id) AS doc_id FROM links GROUP BY t0, t1, text) GROUP BY t0, t1 HAVING count(*) > 1
), taken AS (
  SELECT doc_id, i0, i, n0, n, docs, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run
  FROM links JOIN link_owners USING (t0, t1) WHERE text <> owner
), long_runs AS (
  SELECT doc_id, list(i0) || list(i) AS lines FROM taken GROUP BY doc_id, run HAVING min(docs) * (sum(n) + arg_min(n0, place)) >= 40
), lost AS (
  SELECT doc_id, i FROM named JOIN owners USING (template) WHERE text <> owner
  UNION SELECT doc_id, unnest(lines) FROM long_runs
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE lost.i IS NULL), '') AS text,
  count(*) AS lines_in, count(lost.i) AS lines_lost
FROM l LEFT JOIN lost USING (doc_id, i) GROUP BY doc_id
"""

OP4_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, text, strlen(text) % 5 AS k, strlen(text) % 11 AS flaw FROM conversations),
head AS (SELECT conv_id, min(turn) AS head FROM t WHERE role = 'system' GROUP BY conv_id),
waiting AS (SELECT DISTINCT conv_id, turn + 2 AS turn FROM t WHERE role = 'user' AND k = 0),
c AS (
  SELECT t.conv_id, t.turn, CASE role WHEN 'system' THEN 'configure' ELSE 'answer' END AS name, text, flaw,
    list_sort(list_distinct([x FOR x IN [
      CASE WHEN t.turn >= 2 AND role = 'user' AND waiting.turn IS NULL THEN 'call-' || (t.turn - 2) END,
      CASE WHEN role = 'user' AND k <= 1 THEN 'call-' || (t.turn + 2) END, CASE WHEN head <> t.turn THEN 'call-' || head END] IF x IS NOT NULL])) AS deps
  FROM t LEFT JOIN head USING (conv_id) LEFT JOIN waiting ON waiting.conv_id = t.conv_id AND waiting.turn = t.turn WHERE role IN ('system', 'user')
), r AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM t WHERE role = 'assistant'),
w AS (SELECT conv_id, turn, unnest(deps) AS dep FROM c),
e AS (SELECT w.conv_id, w.turn, c.turn AS before FROM w JOIN c ON c.conv_id = w.conv_id AND w.dep = 'call-' || c.turn),
n AS (SELECT conv_id, count(*) AS n FROM c GROUP BY conv_id),
walk(conv_id, turn, steps) AS (
  SELECT conv_id, turn, 0 FROM c
  UNION SELECT e.conv_id, e.turn, steps + 1 FROM walk JOIN e ON e.conv_id = walk.conv_id AND e.before = walk.turn JOIN n ON n.conv_id = walk.conv_id WHERE steps < n.n
),
far AS (SELECT conv_id, turn, max(steps) AS steps, max(steps) >= any_value(n) AS cyclic FROM walk JOIN n USING (conv_id) GROUP BY ALL),
gone AS (
  SELECT w.conv_id, w.turn, string_agg(w.dep, ',' ORDER BY w.dep) AS missing
  FROM w LEFT JOIN c ON c.conv_id = w.conv_id AND w.dep = 'call-' || c.turn
  WHERE c.turn IS NULL GROUP BY ALL
), b AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, 'call-' || coalesce(c.turn, r.turn) AS call_id, coalesce(c.turn, r.turn + 1) AS turn, c.turn AS call_turn,
    name, text, flaw, deps, content, CASE WHEN c.turn IS NULL THEN 'orphan' WHEN r.turn IS NULL THEN 'open' ELSE 'linked' END AS status,
    len(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS words
  FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.turn = r.turn
), p AS (
  SELECT *, CASE WHEN call_turn IS NULL THEN '' WHEN flaw = 2 THEN 'missing:words' WHEN flaw = 3 THEN 'type:words' WHEN flaw = 4 THEN 'unknown:lang' ELSE '' END AS problems FROM b
)
SELECT p.conv_id, call_id, p.turn, name, status, CASE WHEN NOT cyclic THEN steps ELSE -1 END::INTEGER AS level, coalesce(cyclic, false) AS cyclic, coalesce(missing, '') AS missing, problems,
  missing IS NULL AND status <> 'orphan' AND problems = '' AND NOT cyclic AS valid, 0::BIGINT AS repeats,
  concat('{"arguments":', CASE WHEN call_turn IS NULL THEN 'null' ELSE
      concat('{', CASE WHEN flaw = 4 THEN '"lang":"xx",' ELSE '' END, '"text":', CAST(to_json(text) AS VARCHAR),
        CASE flaw WHEN 2 THEN '' WHEN 3 THEN concat(',"words":"', words, '"') ELSE concat(',"words":', words) END, '}') END,
    ',"depends_on":', CASE WHEN call_turn IS NULL THEN '[]' ELSE CAST(to_json(deps) AS VARCHAR) END, ',"id":"', call_id, '","name":',
    CASE WHEN name IS NULL THEN 'null' ELSE concat('"', name, '"') END, ',"result":', CASE WHEN content IS NULL THEN 'null' ELSE CAST(to_json(content) AS VARCHAR) END, '}') AS canonical
FROM p LEFT JOIN far ON far.conv_id = p.conv_id AND far.turn = p.call_turn LEFT JOIN gone ON gone.conv_id = p.conv_id AND gone.turn = p.call_turn
"""

OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, min(reach.b) AS component_id, 1.0::DOUBLE AS audit_recall,
  vec_id = min(reach.b) AS kept
FROM v JOIN reach ON reach.a = vec_id GROUP BY vec_id
"""



def _op13_sql(rounds: int = 5, k: int = 40, dims: int = 64) -> str:
    """The rounds one after the other; floor division by floor_div of exact integers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT row, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT v.row, cent.c, list_sum([(y[1] - y[2]) * (y[1] - y[2]) FOR y IN list_zip(v.q, cent.q)])::BIGINT AS d FROM v, c{r} AS cent
  ) GROUP BY row
)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (
  SELECT c, list(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END ORDER BY d) AS q FROM (
    SELECT best.c AS c, d, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT row, unnest(q) AS x, unnest(range({dims})) AS d FROM v) JOIN a{r} USING (row) GROUP BY 1, 2
  ) GROUP BY c
), c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v ORDER BY h, q LIMIT {k})
), {', '.join(steps)}
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
  sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(cent.q, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (row) JOIN c{rounds} AS cent ON cent.c = best.c
"""


OP13_SQL = _op13_sql()

Builder = Callable[[SparkSession, str], DataFrame]


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.clean(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    out = toolcalls.link(*toolcalls.from_turns(turns), toolcalls.turn_schemas(turns))
    # Joined lists, and -1 for no level, compare alike everywhere.
    return out.withColumns({"missing": F.array_join("missing", ","), "problems": F.array_join("problems", ","), "level": F.coalesce("level", F.lit(-1))})


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nn_descent.components(table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, sf_dir, "labels")), "score")
    return out.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        F.col("leak_words").alias("n_words"),
        F.col("leak_hit").alias("n_hit"),
        F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"),
        (F.col("leak_hit") > 0).alias("contaminated"),
    )


def op9_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitise.found_spans(docs)
    counts = [sanitise.count("base", kind).alias(f"n_{kind}") for kind in sanitise.KINDS[:4]]
    digests = found.select("key", *counts, F.sha2(sanitise.named(F.col("base")), 256).alias("base_sha256"), sanitise.named(F.col("all")).alias("spans"))
    out = docs.select("doc_id", sanitise.content().alias("key")).join(digests, "key", "left")
    none = {f"n_{kind}": 0 for kind in sanitise.KINDS[:4]} | {"base_sha256": hashlib.sha256(b"").hexdigest(), "spans": ""}
    return out.fillna(none).select("doc_id", *none)


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.from_pages(table(spark, sf_dir, "pages")))


def op11_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrowfile.read(arrowfile.write(table(spark, sf_dir, "documents")))


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Builder]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op4_tool_calls": OP4_SQL, "op5_nn_descent": OP5_SQL, "op7_bbit_minhash": OP7_SQL, "op8_decontamination": OP8_SQL, "op13_va_file": OP13_SQL}
