import corpus_pipeline
from glossa.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dedup import brute as groups
from tests.llm.test_near_dedup import shingles
from tests.llm.test_templates import brute as lines


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    names, steps = docs.columns, dict(corpus_pipeline.STAGES)
    pairs = lambda d: [(r.doc_id, r.text) for r in d.collect()]

    kept = stored(steps["toxicity"](spark, docs, SF_SMALL), "t1")
    assert kept.columns == names and 0 < kept.count() <= docs.count()

    before, kept = pairs(kept), stored(steps["line dedup"](spark, kept, SF_SMALL), "t2")
    assert kept.columns == names
    want = [(doc, t) for (doc, t), (_, old) in zip(lines(before), before) if t == old or t.strip()]
    assert sorted(pairs(kept)) == sorted(want)

    before, kept = pairs(kept), stored(steps["near dedup"](spark, kept, SF_SMALL), "t3")
    assert kept.columns == names
    assert sorted(r[0] for r in pairs(kept)) == sorted(doc for doc, _, c in groups(before) if doc == c)

    before, kept = pairs(kept), stored(steps["decontamination"](spark, kept, SF_SMALL), "t4")
    assert kept.columns == names
    assert sorted(r[0] for r in pairs(kept)) == sorted(doc for doc, _, hit, _ in leaks(before, items, 10) if not hit)

    packed = steps["packing"](spark, kept, SF_SMALL).toPandas()
    assert sorted(packed.doc_id.unique()) == sorted(r[0] for r in pairs(kept))
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None, 1), (1, None, None, None, None, 1), (None, "", "en", "s", 0, 1), (3, "x " * 20_000, None, "s", 5, 1), (4, "same words here", "en", None, 5, 1), (4, "same words here", "en", None, 5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, leak_hit int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "odd")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "leak_hit"], name
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert left.count((1, None)) == 2 and (None, "") in left and left.count((4, "same words here")) == 1 and len(left) == 5
    assert shingles(docs.where("doc_id = 3").first().text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.where("piece = 0").count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
