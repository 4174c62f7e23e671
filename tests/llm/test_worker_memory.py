"""Python workers: none where a stage needs none, one a task in decontamination, and empty when idle."""

import corpus_pipeline as pipe
from canvass.llm import common as C
from canvass.llm import decontaminate as decon

ITEMS = ["one two three four five six", "red blue green pink grey white", "north east south west up down"]


def _docs(spark):
    texts = {i: f"start {i} {ITEMS[i % 3]} and then {ITEMS[(i + 1) % 3]}, some more words for {i} that stay" for i in range(30)}
    texts[30], texts[31], texts[32] = None, "", ITEMS[0]
    return spark.createDataFrame([(i, t, len(t or ""), "x") for i, t in texts.items()], "doc_id long, text string, n_chars long, lang string")


def test_line_dedup_runs_no_python(spark, monkeypatch):
    docs = _docs(spark)

    def fail(*args, **kw):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(docs), name, fail)
    assert {0, 30, 31} <= {r.doc_id for r in pipe.line_dedup(spark, docs, "").collect()}


def test_decontamination_is_one_pass(spark):
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(ITEMS)], "item_id string, text string")
    docs = _docs(spark)
    out = decon.decontaminate(docs, items)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    whole = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and set(whole) == set(range(32))
    assert whole[4].text == "start 4  and then , some more words for 4 that stay" and whole[30].text is None
    parts = decon.decontaminate(docs, items, shard_words=4)   # the items dealt to several passes
    assert {r.doc_id: r for r in parts.collect()} == whole


def test_idle_workers_hold_nothing(spark):
    def work(ids):
        was = C._held.get("key") == "mine"
        C.held("mine", lambda: [0])
        return ([was] * len(ids),)

    got = C.with_arrow(spark.range(0, 64, 1, 64), ["id"], [("was", "boolean")], work)
    assert got.where("was").count() == 0
