"""The pipeline's stages: planted cases, kept columns, whole results."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe

ITEM = "the quick silver fox went over nine lazy rivers before dawn broke on monday"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with a toxic document, copies, a near copy and a benchmark passage; clash and null columns."""
    r = random.Random(3)
    word = lambda: "".join(r.choice(["ba", "to", "li", "ne", "ru", "sa"]) for _ in range(r.randint(1, 4)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n))
    docs = {i: text(6) for i in range(200)}
    labels = []
    for i in range(200):
        if i % 4 == 0:
            docs[i] += " " + " ".join(["grux", word(), "zork", word()] * 3)
        labels.append((i, 1, int(i % 4 == 0)))
    docs[301], docs[302] = docs[1], docs[1]                        # exact copies
    docs[303] = docs[2].replace("\n", " ")                         # a copy with other line ends
    docs[304] = docs[5] + "\nSo " + ITEM + ". And on."
    docs[305], docs[306] = "", None
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(d, t, None, "src", len(t) if t is not None else None, "mine") for d, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("1", ITEM)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipe.STAGES[:-1]:
        out = stage(spark, docs, folder).persist()
        assert out.columns == docs.columns and out.where("score != 'mine'").count() == 0
        kept[name] = {r.doc_id: r for r in out.collect()}
        docs = out
    toxic = {i for i in range(200) if i % 4 == 0}
    assert len(toxic & set(kept["toxicity"])) <= 3 and set(range(200)) - toxic - set(kept["toxicity"]) == set()
    assert {305, 306} <= set(kept["toxicity"])
    lines = kept["line_dedup"]
    assert 1 in lines and not {301, 302} & set(lines) and {305, 306} <= set(lines)
    assert lines[304].text.startswith("So the quick") and lines[304].n_chars == len(lines[304].text)
    near = kept["near_dedup"]
    assert 2 in near and 303 not in near and {305, 306, 304} <= set(near)
    clean = kept["decontamination"]
    assert 306 in clean and all("quick silver fox" not in (r.text or "") for r in clean.values())
    assert clean[3].text == kept["near_dedup"][3].text
    packed = pipe.packing(spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(clean)


def test_run_and_empty(spark, folder, tmp_path):
    got = pipe.run(spark, folder)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipe.run(spark, str(tmp_path)).count() == 0
