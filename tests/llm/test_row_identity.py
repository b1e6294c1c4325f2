"""The pipeline's filters on null and repeated ids."""

import corpus_pipeline
from attesta.llm import decontam


def kept(df):
    return sorted(((str(r.doc_id), r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_near_dedup_decides_by_row(spark, docs_of, prose):
    a, b, c, d = (prose(80, i) for i in range(4))
    rows = [(1, a), (None, a), (None, b), (None, b), (2, c), (2, d), (3, c), (None, None), (4, ""), (0, "x y"), (0, "X  y")]
    out = kept(corpus_pipeline.near_dedup(spark, docs_of(rows), ""))
    assert [r for r in out if r[0] != "0"] == sorted([("1", a), ("None", b), ("2", c), ("2", d), ("4", "")], key=str)
    assert len([r for r in out if r[0] == "0"]) == 1


def test_decontamination_decides_by_row(spark, docs_of, prose, tmp_path, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 1)
    items, clean = [prose(40, 1), prose(40, 2)], prose(60, 3)
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, clean + " " + items[0]), (None, items[1]), (None, clean), (5, items[1]), (5, clean), (6, None), (7, items[0])]
    out = corpus_pipeline.decontamination(spark, docs_of(rows), str(tmp_path))
    assert kept(out) == sorted([("None", clean), ("5", clean), ("6", None)], key=str)
