"""The pipeline at small scale: every stage's rows against its own definition."""
import gc
import weakref

import pyarrow as pa

import corpus_pipeline
from chartlake.llm import langid, packing, pii
from chartlake.llm.common import materialise

from .test_llm_operators import plain_components, plain_pii

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns
        old = {r.doc_id: r for r in before.collect()}
        new = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(new) == {d for d, r in old.items() if langid.normalise(r.text or "")}
            found = {r.doc_id: r.lang_pred for r in langid.identify(before).collect()}
            assert all(r.lang == found[d] and r.text == old[d].text for d, r in new.items())
        elif name == "near_duplicates":
            rows = [(d, r.text) for d, r in old.items()]
            assert set(new) == set(plain_components(rows)[1])
        elif name == "decontamination":
            assert {d for d, r in old.items() if any(i in r.text for i in items)} == set(old) - set(new)
        else:
            assert set(new) == set(old)
            assert all((new[d].text != old[d].text) == bool(plain_pii(old[d].text)) for d in old)
    pieces = packing.pack(docs).count()
    assert pieces >= docs.count() == pii.redact(docs).count()
    assert corpus_pipeline.run(spark, SF).count() == pieces


def test_stages_take_any_table(spark, tmp_path):
    """Nulls in any column, clashing extra columns, repeated rows, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, fp long, `a.b` int, held_out string"
    text = "This row holds a letter or two and goes on for some more words than that, mail me at a@b.org"
    rows = [(1, text, "en", "s", 5, "r", 1, 2, "h"), (1, text, "en", "s", 5, "r", 1, 2, "h"), (2, None, None, None, None, None, None, None, None),
            (3, "", "en", None, None, None, None, None, None), (4, "12 .. ! 34", "en", "s", 1, "r", 1, 2, "h"),
            (None, "no id but words", None, None, None, None, None, None, None), (5, "other words here", "en", "s", 1, "r", 1, 2, "h")]
    for data, kept in ((rows, {1, 5, None}), ([], set())):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF), "any")
            assert docs.columns == [f.split()[0].strip("`") for f in schema.split(", ")]
        assert {r.doc_id for r in docs.collect()} == kept
        assert "b.org" not in " ".join(r.text for r in docs.collect())
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert {r.doc_id for r in pieces} == kept


def test_a_worker_keeps_one_operators_things():
    from chartlake.llm.common import held
    made = []

    def make():
        made.append(1)
        return object()

    first = held(("langid", 1), make)
    assert held(("langid", 1), make) is first and len(made) == 1
    model = type("Model", (), {})
    gone = weakref.ref(held(("langid", 2), model))
    assert gone() is not None
    held(("packing", "file"), make)
    gc.collect()
    assert gone() is None                        # dropped when the next operator came


def test_language_batches_come_back_in_stretches(monkeypatch):
    from chartlake.llm import langid
    monkeypatch.setattr(langid, "CHARS", 100)
    texts = ["the cat sat on the mat"] * 9 + [None, "", "x" * 300, "le chat est sur la table"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)), pa.array(texts)],
                                       names=["row", "held_out", "text"])
    samples = (("en", ("the cat and the dog sat on the mat",)), ("fr", ("le chien et le chat sur la table",)))
    out = list(langid._predict(samples, True)(iter([batch])))
    assert len(out) > 2 and max(b.column(3).nbytes for b in out) < batch.column(2).nbytes
    rows = pa.Table.from_batches(out)
    assert rows["row"].to_pylist() == list(range(len(texts))) and rows["text"].to_pylist() == texts
    whole = langid.Parser({k: list(v) for k, v in samples}).predict(texts)
    assert list(zip(rows["lang_pred"].to_pylist(), rows["score"].to_pylist())) == whole
