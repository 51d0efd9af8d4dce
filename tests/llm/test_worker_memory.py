"""What Python workers hold beside the executor's heap: no whole batch of texts, no second copy, no idle workers."""

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pixeltally.llm import language_id, mixing, packing, registry
from pixeltally.llm.common import small_table, stored

MODEL = language_id.Model(["a", "b"], language_id.codewords(2), np.zeros((language_id.FEATURES, 1)), np.zeros(1), np.ones(1))


def test_answers_hold_a_slice_of_a_batch():
    rows, length = 20_000, 2_000
    texts = pa.array([f"{n:0{length}}" for n in range(rows)])
    batch = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([texts], ["text"])], names=["carry"])
    tracemalloc.start()
    found = [b.num_rows for b in language_id._answers(lambda: MODEL, 0)(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) == rows and max(found) == language_id.AT_ONCE
    assert peak < rows * length / 4


def test_answers_stand_beside_their_rows():
    texts = [None, "", "7", *[f"words {chr(97 + n % 26)}{n}" for n in range(3 * language_id.AT_ONCE)]]
    apart = pa.RecordBatch.from_arrays(
        [pa.StructArray.from_arrays([pa.array(range(len(texts)))], ["n"]), pa.array(texts)], names=["carry", "text"])
    carried = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array(texts)], ["text"])], names=["carry"])
    first, second = (
        pa.Table.from_batches(language_id._answers(lambda: MODEL, place)(iter([b]))) for b, place in ((apart, None), (carried, 0)))
    assert [r["n"] for r in first["carry"].to_pylist()] == list(range(len(texts)))
    assert [r["text"] for r in second["carry"].to_pylist()] == texts
    assert first.drop_columns("carry") == second.drop_columns("carry")
    assert first["lang_pred"].to_pylist()[:3] == ["und"] * 3 and "und" not in first["lang_pred"].to_pylist()[3:]


def test_the_language_stage_sends_a_text_once(spark):
    docs = spark.createDataFrame([(n, f"some words {n}", "en") for n in range(20)], "doc_id long, text string, lang string")
    found = corpus_pipeline.identify_language(spark, docs, "")
    assert found.columns == docs.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    # What goes to the workers: all columns in one struct, and no text beside it.
    sent = found._jdf.queryExecution().analyzed().toString().split("MapInArrow")[1].split("\n")[1]
    assert "AS carry" in sent and "AS text" not in sent


def test_mixing_starts_no_other_workers(spark, plan_of):
    docs = spark.createDataFrame([(n, f"some words {n}", "s" if n % 3 else None) for n in range(30)], "doc_id long, text string, source string")
    assert "ExistingRDD" not in plan_of(mixing.mix(stored(docs, "mix-input")))


def test_small_tables(spark):
    rows, schema = [(None, 1, 2, 0.5), ("a", 2**40, -1, 1e300)], "s string, l long, i int, d double"
    assert sorted(map(tuple, small_table(spark, rows, schema).collect()), key=str) == sorted(rows, key=str)
    assert small_table(spark, rows, schema).dtypes == spark.createDataFrame(rows, schema).dtypes
    assert small_table(spark, [], schema).collect() == [] and small_table(spark, [], schema).filter(F.col("l") > 0).count() == 0


def test_the_cache_has_a_word_once_whatever_mark_follows():
    words = packing.WordTokenizer(registry.tokenizer_path())
    texts = [f"{word}{mark}" for word in ("river", "stone", "é") for mark in ("", *packing.MARKS)]
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words([" ".join(texts)]) == [b"".join(expected)] and words(texts) == expected
    assert set(words.known) == {"river", "stone", "é"}
