"""Each stage of the pipeline against a plain version, and all of them over odd rows."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest

from pixeltally.llm import language_id, line_dedup, minhash, mixing
from test_edges import ROWS, brute_near

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before each stage and what the last one returns, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    found = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF_DIR).write.parquet(str(folder / name))
        found.append(spark.read.parquet(str(folder / name)))
    return [f.toArrow().to_pylist() for f in found]


def test_columns_stay(steps):
    assert all(list(step[0]) == list(steps[0][0]) for step in steps[:-1])


def test_language_stage_keeps_what_has_words(steps):
    kept = {r["doc_id"] for r in steps[1]}
    assert len(kept) >= 0.98 * len(steps[0])
    assert all(any(c.isalpha() for c in r["text"]) for r in steps[1])


def test_language_stage_without_labels(spark):
    rows = [(1, "some words", None), (2, "12 !?", None), (3, None, None), (4, "ein Text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SF_DIR).collect()) == [1, 4]


def test_line_stage(steps):
    pages, lines = Counter(r["source"] for r in steps[1]), Counter()
    for r in steps[1]:
        lines.update((r["source"], line) for line in set(r["text"].split("\n")) if line.strip(" "))
    expected = {}
    for r in steps[1]:
        expected[r["doc_id"]] = "\n".join(
            line for line in r["text"].split("\n")
            if not (lines[r["source"], line] >= line_dedup.LEAST_PAGES and lines[r["source"], line] > line_dedup.RATIO * pages[r["source"]]))
    assert {r["doc_id"]: r["text"] for r in steps[2]} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2])


def test_near_stage(steps):
    groups = brute_near([(r["doc_id"], r["text"]) for r in steps[2]], minhash.SHINGLE, minhash.PERCENT)
    assert sorted(r["doc_id"] for r in steps[3]) == sorted(i for i, (_, least) in groups.items() if i == least)


def test_near_stage_keeps_a_row_of_each_group(spark):
    copy, unique, third = (" ".join(f"{name}{k}" for k in range(40)) for name in ("copy", "unique", "third"))
    rows = [(1, copy), (2, copy + " more"), (2, unique), (3, third), (3, third), (None, third), (None, "alone " + unique[:60]),
            (None, "alone " + unique[:60]), (None, None), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    assert Counter(map(tuple, found)) == Counter(
        [(1, copy), (2, unique), (3, third), (None, "alone " + unique[:60]), (None, None), (4, None), (4, "")])


def test_mixing_stage(steps):
    sizes = defaultdict(int)
    for r in steps[3]:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    goal, taken = mixing.targets(sizes), defaultdict(int)
    texts = {r["doc_id"]: WORD.findall(r["text"]) for r in steps[3]}
    for r in steps[4]:
        words = WORD.findall(r["text"])
        taken[r["source"]] += len(words)
        assert " ".join(words) in " ".join(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert all(abs(taken[s] - goal[s]) <= 32 + 0.005 * goal[s] for s in sizes)


def test_packing_stage(steps):
    assert Counter(r["doc_id"] for r in steps[4]) == Counter(r["doc_id"] for r in steps[5] if r["piece"] == 0)


def test_run_gives_the_last_stage(spark, steps):
    rows = corpus_pipeline.run(spark, SF_DIR).toArrow().to_pylist()
    assert sorted(map(str, rows)) == sorted(map(str, steps[-1]))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_accept_odd_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, whole_row string, carry string, no_column string"
    rows = [(*r, None, "x", "y", "z") for r in ROWS]
    docs = spark.createDataFrame(rows, schema)
    found = stage(spark, docs, SF_DIR)
    assert found.count() > 0
    assert name == "packing" or found.columns == docs.columns
    assert stage(spark, docs.limit(0), SF_DIR).collect() == []


def test_ambiguous_languages_are_flagged():
    import numpy as np

    model = language_id.Model(["a", "b"], language_id.codewords(2), np.zeros((4, 1)), np.zeros(1), np.ones(1))
    _, score, flag = model.decode(np.zeros((1, 4)))
    assert flag[0] and score[0] == 0.5
