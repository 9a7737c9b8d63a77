"""The pipeline on a small corpus, against its stages done by hand."""

import hashlib

import numpy as np
import pytest
from llm_edges import by_id
from test_near_duplicates import plain_components

import corpus_pipeline
from telewarden.llm import queries
from telewarden.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


def invented(n, seed):
    random = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "bdgkl" for b in "aeiou" for c in ("nt", "rm", "sk", "l")]
    return " ".join(random.choice(words, n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    leak = invented(30, 99_999)
    rows = []
    for i in range(240):
        text = invented(80, i)
        if i % 5 == 0:
            text = " ".join(w + "!!" for w in text.split())
        elif i % 12 == 1:
            text = invented(80, 1)
        elif i % 12 == 2:
            text = f"{text} {leak} {invented(20, 7)}"
        elif i % 12 == 3:
            text += " write to some.one@mail.example.com"
        rows.append((i, text, "xx", "s", len(text)))
    rows += [(500, None, None, None, None), (501, "", "xx", "s", 0), (501, "", "xx", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(240)] + [(500, 1, 0), (501, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, invented(25, 88_888))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_stages_take_effect(spark, folder):
    root, rows = folder
    good = [r for r in rows if r[0] >= 500 or r[0] % 5]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, root)
        assert docs.columns == columns
        path = f"{root}/stage_{len(kept)}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(by_id(docs.collect()))
    graded, single, clean, redacted = kept
    graded_ids = {r[0] for r in graded}
    assert {r[0] for r in good if r[0] < 500} == {i for i in graded_ids if i < 500}
    rejected_empty = {500, 501} - graded_ids
    components = {(i, c) for i, _, c in plain_components([r for r in good if r[0] not in rejected_empty])}
    assert [r[0] for r in single] == sorted({i for i, c in components if i == c})
    assert [r[0] for r in clean] == [r[0] for r in single if r[0] >= 500 or r[0] % 12 != 2]
    assert [r[0] for r in redacted] == [r[0] for r in clean]
    for before, after in zip(clean, redacted):
        assert after[1] == (before[1] and before[1].replace("some.one@mail.example.com", "[EMAIL]"))
        assert after[4] == (None if after[1] is None else len(after[1]))
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    final = by_id(corpus_pipeline.run(spark, root).select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    expected = []
    for key, text, *_ in redacted:
        ids = library.encode(text or "", add_special_tokens=False).ids
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text or "")]
        expected.append((key, ids, len(ids), *hashes))
    assert final == expected


def test_stages_on_an_empty_table(spark, folder, tmp_path):
    root, _ = folder
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{number}")
        assert spark.read.parquet(f"{tmp_path}/{number}").count() == 0


def test_registered_queries():
    import __spark_entry__ as driver

    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert driver.queries()["pipeline"] is corpus_pipeline.run and set(queries.QUERIES) == set(names)
