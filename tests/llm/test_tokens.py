"""BPE against the tokenizers library, word pieces against plain longest match, languages, quality."""

import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_edges import ROWS, by_id, documents, empty

from telewarden.llm import bpe, langid, quality, wordpiece
from telewarden.llm.common import ship
from telewarden.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
RANDOM = random.Random(3)
LETTERS = " \n\t\r  aaa'stre''llé漢字123٣²ª!!..…🙂 　\u0085\x1c​ẞİK<|endoftext|>"
TEXTS = [
    "", " ", "  ", "a ", " a", "foo\n bar", "foo \nbar", "don't I'll we've 's", "a" * 5000, "ab" * 3000, "\x00",
    "a<|endoftext|>b <|endoftext|>  <|endoftext|><|endoftext|> x", "<|endoftext|>",
    *("".join(RANDOM.choice(LETTERS) for _ in range(RANDOM.randint(0, 60))) for _ in range(1500)),
    *(f"x{chr(c)}{chr(c)} {chr(c)}1" for c in range(0, 0x3000, 3)),
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def test_ids_and_texts_equal_the_library(library, monkeypatch):
    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary_path()))
    expected = [x.ids for x in library.encode_batch(TEXTS, add_special_tokens=False)]
    monkeypatch.setattr(bpe, "REMEMBERED", 100)  # forgetting must not change ids
    for start in (0, 700):
        ids, bounds = encoder.encode(TEXTS[start:])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == expected[start:]
        assert encoder.decode(ids, bounds) == [library.decode(x, skip_special_tokens=False) for x in expected[start:]]
    assert encoder.decode(np.array([171, 50256]), np.array([0, 1, 2])) == ["�", "<|endoftext|>"]


def test_bpe_over_documents(spark, library):
    docs = documents(spark)
    encoded = bpe.encode(spark, docs, vocabulary_path(), decoded=True)
    found = by_id(bpe.digests(encoded).collect())
    expected = []
    for key, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined = ",".join(map(str, ids))
        plain = library.decode(ids, skip_special_tokens=False)
        expected.append((key, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    assert found == by_id(expected)
    back = by_id(bpe.decode(spark, encoded, vocabulary_path()).collect())
    assert back == by_id((key, text or "") for key, text, *_ in ROWS)
    assert bpe.digests(bpe.encode(spark, empty(spark), vocabulary_path(), decoded=True)).collect() == []


def longest_match(word, entries):
    count = 0
    while word:
        size = next((n for n in range(len(word), 0, -1) if word[:n] in entries), 0)
        if not size:
            return -1
        word, count = word[size:], count + 1
    return count


@pytest.mark.parametrize("entries", [
    [b"a", b"ab", b"abc", b"bcd", b"cd", b"d", b"abcdx"], [b"b", b"aaa", b"a"], [b"abcd", b"bc"], [],
])
def test_automaton_equals_longest_match(entries):
    words = [bytes(RANDOM.choice(b"abcdx") for _ in range(RANDOM.randint(0, 9))) for _ in range(2000)]
    found = wordpiece.Automaton(entries).counts(words)
    assert found.tolist() == [longest_match(w, set(entries)) for w in words]


def test_token_counts_over_documents(spark):
    import regex

    entries = wordpiece.byte_entries(vocabulary_path())
    known, expected = set(entries), []
    for key, text, *_ in ROWS:
        words = regex.findall(bpe.PATTERN, text or "")
        sizes = {w: longest_match(w.encode(), known) for w in set(words)}
        expected.append((key, len(words), sum(sizes[w] for w in words), 0))
    assert by_id(wordpiece.token_counts(spark, documents(spark), entries).collect()) == by_id(expected)
    lacking = wordpiece.token_counts(spark, documents(spark, [(1, "aab c", None, None)]), [b"a", b" c"])
    assert [tuple(r) for r in lacking.collect()] == [(1, 2, 2, 1)]
    assert wordpiece.token_counts(spark, empty(spark), entries).collect() == []


WORDS = {"xx": "bano kilo rano melo tiko sano vilo".split(), "yy": "schrump glorft dwelkh zwurg pflanst".split()}


def invented(lang, n, seed):
    random = np.random.default_rng(seed)
    return " ".join(random.choice(WORDS[lang], n))


def is_held(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


def test_languages(spark):
    rows = [(i, invented(lang, 30, i), lang, None) for i, lang in enumerate(["xx", "yy"] * 30)]
    rows += [(1000, invented("xx", 40, 1) + " " + invented("yy", 12, 2), None, None), (1001, "12 -- 7", "xx", None)]
    rows += [(1002, None, "yy", None), (1003, "", None, None), (None, invented("yy", 9, 3), None, None)]
    rows += [(1004, invented("yy", 40_000, 4), None, None), (1004, invented("xx", 5, 4), None, None)]
    docs = documents(spark, rows)
    found = langid.predict(docs, langid.fit(docs)).collect()
    assert len(found) == len(rows)
    by = {(r.doc_id, r.lang_pred) for r in found}
    assert all((i, lang) in by for i, _, lang, _ in rows[:60])
    mixed = next(r for r in found if r.doc_id == 1000)
    assert mixed.lang_pred == "xx" and {x.lang for x in mixed.langs} == {"xx", "yy"}
    assert 0.7 < mixed.score < 0.85
    assert {(1001, "und"), (1002, "und"), (1003, "und"), (None, "yy"), (1004, "xx"), (1004, "yy")} <= by
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    none = langid.predict(docs, langid.fit(empty(spark))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert langid.predict(empty(spark), langid.fit(docs)).collect() == []


def test_languages_learn_from_no_held_out_row(spark):
    rows = [(i, invented("xx", 20, i), "xx", None) for i in range(40)]
    rows += [(i, invented("yy", 20, i), "yy", None) for i in range(40, 80) if is_held(i)]
    assert langid.fit(documents(spark, rows)).langs == ["xx"]


def test_quality(spark):
    def text(good, i):
        words = invented("xx" if i % 2 else "yy", 60, i).split()
        return " ".join(words) if good else " ".join(f"{w}!!" for w in words)

    rows = [(i, text(i % 3 > 0, i), None, None) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0) if is_held(i) is False else int(i % 3 == 0), 0) for i in range(300)]
                                   + [(None, 1, 0), (7, None, 0), (9, 0, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows + [(1000, None, None, None), (1000, "", None, None), (None, text(True, 1), None, None)])
    model = quality.fit(spark, docs, labels)
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(rows) + 3 and all(0 <= r.score <= 1 for r in scored)
    # The held-out labels are wrong on purpose: a model that had seen them would not fit the texts.
    wrong = [r.doc_id for r in scored if r.doc_id is not None and r.doc_id < 300 and (r.score >= 0.3) != (r.doc_id % 3 > 0)]
    assert wrong == []
    again = quality.score(docs, quality.fit(spark, docs, labels)).collect()
    assert by_id(again) == by_id(scored)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 300) == [i for i in range(300) if i % 3]


def test_quality_with_little_to_learn_from(spark):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark)
    for given in (labels, labels.limit(0)):
        assert len({r.score for r in quality.score(docs, quality.fit(spark, docs, given)).collect()}) == 1
    model = quality.fit(spark, empty(spark), labels)
    assert quality.score(empty(spark), model).collect() == []
    assert quality.accepted(empty(spark), model).collect() == []


def test_network_is_calibrated():
    random = np.random.default_rng(0)
    x = random.standard_normal((4000, 3))
    y = (random.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    p = quality.Network(x, y)(x)
    for low in (0.1, 0.3, 0.5, 0.7):
        inside = (p >= low) & (p < low + 0.2)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.08


def test_pooling_ignores_neighbouring_texts():
    vectors = np.random.default_rng(0).standard_normal((quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    texts = ["one two", "", "two two three!", None, "x"]
    alone = np.concatenate([quality.pooled(vectors, pa.array([t], pa.string())) for t in texts])
    assert np.allclose(quality.pooled(vectors, pa.array(texts, pa.string())), alone, atol=1e-5)


def test_long_words_equal_the_library_and_take_linear_time():
    """Words without spaces, merged by links."""
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    library.no_truncation()
    library.no_padding()
    r = random.Random(1)
    alphabets = ("abcdefghijklmnopqrstuvwxyz", "ab", "a", "éüñßл中文", "0123456789", "etaoin", "-_=+.", "the")
    texts = ["".join(r.choice(a) for _ in range(n)) for a in alphabets for n in (255, 256, 257, 1000, 5000)]
    texts += [" " * 3000 + "x", "aaaa" * 700 + " bbb" * 10, "x" * 100_000, "".join(r.choice(alphabets[0]) for _ in range(100_000))]
    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary_path()))
    ids, bounds = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids

    def seconds(n):
        text = "".join(r.choice(alphabets[0]) for _ in range(n))
        started = time.process_time()
        bpe.merge(encoder.vocabulary, [text.encode()])
        return time.process_time() - started

    assert seconds(320_000) < 8 * 2.5 * seconds(40_000) + 0.5
