"""Personal data, licenses, main text and benchmark passages against plain searches."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from llm_edges import LONG, ROWS, by_id, documents, empty

from telewarden.llm import decontamination, html_text, licenses, pii
from telewarden.llm.common import ship

RANDOM = random.Random(5)
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def checksum(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and checksum(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if good():
                found.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    texts = ["".join(RANDOM.choice("a@b.c-+ 1234567890.@+()_%é") for _ in range(RANDOM.randint(0, 80))) for _ in range(8000)]
    texts += ["".join(RANDOM.choice("0123456789 -+") for _ in range(40)) for _ in range(8000)]
    texts += ["1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1", "a@b.c_d@e.f", "a" * 5000, "1" * 4000 + ".1.1.1", "@" * 1000]
    for text in texts:
        assert [(s, pii.KINDS.index(k), e) for k, s, e, base, _ in pii.find_spans(text) if base] == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "a@" * 100_000):
        pii.find_spans(text)


def seconds(work, *arguments):
    started = time.process_time()
    work(*arguments)
    return time.process_time() - started


@pytest.mark.parametrize("line", ["me@x.org 4111111111111111 555-123-4567 tel, ", "call 555-123-4567, ", "DE89 3704 0044 0532 0130 00, "])
def test_many_spans_take_linear_time(line):
    seconds(pii.find_spans, line * 100)
    assert seconds(pii.find_spans, line * 32_000) < 8 * 2.5 * seconds(pii.find_spans, line * 4_000) + 0.2


@pytest.mark.parametrize("text,expected", [
    ("+1 (555) 123-4567 4111111111111111", ["phone:0:17", "card:18:34"]),
    ("+49 30 1234567 4111-1111 1111 1111 10.0.0.1", ["phone:0:14", "card:15:34", "ip:35:43"]),
    ("call me: 555-123-4567 today", ["phone:9:21"]), ("lot 555-123-4567 today", []),
    ("account DE89 3704 0044 0532 0130 00", ["iban:8:35"]), ("DE89 3704 0044 0532 0130 02", []),
    ("ssn 219-09-9999", ["ssn:4:15"]), ("part 219-09-9999", []), ("ssn 000-09-9999", []),
    ("é mail x.y@z.example.org.", ["email:7:24"]),
])
def test_spans_of_the_method(text, expected):
    assert [f"{k}:{s}:{e}" for k, s, e, *_ in pii.find_spans(text)] == expected


@pytest.mark.parametrize("text,expected", [
    ("BE68 5390 0754 7034 BIC GKCCBEBB", ["iban:0:19"]), ("to ES9121000418450200051332 EUR", ["iban:3:27"]),
    ("BE68539007547034 IBAN", ["iban:0:16"]), ("DE89 3704 0044 0532 0130 00 BE68 5390 0754 7034", ["iban:0:27", "iban:28:47"]),
    ("BE68 5390 0754 7035 BIC", []), ("NR12 3456 DE89 3704 0044 0532 0130 00", ["iban:10:37"]),
    ("NL91ABNA0417164300 NOTE", ["iban:0:18"]), ("NO9386011117947 SWIFT", ["iban:0:15"]),
])
def test_accounts_before_other_capitals(text, expected):
    found = [f"{k}:{s}:{e}" for k, s, e, *_ in pii.find_spans(text) if k == "iban"]
    assert found == expected


def test_personal_data_over_documents(spark):
    rows = [*ROWS, (8, "é a@b.cd and +49 30 1234567, 4111-1111 1111 1111; 10.0.0.1", "en", "d")]
    found = by_id(pii.digests(pii.detect(documents(spark, rows))).collect())
    expected = []
    for key, text, *_ in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        expected.append((key, *counts, hashlib.sha256(joined.encode()).hexdigest(), joined))
    assert found == by_id(expected)
    assert pii.digests(pii.detect(empty(spark))).collect() == []


def test_redaction(spark):
    docs = documents(spark, [*ROWS, (8, "to a@b.cd or +49 30 1234567.", "en", "d")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    rows = by_id(out.collect())
    assert rows[-1][1] == "to [EMAIL] or [PHONE]." and rows[-1][4] == len(rows[-1][1])
    assert [r[:5] for r in rows[:-1]] == [r[:5] for r in by_id(documents(spark).collect())]
    assert pii.redact(empty(spark)).collect() == []


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        phrase = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses_equal_a_plain_search(spark):
    rows = [
        *ROWS, (20, "MIT License mit license. Apache-License cc-by CC by nc gnu General public license", None, None),
        (21, "mit license " * 3000, None, None), (22, "K mit licensé mİt license CC\nBY", None, None),
        (23, "a gnu general public gnu general public license mit", None, None), (None, "cc by", None, None),
    ]
    found = by_id(r[:6] for r in licenses.scan(spark, documents(spark, rows)).collect())
    assert found == by_id((key, *plain_places(text)) for key, text, *_ in rows)
    assert licenses.scan(spark, empty(spark)).collect() == []


def test_long_texts_take_linear_time(spark):
    """Forty times the words must not take more than some times as long, most of which is fixed cost."""
    def scanned(n):
        return licenses.scan(spark, documents(spark, [(1, "some other words and mit license " * n, None, None)], clashing=False)).collect()

    scanned(10)
    started = time.time()
    short = scanned(1_000)
    middle = time.time()
    long = scanned(40_000)
    assert time.time() - middle < 10 * (middle - started) + 5
    assert [(r.n_words, r.n_base) for r in (*short, *long)] == [(6_000, 1_000), (240_000, 40_000)]


def test_edited_license_passages(spark):
    mit = licenses.PASSAGES[0][0].split()
    inserted = " ".join([*mit[:9], "really", *mit[9:]])
    rows = [(1, " ".join(mit), None, None), (2, inserted, None, None), (3, " ".join(mit[::2]), None, None), (4, "cc by sa", None, None)]
    found = {r.doc_id: (r.labels, r.base_labels, r.score) for r in licenses.scan(spark, documents(spark, rows)).collect()}
    assert found[1] == ("mit", "", 1.0) and found[2][:2] == ("mit", "") and 0.9 < found[2][2] < 1
    assert found[3][:2] == ("", "") and found[4] == ("cc-by,cc-by-sa", "cc-by", 1.0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="ad">Buy this now, it is good.</div>
%s<aside><p>Side text that is long enough to look like something real.</p></aside><form><p>Your name</p></form>
<footer>&copy; 2020</footer></body></html>"""
BODY = ("<h2>Real  title</h2><p>First &amp; best paragraph with a good deal of text&nbsp;in it, certainly.<p>Short.</p>"
        "<ul><li>Item <b>one</b> of the list here<li>Item two</ul><p>Another paragraph<br>with some text in it, certainly.</p>"
        "<div class='reader comments'><p>Great post, I love it very much indeed, thanks a lot!</p></div>")
TEXT = "Real title\nFirst & best paragraph with a good deal of text in it, certainly.\nShort.\nItem one of the list here\nItem two\nAnother paragraph with some text in it, certainly."


@pytest.mark.parametrize("html,text", [
    (PAGE % f"<article>{BODY}</article>", TEXT), (PAGE % f"<main><div>{BODY}</div></main>", TEXT),
    (PAGE % f"<div id=content>{BODY}</div>", TEXT), (PAGE % "", ""), ("", ""), ("no markup at all", "no markup at all"),
    ("<article><p>Only.</article>", "Only."), ("<article><p>unclosed &lt;b", "unclosed <b"),
    ("<article><p>" + "long words " * 20_000 + "</p></article>", ("long words " * 20_000).strip()),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


FURNITURE = ("<div class='site-nav'><a href=x>Home</a> and more</div><p class='cookie-notice'>We use cookies here, as all do.</p>"
             "%s<div class='widget-area'><p>A word from our friends, not long.</p></div>")
PARAGRAPHS = [f"Paragraph {i} of the text, which has about as many letters as such a paragraph has." for i in range(9)]
BLOCK = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
COMMENTS = "<ol class='comment-list'><li><article class='comment'><p>I do not agree with any of this at all.</p></article></ol>"


@pytest.mark.parametrize("html", [
    FURNITURE % f"<div class='content no-sidebar'>{BLOCK}</div>",
    FURNITURE % f"<div class='content no-sidebar'>{BLOCK}<div class='sidebar'><p>Side text, a little.</p></div></div>",
    FURNITURE % "".join(f"<div class='elementor-widget elementor-widget-text-editor'>{BLOCK[a:b]}</div>" for a, b in (
        (0, BLOCK.index("<p>Paragraph 4")), (BLOCK.index("<p>Paragraph 4"), len(BLOCK)))),
    FURNITURE % f"<div class='elementor-widget elementor-widget-heading'><h2>{PARAGRAPHS[0]}</h2></div>"
    f"<div class='elementor-widget elementor-widget-text-editor'>{BLOCK[BLOCK.index('<p>Paragraph 1'):]}</div>",
    FURNITURE % f"<article class='post category-reviews'>{BLOCK}</article>",
    FURNITURE % f"<main><article class='post category-reviews'>{BLOCK}</article></main>",
    FURNITURE % f"<div class='widget'><main>{BLOCK}</main></div>",
    FURNITURE % f"<article>{BLOCK}{COMMENTS}</article>{COMMENTS}",
    f"<body><form action=x>{FURNITURE % f'<div id=content>{BLOCK}</div>'}<input name=q></form></body>",
    FURNITURE % f"<div id=content>{BLOCK}</div>{COMMENTS}<form><p>Your name and your mail</p></form>",
])
def test_wrappers_with_the_names_of_furniture(html):
    assert html_text.main_text(html) == "\n".join(PARAGRAPHS)


REMARK = "<p>I think that this remark says quite a lot about the text above it, number %d.</p>"
PLACES = (
    "<article>%s%s</article>", "<main>%s%s</main>", "<div id=content>%s%s</div>", "<body><div><article>%s</article>%s</div>", "%s%s",
    "<main><article>%s</article>%s</main>", "<div class='content no-sidebar'>%s%s</div>",
)


@pytest.mark.parametrize("name", [
    "comments-area", "comments", "comment-thread", "comments-list", "sidebar-right", "sidebar", "newsletter-form", "related-posts",
])
def test_named_furniture_of_any_size_is_left_out(name):
    """From a tenth to nearly all of the page's letters."""
    text = BLOCK.split("<p>Paragraph 3")[0]
    for place in PLACES:
        for element in ("<div id='%s'>%s</div>", "<section class='%s'>%s</section>", "<div class='x %s'><div>%s</div></div>"):
            for number in (1, 8, 64, 400):
                html = place % (text, element % (name, "".join(REMARK % i for i in range(number))))
                assert html_text.main_text(html) == "\n".join(PARAGRAPHS[:3]), html[:300]


@pytest.mark.parametrize("place", PLACES)
def test_forms_of_any_size_are_left_out(place):
    for number in (1, 8, 64, 400):
        html = place % (BLOCK, "<form>" + "".join(REMARK % i for i in range(number)) + "</form>")
        assert html_text.main_text(html) == "\n".join(PARAGRAPHS)


def test_marks_inside_a_paragraph_do_not_end_it():
    html = ("<article><p>Let <math><mi>x</mi></math> be a number, press <button>OK</button> now <svg><title>i</title></svg>and"
            " <span class='ad'>buy</span> go<script>f()</script> on.</p></article>")
    assert html_text.main_text(html) == "Let x be a number, press now and go on."


@pytest.mark.parametrize("made", [
    lambda n: "<div>some text here</div>" * n, lambda n: "<div><b>" * n + "x", lambda n: "<b>" * n + "</i>" * n + "<p>x" * n,
    lambda n: "<div>" + "<b><i></b>" * n + "<p>y", lambda n: "<article>" + "<p>words and words<section>" * n,
])
def test_time_follows_the_length_of_the_page(made):
    def seconds(n):
        started = time.process_time()
        html_text.main_text(made(n))
        return time.process_time() - started

    seconds(100)
    assert seconds(32_000) < 8 * 2.5 * seconds(4_000) + 0.2


@pytest.mark.parametrize("opening,closing", [("<article>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>")])
@pytest.mark.parametrize("letters", [300, 10_000, 200_000])
def test_short_sections_beside_a_very_long_paragraph(opening, closing, letters):
    long = ("many words " * (letters // 11)).strip()
    short = [f"Section {i} with some text of its own, " + "which goes on for a while " * 4 + "and ends." for i in range(20)]
    body = f"<p>{long}</p>" + "".join(f"<{t}><p>{s}</p></{t}>" for s, t in zip(short, ["section", "div"] * 10))
    assert html_text.main_text(PAGE % f"{opening}{body}{closing}") == "\n".join([long, *short])


def test_sections_of_links_belong_to_the_article():
    html = PAGE % f"<article>{BLOCK}<section><ul>{'<li><a href=x>A source</a>' * 12}</ul></section></article>"
    assert html_text.main_text(html) == "\n".join([*PARAGRAPHS, *["A source"] * 12])


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE % f"<article>{BODY}</article>", "x"), (1, "u", None, "x"), (None, None, "", "y"), (2, "v", "<p>é", None)],
        "page_id long, url string, html string, text string",
    )
    found = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=repr)
    assert found == sorted([(1, "u", TEXT, len(TEXT)), (1, "u", "", 0), (None, None, "", 0), (2, "v", "é", 1)], key=repr)
    assert html_text.extract(pages.limit(0)).collect() == []


SYLLABLES = [f"{a}{b}{c}" for a in "bdgkl" for b in "aeiou" for c in ("nt", "rm", "sk", "l")]
VOCABULARY = [a + b for a in SYLLABLES for b in SYLLABLES]


def invented(n, seed):
    random = np.random.default_rng(seed)
    common = random.random(n) < 0.4
    return [("the", "of", "and")[random.integers(3)] if c else VOCABULARY[random.integers(len(VOCABULARY))] for c in common]


def words_of(texts):
    hashes, _, _, bounds, _, _ = decontamination.words(pa.array(texts, pa.string()))
    return [hashes[a:b] for a, b in zip(bounds, bounds[1:])]


def plain_alignment(item, text):
    """The textbook table, cell by cell."""
    best, above = 0.0, [0.0] * (len(text) + 1)
    for w in item:
        row = [0.0]
        for j, v in enumerate(text):
            step = above[j] + (1.0 if w == v else decontamination.MISMATCH)
            row.append(max(0.0, step, above[j + 1] + decontamination.GAP, row[j] + decontamination.GAP))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_the_plain_table():
    for seed in range(60):
        random = np.random.default_rng(seed)
        item, text = random.integers(0, 6, random.integers(0, 12)), random.integers(0, 6, random.integers(0, 25))
        assert decontamination.aligned(item, text)[0] == plain_alignment(item.tolist(), text.tolist())


def test_matches_equal_a_search_of_all_pairs(spark):
    items = [" ".join(invented(30, 100 + i)) for i in range(12)] + ["too short", "", None]
    random = np.random.default_rng(1)
    rows = []
    for i in range(150):
        body = invented(int(random.integers(5, 300)), i)
        if i % 3 == 0:  # a copy, every k-th word of it edited
            own = items[i % 12].split()
            for j in range(0, len(own), int(random.integers(4, 31))):
                own[j] = "edited"
            at = int(random.integers(0, len(body)))
            body[at:at] = own
        rows.append((i, ", ".join(body).upper() if i % 2 else "\n".join(body), None, None))
    rows += [(1000, None, None, None), (1001, "", None, None), (None, items[0], None, None), (1002, LONG + " " + items[1], None, None)]
    rows += [(1003, items[2], None, None)] * 2
    benchmark = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    docs = documents(spark, rows)
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.matches(spark, docs, benchmark).collect()}
    texts, tests, expected = words_of([r[1] for r in rows]), words_of(items), {}
    for (key, *_), text in zip(rows, texts):
        for number, item in enumerate(tests):
            if key is not None and len(item) >= decontamination.SEED:
                score = decontamination.aligned(item, text)[0]
                if score >= min(len(item) * decontamination.SHARE, decontamination.LONG):
                    expected[key, number] = score
    assert len(expected) > 40 and found == expected
    clean = decontamination.clean(spark, docs, benchmark)
    assert clean.columns == docs.columns
    bad = {key for key, _ in expected}
    assert by_id(r[:2] for r in clean.collect()) == by_id((r[0], r[1]) for r in rows if r[0] not in bad)
    assert decontamination.matches(spark, empty(spark), benchmark).collect() == []
    assert decontamination.matches(spark, docs, benchmark.limit(0)).collect() == []


def test_a_phrase_that_many_items_share_is_no_reason_to_align(spark, monkeypatch):
    """200 questions and 200 documents have one phrase; what matches is the same as in all pairs."""
    phrase = "zorp quell the vundim"
    items = [phrase + " " + " ".join(invented(int(n), 5000 + i)) for i, n in enumerate(np.random.default_rng(2).integers(6, 30, 200))]
    items[7] = phrase + " answer all of these in a line"
    random = np.random.default_rng(3)
    rows = []
    for i in range(200):
        body = invented(int(random.integers(20, 120)), 9000 + i)
        at = int(random.integers(0, len(body)))
        body[at:at] = phrase.split()
        if i % 5 == 0:  # a copy, every other word or so of the question's own edited
            own = items[i].split()
            for j in range(4, len(own), int(random.integers(2, 6))):
                own[j] = "edited"
            body[at:at] = own
        rows.append((i, " ".join(body), None, None))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    aligned = []
    real = decontamination.scored

    def counted(pairs):
        aligned.append(pairs.count())
        return real(pairs)

    monkeypatch.setattr(decontamination, "scored", counted)
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.matches(spark, documents(spark, rows), benchmark).collect()}
    texts, tests, expected = words_of([r[1] for r in rows]), words_of(items), {}
    own = [set(t.tolist()) for t in texts]
    for i, text in enumerate(texts):
        for j, item in enumerate(tests):
            # Fewer words in common than a match needs can't be one.
            need = min(max(len(item) * decontamination.SHARE, min(len(item), decontamination.EVIDENCE)), decontamination.LONG)
            if np.isin(item, text).sum() >= need and (score := decontamination.aligned(item, text)[0]) >= need:
                expected[i, j] = score
    assert found == expected and len(expected) >= 15
    assert aligned[0] < 10 * len(rows)


def test_a_passage_in_many_documents_stays_a_seed(spark):
    item = " ".join(invented(30, 7))
    rows = [(i, " ".join(invented(40, 1000 + i)) + " " + item if i % 3 == 0 else " ".join(invented(60, i)), None, None) for i in range(300)]
    benchmark = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = decontamination.matches(spark, documents(spark, rows), benchmark).collect()
    assert sorted(r.doc_id for r in found) == [i for i in range(300) if i % 3 == 0]


def test_short_items_need_all_their_words(spark):
    items = ["What is the capital of France?", "one two three four five six seven", "never seen here"]
    texts = [
        "Nobody knows what is the best way", "the capital of Spain", "Q: what is the capital of france, please",
        "one two three four five and a six seven", "he counts one two three four five six seven eight", "what is the",
    ]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.score) for r in decontamination.matches(spark, docs, benchmark).collect()}
    assert found == {(2, 0, 6.0), (4, 1, 7.0)}
    assert sorted(r.doc_id for r in decontamination.clean(spark, docs, benchmark).collect()) == [0, 1, 3, 5]


def test_items_of_frequent_words_are_found_when_edited(spark):
    random = np.random.default_rng(4)
    # Words of 2 to 3 in a hundred, ten of them a little rarer; the rarer ones stand together in the item and are edited.
    weights = np.array([1.0] * 30 + [0.8] * 10)
    weights /= weights.sum()
    item = [f"f{i}" for i in (*random.permutation(30)[:12], *random.permutation(10)[:9] + 30, *random.permutation(30)[:12])]
    copy = [f"x{w}" if int(w[1:]) >= 30 and i % 2 == 0 else w for i, w in enumerate(item)]
    rows = [(i, " ".join(f"f{x}" for x in random.choice(40, 200, p=weights)), None, None) for i in range(200)]
    rows.append((900, " ".join(copy), None, None))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    own, other = words_of([" ".join(item), " ".join(copy)])
    assert decontamination.aligned(own, other)[0] >= len(item) * decontamination.SHARE
    assert [r.doc_id for r in decontamination.matches(spark, documents(spark, rows), benchmark).collect()] == [900]


def test_seeds_reach_every_place():
    random = np.random.default_rng(8)
    for n in (3, 10, 40, 200):
        chances = np.log(random.choice([0.3, 0.05, 0.01, 1e-4], n))
        covered = np.zeros(n, bool)
        for begin, size in decontamination.chosen(chances):
            assert begin >= 0 and size >= decontamination.SEED and begin + size <= n
            covered[begin : begin + size] = True
        assert covered.all() or chances.sum() > np.log(decontamination.RARE)
