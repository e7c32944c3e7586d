"""Quality model, decontamination, chat templates and page text."""

import random

import numpy as np
import pytest
from conftest import table
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfsense.llm import chat, decontam, pagetext, quality


def test_model_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    grades = quality.grades_of_labels(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    train, test = grades.filter("doc_id % 4 <> 0"), grades.filter("doc_id % 4 = 0")
    model = quality.train(docs, train, 3, max_labels=2000)
    rows = quality.score(docs.join(test, "doc_id"), model).select("grade", "expected_grade", "tail_2").toPandas()
    kept = rows["tail_2"] >= 0.5
    assert kept[rows["grade"] == 2].mean() > 0.97
    assert kept[rows["grade"] == 0].mean() < 0.15
    means = rows.groupby("grade")["expected_grade"].mean()
    assert means[0] < means[1] < means[2]


def test_thresholds_ascend_and_tails_fall():
    rng = np.random.default_rng(0)
    rows = [(np.array([g, 7], np.int32), np.array([0.5, 0.1], np.float32)) for g in rng.integers(0, 4, 200)]
    model = quality.fit(rows, np.array([int(ids[0]) for ids, _ in rows]), 4)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.linspace(-9, 9, 20))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(tails, axis=0) >= 0).all()


def test_scores_of_hostile_documents(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (6, 1, 0), (10, 1, 1), (None, 1, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    kept = quality.select(docs, labels, least_tail=0.0)
    assert kept.count() == docs.count() and set(docs.columns) <= set(kept.columns)
    assert quality.select(no_docs, labels).count() == 0
    assert quality.select(docs, labels.limit(0), 0.0).count() == docs.count()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_passages_with_edits(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnop "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(rng.choice([24, 60, 150]))) for i in range(12)]
    rows, expected = [], {}
    for i in range(60):
        item_id, item = rng.choice(items)
        edits = rng.randrange(decontam.budget(len(item), decontam.EDIT_SHARE) + 1)
        passage = list(item.upper() if i % 2 else item)
        for _ in range(edits):
            at = rng.randrange(len(passage))
            passage[at : at + rng.choice([0, 1])] = rng.choice(["", "z", "y"])
        rows.append((i, text(rng.randrange(200)) + "".join(passage) + text(rng.randrange(200))))
        expected[i, item_id] = edit_distance("".join(passage).lower(), item)
    rows += [(100 + i, text(300)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontam.find_passages(docs, benchmark, block_bytes=400).collect()}
    assert set(found) == set(expected)
    assert all(found[key] <= expected[key] for key in found)
    left = {r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in expected}


def test_exact_passages_of_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    found = decontam.find_passages(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    documents, benchmark = table("sf0.01", "documents"), table("sf0.01", "benchmark")
    exact = {(d, i) for d, text in zip(documents.doc_id, documents.text) for i, item in zip(benchmark.item_id, benchmark.text) if item in (text or "")}
    assert exact and {(r.doc_id, r.item_id) for r in found.collect() if r.edits == 0} == exact


def test_passages_in_hostile_documents(spark, docs, no_docs):
    benchmark = spark.createDataFrame([(1, None), (2, "short"), (3, "fox jumps over the lazy dog near the"), (3, "fox jumps over the lazy dog near the")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_passages(docs, benchmark).collect()} == {(1, 3), (2, 3)}
    assert decontam.find_passages(docs, benchmark.limit(0)).count() == 0
    assert decontam.find_passages(no_docs, benchmark).count() == 0
    assert decontam.drop_contaminated(docs, benchmark).columns == docs.columns


PARTS = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "a", " ", "\n", "é", "<\\s>"])
TEXTS = st.lists(PARTS, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[INST]"]), TEXTS), max_size=5))
def test_conversations_come_back(turns):
    text, spans = chat.compile_template(chat.TEMPLATE)({"messages": [{"role": r, "text": t} for r, t in turns]})
    assert chat.read_turns(text) == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_template_language():
    render = lambda source, **values: chat.compile_template(source)(values)[0]
    assert render("{{ 'a' + \"b\" ~ 1 }}|{{ x.y['z'] }}|{{ none }}", x={"y": {"z": 3}}) == "ab1|3|"
    assert render("{% for m in ms %}{{ loop.index0 }}{{ m }}{% if not loop.last %},{% endif %}{% endfor %}", ms=["a", "b"]) == "0a,1b"
    assert render("{% if a == 1 %}x{% elif a != 2 and b %}y{% else %}z{% endif %}", a=3, b=True) == "y"
    assert render("{% set t = ' q ' %}  {{- t | trim | upper -}}  .") == "Q."
    assert render("{{ 'a' in xs }}{{ 'b' in 'abc' }}{{ 'b' in none }}", xs=["a"]) == "TrueTrueFalse"
    assert render("{{ x.__class__ }}{{ y.upper }}", x=3, y="s") == ""


def test_constants_fold():
    tree = chat.fold_block(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}no{% elif true %}d{% else %}no{% endif %}{{ 'E' | lower }}"))
    assert tree == [("text", "abcde")]


@pytest.mark.parametrize("source", ["{% for x %}{% endfor %}", "{% if a %}", "{{ a | open }}", "{{ (a }}", "{% while a %}", "{{ a %}", "{{ a b }}", "{% endif %}"])
def test_templates_outside_the_language(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_hostile_conversations(spark):
    rows = [(1, 1, "assistant", "</s>"), (1, 0, "user", None), (1, None, None, "first"), (1, 0, "user", None), (None, 0, "user", "x"), (2, 0, "assistant", "")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(turns)
    got = {r.conv_id: chat.read_turns(r.formatted) for r in formatted.collect()}
    assert got == {1: [("", "first"), ("user", ""), ("user", ""), ("assistant", "</s>")], None: [("user", "x")], 2: [("assistant", "")]}
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(formatted).collect()} == {1: (4, 4), None: (1, 0), 2: (1, 0)}
    assert chat.format_conversations(turns.limit(0)).count() == 0


PAGES = [
    ("<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>T</h1><p>One <b>two</b>&amp;\n three<p>four</article><footer>f</footer>", "T One two& three four"),
    ("<body><div class='ad'>buy<div>now</div></div><main><p>x&nbsp;y<script>var a='</p>'</script></p><form>f</form><!-- c --><p title='a>b'>z</p></main>", "x y z"),
    ("<div id=sidebar>menu one two</div><article>" + "<p>" + "words " * 40 + "</article><section class=comments><p>" + "reader " * 50, ("words " * 40).strip()),
    ("<nav><div>never closed<article><p>text</p></article>", "text"),
    ("<div><p>" + "body text " * 30 + "</p><p>short</p><p>" + "more text " * 30 + "</p></div>", ("body text " * 30 + "short " + "more text " * 30).strip()),
    ("<article><p>a</div>b</p><aside>no</aside><p>it&apos;s &#9999999; &eacute</article>", "a b it's � é"),
    ("<![if IE]><article>k</article>", "k"),
    ("", ""), ("<html></html>", ""), ("plain text", "plain text"), ("<p>" + "x" * 200_000, "x" * 200_000), ("<" * 50, "<" * 50),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_main_text(html, text):
    assert pagetext.main_text(html) == text


def test_pages_without_article_keep_all_clusters():
    parts = [[f"{kind}{i} " + "x" * size for i in range(n)] for kind, n, size in (("a", 6, 296), ("b", 10, 4), ("c", 5, 276))]
    lines = [line for part in parts for line in part]
    body = "".join(f"<p>{line}</p>" for line in lines)
    assert pagetext.main_text(f"<div>{body}</div>") == " ".join(lines)
    menu = "".join(f"<div><span><a href=/>m{i}</a></span></div>" for i in range(12))
    assert pagetext.main_text(f"<div>{menu}</div><div>{body}</div><div>{menu}</div>").count("m") < 8


def test_article_is_a_weight():
    teaser, body = "<article><p>teaser</p></article>", "".join(f"<p>{'body text ' * 30}</p>" for _ in range(6))
    link = "<div><span><a href=/>link</a></span></div>" * 5
    text = pagetext.main_text(f"<div>{body}</div>{teaser}{link}")
    assert text.count("body text") == 180 and "teaser" in text and "link" not in text


def test_contaminated_rows_go_alone(spark):
    item = "the benchmark passage that no training document may hold"
    rows = [(None, f"before {item} after"), (None, "a clean text"), (None, None), (4, f"{item}!"), (4, "clean too"), (5, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontam.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([rows[1], rows[2], rows[4], rows[5]], key=repr)


def test_hostile_pages(spark):
    rows = [(1, None, None, "x"), (1, "u", "<article>a</article>", "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(tuple, pagetext.extract(pages).collect()), key=repr) == sorted([(1, None, "", 0), (1, "u", "a", 1), (None, "u", "", 0)], key=repr)
    assert pagetext.extract(pages.limit(0)).count() == 0
