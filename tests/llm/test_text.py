"""HTML, chat formatting, quality rules, classifier and language identification."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from oracle_check import compare, duck  # noqa: E402
from stratamart.llm import chat_formatting as chat, html_text, language_id as lang, quality_classifier as qc, quality_rules as qr  # noqa: E402
from stratamart.llm.common import fold  # noqa: E402
from stratamart.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    rows, problems = compare(QUERIES[name](spark, brute.SF), duck(brute.SF), ORACLE[name])
    assert rows and not problems


PAGES = [
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>x<li value=3>y<li>z</ol>", "9. x\n3. y\n4. z"),
    ("<table><tr><th>Name<th>n<tr><td>Long name<td>1</table>", "Name       n\nLong name  1"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td colspan=2>wide one<td>x<tr><td>a<td>b<td>c</table>", "wide one  x\na  b      c"),
    ("x<script>var a='</p>';</script><style>p{}</style>y", "xy"),
    ("<style>.no{display:none}</style><div class='a no'>gone</div><p hidden>gone<p>seen", "seen"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("<pre>\n a  b\n   c</pre>d", " a  b\n   c\n\nd"),
    ("a &amp; b&nbsp;c &lt;d&gt;", "a & b c <d>"),
    ("<p>a  \n b<br>c</p><!-- no -->d", "a b\nc\n\nd"),
    ("<details><summary>S</summary>hidden</details>", "S"),
    ("<head><title>T</title></head><body>b", "b"),
    ("<dl><dt>T<dd>D<dt>U<dd>E</dl>", "T\n  D\nU\n  E"),
    ("<div>" * 5000 + "deep", "deep"),
    *[("<div>" * n + "<p style='display:none'>no</p><table><tr><td>a<td>b</table>", "a  b") for n in (148, 149, 150, 151, 20_000)],
    *[(f"<table><tr><td>{'x' * n} y<td>B<tr><td>c<td>D</table>", f"{'x' * n} y  B\nc{' ' * (n + 3)}D") for n in (57, 58)],
    (f"<table><tr><td>{'x' * 58} yy<td>B<tr><td>c<td>D</table>", f"{'x' * 58}  B\nyy\nc{' ' * 59}D"),
    (f"<table><tr><td>{'x' * 61}<td>B<tr><td>c<td>D</table>", f"{'x' * 61}  B\nc  D"),
    ("<style>@media print{.a{display:none}} @media screen{.b{display:none}}</style><p class=a>a<p class=b>b", "a"),
    ("<style>@media (max-width:600px){.a{display:none}} @media (min-width: 600px){.b{display:none}} @font-face{x:y}.c{display:none}</style>"
     "<p class=a>a<p class=b>b<p class=c>c", "a"),
    ("<style>.a{display:none}.a{display:block}</style><p class=a>a", "a"),
    ("<style>.a{display:none}</style><p class=a style='display:block'>a<p class=a>b", "a"),
    ("<style>.a{display:none!important}</style><p class=a style='display:block'>a<p>b", "b"),
    ("<style>#i{display:block}p.a{display:none}</style><p class=a id=i>a<p class=a>b<div class=a>c</div>", "a\n\nc"),
    ("<style>div .a{display:none}ul>.b{visibility:hidden}p:hover{display:none}</style><p class=a>a<div><b class=a>no</b>c</div><ul><li class=b>no<li>d</ul>", "a\n\nc\n\n- d"),
    ("<style>tr .n, table.x > p{display:none}</style><table><tr><td>a<td class=n>no</table>", "a"),
    ("<p hidden style='display:block'>shown", "shown"),
    ("a<svg><defs><text>no</text></defs><path d=''/><text x=1>label</text><text>two</text></svg>b", "a label two b"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>", "x=2"),
    ("</p></div>text</b>", "text"),
    ("", ""), (None, ""), ("<p>", ""), ("<table></table>", ""),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_page_text(html, text):
    assert html_text.page_text(html) == text


def test_extract_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


@given(st.text(alphabet="<[|/sINST]>\\%7C\n", max_size=30))
@settings(max_examples=600, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))
    assert chat._unescape_role(chat._escape_role(text)) == text


def conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|end|>\n"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", "hi"),
            (4, 0, None, None), (4, None, "as|x%7C", "</s>"), (5, 1, "assistant", "b"), (5, 0, "assistant", "a"), (5, 0, "assistant", "a"),
            (None, 0, "user", "hi"), (6, 0, "user", "hi"), (6, 1, "assistant", "no")]
    return rows, spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, turns int, nodes string")


@pytest.mark.parametrize("chars,members", [(10_000, 1000), (1, 1000), (60, 2)])
def test_conversations_read_back(spark, chars, members):
    rows, df = conversations(spark)
    packs = chat.format_conversations(df, chars, members).collect()
    found = {}
    for p in packs:
        nodes = [n.asDict(recursive=True) for n in p.nodes]
        for n in nodes:  # positions go on from the parent, and only ancestors are attended to
            above = nodes[n["parent"]] if n["parent"] >= 0 else None
            assert n["position"] == (above["position"] + above["end"] - above["start"] if above else 0)
            assert sum(s["end"] - s["start"] for s in n["ancestors"]) == n["position"]
        for m in p.members:
            assert m.conv_id not in found
            _, turns, loss = chat.read_back(p.text, nodes, m.leaf)
            found[m.conv_id] = turns
            assert loss == "".join(t for role, t in turns if role == "assistant")
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        assert found[conv] == [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
    if chars == 10_000:
        assert sum(len(p.nodes) for p in packs) == len({1, 2, 3, 4, 5, 6, 7, 8}) + 0 or len(packs) > 1
        assert "".join(p.text for p in packs).count("hi<|end|>") <= len(packs)


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, t % 3, "user", f"text {t % 5}") for t in range(60)] + [(1, 0, "user", "hi"), (1, 1, "assistant", "yes")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, turns int, nodes string")
    found = chat.digests(chat.format_conversations(df)).collect()
    assert sorted(r.n_turns for r in found if r.conv_id is None) == [1] * 60 and len(found) == 61


def test_no_conversations(spark):
    _, df = conversations(spark)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize("n", [99, 100, 255, 256, 257, 999, 1000, 1001, 20_000])
def test_word_salad_is_accused_at_every_length(spark, n):
    """Few different words are accused, many are not, whatever the number of words."""
    few, many = [f"w{k % 5}" for k in range(n)], [f"w{k * 7919 % max(1, n // 2)}" for k in range(n)]
    bad = qr.RULES["variety"][0]
    df = spark.createDataFrame([(len(set(t)), len(t)) for t in (few, many)], "n_distinct int, n_words long")
    assert [r[0] for r in df.selectExpr(bad).collect()] == [True, False]


def test_quality_rules_edge_cases(spark):
    line = "one two three four five six seven eight nine ten"
    texts = [None, "", " \t\n", line, f"{line}\n{line}\n\n\n x \n x ", "#$%&*|<> a", "a b " * 40, "x" * 200_000 + " " + line]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, n_words int, quality string")
    got = {r.doc_id: r for r in qr.quality_rules(df).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        w = brute.words(t)
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        hit = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(8)}
        lines = [x for x in (t or "").split("\n") if brute.words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert qr.quality_rules(df.limit(0)).count() == 0


def test_quality_rules_run_no_python(spark):
    plan = qr.quality_rules(spark.read.parquet(f"{brute.SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_keep_labelled_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{brute.SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = qr.quality_rules(docs).drop("quality").join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{brute.SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = qc.score_quality(docs, labels, learn=fold("doc_id", 3) != 1)
    rows = scored.join(labels, "doc_id").where(fold("doc_id", 3) == 1).collect()
    assert scored.count() == docs.count()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_class_prior_and_risk_on_made_points():
    rng = np.random.default_rng(0)
    make = lambda n, at: np.hstack([rng.normal(at, 1, (n, 2)), rng.normal(0, 1, (n, 1))])
    p, u = make(3000, 2), np.vstack([make(2100, 2), make(900, -2)])
    first = qc.fit(p, u, None)
    bins = lambda x: np.histogram(qc._sigmoid(first.inputs(x) @ first.weights), 100, (0, 1))[0].astype(float)
    assert abs(qc.class_prior(bins(p), bins(u)) - 0.7) < 0.06
    m = qc.fit(p, u, 0.7)
    assert (m.inputs(make(500, 2)) @ m.weights > 0).mean() > 0.95 and (m.inputs(make(500, -2)) @ m.weights < 0).mean() > 0.95


def test_classifier_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "a b", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (None, 1)], "doc_id long, quality int")
    scored = qc.score_quality(docs, labels, learn=fold("doc_id", 3) != 9).collect()
    assert len(scored) == 4 and all(0 <= r.score <= 1 for r in scored)
    unlearnt = qc.score_quality(docs, labels.limit(0), learn=fold("doc_id", 3) != 9).collect()
    assert {(r.score, r.predicted) for r in unlearnt} == {(0.5, 1)}
    assert qc.score_quality(docs.limit(0), labels, learn=fold("doc_id", 3) != 9).count() == 0
    assert len(qc.features("word " * 50_000)) == len(qc.FEATURES)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    m = lang._start(["a", "b", "c"], 4, rng)
    for name in ("inputs", "recurrent", "out", "bias"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    data, labels = rng.integers(0, 257, (5, 9)), rng.integers(0, 3, 5)
    _, grads = lang._gradients(m, data, labels)
    for array, grad in zip((m.recurrent, m.out), grads[1:3]):
        for _ in range(20):
            at, step = tuple(rng.integers(n) for n in array.shape), 1e-2
            array[at] += step
            above = lang._gradients(m, data, labels)[0]
            array[at] -= 2 * step
            below = lang._gradients(m, data, labels)[0]
            array[at] += step
            assert abs((above - below) / (2 * step) - grad[at]) < 1e-5


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    found = lang.identify(docs, docs.where(fold("doc_id", 4) != 2), ("doc_id", "lang")).where(fold("doc_id", 4) == 2).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_every_byte_is_labelled_once():
    m = lang._start(["a", "b"], 4, np.random.default_rng(0))
    texts = [b"x" * n for n in (0, 1, 255, 256, 257, 1000)]
    seen = [0] * len(texts)
    for owners, scores, counts in lang.label_positions(m, texts):
        assert np.allclose(scores.sum(axis=1), 1, atol=1e-4)
        for k, c in zip(owners, counts.sum(axis=1)):
            seen[k] += c
    assert seen == [len(t) for t in texts]


def test_language_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, None, "en", 0), (2, "", "en", 0), (3, "12 34 ...", "fr", 0), (4, "the and of", "en", 0), (4, "the and of", None, 0), (5, "le la les", "fr", 0)],
        "doc_id long, text string, lang string, score int",
    )
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in lang.identify(df, df).collect())
    assert [g[1] for g in got[:3]] == ["und"] * 3 and all(0 <= g[2] <= 1 for g in got)
    assert {g[1] for g in got[3:]} <= {"en", "fr"} and len(got) == 6
    assert {r.lang_pred for r in lang.identify(df, df.limit(0)).collect()} == {"und"}
    assert lang.identify(df.limit(0), df).count() == 0
