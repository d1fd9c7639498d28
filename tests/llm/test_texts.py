import random

import numpy as np
import pyarrow as pa

from cdclake.llm import common, html_text, quality, toxicity, words
from tests.llm.cases import ODD, documents, frame, rows_of


def test_words_are_those_of_the_definition():
    texts = ODD + [t or "" for _, t in documents(n=5)]
    data, offsets = common.utf8(pa.array(texts))
    w = words.split(data, offsets)
    raw = data.tobytes()
    found = [raw[a:b] for a, b in zip(w.starts, w.ends)]
    assert [found[a:b] for a, b in zip(w.first, w.first[1:])] == [t.encode().split() for t in texts]
    assert len({h: x for h, x in zip(w.hashes.tolist(), found)}) == len(set(found))
    hashes, at = words.grams(w, 3)
    assert len(hashes) == sum(max(0, len(t.split(b" ")) and len(t.split()) - 2) for t in (x.encode() for x in texts))
    assert len(set(hashes.tolist())) == len({tuple(found[i:i + 3]) for i in at})


def _quality(text):
    ws, lines = text.encode().split(), [x for x in text.split("\n") if x.encode().split()]
    seen, again = set(), 0
    for x in lines:
        again += x in seen
        seen.add(x)
    windows = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    twice = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else {x for x in windows if x in set(windows[:0])}
    covered = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 5)}
    return len(ws), sum(len(x.decode()) for x in ws), sum(c in quality.SYMBOLS for c in text), again, len(covered)


def test_quality_counts(spark):
    rows = [r for r in documents(4) if len(r[1] or "") < 9000] + list(enumerate(ODD, 20000)) + [(30000, "a\na\n\n a\n#*$%&|<>\n" + "one two three four five six " * 3)]
    got = rows_of(quality.judge(frame(spark, rows)).drop("kept"))
    want = []
    for d, t in rows:
        n, *rest, rep = _quality(t or "")
        want.append((d, n, *rest, rep, n < 10 or 100 * rep > 20 * n))
    assert got == sorted(want, key=repr)


def test_every_quality_measure_rejects(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    lines = lambda k: [" ".join(word(5) for _ in range(20)) for _ in range(k)]
    rows = [(i, "\n".join(lines(10))) for i in range(700)]
    shared = [(10_000 + i, "\n".join([*x, x[0]])) for i in range(8) for x in [lines(40)]]
    odd = {1000: "\n".join(x + " " + "#" * 40 for x in lines(10)), 1001: "\n".join(lines(8) + ["a b"] * 6),
           1002: " ".join(lines(10) + [x := " ".join(word(5) for _ in range(12)), x]), 1003: " ".join(word(12) for _ in range(200))}
    df = spark.createDataFrame([*rows, *shared, *odd.items()], "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source")
    got = {x.doc_id: x for x in quality.judge(df).collect()}
    assert not any(got[i].base_failed or got[i].kept for i in odd)
    assert all(got[i].kept for i, _ in rows)
    assert sum(x.kept for x in got.values()) >= len(rows)


def test_quality_limits_have_no_step(spark):
    """A group's limit moves from its language's to its own, little by little, as it grows."""
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(n)) for _ in range(60))
    common_ = [("big", text(5)) for _ in range(3000)]
    own = [text(9) for _ in range(130)]
    seen = []
    for n in (1, 50, 99, 100, 101, 130):
        df = spark.createDataFrame([(i, t, "en", s) for i, (s, t) in enumerate(common_ + [("small", t) for t in own[:n]])], "doc_id long, text string, lang string, source string")
        rows = quality.measured(df).drop("row")
        seen.append({x.source: x.max_length for x in quality.limits(rows).collect()}["small"])
    assert seen[0] < seen[1] < seen[-1] and max(abs(a - b) for a, b in zip(seen[2:5], seen[3:5])) < 10


def test_quality_limits_follow_the_group(spark):
    """What is rare in a source is rejected there, and kept where it is usual; few texts borrow their language's limits."""
    r = random.Random(5)
    text = lambda junk: " ".join(f"word{r.randrange(10**6)}{'***' * junk}" for _ in range(40))
    rows = [(i, text(i % 10 == 0), "en", "mixed") for i in range(300)] + [(1000 + i, text(i % 10 > 0), "xx", "odd") for i in range(300)] + [(2000, text(1), "en", "few"), (2001, text(0), "en", "few")]
    rows += [(3000, None, None, None), (3001, text(0), None, "mixed"), (3001, text(0), None, "mixed")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert all(kept[i] == (i % 10 > 0) for i in range(300))
    assert all(kept[1000 + i] for i in range(300))
    assert not kept[2000] and kept[2001] and not kept[3000] and kept[3001]
    assert rows_of(quality.passing(df)) == sorted((x for x in rows if kept[x[0]]), key=repr)
    assert quality.judge(df.limit(0)).count() == 0 and quality.passing(df.limit(0)).columns == df.columns


def _toxic_rows(n=1500, seed=6):
    r = random.Random(seed)
    clean = [f"w{i}" for i in range(800)]
    rows, labels = [], []
    for d in range(n):
        w = [r.choice(clean) for _ in range(r.randint(5, 60))]
        bad = r.random() < 0.25
        for _ in range(bad * r.randint(1, 3)):
            w[r.randrange(len(w))] = r.choice(["Nasty,", "vileness", "SCUMBAG!"])
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = _toxic_rows()
    extra = [(5000, None), (5001, ""), (None, "nasty scumbag"), (5002, "w1 w2 " * 5000), (0, rows[0][1])]
    docs = frame(spark, rows + extra)
    table = spark.createDataFrame(labels + [(None, 1), (7, None), (0, labels[0][1])], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, docs, table).collect()}
    import zlib

    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    held = [(d, y) for d, y in labels if got[d].held_out]
    assert sum(got[d].predicted == y for d, y in held) >= 0.97 * len(held)
    assert got[5000].score == got[5001].score and got[5000].predicted == 0 and got[None].predicted == 1
    assert toxicity.scored(docs, docs, table).where("doc_id = 0").distinct().count() == 1
    model = toxicity.learnt(docs, table)
    assert 0 < len(model[0]) < 2000
    kept = rows_of(toxicity.clean(docs, model))
    assert kept == sorted((tuple(r) for r in docs.collect() if not got[r.doc_id].predicted), key=repr)


def test_toxicity_learns_only_from_the_fit_rows(spark):
    rows, labels = _toxic_rows(400)
    docs = frame(spark, rows)
    import zlib

    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, y in labels]
    a, b = (toxicity.learnt(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    none = toxicity.scored(docs, docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}


def test_html_layout():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>Hi <b>there</b>,
 you<p>one<p>two  three<br>four<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol start=3><li>x<li>y<p>z</ol>
<table><tr><th>Name<th>Value<tr><td>alpha<td>1<tr><td colspan=2>wide<tr><td>b<td>22222</table><div hidden>no</div><i style="display: none">no</i><pre>
 a
   b</pre><blockquote>said</blockquote>&lt;end&gt; &amp; <script>var x="<p>no";</script>it<p class=it's title="a>b">q</p><dl><dt>t<dd>d</dl>3 < 4<!-- no --> x"""
    assert html_text.text_of(page) == (
        "Hi there, you\n\none\n\ntwo three\nfour\n\n- a\n- b\n  - c\n- d\n\n3. x\n4. y\n\n   z\n\nName   Value\nalpha  1\nwide\nb      22222\n\n a\n   b\n\n  said\n\n<end> & it\n\nq\n\nt\n  d\n\n3 < 4 x")


def test_html_odd_pages(spark):
    cases = {"": "", "plain": "plain", "<p>a</p></p></div>b": "a\n\nb", "<div>" * 5000 + "x": "x", "a<br><br>b": "a\n\nb", "x <a href='": "x", "<b": "", "a </ >b": "a b",
             "<table><tr><td rowspan=2>r<td>1<tr><td>22</table>": "r  1\n   22", "<textarea><b></textarea>": "<b>", "<select><option>a<option>b</select>": "ab",
             "<p>1<table><tr><td><p>2<p>3</table>": "1\n\n2\n\n3", "<td>loose</td> x": "loose x" if False else "loose\nx", "<SCRIPT>x</Script>y": "y", "&nbsp;&#8364;": "\xa0€"}
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)] + [(99, None), (None, "<p>n"), (None, "<p>n")], "page_id long, html string").selectExpr("*", "1 AS text")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert got[99] == "" and got[None] == "n" and html_text.extract(df).count() == len(cases) + 3
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_drawings_formulas_and_visibility(spark):
    cases = {
        '<body><p>a</p><svg class="i"/><p>b</p><math/>c': "a\n\nb\n\nc",
        "a <svg viewBox='0 0 1 1'><path d='M0'/><g><circle r=1 /></g></svg> b": "a b",
        "a<svg><title>no</title><style/><script/><defs><text>no</text></defs>no<text>x<tspan>y</tspan></text><text>z</text></svg>b": "a xy z b",
        "<svg><g/><foreignObject><p>in<b/>side</p></foreignObject>no</svg>out": "inside\n\nout",
        "<svg><text><![CDATA[1 < 2]]></text></svg>": "1 < 2",
        "<svg><path><p>unclosed": "unclosed",
        "so <math><semantics><mrow><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math> holds": "so x=2 holds",
        "<p/>a<div/>b": "a\n\nb",
        "a <span style='visibility:hidden'>no <b style='visibility: visible'>yes <i style='visibility:hidden'>no</i></b> no</span> b": "a yes b",
        "<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>": "- yes",
        "<div style='display:none'><b style='visibility:visible'>no</b></div>a": "a",
        "<i style='backface-visibility:hidden'>a</i>": "a",
        "<svg>" + "<g>" * 5000 + "<text>deep": "deep",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
