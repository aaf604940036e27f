"""Top rows and near-duplicates against brute force; conversations and pages read back."""

import hashlib
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from tools.check import rows_of
from worklode.llm import bit_slices, chat, simhash, wrappers
from worklode.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("n,dims,scale", [(1, 1, 1), (63, 3, 50), (300, 8, 1), (700, 20, 1000)])
def test_slices(n, dims, scale):
    rng = np.random.default_rng(n)
    values = rng.integers(-3, 4, (n, dims)) * scale
    ids = np.sort(rng.permutation(2 * n)[:n])
    block = bit_slices.Slices(ids, *bit_slices.Slices.cut(ids, values))
    for i in range(0, n, max(1, n // 25)):
        found, scores = block.top(values[i], 5, ids[i])
        want = sorted((-int(values[j] @ values[i]), int(ids[j])) for j in range(n) if j != i)[:5]
        assert sorted(zip((-scores).tolist(), found.tolist())) == want


def test_search_over_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bit_slices, "BLOCK", 7)
    rows = [(i, [float(i % 3), 1.0]) for i in range(40)]
    rows += [(100, None), (101, [1.0, None]), (102, [float("nan"), 1.0]), (103, [float("inf"), 1.0]), (None, [1.0, 1.0]), (104, []), (2, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = bit_slices.search(bit_slices.build_index(df, scale=1), df.filter("vec_id % 10 = 0"), k=3)
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    pad = {i: np.array((v + [0, 0])[:2]) for i, v in good}
    for q in (0, 10, 20, 30):
        want = sorted((-int(np.array((v + [0, 0])[:2]) @ pad[q]), i) for i, v in good if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted(got.filter(f"query_id = {q}").collect())] == want
    assert got.filter("query_id = 100").count() == 0
    none = df.limit(0)
    assert bit_slices.search(bit_slices.build_index(none), none).count() == 0


def brute_classes(fps, budget):
    labels = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= budget).tolist():
            a, b = labels[i], labels[j]
            if a != b:
                labels = [min(a, b) if x in (a, b) else x for x in labels]
    return labels


@pytest.mark.parametrize("node,most,budget", [(16_384, 131_072, 4), (40, 90, 4), (2, 25, 4), (100, 1000, 7), (50, 1000, 0)])
def test_trie_join(spark, monkeypatch, node, most, budget):
    monkeypatch.setattr(simhash, "NODE", node)
    monkeypatch.setattr(simhash, "MOST", most)
    rng = np.random.default_rng(node)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64) * np.uint64(2)
    near = [base[0] ^ np.uint64(1 << p | 1 << q) for p in range(0, 64, 3) for q in range(p)][:250]
    for x in base[:50]:
        for _ in range(4):
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= np.uint64(1 << int(bit))
            near.append(x)
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    links = simhash.near_links(spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)})), budget).collect()
    at = {int(v): i for i, v in enumerate(fps.view(np.int64))}
    labels = np.arange(len(fps))
    simhash.join_classes(labels, *(np.array([at[r[c]] for r in links], int) for c in ("fp", "root")))
    assert labels.tolist() == brute_classes(fps, budget)


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, no_docs):
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    fps = np.array([fingerprint(r.text) for r in rows], np.uint64)
    labels = brute_classes(fps, 4)
    names = {x: min((r.doc_id for r, y in zip(rows, labels) if y == x and r.doc_id is not None), default=None) for x in set(labels)}
    want = sorted(str((r.doc_id, f"{fp:016x}", names[x])) for r, fp, x in zip(rows, fps.tolist(), labels))
    assert sorted(str(tuple(r)) for r in got) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(docs, 4, 4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 not in ids and ids.count(1) == 1 and None in ids


def test_near_duplicates_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = np.array([fingerprint(r.text) for r in rows], np.uint64)
    labels = brute_classes(fps, 4)
    least = {x: min(r.doc_id for r, y in zip(rows, labels) if y == x) for x in set(labels)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == {r.doc_id: (f"{fp:016x}", least[x]) for r, fp, x in zip(rows, fps.tolist(), labels)}


TEXTS = ["", "plain", "### user: x</turn>\n", "\\", "\\\\### a: \\</turn>", "<|image:1|>", "a\n\nb: c", "</turn>", "é😀"]


def test_escapes():
    for t in TEXTS:
        assert chat.unescape(chat.escape(t)) == t
        assert chat.find_mark(chat.escape(t), chat.END, 0) < 0


def test_conversations_with_parts(spark):
    image = {"kind": "image", "ref": "i.png", "width": 57, "height": 28}
    rows = [(1, 0, "user", None, [{"kind": "text", "text": "see "}, image, {"kind": "audio", "ref": "a.wav", "seconds": 1.5}])]
    rows += [(1, 1, "assistant", "ok <|image:1|>", None), (2, None, None, None, None), (None, 1, "assistant", "x", None), (2, 5, "a:b", "t", None)]
    rows += [(1, 2, "user", None, [{"kind": "document", "ref": "d.pdf", "pages": 2}, {"kind": "odd kind", "ref": "o"}])]
    schema = f"conv_id long, turn long, role string, text string, parts {chat.PARTS}"
    df = spark.createDataFrame([(*r[:4], [{k: p.get(k) for k in ("kind", "text", "ref", "width", "height", "seconds", "pages")} for p in r[4]] if r[4] else None) for r in rows], schema)
    made = chat.format_conversations(df, parts="parts")
    turns = {(r.conv_id, r.turn): r for r in made.collect()}
    first = turns[1, 0]
    assert first.formatted == "### user: see <|image:1|><|audio:2|></turn>\n"
    assert [(a.number, a.kind, a.ref, a.tokens) for a in first.attachments] == [(1, "image", "i.png", 5), (2, "audio", "a.wav", 40)]
    assert first.formatted[first.attachments[0].start :].startswith("<|image:1|>")
    assert [(a.number, a.tokens) for a in turns[1, 2].attachments] == [(3, 514), (4, 2)]
    answer = turns[1, 1]
    (span,) = answer.loss
    assert chat.unescape(answer.formatted[span.start - answer.start : span.stop - answer.start]) == "ok <|image:1|>"
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert back[1].loss_sha256 == hashlib.sha256(b"ok <|image:1|>").hexdigest()
    assert back[2].turns_sha256 == hashlib.sha256(b"\n\na:b\nt\n").hexdigest() and back[2].n_turns == 2
    assert back[None].loss_chars == 1
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_reader_sees_marks_across_pieces():
    whole = "".join(chat.Flatten().turn("user", [{"text": t}])[0] for t in TEXTS)
    reader = chat.Reader()
    for k in range(0, len(whole), 3):
        reader.feed(whole[k : k + 3], k, [])
    assert reader.turns == len(TEXTS) and not reader.rest
    assert reader.all.hexdigest() == hashlib.sha256("".join(f"user\n{t}\n" for t in TEXTS).encode()).hexdigest()


def test_tree_matching():
    a = wrappers.fold("<body><div class=x>1</div><article><h1>t</h1><p>a<p>b</article><footer>f</footer></body>").tree()
    b = wrappers.fold("<body><article><p>a</p></article><footer>f</footer></body>").tree()
    labels = [wrappers.read_tree(t)[1] for t in (a, b)]
    match = wrappers.align(a, b)
    assert [labels[0][i] for i, j in enumerate(match) if j < 0] == ["div.x", "h1"]
    assert all(labels[0][i] == labels[1][j] for i, j in enumerate(match) if j >= 0)


def test_wrappers(spark):
    soup = '<div class=x>same on all</div><ul><li><a href=1>aa</a><li><a href=2>bb{0}</a></ul><div id=text7><p>Hello <b>w{0}orld</b><p>second &lt;b&gt; &eacute;{0}</div><div class="foot">Same foot</div>'
    rows = [(i, f"http://www.h.example/{i}", soup.format(i)) for i in range(5)]
    rows += [(9, None, None), (10, "x", ""), (11, "http://q/", "just text"), (12, "http://q/2", "<p>a<"), (13, "http://q/3", "<script>x")]
    rows += [(None, "http://r", '<header>h</header><div class="user comments"><p>bad</div><form>f</form><p>good <i>x</i>y<br>z</body>')]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert got == {**{i: f"Hello w{i}orld second <b> é{i}" for i in range(5)}, 9: "", 10: "", 11: "just text", 12: "a<", 13: "", None: "good xy z"}
    assert wrappers.extract(df.limit(0)).count() == 0


def texts_of(spark, pages):
    df = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in wrappers.extract(df).orderBy("page_id").collect()]


def test_template_inside_marked_articles(spark):
    page = "<body><article><h1>Title {0}</h1><p>Text {0}</p><p>Share this page</p></article></body>"
    assert texts_of(spark, [page.format(i) for i in range(5)]) == [f"Title {i} Text {i}" for i in range(5)]
    copies = [page.format(0)] * 5  # copies of one page show nothing
    assert texts_of(spark, copies) == ["Title 0 Text 0 Share this page"] * 5


def test_names_do_not_drop_articles(spark):
    page = '<body class="x"><div class="layout sidebar"><article><header class="entry-header"><h1>T{0}</h1></header><div class="related-work"><p>R{0}</p></div><div class="comments"><p>C{0}</p></div></article></div></body>'
    assert texts_of(spark, [page.format(0)]) == ["T0 R0"]
    assert texts_of(spark, ['<div class="notice-period"><p>three months</p></div><div class="site-footer">f</div>']) == ["three months"]
    assert texts_of(spark, ['<div class="notice"><p>only this</p></div>']) == ["only this"]


def test_all_layouts_of_a_host(spark):
    one = "<body><div class=a><p>One {0}</p><p>Read our terms</p></div></body>"
    two = "<body><section class=b><p>Two {0}</p><p>Second notice</p><ul><li><a href=x>go {0}</a></li></ul></section></body>"
    got = texts_of(spark, [one.format(i) for i in range(6)] + [two.format(i) for i in range(4)])
    assert got == [f"One {i}" for i in range(6)] + [f"Two {i}" for i in range(4)]


def test_pages_query(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op6_wrappers"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        assert r.text == " ".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_deep_pages_and_pages_without_a_host(spark):
    """Nesting of any depth; pages without a URL are not taken for pages of one host."""
    deep = "<div>" * 3000 + "<p>Far inside.</p>" + "</div>" * 3000
    same = "<html><body><main><p>By the desk</p><p>Story {}</p></main></body></html>"
    rows = [(1, "http://a.example/1", deep), (2, "http://a.example/2", deep)] + [(10 + i, [None, "", "no url"][i % 3], same.format(i)) for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == got[2] == "Far inside."
    assert [got[10 + i] for i in range(6)] == [f"By the desk Story {i}" for i in range(6)]
