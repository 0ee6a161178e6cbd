"""WARC, HTML extraction, near-duplicate and nearest vectors, the registered queries and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelens.llm import ann, extraction, neardup, warc
from devicelens.llm.queries import ORACLES, QUERIES
from devicelens.llm.support import table
from devicelens.session import scratch_path
from tests.compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


# --- WARC -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("least", [0, 3])
def test_archive(spark, least):
    rows = [(1, "u1", "é" * 5), (2, "u2", "é" * 5), (3, None, None), (4, "u4", ""), (5, "u\r\n5", "x"), (6, "u6", "x"), (6, "u6", "x"), (None, "u7", "é" * 5), (None, "u8", "alone"), (9, "u9", "long " * 9000)]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, header string, payload int").repartition(3)
    path = scratch_path(spark, "test-warc")
    warc.write_archive(pages, path, min_bytes=least)
    got = [(r.id, bytes(r.payload), r.record_type, r.refers_to, r.digest, r.verified, bytes(r.record)) for r in warc.read_archive(spark, path).collect()]
    want = []
    for i, _, h in rows:
        payload = (h or "").encode()
        ids = [k for k, _, o in rows if (o or "").encode() == payload and k is not None]
        holder = max(ids, default=None) if len(payload) >= least else None
        revisit = holder is not None and i != holder
        want.append((i, payload, "revisit" if revisit else "response", str(holder) if revisit else None, base64.b32encode(hashlib.sha1(payload).digest()).decode(), True))
    assert sorted(map(str, (g[:6] for g in got))) == sorted(map(str, want))
    for _, payload, kind, _, digest, _, record in got:
        head, _, block = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and digest.encode() in head
        assert block == (payload if kind == "response" else b"") + b"\r\n\r\n"
    stored = [bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert len(stored) == len(set(stored)) == len({(h or "") for _, _, h in rows})


def test_archive_of_nothing(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).count() == 0


# --- HTML extraction --------------------------------------------------------------------------------------------

TEXT = "A sentence of the article, with some words in it. Another one follows, as it does."


@pytest.fixture(scope="module")
def trees(spark, sf_dir):
    return extraction.fit_extractor(table(spark, sf_dir, "pages"))


def test_layouts_not_seen(trees):
    page = f"""<!doctype html><html><head><title>T</title><style>p{{a:b}}</style><script>var a="</p><p>x";</script></head><body>
    <div class="navbar"><a href=/>Home</a> <a href=/b>B</a></div>
    <div class="cookie-notice"><p>We use cookies on this page.</p><button>OK</button></div>
    <main><h1>The &amp; title</h1><p>{TEXT}<p>Second&nbsp; <b>bold</b>\n text.<br>after {TEXT}<div class="ad">Buy now</div><ul><li>one thing of it<li>another thing of it</ul></main>
    <aside><h3>Related</h3><ul><li><a href=/r>Other</a></li><li><a href=/s>More</a></li></ul></aside>
    <section id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>{TEXT}</p></div></section>
    <form><label>Mail</label><input><button>Go</button></form><footer>&copy; Site</footer>"""
    want = ["The & title", TEXT, f"Second bold text. after {TEXT}", "one thing of it", "another thing of it"]
    assert extraction.extract_text(page, trees).split("\n") == want


@pytest.mark.parametrize("head", ["<title>T</title>", "<title>T <p> and <body> tags</title>", "<title>T", "<meta charset=utf-8><title>T</title><noscript><p>No script</p></noscript><style>p{}</style>", "<title>T</title><noscript><link href=a>", "<template><p>no</p></template><title>T</title>", "<base href=/><script>'<p>'</script>"])
@pytest.mark.parametrize("body", ["<body>", "", "</head><body>"])
def test_head_without_its_end(trees, head, body):
    rest = f"""<div class="nav"><a href=/>Home</a> <a href=/b>B</a></div><article><h1>Name</h1><p>{TEXT}</p><p>{TEXT}</p></article><footer>&copy; Site</footer>"""
    want = extraction.extract_text(f"<html><head><title>T</title></head><body>{rest}</body></html>", trees)
    assert TEXT in want
    assert extraction.extract_text(f"<!doctype html><html><head>{head}{body}{rest}</body></html>", trees) == want


def test_text_ends_a_head(trees):
    _, out = extraction.parse(f"<head><title>T</title>\n{TEXT}<b>bold</b>")
    assert "".join(t for _, t in out).split("\n")[-1] == f"{TEXT}bold"


def test_given_pages_keep_their_article(spark, sf_dir, trees):
    import html
    import re

    rows = table(spark, sf_dir, "pages").collect()
    out = {r.page_id: r for r in extraction.extract(table(spark, sf_dir, "pages"), trees).collect()}
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|h2|li|ul|div)>", inside)]
        assert out[r.page_id].text == "\n".join(b for b in blocks if b) and out[r.page_id].n_chars == len(out[r.page_id].text)


def test_no_kept_node_below_a_cut_one():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        nodes = [extraction.Node("div", int(rng.integers(0, i)) if i else -1, 0, 0) for i in range(n)]
        odds = rng.normal(size=n)
        keep = extraction.decode(nodes, odds)
        assert all(keep[nodes[i].parent] or not keep[i] for i in range(1, n))
        if n <= 10:
            best = max(sum(odds[i] for i in range(n) if s >> i & 1) for s in range(1 << n) if all(not s >> i & 1 or s >> nodes[i].parent & 1 for i in range(1, n)))
            assert abs(best - odds[keep].sum()) < 1e-9


@pytest.mark.parametrize("page", [None, "", "<", "<p", "plain & text", "<a" * 500, "<div>" * 5000, '<p class="x>y', "<!-- open", "</p></div>", "<script>never closed", "\x00<p>퟿" * 3, "<p>" + "word " * 200_000])
def test_broken_pages(trees, page):
    assert isinstance(extraction.extract_text(page, trees), str)


def test_extract_odd_rows(spark, trees):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "", "t"), (1, None, None, "t"), (2, "u", f"<article><p>{TEXT}</p><p>{TEXT}</p></article>", "t")], "page_id long, url string, html string, text string")
    out = extraction.extract(pages, trees).collect()
    assert sorted(r.n_chars for r in out) == [0, 0, 0, 2 * len(TEXT) + 1]
    assert extraction.extract(pages.limit(0), trees).count() == 0
    extraction.fit_extractor(pages.limit(0))


# --- vectors ----------------------------------------------------------------------------------------------------


def vector_rows(seed, n=160, d=12):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.normal(size=(8, d))
    for i in range(n):
        v = base[rng.integers(8)] + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.3, 2.0])
        rows.append((i * 2 if i % 3 else i * 20, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    seen, unique = set(), []
    for r in rows:
        if r[0] not in seen:
            seen.add(r[0])
            unique.append(r)
    return [*unique, (9001, None, 1), (9020, [0.0] * d, 1), (9003, [float("nan")] * d, 1), (9004, [None] * d, 1), (9006, [1.0, 2.0], 0), (9040, [1.0, 2.0], None), (9060, [float("inf")] + [0.0] * (d - 1), 2), (9080, [2.0, 4.0], 0)]


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile", [2_000, 9])
def test_near_vectors(spark, tile):
    rows = vector_rows(1)
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, label int, n_links double").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neardup.near_vectors(frame, tile=tile).collect()}
    part = sorted(r for r in rows if good(r[1]) and r[2] is not None)
    a, b = [], []
    for x in range(len(part)):
        for y in range(len(part)):
            p, q = np.array(part[x][1]), np.array(part[y][1])
            if x != y and part[x][2] == part[y][2] and len(p) == len(q) and p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.93:
                a.append(x)
                b.append(y)
    from devicelens.llm.components import lowest_labels

    label = lowest_labels(len(part), np.array(a, int), np.array(b, int))
    want = {r[0]: (0, r[0], True) for r in rows}
    for k, r in enumerate(part):
        want[r[0]] = (a.count(k), part[label[k]][0], part[label[k]][0] == r[0])
    assert got == want


@pytest.mark.parametrize("exact", [True, False])
def test_nearest(spark, exact):
    rows = vector_rows(2)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, rank int").repartition(3)
    got = {}
    for r in ann.nearest(frame, k=7, window=16, exact=exact).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    part = [r for r in rows if good(r[1])]
    found = total = 0
    for i, v, _ in part:
        if i % 20:
            assert i not in got
            continue
        others = sorted(((-float(np.cumsum(np.array(v) * np.array(w))[-1]), j) for j, w, _ in part if j != i and len(w) == len(v)))[:7]
        want = [(n + 1, j, -s) for n, (s, j) in enumerate(others)]
        mine = sorted(got.get(i, []))
        total += len(want)
        found += len({j for _, j, _ in want} & {j for _, j, _ in mine})
        if exact:
            assert mine == want, i
    assert found >= 0.9 * total if exact else found > 0.4 * total


def test_recall_of_the_registered_search(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = {}
    for r in QUERIES["op8_nearest"](spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(best & got[ids[q]]), total + len(best)
    assert hits >= 0.9 * total


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_steps_to_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    key = ann.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_links_between_equals_products():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 40)), rng.normal(size=(60, 40))
    b[:20] = a[:20] + rng.normal(size=(20, 40)) * 0.2
    turned = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for t in (0.2, 0.9, 0.99):
        want = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)) >= t
        r, c = neardup.links_between(a, b, turned, t, 7)
        assert set(zip(r.tolist(), c.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(want))))


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neardup.near_vectors(frame).count() == 0 and ann.nearest(frame).count() == 0
    one = spark.createDataFrame([(20, [1.0], 1), (3, None, None)], frame.schema)
    assert ann.nearest(one).count() == 0 and neardup.near_vectors(one).count() == 2


# --- registered queries and the pipeline ------------------------------------------------------------------------


def test_entry_lists_all(spark):
    import __spark_entry__ as entry

    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_pipeline_stages(spark):
    import corpus_pipeline
    from devicelens.session import stored
    from tests.llm.test_text_operators import plain_components, plain_fingerprint, plain_repeats

    sf_dir = "/root/testdata/sf0.001"
    steps = {"input": table(spark, sf_dir, "documents").limit(120)}
    docs = steps["input"] = stored(steps["input"], "test-docs")
    for name, stage in corpus_pipeline.STAGES:
        docs = steps[name] = stored(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "tokens":
            assert docs.columns == steps["input"].columns
    rows = {k: sorted((r.doc_id, r.text) for r in v.collect()) for k, v in steps.items() if k != "tokens"}
    assert set(rows["toxicity"]) <= set(rows["input"])
    before = rows["toxicity"]
    groups = plain_components([i for i, _ in before], [plain_fingerprint(t) for _, t in before])
    assert rows["near_duplicates"] == [r for r, g in zip(before, groups) if r[0] == g]
    want = {s.split(",")[0].strip("("): s for s in plain_repeats(rows["near_duplicates"], 100)}
    old = dict(rows["near_duplicates"])
    for i, text in rows["repeats"]:
        n_bytes, n_removed = (int(x) for x in want[str(i)].split(",")[1:3])
        assert n_bytes - n_removed - 6 * 8 <= len(text.encode()) <= n_bytes - n_removed
        assert n_removed or text == old[i]
    texts = dict(rows["repeats"])
    taken = {}
    for i, text in rows["mix"]:
        assert set(text.split()) <= set(texts[i].split())
        taken[i] = taken.get(i, 0) + len(text.split())
    assert all(n <= 3 * len(texts[i].split()) for i, n in taken.items())
    out = steps["tokens"].collect()
    assert sorted(r.decoded_sha256 for r in out) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in rows["mix"])


def test_pipeline_keeps_odd_rows(spark, sf_dir):
    import corpus_pipeline
    from devicelens.session import stored

    rows = [(1, "a b c", "en", "s", 5), (2, None, None, None, None), (None, "x y z w v", "en", None, 9), (3, "", "en", "s", 0), (4, "a b c d e f", "en", "t", 11), (4, "a b c d e f", "en", "t", 11), (5, "v " * 4000, "en", "s", 8000)]
    frame = spark.createDataFrame([(*r, 1, "u") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id int, _text string")
    docs = frame
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, sf_dir), f"odd-{name}")
        assert docs.columns == frame.columns
        if name != "mix":
            ids = [r.doc_id for r in docs.select("doc_id").collect()]
            assert {1, 4, 5, None} <= set(ids), name
    assert docs.count() > 0
    empty = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


# --- markup and header lines that are easily misread --------------------------------------------------------------


def text_of(page):
    nodes, pieces = extraction.parse(page)
    return extraction.assemble(pieces, np.ones(len(nodes), bool))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>We said <a href='x' title='don't go'>this</a> here.</p><p>It's a long article, isn't it</p>", "We said this here.\nIt's a long article, isn't it"),
        ("if a < b then c > d holds", "if a < b then c > d holds"),
        ("<p>intro</p><!-->after one<!--->after two", "intro\nafter oneafter two"),
        ("<p>x</p><!-- a --!>y<!-- <p>no</p> -- > -->z", "x\nyz"),
        ("Hello <b>x</b>\n<b>y</b>", "Hello x y"),
        ("a <svg><g><path d='x'/></g></svg> sentence <iframe src=x><p>no</iframe> goes <math><mi>no</math>on", "a sentence goes on"),
        ("<a b=c/>x</a></>y</ no>z<?no?>w<![CDATA[no]]>v", "xyzwv"),
        ("a <textarea><b>no</textarea> b <textarea> c", "a b"),
        ("<div class='a>b' id=c'd>x</div>1 <2 and <3", "x\n1 <2 and <3"),
        ("<DIV\nCLASS = \"a\"\tdata-main>x<BR/>y</DIV >z", "x y\nz"),
        ("<script>if (a</b>) '<p>'</scripty></script >x<style></style/>y", "xy"),
        ("<p title='never closed>all of this is in the tag", ""),
        ("&lt;b&gt; &amp;c &#x41; < &notit; a<", "<b> &c A < \u00acit; a<"),
    ],
)
def test_markup_as_html_reads_it(page, text):
    assert text_of(page) == text


def test_attributes_of_blocks():
    nodes, _ = extraction.parse("<div class=\"Nav bar\" id='it\"s' role=main x=y data-main=1><p class=a/><p id= b >t")
    assert [n.tokens for n in nodes[1:]] == [' nav bar it"s main', " a/", " b"] and nodes[1].main and not nodes[2].main


def test_tokens_against_the_standard_parser():
    """Random markup of tags, quotes, comments and loose marks: the same characters of text, in order."""
    import html.parser

    class Plain(html.parser.HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.text = []

        def handle_data(self, data):
            self.text.append(data)

    parts = ["word ", "it's ", 'say "so" ', "<p>", "</p>", "<b class='x y'>", "</b>", '<i title="a > b">', "</i>", "<div id=c>", "</div>", "<!-- note <p> -->", "1 < 2 ", "a > b ", "&amp; ", "&eacute;", "<br/>", "<img alt='don\"t'>", "\n", "<span\nclass=z >", "</span>", "&", "<em>", "</em >"]
    rng = random.Random(12)
    for _ in range(400):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) + "."
        plain = Plain()
        plain.feed(page)
        plain.close()
        got = "".join(piece for node, piece in extraction.parse(page)[1] if node >= 0 and piece != " ")
        assert "".join(got.split()) == "".join("".join(plain.text).split()), page


@pytest.mark.parametrize("unit", ["<a b='", "<", "<!--", "</", "<a ", "<li><b>", "<textarea>", "</b>", "<!-- --"])
def test_a_megabyte_of_broken_markup_takes_linear_time(unit):
    page = unit * (1_000_000 // len(unit))
    start = time.time()
    extraction.parse(page)
    assert time.time() - start < 20  # seconds if it is linear, hours if not


def test_archive_fields_do_not_come_from_a_url(spark, tmp_path):
    """Line ends of Unicode, and of HTTP, inside a URL."""
    ends = ["\u0085", "\u2028", "\u2029", "\r\n", "\n", "\r", "\x0b", "\x0c"]
    rows = [(i, f"http://x/{e}WARC-Refers-To: <urn:page:99>{e}WARC-Type: revisit{e}WARC-Payload-Digest: sha1:AAAA", f"<p>{i}</p>") for i, e in enumerate(ends)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    back = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert len(back) == len(ends)
    for r in back:
        assert r.record_type == "response" and r.refers_to is None and r.verified, r


def test_archive_verifies_the_key_too(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, html string"), path)
    other = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.when(F.col("payload") == F.lit(b"one"), F.lit(b"onf")).otherwise(F.col("payload")))
    other.write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / "b/headers"))
    assert {r.id: r.verified for r in warc.read_archive(spark, str(tmp_path / "b")).collect()} == {1: False, 2: True}
