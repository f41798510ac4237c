"""Reply trees, exact top-k search and HTML extraction."""

import html as entities
from collections import Counter, defaultdict
from html.parser import HTMLParser

import duckdb
import numpy as np
import pandas as pd
import pytest

from footfall.llm import host_consensus as hc
from footfall.llm import impact_index as ii
from footfall.llm import reply_trees as rt
from footfall.llm.queries import ORACLE, QUERIES

from .conftest import SF_MID, key, rows_of

MESSAGES = "tree_id long, node_id string, parent_id string, role string, text string, score double"


def against_sql(spark, name, table, cols):
    duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SF_MID}/{table}.parquet'")
    want = duckdb.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert rows_of(QUERIES[name](spark, SF_MID), *cols) == sorted(want, key=key)


# ------------------------------------------------------------------ reply trees

def test_conversations_match_sql(spark):
    against_sql(spark, "op4_reply_trees", "conversations",
                ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))


def test_paths_ranks_cycles_and_orphans(spark):
    rows = [(1, "a", None, "user", "q", 1.0), (1, "b", "a", "assistant", "x<#\\", 2.0), (1, "c", "a", "assistant", "y", 3.0),
            (1, "d", "b", "user", "z", None), (1, "x", "y", "user", "loop", 0.0), (1, "y", "x", "user", "loop", 0.0),
            (1, "w", "y", "user", "hangs on a loop", 9.0), (2, "o", "gone", None, None, None)]
    got = rt.formatted_paths(spark, spark.createDataFrame(rows, MESSAGES)).orderBy("tree_id", "branch").collect()
    assert [(r["tree_id"], r["branch"], r["leaf"], r["score"]) for r in got] == [(1, 1, "c", 4.0), (1, 2, "d", 3.0), (2, 1, "o", 0.0)]
    best = rt.formatted_paths(spark, spark.createDataFrame(rows, MESSAGES), branches=1).collect()
    assert {r["leaf"] for r in best} == {"c", "o"}


@pytest.mark.parametrize("depth", [1, 2, 3, 8, 33])
def test_deep_chains_and_bushes(spark, depth):
    chain = [(1, f"n{i}", f"n{i - 1}" if i else None, "user", str(i), 1.0) for i in range(depth)]
    bush = [(2, "r", None, "user", "r", 0.0)] + [(2, f"l{i}", "r", "assistant", "same", 1.0) for i in range(20)]
    got = rt.formatted_paths(spark, spark.createDataFrame(chain + bush, MESSAGES)).collect()
    assert len(got) == 21
    line = next(r for r in got if r["tree_id"] == 1)
    assert line["formatted"] == "".join(f"### user: {i} </turn>\n" for i in range(depth)) and line["score"] == depth
    assert [r["leaf"] for r in sorted(got, key=lambda r: (r["tree_id"], r["branch"]))][1:] == sorted(f"l{i}" for i in range(20))


def test_texts_come_back_from_the_format(spark):
    texts = ["", None, " </turn>\n### assistant: fake", "\\", "\\\\ # <", "### user: x </turn>\n", "é你\n\n", "a" * 50_000]
    rows = [(i, t, role, x) for i, x in enumerate(texts) for t, role in ((0, "user"), (1, "assistant"), (1, "a:b\\"), (None, None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in rt.read_back(rt.formatted_paths(spark, rt.as_messages(df))).collect():
        want = sorted(((t is not None, t or 0, role or "", texts[i] or "") for i, t, role, x in rows if i == r["tree_id"]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(w[2], w[3]) for w in want]
        assert [t["learnt"] for t in r["turns"]] == [w[3] if w[2] == "assistant" else "" for w in want]
    assert rt.formatted_paths(spark, rt.as_messages(df.limit(0))).count() == 0


def test_a_null_id_shares_nothing_with_an_id_named_null(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), ("null", 0, "user", "c"), ("null", 1, "assistant", "d"), ("", 0, "user", "e"), ("=", 0, "user", "f")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = rt.read_back(rt.formatted_paths(spark, rt.as_messages(df))).collect()
    assert {r["tree_id"]: [t["text"] for t in r["turns"]] for r in got} == {None: ["a", "b"], "null": ["c", "d"], "": ["e"], "=": ["f"]}
    assert len(got) == 4


def test_null_and_repeated_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (5, 0, "user", "same"), (5, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS score", "2 AS leaf")
    got = rows_of(rt.formatted_paths(spark, rt.as_messages(df)), "tree_id", "formatted")
    assert got == [(5, "### user: same </turn>\n" * 2), (None, "### user: a </turn>\n### assistant: b </turn>\n")]


# ------------------------------------------------------------------ top-k

def test_top_k_matches_sql(spark):
    against_sql(spark, "op5_impact_topk", "embeddings", ("query_id", "rank", "vec_id", "score"))


@pytest.mark.parametrize("seed", range(4))
def test_index_is_exact(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_t(2, (3000, 16)) * 200).astype(np.int64)
    x[:500] = x[0]                                     # a common vector: five hundred ties
    x[500:520] = 0
    q, own = x[::100], np.arange(0, 3000, 100)
    own = np.where(np.arange(30) % 3 == 0, -1, own)
    ids = rng.permutation(3000)
    who, row, score = ii.ImpactIndex(x).search(q, own, ids, 10)
    for i in range(30):
        s = x @ q[i]
        ok = np.arange(3000) != own[i]
        want = sorted(zip(-s[ok], ids[ok]))[:10]
        assert list(zip(-score[who == i], ids[row[who == i]])) == want


def given_vectors():
    table = pd.read_parquet(f"{SF_MID.replace('0.01', '0.1')}/embeddings.parquet")
    usable = [(i, v) for i, v in zip(table.vec_id, table.embedding) if v is not None and len(v) and np.isfinite(v).all()]
    return np.array([i for i, _ in usable]), np.floor(1024 * np.array([v for _, v in usable], float)).astype(np.int64)


def test_most_rows_leave_before_the_last_segment():
    ids, x = given_vectors()
    at = np.flatnonzero(ids % 100 == 0)
    index = ii.ImpactIndex(x)
    found, left = index.survivors(x[at], at, 10)
    pairs = len(at) * len(x)
    assert left == sorted(left, reverse=True) and len(left) <= len(index.segments) + 1
    assert left[len(index.segments) - 1 if len(left) > len(index.segments) else -1] < pairs / 4, (left, pairs)
    assert sum(map(len, found)) < pairs / 20
    for i, rows in zip(at, found):                     # no row of the best is out
        s = x @ x[i]
        s[i] = np.iinfo(np.int64).min
        assert set(np.flatnonzero(s >= np.sort(s)[-10])) <= set(rows.tolist())


def test_a_query_stops_at_the_first_proof():
    x = np.zeros((2000, 8), np.int64)
    x[:, 0] = 1
    x[:20, 1] = 1000 + np.arange(20)                   # the best rows are known from the first segment
    found, left = ii.ImpactIndex(x).survivors(np.array([[0, 9, 0, 0, 0, 0, 0, 0]]), np.array([-1]), 10)
    assert left[1] <= 64 and len(left) == 2 and set(range(10, 20)) <= set(found[0].tolist())


@pytest.mark.parametrize("bits", [24, 26, 28, 29])
def test_large_components_are_scored_exactly(bits):
    rng = np.random.default_rng(bits)
    x = 2**bits + rng.integers(0, 4, (300, 8)) if bits % 4 else rng.integers(-2**bits, 2**bits, (300, 8))
    x[:100] = x[0]
    ids = rng.permutation(300)
    who, row, score = ii.ImpactIndex(x).search(x[::30], np.arange(0, 300, 30), ids, 10)
    for i in range(10):
        s = x.astype(object) @ x[30 * i].astype(object)
        want = sorted((-int(s[j]), int(ids[j])) for j in range(300) if j != 30 * i)[:10]
        assert [(-int(a), int(b)) for a, b in zip(score[who == i], ids[row[who == i]])] == want


@pytest.mark.parametrize("component", [2**40, 2**62, -2**63])
def test_scores_beyond_64_bits_are_an_error(component):
    x = np.full((3, 4), component, np.int64)
    with pytest.raises(OverflowError):
        ii.ImpactIndex(x).search(x, np.full(3, -1), np.arange(3), 2)


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(ii, "SHARD_ROWS", 3)
    monkeypatch.setattr(ii, "QUERY_ROWS", 1)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (100, [-1.0, 0.0]), (None, [2.0, 2.0]), (7, [1.0, 0.5]), (8, [0.00001, -0.00001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "'x' AS rank", "0 AS query_id")
    vectors = ii.integer_vectors(df)
    assert vectors.where("vec_id = 8").first()["v"] == [0, -1]
    got = rows_of(ii.top_k(spark, vectors, "vec_id % 100 = 0"), "query_id", "rank", "vec_id", "score")
    usable = [(i, np.floor(1024 * np.float32(v).astype(float)).astype(int)) for i, v in rows
              if v and all(c is not None and np.isfinite(c) for c in v)]
    want = []
    for n, (i, q) in enumerate(usable):
        if i is not None and i % 100 == 0:
            best = sorted((-int(q @ v), (j is None, j or 0)) for m, (j, v) in enumerate(usable) if m != n)[:10]
            want += [(i, r + 1, None if j[0] else j[1], -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want, key=key)
    assert ii.top_k(spark, vectors.limit(0), "vec_id % 100 = 0").count() == 0


# ------------------------------------------------------------------ pages

class Article(HTMLParser):
    """Brute force for the test tables, whose main text is always in the article element."""

    def __init__(self):
        super().__init__()
        self.on, self.blocks, self.buffer = False, [], ""

    def flush(self):
        text = " ".join(self.buffer.split())
        self.buffer = ""
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article", "ul", "li", "div"):
            self.flush()
        self.on |= tag == "article"
        self.buffer += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article", "ul", "li", "div"):
            self.flush()
        if tag == "article":
            self.on = False

    def handle_data(self, data):
        if self.on:
            self.buffer += data


def test_pages_of_the_tables(spark):
    got = QUERIES["op8_host_consensus"](spark, SF_MID).toPandas().set_index("page_id")
    for r in pd.read_parquet(f"{SF_MID}/pages.parquet").itertuples():
        slow = Article()
        slow.feed(r.html or "")
        slow.close()
        slow.flush()
        assert got.text[r.page_id] == "\n\n".join(slow.blocks)
        assert got.n_chars[r.page_id] == len(got.text[r.page_id]) and got.url[r.page_id] == r.url


LAYOUT = """<html><body><header><h1>Site</h1><nav><a href=x>m</a></nav></header><div id="cookie-notice">We use cookies</div>
<div class="layout"><div class="post-{n} content"><h1>T &amp; t</h1><p>One <b>two</b><br>three&nbsp;x &lt;tag&gt;<p class=x>Unclosed "quote
<div class="ad-box">buy</div><ul><li>a<li>b</ul><form><input>q</form><section id="comments"><p>me too</p></section></div>
<aside>side</aside></div><footer>c</footer><script>var a="</p>"</script></body></html><p"""
MAIN = 'T & t\n\nOne two three x <tag>\n\nUnclosed "quote\n\na\n\nb'


def test_boilerplate_goes_and_blocks_stay():
    assert hc.main_text(LAYOUT.format(n=1), []) == MAIN
    assert {p for p, _, _ in hc.page_blocks(LAYOUT.format(n=12))} == {"div.layout>div.content.post-#"}
    assert hc.main_text("", []) == hc.main_text("<nav>only</nav>", []) == ""
    assert hc.main_text("plain &amp;amp; text\n  here", []) == "plain &amp; text here"
    assert hc.main_text("<article><p>a</p><table><tr><td>b<td>c</table><p title='<p>'>d<!-- x --></article>e", []) == "a\n\nb\n\nc\n\nd"


@pytest.mark.parametrize("kept", [
    '<h2 id="related-work">x</h2>', '<section id="discussion">x</section>', '<p class="notice">x</p>', '<p><span class="ad">x</span></p>',
    '<div class="side-by-side">x</div>', '<div class="commentary">x</div>', '<div class="comments-on-x">x</div>',
    '<div class="cookie-recipe">x</div>', '<p hidden>x</p>', '<div class="has-sidebar">x</div>'])
def test_words_of_real_text_drop_nothing(kept):
    for page in ("<article><p>a</p>{}</article>", "<main><p>a</p>{}</main>", "<div><p>a</p>{}</div>"):
        assert [t for _, t, _ in hc.page_blocks(page.format(kept))] == ["a", "x"], page


def test_boilerplate_words_need_evidence_inside_an_article():
    links = "<a href=y>more of this</a> and <a href=z>that</a>"
    for gone in ('<div class="ad-box">x</div>', '<div class="comments">x</div>', '<p role="alert">x</p>', '<nav>x</nav>',
                 f'<section id="related">{links}</section>', f'<ul class="menu"><li>{links}</ul>',
                 f'<div class="related"><div class="share"><p>x</p></div>{links}{links}</div>'):
        assert [t for _, t, _ in hc.page_blocks(f"<article><p>a</p>{gone}<p>b</article>")] == ["a", "b"], gone
    for word in ("notice", "menu", "sidebar", "related", "search"):
        kept = f'<section id="{word}"><p>plain text on it, one <a href=x>link</a></p></section>'
        assert len(hc.page_blocks(f"<article><p>a</p>{kept}</article>")) == 2, word
    for word in ("notice", "site-footer", "cookie_notice", "sidebar", "widget-2", "top-menu", "site-header"):
        assert hc.page_blocks(f'<p>a</p><div class="{word}">x</div>') == [("", "a", 0)], word


def test_winning_path_overrules_a_page(spark):
    many = [(i, "http://h.example/x", LAYOUT.format(n=i)) for i in range(8)]
    short = LAYOUT.format(n=9).replace("<aside>side</aside>", "<div class='extra'>" + "much longer text beside it " * 20 + "</div>")
    rows = [*many, (8, "https://u@H.example:80/y", short), (9, None, None), (10, "", "<p>x</p>"), (10, "", "<p>x</p>"), (None, "bad", "<main>y</main>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "1 AS __host", "2 AS n_chars")
    got = {(r["page_id"], r["url"]): r["text"] for r in hc.extracted(spark, df).collect()}
    assert got[0, "http://h.example/x"] == MAIN and got[8, "https://u@H.example:80/y"] == MAIN
    assert hc.main_text(short, []) != MAIN
    assert got[9, None] == "" and got[10, ""] == "x" and got[None, "bad"] == "y"
    assert hc.extracted(spark, df).count() == len(rows) and hc.extracted(spark, df.limit(0)).count() == 0


LONG = "the main text of the page goes on " * 20
STORY = f'<div class="story"><p>{LONG}</p></div><div class="content">small box</div>'


def test_winner_counts_only_where_it_holds_the_main_text():
    assert hc.main_text(STORY, ["div.content"]).startswith(LONG.strip())
    nested = f'<div class="wrap"><div class="post"><p>{LONG}</p></div><p><a href=x>more</a></p></div>'
    assert hc.main_text(nested, ["", "div.wrap", "div.wrap>div.post"]) == LONG.strip()
    article = f"<p>beside it</p><article><p>{LONG}</p></article>"
    for winners in ([""], ["", "article"]):
        assert hc.main_text(article, winners) == LONG.strip()
    assert hc.main_text(f"<div class=wrap>{article}</div>", ["div.wrap"]) == LONG.strip()
    assert hc.main_text(f"<div><p>{LONG}</p></div><p><a href=x>elsewhere</a>", [""]) == LONG.strip()


def test_headings_leads_and_sections_beside_the_best_path_stay():
    a, b, c = LONG.strip(), "a second part " * 15 + "end", "a column of text " * 8 + "end"
    post = f"<div class=post><h1>title</h1><p>lead</p><div class=body><p>{a}</p></div>{{}}</div>"
    for winners in ([], ["div.post>div.body"], ["div.post"], [""]):
        assert hc.main_text(post.format(""), winners) == f"title\n\nlead\n\n{a}"
        assert hc.main_text(post.format(f"<div class=col>{c}</div>"), winners) == f"title\n\nlead\n\n{a}\n\n{c}"
    linked = "<div class=more><a href=x>one more page</a> <a href=y>and another</a></div>"
    assert hc.main_text(f"<div class=wrap><div class=body><p>{a}</p></div>{linked}</div>", []) == a
    assert hc.main_text(post.format(linked), []).startswith(f"title\n\nlead\n\n{a}")
    parts = f"<article class=part-a><p>{a}</p></article>{{}}<article class=part-b><p>{b}</p></article>"
    for winners in ([], ["article.part-a"], ["", "article.part-b"]):
        assert hc.main_text(parts.format(""), winners) == f"{a}\n\n{b}"
        assert hc.main_text(parts.format("<p><a href=x>" + "links " * 50 + "</a></p>"), winners) == f"{a}\n\n{b}"
    assert hc.main_text(f"<article><p>{b}</p></article><div class=rest><p>{a}</p></div>", ["article"]) == f"{b}\n\n{a}"


def test_minority_template_keeps_its_main_text(spark):
    usual = f'<div class="content"><p>{LONG}</p></div>'
    rows = [(i, "http://h.example/x", usual) for i in range(8)] + [(8, "http://h.example/y", STORY)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all(r["text"].startswith(LONG.strip()) for r in hc.extracted(spark, df).collect())


def test_quotes_in_tags_take_linear_time():
    page = "<p>" + "<a title=5\" x>" * 20_000 + "text" + entities.escape("<") * 10
    assert hc.main_text(page, []).startswith("text")


@pytest.mark.parametrize("gone", [
    "div class=user-comments", "div class=comments-section", "section id=comments", "article class=comment", "div class=left-sidebar",
    "div class=sidebar-right", "div class=privacy-notice", "div class=reader-comments", "div class='box post-comments'"])
def test_boxes_named_with_a_place_go(gone):
    end = f"</{gone.split()[0]}>"
    foreign = "comment" in gone
    for page in ("<div class=x><p>{a}</p>{box}</div>", "<main><p>{a}</p>{box}</main>", "<article><p>{a}</p>{box}</article>"):
        if foreign or "<article>" not in page:
            box = f"<{gone}><p>prose of another person, said at length</p>{end}"
            assert hc.main_text(page.format(a=LONG, box=box), []) == LONG.strip(), (gone, page)


@pytest.mark.parametrize("kept", ["has-sidebar", "post-header", "left-side", "section-header", "article-body", "comments-open", "page-1"])
def test_names_of_columns_and_heads_stay(kept):
    assert [t for _, t, _ in hc.page_blocks(f"<main><p>a</p><div class={kept}><p>x</p></div></main>")] == ["a", "x"]


def test_a_wrapper_with_the_main_element_stays():
    page = f"<div class=page-sidebar-right><main><p>{LONG}</p></main><div class=sidebar><p>beside</p></div></div>"
    assert hc.main_text(page, []) == LONG.strip()
    assert hc.page_blocks("<nav><main>x</main></nav>") == [] == hc.page_blocks("<div class=sidebar><p>x</p></div>")


TOP = ('<nav><a href=a>home</a></nav>', '<div class=site-header><p>Site name</p></div>', '<ul class=top-menu><li><a href=b>m</a></ul>')
BODY = ('<div class="story n{i}">{b}{in_}</div>', '<div id=page><section class=text>{b}</section>{in_}</div>', '<table><tr><td class=main>{b}{in_}</table>',
        '<main>{b}{in_}</main>', '<div class=wrap><div class=col><div class=entry-{i}>{b}</div></div></div>{in_}', '{b}{in_}', '<div class=post>{b}<div class=more>{in_}</div></div>')
INSIDE = ('', '<div class=user-comments><p>I agree with all of it</p></div>', '<div class=right-sidebar><p>Also read this</p></div><div class=ad-box>buy</div>')


def test_templates_without_article_on_hot_and_mixed_hosts(spark):
    rows, want = [], {}
    for t in range(21):
        for n in range(1 + 30 * (t == 0) + t % 3):         # template 0 is most of its host
            i = len(rows)
            parts = [f"Title {i}", f"Lead of text {i}.", *(f"Paragraph {k} of page {i} " + "with words of its own " * (9 + k) + "end." for k in range(3))]
            b = f"<h1>{parts[0]}</h1><p class=lead>{parts[1]}</p>" + "".join(f"<p>{p}</p>" for p in parts[2:])
            page = TOP[t % 3] + BODY[t % 7].format(i=i, b=b, in_=INSIDE[t // 7]) + "<div class=site-footer>imprint</div><form><p>mail</p></form>"
            rows.append((i, f"https://h{t % 2}.example/{i}", f"<html><body>{page}</body></html>"))
            want[i] = "\n\n".join(parts)
    got = hc.extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and len(got) == len(rows)


UNNAMED = '<div class=zone-a><p>{note}</p></div>'


def hosts_with_boxes() -> tuple[list[tuple], dict[int, str]]:
    """Pages without article whose hosts put prose in boxes that no word names; and the text of each."""
    rows, want = [], {}
    def page(host, story, box):
        i = len(rows)
        rows.append((i, f"https://{host}/{i}", f"<body><div class=col><div class=story>{story}</div>{box}</div></body>"))
        return i
    for n in range(40):                                    # a hot host: the same prose beside every text
        body = f"Text {n} of the hot host, " + "said at some length " * 12 + "end."
        want[page("hot.example", f"<p>{body}</p>", UNNAMED.format(note="We are a small paper and live from what readers give us."))] = body
    for n in range(12):                                    # a mixed host: every page has a note of its own in the same box
        body, note = f"Text {n} of another host, " + "with words of its own " * 12 + "end.", f"Note {n}, which belongs to the text."
        want[page("mixed.example", f"<p>{body}</p>", UNNAMED.format(note=note))] = f"{body}\n\n{note}"
    same = "One text with its note, " + "copied many times over " * 12 + "end."
    for _ in range(9):                                     # copies of one page say nothing about their host
        want[page("copies.example", f"<p>{same}</p>", UNNAMED.format(note="Its own note."))] = f"{same}\n\nIts own note."
    for n in range(9):                                     # most of the text is the same on all pages: it stays
        want[page("forms.example", f"<p>{same}</p>", f"<div class=when><p>Day {n}</p></div>")] = f"{same}\n\nDay {n}"
    for n in range(4):                                     # too few pages to tell
        body = f"Text {n} of a small host, " + "said at some length " * 12 + "end."
        want[page("small.example", f"<p>{body}</p>", UNNAMED.format(note="A line.")) ] = f"{body}\n\nA line."
    for n in range(9):                                     # inside an article element a repeated box is the article's
        body = f"Article {n}, " + "said at some length " * 12 + "end."
        i = page("articles.example", "", "")
        rows[i] = (i, rows[i][1], f"<article><p>{body}</p>{UNNAMED.format(note='Part of a series.')}</article>")
        want[i] = f"{body}\n\nPart of a series."
    return rows, want


def test_boxes_that_a_host_repeats_go(spark):
    rows, want = hosts_with_boxes()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = hc.extracted(spark, df).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and len(got) == len(rows)
    alone = hc.extracted(spark, df.where("page_id = 0")).first()["text"]
    assert alone != want[0]                                # it is the host's other pages that tell


def test_repeated_boxes_against_a_brute_force(spark):
    """Counts of every box by plain dictionaries over the boxes' texts, without digests."""
    rows, _ = hosts_with_boxes()
    pages = defaultdict(set)
    seen = defaultdict(set)
    for _, url, html in rows:
        host = url.split("/")[2]
        pages[host].add(html)
        paths, blocks = hc.parsed(html)
        sums = hc.container_sums(paths, blocks)
        for p in hc.small_boxes(sums, blocks):
            inside = paths.within([p])
            seen[host, paths.text(p), tuple(t for at, t, _ in blocks if inside[at])].add(html)
    slow = sorted((h, len(at)) for (h, _, _), at in seen.items() if len(at) >= max(hc.REPEATED, hc.SHARE * len(pages[h])))
    df = hc.with_host(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["__host"]: len(r["__boxes"] or ()) for r in hc.host_paths(spark, df).collect()}
    assert {h: n for h, n in got.items() if n} == dict(Counter(h for h, _ in slow)) == {"hot.example": 1}
    assert set(got) == set(pages)


def test_nesting_takes_linear_time():
    import time
    for shell in ("<div>", "<div class=a>", "<div class=comments>", "<section id=related><p>x</p>", "<b role=note>"):
        start = time.process_time()
        hc.main_text(shell * 20_000 + "text" + "</i>" * 20_000 + "</div>" * 20_000, [""])
        assert time.process_time() - start < 8, shell
    assert hc.main_text("<div>" * 20_000 + "text", []) == "text"
    start = time.process_time()
    deep = f"<p>{LONG}</p>" + "<section><p>x</p>" * 10_000
    assert hc.main_text(deep, [], None, frozenset({(0, 0)})).startswith(LONG.strip())
    assert time.process_time() - start < 8
