"""Vector and page operators against brute force, and the pipeline end to end."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.graph import components
from strata.llm.main_text import extract, learn, main_text
from strata.llm.top_k import top_k
from strata.llm.vector_links import links, vector_groups

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, n long"


def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8))
    x = [centres[i % 30] + rng.normal(size=8) * 0.25 for i in range(200)]
    out = [(i, [float(v) for v in np.float32(a)], i % 3, 1, 1) for i, a in enumerate(x)]
    out += [(500 + i, out[0][1], 0, 1, 1) for i in range(20)]
    bad = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, []]
    out += [(600 + 20 * i, b, 0, 1, 1) for i, b in enumerate(bad)]
    return out + [(800, out[0][1], None, 1, 1)]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


def test_vector_groups_match_brute_force(spark, vectors):
    got = {r.vec_id: r for r in vector_groups(vectors).collect()}
    sound = [r for r in rows() if r[2] is not None and r[1] and None not in r[1]
             and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([r[1] for r in sound], np.float32).astype(float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    label = np.array([r[2] for r in sound])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    root = np.array([r[0] for r in sound])
    for _ in sound:
        root = np.array([min([root[i], *root[near[i]]]) for i in range(len(sound))])
    for r, n, c in zip(sound, near.sum(1), root, strict=True):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (n, c, r[0] == c)
    for i in set(got) - {r[0] for r in sound}:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vector_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_nodes_and_blocks_lose_no_link():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(1, 6)) + rng.normal(size=(120, 6)) * s for s in (0.01, 0.2, 3)])
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    weights = rng.integers(1, 4, len(x))
    total, _ = links(x, None, weights, 0.93)
    assert (total == near @ weights).all()
    total, _ = links(x[:150], x[150:], weights, 0.93)
    across = near.copy()
    across[:150, :150] = across[150:, 150:] = False
    assert (total == across @ weights).all()


def test_top_k_matches_brute_force(spark, vectors):
    got: dict = {}
    for r in top_k(vectors, F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    sound = [r for r in rows() if r[1] and None not in r[1] and np.isfinite(r[1]).all()]
    q = np.floor(64 * np.array([r[1] for r in sound], np.float32).astype(float))
    ids = np.array([r[0] for r in sound])
    for i in np.flatnonzero(ids % 20 == 0):
        score = q @ q[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        assert sorted(got.pop(ids[i])) == [(k + 1, ids[j], int(score[j])) for k, j in enumerate(order)]
    assert set(got) <= {600 + 20 * 5}  # the empty vector
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in range(200, 300))
    assert got[301] == 300 and 5 not in got


PAGE = """<!DOCTYPE html><html><head><title>Title</title><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a>About us</a></li></ul></nav><div class="cookie-notice">We use cookies here</div>
<article><header><h1>The  heading</h1></header><p>First &amp; <b>bold</b>\n text of the page<br>goes on.
<p>Unclosed second one<div class="ad">Buy this now</div><p>Third paragraph here.</p><form><label>Your mail</label></form>
<aside>Related things</aside></article><section id="comments"><p>I liked this very much indeed thank you</p></section>
<footer>&copy; someone</footer></body></html>"""


def test_main_text():
    weights = learn([PAGE] * 3)
    want = "The heading\n\nFirst & bold text of the page goes on.\n\nUnclosed second one\n\nThird paragraph here."
    assert extract(PAGE, weights) == want
    assert extract(PAGE.replace("article>", "div>"), weights).startswith("First & bold text")
    for page, text in [(None, ""), ("", ""), ("plain words", "plain words"), ("<p>a", "a"), ("<nav>x</nav>", ""),
                       ("<script>x", ""), ("<!-- x", ""), ("&lt;&#39;", "<'")]:
        assert extract(page, weights) == text
    assert extract("<p>" + "word " * 200_000, weights) == " ".join(["word"] * 200_000)


def test_names_do_not_drop_the_article():
    weights = learn([PAGE] * 3)
    want = extract(PAGE, weights)
    for old, new in [("<body>", '<body class="no-sidebar">'), ("<body>", '<body class="comments-open">'),
                     ("<body>", '<body id="search"><form action="/">'), ("<article>", '<article class="post has-comments">'),
                     ("<article>", '<div class="content with-sidebar"><article>'), ("<article>", '<main class="share"><article>'),
                     ("<article>", '<article><div class="sidebar">'), ("<p>First", '<p class="no-ads">First')]:
        assert old in PAGE and extract(PAGE.replace(old, new), weights) == want
    words = "Some words of the only text here. " * 5
    for page in ('<body class="with-sidebar">%s</body>', '<div class="content no-sidebar">%s</div>', "<form>%s</form>",
                 '<main><div class="widget">%s</div></main>'):
        got = extract(page % f"<p>{words}</p><div class='ad'>Buy now</div>", weights)
        assert got == words.strip()
    many = PAGE.replace("I liked this", "I liked this " * 50)  # long comments still are none of the article
    assert extract(many, weights) == want


def test_pages_keep_their_columns(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in main_text(pages, learn([PAGE])).collect()}
    assert got[1].url == "u" and got[1].text.startswith("The heading") and got[2].text == ""
    assert main_text(pages.where("false"), {}).collect() == []


def test_pipeline_keeps_clean_documents(spark, sf_small):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "repeated passages", "packing"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_small).cache()
        assert kept.columns == docs.columns
        assert kept.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
        docs = kept
    packed = corpus_pipeline.packed(spark, docs, sf_small)
    assert packed.select("doc_id").distinct().count() == docs.count() > 150


def test_pipeline_leaves_no_passage_of_51_words_twice(spark):
    import random
    import corpus_pipeline
    rng = random.Random(3)

    def prose(n, stops):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) + rng.choice(stops) for _ in range(n))
    shared = [prose(60, ["", "", "", "", "."]), prose(60, ["!!"]), prose(60, [""])]
    rows = [(i, " ".join([prose(40, ["", "", "."]), shared[i % 3], prose(40, ["", "", "."])]), "en", "web", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text.split() for r in corpus_pipeline.distinct_passages(spark, docs, "").collect()}
    seen = [tuple(w[k:k + 51]) for w in kept.values() for k in range(len(w) - 50)]
    assert len(kept) == 12 and len(seen) == len(set(seen))
    assert [len(kept[i]) for i in range(12)] == [140] * 3 + [80] * 9


@pytest.mark.parametrize("times", [0.5, 1, 2, 5, 40])
@pytest.mark.parametrize("page", [
    "<article><h1>Title</h1>{text}<section class='comments'>{more}</section></article>",
    "<article><h1>Title</h1>{text}</article><div id='comments'>{more}</div>",
    "<main><div>{text}</div><div class='sidebar'>{more}</div></main>",
    "<div class='post'>{text}</div><div class='comments'>{more}</div>",
    "<article>{text}<div class='ad-banner'>{more}</div></article>",
    "<main class='no-sidebar'><article class='has-comments'>{text}<ul class='reader-replies'><li>{more}</li></ul></article></main>",
])
def test_readers_and_sidebars_stay_out_however_long(page, times):
    text = "".join(f"<p>{' '.join(f'word{i}{k}' for k in range(20))}.</p>" for i in range(4))
    more = "".join(f"<p>{' '.join(f'noise{i}{k}' for k in range(10))}</p>" for i in range(max(1, int(8 * times))))
    got = extract(page.format(text=text, more=more), {"p": -0.1, "/p": -0.1, "div": -1.0, "/div": -1.0})
    assert "noise" not in got and got.count("word") == 80


def test_a_named_part_is_the_article_where_nothing_else_is(spark):
    text = " ".join(f"word{k}" for k in range(60))
    for page in ("<article><h1>Some title of the article here</h1><div class='widget'><p>{}</p></div></article>",
                 "<form><div><p>{}</p></div></form>", "<body class='comments-open sidebar'><p>{}</p></body>"):
        assert extract(page.format(text), {}).count("word") == 60
    assert "word" not in extract(f"<article><h1>Title</h1><div class='comments'><p>{text}</p></div></article>", {})


def test_best_region_by_comparing_all_runs():
    from strata.llm.main_text import best_region
    rng = np.random.default_rng(6)
    for n in [0, 1, 2, 3, 8, 20, 40] * 12:
        values = [float(v) for v in rng.integers(-6, 4, n)]
        runs = [(sum(values[i:j + 1]), -j, i) for i in range(n) for j in range(i, n)]
        best = max((r[0] for r in runs), default=0)
        got = best_region(values)
        if best <= 0:
            assert got is None
        else:
            assert sum(values[got[0]:got[1] + 1]) == best
            assert got[1] == min(-r[1] for r in runs if r[0] == best)


def test_weights_come_from_distinct_pages_and_an_empty_table_has_none(spark):
    from strata.llm import main_text as M
    pages = [f"<div><nav>menu</nav><article><p>text {i}</p></article></div>" for i in range(5)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages * 3)] + [(99, None), (100, "<p>no article</p>")], "page_id long, html string")
    assert M.fit(df) == learn(sorted(pages)) and M.fit(df.limit(0)) == {}
    assert len(M.fit(df, sample=2)) > 0
