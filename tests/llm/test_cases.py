"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from ratewell.llm import bpe, components, counts, decontaminate, exact, html, lines, near, quality, queries, toxicity, warc, words

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
PASSAGE = " ".join(f"common{i}" for i in range(60))
TEXTS = [
    (1, "One two three four five six seven eight nine ten eleven."), (2, "ONE two three four five six seven eight nine ten eleven."),
    (2, "ONE two three four five six seven eight nine ten eleven."), (3, None), (4, ""), (None, "one two three four five six seven eight nine ten eleven."), (None, None),
    (5, " \t\r\n\v\f "), (6, "Été ÇA \U0001f600 " * 5), (7, LONG), (8, LONG + " end"), (9, "ab"), (10, f"first of all\n{PASSAGE}\nlast"),
    (11, f"other\n{PASSAGE}"), (12, f"{PASSAGE}\n{PASSAGE}\n\nshort"), (13, "z" * 70_000), (9, "ab cd"),
]
EXTRA = "id bigint, key string, n int, comp int, component string, digest string, word string, words int, pos int, r int, u int, v int, shard int, x double"


@pytest.fixture(scope="module")
def messy(spark):
    """Rows of all kinds with columns named like those that the operators use inside."""
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(3)
    return df.selectExpr("*", *[f"cast(7 as {c.split()[1]}) as `{c.split()[0]}`" for c in EXTRA.split(", ")])


@pytest.fixture(scope="module")
def nothing(messy):
    return messy.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (6, 0, 1), (7, 1, 0), (7, None, None), (None, 1, 1), (8, 0, 1), (99, 1, 1), (12, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_words_are_those_of_a_plain_split():
    texts = [t for _, t in TEXTS] + ["a", "", None, "é", "x y", "A-b_c9\x7fd"]
    for inside, split in ((words.SPACED, lambda t: brute.lower(t).encode().split()), (words.PLAIN, lambda t: [w.encode() for w in brute.PLAIN.findall(brute.lower(t))])):
        names, back = {}, {}
        for first, last, data, at in words.chunks(pa.array(texts)):
            hashed, start = words.word_hashes(data, at, inside)
            for i in range(last - first):
                own, want = hashed[start[i] : start[i + 1]].tolist(), split(texts[first + i])
                assert len(own) == len(want)
                for h, w in zip(own, want, strict=True):
                    assert names.setdefault(h, w) == w and back.setdefault(w, h) == h


def test_a_word_longer_than_a_tile_is_hashed_like_others(monkeypatch):
    texts = pa.array(["abcdefghij klm abcdefghij", "no abcdefghij"])
    whole = [h.tolist() for _, _, d, at in words.chunks(texts) for h in [words.word_hashes(d, at, words.SPACED)[0]]]
    monkeypatch.setattr(words, "TILE", 4)
    assert [h.tolist() for _, _, d, at in words.chunks(texts) for h in [words.word_hashes(d, at, words.SPACED)[0]]] == whole


# ---- 1


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("just words", "just words"), ("<p>a &amp; b&nbsp;c&#x41;<br>d<p>e", "a & b cA d\ne"),
        ("<script>var a='<p>no</p>'</script><p>yes, this is it", "yes, this is it"), ("<p>cut <a href='x", "cut"), ("<p>a<!-- never closed <p>b", "a"),
        ("<ul class='main-menu'><li><a href=1>x</a></ul><p>kept text</p>", "kept text"), ("<article><p>one<b>two<p>three</article><footer>no</footer>", "onetwo\nthree"),
        ("<div><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Body.</p></article></div>", "Title\nBody."),
        ("<main class='has-sidebar'><p>kept</p><aside>no</aside><form><p>no</p></form></main>", "kept"), ("<p>a<p hidden>b<p style='display: none'>c<p>d", "a\nd"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<div>" * 5000 + "deep", "deep"), ("<p title='a > b'>x < y</p>", "x < y"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_the_best_container_wins_over_boilerplate():
    story = "".join(f"<p>Sentence {i}, with some commas, and quite a few words to be scored by.</p>" for i in range(6))
    page = f"""<body><div id=top class="site-header"><a href=1>Home</a> <a href=2>News</a></div>
        <div class="layout"><div class="sidebar"><p>Subscribe, now, and, here, it is, very, very long, and it has many, many commas, indeed.</p></div>
        <div class="post-text"><h2>Title</h2>{story}<div class="share">Share it</div></div>
        <section id="comments"><p>A reader, who writes, a lot, of long, and winding, sentences, about this, and that.</p></section></div>
        <div class="cookie-notice">We use cookies, and more.</div><div class=links><a href=3>One</a><a href=4>Two</a><a href=5>Three</a></div></body>"""
    assert html.main_text(page).split("\n") == ["Title", *[f"Sentence {i}, with some commas, and quite a few words to be scored by." for i in range(6)]]


def test_main_is_kept_whole_without_an_article():
    long = "".join(f"<p>Sentence {i}, with some commas, and quite a few words to be scored by.</p>" for i in range(10))
    page = f"<body><nav><a href=1>Home</a></nav><main><section>{long}</section><section><p>One more paragraph, short, but part of the text.</p></section></main></body>"
    assert html.main_text(page).split("\n")[-1] == "One more paragraph, short, but part of the text."


@pytest.mark.parametrize("tag", ["svg", "math", "template", "noscript"])
def test_an_unclosed_element_is_empty(tag):
    assert html.main_text(f"<article><p>before</p><{tag}><p>after</p></article>") == "before\nafter"


STORY = [f"Sentence {i}, with some commas, and quite a few words to be scored by." for i in range(6)]
PARTS = "".join(f"<p>{x}</p>" for x in STORY)


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="search">{}</h2>', '<section id="notice-period"><p>{}</p></section>', '<p class="share-price">{}</p>', '<div class="social-history">{}</div>',
        '<h2 id="related-work">{}</h2>', '<section id="modal-verbs"><h3>{}</h3></section>', '<h2 id="comments">{}</h2>', '<p class="ad-hoc">{}</p>',
    ],
)
def test_a_name_in_part_or_an_id_takes_nothing_from_an_article(part):
    assert html.main_text(f"<body><article>{PARTS}{part.format('A word of it')}</article></body>").split("\n") == [*STORY, "A word of it"]


@pytest.mark.parametrize(
    "part",
    [
        '<div class="share">{}</div>', '<div class="ad">{}</div>', '<div class="box cookie-banner">{}</div>', '<section class="comments"><p>{}</p></section>',
        '<div class="userComments"><p>{}</p></div>', '<form><p>{}</p></form>', '<div class="newsletter-signup">{}</div>', '<p class="notice">{}</p>',
        '<ul class="share-price-links"><li><a href=1>{}</a><li><a href=2>Other</a></ul>', '<div class="related_posts">{}</div>', '<aside>{}</aside>', '<div id="comments"><p>{}</p></div>',
    ],
)
def test_a_whole_name_takes_an_element_out(part):
    assert html.main_text(f"<body><article>{PARTS}{part.format('Five words, no article text.')}</article></body>").split("\n") == STORY


def test_pages_without_article_or_main():
    lead = "A lead paragraph in a small part of its own, which says in a sentence what the page is about."
    menu = "<ul><li><a href=1>Home</a><li><a href=2>News</a></ul>"
    assert html.main_text(f"<body>{menu}<div><div>{lead}</div><div>{PARTS}</div><div><a href=3>More of the same kind of text, all of it inside a link to somewhere.</a></div></div></body>").split("\n") == [lead, *STORY]
    page = f"<body><form action=x>{menu}<div>{PARTS}<input name=q><button>Go</button></div></form></body>"
    assert html.main_text(page).split("\n") == STORY
    assert html.main_text(f"<body><div class='modal'><p>{lead}</p></div></body>") == lead
    assert html.main_text(f"<body><div class='comments'><p>{lead}</p></div></body>") == ""
    assert html.main_text(f"<body><div>{PARTS}</div><form><p>{lead}</p><input></form></body>").split("\n") == STORY


def test_articles_side_by_side():
    teaser = "<article class=card><h3>Other</h3><p>Some words on another story, which is told elsewhere.</p></article>"
    page = f"<body><main><article>{PARTS * 2}</article>{teaser}<article>{PARTS}{PARTS}</article></main></body>"
    assert html.main_text(page).split("\n") == STORY * 4


def test_pages(spark, nothing):
    pages = spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None)], "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    assert sorted(map(tuple, html.extract(pages).collect()), key=str) == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert html.extract(pages.where("false")).collect() == []


# ---- 2


def test_contamination(spark, messy, nothing):
    items = spark.createDataFrame(
        [(1, "five six SEVEN"), (1, "five six SEVEN"), (2, None), (3, "?!"), (4, "common1 common2"), (None, "ab"), (5, PASSAGE), (6, "no such words")], "item_id bigint, text string"
    )
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, sum(s.b - s.a for s in r.spans), [i for i in r["items"]]) for r in decontaminate.contamination(messy, items).collect())
    plain = brute.contaminated(enumerate(t for _, t in TEXTS), [(i, t) for i, t in map(tuple, items.collect()) if i is not None] + [(0, "ab")])
    want = sorted((d is None, d or 0, *plain[k][:2], [None if i == 0 else i for i in plain[k][2]]) for k, (d, _) in enumerate(TEXTS))
    assert got == want
    for docs, bench in ((messy, items.where("false")), (nothing, items)):
        assert all(r["items"] == [] and r.spans == [] for r in decontaminate.contamination(docs, bench).collect())
    kept = decontaminate.clean(messy, items)
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()} == {None, 3, 4, 5, 6, 7, 8, 13}


def test_blocks_of_items_give_what_one_block_gives(spark, messy, monkeypatch):
    items = spark.createDataFrame([(i, f"common{i} common{i + 1} common{i + 2}") for i in range(40)], "item_id bigint, text string")
    whole = sorted(map(str, decontaminate.contamination(messy, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 25)
    assert sorted(map(str, decontaminate.contamination(messy, items).collect())) == whole


def test_one_index_is_searched_by_two_benchmarks(spark, messy):
    index = decontaminate.written(decontaminate.build_index(messy), "postings")
    first = spark.createDataFrame([(i, f"common{i} common{i + 1} common{i + 2}") for i in range(5)], "item_id bigint, text string")
    second = spark.createDataFrame([("a", "one two three four five six seven eight nine ten eleven"), ("b", "w3x3 w4x4 w5x5")], "name string, passage string")
    for items, names in ((first, ("item_id", "text")), (second, ("name", "passage"))):
        got = sorted(map(str, decontaminate.search(index, items, *names).collect()))
        assert got == sorted(map(str, decontaminate.contamination(messy, items, *names).collect())) and any("Row(a=" in row for row in got)


def test_kept_columns_of_inner_names(spark):
    docs = spark.createDataFrame([(1, "alpha beta", 5, "x", 2)], "doc_id bigint, text string, terms int, counts string, positions int")
    items = spark.createDataFrame([(1, "beta")], "item_id bigint, text string")
    (row,) = decontaminate.contamination(docs, items, keep=("doc_id", "terms", "counts", "positions")).collect()
    assert (row.doc_id, row.terms, row.counts, row.positions, row.n_words, row["items"]) == (1, 5, "x", 2, 2, [1])
    with pytest.raises(ValueError, match="rename them"):
        decontaminate.contamination(docs.withColumnRenamed("terms", "Spans"), items, keep=("doc_id", "Spans"))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 9 + "beta gamma"), (4, "alpha beta")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    near_by = {r.doc_id for r in decontaminate.contamination(docs, items, distance=5).collect() if r["items"]}
    exactly = {r.doc_id for r in decontaminate.contamination(docs, items).collect() if r["items"]}
    assert near_by == {1, 2} and exactly == set()


def test_proximity_starts_from_the_rarest_term_at_every_size(spark, monkeypatch):
    near = [(i, f"a{i} x x x b{i} x x x c{i}") for i in range(8)]
    docs = spark.createDataFrame(near + [(10 + i, f"a{i} c{i}") for i in range(8)], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(8)], "item_id bigint, text string")
    for words_ in (1000, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words_)
        got = {r.doc_id: ([(s.a, s.b) for s in r.spans], r["items"]) for r in decontaminate.contamination(docs, items, distance=5).collect()}
        assert got == {i: ([(4, 5)], [i]) for i in range(8)} | {10 + i: ([], []) for i in range(8)}


def test_a_frequent_anchor_meets_its_windows_in_bounded_steps(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_POSITIONS", 800)
    seen, slot = [], decontaminate.Shard.slot
    monkeypatch.setattr(decontaminate.Shard, "slot", lambda self, doc, term: seen.append(len(doc)) or slot(self, doc, term))
    shard = decontaminate.Shard(np.array([1, 2]), np.array([0, 2]), np.array([300, 300]), np.r_[0:600:2, 1:600:2])
    items = [(k, np.array([1, 2 if k == 0 else 10 + k]).view(np.uint64)) for k in range(50)]
    passages = decontaminate.Passages(items, {1: 0, **{10 + k: 1 for k in range(50)}, 2: 1}, 2)
    doc, window, at = shard.matches(passages, None)
    assert max(seen) <= 100 and sorted(at.tolist()) == list(range(0, 600, 2)) and set(window.tolist()) == {0}


# ---- 3


def test_line_runs(spark, messy, nothing):
    out = lines.deduplicate(messy)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert set(messy.columns) <= set(out.columns) and len(got) == len(TEXTS)
    left = {d: t for d, t in got if d is not None}
    assert left[10] == dict(TEXTS)[10] and left[11] == "other" and left[12] == "\nshort" and left[3] is None and left[4] == "" and left[7] == LONG
    assert lines.deduplicate(nothing).collect() == [] and lines.deduplicate(messy, min_words=10**6).where("size(gone) > 0").count() == 0


def test_line_runs_of_several_lines(spark):
    rng = np.random.default_rng(3)
    base = [f"{'w ' * int(rng.integers(0, 6))}l{rng.integers(12)}" for _ in range(400)]
    texts = {d: "\n".join(base[a : a + int(n)]) for d, (a, n) in enumerate(zip(rng.integers(0, 380, 60), rng.integers(1, 40, 60), strict=True))}
    for least in (1, 7, 30):
        got = {r.doc_id: r.text for r in lines.deduplicate(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), min_words=least).collect()}
        assert got == brute.without_later_runs(texts, least)


def test_words_of_lines_are_runs_between_white_space(spark):
    tabs, blanks = "\t".join(f"t{i}" for i in range(61)), "\n" * 45 + " ".join(f"b{i}" for i in range(10))
    columns = "\n".join("  ".join(f"c{i}_{j}" for j in range(4)) + "\n" for i in range(14))
    texts = {1: f"a\n{tabs}\nb", 2: f"c\n{tabs}", 3: f"d\n{blanks}", 4: f"e\n{blanks}", 5: f"f\n\n\n{columns}\n\ng", 6: f"h\n\n\n{columns}\n\n\ni"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in lines.deduplicate(df).collect()}
    assert got == {**texts, 2: "c", 6: "h\n\ni"} == brute.without_later_runs(texts, 50)


def test_line_runs_with_lines_without_words(spark):
    rng = np.random.default_rng(5)
    base = ["\t ".join(f"w{x}" for x in rng.integers(0, 3, int(rng.integers(0, 4)))) for _ in range(300)]
    texts = {d: "\n".join(base[a : a + int(n)]) for d, (a, n) in enumerate(zip(rng.integers(0, 280, 50), rng.integers(1, 40, 50), strict=True))}
    for least in (1, 2, 5, 12):
        got = {r.doc_id: r.text for r in lines.deduplicate(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), min_words=least).collect()}
        assert got == brute.without_later_runs(texts, least), least


def test_a_column_of_the_name_of_the_runs_stays(spark):
    df = spark.createDataFrame([(1, PASSAGE, 5), (2, PASSAGE, 6)], "doc_id bigint, text string, Gone int")
    out = lines.deduplicate(df)
    assert out.columns == ["doc_id", "text", "Gone", "gone_1"]
    assert [(r.doc_id, r.text, r.Gone, len(r.gone_1)) for r in out.orderBy("doc_id").collect()] == [(1, PASSAGE, 5, 0), (2, "", 6, 1)]


# ---- 4 and 5


def test_bpe_round_trip(messy, nothing):
    encoded = bpe.encode(messy, *queries.vocabulary(), keep=("doc_id", "text", "n"))
    got = bpe.decode(encoded, *queries.vocabulary(), keep=("doc_id", "text", "n_tokens", "ids")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, TEXTS))
    assert all(bytes(r.decoded) == (r.text or "").encode() and len(r.ids) == 4 * r.n_tokens for r in got)
    assert bpe.decode(bpe.encode(nothing, *queries.vocabulary()), *queries.vocabulary()).collect() == []


def test_cut_texts_have_the_ids_of_whole_ones():
    path, pattern = queries.vocabulary()
    with open(path, "rb") as f:
        enc = bpe.encoder(f.read(), pattern)
    rng = np.random.default_rng(5)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "12", "é", " ", " ", "...", "\x1c", "\x85", "日本", "\r\n"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, 60))
        want = b"".join(i.to_bytes(4, "little") for i in enc.encode_ordinary(text))
        assert bpe.token_ids(enc, text, 7) == want and "".join(bpe.pieces(text, 7)) == text
        assert bpe.raw_bytes(enc, want) == text.encode()
    assert bpe.raw_bytes(enc, (255).to_bytes(4, "little") * 3) == enc.decode_bytes([255] * 3)


def test_counts_follow_random_edits():
    path, pattern = queries.vocabulary()
    with open(path, "rb") as f:
        enc = bpe.encoder(f.read(), pattern)
    rng = np.random.default_rng(6)
    pieces = ["a", "B", " ", "  ", "\n", "'s", "12", "é", "...", "", "word " * 500, " x", "y "]
    for text in ["", " ", "ab", "word " * 400, "z" * 3000, "\n".join(["one two, three"] * 90)]:
        for _ in range(25):
            counted = counts.CountedText(enc, list(bpe.pieces(text, counts.LEAF)))
            edits = [(int(a), int(a) + int(rng.choice([0, 1, 3, 800, -2])), "".join(rng.choice(pieces, int(rng.integers(0, 4))))) for a in rng.integers(0, len(text) + 3, 4)]
            counts.edited(counted, edits)
            want, limit = text, None
            for a, b, new in sorted(edits, key=lambda e: e[:2], reverse=True):
                a = min(a, len(text))
                b = max(a, min(b, len(text), *([] if limit is None else [limit])))
                want, limit = want[:a] + new + want[b:], a
            assert counted.text() == want and counted.tokens.total() == len(enc.encode_ordinary(want)) and counted.chars.total() == len(want)


def test_trees_are_edited_by_key(spark, messy, nothing):
    trees = counts.build(messy, *queries.vocabulary())
    edits = spark.createDataFrame([(1, 0, 3, "Two"), (4, 0, 9, "new"), (3, 5, 2, "x"), (7, 10, 20, None), (None, 0, 1, "?"), (77, 0, 1, "?")], 'doc_id bigint, start bigint, "end" bigint, replacement string'.replace('"', "`"))
    out = counts.apply(counts.with_edits(trees, edits), *queries.vocabulary())
    got = [(r.doc_id, r.text, r.n_edits) for r in out.collect()]
    by_id = {d: t for d, t, _ in got}
    assert len(got) == len(TEXTS) and by_id[1].startswith("Two two") and by_id[4] == "new" and by_id[3] == "x" and by_id[7] == LONG[:10] + LONG[20:]
    small = {r.doc_id: r.n_chars_encoded for r in out.collect()}
    assert 0 < small[7] < 4 * counts.LEAF
    again = counts.apply(out.drop("n_edits").withColumn("edits", counts.F.lit(None).cast(counts.EDITS)), *queries.vocabulary())
    assert sorted((r.n_tokens, r.n_tokens_before) for r in again.collect()) == sorted((r.n_tokens, r.n_tokens) for r in out.collect())
    assert counts.build(nothing, *queries.vocabulary()).collect() == []


# ---- 6


def test_exact_duplicates(messy, nothing):
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact.mark(messy).collect())
    groups = {}
    for d, t in TEXTS:
        groups.setdefault(brute.lower(t), []).append(d)
    want = []
    for members in groups.values():
        keep = max((d for d in members if d is not None), default=None)
        want += [(str(d), str(keep), len(members), d == keep) for d in members]
    assert got == sorted(want)
    assert sorted(map(str, exact.mark(messy, candidates=1).collect())) == sorted(map(str, exact.mark(messy).collect()))
    assert exact.mark(nothing).collect() == [] and exact.deduplicate(messy).columns == messy.columns


def test_a_group_of_a_third_of_all_rows(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'SAME text', concat('own ', id)) as text")
    got = exact.mark(df)
    assert {tuple(r) for r in got.where("group_size > 1").select("keep_id", "group_size").distinct().collect()} == {(2997, 1000)}
    assert got.where("kept").count() == 2001 and exact.deduplicate(df).count() == 2001


# ---- 7 and 9


def test_toxicity(messy, nothing, labels):
    weights = toxicity.fit(messy, labels)
    got = toxicity.score(messy, weights).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert not toxicity.fit(messy, labels.where("false")).any() and not toxicity.fit(nothing, labels).any()
    assert toxicity.score(nothing, weights).collect() == []


def test_toxic_words_get_weight(spark):
    rows = [(i, " ".join([f"w{i}", f"v{i % 7}", "bad" if i % 4 == 0 else "fine", "plain"])) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert min(s for d, s in scores.items() if d % 4 == 0) > 0.5 > max(s for d, s in scores.items() if d % 4)


def test_ftrl_equals_a_plain_loop():
    """Per-coordinate rates and L1 worked out with a dictionary and one coordinate at a time."""
    rng = np.random.default_rng(7)
    rows = [(np.unique(rng.integers(0, 60, rng.integers(0, 12))).astype(np.int32), float(rng.integers(0, 2))) for _ in range(400)]
    model, z, n = toxicity.Ftrl(), {}, {}

    def weight(j):
        if abs(z.get(j, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1 if z[j] > 0 else -1
        return -(z[j] - sign * toxicity.L1) / ((toxicity.BETA + n[j] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for at, label in rows * 3:
        model.learn(at, label)
        own = sorted({0, *at.tolist()})
        before = {j: weight(j) for j in own}
        gradient = 1 / (1 + math.exp(-sum(before.values()))) - label
        for j in own:
            rate = ((n.get(j, 0.0) + gradient**2) ** 0.5 - n.get(j, 0.0) ** 0.5) / toxicity.ALPHA
            z[j] = z.get(j, 0.0) + gradient - rate * before[j]
            n[j] = n.get(j, 0.0) + gradient**2
    got = toxicity.weights(model.z[:60], model.n[:60])
    assert np.allclose(got, [weight(j) for j in range(60)]) and 0 < np.count_nonzero(got) < 60


def test_a_labelled_id_on_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    rows = [(i, " ".join([f"w{i}", "bad" if i % 4 == 0 else "fine", "plain"])) for i in range(400)]
    labels = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic")
    once = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), labels)
    copied = spark.createDataFrame(rows + rows[5:6] * 1000, "doc_id bigint, text string").coalesce(1)
    assert np.array_equal(once, toxicity.fit(copied, labels)) and once.any()
    texts = spark.createDataFrame(rows + [(5, f"other {i}") for i in range(900)], "doc_id bigint, text string")
    assert toxicity.fit(texts, labels).any()


def test_densities_equal_plain_covariances():
    """Scores from cached factors against log densities by determinant and inverse, with the same shrinkage."""
    rng, d = np.random.default_rng(9), len(quality.STATISTICS)
    x = [rng.normal(size=(80 + 40 * c, d)) @ rng.normal(size=(d, d)) + c for c in (0, 1)]
    total = np.stack([np.concatenate(([len(y)], y.sum(axis=0), (y.T @ y).ravel())) for y in x])
    both = np.concatenate(x)
    centre, scale = both.mean(axis=0), both.std(axis=0)
    own = [(y - centre) / scale for y in x]
    cov = [np.cov(y.T, bias=True) for y in own]
    share = np.array([len(y) for y in x]) / len(both)
    pooled = share[0] * cov[0] + share[1] * cov[1]
    new = (rng.normal(size=(50, d)) * both.std(axis=0)) / scale
    logs = []
    for c in (0, 1):
        s = (1 - quality.TO_POOLED) * cov[c] + quality.TO_POOLED * pooled
        s = (1 - quality.TO_DIAGONAL) * s + quality.TO_DIAGONAL * np.diag(np.diag(s)) + quality.FLOOR * np.eye(d)
        away = new - own[c].mean(axis=0)
        logs.append(np.log(share[c]) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away))
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -35, 35)))
    assert np.allclose(quality.discriminant(total).score(new * scale + centre), want, atol=1e-8)


def test_quality(messy, nothing, labels):
    got = quality.scored(messy, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.scored(messy, labels.where("false")).collect()} == {0.5}
    assert {r.score for r in quality.scored(messy, labels.where("quality = 1")).collect()} == {1.0}
    assert quality.scored(nothing, labels).collect() == []
    kept = quality.keep_good(messy, labels.where("quality = 1"), 0.3)
    assert kept.columns == messy.columns and kept.count() == len(TEXTS)
    assert quality.keep_good(nothing, labels, 0.3).collect() == []
    clashing = messy.withColumnRenamed("x", "statistics")
    assert quality.keep_good(clashing, labels.where("quality = 1"), 0.3).columns == clashing.columns


def test_kept_rows_are_those_with_the_score(messy, labels):
    """The filter decides as the scores of `scored` do, row by row, repeated ids and rows without id included."""
    ids = messy.withColumn("doc_id", F.monotonically_increasing_id())
    known = ids.select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias("quality"))
    score = {r.id: r.score for r in quality.scored(ids, known).collect()}
    middle = sorted(score.values())[len(score) // 2]
    kept = {r.doc_id for r in quality.keep_good(ids, known, middle).select("doc_id").collect()}
    assert kept == {d for d, v in score.items() if v >= middle} and 0 < len(kept) < len(score)


def test_statistics_do_not_depend_on_the_batch():
    texts = pa.array([t for _, t in TEXTS])
    whole = quality.statistics(texts)
    alone = np.concatenate([quality.statistics(texts.slice(i, 1)) for i in range(len(texts))])
    assert np.allclose(whole, alone) and np.isfinite(whole).all()


# ---- 8


def test_near_duplicates(messy, nothing):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.mark(messy, size=3, num=85, den=100).collect()), key=str)
    plain = brute.near(enumerate(t for _, t in TEXTS), 3, 85, 100)
    members = {}
    for k, (d, _) in enumerate(TEXTS):
        if d is not None:
            members.setdefault(d, set()).add(k)
    links = [(a, b) for a in members for b in members for i in members[a] for j in members[b] if plain[i][1] == plain[j][1]]
    root = brute.roots(members, links)
    want = [(d, plain[k][0], root.get(d), d == root.get(d)) for k, (d, _) in enumerate(TEXTS)]
    assert got == sorted(want, key=str)
    assert near.mark(nothing).collect() == [] and near.deduplicate(messy).columns == messy.columns


def test_a_crowd_of_variants(spark):
    """Variants of one text, only a part of which are linked, so buckets stay open and are compared on full sets."""
    rng = np.random.default_rng(8)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for d in range(500):
        own = list(base)
        for i in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            own[i] = f"e{rng.integers(4)}"
        texts[d] = " ".join(own)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.mark(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), size=3, num=85, den=100).collect()}
    want = brute.near(texts.items(), 3, 85, 100)
    assert got == want and 1 < len({c for _, c in want.values()}) < 500


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)] + [(2000, 2000 + i) for i in range(1, 300)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    nodes = {x for pair in chain if None not in pair for x in pair}
    assert got == brute.roots(nodes, [p for p in chain if None not in p])
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


# ---- 10


@pytest.mark.parametrize("version", [1, 2])
def test_archives(spark, version, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 300)
    pages = [(3, "http://a b/\n", "<p>x"), (1, None, "<p>x"), (1, "http://c", "<p>x"), (2, "u", None), (4, "u", ""), (None, "v", "<p>x"), (5, "w", "WARC/1.1\r\n\r\n12\n"), (6, "é", "ü" * 900)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'k' as key", "1 as length", "'d' as digest")
    path = warc.convert(spark, warc.to_arc(df, version=version))
    got = [(r.key, r.payload_bytes, r.record_type, r.refers_to_key) for r in warc.read(spark, path).collect()]
    want = [("3", 4, "revisit", "1"), ("1", 4, "response", None), ("1", 4, "response", None), ("2", 0, "response", None), ("4", 0, "revisit", "2"), (None, 4, "response", None), ("5", 15, "response", None), ("6", 1800, "response", None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    stored = {r.key: bytes(r.payload).decode() for r in warc.read(spark, path, payloads=True).collect() if r.payload is not None}
    assert stored["5"] == pages[6][2] and stored["6"] == pages[7][2]
    whole = warc.read(spark, warc.convert(spark, warc.to_arc(df, version=version), least_bytes=1))
    assert {r.key for r in whole.where("record_type = 'revisit'").collect()} == {"3"}
    assert warc.read(spark, warc.convert(spark, warc.to_arc(df.where("false"), version=version))).collect() == []


def test_plain_archive_of_version_one():
    block = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\nwith lines"
    data = b"filedesc://x 0.0.0.0 1999 text/plain 15\n1 0 someone\nURL\n\n" + b"http://h/ 1.2.3.4 19990203 text/html %d\n" % len(block) + block + b"\n"
    (record,) = warc.arc_records(data)
    assert warc.split_http(record["block"])[1] == b"body\nwith lines" and warc.iso_date(record["date"]) == "1999-02-03T00:00:00Z"
    assert warc.sha1(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and hashlib.sha1(b"").hexdigest().startswith("da39")
    with pytest.raises(ValueError, match="declares"):
        list(warc.arc_records(data[:-9]))
