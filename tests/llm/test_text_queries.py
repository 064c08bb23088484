"""Registered queries against SQL, plain versions or held-out labels."""

import base64
import hashlib
import html as entities
import re
import zlib

import pytest

import brute
from conftest import SMALL
from oracle_check import compare, connect
from ratewell.llm import bpe, counts, queries


def rows(table, columns, sf_dir=SMALL):
    return connect(sf_dir).execute(f"SELECT {columns} FROM {table}").fetchall()


@pytest.fixture(scope="module")
def enc():
    path, pattern = queries.vocabulary()
    with open(path, "rb") as f:
        return bpe.encoder(f.read(), pattern)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.SQL[name]) == []


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


def test_main_text(spark):
    got = {r.page_id: r for r in queries.op1_html_extraction(spark, SMALL).collect()}
    for page, url, html in rows("pages", "page_id, url, html"):
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1])
        parts = [re.sub(r"<[^>]+>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        want = "\n".join(t for t in (" ".join(entities.unescape(p).split()) for p in parts) if t)
        assert (got[page].text, got[page].n_chars, got[page].url) == (want, len(want), url)


def test_contamination(spark):
    want = brute.contaminated(rows("documents", "doc_id, text"), rows("benchmark", "item_id, text"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op2_decontamination(spark, SMALL).collect()}
    assert got == {d: (n, hit, len(items), brute.items_digest(items), hit > 0) for d, (n, hit, items) in want.items()}
    assert any(x[1] for x in want.values())


def test_byte_bpe(spark, enc):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_byte_bpe(spark, SMALL).collect()}
    for d, text in rows("documents", "doc_id, text"):
        ids = enc.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert got[d] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_counts_after_edits(spark, enc):
    masked = re.compile("|".join(f"({form})" for _, form in counts.MASKS), re.I)
    changed = 0
    got = {r.doc_id: r for r in queries.op5_token_counts(spark, SMALL).collect()}
    for d, text in rows("documents", "doc_id, text"):
        want = masked.sub(lambda m: counts.MASKS[m.lastindex - 1][0], text or "")
        changed += want != text
        assert (got[d].n_tokens_before, got[d].n_tokens) == (len(enc.encode_ordinary(text or "")), len(enc.encode_ordinary(want)))
        assert got[d].text_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (got[d].n_chars_encoded > 0) == (got[d].n_edits > 0)
    assert changed


def test_near_duplicates(spark):
    want = brute.near(rows("documents", "doc_id, text"), 3, 85, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_near_dedup(spark, SMALL).collect()}
    assert got == want and any(d != c for d, (_, c) in want.items())


def test_archives(spark):
    first, want = {}, {}
    for page, html in rows("pages", "page_id, html"):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first[digest] = min(first.get(digest, page), page)
        want[page] = [len(data), digest]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op10_warc(spark, SMALL).collect()}
    assert got == {p: (n, d, *(("response", None) if first[d] == p else ("revisit", first[d]))) for p, (n, d) in want.items()}


def test_spelling_variants(spark):
    got = {r.word: tuple(r)[1:] for r in queries.op12_spelling_variants(spark, SMALL).collect()}
    want = brute.spelling(rows("documents", "doc_id, text"), noise=199)
    assert got == want and any(w[0] for w in want.values()) and any(w[3] > 1 for w in want.values())


def test_fingerprints(spark):
    got = {r.doc_id: tuple(r)[1:7] for r in queries.op13_fingerprints(spark, SMALL).collect()}
    want = brute.edited(rows("documents", "doc_id, text"))
    assert got == want
    assert sum(w[4] > w[5] for w in want.values()) > 0.9 * len(want)


@pytest.mark.parametrize(("name", "label", "least"), [("op7_toxicity", "toxic", 0.9), ("op9_quality", "quality", 0.98)])
def test_scores_of_held_out_rows(spark, name, label, least):
    """The share of pairs of a good and a bad held-out document that are in the right order."""
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    docs = {d for (d,) in rows("documents", "doc_id", sf_dir)}
    assert set(got) == docs
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= (0.5 if label == "toxic" else 0.3))
    truth = {d: y for d, y in rows("labels", f"doc_id, {label}", sf_dir) if d in got and got[d].held_out}
    ones, zeros = ([got[d].score for d, y in truth.items() if y == v] for v in (1, 0))
    right = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    assert right / (len(ones) * len(zeros)) >= least


def test_pipeline(spark, enc):
    """Every stage on what the one before kept, against plain versions on its own input."""
    import corpus_pipeline
    from ratewell.llm.shared import written

    docs, columns = queries.table(spark, SMALL, "documents"), ["doc_id", "text", "lang", "source", "n_chars"]
    before = {r.doc_id: r.text for r in docs.collect()}
    labels = dict(rows("labels", "doc_id, quality"))
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        if name == "byte_bpe":
            for r in docs.collect():
                assert r.n_tokens == len(enc.encode_ordinary(before[r.doc_id])) and enc.decode_bytes(memoryview(bytes(r.ids)).cast("I").tolist()) == before[r.doc_id].encode()
            assert docs.count() == len(before)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before) and len(after) < len(before)
        gone = set(before) - set(after)
        if name == "quality_classifier":
            assert sum(labels.get(d) == 1 for d in gone) <= 1 and sum(labels.get(d) == 0 for d in after) <= 1
        elif name == "minhash_near_dedup":
            assert gone == {d for d, (_, c) in brute.near(before.items(), 5, 80, 100).items() if c != d}
        elif name == "benchmark_decontamination":
            hits = brute.contaminated(before.items(), rows("benchmark", "item_id, text"))
            assert gone == {d for d, (_, hit, _) in hits.items() if hit}
        elif name == "line_dedup":
            want = brute.without_later_runs(before, 50)
            assert after == {d: t for d, t in want.items() if t.strip() or t == before[d]}
        before = after
