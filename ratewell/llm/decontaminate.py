"""Benchmark passages in training texts by a positional inverted index.

The index is sharded by document: one row holds the sorted list of all of a document's
distinct terms and, for each of them, its sorted positions (the postings).  It is written
to the shared folder and can be searched again, by any other benchmark.  A search knows how often each test term
occurs in the whole index.  For every passage it starts with the postings of the
rarest term, shifts them by the term's offset in the passage, and keeps the shifted
positions that the list of the next rarer term, shifted by its own offset, has too.  All terms
take part, so what is left are exact phrase matches; for proximity the other
terms need only be near the rarest one.  A document's postings lie in one row, so
a search moves no postings between tasks.

Passages are searched in blocks of items with a bounded number of words, so what is
sent to the tasks is bounded whatever the size of the benchmark.  Frequencies of all test
terms are counted on the cluster, and a block gets those of its own terms; its hits are
written before the next block is sent.  Each block reads the index once, so a search takes
time in proportion to the index times the blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import words
from .shared import folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
#: Words of items sent to the tasks at a time, at about 60 bytes each.
BLOCK_WORDS = 200_000
#: Number of a document in the index.
ROW = "row of the index"
#: Positions that a task works on at a time.
CHUNK_POSITIONS = 1 << 19


def terms_of(items: DataFrame, text_col: str) -> DataFrame:
    """Hashes of the distinct words of the items."""

    def run(batches):
        for batch in batches:
            for _, _, data, at in words.chunks(batch.column(0)):
                hashed, _ = words.word_hashes(data, at, words.PLAIN)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashed).view(np.int64))], names=["term"])

    return items.select(items[f"`{text_col}`"].alias("t")).mapInArrow(run, "term bigint").distinct()


# Columns of the index, of names that no kept column has.
TERMS, COUNTS, POSITIONS = "terms of the row", "postings of each term", "positions of the postings"
INDEX = [("n_words", "bigint"), (TERMS, "array<bigint>"), (COUNTS, "array<int>"), (POSITIONS, "array<int>")]


def build_index(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, `n_words`, the postings of all terms (TERMS, COUNTS, POSITIONS), and a number (ROW) of every document.

    Null and empty texts have no words and no postings.  Kept columns must not have the names of the results.
    """
    if clash := {c.lower() for c in keep} & {"n_words", "spans", "items"}:
        raise ValueError(f"columns {sorted(clash)} of the documents would be mixed up with results: rename them first")

    def run(batches):
        for batch in batches:
            kept = batch.select(names)
            for first, last, data, at in words.chunks(batch.column("text of a row")):
                hashed, start = words.word_hashes(data, at, words.PLAIN)
                doc = np.repeat(np.arange(last - first), np.diff(start))
                pos = np.arange(len(hashed)) - start[doc]
                n_words = np.diff(start)
                term = hashed.view(np.int64)
                order = np.lexsort((term, doc))  # stable: positions stay in order
                doc, pos, term = doc[order], pos[order], term[order]
                new = np.ones(len(term), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
                heads = np.flatnonzero(new)
                counts = np.diff(np.append(heads, len(term)))
                lists = np.searchsorted(doc[heads], np.arange(last - first + 1))
                postings = np.searchsorted(doc, np.arange(last - first + 1))
                columns = [_list(lists, term[heads], pa.int64()), _list(lists, counts, pa.int32()), _list(postings, pos, pa.int32())]
                yield pa.RecordBatch.from_arrays([*kept.slice(first, last - first).columns, pa.array(n_words), *columns], names=out)

    names = [f"kept {i}" for i in range(len(keep))]
    chosen = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in zip(keep, names, strict=True)], docs[f"`{text_col}`"].alias("text of a row"))
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in INDEX:
        schema = schema.add(name, T.DataType.fromDDL(kind))
    out = schema.names
    return chosen.mapInArrow(run, schema).withColumn(ROW, F.monotonically_increasing_id())


def _list(at: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype()), kind))


SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
NONE = np.zeros(0, np.int64)


class Passages:
    """Distinct windows of a block of items, each with its terms from the rarest to the most frequent and their offsets."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], frequency: dict[int, int], window: int) -> None:
        self.names = [name for name, _ in items]
        found: dict[tuple[int, ...], set[int]] = {}
        for k, (_, terms) in enumerate(items):
            terms = terms.view(np.int64).tolist()
            for j in range(max(1, len(terms) - window + 1) if terms else 0):
                found.setdefault(tuple(terms[j : j + window]), set()).add(k)
        keys = list(found)
        self.owners = [sorted(found[key]) for key in keys]
        self.length = np.array([len(key) for key in keys], dtype=np.int64)
        self.terms = np.zeros((len(keys), window), dtype=np.int64)
        self.offsets = np.zeros((len(keys), window), dtype=np.int64)
        for w, key in enumerate(keys):
            rank = sorted(range(len(key)), key=lambda o: (frequency.get(key[o], 0), key[o], o))
            self.terms[w, : len(key)] = [key[o] for o in rank]
            self.offsets[w, : len(key)] = rank
        by = np.argsort(self.terms[:, 0], kind="stable")
        self.rarest, first = np.unique(self.terms[by, 0], return_index=True)
        self.windows, self.first = by, np.append(first, len(by))


def _span(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, `counts` numbers each."""
    total = np.cumsum(counts)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - counts - starts, counts)


class Shard:
    """Postings of the documents of a chunk: for (document, term) the place of its positions."""

    def __init__(self, terms: np.ndarray, lists: np.ndarray, counts: np.ndarray, positions: np.ndarray) -> None:
        self.vocabulary, code = np.unique(terms, return_inverse=True)
        doc = np.repeat(np.arange(len(lists) - 1), np.diff(lists))
        self.slots = doc * len(self.vocabulary) + code  # ascending: a document's terms are sorted
        self.doc, self.code, self.counts = doc, code, counts.astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.positions = positions
        self.keys = (np.repeat(np.arange(len(terms)), self.counts) << 32) | positions

    def slot(self, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Number of the list of a term in a document, or -1."""
        if not len(self.slots):
            return np.full(len(doc), -1)
        code = np.minimum(np.searchsorted(self.vocabulary, term), len(self.vocabulary) - 1)
        want = doc * len(self.vocabulary) + code
        place = np.minimum(np.searchsorted(self.slots, want), len(self.slots) - 1)
        return np.where((self.vocabulary[code] == term) & (self.slots[place] == want), place, -1)

    def has(self, slot: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (slot << 32) | position
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (slot >= 0) & (position >= 0) & (self.keys[place] == key)

    def near(self, slot: np.ndarray, position: np.ndarray, distance: int) -> np.ndarray:
        """Whether the list has a position at most `distance` away."""
        low = np.searchsorted(self.keys, (slot << 32) | np.maximum(position - distance, 0))
        low = np.minimum(low, len(self.keys) - 1)
        return (slot >= 0) & (self.keys[low] >> 32 == slot) & (np.abs((self.keys[low] & 0xFFFFFFFF) - position) <= distance)

    def matches(self, passages: Passages, distance: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents, windows and places of all matches: the start of a phrase, or the rarest term's position."""
        if not len(self.slots) or not len(passages.rarest):
            return (np.zeros(0, np.int64),) * 3
        place = np.minimum(np.searchsorted(passages.rarest, self.vocabulary), len(passages.rarest) - 1)
        group = np.where(passages.rarest[place] == self.vocabulary, place, -1)[self.code]
        lists = np.flatnonzero(group >= 0)
        group = group[lists]
        posting = _span(self.first[lists], self.counts[lists])
        doc, group = np.repeat(self.doc[lists], self.counts[lists]), np.repeat(group, self.counts[lists])
        found = []
        step = max(1, CHUNK_POSITIONS // 8)
        n = np.diff(passages.first)[group]
        upto = np.cumsum(n)
        # Pairs of a posting and a window of its term, so many at a time.
        for lo in range(0, int(upto[-1]) if len(upto) else 0, step):
            pair = np.arange(lo, min(lo + step, upto[-1]))
            part = np.searchsorted(upto, pair, side="right")
            window = passages.windows[passages.first[group[part]] + pair - (upto - n)[part]]
            d, at = doc[part], self.positions[posting[part]].astype(np.int64)
            if distance is None:
                at = at - passages.offsets[window, 0]
            for k in range(1, passages.terms.shape[1]):
                asked = passages.length[window] > k
                slot = self.slot(d, passages.terms[window, k])
                ok = self.has(slot, at + passages.offsets[window, k]) if distance is None else self.near(slot, at, distance)
                ok |= ~asked
                d, window, at = d[ok], window[ok], at[ok]
            ok = at >= 0
            found.append((d[ok], window[ok], at[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Shard]]:
    terms, counts, positions = (batch.column(c) for c in (TERMS, COUNTS, POSITIONS))
    at_t, at_p = (np.asarray(x.offsets).astype(np.int64) for x in (terms, positions))
    flat_t, flat_c, flat_p = (np.asarray(x.values) for x in (terms, counts, positions))
    at_c = np.asarray(counts.offsets).astype(np.int64)
    first = 0
    while first < batch.num_rows:
        last = min(max(first + 1, int(np.searchsorted(at_p, at_p[first] + CHUNK_POSITIONS, side="right")) - 1), batch.num_rows)
        t, p = slice(at_t[first], at_t[last]), slice(at_p[first], at_p[last])
        yield first, last, Shard(flat_t[t], at_t[first : last + 1] - at_t[first], flat_c[at_c[first] : at_c[last]], flat_p[p].astype(np.int64))
        first = last


def frequencies(index: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): postings per test term over the whole index, a table however many terms there are."""

    def run(batches):
        for batch in batches:
            found, counts = (np.asarray(batch.column(c).flatten()) for c in (TERMS, COUNTS))
            term, place = np.unique(found, return_inverse=True)
            total = np.bincount(place, weights=counts, minlength=len(term)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(total)], names=["term", "n"])

    counted = index.select(TERMS, COUNTS).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return written(counted.join(terms_of(items, text_col), "term", "left_semi"), "frequencies")


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[DataFrame, list[tuple[int | None, np.ndarray]]]]:
    """Items, and their ids and word hashes, in blocks of about BLOCK_WORDS words; a longer item is a block of its own."""
    chosen = items.select(items[f"`{id_col}`"].alias("id"), items[f"`{text_col}`"].alias("text"))
    total = chosen.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    count = int(total // BLOCK_WORDS) + 1
    for b in range(count):
        own = chosen.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == b)
        block = own.toArrow()
        rows = []
        for first, last, data, at in words.chunks(block.column("text")):
            hashed, start = words.word_hashes(data, at, words.PLAIN)
            rows += [(block.column("id")[first + i].as_py(), hashed[start[i] : start[i + 1]]) for i in range(last - first)]
        if rows:
            yield own, rows


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, distance: int | None = None) -> DataFrame:
    """The (written) index without postings, with `spans` (start and end of hit words, merged) and `items` per document.

    Every run of `window` item words is searched, or the whole item when it is shorter.
    `distance` None asks for exact phrases; a number asks for all terms of a run at most
    so many words from its rarest one, and a span is then the rarest term's word.
    """
    frequency = frequencies(index, items, text_col)
    keep = [c for c in index.columns if c not in (TERMS, COUNTS, POSITIONS, ROW)]
    spans, names = "array<struct<a: bigint, b: bigint>>", f"array<{items.schema[id_col].dataType.simpleString()}>"
    schema = f"`{ROW}` bigint, spans {spans}, items {names}"
    kind = to_arrow_type(items.schema[id_col].dataType)
    path = folder(index.sparkSession, "hits")
    index.sparkSession.createDataFrame([], schema).write.parquet(path)
    for own, rows in _blocks(items, id_col, text_col):
        known = frequency.join(terms_of(own, "text"), "term", "left_semi").toArrow()
        counts = dict(zip(known.column("term").to_pylist(), known.column("n").to_pylist(), strict=True))
        passages = index.sparkSession.sparkContext.broadcast(Passages(rows, counts, window))
        index.select(ROW, TERMS, COUNTS, POSITIONS).mapInArrow(_searched(passages, distance, kind), schema).write.mode("append").parquet(path)
        passages.destroy()
    hits = index.sparkSession.read.schema(schema).parquet(path).groupBy(ROW)
    hits = hits.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")).mapInArrow(_joined, schema)
    found = index.select(ROW, *[F.col(f"`{c}`") for c in keep]).join(hits, ROW, "left")
    empty = {c: F.coalesce(c, F.expr(f"cast(array() as {kind})")) for c, kind in (("spans", spans), ("items", names))}
    return found.withColumns(empty).select(*[F.col(f"`{c}`") for c in keep], "spans", "items")


def _searched(passages, distance: int | None, kind: pa.DataType):
    """Per document with hits in the block its number, its spans and the items."""

    def run(batches):
        for batch in batches:
            rows, spans, items = [], [], []
            number = batch.column(ROW)
            for first, _, shard in _shards(batch):
                doc, window, at = shard.matches(passages.value, distance)
                length = passages.value.length[window] if distance is None else np.ones(len(window), np.int64)
                by = np.argsort(doc, kind="stable")
                doc, window, at, length = doc[by], window[by], at[by], length[by]
                hit, cut = np.unique(doc, return_index=True)
                for d, x, y in zip(hit.tolist(), cut.tolist(), np.append(cut, len(doc))[1:].tolist(), strict=True):
                    rows.append(number[first + d].as_py())
                    spans.append(merged([], at[x:y], at[x:y] + length[x:y]))
                    items.append(_sorted({passages.value.names[k] for w in np.unique(window[x:y]).tolist() for k in passages.value.owners[w]}))
            columns = [pa.array(rows, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, "spans", "items"])

    return run


def _joined(batches):
    """Hits of several blocks in one document as ones."""
    for batch in batches:
        spans = [merged(x, NONE, NONE) for x in batch.column("spans").to_pylist()]
        items = [_sorted(set(x)) for x in batch.column("items").to_pylist()]
        columns = [batch.column(ROW), pa.array(spans, batch.schema.field("spans").type), pa.array(items, batch.schema.field("items").type)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _sorted(names: set) -> list:
    return sorted(names, key=lambda x: (x is not None, x))


def merged(spans: list[dict], starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Old and new spans as ascending ones that neither overlap nor touch."""
    every = sorted([(s["a"], s["b"]) for s in spans] + list(zip(starts.tolist(), ends.tolist(), strict=True)))
    out: list[list[int]] = []
    for a, b in every:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"a": a, "b": b} for a, b in out]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), doc_text: str = "text", window: int = WINDOW, distance: int | None = None) -> DataFrame:
    """Index `docs`, search `items`: the kept columns, `n_words`, `spans` and `items` per row of `docs`.

    Words are runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased.  Null and empty
    texts have no words; an item without words is never found; an item without id counts
    under the id null.  Repeated rows are searched each; a repeated item id is one item.
    Empty tables give empty or unhit results.
    """
    index = written(build_index(docs, doc_text, keep), "postings")
    return search(index, items, id_col, text_col, window, distance)


def clean(docs: DataFrame, items: DataFrame, most_words: int = 0, key: str = "doc_id", **settings) -> DataFrame:
    """The documents with at most `most_words` hit words, with all their columns; rows without a key stay."""
    hits = contamination(docs, items, keep=(key,), **settings)
    gone = hits.where(hit_words("spans") > most_words).select(F.col(key).alias("key of a row that goes")).distinct()
    return docs.join(gone, docs[f"`{key}`"] == gone["key of a row that goes"], "left_anti")


def hit_words(spans: str):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, s: total + s["b"] - s["a"])
