"""Near-duplicate documents by word shingles, MinHash bands and odd sketches.

1. One pass over the texts makes, per document, the number of distinct
   shingles, a digest of the whole set, MinHash bands and an odd sketch: the
   MinHash samples folded into a parity bitmap.  The XOR of two bitmaps has as many
   set bits as the samples differ in, up to collisions, which tells high
   similarities apart sharply.
2. Documents with the same set become one row.
3. In a bucket of a band every set is compared with one leader, not with all
   others.  Pairs that pass the sketch and the sizes are candidates; the best
   one of each set is confirmed on the full sets first.
4. Components of those links are formed.  Buckets inside one component are
   settled.  In the others, the rows outside the largest component are compared
   with all rows of other components, in blocks of bounded size: by bit counts
   of the sketches, and the pairs left on their full sets, or, where such rows
   are many, by products of incidence matrices of the full sets at once, so that no
   row travels once per pair.  Then the components are completed.

A pair with the asked similarity shares a band with probability ``1 - MISS``
or more, and every such pair is confirmed or lies within a component already, so
components are those of the full link graph.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from . import words
from .components import components
from .shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Chance of a pair just at the threshold to share no band.
MISS = 1e-7
ROWS = 4
BITS = 512
WORDS = BITS // 64
#: A block holds at most so many rows, and about so many shingles where full sets are compared.
BLOCK, BLOCK_SHINGLES = 256, 1 << 17
#: Buckets with more rows outside the largest component are compared on full sets at once.
DENSE = 16
#: Standard deviations that the sketch filter allows.
SLACK = 6


def bands_for(share: float, rows: int = ROWS) -> int:
    return max(1, math.ceil(math.log(MISS) / math.log1p(-(share**rows)))) if share < 1 else 1


def most_bits(share: float, samples: int) -> int:
    """Set bits in the XOR of two sketches that a pair of the asked similarity stays below, but for a chance of about one in 10**9."""
    differ = min(samples, samples * (1 - share) + SLACK * math.sqrt(samples * share * (1 - share)))
    expected = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * differ))
    return math.ceil(expected + 2)


def text_sets(column: pa.Array, size: int):
    """(row, sorted distinct shingle hashes) of each text."""
    for first, last, data, at in words.chunks(column):
        hashed, start = words.word_hashes(data, at, words.SPACED)
        for i in range(last - first):
            yield first + i, words.shingles(hashed[start[i] : start[i + 1]], size)


def samples_of(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash samples, one line per set that is not empty."""
    rng = np.random.default_rng(20240229)
    masks = rng.integers(0, 2**63, count, dtype=np.uint64)
    factors = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), count), dtype=np.uint64)
    lo = 0
    while lo < len(sets):  # so many sets at a time that their hashes stay in the cache
        hi, total = lo + 1, len(sets[lo])
        while hi < len(sets) and total + len(sets[hi]) <= 1 << 15:
            total += len(sets[hi])
            hi += 1
        flat = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0] + [len(s) for s in sets[lo : hi - 1]])
        for k in range(count):
            out[lo:hi, k] = np.minimum.reduceat((flat ^ masks[k]) * factors[k], starts)
        lo = hi
    return out


def sketches(samples: np.ndarray) -> np.ndarray:
    """Odd sketches as lines of 64-bit numbers."""
    n, count = samples.shape
    bit = (words.mixed(samples + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(words.PRIME)) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount((np.arange(n)[:, None] * BITS + bit).ravel(), minlength=n * BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    n, count = samples.shape
    keys = np.zeros((n, count // rows), dtype=np.uint64)
    for r in range(rows):
        keys *= np.uint64(words.PRIME)
        keys += samples[:, r::rows][:, : count // rows]
    return words.mixed(keys + np.arange(1, count // rows + 1, dtype=np.uint64)).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(values.ravel()))


SIGNATURE = "id bigint, n_shingles bigint, digest binary, sketch array<bigint>, bands array<bigint>"


def signatures(rows: DataFrame, size: int, bands: int) -> DataFrame:
    """`rows` has id and text; a text without words has no digest, sketch or bands."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            found, first = [], 0
            pending = 0
            for row, own in text_sets(batch.column(1), size):
                found.append(own)
                pending += len(own)
                if pending >= 1 << 18 or len(found) >= 4096 or row + 1 == len(ids):
                    yield result(ids.slice(first, row + 1 - first), found)
                    found, first, pending = [], row + 1, 0

    def result(ids, found):
        n = np.array([len(s) for s in found], dtype=np.int64)
        filled = np.flatnonzero(n)
        drawn = samples_of([found[i] for i in filled], bands * ROWS)
        place = np.full(len(found), -1)
        place[filled] = np.arange(len(filled))
        take = pa.array(place, mask=place < 0)
        digests = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found], pa.binary())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n), digests, _lists(sketches(drawn)).take(take), _lists(band_keys(drawn, ROWS)).take(take)],
            names=["id", "n_shingles", "digest", "sketch", "bands"],
        )

    return rows.mapInArrow(run, SIGNATURE)


def full_sets(rows: DataFrame, size: int) -> DataFrame:
    """id and set (array of hashes) of rows with id and text."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            found, first, pending = [], 0, 0
            for row, own in text_sets(batch.column(1), size):
                found.append(own.view(np.int64))
                pending += len(own)
                if pending >= 1 << 18 or row + 1 == len(ids):
                    at = np.cumsum([0] + [len(s) for s in found]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays([ids.slice(first, row + 1 - first), lists], names=["id", "set"])
                    found, first, pending = [], row + 1, 0

    return rows.mapInArrow(run, "id bigint, set array<bigint>")


def _sized_alike(a: str, b: str, num: int, den: int):
    return F.expr(f"{den} * least({a}, {b}) >= {num} * greatest({a}, {b})")


def _unlike_bits(a: str, b: str):
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(WORDS)))


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("u"), F.col("set").alias("one"))
    two = sets.select(F.col("id").alias("v"), F.col("set").alias("two"))
    met = pairs.select("u", "v").join(one, "u").join(two, "v").withColumn("both", F.size(F.array_intersect("one", "two")))
    return met.where(F.expr(f"{den} * both >= {num} * (size(one) + size(two) - both)")).select("u", "v")


def _unsettled(met: DataFrame, comps: DataFrame, sides: DataFrame) -> DataFrame:
    """Rows of buckets with several components, dealt to cells: (dense, key, i, j, both_small, rep, comp, left).

    Rows outside the largest component of a bucket are small.  A cell holds a block of
    small rows and another block of the same bucket, so it is bounded; the rows of the
    largest component go to as many cells as there are blocks of small rows.
    """
    named = sides.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = written(named.select("rep", F.coalesce("component", "rep").alias("comp"), "n"), "set-components")
    met = written(met.join(named, "rep").select("key", "rep", "comp", "n"), "bucket-rows")
    per = met.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("n").alias("s"))
    per = per.groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("most"), F.max("n").alias("n_big"), F.max_by("s", F.struct("n", "comp")).alias("s_big"),
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("comps"),
    )
    blocks = "int(if(n - n_big > {dense}, greatest(ceil({n} / {rows}), ceil({s} / {shingles})), ceil({n} / {rows})))"
    sizes = {"dense": DENSE, "rows": BLOCK, "shingles": BLOCK_SHINGLES}
    per = per.where("comps > 1").select(
        "key", "most", F.expr(f"n - n_big > {DENSE}").alias("dense"),
        F.expr(blocks.format(n="(n - n_big)", s="(s - s_big)", **sizes)).alias("ns"), F.expr(blocks.format(n="n_big", s="s_big", **sizes)).alias("nb"),
    )
    rows = met.drop("n").join(written(per, "open-buckets"), "key").withColumn("small", F.col("comp") != F.col("most"))
    rows = rows.withColumn("own", F.expr("if(small, pmod(xxhash64(rep), ns), pmod(xxhash64(rep), nb))").cast("int"))
    cells = F.expr(
        """if(small,
             concat(transform(sequence(0, ns - 1), j -> struct(least(own, j) as i, greatest(own, j) as j, true as both_small)),
                    transform(sequence(0, nb - 1), j -> struct(own as i, j as j, false as both_small))),
             transform(sequence(0, ns - 1), i -> struct(i as i, own as j, false as both_small)))"""
    )
    rows = rows.select("dense", "key", "rep", "comp", "small", "own", F.explode(cells).alias("c"))
    return rows.select("dense", "key", "c.i", "c.j", "c.both_small", "rep", "comp", (F.col("small") & (F.col("own") == F.col("c.i"))).alias("left"))


CELL = ("key", "i", "j", "both_small")


def _by_cell(work):
    """Calls `work` with a table of whole cells and the numbers of their first rows; rows come sorted by cell."""

    def run(batches):
        held = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch])
            cell = np.stack([table.column(c).to_numpy().astype(np.int64) for c in CELL], axis=1)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            done = int(cuts[-1]) if len(cuts) else 0
            if done:
                yield from work(table.slice(0, done).combine_chunks(), np.concatenate(([0], cuts)))
            held = table.slice(done).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from work(table, np.array([0, table.num_rows]))

    return run


def _column(table: pa.Table, name: str):
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _edges(us: list, vs: list):
    if us:
        found = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])


def _pairs_in_cells(rows: DataFrame, num: int, den: int, limit: int) -> DataFrame:
    """Pairs of different components in a cell whose sketches and sizes allow the similarity."""

    def pairs(table, cuts):
        ids, comp, n, left = (table.column(c).to_numpy() for c in ("rep", "comp", "n", "left"))
        sketch = np.asarray(_column(table, "sketch").flatten()).view(np.uint64).reshape(-1, WORDS)
        us, vs = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            rows = np.arange(lo, hi)
            a = rows[left[lo:hi]]
            ok = (comp[a][:, None] != comp[rows][None, :]) & (den * np.minimum(n[a][:, None], n[rows][None, :]) >= num * np.maximum(n[a][:, None], n[rows][None, :]))
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            x, y = a[x], rows[y]
            bits = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64)
            x, y = x[bits <= limit], y[bits <= limit]
            us.append(np.maximum(ids[x], ids[y]))
            vs.append(np.minimum(ids[x], ids[y]))
        yield from _edges(us, vs)

    return rows.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_by_cell(pairs), "u bigint, v bigint")


def common(sets: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at `left` with all sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    keep = often[code]
    owner, code = owner[keep], number[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(left), len(sets)), dtype=np.float32)
    total = int(often.sum())
    for lo in range(0, total, 4096):
        a, b = np.searchsorted(code, (lo, lo + 4096))
        grid = np.zeros((len(sets), min(4096, total - lo)), dtype=np.float32)
        grid[owner[a:b], code[a:b] - lo] = 1
        both += grid[left] @ grid.T
    return both.astype(np.int64)


def _links_in_cells(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links between different components in a cell, confirmed on the full sets; no more than connect the components."""

    def links(table, cuts):
        ids, comp, left = (table.column(c).to_numpy() for c in ("rep", "comp", "left"))
        column = _column(table, "set")
        flat, at = np.asarray(column.flatten()), np.concatenate(([0], np.cumsum(np.asarray(column.value_lengths()))))
        us, vs = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            rows = np.arange(lo, hi)
            a = np.flatnonzero(left[lo:hi])
            if not len(a):
                continue
            both = common([flat[at[i] : at[i + 1]] for i in rows], a)
            n = at[rows + 1] - at[rows]
            ok = (comp[rows[a]][:, None] != comp[rows][None, :]) & (den * both >= num * (n[a][:, None] + n[None, :] - both))
            x, y = np.nonzero(ok)
            x, y = rows[a[x]], rows[y]
            ends = np.stack([np.maximum(comp[x], comp[y]), np.minimum(comp[x], comp[y])], axis=1)
            _, first = np.unique(ends, axis=0, return_index=True)
            root = {}
            for k in first.tolist():  # one link for each pair of components, and none that closes a ring
                u, v = (_root(root, int(c)) for c in ends[k])
                if u != v:
                    root[max(u, v)] = min(u, v)
                    us.append(np.maximum(ids[x[k : k + 1]], ids[y[k : k + 1]]))
                    vs.append(np.minimum(ids[x[k : k + 1]], ids[y[k : k + 1]]))
        yield from _edges(us, vs)

    return rows.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_by_cell(links), "u bigint, v bigint")


def _root(parent: dict[int, int], x: int) -> int:
    while parent.get(x, x) != x:
        x = parent[x]
    return x


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: its id, `n_shingles`, `component_id` and `kept`.

    Documents are linked when `den` * intersection >= `num` * union of their sets of
    `size`-word shingles (words without ASCII white space, A-Z lower-cased; all words
    as one shingle when there are fewer than `size`).  `component_id` is the smallest
    id that can be reached, the own one included; `kept` tells the document with it.

    Null, empty and blank texts have no shingles and are linked with nothing.  A row
    without id is linked with nothing and kept, its component is null.  Rows that repeat an
    id are one document, linked by any of their texts.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    share = num / den
    bands = bands_for(share)
    limit = most_bits(share, bands * ROWS)
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = written(signatures(rows, size, bands), "signatures")
    linkable = signed.where("id is not null and n_shingles > 0")
    reps = linkable.groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    reps = written(reps, "sets")
    members = reps.select("rep", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", "key")).alias("leader"), F.count("*").alias("n"))
    shared = written(shared.where("n > 1").drop("n"), "buckets")
    met = written(members.join(shared, "key"), "bucket-members")
    sides = reps.select("rep", "n", "sketch")

    stars = met.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    stars = stars.join(sides.toDF("u", "nu", "su"), "u").join(sides.toDF("v", "nv", "sv"), "v")
    stars = stars.where(_sized_alike("nu", "nv", num, den)).select("u", "v", _unlike_bits("su", "sv").alias("bits")).where(F.col("bits") <= limit)
    best = written(stars.groupBy("u").agg(F.min_by("v", F.struct("bits", "v")).alias("v")), "best-leaders")

    near = met.select(F.col("rep").alias("id")).distinct()
    sets = written(full_sets(rows.join(near, "id", "left_semi"), size), "full-sets")
    links = written(confirmed(best, sets, num, den), "links")
    repeated = linkable.groupBy("id").agg(F.min("digest").alias("d"), F.max("digest").alias("e")).where("d <> e").select("id")
    same_id = written(linkable.join(repeated, "id", "left_semi").join(reps.select("digest", "rep"), "digest").select(F.col("id").alias("u"), F.col("rep").alias("v")), "same-ids")
    links = links.unionAll(same_id)
    comps = written(components(links), "first-components")

    cells = _unsettled(met, comps, sides)
    few = written(_pairs_in_cells(cells.where("not dense").join(sides, "rep"), num, den, limit).distinct(), "cross-pairs")
    many = cells.where("dense").join(sets.withColumnRenamed("id", "rep"), "rep")
    more = written(confirmed(few, sets, num, den).unionAll(_links_in_cells(many, num, den)), "more-links")
    if not more.isEmpty():
        comps = written(components(comps.select(F.col("id").alias("u"), F.col("component").alias("v")).unionAll(more)), "components")

    named = reps.select("digest", "rep").join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = written(named.select(F.col("digest").alias("set_digest"), F.coalesce("component", "rep").alias("component")), "named-sets")
    out = signed.join(named, signed["digest"] == named["set_digest"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    out = out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    gone = mark(docs, id_col, text_col, **settings).where("not kept").select(F.col(id_col).alias("id of a row that goes")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == gone["id of a row that goes"], "left_anti")


