"""Token counts that follow edits.

A text is cut into leaves, runs of pre-tokens of a few hundred characters that end where the
pattern never joins two pieces.  A segment tree holds characters and tokens of the leaves
and of all subtrees.  An edit is found by descending along the characters; the leaves
it touches are encoded again, together with neighbours as far as their common borders are no safe
cuts any more, and only sums on the way to the root change.  A leaf that has grown
too large is cut again and the tree is built from the leaves' counts, without encoding the others.

Trees are rows: the text, characters and tokens per leaf, and both heaps of sums.
They can be written, read and edited again.

Defined cases: null and empty texts have no leaves and no tokens, and can be edited at 0; edits are
(start, end, replacement) in code points of the text before all edits; places beyond the end mean the
end, an end before its start means an insertion, a null replacement deletes; an edit that reaches into a later one
ends where that begins; of edits at one place the one with the smaller end comes first; a text
without edits keeps its counts.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from . import bpe

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 256
FAT = 8 * LEAF
BATCH_BYTES = 1 << 22
SPACES = " \t\n\r"


class SegmentTree:
    """Sums over leaves in a heap: node k has children 2k and 2k + 1, leaves begin at `size`."""

    def __init__(self, leaves: list[int], heap: list[int] | None = None) -> None:
        self.size = 1
        while self.size < len(leaves):
            self.size *= 2
        if heap is None:
            heap = [0] * self.size + leaves + [0] * (self.size - len(leaves))
            for k in range(self.size - 1, 0, -1):
                heap[k] = heap[2 * k] + heap[2 * k + 1]
        self.heap = heap

    def total(self) -> int:
        return self.heap[1]

    def put(self, leaf: int, value: int) -> None:
        k = self.size + leaf
        change = value - self.heap[k]
        while k and change:
            self.heap[k] += change
            k //= 2

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and the place of its start; the last leaf for the end."""
        k, start = 1, 0
        while k < self.size:
            k *= 2
            if place >= start + self.heap[k] and self.heap[k + 1]:
                start += self.heap[k]
                k += 1
        return k - self.size, start


class CountedText:
    """Leaves of one text with the trees of their characters and tokens."""

    def __init__(self, encoder, leaves: list[str], tokens: list[int] | None = None, heaps: tuple[list[int], list[int]] | None = None) -> None:
        self.encoder, self.leaves = encoder, leaves or [""]
        self.encoded = 0
        tokens = [self._count(x) for x in self.leaves] if tokens is None else tokens or [0]
        self._plant(tokens, heaps)

    def _plant(self, tokens: list[int], heaps=None) -> None:
        chars = [len(x) for x in self.leaves]
        self.chars = SegmentTree(chars, heaps and heaps[0])
        self.tokens = SegmentTree(tokens, heaps and heaps[1])

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.encoder.encode_ordinary(text)) if text else 0

    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_tokens(self) -> list[int]:
        return self.tokens.heap[self.tokens.size : self.tokens.size + len(self.leaves)]

    def _beside(self, leaf: int, step: int) -> int | None:
        """The next leaf with text on one side."""
        leaf += step
        while 0 <= leaf < len(self.leaves) and not self.leaves[leaf]:
            leaf += step
        return leaf if 0 <= leaf < len(self.leaves) else None

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from `start` to before `end`."""
        first, at = self.chars.find(start)
        last, last_at = self.chars.find(max(start, end - 1)) if end > start else (first, at)
        begin, stop = start - at, end - last_at
        merged = self.leaves[first][:begin] + replacement + self.leaves[last][stop:]
        while (left := self._beside(first, -1)) is not None and not (merged and merged[0] in SPACES and not self.leaves[left][-1].isspace()):
            merged, first = self.leaves[left] + merged, left
        while (right := self._beside(last, 1)) is not None and not (merged and not merged[-1].isspace() and self.leaves[right][0] in SPACES):
            merged, last = merged + self.leaves[right], right
        for k in range(first + 1, last + 1):
            self.leaves[k] = ""
            self.chars.put(k, 0)
            self.tokens.put(k, 0)
        if len(merged) > FAT and len(parts := list(bpe.pieces(merged, LEAF))) > 1:
            tokens = self.leaf_tokens()
            self.leaves[first : last + 1] = parts
            tokens[first : last + 1] = [self._count(p) for p in parts]
            self._plant(tokens)
        else:
            self.leaves[first] = merged
            self.chars.put(first, len(merged))
            self.tokens.put(first, self._count(merged))


def edited(counted: CountedText, edits: list[tuple[int, int, str]]) -> int:
    """Apply edits given in places of the text before all of them; their number."""
    length, limit = counted.chars.total(), None
    for start, end, replacement in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
        start = min(max(start, 0), length)
        end = min(max(end, start), length)
        if limit is not None:
            end = min(end, limit)
        counted.edit(start, end, replacement)
        limit = start
    return len(edits)


EDITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("replacement", T.StringType())]))
TREE = [("text", T.StringType()), ("leaf_chars", T.ArrayType(T.IntegerType())), ("leaf_tokens", T.ArrayType(T.IntegerType())), ("chars_heap", T.ArrayType(T.LongType())), ("tokens_heap", T.ArrayType(T.LongType())), ("n_tokens", T.LongType())]
TREE_ARROW = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]


def _row(counted: CountedText) -> tuple:
    return counted.text(), [len(x) for x in counted.leaves], counted.leaf_tokens(), counted.chars.heap, counted.tokens.heap, counted.tokens.total()


def _rows(batch: pa.RecordBatch, n_kept: int, made, kinds: list[pa.DataType], names: list[str]):
    rows, size, first = [], 0, 0
    columns = [batch.column(k) for k in range(n_kept, batch.num_columns)]
    for i in range(batch.num_rows):
        rows.append(made(*[c[i].as_py() for c in columns]))
        size += 3 * len(rows[-1][0] or "") + 64
        if size >= BATCH_BYTES or i + 1 == batch.num_rows:
            kept = [batch.column(k).slice(first, len(rows)) for k in range(n_kept)]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names=names)
            rows, size, first = [], 0, i + 1


def _chosen(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.select(*[rows[f"`{c}`"].alias(f"column {i}") for i, c in enumerate(columns)])


def build(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and the tree of every text."""
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in TREE:
        schema = schema.add(name, kind)
    names = schema.names

    def run(batches):
        enc = bpe.encoder(ranks.value, pattern)
        for batch in batches:
            yield from _rows(batch, len(keep), lambda text: _row(CountedText(enc, list(bpe.pieces(text or "", LEAF)))), TREE_ARROW, names)

    return _chosen(docs, (*keep, text_col)).mapInArrow(run, schema)


def with_edits(trees: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """The trees with the edits (key, start, end, replacement) of their key as an array; a document's edits are no more than its row can hold."""
    lists = edits.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct("start", "end", "replacement")).alias("edits"))
    return trees.join(lists, key, "left")


def apply(trees: DataFrame, rank_path: str, pattern: str, edits_col: str = "edits", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the edited trees, `n_tokens_before`, `n_edits` and `n_chars_encoded`, the characters that were encoded again."""
    with open(rank_path, "rb") as f:
        ranks = trees.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([trees.schema[c] for c in keep])
    extra = ("n_tokens_before", "n_edits", "n_chars_encoded")
    for name, kind in [*TREE, *[(n, T.LongType()) for n in extra]]:
        schema = schema.add(name, kind)
    names = schema.names

    def run(batches):
        enc = bpe.encoder(ranks.value, pattern)

        def made(text, leaf_chars, leaf_tokens, chars_heap, tokens_heap, n_tokens, edits):
            if not edits:
                return text, leaf_chars, leaf_tokens, chars_heap, tokens_heap, n_tokens, n_tokens, 0, 0
            leaves, at = [], 0
            for n in leaf_chars:
                leaves.append(text[at : at + n])
                at += n
            counted = CountedText(enc, leaves, leaf_tokens, (chars_heap, tokens_heap))
            n = edited(counted, [(e["start"], e["end"], e["replacement"] or "") for e in edits])
            return (*_row(counted), n_tokens, n, counted.encoded)

        for batch in batches:
            yield from _rows(batch, len(keep), made, [*TREE_ARROW, *[pa.int64()] * 3], names)

    return _chosen(trees, (*keep, *[n for n, _ in TREE], edits_col)).mapInArrow(run, schema)


# Forms of personal data and secrets, with what takes their place.
MASKS = (
    ("<email>", r"[\w.+-]+@[\w-]+\.[\w.-]*\w"), ("<secret>", r"(?:password|passwd|secret|token|api_?key)\s*[=:]\s*\S+"), ("<phone>", r"\+\d[\d ()-]{7,}\d"),
    ("<ip>", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"), ("<number>", r"\b\d{12,19}\b"),
)


def masking(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The kept columns and `edits` that mask personal data and secrets in the text."""
    forms = re.compile("|".join(f"({form})" for _, form in MASKS), re.I)
    schema = T.StructType([docs.schema[c] for c in keep]).add("edits", EDITS)
    names, kind = schema.names, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("replacement", pa.string())]))

    def run(batches):
        for batch in batches:
            found = [[{"start": m.start(), "end": m.end(), "replacement": MASKS[m.lastindex - 1][0]} for m in forms.finditer(x.as_py() or "")] for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], pa.array(found, kind)], names=names)

    return _chosen(docs, (*keep, text_col)).mapInArrow(run, schema)
