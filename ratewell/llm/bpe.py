"""Byte-level BPE with a local rank file: encoding of whole texts and decoding to raw bytes.

The rank file is read once on the driver and sent to the executors, so only
the driver needs it.  Ids are kept as little-endian unsigned 32-bit numbers in
one binary value per text.  Texts beyond ``LONG`` characters are cut where
the pattern never joins two pieces: between a character that is no white
space and ASCII white space.  No alternative of the pattern has white space behind
another character, and its only look-ahead goes to the right, so the pieces
of both sides, and with them the ids, are those of the uncut text.

Defined cases: null and empty texts have no ids and decode to no bytes; a text
without a cut point is encoded as one; repeated rows are encoded each; other
columns are passed on by ``encode`` and ``decode`` only when named in `keep`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG = 1 << 16
CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")
#: Result batches are closed at about so many bytes.
BATCH_BYTES = 1 << 22


def encoder(rank_file: bytes, pattern: str):
    """The library's encoder for a rank file, made once per Python worker."""
    import tiktoken

    made = vars(tiktoken).setdefault("_made_by_rank_file", {})  # outlives a task, unlike what comes with the task's code
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in made:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in rank_file.splitlines() if line.strip())}
        made[key] = tiktoken.Encoding(key, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return made[key]


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text cut at safe boundaries into parts of `long` characters or little more."""
    start = 0
    while len(text) - start > long:
        found = CUT.search(text, start + long)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def token_ids(enc, text: str | None, long: int = LONG) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit numbers."""
    if not text:
        return b""
    out = bytearray()
    for piece in pieces(text, long):
        ids = array("I", enc.encode_ordinary(piece))
        if sys.byteorder == "big":
            ids.byteswap()
        out += ids.tobytes()
    return bytes(out)


def raw_bytes(enc, ids: bytes | None) -> bytes:
    """The bytes that the ids stand for, also where they are no valid UTF-8."""
    if not ids:
        return b""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return enc.decode_bytes(numbers)


def _in_parts(batch: pa.RecordBatch, column: str, names: list[str], made, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches with the kept columns and what `made` gives for each value, closed at BATCH_BYTES."""
    rows, size, first = [], 0, 0
    values = batch.column(column)
    for i in range(len(values)):
        rows.append(made(values[i].as_py()))
        size += sum(len(x) for x in rows[-1] if isinstance(x, bytes)) + 64
        if size >= BATCH_BYTES or i + 1 == len(values):
            kept = [batch.column(n).slice(first, i + 1 - first) for n in names]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[str(j) for j in range(len(names) + len(kinds))])
            rows, size, first = [], 0, i + 1


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), long: int = LONG) -> DataFrame:
    """The kept columns, `n_tokens` and `ids` of every text."""
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoder(ranks.value, pattern)

        def made(text):
            ids = token_ids(enc, text, long)
            return len(ids) // 4, ids

        for batch in batches:
            yield from _in_parts(batch, "text of a row", names, made, [pa.int64(), pa.binary()])

    names = [f"kept {i}" for i in range(len(keep))]
    chosen = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in zip(keep, names, strict=True)], docs[f"`{text_col}`"].alias("text of a row"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return chosen.mapInArrow(_named(run, schema.names), schema)


def decode(encoded: DataFrame, rank_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The kept columns and `decoded`, the raw bytes of every list of ids."""
    with open(rank_path, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoder(ranks.value, pattern)
        for batch in batches:
            yield from _in_parts(batch, "ids of a row", names, lambda ids: (raw_bytes(enc, ids),), [pa.binary()])

    names = [f"kept {i}" for i in range(len(keep))]
    chosen = encoded.select(*[encoded[f"`{c}`"].alias(n) for c, n in zip(keep, names, strict=True)], encoded["ids"].alias("ids of a row"))
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])
    return chosen.mapInArrow(_named(run, schema.names), schema)


def _named(run, names):
    def renamed(batches):
        for batch in run(batches):
            yield batch.rename_columns(names)

    return renamed
