"""Spelling variants of the words of a corpus, found with products of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter counts at
a squared distance of 1 or 2.  Words are laid out in blocks of equal length and equal
counts of six classes of letters; an edit leads to the same block, to one with a letter
moved between two classes, or to one that is a letter longer.  For every such pair of
blocks one NumPy product of the two matrices of letter counts gives all squared
distances (|u|² + |v|² − 2u·v); pairs at 2 at most are verified letter by letter.  Large
blocks are cut into parts of bounded size, so a task holds two parts at a time.

Defined cases
-------------
* null text has no words; a null id is written as the empty text in the noise rule;
* equal documents count as often as they come; ties of frequency go to the word that is
  smaller in code-point order;
* texts are cut between words into pieces of about a million characters; a word longer
  than that stays whole;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters of a word, A-Z lower-cased.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
RUN = re.compile("[A-Za-zÀ-ÿ]+")
GAP = re.compile("[^A-Za-zÀ-ÿ]")
CLASSES = 6
PIECE = 1 << 20
#: Distinct words a task holds before it sends their counts on.
HELD = 200_000
#: Words and letters of a part of a block at most (on average; parts are dealt by hash).
PART_WORDS, PART_LETTERS = 512, 1 << 16
#: Letters compared at a time.
COMPARED = 1 << 22


def pieces(text: str):
    """The text cut between words."""
    start = 0
    while len(text) - start > PIECE:
        gap = GAP.search(text, start + PIECE)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1, noise: int | None = None) -> DataFrame:
    """(word, n) of all words of at least ``least`` letters.

    With ``noise`` a word loses one letter in those documents where the crc32 of
    "<id>:<word>" is divisible by it; the place is the crc32 modulo the length.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text"))

    def partial(batches):
        held: Counter = Counter()

        def sent():
            words = pa.RecordBatch.from_pydict({"word": pa.array(list(held.keys()), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return words

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{key.as_py()}:".encode())
                for piece in pieces(text.as_py()):
                    # Lower-casing bytes changes A-Z only.
                    for word, n in Counter(RUN.findall(piece.encode().lower().decode())).items():
                        if noise:
                            h = zlib.crc32(word.encode(), seed)
                            if h % noise == 0:
                                place = h % len(word)
                                word = word[:place] + word[place + 1 :]
                        if len(word) >= least:
                            held[word] += n
                    if len(held) > HELD:
                        yield sent()
        yield sent()

    return rows.mapInArrow(partial, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def class_counts(word: Column) -> Column:
    """Letters of each class in the word."""
    return F.array(*[F.length(word) - F.length(F.translate(word, "".join(chr(c) for c in LETTERS if c % CLASSES == k), "")) for k in range(CLASSES)])


def blocks(words: DataFrame) -> DataFrame:
    """(key, part, words): words of one length and class counts, in parts of bounded size."""
    keyed = words.select(class_counts(F.col("word")).alias("key"), F.length("word").alias("letters"), "word", "n")
    size = F.least(F.lit(PART_WORDS), F.greatest(F.lit(1), F.lit(PART_LETTERS) / F.col("letters")).cast("int"))
    parts = keyed.groupBy("key", "letters").agg(F.count("*").alias("total")).select("key", F.ceil(F.col("total") / size).alias("parts"))
    dealt = keyed.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("word"), "parts"))
    return dealt.groupBy("key", "part").agg(F.collect_list(F.struct("word", "n")).alias("words"))


def neighbours() -> Column:
    """Keys one edit away from ``key``: each pair of blocks from one of its sides only."""
    key = F.col("key")

    def moved(up: int | None = None, down: int | None = None) -> Column:
        return F.transform(key, lambda x, i: x + F.when(i == F.lit(-1 if up is None else up), 1).otherwise(0) - F.when(i == F.lit(-1 if down is None else down), 1).otherwise(0))

    same = [moved(a, b) for a in range(CLASSES) for b in range(a + 1, CLASSES)]
    longer = [moved(a) for a in range(CLASSES)]
    return F.filter(F.array(key, *same, *longer), lambda k: F.forall(k, lambda x: x >= 0))


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.array(words, dtype=f"<U{len(words[0])}").view("<u4").reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    place = np.where(codes < 128, codes.astype(np.int64) - 0x61, codes.astype(np.int64) - 0xC0 + 26)
    rows = np.arange(len(codes))[:, None] * len(LETTERS)
    return np.bincount((rows + place).ravel(), minlength=len(codes) * len(LETTERS)).reshape(len(codes), -1).astype(np.float64)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two code-point matrices are one edit apart; ``b`` may be a letter longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    differs = a != b[:, :-1]
    prefix = np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])
    before = np.arange(a.shape[1]) < prefix[:, None]
    return (before | (a == b[:, 1:])).all(axis=1)


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of two parts that are one edit apart, once per pair when both are the same part."""
    a, b = code_points(left), code_points(right)
    u, v = letter_counts(a), letter_counts(b)
    used = np.flatnonzero(u.any(axis=0) | v.any(axis=0))
    u, v = u[:, used], v[:, used]
    square = (u * u).sum(axis=1)[:, None] + (v * v).sum(axis=1) - 2 * (u @ v.T)
    i, j = np.nonzero(np.triu(square <= 2, 1) if same else square <= 2)
    step = max(1, COMPARED // b.shape[1])
    hit = [one_edit(a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)]
    hit = np.concatenate(hit) if hit else np.zeros(0, dtype=bool)
    return i[hit], j[hit]


def links(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all near words in both directions."""
    stored = written(blocks(words), "letter-blocks")
    left = stored.select(F.col("key").alias("from_key"), F.col("part").alias("from_part"), F.col("words").alias("from_words"), F.explode(neighbours()).alias("key"))
    pairs = left.join(stored, "key").where((F.col("from_key") != F.col("key")) | (F.col("from_part") <= F.col("part")))
    same = (F.col("from_key") == F.col("key")) & (F.col("from_part") == F.col("part"))
    pairs = pairs.select(same.alias("same"), "from_words", "words")

    def products(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                lists = [batch.column(c)[r].values for c in (1, 2)]
                (lw, ln), (rw, rn) = [(x.field("word"), x.field("n")) for x in lists]
                i, j = near_pairs(lw.to_pylist(), rw.to_pylist(), batch.column(0)[r].as_py())
                if len(i):
                    yield pa.RecordBatch.from_arrays([lw.take(i), ln.take(i), rw.take(j), rn.take(j)], ["a", "a_n", "b", "b_n"])

    found = pairs.mapInArrow(products, "a string, a_n bigint, b string, b_n bigint")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return found.select(F.explode(both).alias("link")).select("link.*")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last form a word leads to; a form is always more frequent, so there are no circles."""
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = current.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        current = written(step, "roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")
        current = current.drop("moved")


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table of distinct words and their frequencies.

    A word's form is its most frequent near word, if that is at least ``ratio`` times as frequent.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("best")
    near = written(links(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best), "near-words")
    leads = F.col("n") * ratio <= -F.col("best.minus")
    near = near.select("word", "n_near", F.when(leads, F.col("best.form")).alias("form"), F.when(leads, -F.col("best.minus")).alias("form_n"))
    near = near.join(follow(near.where("form IS NOT NULL")), "word", "left")
    return words.join(near, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 6, least_count: int = 5, ratio: int = 5, noise: int | None = None) -> DataFrame:
    """The words of a corpus with their standard forms."""
    words = count_words(docs, id_col, text_col, least_letters, noise).where(F.col("n") >= least_count)
    return group(written(words, "words"), ratio)
