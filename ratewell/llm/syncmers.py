"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is a sequence of tokens: words of letters and digits, and every other visible
character (and every character of scripts without spaces) on its own.  Of the runs of
``RUN`` tokens those are anchors whose smallest inner run of ``INNER`` tokens, by hash,
lies at the run's start or end.  Whether a run is an anchor depends on nothing outside
it, so an edit changes only the anchors that it touches, and equal passages have equal
anchors wherever they stand.  An anchor is one 64-bit number: 44 bits of its hash and
20 bits of its place.  The fingerprint holds the ``SIZE`` smallest distinct anchors (all,
if there are fewer), 16 hexadecimal digits each; the likeness of two fingerprints is
the share of common anchors among those that both can vouch for, and ``shared`` gives the
places at which two texts agree.

Defined cases
-------------
* null text counts as empty; a text without tokens has the empty fingerprint;
* a text of fewer than ``RUN`` tokens has one anchor, the hash of all its tokens;
* two empty fingerprints have likeness 1, an empty and another one 0;
* of an anchor that occurs several times the first place is kept; places end at 2²⁰ − 1;
* equal texts have equal fingerprints, and A-Z are lower-cased first;
* in ``edited`` rows that repeat id and text are one document of the order, in which
  null ids come last and rows with one id and several texts follow their digests; a
  single document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

RUN, INNER = 4, 2
SIZE = 64
PLACE_BITS = 20
PLACES = (1 << PLACE_BITS) - 1
# Blocks of scripts written without spaces (Thai and Lao, Burmese, Khmer, kana, Han).
ALONE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = rf"[0-9a-z[\p{{L}}\p{{M}}\p{{N}}&&[^{ALONE}]]]+|[{ALONE}]|[^\s\p{{L}}\p{{M}}\p{{N}}]"


def _packed(digest: Column, place: Column) -> Column:
    return digest.bitwiseAND(F.lit(~PLACES)).bitwiseOR(F.least(place, F.lit(PLACES)).cast("bigint"))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """The rows with their anchors, by place; work columns are named after ``out``."""
    h, s, n = f"{out} tokens", f"{out} inner", F.size(f"{out} tokens")
    lowered = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    df = df.withColumn(h, F.transform(F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t)))
    df = df.withColumn(s, F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))))

    def anchor(first: Column, i: Column) -> Column:
        # Inner runs of a run of four tokens: at its start, in its middle and at its end.
        last = F.get(s, i + 2)
        return F.when((i <= n - RUN) & (F.least(first, last) <= F.get(s, i + 1)), _packed(F.xxhash64(first, last), i))

    short = F.when(n > 0, F.array(_packed(F.xxhash64(F.col(h)), F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.when(n < RUN, short).otherwise(F.array_compact(F.transform(s, anchor)))).drop(h, s)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """The rows with the fingerprint of a text as an ascending array of numbers."""
    sorted_ = f"{out} sorted"
    df = with_anchors(df, text, out).withColumn(sorted_, F.sort_array(out)).drop(out)
    new = F.filter(sorted_, lambda x, i: (i == 0) | (F.shiftright(x, PLACE_BITS) != F.shiftright(F.get(sorted_, i - 1), PLACE_BITS)))
    return df.withColumn(out, F.slice(new, 1, SIZE)).drop(sorted_)


def as_text(fingerprint: Column | str) -> Column:
    """A fingerprint as text."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _digests(fingerprint: Column | str) -> Column:
    return F.transform(fingerprint, lambda x: F.shiftright(x, PLACE_BITS))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """The rows with the likeness of two fingerprints, from 0 to 1.

    Two complete fingerprints are compared as sets; where one was cut off at ``SIZE``,
    among the smallest ``SIZE`` anchors of both together.
    """
    left, right, both = f"{out} left", f"{out} right", f"{out} both"
    df = df.withColumns({left: _digests(a), right: _digests(b)}).withColumn(both, F.array_union(left, right))
    cut = (F.size(left) >= SIZE) | (F.size(right) >= SIZE)
    df = df.withColumn(both, F.when(cut, F.slice(F.sort_array(both), 1, SIZE)).otherwise(F.col(both)))
    common = F.size(F.array_intersect(F.array_intersect(left, right), both))
    return df.withColumn(out, F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))).drop(left, right, both)


def shared(a: str, b: str) -> Column:
    """Places of the anchors that two fingerprints share: (place in a, place in b), by place in a.

    A run of pairs with one difference is a passage that both texts hold.
    """
    place = F.map_from_entries(F.transform(b, lambda x: F.struct(F.shiftright(x, PLACE_BITS), x.bitwiseAND(F.lit(PLACES)))))
    pairs = F.transform(a, lambda x: F.struct(x.bitwiseAND(F.lit(PLACES)).alias("a"), F.try_element_at(place, F.shiftright(x, PLACE_BITS)).alias("b")))
    return F.array_sort(F.filter(pairs, lambda p: p["b"].isNotNull()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return with_fingerprint(rows, "text", "marks").select(F.col("id").alias(id_col), as_text("marks").alias("fingerprint"))


def _in_order(docs: DataFrame) -> DataFrame:
    """(key, next_key, id, n_chars) of distinct documents by descending id; the last one's next is the first."""
    order = (F.desc_nulls_last("id"), "key")
    light = docs.groupBy("key").agg(F.max("id").alias("id"), F.max(F.length("text")).alias("n_chars"))
    light = light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    light = written(light, "order").withColumn("range", F.shiftright("place", 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of the stored table.
    starts = light.groupBy("range").agg(F.count("*").alias("n"))
    starts = starts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = light.join(starts, "range").withColumn("number", F.col("start") + F.col("place") - F.shiftleft("range", 33))
    total = light.count()
    ahead = numbered.select(F.col("number").alias("next"), F.col("key").alias("next_key"))
    wanted = F.when(F.col("number") + 1 < total, F.col("number") + 1).otherwise(F.lit(0))
    return numbered.withColumn("next", wanted).join(ahead, "next").select("key", "next_key", "id", "n_chars")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against an edited copy of itself and against the next document.

    The edited text has the last third of the code points replaced by the first as many
    of the next document, in descending order of ids.  Only that head and the
    fingerprint of the next document travel to a document, not its text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), text).cast("binary")).alias("key"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    links = written(_in_order(rows), "next-documents")
    texts = rows.select("key", "text")
    ahead = texts.join(links.withColumnsRenamed({"key": "to", "next_key": "key"}), "key")
    ahead = with_fingerprint(ahead, "text", "next_marks").select(
        F.col("to").alias("key"), "id", "n_chars", F.expr("substring(text, 1, n_chars div 3)").alias("head"), "next_marks"
    )
    out = texts.join(ahead.dropDuplicates(["key"]), "key")
    out = out.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - n_chars div 3)"), "head"))
    out = with_fingerprint(with_fingerprint(out, "text", "marks"), "edited", "edited_marks")
    out = with_likeness(with_likeness(out, "marks", "edited_marks", "near_edited"), "marks", "next_marks", "near_next")
    return out.select(
        F.col("id").alias(id_col), F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text("marks").alias("fingerprint"), as_text("edited_marks").alias("edited_fingerprint"), "near_edited", "near_next",
        shared("marks", "edited_marks").alias("shared_edited"),
    )
