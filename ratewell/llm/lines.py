"""Repeated runs of lines, found by prefix doubling over line ids, and deletion of their later copies.

Every text is a sequence of line ids.  Only lines that occur more than once can lie in a
repeated run, so all others end a sequence.  Prefix doubling ranks the runs of 1, 2, 4, ... lines
that start at each position: the rank of twice the length comes from the pair of ranks of
both halves, is given in the order of the pairs (range-partitioned, so no task sees
them all), and positions whose run is unique are dropped.  Ordered by rank the
positions are the suffix array, as deep as it is needed.  A longest-common-prefix interval of depth d, the
suffixes that share d lines, is the set of positions with equal ranks of the two overlapping runs of
2^j <= d lines that make up d lines.

A run counts when it has at least `min_words` words.  The shortest such runs that start or end at
a position cover every longer repeated run, so intervals of just their depths find
all lines of all maximal repeated runs.  Of each interval the first position in the order of
(id, text hash, line) stays; the runs at all others are deleted.

Only DataFrame functions are used.  A very frequent line or run is one row after map-side counts, and
joins with it read written tables, which Spark splits where they are skewed.

Defined cases: null counts as the empty text, which is one empty line; blanks around a line do not
count; the words of a line are its runs of characters other than white space (space and \\x09 to \\x0D), so an empty
line has none but is a line of a run like others; a null id comes first in the order; rows that repeat an id and a
text are one document and are changed alike; an empty table gives an empty result; an input column `gone` stays as
it is, and the deleted runs are then called `gone_1`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import free_name, written

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, pos, k1, k2, words): a row per line, with two independent hashes of the line."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), _text_hash(f"`{text_col}`").alias("h"), F.posexplode(_lines_of(F.col(f"`{text_col}`"))).alias("pos", "line"))
    line = F.btrim("line", F.lit(" \t\r"))
    return rows.select("id", "h", "pos", F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2"), F.regexp_count(line, F.lit(WORD)).cast("bigint").alias("words"))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _ranked(keys: DataFrame, *names: str) -> DataFrame:
    """Distinct keys with a rank in their order; ranks of the same order in every task, though not consecutive."""
    ordered = keys.repartitionByRange(*names).sortWithinPartitions(*names)
    return written(ordered.select(*names, F.monotonically_increasing_id().alias("r")), "ranks")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The positions whose line occurs more than once, with the line's rank."""
    often = lines.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    live = lines.join(_ranked(often, "k1", "k2"), ["k1", "k2"]).select("id", "h", "pos", "words", "r").distinct()
    return written(live, "repeated-lines")


def _ahead(left: DataFrame, ranks: DataFrame, place: Column, named: str, *on: str) -> DataFrame:
    """The left rows with the rank, under a new name, of the run that starts at `place` in the same text."""
    other = ranks.select(F.col("id").alias("other id"), F.col("h").alias("other h"), F.col("pos").alias("other pos"), F.col("r").alias(named), *[F.col(c).alias(f"other {c}") for c in on])
    same = F.col("id").eqNullSafe(F.col("other id")) & (F.col("h") == F.col("other h")) & (place == F.col("other pos"))
    for c in on:
        same &= F.col(c) == F.col(f"other {c}")
    return left.join(other, same).select(*left.columns, named)


def doubled(level: DataFrame, length: int) -> DataFrame:
    """Ranks of repeated runs of 2 * length lines from those of length lines."""
    halves = level.withColumnRenamed("r", "first")
    pairs = written(_ahead(halves, level, F.col("pos") + length, "next"), "pairs")
    often = pairs.groupBy("first", "next").agg(F.count("*").alias("n")).where("n > 1").select("first", "next")
    return written(pairs.join(_ranked(often, "first", "next"), ["first", "next"]).select("id", "h", "pos", "r"), "runs")


def shortest_runs(live: DataFrame, min_words: int) -> DataFrame:
    """(id, h, start, length) of the shortest runs of repeated lines with enough words, by their start and by their end."""
    by_doc = Window.partitionBy("id", "h").orderBy("pos")
    rows = live.withColumn("island", F.col("pos") - F.row_number().over(by_doc))
    rows = rows.withColumn("upto", F.sum("words").over(Window.partitionBy("id", "h", "island").orderBy("pos")))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    ahead = Window.partitionBy("id", "h", "island").orderBy("before").rangeBetween(0, min_words - 1)
    back = Window.partitionBy("id", "h", "island").orderBy("upto").rangeBetween(-(min_words - 1), 0)
    # Lines without words share `before` or `upto` with a neighbour, so a run is told by its outermost line, not by a count.
    rows = rows.select(
        "id", "h", "pos",
        (F.max("pos").over(ahead) - F.col("pos") + 1).cast("bigint").alias("n_ahead"), F.sum("words").over(ahead).alias("w_ahead"),
        (F.col("pos") - F.min("pos").over(back) + 1).cast("bigint").alias("n_back"), F.sum("words").over(back).alias("w_back"),
    )
    runs = F.filter(
        F.array(
            F.struct(F.col("pos").cast("bigint").alias("start"), F.col("n_ahead").alias("length"), F.col("w_ahead").alias("w")),
            F.struct((F.col("pos") - F.col("n_back") + 1).cast("bigint").alias("start"), F.col("n_back").alias("length"), F.col("w_back").alias("w")),
        ),
        lambda run: run["w"] >= min_words,
    )
    return written(rows.select("id", "h", F.explode(runs).alias("run")).select("id", "h", "run.start", "run.length").distinct(), "shortest-runs")


def later_copies(live: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, h, start, length) of the runs that occur earlier, too."""
    longest = runs.agg(F.max("length")).first()[0] or 0
    levels, length = [live.select("id", "h", "pos", "r")], 1
    while 2 * length <= longest:
        levels.append(doubled(levels[-1], length))
        length *= 2
    ranks = reduce(DataFrame.unionAll, [x.select("id", "h", "pos", "r", F.lit(j).alias("level")) for j, x in enumerate(levels)])
    runs = runs.withColumn("level", F.floor(F.log2("length") + 1e-9).cast("int"))
    found = _ahead(runs, ranks, F.col("start"), "first", "level")
    found = _ahead(found, ranks, F.col("start") + F.col("length") - F.expr("shiftleft(1L, level)"), "last", "level")
    found = written(found, "runs-with-ranks")
    interval = ["length", "first", "last"]
    stays = found.groupBy(*interval).agg(F.min(F.struct("id", "h", "start")).alias("stays"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(written(stays, "intervals"), interval)
    return later.where(~F.struct("id", "h", "start").eqNullSafe(F.col("stays"))).select("id", "h", "start", "length")


def deleted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, gone): per document and text hash, the maximal runs of deleted lines as structs a (first) and b (behind the last)."""
    live = repeated_lines(line_table(docs, id_col, text_col))
    later = later_copies(live, shortest_runs(live, min_words))
    by_doc = Window.partitionBy("id", "h").orderBy("start")
    ends = later.groupBy("id", "h", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    ends = ends.withColumn("reached", F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1)))
    ends = ends.withColumn("run", F.sum(F.when(F.col("start") <= F.col("reached"), 0).otherwise(1)).over(by_doc))
    runs = ends.groupBy("id", "h", "run").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    return written(runs.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("gone")), "deleted-runs")


def runs_column(docs: DataFrame) -> str:
    """What the column of deleted runs is called: `gone`, unless the documents have a column of that name."""
    return free_name(docs, "gone")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns with the text left, and the deleted runs of lines (empty where nothing was deleted) in the column `runs_column(docs)`."""
    runs = deleted_runs(docs, id_col, text_col, min_words).toDF("id of a changed row", "hash of a changed row", "gone lines of a changed row")
    same = docs[f"`{id_col}`"].eqNullSafe(runs["id of a changed row"]) & (_text_hash(f"`{text_col}`") == runs["hash of a changed row"])
    gone = F.col("gone lines of a changed row")
    left = F.filter(_lines_of(F.col(f"`{text_col}`")), lambda line, i: ~F.exists(gone, lambda run: (i >= run["a"]) & (i < run["b"])))
    text = F.when(gone.isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(left, "\n"))
    # A merge join at every size: whether the deleted runs are few depends on the data.
    out = docs.join(runs.hint("merge"), same, "left").withColumn(text_col, text)
    return out.withColumn(runs_column(docs), F.coalesce(gone, F.expr("cast(array() as array<struct<a: bigint, b: bigint>>)"))).drop("id of a changed row", "hash of a changed row", "gone lines of a changed row")
