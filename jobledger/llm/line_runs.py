"""Removal of repeated runs of lines, by prefix doubling over sequences of line ids.

Every place of a line in a document is a suffix of the sequence of its line ids. Suffixes are ranked
by their first line, then by pairs of ranks at a growing offset, the pair (rank of h lines here, rank
of h lines further on), sorted and counted by Spark. A suffix that is alone with its rank leaves, and
so does the rest of its document's stretch; ranks stop at ``least`` lines, the smallest run of
interest. Suffixes of one rank are then an interval of the suffix array whose longest common prefix
is ``least`` or more, its smallest place is the original and all others are copies; copies that
follow each other line by line join to the maximal repeated runs.

A rank is a hash of its pair and 128 bits long, so ranking needs no global sort, and a line that a
third of all rows repeat is one key of a partial count. Ranks of whole documents are worked out
where the document is: only lines that stand more than once anywhere are sent on.

On demand runs of fewer lines count as well, if they have many words or are a whole document. Ranks
then grow line by line, and each carries the words of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.tables import KEY, keyed, same_key, written

_BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _words(line: str) -> Column:
    """How many words a line has: the pieces that are left once what stands between them is one blank."""
    spaced = F.btrim(F.regexp_replace(line, _BETWEEN_WORDS, " "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.size(F.split(spaced, " "))).cast("bigint")


def _rank(*values: Column | str) -> Column:
    """128 bits as two numbers."""
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(7919), *values, F.lit(104729)).alias("b"))


def _repeated(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose rank stands at two places or more."""
    counts = suffixes.groupBy("rank").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("rank")
    return suffixes.join(counts, "rank", "left_semi")


def _doubled(suffixes: DataFrame, offset: int) -> DataFrame:
    """Ranks of pairs: a suffix and the one ``offset`` lines on, where that is still ranked."""
    on = F.lead(F.struct("line", "rank"), offset).over(Window.partitionBy(*KEY).orderBy("line"))
    # With every line between there, the row ``offset`` on is the line ``offset`` on.
    found = suffixes.withColumn("_on", on).where(F.col("_on.line") == F.col("line") + offset)
    return found.select(*KEY, "line", _rank("rank.a", "rank.b", "_on.rank.a", "_on.rank.b").alias("rank"))


def remove_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 3, words: int | None = None
) -> DataFrame:
    """(doc_id, _h, n_lines, n_removed, n_runs, kept_text, runs) of every row.

    A line is removed if it is part of ``least`` or more lines in a row that also stand earlier: in a
    document of smaller id or further up in its own. With ``words``, fewer lines that stand earlier are
    removed too if they have more than so many words, or have any and are a whole document. Lines end at a line feed; lines without any word
    count like others. ``runs`` are the maximal removed runs (first line from 0, lines). A null or
    empty text is one empty line and keeps it; ``kept_text`` are the other lines, each as it was.
    Documents without an id come first, those of one id in the order of a hash of the text ``_h``;
    rows that repeat id and text are one document and fare alike. An empty table gives no rows.
    """
    rows = keyed(docs, doc_id, text)
    lines = rows.select(*KEY, F.posexplode(F.split("text", "\n")).alias("line", "value"))
    first = lines.select(*KEY, "line", _rank("value").alias("rank"))
    if words is None:
        copies = _copies(_repeated_lines(first), least)
    else:
        # The outer form builds the array once; a plain explode looks at its size first.
        split = rows.select(*KEY, F.split("text", "\n").alias("lines"))
        first = split.select(*KEY, F.size("lines").alias("size"), F.posexplode_outer("lines").alias("line", "value"))
        first = first.select(*KEY, "size", "line", _rank("value").alias("rank"), _words("value").alias("own"))
        copies = _copies_of_words(_repeated_lines(first), least, words)
    runs = written(_runs(copies), "line-runs")
    # Always a shuffle of the texts: the runs grow with them, so no size of theirs is one to rely on.
    joined = rows.join(runs.hint("merge"), same_key(rows, runs), "left")
    joined = joined.select(rows["doc_id"], rows["_h"], "text", "runs")
    split = F.split("text", "\n")
    none = F.array().cast("array<struct<first:int,lines:int>>")
    runs_ = F.coalesce(F.col("runs"), none)
    # Kept stretches lie before, between and after the runs.
    starts = F.concat(F.array(F.lit(0)), F.transform(runs_, lambda r: r["first"] + r["lines"]))
    ends = F.concat(F.transform(runs_, lambda r: r["first"]), F.array(F.size(split)))
    stretches = F.transform(
        F.arrays_zip(starts.alias("from"), ends.alias("to")),
        lambda s: F.slice(split, s["from"] + 1, F.greatest(s["to"] - s["from"], F.lit(0))),
    )
    removed = F.aggregate(runs_, F.lit(0), lambda total, r: total + r["lines"])
    return joined.select(
        "doc_id",
        "_h",
        F.size(split).alias("n_lines"),
        removed.alias("n_removed"),
        F.size(runs_).alias("n_runs"),
        F.when(F.col("runs").isNull(), F.col("text"))
        .otherwise(F.array_join(F.flatten(stretches), "\n"))
        .alias("kept_text"),
        runs_.alias("runs"),
    )


def _repeated_lines(first: DataFrame) -> DataFrame:
    """Places of lines that stand more than once, each once however often its row is repeated."""
    return written(_repeated(first).dropDuplicates([*KEY, "line"]), "line-ranks")


def _copies(suffixes: DataFrame, least: int) -> DataFrame:
    """Places where ``least`` lines begin that also begin earlier."""
    have = 1
    while have < least:
        offset = min(have, least - have)
        suffixes = written(_repeated(_doubled(suffixes, offset)), "line-ranks")
        have += offset
    return _later(suffixes, least)


def _copies_of_words(suffixes: DataFrame, least: int, words: int) -> DataFrame:
    """The same, and places of fewer lines with more than ``words`` words or of a whole document."""
    suffixes = suffixes.withColumn("words", F.col("own"))
    found = []
    for have in range(1, least):
        whole = (F.col("line") == 0) & (F.col("size") == have) & (F.col("words") > 0)
        found.append(_later(suffixes, have, (F.col("words") > words) | whole))
        row = F.struct("line", "rank", "words")
        on = F.lead(row, 1).over(Window.partitionBy(*KEY).orderBy("line"))
        grown = suffixes.withColumn("_on", on).where(F.col("_on.line") == F.col("line") + 1)
        grown = grown.select(
            *KEY, "size", "line", "own",
            _rank("rank.a", "rank.b", "_on.rank.a", "_on.rank.b").alias("rank"),
            (F.col("own") + F.col("_on.words")).alias("words"),
        )
        suffixes = written(_repeated(grown), "line-ranks")
    copies = _later(suffixes, least)
    for short in found:
        copies = copies.unionByName(short)
    return copies


def _later(suffixes: DataFrame, lines: int, wanted: Column | str = "true") -> DataFrame:
    """(key, line, lines) of the ``wanted`` places of each rank, but for its first one."""
    originals = suffixes.groupBy("rank").agg(F.min(F.struct(*KEY, "line")).alias("least"))
    return suffixes.join(originals, "rank").where(
        F.struct(*KEY, "line") != F.col("least")
    ).where(wanted).select(*KEY, "line", F.lit(lines).alias("lines"))


def _runs(copies: DataFrame) -> DataFrame:
    """(key, runs) of the documents that have any: copies joined where they meet or overlap."""
    by_line = Window.partitionBy(*KEY).orderBy("line")
    copies = copies.withColumn("end", F.col("line") + F.col("lines"))
    reach = F.max("end").over(by_line.rowsBetween(Window.unboundedPreceding, -1))
    copies = copies.withColumn("_new", (reach.isNull() | (reach < F.col("line"))).cast("int"))
    copies = copies.withColumn("_run", F.sum("_new").over(by_line))
    runs = copies.groupBy(*KEY, "_run").agg(F.min("line").alias("first"), F.max("end").alias("end"))
    run = F.struct("first", (F.col("end") - F.col("first")).alias("lines"))
    return runs.groupBy(*KEY).agg(F.array_sort(F.collect_list(run)).alias("runs"))
