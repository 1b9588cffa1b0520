"""Spelling variants: words one inserted, deleted or replaced code point apart, found without a list
of candidates.

The vocabulary's prefixes are the nodes of a trie and its suffixes those of a trie of the reversed
words; both are numbered. A word split at a place is the pair (node before it, node after it), and a
word with one code point skipped is the pair of nodes around that one. Words that share a pair by a
skip at the same place differ in that code point alone, and a word whose skip is the split of another
one is that word with a code point inserted. A pair stands for one text and one place, so its words
are at most as many as there are letters, whatever the size of the vocabulary; what a pair gives
each of its words (how many are near, and the best of them) is worked out in place and summed up by
word, so no table of all near pairs is made.

A node is known by a digest of 128 bits of its path, each made of the one before and a code point, so
a word of any length costs as many digests as it has letters. Short prefixes are in very many words:
they are joined to their numbers by ``lookup_join``, which spreads keys with many rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.llm.tables import written
from jobledger.plans.skew import lookup_join

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_OUTSIDE = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Code points of a text looked at in one go, to the end of a run; code points of words held by a task.
PIECE, HELD = 1 << 20, 1 << 22


def _runs(text: bytes) -> Iterator[list[str]]:
    """The runs of letters of a text with A-Z in lower case, in lists of a piece of the text each."""
    lower = text.translate(_LOWER).decode("utf-8", "replace")
    at = 0
    while at < len(lower):
        end = at + PIECE
        if end < len(lower):
            outside = _OUTSIDE.search(lower, end)
            end = outside.start() if outside else len(lower)
        yield _RUN.findall(lower, at, end)
        at = end


def slip(doc_id: int | None, word: str, every: int) -> str:
    """The word without one code point, in one of ``every`` cases, as a hash of id and word has it."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, least_length: int, least_count: int, doc_id: str, text: str, slip_every: int | None
) -> DataFrame:
    """(word, n) of all words of ``least_length`` code points that stand ``least_count`` times or more.

    Every task sends a row for a word each time its table of words is full, not one for each place.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        held = 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found: Counter[str] = Counter()
                for runs in _runs(value.as_py() or b""):
                    found.update(runs)
                for word, n in found.items():
                    if len(word) >= least_length and slip_every is not None:
                        word = slip(key, word, slip_every)
                    if len(word) < least_length:
                        continue
                    before = total.get(word)
                    if before is None:
                        held += len(word)
                        total[word] = n
                    else:
                        total[word] = before + n
                if held > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values())], schema=schema)
                    total, held = {}, 0
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values())], schema=schema)

    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _paths(words: DataFrame, backwards: bool) -> DataFrame:
    """(word_id, n, at, path, fresh): the digest of the first ``at`` code points of every word, for
    ``at`` from 0 to its length, of the reversed word if ``backwards``. ``fresh``: the code point
    after them is another than the one before it, or there is none before."""
    names = ["word_id", "n", "at", "path", "fresh"]
    most = 1 << 16

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], []]
        for batch in batches:
            for word_id, word, n in zip(*(column.to_pylist() for column in batch.columns)):
                letters = word[::-1] if backwards else word
                path, before = b"", ""
                for at in range(len(letters) + 1):
                    after = letters[at] if at < len(letters) else ""
                    for column, value in zip(rows, (word_id, n, at, path, after != before)):
                        column.append(value)
                    path = hashlib.blake2b(path + after.encode("utf-32-le"), digest_size=16).digest()
                    before = after
                    if len(rows[0]) >= most:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), names=names)
                        rows = [[], [], [], [], []]
        if rows[0]:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), names=names)

    return words.select("word_id", "word", "n").mapInArrow(
        walk, "word_id bigint, n bigint, at bigint, path binary, fresh boolean"
    )


def _numbered(words: DataFrame, backwards: bool) -> DataFrame:
    """``_paths`` with ``node``, the number of the trie node, in place of the digest."""
    label = "suffix" if backwards else "prefix"
    paths = written(_paths(words, backwards), f"spelling-{label}-paths")
    nodes = paths.select("path").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = written(nodes, f"spelling-{label}-nodes")
    return lookup_join(paths, nodes, "path", ["word_id", "at"]).drop("path")


def near_words(words: DataFrame) -> DataFrame:
    """(word_id, n_near, best) from (word_id, word, n) with ids in the order of the words.

    ``best`` is the near word of largest n, of equal ones the first: a struct of its negative n and
    its id. Words without a near one are left out.
    """
    before = _numbered(words, False).withColumnRenamed("node", "before")
    length = F.length("word").cast("bigint").alias("length")
    after = _numbered(words, True).join(words.select("word_id", length), "word_id")
    # What follows a split is the rest of the word; what follows a skip lacks one code point.
    rest = F.col("length") - F.col("at")
    after = after.select(
        "word_id",
        F.col("node").alias("after"),
        F.explode(F.array(F.struct(rest.alias("at"), F.lit(False).alias("skip")),
                          F.struct((rest - 1).alias("at"), F.lit(True).alias("skip")))).alias("_p"),
    ).select("word_id", "after", "_p.at", "_p.skip").where("at >= 0")
    word = F.struct((-F.col("n")).alias("neg_n"), "word_id", "fresh")
    pairs = before.join(after, ["word_id", "at"]).groupBy("before", "after").agg(
        F.array_sort(F.collect_list(F.when(F.col("skip"), word))).alias("skips"),
        F.max(F.when(~F.col("skip"), F.struct((-F.col("n")).alias("neg_n"), "word_id"))).alias("whole"),
    )
    pairs = pairs.where((F.size("skips") > 1) | ((F.size("skips") == 1) & F.col("whole").isNotNull()))

    def plain(x):
        return F.struct(x["neg_n"].alias("neg_n"), x["word_id"].alias("word_id"))

    # A letter of a run can be left out at each place of the run with the same outcome; the first counts.
    shorter = F.col("fresh") & F.col("whole").isNotNull()
    best_other = F.when(F.col("n_skips") > 1, F.when(F.col("i") == 0, plain(F.get("skips", F.lit(1))))
                        .otherwise(plain(F.get("skips", F.lit(0)))))
    alike = pairs.select("skips", "whole", F.size("skips").alias("n_skips"), F.posexplode("skips").alias("i", "x"))
    alike = alike.select("*", "x.fresh").select(
        F.col("x.word_id").alias("word_id"),
        (F.col("n_skips") - 1 + shorter.cast("int")).alias("n_near"),
        F.array_min(F.filter(F.array(best_other, F.when(shorter, F.col("whole"))), lambda y: y.isNotNull())).alias("best"),
    )
    longer = pairs.where("whole IS NOT NULL").withColumn("firsts", F.filter("skips", lambda x: x["fresh"]))
    longer = longer.select(
        F.col("whole.word_id").alias("word_id"), F.size("firsts").alias("n_near"), plain(F.get("firsts", F.lit(0))).alias("best")
    )
    found = alike.unionByName(longer).where("n_near > 0")
    return found.groupBy("word_id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(word_id, root): where the links word_id -> form end, by jumps of doubling length.

    Counts double along a chain of forms, so it has 62 links at most and six rounds are enough.
    """
    roots = links.select("word_id", F.col("form_id").alias("root"))
    while True:
        roots = written(roots, "spelling-roots")
        onward = roots.select(F.col("word_id").alias("root"), F.col("root").alias("next"))
        jumped = lookup_join(roots, onward, "root", ["word_id"])
        if not jumped.where("next IS NOT NULL").limit(1).count():
            return roots
        roots = jumped.select("word_id", F.coalesce("next", "root").alias("root"))


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    ratio: int = 2,
    slip_every: int | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its form and the root of its forms.

    Words are longest runs of ``[A-Za-zÀ-ÿ]`` with A-Z in lower case, of ``least_length`` code
    points and ``least_count`` occurrences or more, counted over every row, repeated rows too. Near
    words differ by one inserted, deleted or replaced code point; ``n_near`` counts them. The form is
    the near word of largest n, of equal ones the first in code point order, if it is ``ratio`` times
    as frequent or more (2 at least), else null; ``root`` is where the forms of forms end, the word
    itself without one. ``slip_every`` first plants slips, see ``slip``, as a rehearsal on data
    without any; a missing id counts as an empty one there. Null and empty texts have no words; empty
    tables and tables without such words give no rows. Words and texts may be of any length.
    """
    if ratio < 2:
        raise ValueError("forms need twice the count at least, else they may go in circles")
    counted = word_counts(docs, least_length, least_count, doc_id, text, slip_every)
    # Ids in the order of the words, of code points: the table is in that order.
    words = counted.orderBy("word").withColumn("word_id", F.monotonically_increasing_id())
    words = written(words, "spelling-words")
    near = written(near_words(words), "spelling-near")
    enough = -F.col("best.neg_n") >= F.col("n") * ratio
    links = near.join(words.select("word_id", "n"), "word_id").where(enough)
    links = written(links.select("word_id", F.col("best.word_id").alias("form_id")), "spelling-links")

    named = words.select(F.col("word_id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ends = words.select(F.col("word_id").alias("root_id"), F.col("word").alias("root"))
    linked = lookup_join(links, named, "form_id", ["word_id"]).select("word_id", "form", "form_n")
    roots = _roots(links).withColumnRenamed("root", "root_id")
    linked = linked.join(lookup_join(roots, ends, "root_id", ["word_id"]).select("word_id", "root"), "word_id")
    found = words.join(near.select("word_id", "n_near"), "word_id", "left").join(linked, "word_id", "left")
    return found.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        "form_n",
    )


#: Unsigned crc32 of a text in DuckDB: a CTE of the table of 256 remainders, and the value by it.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(i)))"""


def crc_sql(value: str) -> str:
    codes = f"hex(encode({value}))"
    return f"""xor(4294967295, list_reduce([4294967295] || list_transform(range(1, len({codes}), 2),
        lambda j: ('0x' || substr({codes}, j, 2))::BIGINT), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""


def sql() -> str:
    """The query in DuckDB's SQL, near words by their texts with one code point left out."""
    return f"""WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
marked AS (SELECT w, k, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h
    FROM (SELECT doc_id, w, count(*) AS k FROM runs GROUP BY ALL) CROSS JOIN crc_table WHERE length(w) >= 5),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % 97 = 0 THEN
    left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word FROM marked)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, w.word, w.n FROM cuts a JOIN words w ON a.cut = w.word
    UNION SELECT w.word, a.word, a.n FROM cuts a JOIN words w ON a.cut = w.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY word),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
    CASE WHEN m >= 2 * n THEN m END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (SELECT word, word AS at, form AS next FROM formed
    UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON c.next = f.word)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON f.word = c.word AND c.next IS NULL"""
