"""Quality rules whose cutoffs come with a bound on how many good documents they reject.

A document that fails a base rule goes. Beyond that, five measures of a text (larger is worse, whole
numbers) get a cutoff for every stratum, such as a language, from labelled documents that the base
rules keep. Cutoffs of a measure are tested from the most lenient one on: k of n good documents of
the stratum reach it, and it is certified while P(Binomial(n, alpha / measures) <= k) is at most
delta / (strata * measures), up to the first cutoff that is not. That is the exact (Clopper-Pearson)
upper bound of the rate, corrected over strata and measures (Bonferroni); along a measure the order
of the tests is fixed, so it needs no correction of its own. With a probability of 1 - delta, the
measures together then reject no more than ``alpha`` of the good documents of any stratum, of which
the labelled ones are a random sample. Of the certified cutoffs the one with the largest difference
between the shares of bad and of good documents rejected is taken, the most lenient of equal ones.
A stratum with too few labels has no certified cutoff, and only the base rules hold there.

All of it is column expressions and joins. Words of a text are sorted within its row.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.tables import written
from jobledger.plans.skew import lookup_join

#: What separates words.
BLANK = " \t\n\x0b\x0c\r"
#: The measures, each with its value as whole numbers over the counts of a text.
MEASURES = {
    "symbols": "least(1000 * n_symbols div n_words, 1000)",
    "repeats": "1000 * n_repeat_words div n_words",
    "lines": "1000 * n_dup_lines div n_lines",
    "capitals": "1000 * n_capitals div word_chars",
    "length": "least(10 * word_chars div n_words, 1000)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(words: Column) -> Column:
    """How many words stand in a window of three words that the text has twice or more."""

    def sorted_windows(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 3)
        return F.array_sort(
            F.transform(
                places,
                lambda i: F.struct(
                    F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
                    i.alias("i"),
                ),
            )
        )

    def twice(windows: Column) -> Column:
        """Places, ascending, of the windows that are next to an equal one when sorted."""
        beside = F.filter(
            windows,
            lambda x, j: (F.get(windows, j + 1)["h"] == x["h"]) | (F.get(windows, j - 1)["h"] == x["h"]),
        )
        return F.array_sort(F.transform(beside, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda i, j: F.least(F.coalesce(F.get(places, j + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    counted = _bind(words, lambda w: _bind(sorted_windows(w), lambda s: _bind(twice(s), covered)))
    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(counted)


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, ``COUNTS``) for every row of ``docs``, all counts long.

    Words are runs without blanks. A null text has none. ``stratum`` is text and never null: a
    missing stratum is one of its own.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        named.alias("stratum"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    blank = F.lit(BLANK)
    parts = F.split(F.btrim("text", blank), r"[\x20\x09-\x0D]+")
    words = F.when(F.btrim("text", blank) == "", F.array().cast("array<string>")).otherwise(parts)
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, blank) != "")
    rows = rows.withColumns({"_words": words, "_lines": lines})
    return rows.select(
        "doc_id",
        "stratum",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))).cast("bigint").alias("n_capitals"),
    )


def _ln_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series at n + 8 and the seven factors too many."""
    x = n.cast("double") + 8
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    whole = (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + series
    return whole - F.ln(functools.reduce(operator.mul, [n.cast("double") + i for i in range(1, 8)]))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k) for k up to n * rate, exact but for rounding.

    Terms fall off below k; ten standard deviations and 50 terms below it they are under 1e-20 of it.
    """
    start = _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
    start = F.exp(start + k * math.log(rate) + (n - k) * math.log1p(-rate))
    terms = F.least(k, F.ceil(10 * F.sqrt(n * rate * (1 - rate))) + 50).cast("int")
    zero = F.struct(start.alias("term"), start.alias("total"))

    def step(state: Column, j: Column) -> Column:
        i = k - j  # from the term of i + 1 to that of i
        term = state["term"] * (i + 1) / (n - i) * ((1 - rate) / rate)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    below = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(below, zero, step, lambda state: state["total"])


def cutoffs(labelled: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(stratum, measure, cutoff, n_good, n_rejected, tail): the cutoffs that hold, from rows
    (stratum, good boolean, ``MEASURES``) of documents with a label.

    A document is rejected where its measure is the cutoff or more. Rows are counted by (stratum,
    measure, value) in every task first; a measure has up to 1,001 values.
    """
    rate = alpha / len(MEASURES)
    values = ", ".join(f"'{name}', {name}" for name in MEASURES)
    long = labelled.selectExpr("stratum", "good", f"stack({len(MEASURES)}, {values}) AS (measure, value)")
    bins = long.groupBy("stratum", "measure", "value").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    one = Window.partitionBy("stratum", "measure")
    down = one.orderBy(F.col("value").desc())
    tested = bins.select(
        "stratum",
        "measure",
        F.col("value").alias("cutoff"),
        F.sum("good").over(one).alias("n_good"),
        F.sum("bad").over(one).alias("n_bad"),
        F.sum("good").over(down).alias("n_rejected"),
        F.sum("bad").over(down).alias("bad_rejected"),
    )
    tests = bins.agg(F.count_distinct("stratum")).scalar() * len(MEASURES)
    k, n = F.col("n_rejected"), F.col("n_good")
    # Above n * rate the tail is well over any level in use.
    tail = F.when(k <= n * rate, binomial_tail(k, n, rate)).otherwise(F.lit(1.0))
    tested = tested.where("n_good > 0 AND n_bad > 0").withColumn("tail", tail)
    # The tail grows with the rejections, so what is certified ends at the first one that is not.
    certified = tested.where(F.col("tail") * tests <= delta)
    gain = F.col("bad_rejected") / F.col("n_bad") - F.col("n_rejected") / F.col("n_good")
    best = F.max_by(F.struct("cutoff", "n_good", "n_rejected", "tail"), F.struct(gain, "cutoff")).alias("best")
    chosen = certified.where(gain > 0).groupBy("stratum", "measure").agg(best)
    return chosen.select("stratum", "measure", "best.*")


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    alpha: float = 0.02,
    delta: float = 0.05,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    rejected_by) for every row of ``docs``, repeated rows too.

    ``labels`` has ``doc_id`` and ``label``, 1 for a good document and 0 for a bad one; a null label
    is none, and of several labels of an id the largest counts. Rows without an id have no label but
    are judged like all others. ``base_failed`` is true for fewer than 50 words, so for null and
    empty texts, or where more than half of the words stand in repeated windows of three. ``kept``
    is false for those and for documents that reach a cutoff of their stratum; ``rejected_by`` names
    the measures whose cutoffs they reach, in order, and is empty otherwise. Without labels no
    cutoff holds; an empty table gives no rows.
    """
    found = written(counts(docs, doc_id, text, stratum), "quality-counts")
    # Without words the base rules decide; a measure then is 0.
    measured = found.selectExpr(
        "*", f"{BASE} AS base_failed",
        *[f"coalesce(if(n_words > 0, {value}, 0), 0) AS {name}" for name, value in MEASURES.items()],
    )
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("doc_id"))
    known = known.agg((F.max(label) == 1).alias("good"))
    tried = measured.where("NOT base_failed").select("doc_id", "stratum", *MEASURES).join(known, "doc_id")
    chosen = cutoffs(tried.select("stratum", "good", *MEASURES), alpha, delta)
    wide = chosen.groupBy("stratum").agg(
        *[F.max(F.when(F.col("measure") == name, F.col("cutoff"))).alias(f"_{name}") for name in MEASURES]
    )
    limits = written(wide, "quality-cutoffs")
    judged = lookup_join(measured, limits, "stratum", ["doc_id", *COUNTS])
    reached = F.array(*[F.when(F.col(name) >= F.col(f"_{name}"), F.lit(name)) for name in MEASURES])
    rejected = F.when(F.col("base_failed"), F.lit("")).otherwise(F.array_join(reached, ","))
    return judged.withColumn("rejected_by", rejected).select(
        "doc_id",
        *COUNTS[:5],
        "base_failed",
        (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"),
        "rejected_by",
    )


def sql(alpha: float = 0.02, delta: float = 0.05) -> str:
    """The same in DuckDB's SQL."""
    rate = alpha / len(MEASURES)
    blank = r"[\x20\x09-\x0D]"
    values = ", ".join(
        f"CASE WHEN n_words > 0 THEN {value.replace(' div ', ' // ')} ELSE 0 END AS {name}"
        for name, value in MEASURES.items()
    )
    each = " UNION ALL ".join(f"SELECT lang, good, '{m}' AS measure, {m} AS value FROM tried" for m in MEASURES)
    limits = ", ".join(f"max(cutoff) FILTER (measure = '{m}') AS c_{m}" for m in MEASURES)
    named = ", ".join(f"CASE WHEN {m} >= c_{m} THEN '{m}' END" for m in MEASURES)
    return f"""WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents),
places AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM texts),
threes AS (SELECT doc_id, i, w AS a, lead(w) OVER d AS b, lead(w, 2) OVER d AS c FROM places
    WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM threes
    WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
counted AS (SELECT t.doc_id, lang, len(words) AS n_words, CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '[A-Z]')) AS n_capitals FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id),
measured AS (SELECT *, {BASE} AS base_failed, {values.replace("// n_lines", "// greatest(n_lines, 1)")} FROM counted),
known AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
tried AS (SELECT m.*, good FROM measured m JOIN known USING (doc_id) WHERE NOT base_failed),
bins AS (SELECT lang, measure, value AS cutoff, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
    FROM ({each}) GROUP BY ALL),
tested AS (SELECT lang, measure, cutoff, sum(good) OVER o AS n, sum(bad) OVER o AS b,
    sum(good) OVER (PARTITION BY lang, measure ORDER BY cutoff DESC) AS k,
    sum(bad) OVER (PARTITION BY lang, measure ORDER BY cutoff DESC) AS r
    FROM bins WINDOW o AS (PARTITION BY lang, measure)),
tails AS (SELECT lang, measure, cutoff, n, b, k, r, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({rate}) + (n - i) * ln(1 - {rate}))) AS tail FROM (SELECT *, unnest(range(CAST(k AS BIGINT) + 1)) AS i
    FROM tested WHERE n > 0 AND b > 0 AND k <= n * {rate}) GROUP BY ALL),
chosen AS (SELECT lang, measure, max_by(cutoff, struct_pack(g := r / b - k / n, c := cutoff)) AS cutoff FROM tails
    WHERE r / b - k / n > 0 AND tail * (SELECT count(*) * {len(MEASURES)} FROM (SELECT DISTINCT lang FROM tried))
    <= {delta} GROUP BY lang, measure),
limits AS (SELECT lang, {limits} FROM chosen GROUP BY lang),
judged AS (SELECT m.*, CASE WHEN base_failed THEN '' ELSE concat_ws(',', {named}) END AS rejected_by
    FROM measured m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND rejected_by = '' AS kept, rejected_by FROM judged"""
