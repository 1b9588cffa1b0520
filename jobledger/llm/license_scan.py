"""License notices found by ordered signature rules over words, in DataFrame operations alone.

Texts are lower-cased in A-Z and cut into words; a rule is a regular expression over whole words. A
document is looked at by a rule only if it has the rule's keyword, and by any rule only if it has a
piece of a word that stands in some keyword. What a rule finds is an interval of words. An interval that lies within one of a rule of
better priority, or of a longer one of its own priority, is suppressed, except for the base phrases,
which always count.

Rules are written word by word: ``word?`` is optional, ``[..]`` and ``(a|b)`` are as in any regular
expression. They are in ``license_rules``.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.license_rules import ANCHORS, lines
from jobledger.llm.tables import KEY, id_and_text, lower_ascii, same_key, written

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"


@dataclass(frozen=True)
class Rule:
    label: str
    words: str
    keyword: str  # words that every match contains
    priority: int  # 1 is best, 0 a base phrase

    @property
    def pattern(self) -> str:
        """The rule over text in which every word stands between two spaces of its own."""
        return "".join(
            f"(?: {word[:-1]} )?" if word.endswith("?") else f" {word} " for word in self.words.split()
        )

    @property
    def gate(self) -> str:
        return "  ".join(self.keyword.split())


# Fixed values of the task: base phrases and their labels.
BASE = (
    Rule("cc-by", "cc by", "cc by", 0),
    Rule("gpl", "general public license", "general public license", 0),
    Rule("reserved", "all rights reserved", "rights reserved", 0),
)

def rules() -> tuple[Rule, ...]:
    """All rules in order: base phrases and the signatures."""
    signatures = (Rule(label, words, keyword, int(priority)) for label, priority, keyword, words in lines())
    return (*BASE, *signatures)


CONFIDENCE = {0: 0.75, 1: 1.0, 2: 0.875, 3: 0.625, 4: 0.25}


def _words_in(text: Column) -> Column:
    """Words in a piece of text in which every word stands between two spaces of its own."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("int")


def _any_anchor(text: Column, table: tuple[Rule, ...]) -> Column:
    """Whether a text has a piece of a word that a keyword of the table has: plain searches, no pattern."""
    anchors = [anchor for anchor in ANCHORS if any(anchor in rule.gate for rule in table)]
    # Keywords of other tables bring their own first word.
    anchors += [rule.gate.split()[0] for rule in table if not any(anchor in rule.gate for anchor in ANCHORS)]
    return functools.reduce(operator.or_, [F.contains(text, F.lit(anchor)) for anchor in dict.fromkeys(anchors)])


def detections(docs: DataFrame, table: tuple[Rule, ...]) -> DataFrame:
    """(key, number, label, priority, first, last) of every match: words ``first`` to ``last`` - 1.

    ``docs``: (key, words), the words of a text each between two spaces of its own.
    """
    each = F.array(*[
        F.struct(F.lit(i).alias("number"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                 F.lit(r.gate).alias("gate"), F.lit(r.pattern).alias("pattern"))
        for i, r in enumerate(table)
    ])
    gated = F.filter(each, lambda rule: F.contains(F.col("words"), rule["gate"]))
    tried = docs.select(*KEY, "words", F.explode(gated).alias("rule"))
    hits = F.regexp_extract_all("words", F.col("rule.pattern"), F.lit(0))
    tried = tried.select(*KEY, "words", "rule", hits.alias("hits")).where(F.size("hits") > 0)
    # The text between the matches gives their places.
    gaps = F.split("words", F.col("rule.pattern"), -1)
    parts = F.transform(
        F.arrays_zip(gaps.alias("gap"), F.col("hits").alias("hit")),
        lambda part: F.struct(_words_in(part["gap"]).alias("gap"), _words_in(part["hit"]).alias("hit")),
    )
    parts = tried.select(*KEY, "rule.number", "rule.label", "rule.priority", F.posexplode(parts).alias("at", "part"))
    parts = parts.where("part.hit IS NOT NULL")
    up_to = Window.partitionBy(*KEY, "number").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum(F.col("part.gap") + F.col("part.hit")).over(up_to)
    return parts.select(*KEY, "number", "label", "priority", (last - F.col("part.hit")).alias("first"), last.alias("last"))


def kept(found: DataFrame) -> DataFrame:
    """Detections that no other suppresses. Base phrases (priority 0) neither suppress nor fall."""
    own = found.where("priority > 0")
    by_start = Window.partitionBy(*KEY).orderBy("first").rangeBetween(Window.unboundedPreceding, 0)
    for level in sorted(CONFIDENCE)[1:-1]:
        reach = F.max(F.when(F.col("priority") == level, F.col("last"))).over(by_start)
        own = own.withColumn(f"reach_{level}", reach)
    same = Window.partitionBy(*KEY, "priority").orderBy("first", F.desc("last"), "number")
    own = own.withColumn("reach_own", F.max("last").over(same.rowsBetween(Window.unboundedPreceding, -1)))
    hidden = F.coalesce(F.col("reach_own") >= F.col("last"), F.lit(False))
    for level in sorted(CONFIDENCE)[1:-1]:
        better = (F.col("priority") > level) & (F.col(f"reach_{level}") >= F.col("last"))
        hidden |= F.coalesce(better, F.lit(False))
    return found.where("priority = 0").unionByName(own.where(~hidden).select(*found.columns))


def license_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table: tuple[Rule, ...] | None = None
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``n_base`` counts the places of base phrases, the next two are the smallest and largest word they
    begin at, from 0, null without any. Labels are distinct, sorted and joined by commas. ``score``
    is the confidence of the surest detection that stays, 0 without any. A null or empty text has no
    words; rows that repeat id and text get the same result each. An empty table gives no rows.
    """
    table = table or rules()
    lower = lower_ascii(F.col("text"))
    rows = id_and_text(docs, doc_id, text).select("doc_id", F.xxhash64("text").alias("_h"), lower.alias("text"))
    trimmed = F.regexp_replace("text", f"^{BREAK}+|{BREAK}+$", "")
    words = F.concat(F.lit(" "), F.regexp_replace(trimmed, f"{BREAK}+", "  "), F.lit(" "))
    scanned = rows.select(
        *KEY,
        F.regexp_count("text", F.lit(f"{WORD}+")).cast("bigint").alias("n_words"),
        F.when(_any_anchor(F.col("text"), table), words).alias("words"),
    )
    scanned = written(scanned, "license-words")
    looked_at = scanned.where("words IS NOT NULL").select(*KEY, "words")
    looked_at = looked_at.groupBy(*KEY).agg(F.any_value("words").alias("words"))
    found = kept(written(detections(looked_at, table), "license-found"))
    base = F.col("priority") == 0
    confidence = F.element_at(F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair]), F.col("priority"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    summed = found.groupBy(*KEY).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max(confidence).alias("score"),
    )
    scanned = scanned.select(*KEY, "n_words")
    return scanned.join(summed, same_key(scanned, summed), "left").select(
        scanned["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def sql(lower: str, table: tuple[Rule, ...] | None = None) -> str:
    """The scan of ``documents`` in SQL; ``lower`` is the lower-cased text."""
    table = table or rules()
    quote = lambda text: text.replace("'", "''")
    values = ", ".join(
        f"({i}, '{quote(r.label)}', {r.priority}, '{quote(r.gate)}', '{quote(r.pattern)}')" for i, r in enumerate(table)
    )
    reach = ", ".join(
        f"max(CASE WHEN priority = {p} THEN last END) OVER (PARTITION BY doc_id ORDER BY first RANGE UNBOUNDED PRECEDING) AS reach_{p}"
        for p in sorted(CONFIDENCE)[1:-1]
    )
    hidden = " OR ".join(f"coalesce(priority > {p} AND reach_{p} >= last, false)" for p in sorted(CONFIDENCE)[1:-1])
    confidence = " ".join(f"WHEN {p} THEN {c}::DOUBLE" for p, c in CONFIDENCE.items())
    return f"""WITH rules(number, label, priority, gate, pattern) AS (VALUES {values}),
low AS (SELECT doc_id, {lower} AS t FROM documents),
texts AS (SELECT doc_id, CAST(len(regexp_extract_all(t, '{WORD}+')) AS BIGINT) AS n_words, ' ' ||
    regexp_replace(regexp_replace(t, '^{BREAK}+|{BREAK}+$', '', 'g'), '{BREAK}+', '  ', 'g') || ' ' AS words FROM low),
tried AS (SELECT doc_id, number, label, priority, string_split_regex(words, pattern) AS gaps,
    regexp_extract_all(words, pattern) AS hits FROM texts JOIN rules ON contains(words, gate)),
parts AS (SELECT doc_id, number, label, priority, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit,
    unnest(range(len(hits))) AS pos FROM tried),
counted AS (SELECT *, (length(gap) - length(replace(gap, ' ', ''))) // 2 AS g,
    (length(hit) - length(replace(hit, ' ', ''))) // 2 AS h FROM parts),
placed AS (SELECT *, CAST(sum(g + h) OVER (PARTITION BY doc_id, number ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS last FROM counted),
found AS (SELECT doc_id, number, label, priority, last - h AS first, last FROM placed),
ranked AS (SELECT *, {reach}, max(last) OVER (PARTITION BY doc_id, priority ORDER BY first, last DESC, number
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach_own FROM found WHERE priority > 0),
kept AS (SELECT doc_id, label, priority, first FROM found WHERE priority = 0 UNION ALL
    SELECT doc_id, label, priority, first FROM ranked WHERE NOT (coalesce(reach_own >= last, false) OR {hidden})),
summed AS (SELECT doc_id, count(*) FILTER (priority = 0) AS n_base, min(first) FILTER (priority = 0) AS first_word,
    max(first) FILTER (priority = 0) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (priority = 0))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(CASE priority {confidence} END) AS score
    FROM kept GROUP BY doc_id)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, coalesce(score, 0) AS score FROM texts LEFT JOIN summed USING (doc_id)"""
