"""The registered queries of the operators, and the same in SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import jobledger
from jobledger.llm import (
    dart_minhash,
    exact_dedup,
    fair_mix,
    license_scan,
    line_runs,
    plane_files,
    prefix_trie,
    quality_rules,
    spelling_variants,
    string_tiling,
    subwords,
    suffix_dedup,
)
from jobledger.llm.tables import lower_ascii, written
from jobledger.plans.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql is not None:
            ORACLE_SQL[run.__name__] = sql
        return run

    return add


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers of the session, once: they import it by name."""
    context = spark.sparkContext
    if getattr(context, "_jobledger_shipped", False):
        return
    root = os.path.dirname(jobledger.__file__)
    path = os.path.join(tempfile.mkdtemp(prefix="jobledger-"), "jobledger.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._jobledger_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids in bit-plane files, read back."""
    import public_tokenizers

    folder = fresh_dir(spark, "ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    plane_files.write_ids(documents(spark, sf_dir), folder, path, end_id=2)
    return plane_files.read_documents(spark, folder)


@query(license_scan.sql(LOWER))
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return license_scan.license_scan(documents(spark, sf_dir))


def predicted(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    settings: subwords.Settings,
    fold: tuple[int, int],
    threshold: float,
) -> DataFrame:
    """Scores of all documents by a model of the labelled ones outside the fold that is held out."""
    docs = documents(spark, sf_dir)
    held_out = subwords.remainder("doc_id", fold[0]) == fold[1]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    model = subwords.train(*subwords.labelled(docs, labels, label, settings), settings)
    return subwords.scored(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query()
def op7_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; case, punctuation and repeated words are part of it."""
    return predicted(spark, sf_dir, "quality", subwords.QUALITY, (5, 0), 0.3)


@query()
def op8_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return predicted(spark, sf_dir, "toxic", subwords.TOXICITY, (3, 1), 0.7)


@query()
def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, named by its smallest id, and the size of the class."""
    found = dart_minhash.near_duplicates(documents(spark, sf_dir))
    sizes = found.groupBy("class_id", "class_h").agg(F.sum("n_rows").alias("class_size"))
    rows = found.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    same = rows["class_id"].eqNullSafe(sizes["class_id"]) & (rows["class_h"] == sizes["class_h"])
    return rows.join(sizes, same).select("doc_id", rows["class_id"], "class_size")


_MIX = """WITH sized AS (SELECT doc_id, source, md5(coalesce(text, '')) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT source, source_size, source_size * 3 AS most,
    CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM sources),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
    - CAST(coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
targets AS (SELECT source, source_size, CAST(coalesce(least(most, weight *
    max(CASE WHEN level * weight <= most THEN level END) OVER ()), most) AS DOUBLE) AS target FROM levels),
queue AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target, e.epoch,
    md5('mix:' || e.epoch || ':' || coalesce(CAST(s.doc_id AS VARCHAR), '') || ':' || s.h) AS mark
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    JOIN (SELECT unnest([1, 2, 3]) AS epoch) e
    ON e.epoch <= CASE WHEN t.source_size > 0 THEN least(ceil(t.target / t.source_size), 3) ELSE 1 END),
sent AS (SELECT *, CASE WHEN target > 0 THEN (sum(size) OVER (PARTITION BY source, epoch
    ORDER BY mark ROWS UNBOUNDED PRECEDING) + (epoch - 1) * source_size) / target
    ELSE CAST(('0x' || substr(mark, 1, 12))::BIGINT AS DOUBLE) / 281474976710656.0 END AS finish FROM queue),
cut AS (SELECT doc_id, sum(size) OVER (ORDER BY finish, mark ROWS UNBOUNDED PRECEDING) AS total FROM sent),
copies AS (SELECT doc_id, count(*) FILTER (total <= (SELECT sum(size) FROM sized)) AS copies FROM cut GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source JOIN copies USING (doc_id)"""


@query(_MIX)
def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    taken = F.col("size") * F.col("copies")
    return fair_mix.fair_mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken")
    )


@query()
def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold half of an item of the benchmark or more, with the item and the tiles."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return string_tiling.contaminated(documents(spark, sf_dir), benchmark).drop("_h")


@query(f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, {LOWER} AS norm FROM documents) WINDOW same AS (PARTITION BY norm)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts, but for the case of A-Z; the largest id stays."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), normalise=lower_ascii, largest=True)


@query()
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that remain once 100-byte strings that begin earlier are removed."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


_RUN_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_RUNS = f"""WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS v,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line,
    len(string_split(coalesce(text, ''), chr(10))) AS size FROM documents),
three AS (SELECT *, lead(v) OVER d AS v2, lead(v, 2) OVER d AS v3, lead(w) OVER d AS w2
    FROM (SELECT *, len(regexp_extract_all(v, '{_RUN_WORD}')) AS w FROM lines) WINDOW d AS (PARTITION BY doc_id ORDER BY line)),
one AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY doc_id, line) AS n FROM three),
two AS (SELECT *, row_number() OVER (PARTITION BY v, v2 ORDER BY doc_id, line) AS n FROM three WHERE v2 IS NOT NULL),
all3 AS (SELECT *, row_number() OVER (PARTITION BY v, v2, v3 ORDER BY doc_id, line) AS n FROM three WHERE v3 IS NOT NULL),
later AS (SELECT doc_id, line, 3 AS k FROM all3 WHERE n > 1
    UNION ALL SELECT doc_id, line, 1 FROM one WHERE n > 1 AND (w > 50 OR (line = 0 AND size = 1 AND w > 0))
    UNION ALL SELECT doc_id, line, 2 FROM two WHERE n > 1 AND (w + w2 > 50 OR (line = 0 AND size = 2 AND w + w2 > 0))),
gone AS (SELECT DISTINCT doc_id, line + unnest(range(k)) AS line FROM later),
marked AS (SELECT l.doc_id, l.line, l.v, g.line IS NOT NULL AS gone FROM lines l LEFT JOIN gone g USING (doc_id, line)),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY line), false) AS first FROM marked)
SELECT doc_id, CAST(count(*) AS INT) AS n_lines, CAST(count(*) FILTER (gone) AS INT) AS n_removed,
    CAST(count(*) FILTER (first) AS INT) AS n_runs,
    md5(coalesce(string_agg(v, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_md5 FROM runs GROUP BY doc_id"""


@query(_RUNS)
def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that remain once runs of three lines or more, of over 50 words, or of a whole document
    that stand earlier are removed."""
    kept = F.md5(F.col("kept_text").cast("binary")).alias("kept_md5")
    found = line_runs.remove_runs(documents(spark, sf_dir), words=50)
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", kept)


@query(quality_rules.sql())
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, and cutoffs that labelled documents certify for each language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.quality_rules(documents(spark, sf_dir), labels)


@query(spelling_variants.sql())
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its form; one in 97 words of a document first loses a letter."""
    return spelling_variants.spelling_variants(documents(spark, sf_dir), slip_every=97)


_TRIE = f"""WITH {spelling_variants.CRC_TABLE},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(struct_pack(role, text) ORDER BY pos) AS own FROM turns GROUP BY conv_id),
hashed AS (SELECT conv_id, own, CAST({spelling_variants.crc_sql("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h
    FROM whole CROSS JOIN crc_table),
rebuilt AS (SELECT c.conv_id, CASE WHEN t.own IS NULL OR h = 0 THEN [] ELSE t.own[1:h] END || c.own[h + 1:] AS seq
    FROM hashed c LEFT JOIN whole t ON t.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (SELECT conv_id, d, CASE WHEN d = 0 THEN [] ELSE seq[1:d] END AS seq, d = len(seq) AS ends
    FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT seq, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE length(seq[d].text) END AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY seq, d),
children AS (SELECT CASE WHEN depth = 1 THEN [] ELSE seq[1:depth - 1] END AS seq, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (SELECT CASE WHEN d = 0 THEN [] ELSE seq[1:d] END AS seq, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (leaf) AS n_leaves
    FROM (SELECT nodes.*, c.n IS NULL AS leaf, unnest(range(depth + 1)) AS d FROM nodes LEFT JOIN children c ON c.seq = nodes.seq) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves,
    CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256 FROM nodes n JOIN below b ON b.seq = n.seq
    LEFT JOIN children c ON c.seq = n.seq LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1
    AND p.seq = CASE WHEN n.depth = 1 THEN [] ELSE n.seq[1:n.depth - 1] END"""


@query(_TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefixes of conversations that were first made to share some."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = written(prefix_trie.placed_turns(conversations), "trie-placed")
    return prefix_trie.prefix_trie(turns.select("conv_id").distinct(), prefix_trie.grafted(turns))
