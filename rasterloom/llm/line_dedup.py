"""Line dedup: repeated windows of three consecutive lines, found globally, lose their later occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, needs, stored


def _windows(lines: Column, size: int) -> Column:
    """The 16-byte digests of every run of ``size`` line digests; none where there are fewer lines."""
    starts = F.when(F.size(lines) >= size, F.sequence(F.lit(0), F.size(lines) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.unhex(F.md5(F.concat(*[F.get(lines, i + k) for k in range(size)]))))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """docs with repeated lines taken out of ``text_col``, plus n_lines and n_removed.

    Lines end at a line feed. Every ``window`` consecutive lines of a document are one window; the windows overlap.
    Of windows with equal lines the first, by (id, text hash, position), stays; all lines that a later one covers go,
    overlapping ones merged. Documents with fewer lines lose nothing. Each repeated window's first place is stored
    before the windows meet it, so the occurrences of a very common window can be split over tasks.

    Nulls: a null text has no lines and stays null; a null id comes first in the order. Ties and repeated rows: rows
    that repeat both id and text are one document for the order, so each gets that document's verdict. An emptied
    document stays, with an empty text. Other columns pass through; a column already named n_lines or n_removed keeps
    its name and the new one gets a leading underscore.
    """
    needs(docs, id_col, text_col)
    own, digest = fresh_name(docs.columns, "dedup_lines"), fresh_name(docs.columns, "dedup_text_hash")
    n_lines, n_removed = fresh_name(docs.columns, "n_lines"), fresh_name(docs.columns, "n_removed")

    hashed = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("h"),
        F.transform(F.split(text_col, "\n", -1), lambda x: F.md5(x)).alias("lines"),
    )
    windows = hashed.select("id", "h", F.posexplode(_windows(F.col("lines"), window)).alias("pos", "key")).select(
        "key", F.struct("id", "h", "pos").alias("at")
    )
    first = (
        windows.groupBy("key").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .filter(F.col("first") != F.col("last")).drop("last")
    )
    later = windows.join(stored(first, "first-windows"), "key").filter(F.col("at") != F.col("first"))
    of_id, of_hash, starts, kept_at = (fresh_name(docs.columns, f"dedup_{c}") for c in ("of_id", "of_hash", "starts", "kept_at"))
    covered = later.groupBy(F.col("at.id").alias(of_id), F.col("at.h").alias(of_hash)).agg(F.collect_set("at.pos").alias(starts))

    joined = docs.withColumn(digest, F.xxhash64(text_col)).join(
        covered, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(digest) == F.col(of_hash)), "left"
    )
    lines = joined.withColumn(own, F.split(text_col, "\n", -1))
    spread = F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (window - 1))))
    rest = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), spread)
    kept = lines.withColumn(kept_at, F.when(F.col(starts).isNotNull(), rest))
    text = F.when(F.col(kept_at).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept_at, lambda i: F.get(F.col(own), i)), "\n")
    )
    return kept.select(
        *[(text if c == text_col else F.col(c)).alias(c) for c in docs.columns],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(own)).alias(n_lines),
        F.when(F.col(kept_at).isNull(), 0).otherwise(F.size(own) - F.size(kept_at)).alias(n_removed),
    )


def op1_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), windows AS (
  SELECT doc_id, p, ls[p] || chr(10) || ls[p + 1] || chr(10) || ls[p + 2] AS w
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM lines)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT DISTINCT doc_id, p + o AS i FROM later, (VALUES (0), (1), (2)) t(o)
), each AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM lines
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t
  FROM each ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(l.ls), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(l.ls), 0) - coalesce(k.n, 0) AS INTEGER) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
