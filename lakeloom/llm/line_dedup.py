"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a text are hashed (128 bits). A window that occurs again
anywhere, in a later document or later in the same one, covers its three lines there; the
covered lines of a text are merged and go. The first occurrence by doc_id and place stays.

Windows are counted with map-side combining; only those that repeat are joined back, a
join whose popular keys Spark can split. Texts are shuffled once, to meet their lines.

Nulls, empty texts, ties: a null text is empty and has one empty line. A text of fewer
than three lines has no window and stays whole. Rows that repeat a doc_id and text are one
document; with different texts, equal places count as one occurrence. A row without a
doc_id stays whole and removes nothing. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows ``(doc_id, n_lines, n_removed, kept_sha256, kept)``, one per row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    parts = ", ".join(f"lines[i + {k}]" for k in range(window))
    cut = (
        f"CASE WHEN size(lines) >= {window} THEN transform(sequence(0, size(lines) - {window}), "
        f"i -> struct(i AS start, xxhash64({parts}) AS h1, xxhash64({window}, {parts}) AS h2)) END"
    )
    digest = F.xxhash64(text).alias("digest")
    read = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint"), digest, lines.alias("lines"))
    windows = read.select("doc_id", "digest", F.expr(f"inline_outer({cut})")).where("start IS NOT NULL")
    repeated = windows.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")
    ).where("n > 1").drop("n")
    known = windows.join(repeated, ["h1", "h2"])
    # Inside the first document, the first place stays.
    first = known.where("doc_id = first_doc").groupBy("h1", "h2").agg(F.min("start").alias("first_start"))
    later = known.join(first, ["h1", "h2"]).where("doc_id > first_doc OR start > first_start")
    starts = later.groupBy("doc_id", "digest").agg(F.collect_set("start").alias("starts"))
    covered = F.expr(
        f"array_distinct(flatten(transform(starts, s -> sequence(s, s + {window - 1}))))"
    )
    own = docs.select("doc_id", text.alias("text"), digest).join(
        starts.select("doc_id", "digest", covered.alias("gone")).hint("merge"), ["doc_id", "digest"], "left"
    )
    own = own.withColumn("lines", F.split("text", "\n", -1))
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(
            F.expr(
                "transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i])"
            ),
            "\n",
        )
    )
    left = F.when(F.size("gone") == F.size("lines"), F.lit("")).otherwise(left)
    result = own.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_removed"),
        left.alias("kept"),
    )
    return result.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
w AS (SELECT doc_id, line, i, lead(line, 1) OVER p AS l2, lead(line, 2) OVER p AS l3
      FROM e WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, i) AS place
      FROM w WHERE l3 IS NOT NULL),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 2)) AS i FROM o WHERE place > 1),
k AS (SELECT e.doc_id, count(r.i) AS n_removed, count(*) AS n_lines,
             string_agg(line, chr(10) ORDER BY e.i) FILTER (WHERE r.i IS NULL) AS kept
      FROM e LEFT JOIN r USING (doc_id, i) GROUP BY e.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""
