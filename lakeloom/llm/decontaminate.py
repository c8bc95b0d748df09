"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed in runs of ``GRAM``; of the runs in each ``WINDOW - GRAM + 1``
consecutive places the smallest hash is kept. Two texts that share ``WINDOW`` words
keep the same run of them, so joining the fingerprints misses no shared window.
Hits are then extended: the windows around each hit are cut out of the document and
joined with the benchmark's windows by their words, so chance hits fall away and
every occurrence is found.

An item of fewer words is one window of its own length. Its fingerprint is that whole
window; documents are fingerprinted in runs of the short lengths that occur (at most
``WINDOW - 1`` of them).

Distinct texts are judged once, whatever the number of their copies. The benchmark's
fingerprints are written down first, so Spark knows their size and sends them to all
tasks only below the session's own limit; beyond it both sides are shuffled.

Arrays are opened by the outer forms of ``explode``: the plain ones bring a filter that
Spark would push below the words, computing them again for each element.

Nulls, empty texts, ties: a null or empty text has no words, and an item without
words has no windows. Items that repeat are counted once by their id; an item
without an id marks words but is not counted. Rows that repeat a doc_id are judged
each by its own text. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

WINDOW = 10
GRAM = 5

# Runs of letters, digits and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters stay as they are.

    ``lower`` says the same where no other letter has a case to lose.
    """
    others = F.rlike(text, F.lit(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"))
    return F.when(others, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _run(n: int, i: str, words: str = "words") -> str:
    """SQL: the ``n`` values from place ``i`` on; each is read by its place, no part is copied."""
    return ", ".join(f"{words}[{i} + {k}]" for k in range(n))


def _grams(n: int) -> str:
    """SQL: a hash of each run of ``n`` words, in order."""
    runs = f"transform(sequence(0, size(words) - {n}), i -> xxhash64({n}, {_run(n, 'i')}))"
    return f"CASE WHEN size(words) >= {n} THEN {runs} ELSE array() END"


def _winnowed(window: int, gram: int) -> str:
    """SQL over ``grams``: the smallest hash of every ``window - gram + 1`` in a row."""
    span = window - gram + 1
    least = f"transform(sequence(0, size(grams) - {span}), i -> least({_run(span, 'i', 'grams')}))"
    return f"CASE WHEN size(grams) >= {span} THEN array_distinct({least}) ELSE array() END"


def _phrases(n: int) -> str:
    """SQL: each run of ``n`` words as text."""
    return f"transform(sequence(0, size(words) - {n}), i -> concat_ws(' ', {_run(n, 'i')}))"


def fingerprints(table: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """Adds ``prints`` to a table with ``words``: winnowed runs, and all runs of short lengths."""
    prints = [F.expr(_winnowed(window, gram)), *(F.expr(_grams(n)) for n in short)]
    return table.withColumn("grams", F.expr(_grams(gram))).withColumn("prints", F.concat(*prints)).drop("grams")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one per document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    items = pin(
        benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(text).alias("words"))
        .where("size(words) > 0")
        .withColumn("length", F.least(F.lit(window), F.size("words"))),
        "items",
    )
    short = sorted(r[0] for r in items.where(F.col("length") < window).select("length").distinct().collect())
    lengths = [*short, window]
    cuts = "CASE " + " ".join(f"WHEN length = {n} THEN {_phrases(n)}" for n in lengths) + " END"
    windows = pin(items.select("item", F.explode_outer(F.expr(cuts)).alias("phrase")).distinct(), "windows")
    # A short item's own print is the run of its length; longer ones have winnowed prints.
    own = " ".join(f"WHEN length = {n} THEN {_grams(n)}" for n in short)
    whole = F.expr(f"CASE {own} END" if short else "CAST(NULL AS array<bigint>)")
    longer = fingerprints(items, window, gram, [])
    prints = longer.select(F.explode_outer(F.coalesce(whole, "prints")).alias("print")).distinct()
    prints = pin(prints, "prints")

    digest = F.md5(F.encode(text, "UTF-8")).alias("digest")
    read = docs.select(digest, words_of(text).alias("words"))
    posted = fingerprints(read, window, gram, short).select("digest", F.explode_outer("prints").alias("print"))
    hits = pin(posted.join(prints, "print").distinct(), "hits")

    # Hits grow with the documents: both sides are shuffled at every size.
    named = hits.select("digest").distinct().hint("merge")
    texts = docs.select(digest, text.alias("text")).join(named, "digest", "left_semi")
    texts = pin(texts.dropDuplicates(["digest"]), "texts")
    found = hits.groupBy("digest").agg(F.collect_set("print").alias("found"))
    opened = texts.join(found, "digest").select("digest", words_of(F.col("text")).alias("words"), "found")

    # All lengths are cut out in one pass over the words.
    cut = []
    for n, length in [(gram, window), *((n, n) for n in short)]:
        hit = f"array_contains(found, xxhash64({n}, {_run(n, 'i')}))"
        places = f"filter(sequence(0, size(words) - {n}), i -> {hit})"
        around = f"transform({places}, p -> sequence(greatest(0, p - {length - n}), p))"
        inside = f"filter(array_distinct(flatten({around})), i -> i + {length} <= size(words))"
        phrase = f"struct(i AS start, {length} AS length, concat_ws(' ', {_run(length, 'i')}) AS phrase)"
        none = f"filter(array(struct(0 AS start, {length} AS length, '' AS phrase)), x -> false)"
        cut.append(f"CASE WHEN size(words) >= {length} THEN transform({inside}, i -> {phrase}) ELSE {none} END")
    starts = opened.select("digest", F.expr(f"inline_outer(concat({', '.join(cut)}))"))

    joined = starts.join(windows, "phrase")
    spans = joined.groupBy("digest").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )
    covered = """aggregate(spans, named_struct('n', 0L, 'end', 0),
        (a, s) -> named_struct('n', a.n + greatest(0, s.start + s.length - greatest(s.start, a.end)),
                               'end', greatest(a.end, s.start + s.length)), a -> a.n)"""
    judged = spans.select(
        "digest",
        F.expr(covered).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    counts = docs.select("doc_id", digest, F.regexp_count(text, F.lit(ANY_CASE)).cast("bigint").alias("n_words"))
    none = spark.sql("SELECT sha2('', 256)").first()[0]
    return counts.join(judged, "digest", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.lit(none)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


# One statement of the same in SQL, by windows alone.
SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
          translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
bw AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n,
              array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS phrase
       FROM (SELECT item, w, unnest(generate_series(1, len(w) - least({WINDOW}, len(w)) + 1)) AS i
             FROM b WHERE len(w) > 0)),
dl AS (SELECT doc_id, i, len(w) AS m, [word, {", ".join(f"lead(word, {k}) OVER p" for k in range(1, WINDOW))}] AS l
       FROM (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d)
       WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
dw AS (SELECT doc_id, i, n, array_to_string(l[1:n], ' ') AS phrase
       FROM dl, (SELECT DISTINCT n FROM bw) WHERE i + n - 1 <= m),
h AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (phrase)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
          SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items,
             sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
