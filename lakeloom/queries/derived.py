"""Inputs derived from the given tables by SQL that Spark and the oracle both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import table

# name -> (tables it reads, SELECT over them)
DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    # Comma texts with spaces, empty elements, a duplicate, dataset pages with an
    # extra path, a query, or one segment only.
    "part_lists": (
        ("part",),
        """
        SELECT p_partkey,
               ' https://data.example.org/' || lower(p_type)
               || ' ,, https://www.kaggle.com/datasets/' || lower(replace(p_brand, '#', '_'))
               || '/' || replace(p_name, ' ', '-') || CASE WHEN p_size > 25 THEN '/data' ELSE '?v=1' END
               || ',https://data.example.org/' || lower(p_type)
               || ',' || CASE WHEN p_size > 40 THEN '  '
                    ELSE 'https://www.kaggle.com/datasets/' || lower(p_type) END AS urls
        FROM {part}
        """,
    ),
    # Pages whose links ending in "er" or "on" lead to .csv files, some by a
    # relative, a parent or another host's URL, one kind with an entity.
    "index_pages": (
        ("pages",),
        """
        SELECT page_id, url,
               replace(replace(replace(replace(html,
                   'er">', 'er.csv">'),
                   'on">', 'on.csv">'),
                   'href="/d', 'class=k href="d'),
                   'href="/l', 'HREF = "../l') AS html
        FROM {pages}
        """,
    ),
    "listed_urls": (
        ("pages", "supplier"),
        """
        SELECT page_id AS pos, url FROM {pages}
        UNION ALL
        SELECT 1000000000 + s_suppkey, 'https://gone.example.org/' || s_name FROM {supplier}
        """,
    ),
    "object_names": (
        ("documents",),
        """
        SELECT doc_id,
               CASE WHEN source = 'src1' THEN '' WHEN source = 'src2' THEN 'raw/dev/' ELSE 'raw' END
                   AS destination,
               CASE WHEN source = 'src3' THEN '/' ELSE '' END || lang || '-' || cast(doc_id AS string)
               || CASE WHEN lang = 'en' THEN '.csv' WHEN lang = 'fr' THEN '.JSON'
                       WHEN lang = 'de' THEN '.csv.gz' ELSE '.unknown' END AS name,
               CASE WHEN source = 'src4' THEN 'my_lake' ELSE 'lake-' || lang END AS lake,
               CASE WHEN lang = 'es' THEN 'copper' WHEN lang = 'en' THEN 'gold' ELSE 'bronze' END
                   AS layer
        FROM {documents}
        """,
    ),
    # One environment per customer; some parameters missing or invalid, and
    # names that are not the project's.
    "parameters": (
        ("customer",),
        """
        SELECT '/lake/c' || cast(c_custkey AS string) || '/sink/type' AS name,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'local'
                    WHEN c_mktsegment = 'FURNITURE' THEN 'ftp' ELSE 's3' END AS value
        FROM {customer} WHERE c_mktsegment <> 'HOUSEHOLD'
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/sink/bucket_name',
               CASE WHEN c_acctbal < 0 THEN c_name ELSE lower(replace(c_name, '#', '-')) END
        FROM {customer}
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/kaggle/data_source_urls',
               'https://www.kaggle.com/datasets/' || lower(c_mktsegment) || '/a, '
               || CASE WHEN c_acctbal > 5000 THEN 'https://' ELSE 'ftp://' END || 'example.org/b'
        FROM {customer}
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/crawler/data_source_urls',
               CASE WHEN c_nationkey < 5 THEN '' ELSE 'http' || CASE WHEN c_nationkey < 20
                    THEN 's' ELSE '' END || '://example.org/' || c_mktsegment END
        FROM {customer}
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/kaggle/username',
               CASE WHEN c_nationkey = 3 THEN c_name ELSE replace(c_name, '#', '_') END
        FROM {customer}
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/kaggle/key',
               CASE WHEN c_nationkey = 4 THEN upper(md5(c_name))
                    WHEN c_nationkey = 6 THEN '' ELSE md5(c_name) END
        FROM {customer} WHERE c_nationkey <> 8
        UNION ALL
        SELECT '/other/c' || cast(c_custkey AS string) || '/sink/type', c_mktsegment FROM {customer}
        UNION ALL
        SELECT '/lake/c' || cast(c_custkey AS string) || '/sink/type/old', c_mktsegment FROM {customer}
        """,
    ),
    # Records as a local file would hold them.
    "file_settings": (
        ("customer",),
        """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'staging' WHEN c_mktsegment = 'MACHINERY'
                    THEN 'qc' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'prod' ELSE 'dev' END AS stage,
               'c' || cast(c_custkey AS string) AS environment,
               CASE WHEN c_nationkey < 3 THEN NULL WHEN c_nationkey < 12 THEN 's3'
                    WHEN c_nationkey < 22 THEN 'local' ELSE 'gcs' END AS sink_type,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN ''
                    ELSE lower(c_mktsegment) END AS bucket_name,
               CASE WHEN c_acctbal > 8000 THEN NULL WHEN c_acctbal > 7000 THEN ''
                    ELSE '/data/' || lower(c_mktsegment) END AS path,
               CASE WHEN c_acctbal < 2000 THEN '' WHEN c_acctbal < 3000 THEN 'no url'
                    ELSE 'https://www.kaggle.com/datasets/o/' || lower(c_mktsegment) END AS kaggle_urls,
               CASE WHEN c_acctbal > 6000 THEN '' WHEN c_acctbal > 5500 THEN 'https://'
                    ELSE 'http://example.org/' || lower(c_mktsegment) || ',https://example.org' END
                   AS crawler_urls,
               c_nationkey <> 9 AS has_credentials,
               CASE WHEN c_nationkey = 10 THEN NULL ELSE 'raw/dev' END AS destination
        FROM {customer}
        """,
    ),
    # Orders as raw text: padded, with unparsable amounts and re-sent copies.
    "raw_orders": (
        ("orders",),
        """
        SELECT ' ' || cast(o_orderkey AS string) AS o_orderkey,
               cast(o_custkey AS string) || '  ' AS o_custkey,
               lower(o_orderstatus) AS o_orderstatus,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'n/a'
                    ELSE cast(o_totalprice AS string) END AS o_totalprice,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN ' '
                    ELSE cast(cast(o_orderdate AS date) AS string) END AS o_orderdate,
               o_orderpriority, 1 AS sent
        FROM {orders}
        UNION ALL
        SELECT cast(o_orderkey AS string), cast(o_custkey AS string), o_orderstatus,
               cast(o_totalprice AS string), cast(cast(o_orderdate AS date) AS string),
               o_orderpriority, 2
        FROM {orders} WHERE o_orderstatus <> 'O'
        """,
    ),
}


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tables, sql = DERIVED[name]
    return spark.sql(sql, **{t: table(spark, folder, t) for t in tables})


def ctes(*names: str) -> str:
    """``name AS (...)`` for the oracle, comma-joined."""
    parts = []
    for name in names:
        tables, sql = DERIVED[name]
        parts.append(f"{name} AS ({sql.format(**{t: t for t in tables})})")
    return ",\n".join(parts)
