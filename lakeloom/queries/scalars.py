"""Lists, names, links and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import page_links
from ..functions.media import content_type
from ..functions.urls import (
    archive_name,
    basename,
    dataset_slug,
    download_name,
    join_url_list,
    parse_url_list,
    resolve_all,
    second_or_first,
    target_key,
)
from ..operators.links import file_rows, file_targets, link_rows
from ..operators.lists import choose_list, join_url_rows, second_or_first_rows, url_rows
from ..operators.split import split
from ..sinks.layer import layer_path
from ..sources.scans import read_pages
from .catalog import query, table
from .derived import ctes, derived

# Oracle twins. Links are found there in two simple steps that suit the given
# pages, not by the library's pattern.
URL_ROWS_SQL = f"""
{ctes("part_lists")},
url_rows AS (
    SELECT p_partkey, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS url
    FROM (SELECT p_partkey, list_filter(list_transform(string_split(urls, ','),
                 lambda x: trim(x)), lambda x: x <> '') AS l FROM part_lists)
)"""


def links_sql(pages: str) -> str:
    return f"""
link_lists AS (
    SELECT page_id, url, regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g'),
        '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hrefs
    FROM {pages}
),
links AS (
    SELECT page_id, url, generate_subscripts(hrefs, 1) - 1 AS link_pos, unnest(hrefs) AS href
    FROM link_lists
),
placed AS (
    SELECT *, regexp_extract(url, '^https?://[^/?#]*') AS host,
           regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path
    FROM links
),
folders AS (
    SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS folder,
           regexp_replace(CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END,
                          '[^/]+/$', '') AS parent
    FROM placed
),
files AS (
    SELECT page_id, url AS page_url, link_pos, href,
           host || CASE WHEN href LIKE '/%' THEN href WHEN href LIKE '../%'
               THEN parent || substr(href, 4) ELSE folder || href END AS file_url
    FROM folders
)"""


@query(f"WITH {URL_ROWS_SQL} SELECT * FROM url_rows")
def url_list_scan(spark: SparkSession, folder: str) -> DataFrame:
    return url_rows(derived(spark, folder, "part_lists"), "urls", ["p_partkey"])


@query("SELECT page_id, url, length(html) AS n_chars FROM pages")
def page_scan(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_pages(spark, f"{folder}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query(f"""
WITH {URL_ROWS_SQL},
slugs AS (SELECT *, nullif(regexp_extract(url, 'kaggle\\.com/datasets/([^/]+/[^/]+)', 1), '') AS slug
          FROM url_rows)
SELECT p_partkey, pos, slug, replace(slug, '/', '_') || '.zip' AS archive_name,
       split_part(slug, '/', 2) || '.zip' AS download_name
FROM slugs
""")
def dataset_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = url_list_scan(spark, folder).withColumn("slug", dataset_slug(F.col("url")))
    slug = F.col("slug")
    return rows.select(
        "p_partkey",
        "pos",
        "slug",
        archive_name(slug).alias("archive_name"),
        download_name(slug).alias("download_name"),
    )


@query(f"""
WITH {URL_ROWS_SQL}
SELECT p_partkey, pos, url,
       CASE WHEN regexp_matches(url, 'kaggle\\.com/datasets/[^/]+/[^/]+') THEN 'accepted'
            ELSE 'rejected' END AS verdict,
       CASE WHEN NOT regexp_matches(url, 'kaggle\\.com/datasets/[^/]+/[^/]+')
            THEN 'no_dataset_name' END AS reason
FROM url_rows
""")
def dataset_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    unnamed = dataset_slug(F.col("url")).isNull()
    rows = url_list_scan(spark, folder).withColumn(
        "reason", F.when(unnamed, F.lit("no_dataset_name"))
    )
    done = split(rows, F.col("reason").isNull(), "named")
    return done.valid.withColumn("verdict", F.lit("accepted")).unionByName(
        done.quarantine.withColumn("verdict", F.lit("rejected"))
    )


@query(f"WITH {links_sql('pages')} SELECT page_id, link_pos, href FROM links")
def page_link_rows(spark: SparkSession, folder: str) -> DataFrame:
    return link_rows(table(spark, folder, "pages"))


@query(f"""
WITH {ctes("index_pages")}, {links_sql("index_pages")}
SELECT page_id, link_pos, href FROM links WHERE suffix(href, '.csv')
""")
def suffix_links(spark: SparkSession, folder: str) -> DataFrame:
    return link_rows(derived(spark, folder, "index_pages"), ".csv")


@query(f"""
WITH {links_sql("pages")},
named AS (SELECT *, substr(href, 2) AS name FROM folders)
SELECT page_id, link_pos, shape, resolved FROM (
    SELECT page_id, link_pos, unnest(['rooted', 'relative', 'here', 'parent', 'query', 'fragment',
               'host', 'absolute', 'dots', 'mail', 'empty']) AS shape,
           unnest([host || href, host || folder || name, host || folder || name,
               host || parent || name, host || path || '?v=' || name,
               regexp_replace(url, '#.*$', '') || '#' || name,
               regexp_extract(url, '^https?:') || '//cdn.example.net' || href,
               'https://files.example.org' || href, host || '/a/' || name || '.csv',
               'mailto:' || name, url]) AS resolved
    FROM named)
""")
def resolved_links(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    linked = pages.select("page_id", "url", F.inline(page_links(F.col("html"))))
    href, name = F.col("href"), F.substring("href", 2, 2**31 - 1)

    def text(*parts: object) -> object:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    shapes = {
        "rooted": href,
        "relative": name,
        "here": text("./", name),
        "parent": text("../", name),
        "query": text("?v=", name),
        "fragment": text("#", name),
        "host": text("//cdn.example.net", href),
        "absolute": text("https://files.example.org", href),
        "dots": text("/x/../a/./", name, ".csv"),
        "mail": text("mailto:", name),
        "empty": F.lit(""),
    }
    names = F.array(*map(F.lit, shapes)).alias("shape")
    resolved = resolve_all(F.col("url"), F.array(*shapes.values())).alias("resolved")
    return linked.select("page_id", "link_pos", F.inline(F.arrays_zip(names, resolved)))


@query(f"""
WITH {ctes("index_pages")}, {links_sql("index_pages")}
SELECT page_id, link_pos, file_url, regexp_extract(file_url, '[^/]*$') AS file_name,
       'raw/' || regexp_extract(file_url, '[^/]*$') AS target_key
FROM files
""")
def file_keys(spark: SparkSession, folder: str) -> DataFrame:
    files = file_targets(file_rows(derived(spark, folder, "index_pages"), suffix=None), "raw")
    return files.select(
        "page_id",
        "link_pos",
        "file_url",
        basename(F.col("file_url")).alias("file_name"),
        "target_key",
    )


@query(f"""
WITH {ctes("object_names")}
SELECT doc_id, target_key,
       CASE WHEN target_key LIKE '%.csv' OR target_key LIKE '%.csv.gz' THEN 'text/csv'
            WHEN target_key LIKE '%.JSON' THEN 'application/json'
            ELSE 'application/octet-stream' END AS content_type
FROM (SELECT doc_id, CASE WHEN name LIKE '/%' OR destination = '' THEN name
                          WHEN destination LIKE '%/' THEN destination || name
                          ELSE destination || '/' || name END AS target_key FROM object_names)
""")
def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = target_key(F.col("destination"), F.col("name"))
    keys = derived(spark, folder, "object_names").select("doc_id", key.alias("target_key"))
    return keys.withColumn("content_type", content_type(F.col("target_key")))


@query(f"""
WITH {ctes("object_names")}
SELECT doc_id, CASE WHEN lake <> 'my_lake' AND layer <> 'copper' THEN
       lake || '-' || layer || '/' || CASE WHEN name LIKE '/%' OR destination = '' THEN name
           WHEN destination LIKE '%/' THEN destination || name
           ELSE destination || '/' || name END END AS object_path
FROM object_names
""")
def layer_paths(spark: SparkSession, folder: str) -> DataFrame:
    path = layer_path(F.col("lake"), F.col("layer"), F.col("destination"), F.col("name"))
    return derived(spark, folder, "object_names").select("doc_id", path.alias("object_path"))


@query(f"""
WITH {URL_ROWS_SQL}
SELECT p_partkey, coalesce(max(CASE WHEN pos = 1 THEN url END),
                           max(CASE WHEN pos = 0 THEN url END)) AS url,
       string_agg(url, ',' ORDER BY pos) AS urls
FROM url_rows GROUP BY p_partkey
""")
def second_or_first_list(spark: SparkSession, folder: str) -> DataFrame:
    listed = derived(spark, folder, "part_lists").withColumn("l", parse_url_list(F.col("urls")))
    return listed.select(
        "p_partkey",
        second_or_first(F.col("l")).alias("url"),
        join_url_list(F.col("l")).alias("urls"),
    )


@query("""
SELECT user_id, event_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r,
           count(*) OVER (PARTITION BY user_id) AS n FROM events)
WHERE r = least(n, 2)
""")
def second_or_first_event(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    return second_or_first_rows(events, ["user_id"], ["event_id"])


@query(f"""
WITH {links_sql("pages")}
SELECT page_id, string_agg(href, ',' ORDER BY link_pos) AS urls FROM links GROUP BY page_id
""")
def url_list_join(spark: SparkSession, folder: str) -> DataFrame:
    return join_url_rows(link_rows(table(spark, folder, "pages")), ["page_id"], "link_pos", "href")


@query("""
SELECT s_suppkey, 'KAGGLE_URLS' AS list_key,
       'https://www.kaggle.com/datasets/' || lower(s_name) || '/a,https://example.org/' || s_name
           AS urls
FROM supplier
""")
def chosen_url_list(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    lower = F.lower("s_name")
    archives = F.array(
        F.concat(F.lit("https://www.kaggle.com/datasets/"), lower, F.lit("/a")),
        F.concat(F.lit("https://example.org/"), F.col("s_name")),
    )
    crawled = F.array(F.concat(F.lit("https://example.org/"), lower))
    lists = F.array(
        F.struct(F.lit("KAGGLE_URLS").alias("list_key"), archives.alias("urls")),
        F.struct(F.lit("CRAWLER_URLS").alias("list_key"), crawled.alias("urls")),
    )
    rows = supplier.select("s_suppkey", F.inline(lists))
    return choose_list(rows, F.col("list_key"), F.col("urls"), "KAGGLE_URLS")
