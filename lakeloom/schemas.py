"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SOURCE_URLS = _struct(env=T.StringType(), source_type=T.StringType(), urls=T.StringType())

PAGES = _struct(page_id=T.LongType(), url=T.StringType(), html=T.StringType())

SINK = _struct(type=T.StringType(), bucket_name=T.StringType(), path=T.StringType())

SETTINGS = _struct(
    environment=T.StringType(),
    sink=SINK,
    kaggle_urls=T.ArrayType(T.StringType()),
    crawler_urls=T.ArrayType(T.StringType()),
    has_credentials=T.BooleanType(),
    destination=T.StringType(),
)

PARAMETERS = _struct(name=T.StringType(), value=T.StringType(), type=T.StringType())

# One row per thing a source wants to land. (source_ord, url_pos, link_pos) is
# the order in which the sources name them; object_id finds the fetched bytes;
# reason is set on rows that must not go on.
CANDIDATES = _struct(
    source_ord=T.IntegerType(),
    source_type=T.StringType(),
    url_pos=T.LongType(),
    link_pos=T.LongType(),
    url=T.StringType(),
    object_id=T.StringType(),
    target_key=T.StringType(),
    reason=T.StringType(),
)

# Objects as cells; objects in files have path, and start where they are a stretch of one.
OBJECTS = _struct(object_id=T.StringType(), length=T.LongType(), content=T.BinaryType())

# What Spark's binaryFile source gives.
FILES = _struct(
    path=T.StringType(),
    modificationTime=T.TimestampType(),
    length=T.LongType(),
    content=T.BinaryType(),
)

# A part of a landed object; parts are numbered from 0. Where a part could not be read,
# error says why, and no part of that attempt has landed.
LANDED = _struct(
    target_key=T.StringType(),
    content_type=T.StringType(),
    length=T.LongType(),
    part_no=T.IntegerType(),
    content=T.BinaryType(),
    sha256=T.StringType(),
    attempt=T.IntegerType(),
    error=T.StringType(),
)

OUTCOMES = _struct(source_type=T.StringType(), status=T.StringType(), n=T.LongType())

RUN_OUTCOMES = _struct(
    environment=T.StringType(), source_type=T.StringType(), status=T.StringType(), n=T.LongType()
)
