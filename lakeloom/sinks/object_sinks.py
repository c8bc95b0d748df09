"""Sinks for fetched objects.

A load decides on names alone, then the tasks that write the winners read their bytes. What
is counted is what the write has done: an object that could not be read is failed, and
the key goes to the next candidate in order, as if the failed one had not been offered.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.media import content_type
from ..operators.landing import (
    FIRST,
    LAST,
    group_candidates,
    outcome_counts,
    outcome_items,
    pick_winners,
    set_aside,
    with_presence,
)
from ..session import pin
from .layer import Layer
from .parts import digests, one_each, read_parts, references
from .registry import sink


def new_load_id() -> str:
    """A name for a load that is given none, after the time it was made."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def write_objects(chosen: DataFrame, layer: Layer, load_id: str, attempt: int = 0) -> tuple[DataFrame, bool]:
    """Write the objects of a written table of names ``(target_key, length, path, start)``.

    Returns rows ``(target_key, content_type, length, parts, sha256, error)``, read from
    what was written without its bytes, and whether any object failed.
    """
    seen = Observation()
    parts = read_parts(chosen).withColumns(
        {"content_type": content_type(F.col("target_key")), "attempt": F.lit(attempt)}
    )
    parts = parts.observe(seen, F.count("error").alias("failed"))
    path = layer.write(parts, load_id, mode="append" if attempt else "overwrite")
    written = chosen.sparkSession.read.schema(layer.schema).parquet(path).where(F.col("attempt") == attempt)
    named = digests(written).withColumn("content_type", content_type(F.col("target_key")))
    return named, bool(seen.get["failed"])


def commit(written: DataFrame, layer: Layer, load_id: str) -> None:
    """The objects written without an error have landed."""
    whole = written.where("error IS NULL")
    layer.commit(whole.select("target_key", "content_type", "length", "parts", "sha256"), load_id)


@dataclass(frozen=True)
class Decision:
    """What a load does with its candidates: written tables without bytes."""

    groups: DataFrame
    winners: DataFrame
    mode: str

    def counts(self) -> DataFrame:
        """Rows ``(source_type, status, n)``."""
        return outcome_counts(self.groups, self.winners, self.mode)

    def items(self) -> DataFrame:
        """Rows ``(source_type, target_key, object_id, reason, status, n)``."""
        return outcome_items(self.groups, self.winners, self.mode)

    def without(self, broken: DataFrame) -> DataFrame:
        """The next candidates of the keys whose winners ``broken`` could not be read."""
        rest = set_aside(self.groups, broken).join(broken.select("target_key").distinct(), "target_key", "left_semi")
        return pick_winners(rest, self.mode)


def fetched(objects: DataFrame) -> DataFrame:
    """Names of the objects that were fetched, each once; cells are written to files first."""
    refs = references(objects.where("length IS NOT NULL"))
    return one_each(pin(refs, "references") if "content" in objects.columns else refs)


def decide_groups(groups: DataFrame, layer: Layer, mode: str, load_id: str) -> Decision:
    """Choose the winner of each key among written groups; the layer is read but not changed."""
    winners = pin(pick_winners(groups, mode), "winners")
    if mode == FIRST:
        winners = pin(layer.unlanded(winners, ["target_key"], load_id), "fresh")
    return Decision(groups, winners, mode)


def decide(
    candidates: DataFrame, objects: DataFrame, layer: Layer, mode: str, load_id: str
) -> Decision:
    """Choose the winner of each key; the layer is read but not changed.

    The choice is written down before the layer changes: what is counted later is
    what was decided, and no later step repeats the extraction of links. Of the
    objects only their names are read.
    """
    groups = pin(with_presence(group_candidates(candidates), fetched(objects)), "groups")
    return decide_groups(groups, layer, mode, load_id)


def carry_out(decision: Decision, layer: Layer, load_id: str) -> Decision:
    """Write the winners, and for those that fail the next in order; what has landed in the end.

    Rounds end: each sets aside at least one object of every key it is about.
    """
    layer.open_keys(decision.groups.sparkSession)
    place = ["source_ord", "source_type", "target_key", "object_id"]
    names = ["target_key", "length", "path", "start"]
    turn, landed, named, broken = decision.winners, None, None, None
    attempt = 0
    while True:
        written, failed = write_objects(turn.select(*names), layer, load_id, attempt)
        if failed:
            written = pin(written, "written")
        wrong = written.where("error IS NOT NULL").select("target_key")
        won = turn.join(wrong, "target_key", "left_anti") if failed else turn
        landed = won if landed is None else landed.unionByName(won)
        named = written if named is None else named.unionByName(written)
        if not failed:
            break
        lost = turn.join(wrong, "target_key", "left_semi").select(*place)
        broken = pin(lost if broken is None else broken.unionByName(lost), "broken")
        turn = pin(decision.without(broken).join(wrong, "target_key", "left_semi").select(*turn.columns), "turn")
        attempt += 1
        if turn.isEmpty():
            break
    commit(named, layer, load_id)
    groups = decision.groups if broken is None else pin(set_aside(decision.groups, broken), "groups")
    return replace(decision, groups=groups, winners=landed)


def land(
    candidates: DataFrame, objects: DataFrame, layer: Layer, mode: str, load_id: str | None = None
) -> DataFrame:
    """Decide on keys, write the bytes, return counts ``(source_type, status, n)`` of what was done.

    ``objects`` are files, ``(object_id, length, path)``, stretches of files with
    ``start``, or cells ``(object_id, length, content)``.
    """
    load_id = load_id or new_load_id()
    decision = decide(candidates, objects, layer, mode, load_id)
    return carry_out(decision, layer, load_id).counts()


@sink("s3")
def keep_first(
    candidates: DataFrame, objects: DataFrame, layer: Layer, load_id: str | None = None
) -> DataFrame:
    """Object sink: a key that exists is skipped, so the first writer stays."""
    return land(candidates, objects, layer, FIRST, load_id)


@sink("local")
def keep_last(
    candidates: DataFrame, objects: DataFrame, layer: Layer, load_id: str | None = None
) -> DataFrame:
    """Overwriting sink: the last writer stays, in a load and across loads.

    Earlier loads are not rewritten; :meth:`Layer.latest` is the table as it now
    stands, and :func:`rewrite` makes a fresh copy without replaced rows.
    """
    return land(candidates, objects, layer, LAST, load_id)


def rewrite(layer: Layer, fresh: Layer, spark: SparkSession, load_id: str | None = None) -> Layer:
    """Write the newest version of each object to another, empty root."""
    if fresh.root == layer.root:
        raise ValueError("a layer cannot be rewritten onto the path it is read from")
    load_id = load_id or new_load_id()
    fresh.open_keys(spark)
    rows = layer.latest(spark).withColumns({"attempt": F.lit(0), "error": F.lit(None).cast("string")})
    path = fresh.write(rows, load_id)
    written = spark.read.schema(fresh.schema).parquet(path)
    commit(digests(written).withColumn("content_type", content_type(F.col("target_key"))), fresh, load_id)
    return fresh
