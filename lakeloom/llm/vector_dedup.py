"""Embedding near-duplicates on a robust-pruned flat graph.

Equal vectors of a label are one class. Per label, a hash sample of about one in
``PER_CENTRE`` classes (``CENTRES`` at most) are centres, and each class joins the shards of
its ``OVERLAP`` nearest. A shard of more than ``BLOCK`` classes is cut into blocks by hash.
In each block a graph is built: the candidates of a node, its nearest and some drawn at
random, are robust-pruned to ``DEGREE``, and edges are laid both ways. The lists a node has
from its shards are united. Then every class is searched: from the block's medoid a greedy
search with a beam, whose range widens through every node near enough, until none is left.
All blocks of a shard are searched by all others, so a large group costs more tasks, not
larger ones, and a task asks ``ASKED`` queries at a time, so a block of nothing but near
copies holds two flags a pair and no more. Links are verified by cosine in double precision on the given vectors.

A pair may share several shards; it is counted in the first that both have. Each task
reports counts and a spanning star of the links it found, never pairs. ``recall`` measures
what the search finds against all pairs for every row whose id is divisible by 100.

Nulls, empty vectors, ties: a vector that is null, empty, zero or holds a null or
non-finite component, or has no label, links with nothing; its component is its own id.
Vectors of different lengths do not link. Rows that repeat a vec_id with one vector are
copies, linked with each other. A row without an id links with nothing, has no component
and is kept. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import pin
from .common import components

SIMILARITY = 0.98
PER_CENTRE = 600
CENTRES = 4096
CHUNK = 4096
OVERLAP = 3
BLOCK = 2000
DEGREE = 24
CANDIDATES = 64
DRAWN = 32
ALPHA = 1.2
BEAM = 16
ASKED = 256
PAIRS = 1 << 15
SLACK = 0.03  # how far below the similarity the range goes on


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows ``i`` of ``a`` with rows ``j`` of ``b``, ``PAIRS`` at a time."""
    out = np.empty(len(i), a.dtype)
    for at in range(0, len(i), PAIRS):
        part = slice(at, at + PAIRS)
        out[part] = (a[i[part]] * b[j[part]]).sum(1)
    return out


def robust_graph(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Neighbours of each row: candidates pruned where a closer one already leads there."""
    n = len(x)
    if n < 2:
        return [np.empty(0, np.int64)] * n
    near = x.astype(np.float32) @ x.T.astype(np.float32)
    np.fill_diagonal(near, -2)
    k = min(CANDIDATES, n - 1)
    drawn = np.random.default_rng(seed).integers(0, n, (n, DRAWN))
    options = np.concatenate((np.argpartition(-near, k - 1, 1)[:, :k], drawn), 1)
    rows = np.arange(n)[:, None]
    closeness = near[rows, options]
    order = np.argsort(-closeness, 1, kind="stable")
    options, closeness = options[rows, order], closeness[rows, order]
    distance = np.maximum(1 - closeness, 0)
    alive = closeness > -2
    out: list[list[int]] = [[] for _ in range(n)]
    for _ in range(DEGREE):
        some = np.flatnonzero(alive.any(1))
        if not len(some):
            break
        first = alive[some].argmax(1)
        pick = options[some, first]
        for p, q in zip(some.tolist(), pick.tolist(), strict=True):
            out[p].append(q)
            out[q].append(p)
        leads = ALPHA * np.maximum(1 - near[pick[:, None], options[some]], 0) <= distance[some]
        same = options[some] == pick[:, None]
        alive[some] &= ~(leads | same)
    return [np.unique(np.array(o[: 3 * DEGREE], np.int64)) for o in out]


def search(queries: np.ndarray, x: np.ndarray, lists: np.ndarray, start: int, least: float) -> np.ndarray:
    """For each query the rows of ``x`` found at least ``least`` similar, as a table of flags.

    Greedy from ``start`` with a beam of ``BEAM``; every row within the range met on the way
    is opened too, until the range is used up. ``lists`` holds neighbours, filled with -1.
    """
    n, m = len(queries), len(x)
    q, x = queries.astype(np.float32), x.astype(np.float32)
    met = np.zeros((n, m + 1), bool)
    met[:, m] = True  # where the filling of lists leads
    inside = np.zeros((n, m), bool)
    opened = np.zeros((n, m), bool)
    beam = np.full((n, BEAM), m)
    value = np.full((n, BEAM), -2.0, np.float32)
    fresh = np.zeros((n, BEAM), bool)
    beam[:, 0], fresh[:, 0], met[:, start] = start, True, True
    value[:, 0] = q @ x[start]
    inside[:, start] = value[:, 0] >= least
    active = np.arange(n)
    while len(active):
        best = np.where(fresh[active], value[active], -3).argmax(1)
        pick = beam[active, best]
        fresh[active, best] = False
        opened[active, pick] = True
        found = lists[pick]
        new = ~met[active[:, None], found]
        met[active[:, None], found] = True
        sim = np.where(new, np.einsum("nrd,nd->nr", x[np.minimum(found, m - 1)], q[active]), -2)
        rows, cols = np.nonzero(sim >= least)
        inside[active[rows], found[rows, cols]] = True
        ids = np.concatenate((beam[active], np.where(new, found, m)), 1)
        sims = np.concatenate((value[active], sim.astype(np.float32)), 1)
        flags = np.concatenate((fresh[active], new), 1)
        top = np.argpartition(-sims, BEAM - 1, 1)[:, :BEAM]
        at = np.arange(len(active))[:, None]
        beam[active], value[active], fresh[active] = ids[at, top], sims[at, top], flags[at, top]
        active = active[fresh[active].any(1)]
    todo = np.argwhere(inside & ~opened)
    while len(todo):
        following = []
        for part in np.array_split(todo, -(-len(todo) // 2000)):
            opened[part[:, 0], part[:, 1]] = True
            found = lists[part[:, 1]]
            new = ~met[part[:, :1], found]
            who, what = np.divmod(np.unique((part[:, :1] * (m + 1) + found)[new]), m + 1)
            met[who, what] = True
            close = dots(q, x, who, what) >= least
            inside[who[close], what[close]] = True
            following.append(np.stack((who[close], what[close]), 1))
        todo = np.concatenate(following)
    return inside


def _assigned(classes: DataFrame) -> DataFrame:
    """Adds to each class its shards: the nearest centres of its label, in order of number."""

    def nearest(members: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(members):
            return pd.DataFrame({"node": [], "centres": []})
        centres = centres.sort_values("place")
        given, to = unit(matrix(members["embedding"])), unit(matrix(centres["embedding"])).T
        k = min(OVERLAP, to.shape[1])
        top = []
        for at in range(0, len(given), ASKED):
            far = -(given[at : at + ASKED] @ to)
            top += list(np.sort(np.argpartition(far, k - 1, 1)[:, :k], 1))
        return pd.DataFrame({"node": members["node"].to_numpy(), "centres": top})

    sizes = classes.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.least(F.lit(CENTRES), F.ceil(F.col("n") / PER_CENTRE))
    chunks = F.ceil(F.col("n") / CHUNK)
    order = Window.partitionBy("family").orderBy(F.xxhash64("node"), "node")
    ranked = classes.select("family", "embedding", F.row_number().over(order).alias("place"))
    centres = ranked.where(F.col("place") <= CENTRES).join(sizes, "family").where(F.col("place") <= wanted)
    centres = centres.select(
        "family", "place", "embedding", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk")
    )
    centres = pin(centres, "centres")
    dealt = classes.join(sizes, "family").select(
        "family", "node", "embedding", F.pmod(F.xxhash64("node"), chunks).alias("chunk")
    )
    keys = ["family", "chunk"]
    found = dealt.groupBy(*keys).cogroup(centres.groupBy(*keys)).applyInPandas(
        nearest, "node bigint, centres array<bigint>"
    )
    return classes.join(found, "node")


def _near(classes: DataFrame, similarity: float) -> DataFrame:
    """Rows ``(node, n_links, root)``: what each task found for each of its classes."""
    assigned = pin(_assigned(classes), "assigned")
    posted = assigned.select("*", F.explode("centres").alias("centre"))
    sizes = posted.groupBy("family", "centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = posted.join(sizes, ["family", "centre"]).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))
    )
    members = pin(members, "members")

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        nodes = shard["node"].to_numpy()
        lists = robust_graph(unit(matrix(shard["embedding"])))
        return pd.DataFrame({"node": nodes, "lists": [nodes[o] for o in lists]})

    graph = members.select("family", "centre", "block", "node", "embedding")
    graph = graph.groupBy("family", "centre", "block").applyInPandas(build, "node bigint, lists array<bigint>")
    graph = pin(graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("lists"))).alias("lists")), "graph")

    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    tasks = members.join(graph, "node").select("*", other).select(
        "family", "centre", "node", "embedding", "copies", "centres", "lists", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )

    def look(task: pd.DataFrame) -> pd.DataFrame:
        low, high, centre = task["low"].iloc[0], task["high"].iloc[0], task["centre"].iloc[0]
        target = task[task["block"] == high].sort_values("node")
        asking = task[task["block"] == low].sort_values("node")
        if not len(target) or not len(asking):
            return pd.DataFrame({"node": [], "n_links": [], "root": []})
        nodes = target["node"].to_numpy()
        given, asked = matrix(target["embedding"]), matrix(asking["embedding"])
        x, q = unit(given), unit(asked)
        width = max(max(map(len, target["lists"])), 1)
        lists = np.full((len(nodes), width), len(nodes))
        for k, own in enumerate(target["lists"]):
            own = np.asarray(own, np.int64)
            place = np.minimum(np.searchsorted(nodes, own), len(nodes) - 1)
            place = place[nodes[place] == own]
            lists[k, : len(place)] = place
        medoid = int((x @ x.mean(0)).argmax())
        lengths_of_asked, lengths = np.sqrt((asked * asked).sum(1)), np.sqrt((given * given).sum(1))
        slices = range(0, len(q), ASKED)
        linked = np.zeros((len(q), len(x)), bool)
        for at in slices:
            who, what = np.nonzero(search(q[at : at + ASKED], x, lists, medoid, similarity - SLACK))
            who += at
            near = dots(asked, given, who, what) / (lengths_of_asked[who] * lengths[what]) >= similarity
            linked[who[near], what[near]] = True
        asks, copies_of_asks, copies = asking["node"].to_numpy(), asking["copies"].to_numpy(), target["copies"].to_numpy()
        if low == high:
            linked = np.triu(linked | linked.T, 1)
        of_asks, of_targets = matrix(asking["centres"]), matrix(target["centres"])
        every = np.unique(np.concatenate((asks, nodes)))
        left, right = np.searchsorted(every, asks), np.searchsorted(every, nodes)
        links, root = np.zeros(len(every), np.int64), np.arange(len(every))
        for at in slices:
            who, what = np.nonzero(linked[at : at + ASKED])
            who += at
            shared = np.full(len(who), np.inf)
            for own in of_asks.T:
                common = (own[who, None] == of_targets[what]).any(1)
                shared = np.where(common, np.minimum(shared, own[who]), shared)
            first = shared == centre
            np.add.at(links, left[who[first]], copies[what[first]])
            np.add.at(links, right[what[first]], copies_of_asks[who[first]])
        while True:
            before = root.copy()
            for at in slices:
                who, what = np.nonzero(linked[at : at + ASKED])
                u, v = left[who + at], right[what]
                least = np.minimum(root[u], root[v])
                np.minimum.at(root, u, least)
                np.minimum.at(root, v, least)
            root = root[root]
            if (root == before).all():
                break
        return pd.DataFrame({"node": every, "n_links": links, "root": every[root]})

    return tasks.groupBy("family", "centre", "low", "high").applyInPandas(
        look, "node bigint, n_links bigint, root bigint"
    )


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one per row of ``vectors``."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & (F.when(~bad, norm) > 0), F.lit(False)
    )
    family = F.concat_ws("/", F.size("embedding").cast("string"), "label")
    keys = {"family": family, "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")}
    rows = rows.withColumns({k: F.when(usable, v) for k, v in keys.items()})
    same = ["family", "h1", "h2"]
    grouped = rows.where("h1 IS NOT NULL").groupBy(*same).agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    classes = pin(grouped, "classes")
    found = pin(_near(classes.select("family", "node", "copies", "embedding"), similarity), "found")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    tied = components(edges)
    counts = found.groupBy("node").agg(F.sum("n_links").alias("links"))
    judged = classes.drop("embedding").join(counts, "node", "left").join(tied, "node", "left").select(
        *same,
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("root"),
    )
    return rows.drop("embedding").join(judged, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def recall(vectors: DataFrame, judged: DataFrame, similarity: float = SIMILARITY, every: int = 100) -> float:
    """Links found over links there are, for rows whose id is divisible by ``every``, against all rows."""
    cosine = "aggregate(zip_with(x, y, (a, b) -> a * b), 0D, (s, v) -> s + v) / sqrt(nx * ny)"
    square = "aggregate(embedding, 0D, (s, v) -> s + v * v)"
    sized = vectors.selectExpr("vec_id", "label", "CAST(embedding AS array<double>) AS embedding")
    sized = sized.selectExpr("vec_id", "label", "embedding", f"{square} AS n").where("n > 0")
    asked = sized.where(F.col("vec_id") % every == 0).selectExpr("vec_id AS id", "label", "embedding AS x", "n AS nx")
    pairs = asked.hint("broadcast").join(sized.selectExpr("vec_id", "label", "embedding AS y", "n AS ny"), "label")
    true = pairs.where(f"id <> vec_id AND {cosine} >= {similarity} AND NOT isnan({cosine})").groupBy("id").count()
    both = true.join(judged, F.col("id") == F.col("vec_id")).agg(F.sum("count"), F.sum(F.least("count", "n_links")))
    there, found = both.first()
    return 1.0 if not there else found / there
