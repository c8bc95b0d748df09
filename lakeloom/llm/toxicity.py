"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Learning. Labels are of documents, so tokens are labelled from them: on a bounded sample of
labelled documents (``SAMPLE`` of each label, by hash of the id), words and their beginnings
get log odds between the labels; tokens of toxic documents whose log odds are high are
toxic, all others are not. The chain has the two tags, and features of a token are the bins
of its own, the previous and the next token's log odds. It is trained by gradient steps on
the likelihood of the sample's segments of ``SEGMENT`` tokens. Scores are then fitted by
logistic regression on what the chain says of the sample's documents.

Scoring. The marginals are those of one chain over the whole text. So that a text of any
length is worked off by rows of ``SEGMENT`` tokens, each row is first reduced to the 2 x 2
matrix that carries a message through it; messages go from row to row by these matrices, and
forward-backward inside the rows starts from them. The marginals of the toxic tag make the
document's score, and runs of toxic tokens its offending spans, as offsets in characters.

Only the text is an input of a score. What is sent to tasks is bounded: ``LEXICON`` entries
and the weights.

Nulls, empty texts, ties: a null or empty text has no tokens and scores as one without
toxic tokens. Without labelled rows of both kinds every score is 0. Labels of one document
that disagree are all taken; labels that are null are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, unused

SAMPLE = 2000
LEXICON = 20_000
SEGMENT = 64
BINS = 9
SEEN = 4  # documents of the sample an entry must occur in
EDGE = b".,;:!?\"'()[]*#$%&"


def forms(word: bytes) -> tuple[bytes, bytes, bytes]:
    """What a token is looked up by: itself and two beginnings of it."""
    return word, word[:5] + b"*", word[:4] + b"*"


def cleaned(text: bytes) -> list[bytes]:
    return [w.strip(EDGE) for w in text.lower().split()]


def bin_of(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(odds) + BINS // 2, 0, BINS - 1).astype(np.int64)


@dataclass
class Chain:
    own: np.ndarray  # weight of the toxic tag by bin
    before: np.ndarray
    after: np.ndarray
    moves: np.ndarray  # 2 x 2

    def emissions(self, bins: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        return self.own[bins] + self.before[before] + self.after[after]


def transfers(emission: np.ndarray, real: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For each row of tokens the matrix from tags at its first token to tags at its last, up to scale."""
    move, weight = np.exp(moves), np.exp(np.clip(emission, -30, 30))
    through = np.zeros((len(emission), 2, 2))
    through[:, 0, 0], through[:, 1, 1] = 1, weight[:, 0]
    for t in range(1, emission.shape[1]):
        following = through @ move
        following[:, :, 1] *= weight[:, t, None]
        following /= following.sum((1, 2), keepdims=True)
        through = np.where(real[:, t, None, None], following, through)
    return through


def messages(through: np.ndarray, rank: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each row of a text hears from the rows before and after it; ``rank`` is its place in the text."""
    move, n = np.exp(moves), len(rank)
    before, after = np.ones((n, 2)), np.ones((n, 2))
    order = np.argsort(rank, kind="stable")
    cuts = np.searchsorted(rank[order], np.arange(int(rank.max()) + 2))
    turns = [order[cuts[r] : cuts[r + 1]] for r in range(1, len(cuts) - 1)]
    for row in turns:
        heard = (before[row - 1][:, None] @ through[row - 1])[:, 0] @ move
        before[row] = heard / heard.sum(1, keepdims=True)
    for row in reversed(turns):
        heard = (through[row] @ after[row][:, :, None])[:, :, 0] @ move.T
        after[row - 1] = heard / heard.sum(1, keepdims=True)
    return before, after


def marginals(
    emission: np.ndarray,
    real: np.ndarray,
    moves: np.ndarray,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over rows of segments: toxic marginals, and expected moves summed.

    ``real`` marks tokens; the rest of a segment is filled up and carries no weight. Messages
    come in from ``before`` and ``after`` a row; without them a row is a chain of its own.
    """
    n, length = emission.shape
    move = np.exp(moves)
    weight = np.exp(np.clip(emission, -30, 30))
    forward = np.empty((length, n, 2))
    state = np.ones((n, 2)) if before is None else before.copy()
    state[:, 1] *= weight[:, 0]
    forward[0] = state / state.sum(1, keepdims=True)
    for t in range(1, length):
        state = forward[t - 1] @ move
        state[:, 1] *= weight[:, t]
        state /= state.sum(1, keepdims=True)
        forward[t] = np.where(real[:, t, None], state, forward[t - 1])
    toxic = np.zeros((n, length))
    back = np.ones((n, 2)) if after is None else after
    expected = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        joint = forward[t] * back
        toxic[:, t] = joint[:, 1] / joint.sum(1) * real[:, t]
        if t:
            following = back.copy()
            following[:, 1] *= weight[:, t]
            pair = forward[t - 1][:, :, None] * move[None] * following[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            expected += (pair * real[:, t, None, None]).sum(0)
            earlier = following @ move.T
            earlier /= earlier.sum(1, keepdims=True)
            back = np.where(real[:, t, None], earlier, back)
    return toxic, expected


def segments(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of tokens as rows of ``SEGMENT``, none of which holds two texts, and which are real."""
    rows = -(-lengths // SEGMENT)
    starts = np.repeat(np.cumsum(lengths) - lengths, rows)
    within = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
    places = (starts + within * SEGMENT)[:, None] + np.arange(SEGMENT)
    real = places < np.repeat(np.cumsum(lengths), rows)[:, None]
    return np.where(real, places, 0), real


def neighbours(bins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bins before and after each token; the middle bin at the ends of a text."""
    before = np.concatenate(([BINS // 2], bins[:-1])) if len(bins) else bins
    after = np.concatenate((bins[1:], [BINS // 2])) if len(bins) else bins
    some = lengths[lengths > 0]
    ends = np.cumsum(some)
    before[ends - some], after[ends - 1] = BINS // 2, BINS // 2
    return before, after


@dataclass
class Model:
    odds: dict[bytes, float]
    chain: Chain
    fit: np.ndarray  # intercept and weights of the document's features

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        get, odds, lengths = self.odds.get, [], []
        for text in texts:
            words = cleaned(text)
            lengths.append(len(words))
            odds += [
                max(get(w, 0.0), get(w[:5] + b"*", 0.0), get(w[:4] + b"*", 0.0), key=abs) for w in words
            ]
        return np.array(odds, float), np.array(lengths, np.int64)

    def tag(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The toxic marginal of every token, and the number of tokens of each text."""
        odds, lengths = self.tokens(texts)
        out = np.zeros(len(odds))
        if len(odds):
            bins = bin_of(odds)
            emission = self.chain.emissions(bins, *neighbours(bins, lengths))
            places, real = segments(odds, lengths)
            rows, moves = -(-lengths // SEGMENT), self.chain.moves
            rank = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
            steps = [slice(at, at + 4096) for at in range(0, len(places), 4096)]
            through = np.concatenate([transfers(emission[places[k]], real[k], moves) for k in steps])
            before, after = messages(through, rank, moves)
            for k in steps:
                toxic, _ = marginals(emission[places[k]], real[k], moves, before[k], after[k])
                out[places[k][real[k]]] = toxic[real[k]]
        return out, lengths

    def features(self, toxic: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per text: 1, the log of one plus the expected toxic tokens, their share, the largest marginal."""
        out = np.zeros((len(lengths), 4))
        out[:, 0] = 1
        some = lengths > 0
        if some.any():
            starts = (np.cumsum(lengths) - lengths)[some]
            total = np.add.reduceat(toxic, starts)
            out[some, 1] = np.log1p(total)
            out[some, 2] = np.sqrt(total / lengths[some])
            out[some, 3] = np.maximum.reduceat(toxic, starts)
        return out

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        toxic, lengths = self.tag(texts)
        return 1 / (1 + np.exp(-np.clip(self.features(toxic, lengths) @ self.fit, -30, 30))), toxic, lengths


def log_odds(texts: list[bytes], labels: np.ndarray) -> dict[bytes, float]:
    """Entries whose document frequencies differ most between the labels."""
    seen: dict[bytes, list[int]] = {}
    for text, label in zip(texts, labels, strict=True):
        for form in {f for w in set(cleaned(text)) if w for f in forms(w)}:
            seen.setdefault(form, [0, 0])[label] += 1
    n = np.bincount(labels, minlength=2)
    found = []
    for form, (good, bad) in seen.items():
        if good + bad >= SEEN:
            p, q = (bad + 0.5) / (n[1] + 1), (good + 0.5) / (n[0] + 1)
            odds = np.log(p / (1 - p)) - np.log(q / (1 - q))
            sure = abs(odds) / np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
            if sure > 3:
                found.append((sure, form, float(odds)))
    found.sort(key=lambda x: (-x[0], x[1]))
    return {form: odds for _, form, odds in found[:LEXICON]}


def train_chain(bins: np.ndarray, lengths: np.ndarray, tags: np.ndarray, steps: int = 40) -> Chain:
    chain = Chain(np.zeros(BINS), np.zeros(BINS), np.zeros(BINS), np.zeros((2, 2)))
    before, after = neighbours(bins, lengths)
    places, real = segments(bins, lengths)
    # Filled-up places carry tag 0 but are not counted.
    gold = tags[places] * real
    moved = np.zeros((2, 2))
    np.add.at(moved, (gold[:, :-1][real[:, 1:]], gold[:, 1:][real[:, 1:]]), 1)
    parts = (chain.own, chain.before, chain.after, chain.moves)
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        toxic, expected = marginals(chain.emissions(bins, before, after)[places], real, chain.moves)
        miss = np.zeros(len(bins))
        miss[places[real]] = (gold - toxic)[real]
        slopes = [np.bincount(x, miss, BINS) / len(bins) for x in (bins, before, after)]
        slopes.append((moved - expected) / len(bins))
        for k, slope in enumerate(slopes):
            slope = slope - 1e-5 * parts[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            parts[k][...] += 0.3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return chain


def fit_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, weighted so that both labels count alike."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, len(y) / max(2 * y.sum(), 1), len(y) / max(2 * (1 - y).sum(), 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-2 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` labelled documents of each label."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").distinct()
    drawn = [
        marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for label in (0, 1)
    ]
    rows = docs.select("doc_id", text.alias("text")).join(drawn[0].union(drawn[1]).hint("broadcast"), "doc_id")
    rows = sorted((r.doc_id, r.toxic, bytes(r.text)) for r in rows.toLocalIterator())
    y = np.array([r[1] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    texts = [r[2] for r in rows]
    model = Model(log_odds(texts, y), None, np.zeros(4))
    odds, lengths = model.tokens(texts)
    tags = ((odds >= 2) & (np.repeat(y, lengths) == 1)).astype(np.int64)
    model.chain = train_chain(bin_of(odds), lengths, tags)
    toxic, _ = model.tag(texts)
    model.fit = fit_scores(model.features(toxic, lengths), y.astype(float))
    return model


def spans_of(text: str, toxic: np.ndarray) -> list[dict[str, int]]:
    """Runs of tokens more likely toxic than not, as offsets in characters."""
    out: list[dict[str, int]] = []
    last = -2
    for k, word in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", text)):
        if toxic[k] > 0.5:
            if last == k - 1:
                out[-1]["end"] = word.end()
            else:
                out.append({"start": word.start(), "end": word.end()})
            last = k
    return out


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """Rows ``(doc_id, score, predicted, spans)``, one per row of ``docs``."""

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            if model is None:
                scores, toxic, lengths = np.zeros(len(texts)), None, np.zeros(len(texts), np.int64)
                spans = [[] for _ in texts]
            else:
                scores, toxic, lengths = model.scores(texts)
                cuts = np.concatenate(([0], np.cumsum(lengths)))
                spans = [
                    spans_of(t.decode(), own) if (own := toxic[cuts[n] : cuts[n + 1]]).max(initial=0) > 0.5 else []
                    for n, t in enumerate(texts)
                ]
            columns = [
                batch.column("doc_id"),
                pa.array(scores),
                pa.array((scores >= threshold).astype(np.int32)),
                pa.array(spans, kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    schema = f"doc_id {kind}, score double, predicted int, spans array<struct<start:int,end:int>>"
    return docs.select("doc_id", text).mapInArrow(rate, schema)


def accepted(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged and where they are."""
    if model is None:
        return docs

    text = unused(docs, "_scored_text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            scores = model.scores(batch.column(text).to_pylist())[0]
            yield batch.drop_columns([text]).filter(pa.array(scores < threshold))

    return docs.withColumn(text, F.coalesce("text", F.lit("")).cast("binary")).mapInArrow(keep, docs.schema)


def held_out(folds: int = 3, fold: int = 1):
    """Whether a row is never learned from."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))
