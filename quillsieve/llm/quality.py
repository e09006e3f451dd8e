"""Operator 7: document quality from weak labels.

Nine overlapping heuristic labellers vote low, good or abstain on every
document.  Expectation-maximisation over the counts of vote patterns of ALL
documents estimates, for latent kinds of documents, how often each labeller
votes what on a kind and how large the kind is; votes are independent within a
kind, and several kinds carry the labellers' dependence (one kind of junk sets
off several of them, another only one).  A kind is low if some labeller votes
low on most of its documents, else good: texts that are merely short or
unusual form good kinds of their own, so a lone low vote does not decide.
That gives each labeller's accuracies (``Model.tables``) and turns a vote
pattern into a posterior.  The posteriors of a bounded sample (``SAMPLE``
documents by hash order) train a logistic scorer on hashed words and word
shapes, which scores every document.  A document is rejected if the scorer and
its posterior both call it low.

Defined results: null, empty and blank texts have no words, get score 0 and are
not kept; repeated rows score alike, whatever their id; ties of the sample are
rows of one id and text, any of which gives the same model; a table without
words has no scorer and scores by posterior; a text of any length is one
profile, made by one task; extra columns are ignored, or kept by ``kept``
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.words import _PLACE, _VALUE, blocks, mix, release, weights, word_hashes

LABELLERS = ("upper", "caps", "symbols", "bare", "letters", "repeats", "variety", "stops", "length")
LOW, ABSTAIN, GOOD = 0, 1, 2
SAMPLE, WORDS_DIM, SHAPES_DIM = 8000, 768, 256
TURNS, STILL, THRESHOLD = 1000, 1e-7, 0.5

_KIND = np.full(256, 4, np.uint8)  # other bytes belong to letters outside ASCII
for _b in range(128):
    _KIND[_b] = 1 if chr(_b).isupper() else 2 if chr(_b).islower() else 3 if chr(_b).isdigit() else 0 if _b in (9, 10, 11, 12, 13, 32) else 5


def profile(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Per word: document, hash and shape hash; per document: measures the labellers use."""
    h, counts = word_hashes(texts)
    n = counts.astype(np.float64)
    doc = np.repeat(np.arange(len(texts)), counts)
    out = {"hash": h, "doc": doc, "n": counts}
    if not len(h):
        return out
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[data]
    inside = kind > 0
    first = inside & ~np.concatenate([[False], inside[:-1]])
    b, k = data[inside], kind[inside]
    start = np.flatnonzero(first[inside])
    size = np.diff(start, append=len(b))
    begins = np.zeros(len(b), bool)
    begins[start] = True
    total = lambda x: np.add.reduceat(x.astype(np.int32), start)
    upper, lower, mark = total(k == 1), total(k == 2), total(k == 5)
    same = np.concatenate([[False], b[1:] == b[:-1]]) & ~begins & (k == 5)
    run = total(same)
    shape_code = np.where(k == 5, b, np.where(k == 4, 2, k)).astype(np.uint8)
    turn = begins | np.concatenate([[True], shape_code[1:] != shape_code[:-1]])
    place = np.cumsum(turn)
    place = place - np.repeat(place[start], size)
    shape = mix(np.add.reduceat(np.where(turn, _VALUE[shape_code + 128 * (shape_code < 8)] * weights(place), np.uint64(0)), start) + _PLACE[np.minimum(run, 2)])
    before = np.concatenate([[False], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])])
    pair = np.where(np.concatenate([[False], doc[1:] == doc[:-1]]), mix(h + np.concatenate([h[:1], h[:-1]]) * _PLACE[40]), mix(h))
    per = lambda x: np.bincount(doc, x, len(texts)) / np.maximum(n, 1)
    ends = np.isin(b[start + size - 1], np.frombuffer(b".!?", np.uint8))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    distinct = np.array([len(np.unique(h[i:j])) for i, j in zip(cuts, cuts[1:])]) / np.maximum(n, 1)
    pairs = np.array([len(np.unique(pair[i:j])) for i, j in zip(cuts, cuts[1:])]) / np.maximum(n, 1)
    letters, cased = np.bincount(doc, total((k == 1) | (k == 2) | (k == 4)), len(texts)), np.bincount(doc, upper + lower, len(texts))
    out |= {
        "letters": letters / np.maximum(np.bincount(doc, size, len(texts)), 1), "caps": np.bincount(doc, upper, len(texts)) / np.maximum(cased, 1),
        "shape": np.where(before, mix(shape + _PLACE[41]), shape), "upper": per((upper > 1) & (lower == 0)), "symbols": per(run > 0), "bare": per(mark == size),
        "repeats": per(before), "distinct": distinct, "pairs": pairs, "stops": per(ends), "length": np.bincount(doc, size, len(texts)) / np.maximum(n, 1),
    }
    return out


def votes(p: dict[str, np.ndarray]) -> np.ndarray:
    """One vote a labeller for every document."""
    n = p["n"]
    out = np.full((len(n), len(LABELLERS)), ABSTAIN, np.int8)
    if "shape" not in p:
        out[:] = LOW
        return out
    # labeller: when it votes low, when it votes good; bounds are loose, so that labellers overlap and err
    rules = {
        "upper": (p["upper"] >= 0.3, p["upper"] <= 0.02), "caps": (p["caps"] >= 0.1, p["caps"] <= 0.04), "symbols": (p["symbols"] >= 0.05, p["symbols"] <= 0.005),
        "bare": (p["bare"] >= 0.05, p["bare"] <= 0.01), "letters": (p["letters"] <= 0.85, p["letters"] >= 0.93), "repeats": (p["repeats"] >= 0.1, p["repeats"] <= 0.03),
        "variety": (((p["distinct"] <= 0.35) | (p["pairs"] <= 0.6)) & (n >= 30), (p["distinct"] >= 0.45) & (p["pairs"] >= 0.85)),
        "stops": ((p["stops"] >= 0.25) & (n >= 20) | (p["stops"] < 0.01) & (n >= 60), (p["stops"] >= 0.02) & (p["stops"] < 0.2)), "length": ((p["length"] >= 8) | (p["length"] <= 2.5), (p["length"] >= 3.5) & (p["length"] <= 6.6)),
    }
    for k, name in enumerate(LABELLERS):
        low, good = rules[name]
        out[good, k] = GOOD
        out[low, k] = LOW
    out[n == 0] = LOW
    return out


def _given(patterns: np.ndarray, kinds: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """P(kind | votes) for each pattern; ``kinds`` is labeller x kind x vote."""
    log = np.log(shares)[None, :] + sum(np.log(kinds[j])[:, patterns[:, j]].T for j in range(patterns.shape[1]))
    p = np.exp(log - log.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit_kinds(patterns: np.ndarray, counts: np.ndarray, turns: int = TURNS, still: float = STILL) -> tuple[np.ndarray, np.ndarray]:
    """EM on vote patterns for one kind without low votes and one kind a labeller: (votes by labeller x kind x vote, shares).

    It starts from the votes: half of a pattern with low votes, or less where
    several labellers agree, is of the first kind, the rest of the kinds of
    those that voted low.  Every table has one pseudo-vote and every kind one
    pseudo-document; nothing else holds the estimates.
    """
    labellers = patterns.shape[1]
    low = patterns == LOW
    n = low.sum(1)
    first = np.where(n > 0, 0.5 / (1 + n), 0.95)
    rest = np.where(n[:, None] > 0, low / np.maximum(n, 1)[:, None], 1 / labellers)
    held = np.hstack([first[:, None], rest * (1 - first)[:, None]])
    for _ in range(turns):
        weight = counts[:, None] * held
        shares = (weight.sum(0) + 1) / (counts.sum() + labellers + 1)
        kinds = np.stack([np.stack([weight[patterns[:, j] == v].sum(0) for v in range(3)], 1) + 1 / 3 for j in range(labellers)])
        kinds /= kinds.sum(2, keepdims=True)
        before, held = held, _given(patterns, kinds, shares)
        if np.abs(held - before).max() < still:
            break
    return kinds, shares


def good_kinds(kinds: np.ndarray) -> np.ndarray:
    """Which kinds are good: those on most of whose documents no labeller votes low."""
    return kinds[:, :, LOW].max(0) < 0.5


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, accuracies labeller x class x vote, share of good), the classes being low and good."""
    kinds, shares = fit_kinds(patterns, counts, turns)
    good = good_kinds(kinds)
    tables = np.stack([(kinds * (shares * c)[None, :, None]).sum(1) / max((shares * c).sum(), 1e-12) for c in (~good, good)], 1)
    return _given(patterns, kinds, shares)[:, good].sum(1), tables, float(shares[good].sum())


def features(p: dict[str, np.ndarray]) -> np.ndarray:
    """Hashed word and word-shape frequencies, log-scaled (documents x dimensions)."""
    size, width = len(p["n"]), WORDS_DIM + SHAPES_DIM
    if "shape" not in p:
        return np.zeros((size, width), np.float32)
    word = (p["hash"] % np.uint64(WORDS_DIM)).astype(np.int64)
    shape = WORDS_DIM + (p["shape"] % np.uint64(SHAPES_DIM)).astype(np.int64)
    count = np.bincount(np.concatenate([p["doc"] * width + word, p["doc"] * width + shape]), minlength=size * width).reshape(size, width)
    return np.log1p(100 * count / np.maximum(p["n"], 1)[:, None]).astype(np.float32)


def fit_scorer(x: np.ndarray, y: np.ndarray, turns: int = 200, ridge: float = 1e-4) -> np.ndarray:
    """Logistic weights (bias last) for soft labels, the two classes weighing alike; plain gradient steps with momentum."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    x = x / scale
    weight = y / max(y.sum(), 1e-9) + (1 - y) / max((1 - y).sum(), 1e-9)
    weight = (weight / weight.sum()).astype(np.float32)
    steep = np.ones(x.shape[1], np.float32)
    for _ in range(30):  # the largest curvature, by power iteration
        steep = x.T @ (weight * (x @ steep))
        most = float(np.linalg.norm(steep))
        steep /= max(most, 1e-9)
    rate = np.float32(3 / max(most, 1e-9))
    y, w, speed = y.astype(np.float32), np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for _ in range(turns):
        ahead = w + np.float32(0.9) * speed
        s = 1 / (1 + np.exp(-np.clip(x @ ahead, -50, 50)))
        speed = np.float32(0.9) * speed - rate * (x.T @ (weight * (s - y)) + np.float32(ridge) * ahead)
        w = w + speed
    return w / scale


def _profiles(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, dict]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            texts = [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()]
            for lo, hi in blocks(texts):
                yield part.slice(lo, hi - lo), profile(texts[lo:hi])
    release()


_CODES = 3 ** np.arange(len(LABELLERS))


def _pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(3 ** len(LABELLERS), np.int64)
    for _, p in _profiles(batches, 0):
        total += np.bincount(votes(p) @ _CODES, minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pattern", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, p in _profiles(batches, 0):
        code = votes(p) @ _CODES
        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array([x.tobytes() for x in features(p)], pa.binary())], names=["pattern", "x"])


_ALL = np.arange(3 ** len(LABELLERS))[:, None] // _CODES[None, :] % 3


class Model:
    """Posteriors by vote pattern, labellers' accuracies (labeller x class x vote, low class first) and the scorer's weights."""

    def __init__(self, posterior: np.ndarray, tables: np.ndarray, share: float, weights: np.ndarray | None):
        self.posterior, self.tables, self.share, self.weights = posterior, tables, share, weights


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on ``docs`` (doc_id, text): labellers on all rows, the scorer on a bounded sample."""
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(text).mapInArrow(_pattern_counts, "pattern long, n long").groupBy("pattern").agg(F.sum("n")).collect()  # a row a pattern at most
    if not rows:
        return Model(np.full(len(_ALL), 0.5), np.zeros((len(LABELLERS), 2, 3)), 0.5, None)
    code, count = (np.array(x, np.int64) for x in zip(*sorted(map(tuple, rows))))
    kinds, shares = fit_kinds(_ALL[code], count.astype(np.float64))
    _, tables, share = fit_labellers(_ALL[code], count.astype(np.float64))
    posterior = _given(_ALL, kinds, shares)[:, good_kinds(kinds)].sum(1)
    # the sample's last hash first, so that only hashes are sorted and no text is moved
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("string"), text).alias("r"), text).where("trim(text) <> ''")
    first = [r[0] for r in keyed.select("r").orderBy("r").limit(sample).collect()]
    if not first:
        return Model(posterior, tables, share, None)
    last = F.lit(first[-1])
    # rows of the last hash repeat one id and text, so any of them will do
    some = keyed.where(F.col("r") < last).unionByName(keyed.where(F.col("r") == last).limit(first.count(first[-1])))
    got = sorted(map(tuple, some.select("text").mapInArrow(_sampled, "pattern long, x binary").collect()))
    x = np.stack([np.frombuffer(v, np.float32) for _, v in got])
    return Model(posterior, tables, share, fit_scorer(x, posterior[[p for p, _ in got]]))


def _judge(model: Model, text: Column) -> Column:
    posterior, weights = model.posterior, model.weights

    @F.arrow_udf("struct<votes: string, posterior: double, score: double>")
    def judge(texts: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(texts), 1000):  # few texts at once are held twice
            raw = [t or b"" for t in texts.slice(start, 1000).cast(pa.binary()).to_pylist()]
            for lo, hi in blocks(raw):
                p = profile(raw[lo:hi])
                v = votes(p)
                prior = np.where(p["n"] > 0, posterior[v @ _CODES], 0.0)
                score = prior if weights is None else 1 / (1 + np.exp(-np.clip(features(p) @ weights[:-1] + weights[-1], -50, 50)))
                parts.append((["".join("-?+"[x] for x in r) for r in v], prior, np.where(p["n"] > 0, score, 0.0)))
        release()
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[]] * 3
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.float64(), pa.float64()))], names=["votes", "posterior", "score"])

    return judge(text.cast("string"))


def _good(judged: Column, threshold: float) -> Column:
    return (judged.score >= threshold) | (judged.posterior >= threshold)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id of every row of ``docs`` with quality_votes, quality_posterior, quality_score and quality_kept."""
    q = F.col("q")
    seen = docs.select("doc_id", _judge(model, F.col("text")).alias("q"))
    return seen.select("doc_id", q.votes.alias("quality_votes"), q.posterior.alias("quality_posterior"), q.score.alias("quality_score"), _good(q, threshold).alias("quality_kept"))


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    seen = docs.select(F.struct("*").alias("doc"), _judge(model, F.col("text")).alias("q"))
    return seen.where(_good(F.col("q"), threshold)).select("doc.*")
