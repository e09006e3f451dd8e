"""Operator 6: toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and their stems (first 4, 5 and 6 bytes).  A
bounded sample of labelled rows (``POSITIVES`` and ``NEGATIVES`` by hash order)
gives the examples; their terms, all of them, are the vocabulary.  A term
weighs its inverse document frequency, counted over the whole table, times how
unevenly it falls on the two labels, to the power ``TELLING`` (0: plain
TF-IDF, whose neighbours share topics rather than labels).

The examples lie in an inverted index: a term's postings are cut into the
blocks of examples that hold it, each with the term's greatest weight in the
block.  A text's bound on a block is the sum of its terms' greatest weights
there; the blocks of the highest bounds are read first, then all whose bound
reaches the k-th best found, and the best there are compared whole, so the k
nearest are exact.  Cosines are summed in float64 and in one order, so equal texts get equal
results in any batch.  Votes are weighted by closeness; a monotone map
fitted on the examples, each left out in turn and weighted back to the labelled
rows' shares, makes the vote a probability.  The nearest examples are the
evidence.

Defined results: null and empty texts, and texts without any term of an
example, get the share of toxic rows among examples without neighbours; equal
texts score alike; without labelled rows of both kinds every score is the share
of toxic rows (0 without any); labels of unknown documents, null labels and
extra columns are ignored; where labels of one id differ it is toxic; of texts
that share an example's id the one of the smallest hash is the example; a text
of any length is one vector, made by one task; ties between examples go to the
smaller example number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.words import _VALUE, blocks, mix, release, text_key, weights

POSITIVES, NEGATIVES, TELLING = 800, 2400, 0.9
UNSEEN = (1 / 5000, 1 / 8000)  # shares of toxic and other examples that a term is taken to have besides
STEMS = (4, 5, 6)
K, BLOCK, AHEAD, THRESHOLD = 15, 32, 8, 0.7
COLUMNS, BATCH, SLACK = 4096, 128, np.float32(2e-5)  # the slack is more than float32 sums lose
PIECE = 400_000  # bytes of text scored at once
POSTING = np.dtype([("at", np.int32), ("share", np.float32)])  # read as one int64

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
_FOLD = np.arange(256, dtype=np.uint64)
for _c in range(97, 123):
    _LETTER[[_c, _c - 32]] = True
    _FOLD[_c - 32] = _c


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of all words of three bytes or more and of their stems, repeats included."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = _LETTER[data]
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    after = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
    size = after - first
    letters = data[inside]
    start = np.cumsum(size) - size
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place = np.arange(len(letters)) - np.repeat(start, size)
    word = mix(np.add.reduceat(_VALUE[letters] * weights(place), start) + size.astype(np.uint64))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    doc = np.searchsorted(ends, first, side="right")
    long_enough = size >= 3
    docs, out = [doc[long_enough]], [word[long_enough]]
    key = np.zeros(len(first), np.uint64)
    letters = np.concatenate([letters, np.zeros(8, np.uint8)])
    for i in range(max(STEMS)):
        key = (key << np.uint64(8)) | _FOLD[letters[start + i]]
        if i + 1 in STEMS:
            some = size > i + 1
            docs.append(doc[some])
            out.append(mix(key[some] + np.uint64((i + 1) << 56)))
    return np.concatenate(docs), np.concatenate(out)


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + n), one after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def tallied(doc: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences), sorted, of term numbers below ``width``."""
    key, n = np.unique(doc * width + term, return_counts=True)
    return key // width, key % width, n


class Vocabulary:
    """Sorted term hashes; a table of their leading bits says where to look."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        bits = max(4, int(len(terms)).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(terms >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.most = int(np.diff(self.start).max()) if len(terms) else 0

    def find(self, term: np.ndarray) -> np.ndarray:
        """Each hash's number, -1 for unknown ones."""
        out = np.full(len(term), -1, np.int64)
        head = (term >> self.shift).astype(np.int64)
        at, end = self.start[head], self.start[head + 1]
        open_ = np.flatnonzero(at < end)
        for step in range(self.most):
            spot = at[open_] + step
            hit = self.terms[spot] == term[open_]
            out[open_[hit]] = spot[hit]
            open_ = open_[~hit & (spot + 1 < end[open_])]
        return out

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term number, occurrences), sorted."""
        doc, term = terms_of(texts)
        at = self.find(term)
        known = at >= 0
        return tallied(doc[known], at[known], max(1, len(self.terms)))


def weigh(doc: np.ndarray, at: np.ndarray, n: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Weights of (document, term, occurrences) in unit vectors; a row without weight stays zero."""
    x = (1 + np.log(n)) * weight[at]
    norm = np.sqrt(np.bincount(doc, x * x, rows))
    return x / np.where(norm > 0, norm, 1)[doc]


class BlockMaxIndex:
    """Postings of examples (example, term, weight; unit vectors) in blocks of examples, with each term's greatest weight in each block.

    The ``columns`` terms of the longest lists are kept as columns of each
    block, all others as lists; whole vectors are kept for the last comparison.
    """

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int, block: int = BLOCK, ahead: int = AHEAD, columns: int = COLUMNS):
        some = weight > 0
        example, term, weight = example[some], term[some], weight[some]
        # examples of one heaviest term lie together
        order = np.lexsort((term, -weight, example))
        first = order[np.flatnonzero(np.diff(example[order], prepend=-1))]
        self.names = example[first][np.lexsort((example[first], term[first]))]
        self.size, self.ahead, self.blocks = len(self.names), ahead, -(-len(self.names) // block)
        self.edge = np.minimum(np.arange(self.blocks + 1) * block, self.size)
        place = np.zeros(int(self.names.max()) + 1 if self.size else 0, np.int64)
        place[self.names] = np.arange(self.size)
        at = place[example]
        # whole vectors by example
        order = np.lexsort((term, at))
        whole = np.searchsorted(at[order], np.arange(1, self.size))
        self.lists = np.split(term[order].astype(np.int32), whole), np.split(weight[order], whole)
        # the longest lists as columns
        held = np.bincount(term, minlength=terms)
        longest = np.argsort(-held, kind="stable")[:columns]
        self.column = np.full(terms, -1, np.int32)
        self.column[longest] = np.arange(len(longest))
        wide = self.column[term] >= 0
        dense = np.zeros((self.size, len(longest)), np.float32)
        dense[at[wide], self.column[term[wide]]] = weight[wide]
        self.dense = [np.ascontiguousarray(dense[a:b].T) for a, b in zip(self.edge, self.edge[1:])]
        self.dense_most = np.stack([b.max(1) for b in self.dense], 1) if self.blocks else np.zeros((len(longest), 0), np.float32)
        # the others by term and block
        order = np.lexsort((at, term))
        order = order[~wide[order]]
        term, at, share = term[order], at[order], weight[order]
        cut = np.flatnonzero(np.diff(term * (self.blocks + 1) + at // block, prepend=-1))
        self.start, self.long = cut, np.diff(cut, append=len(term))
        self.block, self.most = at[cut] // block, np.maximum.reduceat(share, cut) if len(cut) else share
        postings = np.zeros(len(term), POSTING)
        postings["at"], postings["share"] = at, share
        self.postings = postings.view(np.int64)
        self.entries = np.searchsorted(term[cut], np.arange(terms + 1))
        self.read = self.held = 0

    def top(self, doc: np.ndarray, at: np.ndarray, weight: np.ndarray, rows: int, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers (-1: none) and cosines of the k nearest of texts given as sorted (text, term, weight); ``without``: an example to leave out."""
        who, best = np.full((rows, k), -1, np.int64), np.zeros((rows, k))
        if not self.size or not len(doc):
            return who, best
        query = np.zeros(len(self.column))
        bounds = np.searchsorted(doc, np.arange(rows + 1))
        for lo in range(0, rows, BATCH):
            hi = min(rows, lo + BATCH)
            part = slice(bounds[lo], bounds[hi])
            found = self._candidates(doc[part] - lo, at[part], weight[part], hi - lo, k, None if without is None else without[lo:hi])
            for r, some in enumerate(found, lo):
                if len(some):
                    own = slice(bounds[r], bounds[r + 1])
                    query[at[own]] = weight[own]
                    cosine = self._cosines(query, some)
                    query[at[own]] = 0
                    name = self.names[some]
                    order = np.lexsort((name, -cosine))[:k]
                    order = order[cosine[order] > 0]
                    who[r, : len(order)], best[r, : len(order)] = name[order], cosine[order]
        return who, best

    def _cosines(self, query: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Whole products with the examples ``some``, each summed over its terms in one order."""
        terms, shares = ([whole[i] for i in some] for whole in self.lists)
        n = np.fromiter(map(len, terms), np.int64, len(terms))
        return np.add.reduceat(query[np.concatenate(terms)] * np.concatenate(shares), np.cumsum(n) - n)

    def _candidates(self, doc, at, weight, rows, k, without) -> list[np.ndarray]:
        """For each text the examples whose product, but for ``SLACK`` of rounding, reaches the k-th best."""
        column = self.column[at]
        wide = column >= 0
        dense = np.zeros((rows, len(self.dense_most)), np.float32)
        dense[doc[wide], column[wide]] = weight[wide]
        doc, at, weight = doc[~wide], at[~wide], weight[~wide]
        n = self.entries[at + 1] - self.entries[at]
        entry, of, share = _spread(self.entries[at], n), np.repeat(doc, n), np.repeat(weight, n)
        cell = of * self.blocks + self.block[entry]
        bound = np.bincount(cell, share * self.most[entry], rows * self.blocks).reshape(rows, self.blocks) + dense @ self.dense_most
        score, seen = np.full((rows, self.size), -1, np.float32), np.zeros((rows, self.blocks), bool)

        def read(wanted: np.ndarray) -> np.ndarray:
            for b in np.flatnonzero(wanted.any(0)):
                these = np.flatnonzero(wanted[:, b])
                score[these, self.edge[b] : self.edge[b + 1]] = dense[these] @ self.dense[b]
            some = np.flatnonzero(wanted.ravel()[cell])
            chosen = entry[some]
            n = self.long[chosen]
            posting = self.postings[_spread(self.start[chosen], n)].view(POSTING)
            score.ravel()[:] += np.bincount(np.repeat(of[some] * self.size, n) + posting["at"], np.repeat(share[some], n) * posting["share"], rows * self.size)
            if without is not None:
                score[self.names[None, :] == without[:, None]] = -1
            seen[wanted] = True
            return np.maximum(np.partition(score, self.size - k, axis=1)[:, self.size - k], 0) if self.size >= k else np.zeros(rows, np.float32)

        first = np.zeros(bound.shape, bool)
        some = min(self.ahead, self.blocks)
        np.put_along_axis(first, np.argpartition(-bound, some - 1, axis=1)[:, :some], True, 1)
        bar = read(first & (bound > 0))
        bar = read(~seen & (bound > 0) & (bound + SLACK >= bar[:, None]))
        self.read, self.held = self.read + int(seen.sum()), self.held + seen.size
        row, column = np.nonzero((score > 0) & (score + SLACK >= bar[:, None]))
        return np.split(column, np.searchsorted(row, np.arange(1, rows)))


def vote(who: np.ndarray, cosine: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Closeness-weighted share of toxic neighbours; NaN without neighbours."""
    if not len(toxic):
        return np.full(len(who), np.nan)
    weight = np.where(who >= 0, cosine**4, 0)
    total = weight.sum(1)
    return np.where(total > 0, (weight * toxic[who]).sum(1) / np.where(total > 0, total, 1), np.nan)


def monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x: knots and values, kept off 0 and 1 by two pseudo-rows of the mean."""
    order = np.argsort(x, kind="stable")
    mean = float((weight * y).sum() / weight.sum())
    pools: list[list[float]] = []
    for i in order:
        pools.append([x[i], x[i], weight[i] * y[i], weight[i]])
        while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
            lo, hi, s, w = pools.pop()
            pools[-1] = [pools[-1][0], hi, pools[-1][2] + s, pools[-1][3] + w]
    knots = [v for p in pools for v in (p[0], p[1])]
    values = [v for p in pools for v in [(p[2] + 2 * mean * 0.1) / (p[3] + 0.2)] * 2]
    return np.array(knots), np.maximum.accumulate(values)


class Model:
    """Vocabulary, term weights, the examples' terms (example, term, occurrences), labels and ids, and the calibration."""

    def __init__(self, terms, weight, tally, toxic, names, share, share_bare=None, knots=np.zeros(0), values=np.zeros(0)):
        self.terms, self.weight, self.toxic, self.names = terms, weight, toxic, names
        self.tally = tuple(x.astype(np.int32) for x in tally)  # workers get a copy each, so it is kept small
        self.share, self.share_bare, self.knots, self.values = share, share if share_bare is None else share_bare, knots, values
        self.made = None

    def __getstate__(self):
        return self.__dict__ | {"made": None}  # each worker builds its own index

    def _parts(self) -> tuple[Vocabulary, BlockMaxIndex]:
        if self.made is None:
            example, at, n = (x.astype(np.int64) for x in self.tally)
            self.made = Vocabulary(self.terms), BlockMaxIndex(example, at, weigh(example, at, n, self.weight, len(self.names)), len(self.terms))
        return self.made

    def nearest(self, texts: list[bytes], without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: none) and cosines of the k nearest examples of each text, but for the examples ``without``."""
        vocabulary, index = self._parts()
        doc, at, n = vocabulary.counts(texts)
        return index.top(doc, at, weigh(doc, at, n, self.weight, len(texts)), len(texts), K, without)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities, the k nearest examples' ids (-1: none) and their cosines."""
        who, cosine = self.nearest(texts)
        v = vote(who, cosine, self.toxic)
        some = ~np.isnan(v)
        out = np.full(len(texts), self.share_bare)
        if len(self.knots):
            out[some] = np.interp(v[some], self.knots, self.values)
        return out, np.where(who >= 0, self.names[who], -1) if len(self.names) else who, cosine


def _holding(terms: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        total, rows = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            rows += len(texts)
            for lo, hi in blocks(texts, PIECE):
                total += np.bincount(vocabulary.counts(texts[lo:hi])[1], minlength=len(terms))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], rows))], names=["term", "n"])
        release()

    return count


def _left_out(held):
    """The vote of each example (doc_id, text) without itself."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts, own = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], np.searchsorted(model.names, batch.column(0).to_numpy())
            for lo, hi in blocks(texts, PIECE):
                v = vote(*model.nearest(texts[lo:hi], own[lo:hi]), model.toxic)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(v)], names=["doc_id", "vote"])
        release()

    return judge


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct term hashes and their counts of each example, as bytes."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        found = [np.unique(terms_of([t])[1], return_counts=True) for t in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([h.tobytes() for h, _ in found], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary()),
        ], names=["doc_id", "toxic", "terms", "counts"])


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, telling: float = TELLING) -> Model:
    """Fits on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic): pass only rows that may be learned from."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    tally = dict(tuple(r) for r in known.groupBy("toxic").count().collect())
    n_yes, n_no = tally.get(1, 0), tally.get(0, 0)
    share = n_yes / (n_yes + n_no) if n_yes + n_no else 0.0
    ordered = lambda v, n: known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = ordered(1, positives).unionByName(ordered(0, negatives))  # a bounded number of ids
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", text_key(F.col("text"))).alias("text"))
    # at most ``positives`` + ``negatives`` rows; their terms come to the driver, their texts do not
    rows = sorted(map(tuple, one.select("doc_id", "toxic", "text").mapInArrow(_examples, "doc_id long, toxic int, terms binary, counts binary").collect())) if n_yes and n_no else []
    if not any(r[2] for r in rows):  # nothing to learn from
        return Model(np.zeros(0, np.uint64), np.zeros(0), [np.zeros(0, np.int64)] * 3, np.zeros(0), np.zeros(0, np.int64), share)
    hashes, n = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in ((2, np.uint64), (3, np.int32)))
    example = np.repeat(np.arange(len(rows)), [len(r[2]) // 8 for r in rows])
    toxic, names = np.array([r[1] for r in rows], np.float64), np.array([r[0] for r in rows], np.int64)
    del rows
    terms, at = np.unique(hashes, return_inverse=True)
    at = at.ravel()
    held = docs.sparkSession.sparkContext.broadcast(terms)
    df, total = np.zeros(len(terms)), 1
    counted = docs.select(F.col("text").cast("string")).mapInArrow(lambda it: _holding(held.value)(it), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for batch in counted.toArrow().to_batches():  # a row a term of the examples at most
        term, holding = (c.to_numpy() for c in batch.columns)
        df[term[term >= 0]] = holding[term >= 0]
        total += int(holding[term < 0].sum())
    yes, no = np.bincount(at, toxic[example], len(terms)), np.bincount(at, 1 - toxic[example], len(terms))
    a, b = yes / max(1, toxic.sum()), no / max(1, (1 - toxic).sum())
    uneven = (a - b) * np.log((a + UNSEEN[0]) / (b + UNSEEN[1]))
    weight = (np.log((1 + total) / (1 + df)) + 0.05) * np.maximum(uneven, 0) ** telling
    held.destroy()
    model = Model(terms, weight, (example, at, n), toxic, names, share)
    known_weight = np.where(toxic > 0, n_yes / max(1, toxic.sum()), n_no / max(1, (1 - toxic).sum()))
    everywhere = docs.sparkSession.sparkContext.broadcast(model)
    left_out = dict(map(tuple, one.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: _left_out(everywhere)(it), "doc_id long, vote double").collect()))
    everywhere.destroy()
    v = np.array([left_out[i] for i in names.tolist()])
    some = ~np.isnan(v)
    model.share_bare = float(((known_weight * toxic)[~some].sum() + share) / (known_weight[~some].sum() + 1))
    if some.any():
        model.knots, model.values = monotone(v[some], toxic[some], known_weight[some])
    return model


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted and the evidence (ids and cosines of the nearest examples) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for lo, hi in blocks(texts, PIECE):
                score, who, cosine = held.value.score(texts[lo:hi])
                near = [[int(i) for i in w if i >= 0][:3] for w in who]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(near, pa.list_(pa.int64())),
                    pa.array([[float(x) for x in c[: len(n)]] for c, n in zip(cosine, near)], pa.list_(pa.float64())),
                ], names=["doc_id", "score", "predicted", "evidence_ids", "evidence_cosines"])
        release()

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(judge, "doc_id long, score double, predicted int, evidence_ids array<long>, evidence_cosines array<double>")
