"""Operator 1: document fingerprints by a randomised edit embedding.

A random walk shared by all texts (one table of steps, indexed by walk time and
character class) spells a text out in up to twice its length: at every time the
walk writes the current character and, by the table, stays or moves on.  Two
texts at a small edit distance fall back into step soon after each edit, so the
edit distance becomes a Hamming distance between what the walks write.

The walk is followed character by character: how long it stays on a character
of a class from a given time on is a table look-up.  It starts anew every
``BLOCK`` characters, at the time it would have on average, so an edit cannot
derail it further than that, and all blocks of a batch advance together, one
numpy step per character of a block.  A fingerprint samples what is written at
shared random times of two scales, the text's own power of two and the next
one, so texts of lengths within a factor of two share a scale.  Each sample is
one hex digit, hashed from three characters.

``near`` compares two fingerprints: the share of samples that agree among
those that at least one walk reached, less what chance gives, in 0..1.
``band_keys`` takes bit samples of a fingerprint for candidate search.

Defined results: null texts are empty; the empty text has a fingerprint of its
own, near 1 to itself and 0 to all others; rows are ordered by (doc_id, text),
nulls first; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.plans.components import components
from quillsieve.plans.cut import written

SAMPLES = 128
BLOCK = 16_384
PERIOD = 1024
PAD = 16
BANDS, WIDTH = 32, 8
_RNG = np.random.default_rng(0x0ED17)
_MOVES = _RNG.integers(0, 2, (2 * PERIOD, 256), np.uint8)
_MOVES[::32] = 1  # no stay is longer than 32
_TIMES = np.sort(_RNG.random(SAMPLES) * 2)
# the samples of each band: half the bands look at what any text of a scale reaches, half further on
_EARLY = [np.flatnonzero(_TIMES < 2 * share) for share in (0.36, 0.72)]
_BAND = np.stack([_RNG.choice(_EARLY[k % 2], WIDTH, replace=False) for k in range(BANDS)])
_DIGIT = np.frombuffer(b"0123456789abcdef-", np.uint8)


def _stays() -> np.ndarray:
    """Steps until the walk leaves a character of class c that it reaches at time t (mod PERIOD)."""
    out = np.zeros((PERIOD, 256), np.uint8)
    wait = np.zeros(256, np.int64)
    for t in range(2 * PERIOD - 1, -1, -1):
        wait = np.where(_MOVES[t] == 1, 1, wait + 1)
        if t < PERIOD:
            out[t] = wait
    return out.ravel()


_STAY = _stays()


def _walk(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """For blocks of ``flat``: the time at which the walk reaches each character, and the time at which it leaves the last."""
    classes = ((flat * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
    reached = np.zeros(len(flat), np.int32)
    order = np.argsort(-size, kind="stable")
    start, length = begin[order], size[order]
    now = np.zeros(len(order), np.int32)
    steps = np.arange(tile)
    for lo in range(0, int(length[0]), tile):
        n = int(np.searchsorted(-length, -lo, side="left"))
        spots = start[:n, None] + (lo + steps)[None, :]
        part = classes[np.minimum(spots, len(flat) - 1)].T.astype(np.int32)
        seen = np.empty((tile, n), np.int32)
        live = np.searchsorted(-length[:n], -(lo + steps), side="left").tolist()
        for i, m in enumerate(live):
            if not m:
                break
            t = now[:m]
            seen[i, :m] = t
            t += _STAY[((t & (PERIOD - 1)) << 8) | part[i, :m]]
        inside = (lo + steps)[None, :] < length[:n, None]
        reached[spots[inside]] = seen.T[inside]
    end = np.empty(len(order), np.int64)
    end[order] = now
    return reached, end


def fingerprints(codes: list[np.ndarray]) -> list[str]:
    """One string for each text, given as code points: level, then two scales of hex digits ('-' past the end)."""
    if not codes:
        return []
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    offset = np.cumsum(sizes) - sizes
    flat = np.concatenate(codes)
    blocks = -(-sizes // BLOCK)
    first = np.cumsum(blocks) - blocks
    nth = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    begin = np.repeat(offset, blocks) + nth * BLOCK
    size = np.minimum(BLOCK, np.repeat(sizes, blocks) - nth * BLOCK)
    levels = np.array([max(4, (int(n) - 1).bit_length()) for n in sizes], np.int64)
    digits = np.full((len(codes), 2 * SAMPLES), PAD, np.uint8)
    if len(begin):
        reached, end = _walk(flat, begin, size)
        span = 40 * BLOCK
        line = reached + np.repeat(np.arange(len(begin)) * span, size)
        times = np.floor(_TIMES[None, None, :] * np.exp2(levels[:, None] + np.arange(2)[None, :])[:, :, None]).astype(np.int64).reshape(len(codes), -1)
        block, local = times // (2 * BLOCK), times % (2 * BLOCK)
        last = block == blocks[:, None] - 1
        text, sample = np.nonzero(block < blocks[:, None])
        row, at = first[text] + block[text, sample], local[text, sample]
        inside = ~last[text, sample] | (at < end[row])
        text, sample, row, at = text[inside], sample[inside], row[inside], at[inside]
        place = np.searchsorted(line, row * span + at, side="right") - 1
        top = (offset + sizes - 1)[text]
        h = flat[place] * np.uint32(0x9E3779B1) + flat[np.minimum(place + 1, top)] * np.uint32(0x85EBCA6B) + flat[np.minimum(place + 2, top)] * np.uint32(0xC2B2AE35)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        digits[text, sample] = (h ^ (h >> np.uint32(16))) >> np.uint32(12) & np.uint32(15)
    raw = _DIGIT[digits].tobytes().decode()
    width = 2 * SAMPLES
    return [f"{level:02x}{raw[i * width : (i + 1) * width]}" for i, level in enumerate(levels.tolist())]


_VALUE = np.zeros(256, np.uint8)
_VALUE[_DIGIT] = np.arange(17)


def _scales(fingerprint: str) -> tuple[int, np.ndarray, np.ndarray]:
    digits = _VALUE[np.frombuffer(fingerprint[2:].encode(), np.uint8)]
    return int(fingerprint[:2], 16), digits[:SAMPLES], digits[SAMPLES:]


def near(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1; equal ones have 1."""
    if a == b:
        return 1.0
    (la, a0, a1), (lb, b0, b1) = _scales(a), _scales(b)
    if abs(la - lb) > 1:
        return 0.0
    x, y = (a0, b0) if la == lb else (a1, b0) if la < lb else (a0, b1)
    met = (x != PAD) | (y != PAD)
    if not met.any():
        return 0.0
    share = float((x[met] == y[met]).mean())
    return max(0.0, (share - 1 / 16) / (1 - 1 / 16))


def band_keys(fingerprint: str) -> list[int]:
    """Keys of the bands of both scales, so that texts of neighbouring levels can meet: ``WIDTH`` whole samples, 32 bits, hashed with band and scale.

    A sample's four bits differ together, so whole samples tell strangers apart
    better than single bits do at the same loss.  A band of which the walk
    reached fewer than three quarters says little and has no key, but for texts
    of at most 16 characters.
    """
    level, own, above = _scales(fingerprint)
    keys = []
    for scale, digits in ((level, own), (level + 1, above)):
        picked = digits[_BAND].astype(np.uint64)
        h = (picked << (np.uint64(5) * np.arange(WIDTH, dtype=np.uint64))).sum(1, dtype=np.uint64)
        h = (h ^ (np.uint64(scale) << np.uint64(40)) ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(46))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        told = (picked == PAD).sum(1) <= WIDTH // 4
        keys += (h if level == 4 else h[told]).view(np.int64).tolist()
    return keys


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _rows(batches: Iterator[pa.RecordBatch], chunk: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    import hashlib

    def flush(pairs: list[tuple]) -> pa.RecordBatch:
        """Rows (doc_id, text, edited text), the last row's successor included in ``pairs`` as (.., None)."""
        texts = {}
        for _, text, edited in pairs:
            texts.setdefault(text)
            if edited is not None:
                texts.setdefault(edited)
        prints = dict(zip(texts, fingerprints([_codes(t) for t in texts])))
        rows = []
        for (doc_id, text, edited), (_, after, _) in zip(pairs, pairs[1:]):
            own, cut, nxt = prints[text], prints[edited], prints[after]
            shared = len(set(band_keys(own)) & set(band_keys(cut)))
            rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, cut, near(own, cut), near(own, nxt), shared))
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "bands_shared"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    held, size, part, before, closed = [], 0, None, None, False
    for batch in batches:
        for p, kind, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            if p != part:
                if held:
                    yield flush([*held, (None, "", None)]) if before is None else flush(held)
                held, size, part, before, closed = [], 0, p, None, False
            if closed:
                continue
            if before is not None:
                own = before[1]
                n = len(own) // 2
                held.append((before[0], own, own[: len(own) - n] + text[:n]))
                size += len(own) * 2
                if kind or size >= chunk:
                    yield flush([*held, (None, text, None)])
                    held, size = [], 0
            before, closed = (doc_id, text), bool(kind)
    # every part ends with a row of kind 1, so nothing is held here


def fingerprint_rows(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses to the edited and to the next text.

    Rows are dealt by ranges of doc_id.  Each range also gets a copy of the
    first row of the range after it (the last range of the first row of all),
    so one pass over sorted ranges sees every row's successor.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    parts = parts or max(1, source.rdd.getNumPartitions() * 2)
    cuts = np.zeros(0, np.int64)
    if parts > 1:
        found = source.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 20 * parts)).first()[0] or []
        cuts = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def part_of(ids):
        return ids.__class__(np.searchsorted(cuts, ids.to_numpy(np.int64), side="left").astype(np.int32))

    heads = [tuple(r) for r in source.select(order.alias("k")).groupBy(part_of("k").alias("p")).agg(F.min("k").alias("head")).orderBy("p").collect()]
    if not heads:
        return source.mapInArrow(lambda batches: iter(()), _SCHEMA)
    head, before = np.array([h for _, h in heads], np.int64), np.array([heads[-1][0], *[p for p, _ in heads[:-1]]], np.int32)

    @F.pandas_udf("int")
    def copy_to(ids):
        """The range before the one that this row heads, else -1."""
        at = np.minimum(np.searchsorted(head, ids.to_numpy(np.int64)), len(head) - 1)
        return ids.__class__(np.where(head[at] == ids.to_numpy(np.int64), before[at], -1).astype(np.int32))

    placed = source.withColumn("p", part_of(order)).withColumn("c", copy_to(order))
    own, copy = F.struct("p", F.lit(0).alias("kind")), F.struct(F.col("c").alias("p"), F.lit(1).alias("kind"))
    dealt = placed.select(F.explode(F.when(F.col("c") >= 0, F.array(own, copy)).otherwise(F.array(own))).alias("at"), "doc_id", "text")
    dealt = dealt.select("at.p", "at.kind", "doc_id", "text").repartitionById(len(cuts) + 1, "p")  # a range a task
    return dealt.sortWithinPartitions("p", "kind", F.asc_nulls_first("doc_id"), "text").mapInArrow(_rows, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, bands_shared long"


def _likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """``near`` of many pairs at once."""
    cut = lambda x: _VALUE[np.frombuffer("".join(f[2:] for f in x).encode(), np.uint8)].reshape(-1, 2, SAMPLES)
    la, lb = (np.array([int(f[:2], 16) for f in x]) for x in (a, b))
    x, y, at = cut(a), cut(b), np.arange(len(a))
    x, y = x[at, (la < lb).astype(int)], y[at, (la > lb).astype(int)]
    met = (x != PAD) | (y != PAD)
    share = ((x == y) & met).sum(1) / np.maximum(met.sum(1), 1)
    out = np.where((abs(la - lb) > 1) | ~met.any(1), 0.0, np.maximum(0.0, (share - 1 / 16) / (1 - 1 / 16)))
    return np.where([f == g for f, g in zip(a, b)], 1.0, out)


def _prints(docs: DataFrame, keys=band_keys) -> DataFrame:
    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo in range(0, len(texts), 500):
                part = texts[lo : lo + 500]
                prints = fingerprints([_codes(t) for t in part])
                digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 500), pa.array(digests, pa.binary()), pa.array(prints), pa.array([keys(p) for p in prints], pa.list_(pa.int64()))], names=["doc_id", "digest", "fingerprint", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(printed, "doc_id long, digest binary, fingerprint string, bands array<long>")


def text_classes(docs: DataFrame) -> DataFrame:
    """(rep, doc_id) of every document: equal texts are one class, named by its smallest id in ``near_pairs``."""
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))
    return rows.join(rows.groupBy("digest").agg(F.min("doc_id").alias("rep")), "digest").select("rep", "doc_id")


def near_pairs(docs: DataFrame, threshold: float = 0.7, block: int = 1000, keys=band_keys) -> DataFrame:
    """Pairs (leader, member, likeness) of differing texts, smaller id first, that link all texts near in a bucket.

    Equal texts are one, see ``text_classes``.  Differing texts of equal
    fingerprints pair with the smallest id, likeness 1; that id alone goes on.
    It is compared with its buckets' smallest ids.  A bucket that is then not within one component is
    compared in full, members of one component with those of the others; a
    large one in blocks of about ``block`` classes, so no task holds it whole.
    Pairs within a component are not all listed.
    """
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                like = _likenesses(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(like, pa.float64())], names=["leader", "member", "likeness"])
                yield out.filter(pa.array(like >= threshold))

    differing = _prints(docs, keys).groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("fingerprint").alias("fingerprint"), F.first("bands").alias("bands"))
    differing = written(differing.where("id is not null"), "prints")
    classes = written(differing.groupBy("fingerprint").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")
    same = differing.join(classes.select("fingerprint", "rep"), "fingerprint").where("id <> rep").select(F.col("rep").alias("leader"), F.col("id").alias("member"), F.lit(1.0).alias("likeness"))
    texts = classes.select("rep", "fingerprint")

    def verified(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(texts.select(F.col("rep").alias("leader"), F.col("fingerprint").alias("fa")), "leader").join(texts.select(F.col("rep").alias("member"), F.col("fingerprint").alias("fb")), "member")
        return written(joined.select("leader", "member", "fa", "fb").mapInArrow(verify, "leader long, member long, likeness double"), "near")

    keyed = classes.select("rep", F.explode(F.array_distinct("bands")).alias("key"))
    leaders = written(keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1"), "leaders")
    led = verified(keyed.join(leaders, "key").where("rep <> leader").select("leader", F.col("rep").alias("member")).distinct())
    linked = components(led.select(F.col("leader").alias("u"), F.col("member").alias("v")))
    held = keyed.join(leaders, "key").join(linked.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    held = written(held, "buckets")
    open_ = held.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    salts = F.floor(F.col("n") / block) + 1
    rest = held.join(open_, "key").where("rep <> leader").withColumn("salt", F.pmod(F.xxhash64("rep"), salts))
    a = rest.select("key", "salt", F.col("rep").alias("a"), F.col("component").alias("ca"))
    b = rest.select("key", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.col("rep").alias("b"), F.col("component").alias("cb"))
    pairs = a.join(b, ["key", "salt"]).where("a < b and ca <> cb").select(F.col("a").alias("leader"), F.col("b").alias("member")).distinct()
    return led.unionByName(verified(pairs)).unionByName(same)
