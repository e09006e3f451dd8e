"""Operator 4: near-duplicate documents by MinHash bands, odd sketches and full sets.

One scan gives every document the MinHash samples of its shingle set, the keys
of its bands, and an odd sketch: the samples folded into a parity bitmap, so
that the population count of two bitmaps' XOR estimates how many samples
differ.  Documents with one and the same set are one class; classes meet in
band buckets.  In a bucket every class is compared with one leader, the member
that meets the most classes in all its buckets, so a group of k copies costs
about k comparisons and most copies link to its centre.  Classes of buckets that are not one
component after that are joined exactly: with all shingles in one order, rare
ones first, two sets of the wanted similarity share a shingle in a
short prefix of each, at positions that leave room for the overlap.  A pair
is confirmed on its full shingle sets either way, so no pair that shares a
band loses its link, and no bucket is expanded into all its pairs.

Defined results: null, empty and blank texts have empty sets and link with
nothing; equal texts share a class; rows without ``doc_id`` are kept and link
with nothing (``component_id`` null); rows that repeat an id and its text are
judged alike (``deduplicated`` leaves one of them); rows that share an id but
differ in text are judged each by its own text and do not link each other's
groups; a text of any length is one set,
held by one task; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.plans.components import components
from quillsieve.llm.words import blocks, mix, release, shingle_sets, text_key
from quillsieve.plans.cut import scratch, written

SAMPLES, ROWS, BITS = 128, 4, 512
BANDS = SAMPLES // ROWS
SLACK = 0.27  # sketches drop only pairs estimated this far below the similarity, five standard deviations
SMALL_ROWS = 1_000_000  # a candidate list of at most so many (id, leader) rows, 16 bytes each, is broadcast
HUB = 256  # members of a leader that one task compares; more are dealt over tasks, each with a copy of the leader's set
_MULTIPLIER = np.random.default_rng(0xB0B).integers(1, 2**63, SAMPLES, np.uint64) | np.uint64(1)
_SALT = np.random.default_rng(0xCAFE).integers(1, 2**63, SAMPLES, np.uint64)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (n x BANDS) and odd sketches (n x BITS/8 bytes) of non-empty sorted shingle sets."""
    flat = np.concatenate(sets)
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.empty((len(sets), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        low[:, k] = np.minimum.reduceat(flat * _MULTIPLIER[k], start)
    own = mix(low + _SALT)
    bands = mix((own.reshape(len(sets), BANDS, ROWS) * _MULTIPLIER[:ROWS]).sum(2, dtype=np.uint64) + _SALT[:BANDS])
    bit = (own >> np.uint64(55)).astype(np.int64)  # 9 bits of 512
    parity = np.zeros((len(sets), BITS), np.uint8)
    np.add.at(parity, (np.repeat(np.arange(len(sets)), SAMPLES), bit.ravel()), 1)
    return bands.view(np.int64), np.packbits(parity & 1, axis=1)


def similarity_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity that two arrays of odd sketches (n x BITS/8) estimate."""
    z = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
    differ = -BITS / 2 * np.log1p(-2 * np.minimum(z, BITS // 2 - 1) / BITS)
    return np.clip(1 - differ / (2 * SAMPLES), 0, 1)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        texts = _texts(batch.column(1))
        for lo, hi in blocks(texts):
            sets = shingle_sets(texts[lo:hi])
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, bands, odd = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                b, o = signatures([sets[i] for i in full])
                for i, x, y in zip(full, b, o):
                    keys[i], bands[i], odd[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), x, y.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.binary()),
            ], names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "odd"])
    release()


def _likely(threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BITS // 8) for k in (2, 3))
                yield batch.filter(pa.array(similarity_of(a, b) >= threshold)).select([0, 1])

    return keep


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        texts = _texts(batch.column(2))
        for lo, hi in blocks(texts):
            sets = [s.view(np.int64) for s in shingle_sets(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))], names=["leader", "member", "shingles"]
            )
    release()


def _with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(leader, member, shingles) for ``wanted`` (leader, member): the member's full set, made where its text is."""
    texts = docs.select(F.col("node").alias("member"), "text")
    node = wanted.schema["member"].dataType.simpleString()
    small = wanted.count() <= SMALL_ROWS
    joined = texts.join(F.broadcast(wanted) if small else wanted, "member").select("leader", "member", "text")
    return written(joined.mapInArrow(_sets, f"leader {node}, member {node}, shingles array<long>"), "sets")


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those pairs (leader, member) whose full shingle sets reach the similarity, as edges (u, v).

    A leader of many members is met in parts of about ``HUB`` members, so the
    centre of a huge group of copies is no task's burden.
    """
    leaders = written(pairs.groupBy("leader").agg(F.floor(F.count("*") / HUB).alias("last")), "hubs")
    wanted = written(pairs.unionByName(leaders.select("leader", F.col("leader").alias("member"))), "pairs")
    held = _with_sets(docs, wanted).join(_sized(leaders), "leader")
    own = held.where("leader = member").select("leader", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("part"), F.col("shingles").alias("own"))
    met = held.where("leader <> member").withColumn("part", F.pmod(F.xxhash64("member"), F.col("last") + 1))
    both = F.size(F.array_intersect("own", "shingles")).cast("long")
    return (
        met.join(own.hint("merge"), ["leader", "part"])
        .withColumn("both", both).where(F.col("both") * 100 >= percent * (F.size("own") + F.size("shingles") - F.col("both")))
        .select(F.col("member").alias("u"), F.col("leader").alias("v"))
    )


def _prefix_pairs(docs: DataFrame, open_: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """All pairs (leader, member) across components of ``open_`` (rep, component) that can reach the similarity.

    A set's shingles are ordered by how many open sets hold them.  The larger
    of two similar sets shares one of its first size - ceil(t * size) + 1 with
    the smaller one's first size - ceil(2t / (1 + t) * size) + 1, at places
    that leave room for the overlap; shingles of one set only, which come
    first, are counted but never joined.  The odd sketches are part of the
    join's condition.
    """
    sets = _with_sets(docs, open_.select(F.col("rep").alias("leader"), F.col("rep").alias("member")))
    sets = sets.select(F.col("member").alias("rep"), F.size("shingles").alias("size"), "shingles").dropDuplicates(["rep"])
    held = written(sets.select("rep", "size", F.explode("shingles").alias("token")), "open-shingles")
    many = written(held.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "repeated-shingles")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("n", "token")) - 1
    kept = F.count("*").over(Window.partitionBy("rep"))
    probe = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    found = F.col("size") - F.ceil(F.col("size") * 2 * percent / (100 + percent)) + 1
    rows = held.join(many, "token").select("rep", "size", "token", (F.col("size") - kept + rank).alias("at"), probe.alias("probe"), found.alias("found")).where("at < probe")
    rows = rows.join(_sized(open_), "rep")
    words = [F.conv(F.hex(F.substring("odd", 1 + 7 * k, 7)), 16, 10).cast("long").alias(f"w{k}") for k in range(-(-BITS // 56))]
    rows = written(rows.join(sketch.select("rep", *words), "rep"), "prefixes")
    names = [f"w{k}" for k in range(len(words))]
    a = rows.select("token", *[F.col(c).alias(f"a_{c}") for c in ("rep", "size", "at", "component", *names)])
    b = rows.where("at < found").select("token", *[F.col(c).alias(f"b_{c}") for c in ("rep", "size", "at", "component", *names)])
    larger = "(a_size > b_size or (a_size = b_size and a_rep > b_rep))"
    room = f"least(a_size - a_at, b_size - b_at) * {100 + percent} >= {percent} * (a_size + b_size)"
    unlike = " + ".join(f"bit_count(a_{w} ^ b_{w})" for w in names)
    far = int(BITS / 2 * (1 - np.exp(-2 * (2 * SAMPLES * (1 - (percent / 100 - SLACK))) / BITS)))
    pairs = a.join(b.hint("merge"), ["token"]).where(f"a_component <> b_component and {larger} and b_size * 100 >= {percent} * a_size and {room} and {unlike} <= {far}")
    return pairs.select(F.least("a_rep", "b_rep").alias("leader"), F.greatest("a_rep", "b_rep").alias("member")).distinct()


def _sized(small: DataFrame) -> DataFrame:
    """``small`` for a join: to be broadcast only if it was counted to be small."""
    return F.broadcast(small) if small.count() <= SMALL_ROWS else small


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key (a hash of the text) for every row of ``docs`` (doc_id, text).

    Links need 100 * shared shingles >= ``percent`` * all shingles of the two.
    """
    with scratch() as block:
        return _judged(docs, percent, block)


def _judged(docs: DataFrame, percent: int, block) -> DataFrame:
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("text_key", text_key(F.col("text")))
    signed = written(source.select("doc_id", "text", "text_key").mapInArrow(_sign, "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, odd binary"), "signed")
    total = signed.count()
    usable = signed.where("set_key is not null and doc_id is not null")
    # ids are the nodes; where one has several texts, ids with their texts' hashes are
    several = usable.groupBy("doc_id").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).where("lo <> hi").limit(1).count()
    node = F.struct("doc_id", "text_key") if several else F.col("doc_id")
    id_of = (lambda n: n["doc_id"]) if several else (lambda n: n)
    source = source.withColumn("node", node)
    # equal sets have equal bands and sketches
    classes = usable.withColumn("node", node).groupBy("set_key").agg(F.min("node").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd"))
    reps = written(classes, "reps", total, 50_000)
    classes = reps.select("set_key", "rep")
    bucketed = reps.select("rep", F.explode("bands").alias("key"))
    shared = bucketed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(bucketed.join(written(shared, "shared", total * BANDS), "key"), "buckets", total * BANDS, 1_000_000)
    # a bucket's leader is the member that meets the most others in all its buckets: the centre of a group of copies
    met = written(members.groupBy("rep").agg(F.sum("n").alias("met")), "met", total)
    leaders = members.join(met, "rep").groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("met"), "rep")).alias("top"))
    leaders = written(leaders.select("key", F.col("top.rep").alias("leader")), "leaders", total * BANDS)
    members = members.join(leaders, "key").select("key", "rep", "leader")

    kind = reps.schema["rep"].dataType.simpleString()
    starred = members.where("rep <> leader").select("leader", F.col("rep").alias("member")).distinct()
    a, b = (reps.select(F.col("rep").alias(x), F.col("odd").alias(f"odd_{x}")) for x in ("leader", "member"))
    likely = starred.join(a, "leader").join(b, "member").select("leader", "member", "odd_leader", "odd_member")
    likely = likely.mapInArrow(_likely(percent / 100 - SLACK), f"leader {kind}, member {kind}").distinct()
    edges = written(_confirmed(source, likely, percent).distinct(), "links")
    label = written(components(edges).withColumnRenamed("node", "rep"), "labels", total)

    named = members.join(label, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    named = written(named, "named", total * BANDS, 1_000_000)
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_ = written(named.join(written(mixed, "mixed", total * BANDS), "key").select("rep", "component").distinct(), "open", total)
    more = written(_confirmed(source, _prefix_pairs(source, open_, reps.select("rep", "odd"), percent), percent), "links")
    # the new links join whole components
    over = more.join(label.select(F.col("rep").alias("u"), F.col("component").alias("cu")), "u", "left").join(label.select(F.col("rep").alias("v"), F.col("component").alias("cv")), "v", "left")
    over = components(over.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))).withColumnRenamed("component", "root")
    flat = classes.join(label, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("node"))
    by_set = written(flat.join(over, "node", "left").select("set_key", F.coalesce("root", "node").alias("component")), "by-set", total)
    short = signed.select("doc_id", "n_shingles", "text_key", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    component = F.coalesce(id_of(F.col("component")), "doc_id")
    named = short.join(by_set, "set_key", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_key")
    named = written(named, "judged", total)
    block.keep(named)
    return named


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each group; nothing but ids and text hashes is joined to them.

    Rows go by (id, hash of the text), so another text of the same id stays.
    What is joined is the shorter list, that of the rows that go; it is
    broadcast only if it was counted to be small.
    """
    with scratch() as block:
        judged = near_duplicates(docs, percent)
        gone = written(judged.where("not kept").select(F.col("doc_id").alias("gone_id__"), F.col("text_key").alias("gone_key__")).distinct(), "gone")
        twice = written(judged.where("kept and doc_id is not null").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_key"), "twice")
        block.keep(gone, twice)
        key = text_key(F.col("text"))
        match = lambda t, a, b: (F.col("doc_id").cast("long") == t[a]) & (key == t[b])
        kept = docs.join(_sized(gone), match(gone, "gone_id__", "gone_key__"), "left_anti")
        if not twice.count():
            return kept
        again = twice.select(F.col("doc_id").alias("twice_id__"), F.col("text_key").alias("twice_key__"))
        once = kept.join(_sized(again), match(again, "twice_id__", "twice_key__"), "left_anti")
        one = kept.join(_sized(again), match(again, "twice_id__", "twice_key__"), "left_semi").withColumn("key__", key).dropDuplicates(["doc_id", "key__"]).drop("key__")
        return once.unionByName(one)
