import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import linededup, mixing


def brute(rows):
    seen, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        gone = set()
        for at, chunk in linededup.passages(t.encode()):
            if seen.setdefault(chunk, (i, at)) != (i, at):
                gone.add(at)
        out[i] = (linededup.without(t.encode(), gone).decode(), len(gone))
    return out


def test_chunks_cover_and_resist_shifts():
    lines = [f"line {i}".encode() for i in range(200)]
    cuts = linededup.chunks(lines)
    assert [a for a, _ in cuts] == [0, *[b for _, b in cuts][:-1]] and cuts[-1][1] == 200
    shifted = linededup.chunks([b"new"] * 7 + lines)
    common = {(a + 7, b + 7) for a, b in cuts} & set(shifted)
    assert len(common) > 0.8 * len(cuts)


def test_against_brute_force(spark):
    rng = np.random.default_rng(8)
    passage = ["\n".join(f"shared {p} line {i}" for i in range(9)) for p in range(4)]
    rows = []
    for i in range(60):
        own = [f"own {i} {j} {rng.integers(99)}" for j in range(rng.integers(0, 8))]
        rows.append((i, "\n".join([*own, *(passage[int(p)] for p in rng.integers(0, 4, rng.integers(0, 3)))])))
    rows += [(100, None), (101, ""), (102, rows[5][1]), (103, "\n\n\n\n"), (104, "\n\n\n\n"), (None, passage[0]), (105, "a\nb\n" * 5000)]
    docs = spark.createDataFrame([(*r, "k", len(r[1] or "")) for r in rows], "doc_id long, text string, gone string, n_chars int").repartition(5)
    want = brute(rows)
    got = {r.doc_id: (r.text, r.chunks_removed) for r in linededup.line_deduplicated(docs).collect()}
    assert got.pop(None) == (passage[0], 0) and got.pop(100) == (None, 0)
    assert got == want and sum(n for _, n in want.values()) > 20
    kept = {r.doc_id: r for r in linededup.deduplicated(docs).collect()}
    assert all(kept[i].text == t and kept[i].n_chars == len(t) for i, (t, n) in want.items() if t.strip() or not n)
    assert not {i for i, (t, n) in want.items() if n and not t.strip()} & set(kept)


def repeated_runs(rows):
    """Non-blank lines (id, position) of all line runs of two non-blank lines or more that occur earlier, by comparing every two places."""
    ordered = [(i, k, t.split("\n")) for i, t in sorted(rows) for k in range(t.count("\n") + 1)]
    gone = set()
    for n, (i, k, lines) in enumerate(ordered):
        for _, j, other in ordered[:n]:
            m = 0
            while k + m < len(lines) and j + m < len(other) and lines[k + m] == other[j + m]:
                m += 1
            full = [x for x in range(k, k + m) if lines[x].strip()]
            if len(full) >= 2:
                gone |= {(i, x) for x in full}
    return gone


def test_every_repeated_run_goes_whole(spark):
    rows = []
    for n in range(2, 11):  # a passage of n lines in the middle of two differing documents, once with blank lines in it
        passage = [f"passage {n} line {i}" for i in range(n)]
        if n % 3 == 0:
            passage.insert(1, "")
        for d in range(2):
            rows.append((10 * n + d, "\n".join([f"head {n} {d} {i}" for i in range(n + 3 * d)] + passage + [f"tail {n} {d} {i}" for i in range(4 - d)])))
    rows += [(200, "head 5 0 0\nnew\npassage 7 line 2\npassage 7 line 3\n\nend"), (201, "\n" + rows[3][1] + "\n"), (202, "x\ny\nz\nx\ny"), (203, "one\n\ntwo"), (204, "one\n\n\ntwo"), (205, "new\nend")]
    want = repeated_runs(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in linededup.line_deduplicated(docs).collect()}
    for i, t in rows:
        assert [x for x in got[i].split("\n") if x.strip()] == [x for k, x in enumerate(t.split("\n")) if x.strip() and (i, k) not in want]
    whole = {x for _, t in rows for x in t.split("\n")}
    assert {x for t in got.values() for x in t.split("\n")} | {""} == whole | {""}
    assert 201 not in {r.doc_id for r in linededup.deduplicated(docs).collect()}


def test_texts_that_share_an_id(spark):
    a, u = "one line here\nsecond line here\nthird", "unique line\nanother unique\nlast unique"
    rows = [(1, a), (5, a), (5, u), (7, u), (7, u), (8, "x\n" + a + "\ny"), (2**62, u)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.text, r.chunks_removed) for r in linededup.line_deduplicated(docs).collect())
    assert got == sorted([(1, a, 0), (5, "", 2), (5, u, 0), (7, "", 2), (7, "", 2), (8, "x\ny", 2), (2**62, "", 2)])


def test_line_dedup_empty(spark):
    assert linededup.deduplicated(spark.createDataFrame([], "doc_id long, text string, n_chars long")).count() == 0


def _docs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(2500):
        source = "hot" if rng.random() < 0.4 else f"s{rng.integers(5)}"
        text = "word " * int(rng.integers(0, 60)) + rng.choice(["", "|", "a@b", "7", "licence"])
        rows.append((i, text, str(rng.choice(["en", "de", "fr"], p=[0.7, 0.2, 0.1])), source, "clash"))
    rows += [(None, "null id", "en", None, "x"), (9001, None, None, "hot", "x"), (9002, "", "en", "hot", "x"), (9002, "", "en", "hot", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, probability string")


def test_mixing_equals_sql(spark):
    docs = _docs(spark)
    got = mixing.mixed(docs).select("doc.doc_id", "source", "lang", "topic", "tokens", "probability", "sampled").toPandas()
    table = docs.drop("probability").toArrow()
    con = duckdb.connect()
    con.register("documents", table)
    want = con.sql(mixing.oracle()).df()
    key = ["doc_id", "source", "lang", "topic", "tokens", "sampled"]
    a, b = (x.assign(doc_id=x.doc_id.fillna(-1).astype(int)).sort_values([*key, "probability"]).reset_index(drop=True) for x in (got, want))
    assert a[key].values.tolist() == b[key].values.tolist()
    assert np.allclose(a.probability, b.probability, atol=1e-8)


def test_targets_are_met(spark):
    docs = _docs(spark)
    targets = {"source": {"hot": 0.1, "s0": 0.3, "s1": 0.2, "s2": 0.2, "s3": 0.1, "s4": 0.1}, "lang": {"en": 0.5, "de": 0.3, "fr": 0.2}}
    out = mixing.mixed(docs, targets=targets, keep=0.15, turns=30).selectExpr("source", "lang", "tokens * probability as t").toPandas()
    for d in ("source", "lang"):
        shares = out.groupby(d).t.sum() / out.t.sum()
        for k, v in targets[d].items():
            assert shares[k] == pytest.approx(v, abs=0.01)
    kept = mixing.sampled_documents(docs, targets=targets, keep=0.15)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_a_target_too_large_shrinks_the_sample(spark):
    docs = spark.createDataFrame([(i, "w" * 400, "en", "small" if i < 10 else "large") for i in range(100)], "doc_id long, text string, lang string, source string")
    got = {r.value: r for r in mixing.achieved(docs, {"source": {"small": 0.5, "large": 0.5}}, keep=0.7).where("dimension = 'source'").collect()}
    assert {v: r.target for v, r in got.items()} == {"small": 0.5, "large": 0.5}
    assert all(r.expected == pytest.approx(0.5, abs=mixing.TOLERANCE) for r in got.values())
    assert got["small"].size == pytest.approx(max(s for s in mixing.sizes(0.7) if s <= 0.2), abs=1e-6)


def test_contradicting_targets_are_reported(spark):
    docs = spark.createDataFrame([(i, "w" * 400, "en" if i < 50 else "de", "a" if i < 50 else "b") for i in range(100)], "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}}
    with pytest.warns(UserWarning, match="targets"):
        got = {(r.dimension, r.value): r for r in mixing.achieved(docs, targets, keep=0.5).collect()}
    assert abs(got["source", "a"].expected - 0.9) > 0.05 or abs(got["lang", "en"].expected - 0.1) > 0.05
    assert sum(r.expected for (d, _), r in got.items() if d == "source") == pytest.approx(1)


def test_topics_may_be_given_and_tokens_are_near_the_tokenizers(spark):
    from tokenizers import Tokenizer

    from quillsieve.llm.tokenize import default_path

    docs = _docs(spark).withColumn("theme", F.when(F.col("doc_id") % 2 == 0, "even"))
    out = mixing.mixed(docs, topic=F.col("theme"))
    assert {r.topic for r in out.select("topic").distinct().collect()} == {"even", "(none)"}
    if os.path.isdir("/root/testdata/sf0.001"):
        rows = mixing.mixed(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select("doc.text", "lang", "tokens").collect()
        tokenizer = Tokenizer.from_file(default_path())
        for lang in {r.lang for r in rows}:
            some = [r for r in rows if r.lang == lang]
            assert sum(r.tokens for r in some) == pytest.approx(sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in some), rel=0.12)


def test_mixing_empty(spark):
    assert mixing.sampled_documents(_docs(spark).where("doc_id = -5")).count() == 0


def test_listed_passes_all_listed_texts(spark):
    from pyspark.sql import functions as F

    from quillsieve.llm.linededup import _listed

    every = spark.range(20_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("key"))
    among = _listed(every.where("doc_id % 10 = 3"))
    hit = {r.doc_id for r in every.where(among(F.col("doc_id"), F.col("key"))).collect()}
    assert hit >= set(range(3, 20_000, 10)) and len(hit) < 2_000 + 0.1 * 18_000
    none = _listed(every.where("doc_id < 0"))
    assert every.where(none(F.col("doc_id"), F.col("key"))).count() == 0
