import os
import re
import zlib

import numpy as np
import pytest

from quillsieve.llm import quality, toxicity

SF = "/root/testdata/sf0.1"
DATA = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_profile_against_plain_python():
    texts = ["Hello WORLD!! foo | foo foo. x### É\x0b a", "", "  ", "AB!! AB!! AB!!", "é" * 3 + " z"]
    p = quality.profile([t.encode() for t in texts])
    for i, t in enumerate(texts):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        n = max(1, len(w))
        assert p["n"][i] == len(w)
        assert p["upper"][i] == pytest.approx(sum(sum("A" <= c <= "Z" for c in x) > 1 and not any("a" <= c <= "z" for c in x) for x in w) / n)
        assert p["symbols"][i] == pytest.approx(sum(bool(re.search(r"([!-/:-@\[-`{-~])\1", x)) for x in w) / n)
        assert p["repeats"][i] == pytest.approx(sum(a == b for a, b in zip(w, w[1:])) / n)
        nonblank, cased = [c for x in w for c in x.encode()], [c for x in w for c in x if c.isascii() and c.isalpha()]
        assert p["letters"][i] == pytest.approx(sum(c > 127 or chr(c).isalpha() for c in nonblank) / max(1, len(nonblank)))
        assert p["caps"][i] == pytest.approx(sum(c.isupper() for c in cased) / max(1, len(cased)))
        assert p["stops"][i] == pytest.approx(sum(x[-1] in ".!?" for x in w) / n)


def test_em_recovers_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.8
    v = np.empty((20000, 4), np.int64)
    for k, (hit, false) in enumerate([(0.9, 0.02), (0.7, 0.01), (0.5, 0.01), (0.8, 0.03)]):
        low = np.where(truth, rng.random(20000) < false, rng.random(20000) < hit)
        v[:, k] = np.where(low, quality.LOW, quality.GOOD)
    patterns, inverse, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    good, tables, share = quality.fit_labellers(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.02
    assert abs(tables[0, 0, quality.LOW] - 0.9) < 0.03 and abs(tables[1, 0, quality.LOW] - 0.7) < 0.04
    assert ((good[inverse.ravel()] > 0.5) == truth).mean() > 0.95


def test_lone_votes_of_a_poor_labeller_do_not_decide():
    rng = np.random.default_rng(1)
    truth = rng.random(40000) < 0.8
    v = np.empty((40000, 4), np.int64)
    for k, (hit, false) in enumerate([(0.9, 0.01), (0.8, 0.01), (0.7, 0.01), (0.6, 0.08)]):
        v[:, k] = np.where(np.where(truth, rng.random(40000) < false, rng.random(40000) < hit), quality.LOW, quality.GOOD)
    patterns, inverse, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    good, tables, _ = quality.fit_labellers(patterns, counts.astype(float))
    by = {tuple(p): g for p, g in zip(patterns.tolist(), good)}
    assert by[2, 2, 2, 0] > 0.5 and by[0, 0, 2, 2] < 0.5
    assert tables[3, 1, quality.LOW] == pytest.approx(0.08, abs=0.02) and tables[0, 0, quality.LOW] == pytest.approx(0.9, abs=0.03)
    assert ((good[inverse.ravel()] > 0.5) == truth).mean() > ((v == quality.LOW).any(1) == ~truth).mean() + 0.05


def plain_votes(text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words]
    n = len(words)
    if not n:
        return "-" * 9
    raw, cased = "".join(words).encode(), [c for x in words for c in x if c.isascii() and c.isalpha()]
    marks = r"[!-/:-@\[-`{-~\x00-\x08\x0e-\x1f\x7f]"
    share = lambda hits: sum(map(bool, hits)) / n
    upper, symbols, bare = (share(f(x) for x in words) for f in (lambda x: sum("A" <= c <= "Z" for c in x) > 1 and not re.search("[a-z]", x), lambda x: re.search(f"({marks})\\1", x), lambda x: re.fullmatch(f"{marks}+", x)))
    caps, letters = sum(c.isupper() for c in cased) / max(1, len(cased)), sum(c > 127 or chr(c).isalpha() for c in raw) / len(raw)
    repeats, distinct, pairs = share(a == b for a, b in zip(low, low[1:])), len(set(low)) / n, len({(None, low[0]), *zip(low, low[1:])}) / n
    stops, length = share(x[-1] in ".!?" for x in words), len(raw) / n
    pick = lambda bad, good: "-" if bad else "+" if good else "?"
    return "".join([
        pick(upper >= 0.3, upper <= 0.02), pick(caps >= 0.1, caps <= 0.04), pick(symbols >= 0.05, symbols <= 0.005), pick(bare >= 0.05, bare <= 0.01), pick(letters <= 0.85, letters >= 0.93),
        pick(repeats >= 0.1, repeats <= 0.03), pick((distinct <= 0.35 or pairs <= 0.6) and n >= 30, distinct >= 0.45 and pairs >= 0.85), pick(stops >= 0.25 and n >= 20 or stops < 0.01 and n >= 60, 0.02 <= stops < 0.2),
        pick(length >= 8 or length <= 2.5, 3.5 <= length <= 6.6),
    ])


def plain_posteriors(counts, turns):
    """EM for ten kinds in plain loops: the posterior of good of each pattern."""
    m, total = 9, sum(counts.values())
    held = {}
    for p in counts:
        n = p.count("-")
        first = 0.5 / (1 + n) if n else 0.95
        held[p] = [first] + [(1 - first) * ((c == "-") / n if n else 1 / m) for c in p]
    for _ in range(turns):
        shares = [(sum(n * held[p][k] for p, n in counts.items()) + 1) / (total + m + 1) for k in range(m + 1)]
        table = {}
        for j in range(m):
            for k in range(m + 1):
                part = {v: sum(n * held[p][k] for p, n in counts.items() if p[j] == v) + 1 / 3 for v in "-?+"}
                table[j, k] = {v: x / sum(part.values()) for v, x in part.items()}
        before, held = held, {}
        for p in counts:
            like = [shares[k] * float(np.prod([table[j, k][p[j]] for j in range(m)])) for k in range(m + 1)]
            held[p] = [x / sum(like) for x in like]
        if max(abs(a - b) for p in counts for a, b in zip(held[p], before[p])) < quality.STILL:
            break
    good = [k for k in range(m + 1) if max(table[j, k]["-"] for j in range(m)) < 0.5]
    return {p: sum(h[k] for k in good) for p, h in held.items()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_quality_query_against_plain_python(spark):
    from collections import Counter

    from quillsieve.llm.queries import op7_quality

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    votes = {i: plain_votes(t) for i, t in texts.items()}
    posterior = plain_posteriors(Counter(votes.values()), quality.TURNS)
    got = {r.doc_id: r for r in op7_quality(spark, "/root/testdata/sf0.001").collect()}
    weights = quality.fit(docs).weights
    assert set(got) == set(texts)
    for i, r in got.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i])
        assert r.quality_votes == votes[i]
        assert r.quality_posterior == pytest.approx(posterior[votes[i]] if words else 0.0, abs=1e-5)
        if words:
            p = quality.profile([texts[i].encode()])
            count = Counter([int(h) % 768 for h in p["hash"]] + [768 + int(h) % 256 for h in p["shape"]])
            z = float(weights[-1]) + sum(float(weights[k]) * np.log1p(100 * n / len(words)) for k, n in count.items())
            assert r.quality_score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-3)
        assert r.quality_kept == (max(r.quality_score, r.quality_posterior) >= 0.5)


@DATA
def test_quality_on_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scored(docs.select("doc_id", "text"), quality.fit(docs)).join(labels, "doc_id").groupBy("quality", "quality_kept").count().collect()
    n = {(r.quality, r.quality_kept): r["count"] for r in out}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.05 * n[0, False]


def test_quality_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (3, " \n", "x"), (None, "plain words here", "x"), (4, "w " * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_score string")
    got = quality.scored(docs, quality.fit(docs)).collect()
    assert [r[2] for r in quality.kept(docs, quality.fit(docs)).collect()] == ["x"] * sum(r.quality_kept for r in got)
    assert len(got) == 6 and all(r.quality_score == 0 and not r.quality_kept for r in got if r.doc_id in (1, 2, 3))
    empty = docs.where("doc_id = 99")
    assert quality.scored(empty, quality.fit(empty)).count() == 0


def test_block_max_is_exact():
    rng = np.random.default_rng(1)
    x = np.where(rng.random((500, 60)) < 0.1, rng.random((500, 60)), 0)
    x[300:] *= np.where(rng.random((200, 60)) < 0.5, 0.01, 1)
    x[7] = x[8] = x[9]  # ties
    x /= np.maximum(np.sqrt((x * x).sum(1)), 1e-9)[:, None]
    example, term = np.nonzero(x)
    plain = x[:80] @ x.T
    for columns in (0, 5, 60):
        index = toxicity.BlockMaxIndex(example, term, x[example, term], 60, block=16, columns=columns)
        some = example < 80
        who, cosine = index.top(example[some], term[some], x[example[some], term[some]], 80, 7)
        assert np.allclose(cosine, np.sort(plain, 1)[:, ::-1][:, :7])
        assert all(i in w for i, w in enumerate(who) if x[i].any())
        assert who[7].tolist()[:3] == who[8].tolist()[:3] == [7, 8, 9]
        out, rest = index.top(example[some], term[some], x[example[some], term[some]], 80, 7, without=np.arange(80))
        np.fill_diagonal(plain, 0)
        assert np.allclose(rest, np.sort(plain, 1)[:, ::-1][:, :7]) and not any(i in w for i, w in enumerate(out))
        plain = x[:80] @ x.T
        assert 0 < index.read < index.held


def plain_terms(text):
    from collections import Counter

    out = Counter()
    for w in re.findall(rb"[a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())):
        out.update([w] * (len(w) >= 3) + [(k, w[:k]) for k in (4, 5, 6) if len(w) > k])
    return out


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_toxicity_query_against_plain_python(spark):
    import math

    from quillsieve.llm.queries import op6_toxicity

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in texts}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.doc_id in texts and not held_out[r.doc_id]}
    terms = {i: plain_terms(t) for i, t in texts.items()}
    names = sorted(labels)
    yes, no = sum(labels.values()), len(labels) - sum(labels.values())
    weight = {}
    for t in {t for i in names for t in terms[i]}:
        a, b = sum(labels[i] for i in names if t in terms[i]) / yes, sum(1 - labels[i] for i in names if t in terms[i]) / no
        idf = math.log((2 + len(texts)) / (1 + sum(t in x for x in terms.values()))) + 0.05
        weight[t] = idf * max(0.0, (a - b) * math.log((a + toxicity.UNSEEN[0]) / (b + toxicity.UNSEEN[1]))) ** toxicity.TELLING

    def vector(i):
        x = {t: (1 + math.log(n)) * weight[t] for t, n in terms[i].items() if weight.get(t)}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {t: v / norm for t, v in x.items()}

    vectors = {i: vector(i) for i in texts}

    def nearest(i, leave=None):
        near = sorted((-sum(v * vectors[e][t] for t, v in vectors[i].items() if t in vectors[e]), e) for e in names if e != leave)
        return [(e, -c) for c, e in near[: toxicity.K] if c < 0]

    def share(near):
        return sum(c**4 * labels[e] for e, c in near) / sum(c**4 for _, c in near) if near else math.nan

    left_out = np.array([share(nearest(i, i)) for i in names])
    some, y = ~np.isnan(left_out), np.array([labels[i] for i in names], float)
    knots, values = toxicity.monotone(left_out[some], y[some], np.ones(int(some.sum())))
    bare = (y[~some].sum() + yes / (yes + no)) / ((~some).sum() + 1)
    got = {r.doc_id: r for r in op6_toxicity(spark, folder).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        near = nearest(i)
        assert r.evidence_cosines == pytest.approx([c for _, c in near[:3]], abs=1e-9)
        assert [sum(v * vectors[n][t] for t, v in vectors[i].items() if t in vectors[n]) for n in r.evidence_ids] == pytest.approx(r.evidence_cosines, abs=1e-9)
        assert r.score == pytest.approx(float(np.interp(share(near), knots, values)) if near else bare, abs=1e-6)
        assert r.held_out == held_out[i] and r.predicted == (r.score >= 0.7)


def test_one_example_an_id_and_equal_texts_alike(spark):
    docs = spark.createDataFrame([(1, "scum and fool"), (1, "scum and fool"), (1, "other words"), (2, "plain words here"), (3, "scum and fool"), (4, "Scum"), (5, "  ")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.names.tolist() == [1, 2] and model.toxic.tolist() == [1.0, 0.0]
    got = [(r.doc_id, r.score) for r in toxicity.scored(docs, model).collect()]
    assert len({s for i, s in got if i == 3}) == 1 and len(got) == 7 and all(0 <= s <= 1 for _, s in got)


def test_terms_against_plain_python():
    texts = ["Abcdefg abc, ab x-yzéz ABCD", "", "vequille"]
    doc, term = toxicity.terms_of([t.encode() for t in texts])
    want = []
    for i, t in enumerate(texts):
        for w in re.findall(rb"[a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())):
            want += [(i, w)] * (len(w) >= 3) + [(i, (k, w[:k])) for k in (4, 5, 6) if len(w) > k]
    assert len(doc) == len(want)
    assert len(set(zip(doc.tolist(), term.tolist()))) == len(set(want))


@DATA
def test_toxicity_held_out(spark):
    from quillsieve.llm.queries import op6_toxicity

    got = op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert ((got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)) == got.held_out).all()
    recall = (got.predicted[got.toxic == 1] == 1).mean()
    wrong = (got.predicted[got.toxic == 0] == 1).mean()
    assert recall > 0.85 and wrong < 0.005
    assert abs(got.score.mean() - got.toxic.mean()) < 0.05


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 0), (None, "scum here", 0), (5, "scum " * 100_000, 1), (6, "scum", 1), (6, "scum", 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scored(docs, toxicity.fit(docs, none)).collect()] == [0.0] * 6
    labels = spark.createDataFrame([(5, 1), (2, 0), (6, None), (77, 1), (None, 1)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(docs.where("doc_id = 99"), toxicity.fit(docs.where("doc_id = 99"), labels)).count() == 0
