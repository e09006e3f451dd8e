import re

import numpy as np

from quillsieve.plans.components import components
from quillsieve.llm import minhash
from quillsieve.llm.minhash import deduplicated, near_duplicates, signatures, similarity_of
from quillsieve.llm.words import shingle_sets


def _set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [_set(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(rows[a][0]), find(rows[b][0])
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)}


def test_shingle_sets_match_plain_ones():
    texts = ["a b c d e f a b c d e", "A\x0bB\tc", "", " \n ", "x", "é É z y x w", "one two three four five one two three four five"]
    for t, got in zip(texts, shingle_sets([t.encode() for t in texts])):
        assert len(got) == len(_set(t))


def test_odd_sketch_estimates():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (1.0, 0.9, 0.75):
        a, b = base[:2000], np.concatenate([base[: int(2000 * share)], base[2000 : 4000 - int(2000 * share)]])
        j = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        _, odd = signatures([np.sort(a), np.sort(b)])
        assert abs(similarity_of(odd[:1], odd[1:])[0] - j) < 0.15


def test_against_brute_force(spark):
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for g in range(12):
        base = list(rng.choice(vocab, rng.integers(3, 120)))
        for _ in range(int(rng.integers(1, 14))):
            w = list(base)
            for _ in range(int(rng.integers(0, 6))):
                w[int(rng.integers(0, len(w)))] = str(rng.choice(vocab))
            rows.append((n, " ".join(w).upper() if n % 5 == 0 else " ".join(w)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one two"), (n + 4, "ONE  two\n"), (n + 5, "long " * 30_000), (n + 6, "long " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component_id int, leader string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(-1, None, True), (2, 2, True), (4, 2, False)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (45, 2))] + [(7, 7), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_words_that_swap_far_blocks_differ(spark):
    a, b = "a" * 4096 + "b" * 4096, "b" * 4096 + "a" * 4096
    c = "".join(chr(97 + i % 7) * 4096 for i in range(5))
    d = c[4096 * 2 : 4096 * 3] + c[4096 : 4096 * 2] + c[: 4096] + c[4096 * 3 :]
    rows = list(enumerate([a, b, c, d, a + " x", b + " x", c.upper()]))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_one_id_with_two_texts_and_repeated_rows(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(3, one, 1), (5, one, 2), (5, two, 3), (7, two, 4), (7, two, 4), (9, "alone here", 5), (9, "alone here", 5), (None, one, 6), (2**62, two + " end", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key int")
    got = sorted(((r.doc_id or -1), r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(-1, None, True), (3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False), (7, 5, False), (9, 9, True), (9, 9, True), (2**62, 5, False)]
    left = sorted((r.doc_id or -1, r.text, r.text_key) for r in deduplicated(docs).collect())
    assert left == [(-1, one, 6), (3, one, 1), (5, two, 3), (9, "alone here", 5)]


def test_a_leader_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUB", 4)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 30 + i % 3] + [f"x{i}"] + base[30 + i % 3 :])) for i in range(60)] + [(99, "quite another text of some words")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
