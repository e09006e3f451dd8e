import hashlib

import numpy as np
import pytest

from quillsieve.llm import edit_embedding as ee
from quillsieve.llm.edit_embedding import band_keys, fingerprint_rows, fingerprints, near, near_pairs, text_classes


def _codes(t):
    return np.frombuffer(t.encode("utf-32-le"), np.uint32)


def _texts(n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(["ab", "cde", "é", "🙂x", "tion", "qu"], rng.integers(0, 400))) for _ in range(n)]


def test_equal_texts_equal_prints_whatever_the_batch():
    texts = _texts(30, 1) + ["", "x", "long " * 20_000]
    all_at_once = fingerprints([_codes(t) for t in texts])
    assert all_at_once == [fingerprints([_codes(t)])[0] for t in texts]
    assert near(all_at_once[0], all_at_once[0]) == 1.0
    assert near(all_at_once[-3], all_at_once[0]) == 0.0


def test_small_edits_stay_near_and_unrelated_texts_do_not():
    rng = np.random.default_rng(4)
    alphabet = list("abcdefghijklmnop ")
    edited, other = [], []
    for _ in range(20):  # how long a walk needs to fall back into step has a long tail, so the mean counts
        a, b = ("".join(rng.choice(alphabet, 3000)) for _ in range(2))
        inserted = a[:1500] + "zz" + a[1500:]
        fa, fb, fi = fingerprints([_codes(x) for x in (a, b, inserted)])
        edited.append(near(fa, fi))
        other.append(near(fa, fb))
    assert np.mean(edited) > 0.7 and min(edited) > 0.4 and max(other) < 0.2


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_against_plain_python(spark, parts):
    texts = _texts(40, 2)
    rows = [(i * 3, t, 1.5) for i, t in enumerate(texts)] + [(7, None, 0.0), (8, "", 0.0), (9 * 100, texts[0], 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_next double").repartition(4)
    got = {r.doc_id: r for r in fingerprint_rows(docs, parts).collect()}
    ordered = sorted((i, t or "") for i, t, _ in rows)
    assert len(got) == len(ordered)
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(t) // 2
        edited = t[: len(t) - n] + after[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        f, e, x = fingerprints([_codes(y) for y in (t, edited, after)])
        assert (r.fingerprint, r.edited_fingerprint) == (f, e)
        assert r.near_edited == pytest.approx(near(f, e)) and r.near_next == pytest.approx(near(f, x))


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc"), (1, "abc"), (None, "xyz")], "doc_id long, text string")
    got = fingerprint_rows(docs, 3).collect()
    assert sorted(((r.doc_id or -1), r.n_chars) for r in got) == [(-1, 3), (1, 3), (1, 3)]
    assert fingerprint_rows(spark.createDataFrame([], "doc_id long, text string"), 3).count() == 0
    assert fingerprint_rows(docs.where("text = 'xyz'"), 2).first().near_next == 1.0


def test_near_pairs_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list("abcdefgh "), 2000)) for _ in range(12)]
    rows = [(i, b) for i, b in enumerate(base)] + [(100 + i, b[:1700] + "!" + b[1701:]) for i, b in enumerate(base)] + [(200, base[0])]
    prints = dict(zip([i for i, _ in rows], fingerprints([_codes(t) for _, t in rows])))
    wanted = {(i, 100 + i) for i in range(12) if near(prints[i], prints[100 + i]) >= 0.8}
    got = {(r.leader, r.member) for r in near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), 0.8).collect()}
    assert got <= wanted and len(got) >= 0.9 * len(wanted) >= 5


def test_near_copies_behind_an_unlike_leader(spark):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcdefgh "), 2000)) for _ in range(6)]
    rows = [(0, "unlike " * 285)] + [(1 + i, b) for i, b in enumerate(base)] + [(101 + i, b[:1990] + "!") for i, b in enumerate(base)] + [(201, base[0])]
    prints = {i: fingerprints([_codes(t)])[0] for i, t in rows}
    ids = [i for i, _ in rows if i != 201]
    wanted = {(i, j) for i in ids for j in ids if i < j and near(prints[i], prints[j]) >= 0.8}
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for block in (1000, 3):
        got = {(r.leader, r.member): r.likeness for r in near_pairs(docs, 0.8, block, lambda p: [7]).collect()}  # all in one bucket
        assert set(got) == wanted and len(wanted) >= 4
        assert all(x == pytest.approx(near(prints[i], prints[j])) for (i, j), x in got.items())
    assert {(r.rep, r.doc_id) for r in text_classes(docs).collect()} == {(i, i) for i in ids} | {(1, 201)}


def plain_fingerprint(text):
    """The walk, one character and one step at a time."""
    codes = [ord(c) for c in text]
    level = max(4, (len(codes) - 1).bit_length()) if codes else 4
    blocks, out, m = [], "", 2**32
    for lo in range(0, len(codes), ee.BLOCK):
        now, spots = 0, []
        for i, c in enumerate(codes[lo : lo + ee.BLOCK], lo):
            spots.append((now, i))
            kind, at = (c * 2654435761 % m) >> 24, now % ee.PERIOD
            while not ee._MOVES[at][kind]:
                at, now = at + 1, now + 1
            now += 1
        blocks.append((spots, now))
    for scale in (level, level + 1):
        for t in ee._TIMES:
            block, local = divmod(int(t * 2**scale), 2 * ee.BLOCK)
            if block >= len(blocks) or block == len(blocks) - 1 and local >= blocks[block][1]:
                out += "-"
                continue
            i = max(i for start, i in blocks[block][0] if start <= local)
            a, b, c = (codes[min(i + k, len(codes) - 1)] for k in range(3))
            h = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % m
            h = (h ^ h >> 15) * 0x2C1B3C6D % m
            out += f"{(h ^ h >> 16) >> 12 & 15:x}"
    return f"{level:02x}{out}"


def test_walk_against_plain_python(monkeypatch):
    for block in (ee.BLOCK, 64):
        monkeypatch.setattr(ee, "BLOCK", block)
        texts = _texts(12, 6) + ["", "x", "🙂", "same " * 60, "a" * 700]
        assert fingerprints([_codes(t) for t in texts]) == [plain_fingerprint(t) for t in texts]


def test_copies_share_a_band_and_strangers_hardly():
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abcdefgh "), int(n))) for n in rng.integers(10, 3000, 600)]
    edited = []
    for t in texts:
        t = list(t)
        for p in rng.integers(0, len(t), max(1, len(t) // 150)):
            t[p] = str(rng.choice(["", "zz", "#"]))
        edited.append("".join(t)[: int(len(t) * rng.uniform(0.78, 1))])
    a, b = (fingerprints([_codes(t) for t in x]) for x in (texts, edited))
    close = [i for i in range(600) if near(a[i], b[i]) >= 0.75]
    met = [bool(set(band_keys(a[i])) & set(band_keys(b[i]))) for i in close]
    assert len(close) > 300 and np.mean(met) > 0.97
    keys = [set(band_keys(x)) for x in a]
    assert sum(bool(keys[i] & keys[i + 1]) for i in range(599)) < 6


def test_near_pairs_link_what_all_pairs_link(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh "), int(n))) for n in rng.integers(100, 1200, 150)]
    for t in list(texts):
        for _ in range(int(rng.integers(0, 4))):
            p = int(rng.integers(0, len(t)))
            texts.append(t[:p] + "#" + t[p + int(rng.integers(0, 3)) :])
    texts += texts[:20] + [None, "", ""]
    prints = fingerprints([_codes(t or "") for t in texts])
    wanted = {(i, j) for i in range(len(texts)) for j in range(i) if (texts[i] or "") != (texts[j] or "") and near(prints[i], prints[j]) >= 0.75}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = {(r.member, r.leader): r.likeness for r in near_pairs(docs, 0.75).collect()}
    assert all(near(prints[i], prints[j]) == pytest.approx(x) and x >= 0.75 for (i, j), x in pairs.items())
    for i, j in [*pairs, *((r.doc_id, r.rep) for r in text_classes(docs).collect())]:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    assert sum(find(i) == find(j) for i, j in wanted) >= 0.98 * len(wanted) > 100
