import numpy as np
import pytest

from quillsieve.llm.hashing import Block, coded, top_k


def brute(ids, codes, query_id, code, k):
    far = [(bin(int(code) ^ int(c)).count("1"), int(i)) for i, c in zip(ids, codes) if i != query_id]
    return sorted(far)[:k]


@pytest.mark.parametrize("n,k,bits", [(1, 3, 64), (40, 10, 64), (3000, 10, 64), (3000, 5, 12), (50, 100, 64)])
def test_block_is_exact(n, k, bits):
    rng = np.random.default_rng(n + k)
    codes = rng.integers(0, 2**bits - 1, n, np.uint64, endpoint=True)
    ids = rng.permutation(n).astype(np.int64)
    block = Block(ids, codes.view(np.int64))
    for q in range(0, n, max(1, n // 20)):
        near, far = block.top(int(ids[q]), codes[q], k)
        assert list(zip(far.tolist(), near.tolist())) == brute(ids, codes, ids[q], codes[q], k)


def test_query_against_brute_force(spark, monkeypatch):
    import quillsieve.llm.hashing as h

    monkeypatch.setattr(h, "BLOCK", 100)
    monkeypatch.setattr(h, "QUERIES", 3)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=64).tolist(), 0) for i in range(450)]
    rows += [(450, None, 0), (None, [1.0] * 64, 0), (451, [1.0, None, float("nan")], 0), (452, [], 0), (453, rows[0][1], 0), (453, rows[0][1], 0)]
    codes = coded(spark.createDataFrame(rows, "vec_id long, embedding array<double>, distance int"))
    held = {(r.id, r.code & (2**64 - 1)) for r in codes.collect()}
    plain = [(i, sum(1 << j for j, x in enumerate(v) if x is not None and x > 0)) for i, v, _ in rows if i is not None and v is not None]
    assert held == set(plain)
    got = {}
    for r in top_k(codes, codes.where("id % 50 = 0 or id = 453"), 7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.distance, r.neighbor_id))
    assert set(got) == {0, 50, 100, 150, 200, 250, 300, 350, 400, 453}
    by_id = dict(plain)
    for q, found in got.items():
        if q != 453:
            assert [x[1:] for x in sorted(found)] == brute([i for i, _ in plain], [c for _, c in plain], q, by_id[q], 7)


def test_empty(spark):
    empty = coded(spark.createDataFrame([], "vec_id long, embedding array<double>"))
    assert top_k(empty, empty).count() == 0
