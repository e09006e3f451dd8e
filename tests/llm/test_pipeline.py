"""The pipeline's rows against plain Python, stage by stage on what the stage before kept."""

import zlib
from collections import Counter

import numpy as np

import corpus_pipeline

from tests.llm.test_linededup_mixing import brute as lines_brute
from tests.llm.test_minhash import brute as near_brute


def _corpus(spark, folder):
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("aeioulnrst"), rng.integers(2, 8)))
    prose = lambda n: " ".join(word() + ("." if k % 9 == 8 else "") for k in range(n))
    passage = "\n".join(prose(20) for _ in range(8))
    rows = []
    for i in range(240):
        text = "\n".join(prose(int(rng.integers(20, 60))) for _ in range(int(rng.integers(1, 5))))
        kind = i % 12
        if kind == 1:
            text = " ".join((word().upper() + "!! ") * 3 for _ in range(40))
        elif kind == 2 and rows:
            text = rows[-2][1]
        elif kind == 3 and len(rows) > 3:
            w = rows[-3][1].split(" ")
            w[len(w) // 2] = "changed"
            text = " ".join(w)
        elif kind in (4, 5):
            text = text + "\n" + passage
        rows.append((i, text, str(rng.choice(["en", "de"])), f"s{i % 3 if i % 2 else 0}", len(text)))
    rows += [(900, None, "en", "s0", 0), (901, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    return rows


def test_stages_and_run(spark, tmp_path):
    from tokenizers import Tokenizer

    from quillsieve.llm.tokenize import default_path

    rows, sf = _corpus(spark, str(tmp_path)), str(tmp_path)
    docs, held = spark.read.parquet(f"{sf}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        out.write.parquet(f"{sf}/{len(held)}")
        docs = spark.read.parquet(f"{sf}/{len(held)}")
        held.append({r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect())
    judged, lined, near, mixed, packed = held
    junk = {i for i, *_ in rows if i % 12 == 1 and i < 900}
    assert set(judged) == {i for i, *_ in rows} - junk - {900, 901}
    want = lines_brute([(i, r.text) for i, r in judged.items()])
    assert {i: r.text for i, r in lined.items()} == {i: t for i, (t, n) in want.items() if t.strip() or not n}
    assert all(r.n_chars == len(r.text) for r in lined.values())
    kept = near_brute(sorted((i, r.text) for i, r in lined.items()))
    assert set(near) == {i for i, (_, _, k) in kept.items() if k} and len(near) < len(lined)
    assert set(mixed) <= set(near) and 0.4 * len(near) < len(mixed) < len(near)
    tokenizer = Tokenizer.from_file(default_path())
    seen = Counter()
    for p in packed:
        ids = np.array([*tokenizer.encode(mixed[p.doc_id].text, add_special_tokens=False).ids, 1], "<u4")
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
        seen[p.doc_id] += p.length
    assert set(seen) == set(mixed)
    again = corpus_pipeline.run(spark, sf).collect()
    assert Counter((p.doc_id, p.ids_crc32) for p in again) == Counter((p.doc_id, p.ids_crc32) for p in packed)
