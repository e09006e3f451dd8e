import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("tokenizers")
from quillsieve.llm.packing import pack
from quillsieve.llm.tokenize import WordBPE, default_path

ODD = ["İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "it's they'll WE'RE 's x's", "a b c\x1cd\x85e", "é́ é ́x", "<|endoftext|> a<|startoftext|>b <|endof",
       "123 4५ ⅷ² x_y", "", "  \n\t ", "x" * 100 + " " + "ß" * 60, "日本語 テキスト！ 🙂🙂 a🙂b", "!!!'s!!", "a﻿b​c", "ǅungla ŉ ﬁ"]


def test_word_bpe_equals_library():
    bpe = WordBPE(default_path(), cached_words=20)
    for _ in range(3):
        for text, got in zip(ODD, bpe.encode([t.encode() for t in ODD])):
            assert got.tolist() == bpe.whole.encode(text, add_special_tokens=False).ids


def test_word_bpe_equals_library_at_every_length():
    rng = np.random.default_rng(3)
    letters = [*"etaoinshrdlu", "é", "ß", "語"]
    words = ["".join(rng.choice(letters, n)) + end for n in range(1, 60) for end in ("", ",", "'s", "7x")]
    bpe = WordBPE(default_path(), cached_words=100)
    for at in range(0, len(words), 90):  # the table is full between batches, by words and by ids
        part = words[at : at + 90]
        for word, got in zip(part, bpe.encode([w.encode() for w in part])):
            assert got.tolist() == bpe.whole.encode(word, add_special_tokens=False).ids


def test_words_of_all_lengths_merge_together():
    rng = np.random.default_rng(4)
    bpe, calls = WordBPE(default_path()), []
    ranks = bpe._ranks
    bpe._ranks = lambda a, b: calls.append(a.size) or ranks(a, b)
    text = " ".join("".join(rng.choice([*"etaoinshrdlu"], n)) for n in range(2, 49))
    assert bpe.encode([text.encode()])[0].tolist() == bpe.whole.encode(text, add_special_tokens=False).ids
    assert len(calls) < 48  # one look-up a merge of the longest word, not of every length


def test_table_holds_the_words_of_a_task():
    bpe, learned = WordBPE(default_path()), []
    learn = bpe._learn
    bpe._learn = lambda words: learned.append(len(words)) or learn(words)
    texts = [" ".join(f"{a}{b}{c}{d}" for b in "etaoinshrd" for c in "etaoinshrd" for d in "etaoinshrdlucmfwypvb").encode() for a in map(chr, range(0x4E00, 0x4E00 + 75))]
    for _ in range(2):
        for at in range(0, len(texts), 15):
            bpe.encode(texts[at : at + 15])
    assert sum(learned) == 150_000  # each word once


@pytest.mark.parametrize("partitions", [1, 7])
def test_pack_round_trip(spark, partitions):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "Straße", "tion", "x1", "heon."]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(0, 4000, 60)]
    rows = [*enumerate(texts), (1000, None), (1001, ""), (1002, texts[3]), (1002, texts[3]), (None, "null id")]
    docs = spark.createDataFrame([(i, t, "extra", 7) for i, t in rows], "doc_id long, text string, lang string, sequence_id int").repartition(partitions)
    got = pack(docs).collect()
    bpe = WordBPE(default_path())
    ids = {i: np.array([*bpe.whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        seen[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        copies = 2 if i == 1002 else 1
        count = np.zeros(len(x), int)
        for start, length in seen[i]:
            count[start : start + length] += 1
        assert (count == copies).all()
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    total = sum(map(len, ids.values())) + len(ids[1002])
    assert len(sequences) <= total / 2048 * 1.01 + 1


def test_pack_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
