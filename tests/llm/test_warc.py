import hashlib
import io
import zlib

import numpy as np
import pytest

from quillsieve.llm.warc import _member, _record, read_warc, records, round_trip, write_warc
from quillsieve.plans.cut import fresh_path


@pytest.mark.parametrize("split", [1, 97, 1000, 10**9])
def test_every_split_reads_each_record_once(split):
    rng = np.random.default_rng(3)
    payloads = [bytes(rng.integers(0, 256, int(n), np.uint8)) for n in rng.integers(0, 3000, 12)]
    payloads.append(zlib.compress(b"x" * 50, wbits=31) * 20)  # gzip magic within a payload
    data = b"".join(_member(_record(i, f"http://a/{i}", p, hashlib.sha256(p).hexdigest(), None), 0) for i, p in enumerate(payloads))
    got = []
    for start in range(0, len(data), split):
        got += [h["warc-record-id"] for h, _ in records(io.BytesIO(data), len(data), start, min(len(data), start + split))]
        if split == 1 and start > 4000:
            break
    if split > 1:
        assert got == [f"<urn:page:{i}>" for i in range(len(payloads))]
    else:
        assert got == [f"<urn:page:{i}>" for i in range(len(got))] and got


def test_round_trip(spark):
    big = "<p>é🙂</p>" * 30
    rows = [(5, "u", big), (3, "u", big), (9, None, big), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u\r\n", ""), (None, "u", big), (7, "u", "z" * 300_000), (3, "u", big), (10, "u", "x" * 100), (11, "u", "x" * 100), (12, "u", "y" * 99), (13, "u", "y" * 99)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= 100:
            first[b] = min(i, first.get(b, i))
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first[b] if i is not None and b in first and first[b] < i else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to))
    got = [tuple(r) for r in round_trip(pages, split=500).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_payloads_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a", "héllo")], "page_id long, url string, html string")
    r = read_warc(write_warc(pages, fresh_path(spark, "warc"))).first()
    assert (r.page_id, r.url, bytes(r.payload).decode()) == (1, "http://a", "héllo")
    assert round_trip(pages.where("page_id = 2")).count() == 0


def test_broken_archive_is_an_error():
    data = _member(_record(1, "u", b"x" * 5000, "0", None), 1)[:-40]
    with pytest.raises(zlib.error):
        list(records(io.BytesIO(data), len(data), 0, len(data)))
