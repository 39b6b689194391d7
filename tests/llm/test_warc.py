import gzip
import io
import os
import zlib

import pytest

from newsgraph.llm import warc
from tests.llm import brute


def rows():
    big = "x" * 150
    out = [(i, f"http://h/{i}", f"<p>{i}</p>" * 30) for i in range(20)]
    out += [(100 + i, "http://hot/", big) for i in range(30)]
    out += [(50, "u", big), (50, "u", big), (200, "u", "short"), (201, "u", "short"), (202, None, None), (203, "a\r\nb: c é", ""),
            (None, "n", big), (None, "n", "only without id " * 20), (None, "m", "only without id " * 20),
            (204, "u", "y" * 100), (205, "u", "y" * 100), (206, "u", "z" * 99), (207, "u", "z" * 99),
            (208, "u", "é\r\n\r\nWARC/1.1\r\n\0" * 30), (209, "u", "long " * 200_000)]
    return out


def expected(table):
    first = {}
    for i, _, h in table:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, (i is None, i or 0)), (i is None, i or 0))
    out, seen = [], set()
    for i, _, h in table:
        b = (h or "").encode()
        kind, to = "response", None
        if b in first and ((i is None, i or 0) != first[b] or b in seen):
            kind, to = "revisit", None if first[b][0] else first[b][1]
        elif b in first:
            seen.add(b)
        out.append((i, len(b), brute.sha(b), kind, to))
    return sorted(out, key=repr)


def pages(spark, table, extra=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(table, "page_id long, url string, html string")
    if extra:
        for c in ("file", "seq", "digest", "size", "idx"):
            df = df.withColumn(c, F.lit("y"))
    return df.repartition(4)


@pytest.mark.parametrize("extra,size", [(False, 32 << 20), (True, 500)])
def test_round_trip(spark, monkeypatch, extra, size):
    monkeypatch.setattr(warc, "FILE_BYTES", size)
    got = warc.op7(pages(spark, rows(), extra)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows())


def test_members_and_index(spark, tmp_path):
    records = warc.write_monoliths(pages(spark, rows()), str(tmp_path))
    raw = {r.file for r in records.collect()}
    for name in raw:  # one member for the whole file
        engine = zlib.decompressobj(31)
        engine.decompress(open(name, "rb").read())
        assert engine.eof and not engine.unused_data
    files = warc.normalise(records, str(tmp_path)).collect()
    assert sum(f.n for f in files) == len(rows())
    import json
    for f in files:
        data = open(f.file, "rb").read()
        entries = [json.loads(x) for x in open(f.idx)]
        assert sum(e["length"] for e in entries) == len(data) == os.path.getsize(f.file)
        for e in entries:
            block = gzip.decompress(data[e["offset"]:e["offset"] + e["length"]])
            assert block.startswith(b"WARC/1.1\r\n") and block.endswith(warc.END)
            assert e["id"].encode() in block


def test_truncated_archive_is_an_error():
    block = warc.header("response", 1, "u", "0", 5) + b"hello" + warc.END
    assert [p for _, p in warc.records_of([block[:30], block[30:] + block])] == [b"hello", b"hello"]
    with pytest.raises(ValueError):
        list(warc.records_of([block[:-6]]))
    two = zlib.compress(b"a", wbits=31) + zlib.compress(b"b", wbits=31)
    assert b"".join(warc.inflate(io.BytesIO(two))) == b"ab"


def test_empty_table(spark):
    assert warc.op7(pages(spark, rows()).limit(0)).collect() == []
