import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from playmart.llm import queries, warc as W
from tests.conftest import tuples

PAGES = "page_id bigint, url string, html string, digest string, original bigint"
HTML = "<p>é🤣</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"


def rows():
    out = [(1, "http://a/1", HTML), (2, "http://a/2", HTML), (9, "http://a/9", HTML), (3, None, None),
           (4, "http://x/\r\nWARC-Type: no", ""), (5, "http://%0A/", "x" * 3_000_000), (6, "u", "one"),
           (None, "n", HTML), (7, "u", "two\n"), (7, "u", "two\n"), (8, "", "two\n"), (10, "z", "\r\n")]
    return out + [(100 + k, "hot", "hot page") for k in range(40)]


def table(spark, data):
    return spark.createDataFrame([(*r, "x", 1) for r in data], PAGES)


def expected(data):
    best = {}
    for i, _, h in data:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in data:
        raw, o = (h or "").encode(), best.get(h or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        response = i is None or i == o
        out.append((i, len(raw), digest, "response" if response else "revisit",
                    None if response else o))
    return out


def test_query_reads_back_what_was_written(spark, tmp_path):
    table(spark, rows()).write.parquet(str(tmp_path / "pages.parquet"))
    got = tuples(queries.op9_warc(spark, str(tmp_path)))
    assert sorted(got, key=str) == sorted(expected(rows()), key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_are_framed_records(spark, tmp_path, compression):
    path = str(tmp_path / "warc")
    W.write(table(spark, rows()).coalesce(1), path, compression=compression, file_records=5)
    files = [p for p in (tmp_path / "warc").iterdir() if p.name.startswith("part")]
    assert len(files) >= len(rows()) / 5
    read = gzip.open if compression == "gzip" else open
    found = []
    for p in files:
        with read(p, "rb") as f:
            found += list(W.parse(f.read()))
    assert sorted(r["url"] for r in found) == sorted(r[1] or "" for r in rows())
    assert sum(r["payload"] == HTML.encode() for r in found) == 2  # of 9, and of the row without id
    assert len({r["record_id"] for r in found}) == len({r[0] for r in rows()})
    back = W.read(spark, path)
    assert back.where("record_type = 'revisit'").agg(F.sum(F.octet_length("payload"))).first()[0] == 0


def test_small_payloads_are_responses(spark, tmp_path):
    path = str(tmp_path / "warc")
    W.write(table(spark, rows()), path, min_bytes=9)
    kinds = W.read(spark, path).where("url = 'hot'").select("record_type").distinct().collect()
    assert kinds == [("response",)]


def test_broken_archives_are_errors():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Target-URI: u\r\n"
            b"WARC-Payload-Digest: sha1:x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert [r["payload"] for r in W.parse(gzip.compress(good) + gzip.compress(good))] == [b"abc"] * 2
    for bad in (good[:-3], good.replace(b": 3", b": 2"), good[:40], gzip.compress(good)[:-12]):
        with pytest.raises(Exception):
            list(W.parse(bad))


def test_empty_table(spark, tmp_path):
    W.write(table(spark, []), str(tmp_path / "warc"))
    assert W.join_revisits(W.read(spark, str(tmp_path / "warc"))).count() == 0


def test_hot_payloads_and_responses_are_split(spark, tmp_path):
    """The largest join task of a table in which half of the rows share one payload."""
    rows = [(k, f"u{k}", "<p>hot</p>" * 40 if k % 2 else f"<p>{k}</p>" * 40) for k in range(4000)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
        W.write(df, str(tmp_path / "w"), compression="none")
        found = W.join_revisits(W.read(spark, str(tmp_path / "w")).repartition(8))
        got = found.groupBy("record_type").count().collect()
        assert {r["record_type"]: r["count"] for r in got} == {"revisit": 1999, "response": 2001}
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
