import base64
import gzip
import hashlib
import random

import pytest

from tidemark.llm.warc import archive_round_trip, lookup, make_record, parse_record, read_records, url_key, write_archives, write_index

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a.example.com/x", "<p>one"), (2, "http://a.example.com/x", "<p>two"), (3, None, "<p>one"), (4, "http://b.example.com:8080/?q=1#f", None),
    (5, "", ""), (6, "no url\r\nat all", "é" * 70_000), (None, "http://c.example.com", "<p>one"), (None, "http://c.example.com", "only here"),
    (7, "http://a.example.com/x", "<p>three"), (7, "http://a.example.com/x", "<p>three"),
]


def expected(rows, least):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "")]
        first = min((i for i in same if i is not None), default=None)
        revisit = len(same) > 1 and len(payload) >= least and first is not None and page_id != first
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5, 100])
def test_round_trip(spark, least, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "'x' as digest", "1 as first", "2 as key", "3 as offset").repartition(3)
    got = archive_round_trip(pages, str(tmp_path / "w"), least_revisit_bytes=least).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS, least)
    for path in (tmp_path / "w").glob("*.warc.gz"):  # ordinary gzip of ordinary records
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_index_over_many_blocks_and_parts(spark, tmp_path):
    pick = random.Random(1)
    rows = [(n, f"http://h{pick.randrange(9)}.example.com/{pick.randrange(40) if n % 3 else 0}", f"page {n}") for n in range(600)]
    folder = str(tmp_path / "w")
    write_archives(spark.createDataFrame(rows, PAGES), folder)
    # Blocks hold three captures, so a key runs over many of them, and the hottest over several parts.
    write_index(spark, folder, block_lines=3)
    wanted = [url_key(u) for _, u, _ in rows[::7]] + ["com,example,none)/", "", "zzz"]
    captures = lookup(spark.createDataFrame([(k,) for k in wanted], "key string"), folder)
    found = sorted((r.key, r.page_id) for r in captures.collect())
    assert found == sorted((url_key(u), i) for i, u, _ in rows if url_key(u) in set(wanted))
    assert read_records(captures, folder).count() == len(found)
    assert sum(r.blocks for r in spark.read.parquet(f"{folder}/index").collect()) >= 200


def test_keys():
    assert url_key("HTTPS://WWW.Example.com:443/A?b=c#d") == "com,example,www)/A?b=c"
    assert url_key("http://example.com") == "com,example)/"
    assert url_key("http://example.com:81/") == "com,example:81)/"
    assert url_key("http://[bad") == "http://[bad"


def test_damaged_payload_is_an_error():
    record = gzip.decompress(make_record(1, "u", b"payload", None, False, "2020-01-01T00:00:00Z"))
    with pytest.raises(ValueError, match="digest"):
        parse_record(gzip.compress(record.replace(b"payload\r", b"pay1oad\r")))


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0
