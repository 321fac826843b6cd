import gzip
import hashlib
from pathlib import Path

import cases

from txlake.llm import warc

PAGES = "page_id long, url string, html string, shard string, digest string, payload string, marker string"
X = ("keep",) * 4


def pages():
    long = "<p>" + "é" * 200 + "</p>"
    return [
        (5, "http://a/5", long, *X), (3, "http://a/3 x\r\nEvil: 1", long, *X), (9, None, long, *X), (3, "http://a/3", long, *X),
        (None, "http://n", long, *X), (None, None, "only here " * 50, *X), (None, "z", "only here " * 50, *X), (1, "http://a/1", "short", *X),
        (2, "http://a/2", "short", *X), (4, "http://a/4", None, *X), (6, "http://a/6", "", *X), (7, "é://ü", "q" * 99, *X), (8, "u", "q" * 99, *X),
        (10, "u", "r" * 100, *X), (11, "u", "r" * 100, *X), (-4, "u", "WARC/1.1\r\n\r\n" * 20, *X), (12, "u", "x\x00y" * 60000, *X),
    ]


def expected(rows):
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h, *_ in rows:
        p = (h or "").encode()
        f = first.get(h)
        revisit = len(p) >= 100 and f is not None and (i is None or i > f)
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", f if revisit else None, None if revisit else p))
    return sorted(out, key=repr)


def read(spark, folder):
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")


def test_round_trip(spark, tmp_path):
    rows = pages()
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path), shard_bytes=4000, max_file_bytes=1500)
    got = read(spark, str(tmp_path)).collect()
    plain = [(*r[:5], None if r[5] is None else bytes(r[5])) for r in got]
    assert sorted(plain, key=repr) == expected(rows)


def test_same_bytes_again(spark, tmp_path):
    df = spark.createDataFrame(pages(), PAGES)
    one = warc.write_archives(df, str(tmp_path / "a"), shard_bytes=4000).collect()
    two = warc.write_archives(df.repartition(5), str(tmp_path / "b"), shard_bytes=4000).collect()
    assert sorted(one) == sorted(two) and len(one) > 2
    for r in one:
        data = (tmp_path / "a/records" / r["file"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == r["sha256"] and len(data) == r["bytes"]
        text = gzip.decompress(data)
        assert text.count(b"WARC-Record-ID") == r["records"] and b"Evil" not in text.replace(b"%0D%0AEvil", b"")
    assert not [p for p in Path(tmp_path).rglob("*.tmp")]


def test_files_without_a_manifest_do_not_count(spark, tmp_path):
    df = spark.createDataFrame(pages()[:3], PAGES)
    warc.write_archives(df, str(tmp_path))
    (tmp_path / "records/shard-999999-00000.warc.gz").write_bytes(b"left over")
    assert read(spark, str(tmp_path)).count() == 3


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path))
    assert read(spark, str(tmp_path)).count() == 0


def test_cases_module():
    assert cases.documents()
