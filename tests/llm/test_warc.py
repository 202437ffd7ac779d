import gzip
import hashlib

from pyspark.sql import functions as F

from tripmart.llm.files import NewFile
from tripmart.llm.warc import MAGIC, base32_sha1, parsed, read_warc, record, records_in, write_warc

DDL = "page_id long, url string, html string, record_type string"


def pages(spark):
    rows = [(k, f"http://a.example/{k}?q=ä b\r\nX: y", f"<p>page {k % 7}</p>" * (k % 9), "z") for k in range(120)]
    rows += [(200, None, None, "z"), (201, "u", "", None), (None, "u", "only here", ""), (None, "u", "<p>page 1</p>", "")]
    rows += [(300, "u", "\x1f\x08 magic " + "gzip " * 30_000, ""), (301, "u", "naïve 漢", ""), (301, "u", "naïve 漢", "")]
    return spark.createDataFrame(rows, DDL)


def expected(rows):
    texts = [(i, (t or "").encode()) for i, _, t, _ in rows]
    first = {}
    for i, t in texts:
        if i is not None and (first.get(t) is None or i > first[t]):
            first[t] = i
        first.setdefault(t, None)
    out = []
    for i, t in texts:
        again = i != first[t]
        digest = base32_sha1(hashlib.sha1(t).hexdigest())
        out.append((i, len(t), digest, "revisit" if again else "response", first[t] if again else None))
    return sorted(out, key=repr)


def test_round_trip_for_any_range(spark):
    frame = pages(spark).repartition(3)
    manifest = write_warc(frame)
    want = expected(pages(spark).collect())
    for size in (97, 1000, 1 << 23):
        got = read_warc(spark, manifest, size).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted(map(tuple, got.collect()), key=repr) == want
    texts = {r.page_id: bytes(r.payload).decode() for r in read_warc(spark, manifest).where("payload is not null").collect()}
    assert texts[300].endswith("gzip ") and texts[301] == "naïve 漢"
    path = manifest.first().path
    whole = gzip.open(path.removeprefix("file:")).read()  # other tools read it, too
    assert whole.count(b"WARC/1.1\r\n") == manifest.first().records
    urls = read_warc(spark, manifest).select("url").distinct()
    assert not urls.where(F.col("url").rlike("[\\s]")).count()


def test_least_bytes_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcd", ""), (4, "u", "abcd", "")], DDL)
    kinds = {r.page_id: r.record_type for r in read_warc(spark, write_warc(frame, least_bytes=3)).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    manifest = write_warc(spark.createDataFrame([], DDL))
    assert manifest.collect() == [] and read_warc(spark, manifest).collect() == []


def test_false_magic_between_records(tmp_root):
    member = record(5, "http://a", b"payload", base32_sha1(hashlib.sha1(b"payload").hexdigest()), None, False)
    path = f"{tmp_root}/x.warc.gz"
    with NewFile(path) as out:
        out.write(MAGIC + b"no member" + MAGIC + member + member)
    found = [parsed(r) for r in records_in(path, 0, 10_000)]
    assert [r["payload"] for r in found] == [b"payload"] * 2 and found[0]["warc-record-id"] == "<urn:page:5>"
    starts = len(MAGIC + b"no member" + MAGIC)
    assert len(list(records_in(path, 0, starts))) == 0 and len(list(records_in(path, 0, starts + 1))) == 1
    assert len(list(records_in(path, starts + 1, 10_000))) == 1
