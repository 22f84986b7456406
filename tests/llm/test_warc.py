import base64
import gzip
import hashlib
from collections import Counter

import pyarrow as pa
import pyarrow.fs as pafs
import pytest

from odflow.llm import warc as W


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_query_matches_brute_force(spark, edge_dir, which):
    path = "/root/testdata/sf0.01" if which == "sf" else edge_dir
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{path}/pages.parquet").collect()]
    first = {}
    for i, h in pages:
        if i is not None:
            first[digest(h)] = min(i, first.get(digest(h), i))
    want = Counter()
    for i, h in pages:
        d = digest(h)
        again = d in first and first[d] != i
        want[i, len((h or "").encode()), d, "revisit" if again else "response", first[d] if again else None] += 1
    got = W.op3_warc_archive(spark, path).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    assert all(r.payload_intact is (True if r.record_type == "response" else None) for r in got)


def test_empty(spark, empty_dir):
    assert W.op3_warc_archive(spark, empty_dir).count() == 0


def write(spark, tmp_path):
    path = str(tmp_path / "w")
    W.archive(spark.createDataFrame([(1, "http://a/1", "x" * 10), (2, "http://b/2", "x" * 10), (3, "http://a/3", "y" * 200_000)],
                                    "page_id long, url string, html string").repartition(2), path)
    return path


def test_filters_and_payloads_are_pushed_down(spark, tmp_path):
    path = write(spark, tmp_path)
    df = W.read_warc(spark, path, payload=False).filter("record_type = 'response' and target_uri like 'http://a/%'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert sorted((r.target_uri, r.payload_length, r.payload) for r in df.collect()) == [("http://a/1", 10, None), ("http://a/3", 200_000, None)]
    revisit = W.read_warc(spark, path).filter("record_type = 'revisit'").first()
    assert (revisit.refers_to, revisit.payload_length, bytes(revisit.payload)) == ("<urn:page:1>", 10, b"")


def test_members_are_plain_gzip_and_foreign_files_are_read(spark, tmp_path):
    path = write(spark, tmp_path)
    plain = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("*.warc.gz"))
    other = tmp_path / "other"
    other.mkdir()
    (other / "a.warc").write_bytes(plain)
    (other / "b.warc.gz").write_bytes(gzip.compress(plain))        # one member, no lengths
    parts = [p + b"\r\n\r\n" for p in plain.split(b"\r\n\r\nWARC/1.1")]
    parts = [parts[0], *[b"WARC/1.1" + p for p in parts[1:]]]
    (other / "c.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    got = Counter((r.record_id, r.payload_length, hashlib.md5(bytes(r.payload)).hexdigest()) for r in W.read_warc(spark, str(other)).collect())
    want = Counter((r.record_id, r.payload_length, hashlib.md5(bytes(r.payload)).hexdigest()) for r in W.read_warc(spark, path).collect())
    assert got == {k: 3 * n for k, n in want.items()}


def test_uncommitted_files_are_not_read(spark, tmp_path):
    path = write(spark, tmp_path)
    before = W.read_warc(spark, path).count()
    W.WarcWriter(path).write(iter([pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": "<urn:x>", "payload": b"lost"}])]))
    assert W.read_warc(spark, path).count() == before


def test_skipping_does_not_inflate_payloads(tmp_path, monkeypatch):
    rows = [{"record_id": f"<{i}>", "record_type": "response", "payload": bytes([i]) * 3_000_000} for i in range(4)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(W.member(W.record_bytes(r)) for r in rows))
    asked = []
    inside = W.Inflated._more
    monkeypatch.setattr(W.Inflated, "_more", lambda self: asked.append(1) or inside(self))
    got = list(W.records(W.Source(pafs.LocalFileSystem().open_input_file(str(path))), lambda r: r["record_id"] == "<2>", False))
    assert [r["payload_length"] for r in got] == [3_000_000] and len(asked) <= 4


def _ids(spark, path):
    return sorted(r.record_id for r in W.read_warc(spark, path).collect())


def test_appends_add_and_overwrites_replace(spark, tmp_path):
    path = str(tmp_path / "w")
    pages = lambda *ids: spark.createDataFrame([(i, f"http://{i}", f"text {i}") for i in ids], "page_id long, url string, html string")
    W.archive(pages(1), path)
    W.archive(pages(2, 3), path)
    assert _ids(spark, path) == ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    W.archive(pages(4), path, mode="overwrite")
    assert _ids(spark, path) == ["<urn:page:4>"]
    W.archive(pages(5), path)
    assert _ids(spark, path) == ["<urn:page:4>", "<urn:page:5>"]
    assert len(list((tmp_path / "w").glob("*.warc.gz"))) == len(list((tmp_path / "w").glob("*.json"))) == 2
    W.archive(pages(), path, mode="overwrite")
    assert _ids(spark, path) == []


def test_a_replaced_manifest_does_not_count_before_it_is_gone(spark, tmp_path):
    path = write(spark, tmp_path)
    old = [p.name for p in (tmp_path / "w").glob("*.json")]
    (tmp_path / "w" / f"{W.MANIFEST}new.json").write_text(f'{{"files": [], "replaces": ["{old[0]}"]}}')
    assert _ids(spark, path) == []


def test_paths_are_resolved_as_spark_does(spark, tmp_path):
    assert W.resolved(spark, str(tmp_path)) == f"file:{tmp_path}"
    W.register(spark)
    with pytest.raises(Exception, match="scheme"):
        spark.read.format("warc").load(str(tmp_path)).count()
    assert W._open(f"file:{tmp_path}")[1] == str(tmp_path)
