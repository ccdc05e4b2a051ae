import base64
import gzip
import hashlib
import os

import pytest

from pressgauge.llm import warc
from pressgauge.session import fresh_dir


def pages(spark, parts=3):
    rows = [(i, f"http://h/{i}?a=ü b%20", f"<p>page {i % 40} é</p>" * (1 + i % 40), "x") for i in range(200)]
    rows += [(5000, None, None, "y"), (5001, "u\r\nInjected: 1", "", "y"), (3, rows[3][1], rows[3][2], "z"), (None, "n", "null id", None), (3, "o", "other", "z")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(parts)


def brute(rows, least):
    first = {}
    for r in rows:
        if r.page_id is not None:
            data = (r.html or "").encode()
            first[data] = min(first.get(data, r.page_id), r.page_id)
    out, seen = [], set()
    for r in sorted(rows, key=lambda r: -1 if r.page_id is None else r.page_id):
        data = (r.html or "").encode()
        again = len(data) >= least and data in first and (first[data] != r.page_id or (r.page_id, data) in seen)
        seen.add((r.page_id, data))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((r.page_id, r.url, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 200])
def test_round_trip_against_brute_force(spark, least):
    docs, folder = pages(spark), fresh_dir(spark, "warc-test")
    got = warc.archive(docs, folder, least_bytes=least, shard_bytes=2000, file_bytes=1500).collect()
    found = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    assert found == brute(docs.collect(), least)
    whole = {r.page_id: bytes(r.html).decode() for r in warc.read(spark, folder, payloads=True).collect() if r.html is not None and r.page_id != 3}
    assert whole and all((r.html or "") == whole[r.page_id] for r in docs.collect() if r.page_id in whole)


def test_files_are_rolled_sorted_and_the_same_in_every_run(spark):
    manifests, folders = [], []
    for parts in (1, 5):
        folder = fresh_dir(spark, "warc-same")
        manifests.append(sorted(map(tuple, warc.write(pages(spark, parts), folder, shard_bytes=20_000, file_bytes=1000).collect())))
        folders.append(folder)
    assert manifests[0] == manifests[1] and len({m[0] for m in manifests[0]}) > 1 and len(manifests[0]) > len({m[0] for m in manifests[0]})
    ids = []
    for shard, file, records, size, digest in manifests[0]:
        path = os.path.join(folders[0].removeprefix("file:"), file)
        data = open(path, "rb").read()
        assert len(data) == size and hashlib.sha256(data).hexdigest() == digest
        text = gzip.decompress(data)
        assert text.count(b"WARC/1.1\r\n") == records + 1
        ids += [int(x.split(b":")[0]) for x in text.split(b"WARC-Record-ID: <urn:x-page:")[1:] if not x.startswith(b"none")]
    assert ids == sorted(ids)
    assert not os.listdir(os.path.join(folders[0].removeprefix("file:"), "_temporary"))


def test_only_listed_files_are_read(spark):
    folder = fresh_dir(spark, "warc-stray")
    before = warc.archive(pages(spark), folder).count()
    with open(os.path.join(folder.removeprefix("file:"), "part-999999-0000.warc.gz"), "wb") as stray:
        stray.write(b"left by a lost task")
    assert warc.read(spark, folder).count() == before


def test_damage_is_found():
    data = warc.record(1, 0, "http://h", b"payload", None, False)
    assert warc.parse(data)["html"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"pAyload\r\n"))


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(none).count() == 0
