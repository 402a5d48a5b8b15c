import base64
import gzip
import hashlib
import os

import pytest

from blockmill.llm import warc as W
from llm_cases import comparable, prose

PAGES = "page_id long, url string, html string"


def pages():
    html = ["", "a", prose(1, 900), "line\r\n\r\nWARC/1.1\r\n\r\n", "Ünï 漢🙂"]
    rows = [(k * 5, f"http://h/{k}\r\nX: y", html[k % 5]) for k in range(200)]
    rows += [(k * 5 + 1, None, prose(k, 50)) for k in range(100)] + [(5000, "é", None), rows[2], rows[2]]
    return rows + [(None, "http://n/", "a"), (None, None, None)]


def brute(rows, least=0):
    keep = {}
    for page, _, html in rows:
        if page is not None:
            keep[html or ""] = max(keep.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        other = page is not None and len(data) >= least and keep[html or ""] != page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if other else "response", keep[html or ""] if other else None))
    return out


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip_and_same_files(spark, tmp_path, least):
    frame = spark.createDataFrame(pages(), PAGES).selectExpr("*", "1 as part", "2 as digest", "'x' as file")
    settings = W.WarcSettings(range_bytes=9000, roll_bytes=1500, least_bytes=least)
    found = []
    for parts in (2, 7):
        folder = str(tmp_path / f"{least}-{parts}")
        W.write_archives(frame.repartition(parts), folder, settings)
        rows = W.read_archives(spark, folder).collect()
        assert comparable(r[:5] for r in rows) == comparable(brute(pages(), least))
        found.append(sorted(map(tuple, W.read_manifest(spark, folder).collect())))
        files = [f for f in os.listdir(f"{folder}/data") if not f.startswith(".")]
        assert sorted(files) == [f[0] for f in found[-1]]
    assert found[0] == found[1] and len(found[0]) > 5
    assert all(f[2] <= 1500 or f[1] == 1 for f in found[0])


def test_records_are_sorted_gzip_members(spark, tmp_path):
    folder = str(tmp_path / "w")
    W.write_archives(spark.createDataFrame(pages(), PAGES), folder)
    name = W.read_manifest(spark, folder).first()["file"]
    text = gzip.decompress(open(f"{folder}/data/{name}", "rb").read())
    ids = [int(x.split(b"\r\n")[0]) for x in text.split(b"X-Page-ID: ")[1:]]
    assert ids == sorted(ids) and text.count(b"WARC-Type: ") >= len(ids)
    assert b"WARC-Refers-To: <urn:uuid:" in text


def test_readers_take_listed_files_only(spark, tmp_path):
    folder = str(tmp_path / "w")
    W.write_archives(spark.createDataFrame(pages(), PAGES), folder)
    n = W.read_archives(spark, folder).count()
    name = W.read_manifest(spark, folder).first()["file"]
    data = open(f"{folder}/data/{name}", "rb").read()
    open(f"{folder}/data/stray.warc.gz", "wb").write(data)
    open(f"{folder}/data/_half.warc.gz", "wb").write(data[:50])
    assert W.read_archives(spark, folder).count() == n
    open(f"{folder}/data/{name}", "wb").write(data[:-5])
    with pytest.raises(Exception, match="not the file"):
        W.read_archives(spark, folder).collect()


def test_damage_is_seen():
    record = W.make_record(1, "u", b"payload", None, "2000-01-01T00:00:00Z")
    assert W.read_record(record)[:4] == (1, 7, W.base32_sha1(b"payload"), "response")
    with pytest.raises(ValueError):
        W.read_record(record.replace(b"payload\r", b"pAyload\r"))
    with pytest.raises(ValueError):
        W.read_record(record[:-3])


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    W.write_archives(spark.createDataFrame([], PAGES), folder)
    assert W.read_archives(spark, folder).count() == 0


@pytest.mark.parametrize("ids", [
    [-8 * 10 ** 18, 5, 8 * 10 ** 18], [-(1 << 63), (1 << 63) - 1, 0, -1], [7] * 5,
])
def test_ids_of_the_full_range(spark, tmp_path, ids):
    rows = [(k, f"http://h/{k}", prose(abs(k) % 97, 40)) for k in ids]
    folder = str(tmp_path / "w")
    W.write_archives(spark.createDataFrame(rows, PAGES), folder, W.WarcSettings(range_bytes=300))
    assert comparable(r[:5] for r in W.read_archives(spark, folder).collect()) == comparable(brute(rows))


def test_far_ids_and_missing_ids_spread_over_ranges(spark, tmp_path):
    """One page far away, and many without an id: no range holds much more than it may."""
    near = [(k, None, prose(k, 30)) for k in range(1500)]
    for rows in (near, near + [(1 << 62, None, "far")], near[:50] + [(None, None, prose(k, 30)) for k in range(1500)]):
        frame = spark.createDataFrame(rows, PAGES)
        settings = W.WarcSettings(range_bytes=10_000)
        folder = str(tmp_path / str(len(os.listdir(tmp_path))))
        W.write_archives(frame, folder, settings)
        held = {}
        for r in W.read_archives(spark, folder).collect():
            part = r["file"].split("-")[1]
            held[part] = held.get(part, 0) + r["payload_bytes"]
        assert len(held) > 20 and max(held.values()) <= 2 * settings.range_bytes
