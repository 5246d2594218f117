import hashlib

import pytest

from millrace.llm.warc_bundles import fetch, plan_records, read_bundles, read_seek_table, round_trip, seek_table, write_bundles


def pages_of(spark):
    big, other = "<p>é</p>" * 300, "x" * 1000
    html = [big, "short", big, other, None, "", "short", big, other, "y" * 200_000, "z\r\n\r\nWARC/1.1\r\n" * 100]
    return html, spark.createDataFrame([(i, f"http://h/{i}" if i else None, h, "clash") for i, h in enumerate(html)], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    html, pages = pages_of(spark)
    got = {r["page_id"]: r for r in round_trip(pages.repartition(3)).collect()}
    assert sorted(got) == list(range(len(html)))
    for i, h in enumerate(html):
        raw = (h or "").encode()
        same = [j for j, x in enumerate(html) if (x or "").encode() == raw]
        first = max(same) if len(raw) >= 1000 else i
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
        assert r["payload"] == (raw if first == i else None)
    assert round_trip(pages.limit(0)).count() == 0


def test_random_access_and_small_frames(spark, tmp_path):
    html, pages = pages_of(spark)
    index = write_bundles(plan_records(pages.coalesce(1)), str(tmp_path), frame_bytes=500, bundle_bytes=600)
    assert index.select("bundle").distinct().count() > 1
    for i, h in enumerate(html):
        head, payload = fetch(index, str(tmp_path), i)
        assert payload == (h or "").encode() and head["WARC-Record-ID"] == f"<urn:page:{i}>"
    assert read_bundles(index, str(tmp_path)).count() == len(html)
    (tmp_path / "part-left-over.warc.zst").write_bytes(b"half a bundle")
    assert read_bundles(index, str(tmp_path)).count() == len(html)
    with pytest.raises(KeyError):
        fetch(index, str(tmp_path), 99)


def test_seek_table():
    frames = [(10, 100), (7, 3)]
    assert read_seek_table(b"frames" + seek_table(frames)) == frames
    with pytest.raises(ValueError):
        read_seek_table(b"123456789")
