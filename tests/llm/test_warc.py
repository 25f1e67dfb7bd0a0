import gzip
import hashlib
import time

import pytest

from textsieve.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], PAGES)


def brute(rows):
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == p and j is not None]
        first = min(ids, default=None) if len(p) >= 100 else i
        out.append((str(i), "response" if first == i else "revisit", None if first == i else str(first), len(p), hashlib.sha256(p).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "http://a/x y", "<p>" + "é" * 60), (3, "http://b\r\nInjected: 1", "<p>" + "é" * 60), (9, None, "<p>" + "é" * 60), (1, "u", "short"),
        (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", "<p>" + "é" * 60), (3, "http://b", "<p>" + "é" * 60),
        (8, "u", "WARC/1.1\r\n\r\n" * 5000), (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "x" * 100), (13, "u", "x" * 100)]


def test_round_trip(spark, tmp_path):
    warc.write_warc(pages(spark, ROWS), str(tmp_path / "w"), records_per_file=3)
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.gap is None for r in got)
    assert sorted(((r.record_id or "None", r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got), key=str) == brute(ROWS)
    by = {r.record_id: r for r in got}
    assert bytes(by["8"].payload) == ROWS[9][2].encode() and bytes(by["5"].payload) == b"" and by["9"].url is None
    assert by["1"].url == "u" and "\r" not in by["5"].url
    for f in (tmp_path / "w").glob("part-*"):  # a plain sequence of gzip members
        assert gzip.decompress(f.read_bytes()).count(b"WARC-Type") <= 3
    warc.write_warc(pages(spark, []), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).collect() == []


def test_salvage():
    recs = [warc.record(i, "u", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None, "2000-01-01T00:00:00Z") for i in range(6)]
    gz = [gzip.compress(r, mtime=0) for r in recs]
    ids = lambda data: [r["record_id"] for _, _, r, _ in warc.salvage(data) if r]
    gaps = lambda data: [(a, b) for a, b, r, _ in warc.salvage(data) if r is None]
    whole = b"".join(gz)
    assert ids(whole) == list("012345") and gaps(whole) == []
    # a flipped byte in the third member loses that one alone
    at = len(gz[0]) + len(gz[1])
    bad = bytearray(whole)
    bad[at + len(gz[2]) // 2] ^= 255
    assert ids(bytes(bad)) == list("01345") and gaps(bytes(bad)) == [(at, at + len(gz[2]))]
    # cut off, junk between, junk in front, plain records among members
    assert ids(whole[:-5]) == list("01234") and gaps(whole[:-5]) == [(len(whole) - len(gz[5]), len(whole) - 5)]
    mixed = b"junk" + gz[0] + recs[1] + b"\x1f\x8b\x08 no member" + recs[2] + gz[3]
    assert ids(mixed) == list("0123") and len(gaps(mixed)) == 2 and gaps(mixed)[0] == (0, 4)
    # a plain record whose length or digest is wrong
    for wrong in (recs[1].replace(b"payload 1", b"payload 7"), recs[1].replace(b"Content-Length: ", b"Content-Length: 9")):
        assert ids(recs[0] + wrong + recs[2]) == ["0", "2"]
        assert gaps(recs[0] + wrong + recs[2]) == [(len(recs[0]), len(recs[0]) + len(wrong))]
    assert ids(b"") == [] and gaps(b"nothing") == [(0, 7)]
    # a member of three records
    assert ids(gzip.compress(recs[0] + recs[1] + recs[2])) == list("012")


def test_damaged_file_read_by_spark(spark, tmp_path):
    recs = [warc.record(i, "u", b"x" * 50, hashlib.sha256(b"x" * 50).hexdigest(), None, "d") for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(recs[0]) + b"damage" + gzip.compress(recs[2]))
    rows = warc.read_warc(spark, str(tmp_path), payloads=False).collect()
    assert [r.record_id for r in rows if r.gap is None] == ["0", "2"]
    gap = next(r for r in rows if r.gap is not None)
    assert gap.end - gap.start == 6 and gap.path.endswith("a.warc.gz")


def test_many_members_take_linear_time():
    one = gzip.compress(warc.record(1, "u", b"y" * 4096, hashlib.sha256(b"y" * 4096).hexdigest(), None, "d"), 0)

    def seconds(n):
        data, t = one * n, time.perf_counter()
        assert sum(1 for _, _, r, _ in warc.salvage(data) if r) == n
        return time.perf_counter() - t

    seconds(50)
    assert seconds(4000) < 8 * seconds(1000) + 0.5


def test_members_are_bounded():
    bomb = gzip.compress(b"0" * (1 << 22))
    assert warc.unpack(bomb, 0, 1 << 22) == (b"0" * (1 << 22), len(bomb))
    with pytest.raises(ValueError, match="too large"):
        warc.unpack(bomb, 0, (1 << 22) - 1)
    # a member longer than the pieces it is read in
    import random

    noise = random.Random(1).randbytes(5 * warc.PIECE + 7)
    member = gzip.compress(noise)
    assert warc.unpack(b"xx" + member + b"after", 2) == (noise, 2 + len(member))


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE", 200)
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    rows = [(i, "u", hashlib.sha256(b"%d" % i).hexdigest() * (20 if i % 3 == 0 else 1)) for i in range(30)]
    warc.write_warc(pages(spark, rows).coalesce(1), str(tmp_path / "w"))
    counts = sorted(gzip.decompress(f.read_bytes()).count(b"WARC-Type: ") for f in (tmp_path / "w").glob("part-*"))
    assert sum(counts) == 30 and counts[:10] == [1] * 10
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted((r.record_id or "None", r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got) == brute(rows)


def test_a_lost_record_is_an_error(spark, tmp_path, monkeypatch):
    pages(spark, ROWS[3:]).withColumnRenamed("digest", "mine").write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op5_warc(spark, str(tmp_path)).count() == len(ROWS) - 3
    real = warc.write_warc

    def damaged(df, path, **options):
        real(df, path, **options)
        import glob
        import os

        path = path.removeprefix("file:")
        name = max(glob.glob(f"{path}/part-*"), key=os.path.getsize)
        data = bytearray(open(name, "rb").read())
        data[len(data) // 2] ^= 255
        os.remove(os.path.join(path, "." + os.path.basename(name) + ".crc"))
        open(name, "wb").write(data)

    monkeypatch.setattr(warc, "write_warc", damaged)
    with pytest.raises(Exception, match="unreadable record in"):
        warc.op5_warc(spark, str(tmp_path)).collect()
