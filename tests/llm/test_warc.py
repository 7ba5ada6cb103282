"""What comes back equals what was written, whatever is damaged in between."""

import glob
import gzip
import hashlib
import random

import pytest

from tidegrid.llm import warc


def test_equals_sql(against_sql):
    assert against_sql("op2_warc_salvage") is None


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_revisits_and_odd_rows(spark, tmp_path):
    big, small = "<p>ä</p>" * 200, "tiny"
    rows = [(5, "http://a b/\r\nX: y", big, "d"), (3, None, big, None), (9, "", big, ""), (None, "http://n/", big, "x"), (3, "u", big, "x"),
            (1, "u", small, "x"), (2, "u", small, "x"), (4, "u", None, "x"), (6, "u", "WARC/1.1\r\nfoo" * 30, "x"), (7, "u", "x\r\n\r\n" * 900_000, "x")]
    for compressed in (True, False):
        path = str(tmp_path / f"out-{compressed}")
        warc.write_pages(_pages(spark, rows), path, compressed)
        back = warc.read_archives(spark, path).cache()
        assert warc.gaps(back).count() == 0
        got = sorted(
            (str(r["record_id"]), r["warc_type"], r["refers_to"], r["payload_length"], None if r["payload"] is None else bytes(r["payload"]).decode())
            for r in warc.records(back).collect()
        )
        want = []
        for i, _, html, _ in rows:
            html = html or ""
            again = html == big and i != 3
            want.append((f"<urn:page:{'' if i is None else i}>", "revisit" if again else "response", "<urn:page:3>" if again else None,
                         len(html.encode()), None if again else html))
        assert got == sorted(want, key=lambda x: (x[0], x[1], x[2] or ""))
    warc.write_pages(_pages(spark, []), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).collect() == []


def test_a_run_of_large_pages_fills_several_archives(spark, tmp_path):
    # thousands of small pages make the mean small; the large ones stand together
    large = "0123456789abcdef" * 160_000
    pages = spark.range(3_020).coalesce(1).selectExpr(
        "id AS page_id", "'u' AS url", f"CASE WHEN id BETWEEN 1000 AND 1019 THEN concat(id, repeat('{large[:16]}', 160000)) ELSE 'tiny' END AS html")
    for compressed in (True, False):
        path = str(tmp_path / f"out-{compressed}")
        warc.write_pages(pages, path, compressed)
        back = warc.read_archives(spark, path).select("file", "gap_reason", "record_id", "payload_length").collect()
        assert len(back) == 3_020 == len({r["record_id"] for r in back}) and not any(r["gap_reason"] for r in back)
        held = {}
        for r in back:
            held[r["file"]] = held.get(r["file"], 0) + r["payload_length"]
        assert len(held) >= 3 and max(held.values()) < warc.FILE_BYTES + len(large) + 4


def test_archives_are_plain_gzip(spark, tmp_path):
    warc.write_pages(_pages(spark, [(i, "http://x/", f"page {i}" * 50, "") for i in range(40)]), str(tmp_path / "z"))
    data = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "z" / "part-*")))
    assert data.count(b"WARC/1.1\r\n") == 40


def members(n, compressed, size=300):
    rng = random.Random(n)
    out = []
    for i in range(n):
        payload = bytes(rng.randrange(32, 127) for _ in range(size))
        plain = warc.record("response", i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None) + warc.END
        out.append(gzip.compress(plain, mtime=0) if compressed else plain)
    return out


def ids(found):
    return [f.headers["warc-record-id"] for f in found if f.reason is None]


def covered(data):
    """Offsets and lengths follow each other without holes."""
    at = 0
    for f in warc.salvage(data):
        assert f.offset == at, (f.offset, at)
        at += f.length
    return at == len(data)


@pytest.mark.parametrize("compressed", [True, False])
def test_any_damaged_byte_costs_one_record_and_leaves_a_gap(compressed):
    parts = members(6, compressed)
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    data = b"".join(parts)
    rng = random.Random(1)
    for _ in range(150):
        at = rng.randrange(starts[2], starts[3])
        broken = bytearray(data)
        broken[at] ^= 1 << rng.randrange(8)
        found = list(warc.salvage(bytes(broken)))
        got = [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
        whole = [f for f in found if f.reason is None and f.offset != starts[2]]
        assert [f.headers["warc-record-id"] for f in whole] == got
        # a header field outside the digests may change unnoticed; else the bytes are in a gap
        gap = [f for f in found if f.reason is not None]
        if not any(f.reason is None and f.offset == starts[2] and f.length for f in found):
            assert [(g.offset, g.length) for g in gap] == [(starts[2], starts[3] - starts[2])]


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_lost_and_foreign_bytes(compressed):
    parts = members(5, compressed)
    whole = b"".join(parts)
    for data, want in [
        # the last member lacks its sum only, and its record proves itself by its digest
        (whole[: len(whole) - 7], [0, 1, 2, 3, 4] if compressed else [0, 1, 2, 3]),
        (whole[9:], [1, 2, 3, 4]),
        (parts[0] + parts[1][:40] + parts[2], [0, 2]),
        (parts[0] + b"\x00" * 500 + parts[1] + b"junk", [0, 1]),
        (parts[0] + b"\x1f\x8b\x08\x00 no member WARC/1.1 no line\nWARC/1.1\r\nno: header\r\n\r\n" + (b"" if compressed else b"\n") + parts[1], [0, 1]),
        (b"nothing here", []),
        (b"", []),
    ]:
        found = list(warc.salvage(data))
        assert ids(found) == [f"<urn:page:{i}>" for i in want]
        assert covered(data)


def test_a_member_of_several_records_and_mixed_archives():
    plain = members(3, False)
    one = gzip.compress(b"".join(plain))
    assert ids(warc.salvage(one + warc.EMPTY_MEMBER + plain[0] + members(2, True)[1])) == [f"<urn:page:{i}>" for i in (0, 1, 2, 0, 1)]
    # of a damaged member the records before the damage still prove themselves
    long = members(30, False)
    cut = gzip.compress(b"".join(long))[:-4000]
    found = list(warc.salvage(cut))
    assert 3 < len(ids(found)) < 30 and found[-1].reason and found[-1].length == len(cut)


def test_gaps_are_logged_by_file(spark, tmp_path):
    parts = members(4, True)
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"?" * 11 + parts[1])
    (tmp_path / "b.warc").write_bytes(b"".join(members(2, False)))
    back = warc.read_archives(spark, str(tmp_path))
    assert warc.records(back).count() == 4
    assert [(r["file"][-9:], r["offset"], r["length"]) for r in warc.gaps(back).collect()] == [("a.warc.gz", len(parts[0]), 11)]


def test_records_before_damage_in_a_member_are_kept():
    for n in (20, 400):  # a member within one piece, and one of several
        plain = members(n, False)
        member = bytearray(gzip.compress(b"".join(plain), mtime=0))
        member[-6] ^= 255
        assert ids(warc.salvage(bytes(member))) == [f"<urn:page:{i}>" for i in range(n)]
        member[len(member) * 9 // 10 :] = b"\xff" * (len(member) - len(member) * 9 // 10)
        kept = ids(warc.salvage(bytes(member)))
        assert len(kept) > 0.8 * n and kept == [f"<urn:page:{i}>" for i in range(len(kept))]


def test_members_with_long_names_are_found_after_damage():
    one, two = members(2, True)
    named = two[:3] + bytes([two[3] | 8]) + two[4:10] + b"n" * 2000 + b"\0" + two[10:]
    assert ids(warc.salvage(one[: len(one) // 2] + named)) == ["<urn:page:1>"]
