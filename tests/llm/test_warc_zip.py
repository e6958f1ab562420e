import base64
import gzip
import hashlib
import io
import zipfile

import pytest

from maskwright.llm import warc_zip as W

SCHEMA = "page_id bigint, url string, html string, digest string, row bigint, path string"
PAGES = [
    (3, "http://a/x y", "<p>same</p>"), (1, "http://b/%41\r\nX: y", "<p>same</p>"),
    (2, None, "<p>é🙂</p>"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 300_000),
    (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "u", "<p>same</p>"), (None, "u", "alone"),
] + [(100 + i, "hot", "hot page") for i in range(60)]


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _brute(pages, least=0):
    first, out = {}, []
    keyed = sorted(range(len(pages)), key=lambda i: (pages[i][0] is None, pages[i][0] or 0, i))
    for i in keyed:
        data = (pages[i][2] or "").encode()
        if len(data) >= least:
            first.setdefault(data, i)
    for i, (page, _, html) in enumerate(pages):
        data = (html or "").encode()
        head = first.get(data, i)
        out.append((page, len(data), _digest(data), "response" if head == i else "revisit",
                    None if head == i else pages[head][0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("least,rows", [(0, 200_000), (0, 0), (5, 200_000)])
def test_records_read_back_equal_brute_force(frame, least, rows):
    made = W.write_archives(frame(PAGES, SCHEMA), min_bytes=least, broadcast_rows=rows,
                            package_bytes=20_000)
    assert sum(r["records"] for r in made.collect()) == len(PAGES)
    got = W.read_archives(made).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r[k] for k in keys)) for r in got) == _brute(PAGES, least)
    uris = {p: u for p, u, _ in PAGES}
    for r in got:
        assert r["page_id"] is None or r["uri"] == uris[r["page_id"]]
        if r["record_type"] == "response":
            assert _digest(bytes(r["payload"])) == r["payload_digest"]


def test_no_pages(frame):
    made = W.write_archives(frame([], SCHEMA))
    assert made.collect() == [] and W.read_archives(made).collect() == []


def test_packages_are_ordinary_zip_files(frame):
    path = W.write_archives(frame(PAGES, SCHEMA)).first()["path"].removeprefix("file://")
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None
        assert {i.filename for i in package.infolist()} == {W.ARCHIVE, W.INDEX}
        data = gzip.decompress(package.read(W.ARCHIVE))
    assert data.startswith(b"WARC/1.1\r\n")


def _package(wide=False, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as package:
        for i in range(5):
            with package.open(f"m{i}", "w", force_zip64=wide) as member:
                member.write(bytes([i]) * (1000 + i))
        package.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("wide,comment", [(False, b""), (True, b"PK\x05\x06 a comment"), (True, b"")])
def test_ranges_of_stored_members(wide, comment):
    data = _package(wide, comment)
    reader = W.PackageReader(io.BytesIO(data), len(data))
    member = reader.stored_member("m3")
    assert member.size == 1003 and reader.read_range(member, 1000, 3) == b"\x03" * 3
    for bad in ((1000, 4), (-1, 1), (0, -1)):
        with pytest.raises(ValueError):
            reader.read_range(member, *bad)


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 500)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = _package(wide=True)
    assert W.END64 in data and W.LOCATOR64 in data
    reader = W.PackageReader(io.BytesIO(data), len(data))
    for i in range(5):
        member = reader.stored_member(f"m{i}")
        assert reader.read_range(member, 0, member.size) == bytes([i]) * (1000 + i)


def test_damaged_packages_say_what_is_wrong():
    data = _package()
    for bad in (b"", b"hello", data[:-30], data.replace(W.CENTRAL, b"XXXX"), data.replace(W.LOCAL, b"XXXX")):
        with pytest.raises(ValueError):
            W.PackageReader(io.BytesIO(bad), len(bad))
    packed = _package(method=zipfile.ZIP_DEFLATED)
    reader = W.PackageReader(io.BytesIO(packed), len(packed))
    for name in ("m1", "none"):
        with pytest.raises(ValueError):
            reader.stored_member(name)
    record = W.make_record(1, "u", b"payload", W.digest_of(b"payload"), None, False)
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"payload\r\n", b"pay1oad\r\n"))
