import gzip
import hashlib
import random

import pytest

from airshed.llm import warc


def record(i, payload, kind="response"):
    return warc.record_bytes(kind, f"urn:key:{i}", f"http://x/{i}", "2024-01-01T00:00:00Z", payload,
                             hashlib.sha256(payload).hexdigest())


RECORDS = [record(i, bytes(random.Random(i).randbytes(50 + 40 * i)) + b"\r\nWARC/1.1\r\nWARC-Type: fake") for i in range(12)]


def build(packed):
    parts = [warc.member(r) for r in RECORDS] if packed else RECORDS
    return parts, b"".join(parts)


def ids(found):
    return [x[3]["warc-record-id"] for x in found if x[0] == "record"]


def covers(found, size):
    """Records and gaps follow each other without a hole and without overlap."""
    at = 0
    for x in found:
        assert x[1] == at
        at = x[2]
    assert at == size


@pytest.mark.parametrize("packed", [True, False])
def test_clean_file(packed):
    parts, data = build(packed)
    found = list(warc.scan(data))
    assert ids(found) == [f"<urn:key:{i}>" for i in range(12)] and not [x for x in found if x[0] == "gap"]
    assert found[3][4].endswith(b"fake")
    covers(found, len(data))


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "zero", "tail"])
def test_damage_costs_only_what_it_touches(packed, damage):
    parts, _ = build(packed)
    start = sum(map(len, parts[:5]))
    hit = bytearray(parts[5])
    if damage == "flip":
        hit[len(hit) // 2] ^= 0xFF
    elif damage == "cut":
        del hit[len(hit) // 2:]
    elif damage == "insert":
        hit = bytearray(b"junk \x1f\x8b\x08 WARC/1.1\r\nnonsense\r\n") + hit
    elif damage == "zero":
        hit[:20] = bytes(20)
    data = b"".join(parts[:5]) + bytes(hit) + b"".join(parts[6:]) if damage != "tail" else b"".join(parts)[:-7]
    found = list(warc.scan(data))
    lost = {"insert": [], "tail": [11]}.get(damage, [5])
    assert ids(found) == [f"<urn:key:{i}>" for i in range(12) if i not in lost]
    gaps = [x for x in found if x[0] == "gap"]
    assert len(gaps) == 1 and gaps[0][3]
    assert damage == "tail" or start <= gaps[0][1] < gaps[0][2] <= start + len(hit)
    covers(found, len(data))


TEXTS = [record(i, (f"page {i} says {random.Random(i).random()} " * 300).encode()) for i in range(40)]
NAMES = [f"<urn:key:{i}>" for i in range(40)]


@pytest.mark.parametrize("records", [RECORDS, TEXTS])
@pytest.mark.parametrize("damage", ["block", "length", "version"])
def test_a_bad_record_costs_no_other_record_of_its_member(records, damage):
    n = len(records)
    hit = {"block": records[5][:-20] + b"#" + records[5][-19:], "length": records[5].replace(b"Content-Length: ", b"Content-Length: 9"),
           "version": b"XXXX" + records[5][4:]}[damage]
    data = warc.member(b"".join(records[:5] + [hit] + records[6:])) + warc.member(record(99, b"next"))
    found = list(warc.scan(data))
    assert ids(found) == NAMES[:5] + NAMES[6:n] + ["<urn:key:99>"]
    gaps = [x for x in found if x[0] == "gap"]
    assert len(gaps) == 1 and found.index(gaps[0]) == 5
    at = sum(map(len, records[:5]))
    assert f"(inflated bytes {at} to {at + len(hit)})" in gaps[0][3]


@pytest.mark.parametrize("records", [RECORDS, TEXTS])
@pytest.mark.parametrize("behind", [[], [record(99, b"next")]])
def test_a_damaged_member_gives_the_records_that_inflated(records, behind):
    n, whole = len(records), warc.member(b"".join(records))
    after = b"".join(warc.member(r) for r in behind)
    tail = ["<urn:key:99>"] * len(behind)
    bad_crc = bytearray(whole)
    bad_crc[-6] ^= 0xFF
    found = list(warc.scan(bytes(bad_crc) + after))
    assert ids(found) == NAMES[:n] + tail and "gap" in [x[0] for x in found]
    cut = whole[:len(whole) * 2 // 3]
    found = list(warc.scan(cut + after))
    inside = ids(found)[:len(ids(found)) - len(behind)]
    assert ids(found) == NAMES[:len(inside)] + tail and n // 3 < len(inside) < n and "gap" in [x[0] for x in found]
    for at in range(len(whole) // 2, len(whole) // 2 + 40):
        flip = bytearray(whole)
        flip[at] ^= 0xFF
        found = list(warc.scan(bytes(flip) + after))
        assert len(set(ids(found))) == len(ids(found)) and set(ids(found)) <= set(NAMES + tail)
        assert ids(found)[:n // 4] == NAMES[:n // 4] and ids(found)[len(ids(found)) - len(behind):] == tail
        assert "gap" in [x[0] for x in found]


def test_records_in_a_damaged_member_need_a_digest_that_holds():
    bare = [r.replace(b"WARC-Block-Digest", b"X-Block-Digest") for r in TEXTS]
    good = warc.member(b"".join(bare))
    bad = bytearray(good)
    bad[-6] ^= 0xFF
    assert len(ids(warc.scan(good))) == 40 and ids(warc.scan(bytes(bad))) == []


def test_random_bytes_never_break_the_reader():
    rng = random.Random(5)
    _, data = build(True)
    for _ in range(60):
        bad = bytearray(data)
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(bad))
            bad[at:at + rng.randrange(0, 30)] = rng.randbytes(rng.randrange(0, 30))
        found = list(warc.scan(bytes(bad)))
        covers(found, len(bad))
        assert set(ids(found)) <= {f"<urn:key:{i}>" for i in range(12)} and len(ids(found)) >= 6
    assert list(warc.scan(b"")) == [] and [x[0] for x in warc.scan(b"noise")] == ["gap"]


PAGES = [(1, "http://a", "x" * 200), (2, "http://b", "x" * 200), (3, None, None), (4, "u\r\nWARC-Type: fake", ""), (5, "", "y" * 99), (6, "", "y" * 99),
         (2, "http://b", "x" * 200), (1, "http://again", "x" * 200), (None, "http://n", "x" * 200), (None, "http://n", "z" * 500),
         (7, "http://long", "é中" * 500000), (8, "http://long2", "é中" * 500000), (9, "w", "WARC/1.1\r\n\r\n" * 20)]


def expected(rows):
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        later = len(body) >= 100 and same and k != min(same)
        out.append((k, len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", min(same) if later else None))
    return sorted(out, key=str)


def test_round_trip_with_odd_rows(spark, tmp_path):
    from airshed.llm.queries import op2
    (tmp_path / "in").mkdir()
    df = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, record_type string")
    df.write.parquet(str(tmp_path / "in" / "pages.parquet"))
    rows = [tuple(r) for r in op2(spark, str(tmp_path / "in")).collect()]
    assert sorted(rows, key=str) == expected(PAGES)
    df.limit(0).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op2(spark, str(tmp_path / "none")).count() == 0


def test_a_header_may_have_any_length(spark, tmp_path):
    from airshed.llm.queries import op2
    rows = [(1, "data:text/html," + "x" * 100_000, "x" * 200), (2, "http://b WARC/1.1 b", "x" * 200), (3, "data:," + "é" * 300_000, "z" * 300)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted([tuple(r) for r in op2(spark, str(tmp_path)).collect()], key=str) == expected(rows)
    endless = b"WARC/1.1\r\nX: " + b"y" * 100_000 + b"\r\n"
    found = list(warc.scan(endless + RECORDS[0]))
    assert [x[0] for x in found] == ["gap", "record"] and found[0][2] == len(endless)


def test_a_gap_in_fresh_archives_is_an_error(spark, tmp_path, monkeypatch):
    from airshed.llm.queries import op2
    write = warc.write_archives

    def damaged(pages, path, **more):
        write(pages, path, **more)
        spark.createDataFrame([("noise",)], "value string").coalesce(1).write.mode("append").text(path)

    spark.createDataFrame([PAGES[0]], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert op2(spark, str(tmp_path)).count() == 1
    monkeypatch.setattr(warc, "write_archives", damaged)
    with pytest.raises(Exception, match="gap in a fresh archive"):
        op2(spark, str(tmp_path)).collect()


def test_archives_are_plain_gzip_and_damage_is_logged(spark, tmp_path):
    path = str(tmp_path / "arch")
    df = spark.createDataFrame([(i, f"http://{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), path, records_per_file=15)
    files = sorted((tmp_path / "arch").glob("part-*"))
    assert len(files) >= 3
    assert all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n") for f in files)
    found = warc.salvage(spark, path, payload=True)
    assert {bytes(r["payload"]).decode() for r in found.collect()} == {f"page {i} " * 50 for i in range(40)}
    hit = bytearray(files[0].read_bytes())
    hit[len(hit) // 2] ^= 0x55
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc.gz").write_bytes(bytes(hit))
    rows = warc.salvage(spark, str(tmp_path / "bad")).collect()
    assert [r["kind"] for r in rows].count("gap") == 1
    gap = next(r for r in rows if r["kind"] == "gap")
    assert gap["end"] > gap["start"] and gap["reason"]
    whole = sum(1 for r in warc.salvage(spark, str(files[0])).collect())
    assert sum(r["kind"] == "record" for r in rows) == whole - 1


def with_header(change, i=5):
    """The clean records with the header of one changed by ``change`` (lines -> lines), plain, and the others' ids."""
    head, _, rest = RECORDS[i].partition(warc.END)
    data = b"".join([*RECORDS[:i], b"\r\n".join(change(head.split(b"\r\n"))) + warc.END + rest, *RECORDS[i + 1:]])
    return data, [f"<urn:key:{k}>" for k in range(12) if k != i]


def replaced(name, value):
    return lambda lines: [name + b": " + value if x.lower().startswith(name.lower() + b":") else x for x in lines]


@pytest.mark.parametrize("size", ["²", "٣", "1" * 5000, "-1", "+5", "1e3", "0x10", "", " ", "9" * 18, "9" * 19, "1_0", "۴۲", "5.0"])
def test_odd_content_lengths_are_gaps(size):
    data, others = with_header(replaced(b"Content-Length", size.encode()))
    for buf in (data, warc.member(data)):
        found = list(warc.scan(buf))
        assert ids(found) == others and len([x for x in found if x[0] == "gap"]) >= 1


def test_random_header_values_never_end_the_reader():
    rng = random.Random(8)
    names = [b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length", b"WARC-Block-Digest", b"WARC-Payload-Digest", b"Content-Type"]
    for _ in range(300):
        value = rng.choice([rng.randbytes(rng.randint(0, 40)), str(rng.randint(-5, 10 ** 30)).encode(), "".join(chr(rng.randint(32, 0x2fff)) for _ in range(9)).encode(),
                            b"sha1:", b"sha256:zz", b":", b"md5:" + b"A" * 26, b"sha512:" + b"0" * 128])
        data, others = with_header(replaced(rng.choice(names), value))
        found = list(warc.scan(data))
        assert set(others) <= set(ids(found))
        covers(found, len(data))


@pytest.mark.parametrize("name", ["sha1", "sha256", "md5", "sha512", "SHA-256"])
def test_block_digests_in_any_writing_are_checked(name):
    import base64
    block = RECORDS[5].partition(warc.END)[2][:-len(warc.END)]
    raw = hashlib.new(name.lower().replace("-", ""), block).digest()
    b32 = base64.b32encode(raw).decode()
    for value in (raw.hex(), raw.hex().upper(), b32, b32.lower(), b32.rstrip("=")):
        data, _ = with_header(replaced(b"WARC-Block-Digest", f"{name}:{value}".encode()))
        assert len(ids(warc.scan(data))) == 12
        wrong = ("0" if value[0] != "0" else "1") + value[1:] if len(value) == 2 * len(raw) else ("a" if value[0].lower() != "a" else "b") + value[1:]
        data, others = with_header(replaced(b"WARC-Block-Digest", f"{name}:{wrong}".encode()))
        assert ids(warc.scan(data)) == others
    data, _ = with_header(replaced(b"WARC-Block-Digest", b"blake9:" + b"0" * 8))  # not known: not checked
    assert len(ids(warc.scan(data))) == 12


def test_folded_header_lines():
    data, _ = with_header(lambda lines: [lines[0], lines[1], *[y for x in lines[2:] for y in (x.partition(b": ")[0] + b":", b"\t " + x.partition(b": ")[2])]])
    found = list(warc.scan(data))
    assert len(ids(found)) == 12 and not [x for x in found if x[0] == "gap"]


def test_files_are_rolled_by_bytes_and_null_keys_share_no_task(spark):
    import glob
    import os

    from airshed.session import shared_path
    rng = random.Random(3)
    rows = [(i if i % 4 else None, f"http://{i}", rng.randbytes(3000).hex()) for i in range(120)] + [(500, "u", rng.randbytes(40000).hex()), (501, "u", "same " * 50), (502, "u", "same " * 50)]
    path = shared_path(spark, "test-rolled")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, file_bytes=20000)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(path.removeprefix("file:") + "/part-*"))
    assert len(sizes) > 15 and all(x <= 20000 for x in sizes[:-1]) and sizes[-1] > 40000
    got = warc.resolve_revisits(warc.salvage(spark, path)).collect()
    assert sorted((r.record_id, r.payload_digest) for r in got) == sorted(
        (f"urn:key:{'' if k is None else k}", hashlib.sha256(p.encode()).hexdigest()) for k, _, p in rows)
    assert [r.refers_to for r in got if r.record_type == "revisit"] == ["urn:key:501"]
