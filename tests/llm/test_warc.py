import gzip
import hashlib
import random

import pytest

from recordweave.llm import warc
from recordweave.llm.files import write_file
from recordweave.storage import new_folder


def one(i, body=b"<p>page</p>" * 20):
    return warc.record("response", f"urn:x:{i}", f"http://a/{i}", body, hashlib.sha256(body).hexdigest(), None)


def found(data):
    records, gaps = [], []
    for f in warc.salvage(data):
        (gaps if f.reason else records).append(f)
    return [int(r.headers["warc-record-id"].strip("<>").rsplit(":", 1)[1]) for r in records], [(g.start, g.end) for g in gaps]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_file(packed):
    data = b"".join(warc._member(one(i)) if packed else one(i) for i in range(20))
    assert found(data) == (list(range(20)), [])


@pytest.mark.parametrize("packed", [True, False])
def test_later_records_survive_damage(packed):
    random.seed(1)
    parts = [warc._member(one(i)) if packed else one(i) for i in range(12)]
    ends = [sum(map(len, parts[: i + 1])) for i in range(12)]
    for _ in range(60):
        data, hurt = bytearray(b"".join(parts)), random.randrange(12)
        start = ends[hurt] - len(parts[hurt])
        # of a plain record the block has a digest, the values of its header lines have none
        place = random.randrange(start + (12 if packed else parts[hurt].index(b"\r\n\r\n") + 4), ends[hurt] - 8)
        data[place] ^= 0x55
        records, gaps = found(bytes(data))
        assert [i for i in records if i != hurt] == [i for i in range(12) if i != hurt]
        if hurt not in records:
            assert gaps == [(start, ends[hurt])]


@pytest.mark.parametrize("packed", [True, False])
def test_cut_and_garbage(packed):
    parts = [warc._member(one(i)) if packed else one(i) for i in range(3)]
    data = b"garbage" + parts[0] + b"\x1f\x8b\x08 no member WARC/1.0\r\nno record" + parts[1] + parts[2][:-20]
    records, gaps = found(data)
    assert records[:2] == [0, 1] and set(records) <= {0, 1, 2}
    assert gaps[0] == (0, 7) and gaps[-1] == (len(data) - len(parts[2]) + 20, len(data))


def test_a_file_packed_as_one_stream_gives_what_comes_before_the_break():
    data = gzip.compress(b"".join(one(i, bytes(random.Random(i).randbytes(3000))) for i in range(50)))
    assert found(data) == (list(range(50)), [])
    records, gaps = found(data[: len(data) // 2])
    assert records == list(range(len(records))) and len(records) > 15 and gaps == [(0, len(data) // 2)]


def test_a_fault_late_in_a_short_member_keeps_the_records_before_it():
    records = [one(i, bytes(random.Random(i).randbytes(700))) for i in range(50)]
    whole = gzip.compress(b"".join(records))
    assert len(whole) < warc._READ
    for place in [*range(len(whole) // 4, len(whole) - 8, 997), len(whole) - 6]:
        data = bytearray(whole)
        data[place] ^= 0x55
        sure = place * 50 // len(whole) - 2
        assert found(bytes(data))[0][:sure] == list(range(sure)), place
    assert found(whole[:-6] + bytes([whole[-6] ^ 1]) + whole[-5:])[0] == list(range(50))


def test_two_damaged_members_in_a_row():
    members = [gzip.compress(b"".join(one(10 * k + i, bytes(random.Random(i).randbytes(700))) for i in range(10))) for k in range(3)]
    hurt = [m[:-6] + bytes([m[-6] ^ 1]) + m[-5:] for m in members]
    got, gaps = found(b"".join(hurt))
    assert got == list(range(30))
    ends = [0, *[sum(map(len, hurt[: i + 1])) for i in range(3)]]
    assert gaps == list(zip(ends, ends[1:], strict=False))


def test_records_of_a_damaged_stored_member_are_given_once():
    whole = gzip.compress(b"".join(one(i) for i in range(5)), compresslevel=0)
    assert found(whole[:-6] + bytes([whole[-6] ^ 1]) + whole[-5:]) == (list(range(5)), [(0, len(whole))])


def test_bad_lengths_and_headers():
    good = one(7)
    for bad in (good.replace(b"Content-Length: 2", b"Content-Length: 9"), good.replace(b"Content-Length", b"Content Length"),
                good.replace(b"WARC-Type:", b"WARC-Type"), good.replace(b"WARC-Date:", b"WARC-Dart:"), b"WARC/1.1\r\n\r\n", b"WARC/1.1\r\nContent-Length: x\r\n\r\n"):
        assert found(bad + good)[0] == [7]
    assert found(b"") == ([], [])


def test_round_trip(spark):
    big = "x" * 100
    rows = [(5, "http://é/ \r\n", big), (3, None, big), (9, "u", big), (3, "u", big), (None, "u", big), (1, "u", "x" * 99), (2, "u", "x" * 99),
            (4, "u", None), (6, "u", ""), (7, "u", "é" * 60), (8, "u", "WARC/1.1\r\n\r\n" * 30), (10, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as payload", "3 as `first`")
    folder = new_folder(spark, "warc-test")
    files = warc.write_warc(pages, folder)
    assert files.agg({"records": "sum"}).first()[0] == 12
    back = warc.read_warc(spark, folder, files=files).collect()
    assert all(r.reason is None for r in back)
    number = lambda name: None if name is None or "None" in name else int(name.strip("<>").rsplit(":", 1)[1])
    got = sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.warc_type, number(r.refers_to)) for r in back), key=str)
    wanted = []
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = html == big and page != 3
        wanted.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(wanted, key=str)
    texts = {number(r.record_id): bytes(r.payload) for r in back if r.warc_type == "response"}
    assert texts[7] == ("é" * 60).encode() and texts[10] == b"y" * 3_000_000


def test_empty_table(spark):
    folder = new_folder(spark, "warc-test")
    assert warc.write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"), folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_files_are_closed_by_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    folder = new_folder(spark, "warc-test")
    pages = spark.range(50).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 50) as html")
    warc.write_warc(pages, folder)
    assert warc.read_warc(spark, folder).count() == 50


def test_files_of_other_attempts_are_not_read(spark):
    folder = new_folder(spark, "warc-test")
    pages = spark.range(20).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 50) as html")
    files = warc.write_warc(pages, folder)
    # A task that is run again leaves files of its own; of one that is killed, a part.
    warc.write_warc(pages.where("page_id < 7"), folder)
    write_file(folder, "part-00000-0000", ".warc.gz", [b"\x1f\x8b cut"])
    back = warc.read_warc(spark, folder, files=files)
    assert back.where("reason IS NULL").count() == back.count() == 20
    assert warc.read_warc(spark, folder).where("reason IS NULL").count() == 27
