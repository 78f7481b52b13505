import gzip
import hashlib
import os
import random

from traitlens.llm import warc as W


def pages(spark):
    return spark.createDataFrame(
        [(3, "http://a/x y", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (5, None, None), (4, "u", ""), (4, "u", ""),
         (None, "n", "<p>é</p>"), (6, "z", "WARC/1.1\r\n" * 20), (7, "q", "x" * 300_000)],
        "page_id long, url string, html string")


def test_round_trip_and_edges(spark, tmp_path):
    got = W.round_trip(pages(spark), str(tmp_path / "w")).collect()
    rows = sorted((tuple(r) for r in got), key=str)
    assert len(rows) == 8
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {
        (1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (4, "response", None), (5, "revisit", 4),
        (6, "response", None), (7, "response", None)}
    sizes = {r.page_id: (r.payload_bytes, r.payload_digest) for r in got}
    assert sizes[3] == sizes[1] == (len("<p>é</p>".encode()), W.digest_of("<p>é</p>".encode()))
    whole = W.read_warc(spark, str(tmp_path / "w"))
    assert {r.page_id: bytes(r.payload) for r in whole.where("record_type = 'response'").collect()}["7"] == b"x" * 300_000
    assert W.gaps(whole).count() == 0
    none = W.round_trip(pages(spark).where("false"), str(tmp_path / "none"))
    assert none.count() == 0
    small = W.round_trip(pages(spark), str(tmp_path / "s"), min_revisit_bytes=1).where("page_id in (4, 5)").collect()
    assert {r.record_type for r in small} == {"response"}


def test_any_gzip_reader_opens_an_archive(spark, tmp_path):
    W.write_warc(pages(spark).coalesce(1), str(tmp_path / "w"))
    parts = [f for f in os.listdir(tmp_path / "w") if f.startswith("part-")]
    data = b"".join(gzip.decompress((tmp_path / "w" / f).read_bytes()) for f in parts)
    assert data.count(b"WARC-Type: ") == 8


def archive():
    rnd = random.Random(4)
    records = [W.record(i, f"http://p/{i}", bytes(rnd.choices(b"abc<>", k=rnd.randint(0, 200))), None, False, "d")
               for i in range(12)]
    return records


def test_salvage_recovers_all_but_the_damaged_record():
    for pack in (W.member, lambda r: r):
        records = [pack(r) for r in archive()]
        starts = [sum(map(len, records[:i])) for i in range(13)]
        data = b"".join(records)
        assert [f[0] for f in W.salvage(data)] == ["record"] * 12
        for hit in range(12):
            broken = bytearray(data)
            broken[starts[hit + 1] - 7] ^= 0x55  # in the block; a plain record's header has no checksum
            found = list(W.salvage(bytes(broken)))
            gaps = [f[1:3] for f in found if f[0] == "gap"]
            ids = [f[3].fields["warc-record-id"] for f in found if f[3]]
            assert gaps == [(starts[hit], starts[hit + 1])]
            assert ids == [f"<urn:page:{i}>" for i in range(12) if i != hit]


def test_salvage_covers_every_byte():
    rnd = random.Random(5)
    data = b"".join(W.member(r) if i % 2 else r for i, r in enumerate(archive()))
    for _ in range(60):
        broken = bytearray(data)
        for _ in range(rnd.randint(1, 4)):
            a = rnd.randrange(len(broken))
            if rnd.random() < .5:
                del broken[a:a + rnd.randint(1, 90)]
            else:
                broken[a:a] = bytes(rnd.choices(range(256), k=rnd.randint(1, 40)))
        at = 0
        for kind, a, b, _ in W.salvage(bytes(broken)):
            assert a == at or kind == "record"
            at = b
        assert at == len(broken)
    assert list(W.salvage(b"")) == [] and [f[:3] for f in W.salvage(b"junk")] == [("gap", 0, 4)]


def test_digest_is_sha1_in_base32():
    assert len(W.digest_of(b"x")) == 32 and hashlib.sha1(b"x").digest()[0] >> 3 == "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567".index(
        W.digest_of(b"x")[0])


def saved(data):
    found = list(W.salvage(data))
    return [f[3].fields["warc-record-id"] for f in found if f[3]], [f[1:3] for f in found if f[0] == "gap"]


def test_records_around_a_bad_one_in_a_member_are_saved():
    records = archive()
    ids = [f"<urn:page:{i}>" for i in range(12)]
    bad = bytearray(b"".join(records[:8]))
    bad[sum(map(len, records[:4])) - 6] ^= 0x55  # in the block of record 3
    packed = W.member(bytes(bad))
    data = packed + W.member(records[8]) + b"".join(records[9:])
    assert saved(data) == (ids[:3] + ids[4:], [(0, len(packed))])


def test_a_cut_or_damaged_single_stream_keeps_its_records():
    records = [W.record(i, "u", random.Random(i).randbytes(3000), None, False, "d") for i in range(40)]
    data = W.member(b"".join(records))
    ids, gaps = saved(data[:len(data) // 2])
    assert ids == [f"<urn:page:{i}>" for i in range(len(ids))] and 17 <= len(ids) <= 20
    assert gaps == [(0, len(data) // 2)]
    assert len(saved(data[:-4] + b"xxxx")[0]) == 40  # only the member's check fails
    tail = W.member(W.record(99, "u", b"x", None, False, "d"))
    ids, gaps = saved(data[:len(data) // 2] + tail)
    assert ids[-1] == "<urn:page:99>" and len(ids) >= 18 and len(set(ids)) == len(ids)
