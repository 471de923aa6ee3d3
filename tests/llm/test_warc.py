import base64
import hashlib
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from lexquarry.llm import warc
from lexquarry.llm.registry import archived_pages


def brute(rows, least=0):
    """Records of (page_id, html) rows."""
    groups = {}
    for place, (key, _, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((key is not None, key or 0, -place, key, place))
    out = []
    for html, own in groups.items():
        raw = html.encode()
        *_, best, first = max(own)
        for *_, key, place in own:
            again = len(raw) >= least and place != first
            out.append((key, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    page = lambda: "<html><body class='x'>" + " ".join(rng.choice(["<p>", "é", "word", "\r\n\r\n", "P*M\x18\0\0\0\0", "日本", "z" * 9]) for _ in range(rng.randrange(0, 120))) + "</body></html>"
    out = [(i, f"http://a.example/{i}", page()) for i in range(300)]
    out += [(1000 + i, f"http://b.example/{i}", "hot page " * 30) for i in range(400)]
    out += [(2000 + i, None, out[i % 7][2]) for i in range(30)]
    out += [(3000, "http://x/\r\nWARC-Type: response", "odd é"), (3001, "", ""), (3002, "u", None), (None, "n", "hot page " * 30), (None, "n", "only null"), (None, "n", "only null")]
    out += [(5, "again", out[5][2]), (5, "http://a.example/5", out[5][2]), (4000, "long", "ab" * 3_000_000), (4000, "long", "ab" * 3_000_000)]
    return out


def _frame(spark, rows):
    df = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], "page_id long, url string, html string, row string, copy string, key string, payload string")
    return df.repartition(5)


@pytest.mark.parametrize("least", [0, 200])
def test_records_are_those_of_brute_force(spark, tmp_path, rows, least):
    df = _frame(spark, rows)
    warc.write_archives(df, str(tmp_path / "a"), "page_id", "url", "html", least=least)
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows, least)
    texts = {r.payload_digest: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert set(texts.values()) == {r[2] or "" for r in rows}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert len({r.record_id for r in got}) == len(rows)


def test_query_columns(spark, rows):
    got = archived_pages(_frame(spark, rows))
    assert got.dtypes[:5] == [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")]
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(rows)


def test_files_follow_the_format(spark, tmp_path, rows):
    folder = str(tmp_path / "a")
    warc.write_archives(_frame(spark, rows).coalesce(1), folder, "page_id", "url", "html", date="2020-01-01T00:00:00Z")
    files = sorted((tmp_path / "a").glob("*.warc.zst"))
    assert files
    with_dictionary = 0
    for f in files:
        raw = f.read_bytes()
        magic, size = struct.unpack_from("<II", raw)
        if magic == 0x184D2A5D:
            with_dictionary += 1
            held = zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size])
            assert held[:4] == b"\x37\xa4\x30\xec"
            own = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
        else:
            own = zstandard.ZstdDecompressor()
        offsets = [at for at, _ in warc.frames(raw)]
        for at, record in warc.frames(raw):  # each by itself, from its offset
            assert own.decompressobj().decompress(raw[at:]) == record and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert b"WARC-Type: warcinfo" in next(warc.frames(raw))[1] and offsets[0] == (8 + size if magic == 0x184D2A5D else 0)
    assert with_dictionary
    revisits = [r for r in warc.read_archives(spark, folder).collect() if r.record_type == "revisit"]
    heads = {warc.parse(rec)[2]: rec for f in files for _, rec in warc.frames(f.read_bytes()) if warc.parse(rec)}
    for r in revisits:  # each names a response with its digest
        named = warc._headers(heads[r.record_id].partition(b"\r\n\r\n")[0])["WARC-Refers-To"]
        target = warc.parse(heads[named])
        assert target[3] == "response" and target[6] == r.payload_digest and target[0] == r.refers_to


def test_a_dictionary_saves_bytes(spark, tmp_path):
    same = "<html><head><title>{0}</title><link rel=stylesheet href=/main.css></head><body><nav>home about contact imprint</nav><p>{0} text of page {0}</p></body></html>"
    records = [warc.warc_record({"key": i, "url": f"http://h/{i}", "payload": same.format(i), "size": len(same.format(i)), "sha1": hashlib.sha1(same.format(i).encode()).hexdigest(), "copy": None, "refers": False}, "d") for i in range(3000)]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(warc.archive(records, "d")) < plain / 2
    assert [r for _, r in warc.frames(warc.archive(records, "d"))][1:] == records
    assert [r for _, r in warc.frames(warc.archive(records[:2], "d"))][1:] == records[:2]  # too few for a dictionary


def test_damage_is_seen():
    record = warc.warc_record({"key": 1, "url": "u", "payload": "body", "size": 4, "sha1": hashlib.sha1(b"body").hexdigest(), "copy": None, "refers": False}, "d")
    assert warc.parse(record)[5] == 4
    with pytest.raises(ValueError, match="digest"):
        warc.parse(record.replace(b"body", b"bodz"))
    with pytest.raises(ValueError, match="length"):
        warc.parse(record + b"x")
    whole = warc.archive([record], "d")
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(whole[:-3]))


def test_small_archives_and_empty_table(spark, tmp_path, rows):
    warc.write_archives(_frame(spark, rows), str(tmp_path / "a"), "page_id", "url", "html", archive_bytes=4000)
    assert len(list((tmp_path / "a").glob("*.warc.zst"))) > 20
    assert warc.read_archives(spark, str(tmp_path / "a"), payloads=False).count() == len(rows)
    warc.write_archives(_frame(spark, []), str(tmp_path / "b"), "page_id", "url", "html")
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0
    assert archived_pages(_frame(spark, rows).where(F.lit(False))).count() == 0
