import gzip
import hashlib
import io
from pathlib import Path

import pytest

from foliomart.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, stands long"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def rows():
    big, other = "<html>" + "é" * 80, "x" * 100
    made = [(9, "http://a/\r\nX: y", big), (3, None, big), (4, "u", other), (4, "u", other), (7, "u", other), (1, "u", "x" * 99), (2, "u", "x" * 99),
            (11, "u", None), (12, "u", ""), (13, "http://ü/ ", "y" * 300_000), (None, "u", other), (None, "u", "z" * 200), (None, "v", "z" * 200)]
    return [(*r, "?", 0) for r in made]


def plain(rows):
    out = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == raw and p is not None]
        first = min(same, default=None)
        again = len(raw) >= 100 and first is not None and first != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, got):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    assert got(warc.round_trip(df), *COLUMNS) == plain(rows())


def test_archives_are_bounded_and_plain_gzip(spark, tmp_path, got):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(2)
    folder = f"file://{tmp_path}/warc"
    made = warc.write(df, folder, archive_bytes=1000).collect()
    assert len(made) > 3 and sum(r["records"] for r in made) == len(rows())
    names = sorted(p.name for p in Path(f"{tmp_path}/warc").iterdir())
    assert names == sorted(r["path"].rsplit("/", 1)[1] for r in made)  # nothing half written is left
    text = b"".join(gzip.decompress(Path(f"{tmp_path}/warc/{n}").read_bytes()) for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(rows())
    archives = spark.createDataFrame([(r["path"],) for r in made], "path string")
    assert got(warc.read(archives), *COLUMNS) == plain(rows())
    urls = {r["page_id"]: r["url"] for r in warc.read(archives).collect()}
    assert urls[9] == "http://a/%0D%0AX:%20y" and urls[3] is None


class Drip(io.BytesIO):
    """A stream that gives a few bytes at a time."""

    def read(self, n=-1):
        return super().read(min(7, n) if n > 0 else 7)


def archive(n=4):
    return b"".join(warc.compressed(warc.record("response", i, "u", b"p" * i * 50, hashlib.sha256(b"p" * i * 50).hexdigest())) for i in range(n))


def test_records_across_reads():
    assert [h["warc-record-id"] for h, _ in warc.records(Drip(archive()))] == [f"<urn:x-page:{i}>" for i in range(4)]


def test_damage_is_found():
    good = archive()
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(good[:-5])))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:40] + b"\0\0\0" + good[43:])))
    raw = warc.record("response", 1, "u", b"payload", hashlib.sha256(b"payload").hexdigest())
    for bad in (raw.replace(b"payload\r\n", b"pAyload\r\n"), raw.replace(b"\r\n\r\n", b"\r\n\r\n ", 1), raw[:-2], raw[5:]):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(warc.compressed(bad))))


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
