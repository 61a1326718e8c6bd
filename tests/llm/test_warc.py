import gzip
import hashlib
import io

import pytest
from hypothesis import given
from hypothesis import strategies as st

from hearthlake.llm import warc
from hearthlake.session import work_dir


def by_hand(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = max(same) if len(payload) >= 1000 and same and sum((h or "").encode() == payload for _, _, h in rows) > 1 else page_id
        revisit = first != page_id
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_against_brute_force(spark, staging):
    long, wide = "x" * 1000, "é" * 500
    rows = [(i, f"http://h/{i}", html) for i, html in enumerate([long, long, "short", "short", wide, wide, None, "", long + "y", "x" * 999])]
    rows += [(3, "http://h/3", "short"), (1, "a b\r\nX: y", long), (None, None, long), (None, "u", "z" * 2000), (None, "u", "z" * 2000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = sorted((tuple(r) for r in warc.archive_round_trip(staging, df).collect()), key=repr)
    assert got == by_hand(rows)
    assert warc.archive_round_trip(staging, df.limit(0)).count() == 0


def test_archives_are_readable_gzip_and_payloads_return(spark, staging):
    rows = [(i, f"http://h/{i}", f"<p>{'é' * i}</p>" * 50) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    written = staging.keep(warc.write_archives(warc.with_record_type(df), work_dir(spark, "warc")), "w")
    for row in written.collect():
        with open(row.path, "rb") as file:
            assert gzip.decompress(file.read()).count(b"WARC/1.1\r\n") == row.records
    back = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read_archives(written, with_payload=True).collect()}
    assert back == {i: (u, h) for i, u, h in rows}


def test_other_columns_may_have_any_name(spark, staging):
    rows = [(1, "u", "x" * 1200), (2, "u", "x" * 1200), (3, None, None)]
    plain = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    more = plain.selectExpr("*", "'t' record_type", "7 refers_to", "'d' payload_digest", "'p' payload", "1 digest", "'n' path", "2 records")
    got = [sorted((tuple(r) for r in warc.archive_round_trip(staging, df).collect()), key=repr) for df in (plain, more)]
    assert got[0] == got[1] == by_hand(rows)


@given(st.lists(st.binary(max_size=300), max_size=6), st.integers(1, 50))
def test_members_in_pieces(contents, size):
    data = b"".join(gzip.compress(c) for c in contents)
    assert list(warc.members(data[i : i + size] for i in range(0, len(data), size))) == contents


def test_broken_records_are_noticed():
    whole = warc.page_record(1, "u", b"payload", None, "p")
    content = next(warc.members([whole]))
    assert warc.read_page(content)["payload"] == b"payload"
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members([whole[:-3]]))
    with pytest.raises(ValueError, match="digest"):
        warc.read_page(content.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    with pytest.raises(ValueError, match="as long"):
        warc.parse_record(content + b"more")
    with pytest.raises(ValueError, match="header"):
        warc.parse_record(b"nothing")
    assert io.BytesIO(whole).read(2) == b"\x1f\x8b"
