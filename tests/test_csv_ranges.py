"""Reading quoted CSV by byte ranges against one pass over the file and against Spark's own reader."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from moodtide.sources import csv as csv_io
from moodtide.sources import csv_ranges as cr

_PLAIN = st.text(alphabet='ab ";', max_size=4).filter(lambda s: not s.startswith('"'))
_QUOTED = st.text(alphabet='ab",\n\r ', max_size=6).map(lambda s: '"' + s.replace('"', '""') + '"')
_ROWS = st.lists(st.lists(_PLAIN | _QUOTED, min_size=2, max_size=3), max_size=6)


def _by_ranges(data: bytes, size: int) -> list[bytes]:
    found, state = [], cr.RECORD
    for start in range(0, len(data), size):
        piece = data[start : start + size]
        found += cr.range_records(piece, state, lambda offset, n, s=start: data[s + offset : s + offset + n])
        state = cr.end_states(piece)[cr.STATES.index(state)]
    return found


@settings(max_examples=300, deadline=None)
@given(_ROWS, st.integers(1, 40), st.sampled_from(["\n", "\r\n"]), st.booleans())
def test_records_of_ranges_are_the_records_of_the_file(rows, size, line_end, ended):
    lines = [",".join(row) for row in rows]
    data = (line_end.join(lines) + (line_end if ended else "")).encode()
    assert _by_ranges(data, size) == [line.encode() for line in lines if line]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='a",\n\r', max_size=30), st.integers(1, 31))
def test_ranges_of_any_bytes_agree_with_one_range(text, size):
    data = text.encode()
    assert _by_ranges(data, size) == _by_ranges(data, len(data) + 1)


def test_states_of_a_range_are_those_of_its_bytes_one_by_one():
    chooser = random.Random(3)
    for _ in range(300):
        data = bytes(chooser.choice(b'a",\n') for _ in range(chooser.randint(1, 12)))
        for i, first in enumerate(cr.STATES):
            state = first
            for byte in data:
                state = cr.end_states(bytes([byte]))[cr.STATES.index(state)]
            assert state == cr.end_states(data)[i], (data, first)


def _adversarial(tmp_path):
    rows = ["id,title,body"]
    for i in range(200):
        rows.append(f'{i},"line one\nline ""two"", {i}\r\n\n",in"side {i}')
        rows.append(f'"{i}b",,"""{"," * (i % 7)}"""')
        rows.append(f'{i}c,"","é\n{"x" * (i * 3)}"')
        rows.append("")
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes("\n".join(rows).encode())
    (folder / "b.csv").write_bytes('\n\nid,title,body\n7,"q\n",z\n'.encode())
    (folder / "empty.csv").write_bytes(b"")
    (folder / "other.txt").write_bytes(b"id\nno")
    return folder


def test_ranges_equal_the_multi_line_reader(spark, tmp_path):
    folder = _adversarial(tmp_path)
    schema = "id string, title string, body string"
    whole = csv_io.scan_csv(spark, str(folder), schema, "*.csv")
    expected = sorted(map(tuple, whole.collect()), key=str)
    assert len(expected) == 601
    size = (folder / "a.csv").stat().st_size
    for range_bytes in (size // 4 + 1, 257, 1 << 20):
        found = cr.scan_csv_ranges(spark, str(folder), schema, range_bytes=range_bytes)
        assert sorted((tuple(r) for r in found.select("id", "title", "body").collect()), key=str) == expected
    blocks = cr.scan_csv_ranges(spark, str(folder / "a.csv"), schema, range_bytes=size // 4 + 1)
    assert blocks.select("src_block").distinct().count() == 4
    ids = [r.id for r in blocks.orderBy("src_file", "src_block", "src_row").collect()]
    assert ids == [f"{i}{s}" for i in range(200) for s in ("", "b", "c")]


def test_no_file_with_content_gives_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"")
    (tmp_path / "b.csv").write_bytes(b"id,t\n")
    assert cr.scan_csv_ranges(spark, str(tmp_path), "id string, t string").collect() == []
