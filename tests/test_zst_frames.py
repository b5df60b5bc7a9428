"""Reading frames of one dump in several tasks against reading it in one."""

from __future__ import annotations

import io

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from moodtide.sources import zst
from moodtide.sources import zst_frames as zf


class _File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())

    def read_at(self, n, offset):
        return bytes(self.getbuffer()[offset : offset + n])


def _lines_of(text: bytes) -> list[bytes]:
    lines = text.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
    return lines[:-1] if lines[-1] == b"" else lines


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="ab\r\n", min_size=1, max_size=5), min_size=1, max_size=7), st.integers(1, 3))
def test_each_line_belongs_to_one_run(frames, block):
    """Every frame a run of its own, in blocks of any length: the lines are those of the whole text."""
    texts = [f.encode() for f in frames]
    blocks = lambda t: iter([t[i : i + block] for i in range(0, len(t), block)])
    found = []
    for i, text in enumerate(texts):
        for piece in zf.run_text(blocks(text), blocks(b"".join(texts[i + 1 :])), i == 0):
            found += _lines_of(piece)
    assert found == _lines_of(b"".join(texts))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300_000), st.booleans(), st.booleans(), st.booleans()), min_size=1, max_size=5))
def test_frame_ends_are_where_frames_were_put_together(frames):
    """Empty, repeated-byte, many-block, checked and skippable frames."""
    data, ends = b"", []
    for size, plain, checksum, skippable in frames:
        content = b"x" * size if plain else bytes((i * i >> 3) % 251 for i in range(size))
        if skippable:
            data += (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"12345"
        else:
            data += zstandard.ZstdCompressor(write_checksum=checksum, write_content_size=plain).compress(content)
        ends.append(len(data))
    assert list(zf.frame_ends(_File(data))) == list(zip([0, *ends], ends))


def test_broken_frame_takes_the_rest():
    whole = zstandard.ZstdCompressor().compress(b"a\n" * 1000)
    assert list(zf.frame_ends(_File(whole + b"nonsense"))) == [(0, len(whole)), (len(whole), len(whole) + 8)]
    assert list(zf.frame_ends(_File(whole[:-3]))) == [(0, len(whole) - 3)]
    assert list(zf.frame_ends(_File(b""))) == []


def test_many_frames_are_read_by_several_tasks(spark, tmp_path):
    text = "".join(f'{{"id": "{i}", "t": "{"é" * (i % 90)}"}}' + ("\r\n" if i % 3 else "\n") for i in range(4000)).encode()
    step = len(text) // 40 + 1
    packed = b"".join(zstandard.ZstdCompressor().compress(text[i : i + step]) for i in range(0, len(text), step))
    (tmp_path / "many.zst").write_bytes(packed)
    (tmp_path / "one.zst").write_bytes(zstandard.ZstdCompressor().compress(b"first\n\nlast"))
    (tmp_path / "empty.zst").write_bytes(b"")
    index = zf.frame_index(spark, str(tmp_path))
    assert index.count() == 41
    found = zf.scan_zst_frames(spark, index=index, run_bytes=len(packed) // 8)
    many = found.filter(found.src_file.endswith("many.zst"))
    assert 7 <= many.select("src_block").distinct().count() <= 9
    assert many.rdd.getNumPartitions() > 7
    ordered = [r.value for r in many.orderBy("src_block", "src_row").collect()]
    assert ordered == text.decode().replace("\r\n", "\n").split("\n")[:-1]
    once = zst.scan_zst(spark, str(tmp_path))
    values = lambda df: sorted(r.value for r in df.select("value").collect())
    assert values(found) == values(once) == values(zf.scan_zst_frames(spark, str(tmp_path)))
