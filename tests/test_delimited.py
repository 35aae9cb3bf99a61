"""Delimited files in byte ranges and members of zip archives, against a reader that goes byte by byte."""

from __future__ import annotations

import random
import zipfile

import pytest
from conftest import ordered, rows
from outorga.sources import delimited
from outorga.sources.delimited import ends_inside, first_record_end, last_record_end, read_ranges, read_zipped, zip_members

SEP = b";"


def states(text: bytes, inside: bool = False) -> list[bool]:
    """Whether each position lies in quotes; a quote opens a field at its start only."""
    out, start, k = [], not inside, 0
    while k < len(text):
        c = text[k : k + 1]
        out.append(inside)
        if inside:
            if c == b'"':
                if text[k + 1 : k + 2] == b'"':
                    out.append(True)
                    k += 1
                else:
                    inside = False
            start = False
        elif c == b'"' and start:
            inside, start = True, False
        else:
            start = c in (SEP, b"\n", b"\r")
        k += 1
    return [*out, inside]


def record_ends(text: bytes) -> list[int]:
    inside = states(text)
    return [k + 1 for k in range(len(text)) if text[k : k + 1] == b"\n" and not inside[k]]


def sample(rng: random.Random, n: int) -> bytes:
    """Fields with line breaks, doubled quotes, separators, and quotes that open nothing."""
    field = ['plain', '', 'a 40" wide one', '"q"', '"two\nlines"', '"with ""quotes"" and ;"', '"\r\n\n"', 'é', '"""x"""', 'x"y"', '""', '" ;\n"" \n"']
    return "".join(";".join(rng.choice(field) for _ in range(3)) + rng.choice(["\n", "\r\n"]) for _ in range(n)).encode()


@pytest.mark.parametrize("seed", range(20))
def test_states_at_line_starts(seed):
    text = sample(random.Random(seed), 30)
    inside, ends = states(text), record_ends(text)
    lines = [0] + [k + 1 for k in range(len(text)) if text[k : k + 1] == b"\n"]
    for a in lines[::3]:
        for b in lines[::2]:
            if a < b:
                assert ends_inside(text[a:b], SEP, inside[a]) == inside[b]
                assert ends_inside(text[a:b], SEP, True) == states(text[a:b], True)[-1]
        want = next(e for e in ends if e > a) if a < ends[-1] else None
        if want and inside[a]:
            assert first_record_end(text[a:], SEP, True) == want - a
    for a in [0, *ends][:-1]:
        assert first_record_end(text[a:], SEP, False) == next(e for e in ends if e > a) - a
        for b in range(a, len(text), 7):  # never past what is certain, never short of it
            found = a + last_record_end(text[a:b], SEP)
            certain = [e for e in ends if a < e <= b]
            assert found in (certain[-2:] or [a]) if text[b - 1 : b] == b"\n" else found == (certain[-1] if certain else a)


def content(seed: int = 1, n: int = 400):
    rng = random.Random(seed)
    values = ["plain", "", "NULL", 'in the "middle"', "two\nlines", "a;b", '"', "\r\n", "é ü", "line\r\nbreak \n\n", " padded ", "x" * 300]
    data = [(str(k), rng.choice(values), rng.choice(values), rng.choice(["", "z"])) for k in range(n)]

    def written(v: str) -> str:
        quoted = any(c in v for c in ';\n\r') or v.startswith('"') or rng.random() < 0.2
        return '"' + v.replace('"', '""') + '"' if quoted else v

    text = "id;one;two;three\n" + "".join(";".join(map(written, r)) + rng.choice(["\n", "\r\n"]) for r in data)
    return text, ordered(tuple(None if v in ("", "NULL") else v for v in (r[2], r[0])) for r in data)


@pytest.mark.parametrize("step", [1 << 26, 2000, 701])
def test_one_file_in_many_ranges(spark, tmp_path, step):
    text, want = content()
    path = tmp_path / "a b.csv"
    path.write_bytes(b"\xef\xbb\xbf" + text.encode())
    df = read_ranges(spark, str(path), ["two", "id"], step=step)
    assert rows(df) == want
    if step < 10_000:
        ranges = delimited.byte_ranges(spark, str(path), step=step)
        assert ranges.count() > 10 and ranges.where("inside").count() > 0
        assert df.rdd.getNumPartitions() == ranges.count()


def test_many_small_ranges_share_tasks(spark, tmp_path):
    text, want = content(3, 2000)
    for name in "ab":
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    ranges = delimited.byte_ranges(spark, str(tmp_path), step=301)
    most = delimited.TASKS * spark.sparkContext.defaultParallelism
    assert ranges.count() > 2 * most and ranges.rdd.getNumPartitions() == most
    df = read_ranges(spark, str(tmp_path), ["two", "id"], step=301)
    assert df.rdd.getNumPartitions() == most
    assert rows(df) == ordered([*want, *want])


def test_folders_widths_and_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2;surplus\n3\n\n4;5")
    (tmp_path / "b.csv").write_text("y;other;x\r\n6;;7\r\n")
    (tmp_path / "c.csv").write_text("x;y\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text('x;y\n8;"never closed\n9;9\n')
    got = rows(read_ranges(spark, str(tmp_path), ["y", "x"], step=6))
    assert got == ordered([("2", "1"), (None, "3"), ("5", "4"), ("6", "7"), ("never closed\n9;9\n", "8")])
    (tmp_path / "latin").mkdir()
    (tmp_path / "latin" / "l.csv").write_bytes("x,y\nção,é\n".encode("latin-1"))
    assert rows(read_ranges(spark, str(tmp_path / "latin"), ["x", "y"], ",", "latin-1")) == [("ção", "é")]
    (tmp_path / "latin" / "l.csv").write_bytes(b"x,y\n\xe7,ok\n")
    assert rows(read_ranges(spark, str(tmp_path / "latin"), ["x", "y"], ",")) == [("�", "ok")]
    with pytest.raises(Exception, match="has no column z"):
        read_ranges(spark, str(tmp_path / "a.csv"), ["z"]).count()


def test_zip_members(spark, tmp_path):
    text, want = content(2)
    for name, members in (("one", 3), ("two", 2)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("folder/", "")
            archive.writestr("empty.csv", "")
            for k in range(members):
                archive.writestr(f"folder/{k}.csv", text)
    found = zip_members(spark, str(tmp_path / "*.zip"))
    assert found.where("length > 0").count() == 5 and found.count() == 7
    for block in (64, 1000, 1 << 23):
        df = read_zipped(spark, str(tmp_path), ["two", "id"], block=block)
        assert rows(df.distinct()) == ordered(set(want)) and df.count() == 5 * len(want)
    assert df.rdd.getNumPartitions() == 5
