import zipfile

import pytest

from regweave.schemas import DATASETS, text_schema
from regweave.sources.archives import (
    audit_archives,
    list_archives,
    list_entries,
    read_zipped,
    storage_uri,
)
from regweave.sources.delimited import read_delimited, read_family, read_state_registry

ABC = text_schema(["a", "b", "c"])

# One line per case of the raw format, and the row it has to give.
LINES = {
    b"1;;x": ("1", None, "x"),
    b'2;"";x': ("2", None, "x"),
    b'3;"   ";x': ("3", "   ", "x"),
    b"4;\xe3;x": ("4", "ã", "x"),
    b'"RUA \\";"said ""hi""";x': ("RUA \\", 'said "hi"', "x"),
    b'6;"a;b";x': ("6", "a;b", "x"),
    b"7;short": ("7", "short", None),
    b"8;b;c;surplus": ("8", "b", "c"),
    b"0009;007;\t": ("0009", "007", "\t"),
    b"10; b ;\xa0": ("10", " b ", " "),
}


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "Abc0" / "part"
    path.parent.mkdir()
    path.write_bytes(b"\n".join(LINES) + b"\n\n")
    return path


def test_delimited_edge_cases(spark, bag, raw_file):
    got = read_delimited(spark, str(raw_file), ABC)
    assert got.schema == ABC
    assert set(bag(got)) == set(LINES.values())


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_delimited(spark, [], ABC)
    with pytest.raises(ValueError):
        read_family(spark, str(tmp_path), "Nothing", ABC)


def test_line_break_in_quotes_needs_multi_line(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes(b'1;"x\ny";z\n')
    assert read_delimited(spark, str(path), ABC).count() == 2
    assert read_delimited(spark, str(path), ABC, multi_line=True).first().b == "x\ny"


def test_family_is_every_directory_with_the_prefix(spark, tmp_path):
    for number in range(2):
        directory = tmp_path / f"Abc{number}"
        directory.mkdir()
        (directory / "one").write_bytes(b"%d;b;c\n" % number)
        (directory / "two").write_bytes(b"x;b;c\n")
    (tmp_path / "Abc9.zip").write_bytes(b"not a directory")
    (tmp_path / "Other").mkdir()
    assert read_family(spark, str(tmp_path), "Abc", ABC).count() == 4
    first = read_family(spark, str(tmp_path), "Abc", ABC, first_only=True)
    assert sorted(row.a for row in first.collect()) == ["0", "x"]


def test_state_registry_names_are_positional(spark, tmp_path):
    columns = DATASETS["jucees"].columns
    path = tmp_path / "registry.csv"
    header = ",".join(reversed(columns))
    path.write_text(header + "\n" + ",".join(str(i) for i in range(14)) + "\n", encoding="utf-8")
    got = read_state_registry(spark, str(path))
    assert got.columns == columns
    assert [tuple(row) for row in got.collect()] == [tuple(str(i) for i in range(14))]


def test_filter_and_columns_reach_the_text_scan(spark, plan, raw_file):
    text = plan(read_delimited(spark, str(raw_file), ABC).filter("a = '1'").select("c"))
    assert "EqualTo(a,1)" in text and "ReadSchema: struct<a:string,c:string>" in text


def zipped(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)


def test_zipped_rows_equal_unzipped_rows(spark, bag, tmp_path, raw_file):
    content = raw_file.read_bytes()
    zipped(tmp_path / "Abc0.zip", {"one": content, "dir/two": content.replace(b"\n", b"\r\n")})
    zipped(tmp_path / "Abc 1.zip", {"one": content, "empty": b""})
    (tmp_path / "Abc2.zip").write_bytes(b"this is no archive")
    (tmp_path / "Abc3.zip").write_bytes(b"")
    archives = list_archives(spark, str(tmp_path))
    assert archives.count() == 4
    with pytest.raises(Exception, match="damaged archive"):
        read_zipped(archives, ABC).count()
    # Whoever wants the readable archives only says so.
    good = audit_archives(archives).where("ok").select("archive")
    want = bag(read_delimited(spark, [str(raw_file)] * 1, ABC))
    assert bag(read_zipped(good, ABC)) == {row: 3 * n for row, n in want.items()}


def test_no_archive_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_archives(spark, str(tmp_path))


def test_entries_of_one_archive_are_decoded_by_many_tasks(spark, plan, tmp_path):
    zipped(tmp_path / "x.zip", {f"{i}.csv": f"{i};b;c\n".encode() for i in range(50)})
    archives = list_archives(spark, str(tmp_path))
    got = read_zipped(archives, ABC)
    assert "rangepartitioning(archive" in plan(got) and ", 50)" in plan(got)
    # Enough equal entries: parsed and filtered where they are decoded, not moved before.
    assert "REBALANCE" not in plan(got.filter("a = '1'"))
    assert sorted(int(row.a) for row in got.collect()) == list(range(50))
    assert list_entries(archives).agg({"size": "sum"}).first()[0] == sum(
        len(f"{i};b;c\n") for i in range(50)
    )
    assert tuple(audit_archives(archives).first())[1:] == (50, 340, None, True)


def test_lines_of_one_large_entry_are_spread(spark, plan, tmp_path):
    zipped(tmp_path / "x.zip", {"1.csv": b"1;b;c\n" * 5000, "2.csv": b"2;b;c\n"})
    got = read_zipped(list_archives(spark, str(tmp_path)), ABC)
    assert "REBALANCE" in plan(got) and got.count() == 5001


@pytest.mark.parametrize("location, uri", [
    ("abfss://box@acc.example.net/a b/x.zip", "abfss://box@acc.example.net/a%20b/x.zip"),
    ("hdfs://nn:8020/a/x y.zip", "hdfs://nn:8020/a/x%20y.zip"),
    ("s3a://bucket/k@1:2.zip", "s3://bucket/k%401%3A2.zip"),
    ("s3n://bucket/x.zip", "s3://bucket/x.zip"),
])
def test_only_the_path_of_a_location_is_escaped(location, uri):
    assert storage_uri(location) == uri


def test_zipped_lines_longer_than_a_chunk_and_header(spark, tmp_path, monkeypatch):
    long = "ã" * 3000
    lines = "a,b,c\n" + "".join(f"{i},{long},z\n" for i in range(2000)) + "last,,"
    zipped(tmp_path / "x.zip", {"x.csv": lines.encode("utf-8")})
    got = read_zipped(list_archives(spark, str(tmp_path)), ABC, ",", "UTF-8", header=True)
    assert got.count() == 2001
    assert got.filter("a = 'last'").first().b is None
    assert got.filter(f"b = '{long}'").count() == 2000


def test_audit_reports_every_kind_of_damage(spark, tmp_path):
    zipped(tmp_path / "good.zip", {"a": b"12345", "b": b"1"})
    with zipfile.ZipFile(tmp_path / "nothing.zip", "w") as archive:
        archive.comment = b"an archive without entries that is long enough to be one"
    zipped(tmp_path / "crc.zip", {"a": bytes(range(256)) * 50})
    (tmp_path / "text.zip").write_bytes(b"no archive")
    (tmp_path / "empty.zip").write_bytes(b"")
    damaged = bytearray((tmp_path / "crc.zip").read_bytes())
    damaged[60] ^= 0xFF
    (tmp_path / "crc.zip").write_bytes(bytes(damaged))
    rows = audit_archives(list_archives(spark, str(tmp_path))).collect()
    got = {row.archive.rsplit("/", 1)[1]: tuple(row)[1:] for row in rows}
    assert got == {
        "good.zip": (2, 6, None, True),
        "crc.zip": (1, 12800, "a", False),
        "text.zip": (None, None, None, False),
        "empty.zip": (None, None, None, False),
        "nothing.zip": (None, None, None, False),
    }
