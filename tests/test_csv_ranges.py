import pytest

from quillsift.sources import csv_ranges, csv_source

TEXT = (
    'n,Body,Label\n0,"a\n\n""b"", c\n",1\n\n1,plain ü,0\n2,"",1\n3,"x\ny\nz\n""\n""",0\n4,,\n\n'
    '5,"' + "\n" * 40 + '",1\n6,"""",0\n7,last,1'
)


@pytest.fixture
def cuts(spark):
    """Sets the length of the byte ranges."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {name: spark.conf.get(name) for name in names}

    def to(length):
        for name in names:
            spark.conf.set(name, str(length))

    yield to
    for name, value in old.items():
        spark.conf.set(name, value)


def whole(spark, path):
    """The read of one task per file."""
    rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path).collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("length", [1, 7, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_equal_to_one_task_wherever_the_file_is_cut(spark, tmp_path, cuts, length, ending):
    path = str(tmp_path / "one.csv")
    with open(path, "w", newline="") as file:
        file.write(TEXT.replace("\n", ending))
    expected = whole(spark, path)
    cuts(length)
    rows = csv_ranges.read(spark, path, ["n", "Body", "Label"], csv_source.FORMAT).orderBy("row_id").collect()
    assert [(r["n"], r["Body"], r["Label"]) for r in rows] == expected
    assert [r["row_id"] for r in rows] == list(range(1, len(expected) + 1))


def test_ranges_beyond_the_broadcast_are_joined(spark, tmp_path, cuts, monkeypatch):
    (tmp_path / "one.csv").write_text(TEXT)
    expected = whole(spark, str(tmp_path / "one.csv"))
    cuts(5)
    monkeypatch.setattr(csv_ranges, "SMALL_RANGES", 0)
    rows = csv_ranges.read(spark, str(tmp_path / "one.csv"), ["n", "Body", "Label"], csv_source.FORMAT).orderBy("row_id").collect()
    assert [(r["n"], r["Body"], r["Label"]) for r in rows] == expected


def test_folder_header_only_and_open_end(spark, tmp_path, cuts):
    (tmp_path / "a.csv").write_text('Body,Label\n"never\nclosed')
    (tmp_path / "b.csv").write_text("Body,Label\n")
    (tmp_path / "c.csv").write_text('Body,Label\n"x\ny",1\n')
    cuts(4)
    rows = csv_ranges.records(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [(r["first"], r["record"]) for r in rows] == [
        (True, "Body,Label"), (False, '"never\nclosed'), (True, "Body,Label"), (True, "Body,Label"), (False, '"x\ny",1'),
    ]
