"""Scanning delimited files: heads, splits, quotes, separators, ragged rows."""

import pytest

from feedmill.feeds import FeedSpec, layout
from feedmill.sources.delimited import MALFORMED, PIECE, any_case, scan, scan_lines

LAYOUT = layout("""
    a 10 required
    b 10
    c 10
""")


def spec(skip=1, sep=","):
    return FeedSpec("t", "t", "t*.csv", LAYOUT, skip=skip, sep=sep)


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def cells(df):
    return sorted(tuple(r[:3]) for r in df.select("a", "b", "c", MALFORMED).collect() if not r[3])


@pytest.mark.parametrize("skip", [0, 1, 2, 4, 5])
def test_skips_the_head_of_every_file_over_many_splits(spark, tmp_path, skip):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        paths, want = [], []
        for f in range(5):
            rows = [(str(f), str(i), "x" * (i % 7)) for i in range(400 if f % 2 else 3)]
            head = "".join(f"head{h},{f},\n" for h in range(skip))
            body = "".join(",".join(r) + "\n" for r in rows)
            paths.append(write(tmp_path / f"t{f}.csv", head + body))
            want += rows
        df = scan(spark, spec(skip), paths)
        assert df.rdd.getNumPartitions() > 5
        assert cells(df) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_shorter_than_its_head_takes_nothing_from_others(spark, tmp_path):
    paths = [
        write(tmp_path / "t1.csv", "h\nh\n"),
        write(tmp_path / "t2.csv", "h\nh\nh\nh\n1,2,3\n"),
        write(tmp_path / "t3.csv", ""),
    ]
    assert cells(scan(spark, spec(4), paths)) == [("1", "2", "3")]


def test_empty_cells_are_empty_text(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'h,h,h\nx,,\ny,"",z\n,1,2\n')
    assert cells(scan(spark, spec(), [path])) == [("", "1", "2"), ("x", "", ""), ("y", "", "z")]


def test_quotes(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'h,h,h\n"a,b","say ""hi""",c\\d\n')
    assert cells(scan(spark, spec(), [path])) == [("a,b", 'say "hi"', "c\\d")]


def test_short_and_long_rows_are_malformed(spark, tmp_path):
    path = write(tmp_path / "t.csv", "h,h,h\n1,2\n1,2,3,4\n1,2,3\n")
    df = scan(spark, spec(), [path])
    assert df.filter(MALFORMED).count() == 2
    assert cells(df) == [("1", "2", "3")]


def test_single_blanks_separate(spark, tmp_path):
    path = write(tmp_path / "t.csv", "head\nhead\nN PAAAA 5\nN  7\n")
    assert cells(scan(spark, spec(2, " "), [path])) == [("N", "", "7"), ("N", "PAAAA", "5")]


@pytest.mark.parametrize("skip", [0, 1, 2])
def test_quoted_line_ends_are_read_by_record(spark, tmp_path, skip):
    head = "h,h,h\n" * skip
    inner = write(tmp_path / "t1.csv", head + 'a,"x\ny",b\nq,r,"last\np,q,r"\n')
    other = write(tmp_path / "t2.csv", head + "1,2,3\n")
    assert cells(scan(spark, spec(skip), [inner, other])) == [
        ("1", "2", "3"),
        ("a", "x\ny", "b"),
        ("q", "r", "last\np,q,r"),
    ]


def test_stray_quotes_stand_alone(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'h,h,h\n5" pipe,b,c\n"open,b,c\n' + "1,2,3\n" * 40 + 'x,y,"end\n')
    df = scan(spark, spec(), [path])
    assert cells(df) == sorted([('5" pipe', "b", "c")] + [("1", "2", "3")] * 40)
    assert df.filter(MALFORMED).count() == 2


@pytest.mark.parametrize("size", [40, 64, 100, 333, 2000])
def test_records_span_lines_and_splits(spark, tmp_path, size):
    """Records over line ends, blank lines, doubled quotes and separators, whatever splits cut."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        rows, text = [], "h,h,h\n"
        for i in range(150):
            row = [str(i), ("a\n\nb", 'q""x\n', "plain", "c,\nd", "e")[i % 5], ("", "z", "v\n,w")[i % 3]]
            rows.append(tuple(c.replace('""', '"') for c in row))
            text += ",".join(f'"{c}"' if "\n" in c or '"' in c or "," in c else c for c in row) + "\n"
        path = write(tmp_path / "t.csv", text)
        df = scan(spark, spec(), [path])
        assert cells(df) == sorted(rows)
        assert size > 1000 or scan_lines(spark, spec(), [path]).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_without_quotes_have_few_pieces(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        path = write(tmp_path / "t.csv", "h,h,h\n" + "1,2,3\n" * 5000)
        rows = scan_lines(spark, spec(), [path])
        splits = rows.rdd.getNumPartitions()
        assert splits > 3 and rows.filter(f"{PIECE} <> 0").count() <= 13 * splits
        assert cells(scan(spark, spec(), [path])) == [("1", "2", "3")] * 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_masks_ignore_case():
    assert any_case("MPrice*.csv") == "[mM][pP][rR][iI][cC][eE]*.[cC][sS][vV]"
