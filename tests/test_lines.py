import datetime as dt

import pytest
from pyspark.sql import functions as F

from periodica.fixed_values import FOOTER_PREFIX
from periodica.sources import files
from periodica.sources.release_lines import carry_forward, is_noise, parse_lines

NINE = "12.3 11.9 105,408 99,000 +6.5 10.0 9.8 1,000,000 900,000 +11.1"


def parse(spark, lines, block=10_000, **options):
    data = [("doc", dt.date(2025, 10, 1), i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(data, "doc string, period date, n int, line string")
    return parse_lines(df, "doc", "n", "line", "period", block=block, **options)


REPORT = [
    f"Early {NINE}",
    "EUROPEAN UNION (EU)",
    "New car registrations by manufacturer",
    "% share Oct 1 2 3 4 5 6 7 8 9",
    "2025 2024 2025 2024 1 2 3 4 5",
    "October 1 2 3 4 5 6 7 8 9",
    "EU",
    f"  Volkswagen {NINE}",
    f"BMW Group1 {NINE}",
    f"Others {NINE}",
    "Short 1 2 3 4 5 6 7 8",
    "1 2 3 4 5 6 7 8 9 10",
    "EFTA",
    f"Volkswagen  AG {NINE}",
    "Page 3 of 4 1 2 3 4 5 6 7 8 9",
    "2 Includes Dodge 1 2 3 4 5 6 7 8 9",
    "EU + EFTA + UK",
    f"Kia {NINE}",
    "",
]


@pytest.mark.parametrize("block", [1, 2, 5, 10_000])
def test_report(spark, rows, block):
    """The carried region and table state is the same whatever the block size."""
    got = rows(parse(spark, REPORT, block), "manufacturer", "frequency", "month", "units", "region", "pdf")
    want = []
    for maker, region in [
        ("Volkswagen", "European Union (EU)"),
        ("BMW Group", "European Union (EU)"),
        ("Volkswagen AG", "EFTA"),
        ("Kia", "EU + EFTA + UK"),
    ]:
        want += [
            (maker, "M", "Oct-25", "105,408", region, "Oct-25"),
            (maker, "M", "Oct-24", "99,000", region, "Oct-25"),
            (maker, "YTD", "Oct-25", "1,000,000", region, "Oct-25"),
            (maker, "YTD", "Oct-24", "900,000", region, "Oct-25"),
        ]
    assert got == sorted(want, key=repr)


def test_region_defaults_and_year_header_is_a_parameter(spark, rows):
    lines = ["NEW CAR REGISTRATIONS BY MANUFACTURER", f"Kia {NINE}", f"2031 2030 {NINE}", f"Model 3x {NINE}"]
    got = rows(parse(spark, lines, year_header="2031 2030"), "manufacturer", "region", "units")
    assert {r[0] for r in got} == {"Kia", "Model"}
    assert {r[1] for r in got} == {"European Union (EU)"}


def test_88_lines_give_352_records(spark):
    lines = ["New car registrations by manufacturer"] + [f"Maker {chr(65 + i % 26)}x {NINE}" for i in range(88)]
    assert parse(spark, lines).count() == 352


@pytest.mark.parametrize(
    "line, noise",
    [(f"{FOOTER_PREFIX} - press", True), (" Page 1 of 2", True), ("page one", False), ("1 Includes Bentley", True), ("1 Toyota", False),
     ("10 includes", False), ("", False), ("Man 1 2", False), ("3 MAN trucks", True), ("offer on page", True)],
)
def test_noise(spark, line, noise):
    assert spark.createDataFrame([(line,)], "v string").select(is_noise(F.col("v"))).first()[0] is noise


def test_carry_forward_against_a_loop(spark):
    marks = {3: "a", 4: None, 17: "b", 18: "c", 41: "d"}
    data = [(k, i, marks.get(i) if k == "x" else None) for k in "xy" for i in range(0, 60)]
    df = spark.createDataFrame(data, "k string, n int, m string")
    out = carry_forward(df, ["k"], "n", {"m": "state"}, block=4)
    state, want = None, {}
    for i in range(60):
        state = marks.get(i) or state
        want[("x", i)], want[("y", i)] = state, None
    assert {(r.k, r.n): r.state for r in out.collect()} == want


@pytest.mark.parametrize(
    "name, period",
    [("Press_release_car_registrations_October_2025.pdf", dt.date(2025, 10, 1)), ("MAY_2024_v12345.csv", dt.date(2024, 5, 1)),
     ("release_2024.pdf", None), ("release_May.pdf", None), ("x20245_June_2023.pdf", dt.date(2023, 6, 1)),
     ("March_2024_and_January_2023.pdf", dt.date(2024, 1, 1))],
)
def test_period_from_name(spark, name, period):
    df = spark.createDataFrame([(name,)], "v string")
    assert df.select(files.period_from_name("v")).first()[0] == period


def test_period_from_name_strict(spark):
    with pytest.raises(Exception, match="no month and year"):
        spark.createDataFrame([("x.pdf",)], "v string").select(files.period_from_name("v", strict=True)).collect()


def test_fallback(spark, rows):
    first = spark.createDataFrame([("a", 1)], "doc string, v int")
    second = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "doc string, v int")
    assert rows(files.with_fallback(first, second, "doc")) == [("a", 1), ("b", 3), ("b", 4)]


def test_csv_scan_and_manifest(spark, rows, tmp_path):
    header = "Manufacturer,Frequency,Month,Units,Region,PDF\n"
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "Press_release_May_2024_schema.csv").write_text(header + 'X,M,May-24,"105,408",EU,May-24\n')
    (deep / "Press_release_June_2024_schema.csv").write_text(header + "X,M,Jun-24,7,EU,Jun-24\nY,M,Jun-24,8,EU,Jun-24\n")
    (deep / "_index.csv").write_text("pdf_file,rows\n1,2\n")
    (deep / "notes.csv").write_text("a,b\n1,2\n")
    scan = files.scan_csv(spark, str(tmp_path), files.RELEASE_SCHEMA)
    loaded = files.load_raw(scan, "2025-01-01T00:00:00")
    assert rows(loaded, "Manufacturer", "Units") == [("X", 105408.0), ("X", 7.0), ("Y", 8.0)]
    assert rows(files.manifest(scan, "file_name", 6)) == [
        ("Press_release_June_2024_schema.csv", 2, 6),
        ("Press_release_May_2024_schema.csv", 1, 6),
    ]
    listed = files.list_files(spark, str(tmp_path), "Press_release*.csv").collect()
    assert [r.path.rsplit("/", 1)[-1][14:18] for r in listed] == ["May_", "June"]


def test_text_lines_come_in_file_order(spark, tmp_path):
    (tmp_path / "one.txt").write_text("\n".join(f"line {i}" for i in range(500)))
    (tmp_path / "two.txt").write_text("\n".join(f"row {i}" for i in range(300)))
    for name, word, count in [("one.txt", "line", 500), ("two.txt", "row", 300)]:
        lines = files.scan_lines(spark, str(tmp_path)).where(F.col("file_name") == name).orderBy("line_no")
        assert [r.line for r in lines.collect()] == [f"{word} {i}" for i in range(count)]


def test_seed_override_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("code,n\n007,1\n008,2\n")
    seed = files.load_seed(spark, str(tmp_path / "seed.csv"), {"code": "string", "n": "double"})
    assert [tuple(r) for r in seed.orderBy("code").collect()] == [("007", 1.0), ("008", 2.0)]


def test_small_pieces_and_equal_names_keep_lines_apart(spark, tmp_path):
    """Pieces far below a MiB, empty lines, and two files of one name."""
    texts = {"a": "\n" * 3000 + "\n".join(f"a{i}" for i in range(3000)), "b": "\n".join(str(i) for i in range(5000)) + "\n" * 200}
    for folder, text in texts.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.txt").write_text(text)
    for i in range(20):
        (tmp_path / f"small{i}.txt").write_text(f"{i}\n\n{i}")
    sizes = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        rows = files.scan_lines(spark, str(tmp_path)).collect()
    finally:
        for key in sizes:
            spark.conf.unset(key)
    for folder, text in texts.items():
        own = sorted((r.line_no, r.line) for r in rows if f"/{folder}/same.txt" in r.file_path)
        assert [line for _, line in own] == text.splitlines()
        assert len({n for n, _ in own}) == len(own)


def test_csv_files_are_united_by_name(spark, rows, tmp_path):
    (tmp_path / "Press_release 1.csv").write_text('PDF,Units,Month,manufacturer,"Note, x"\np1,"1,000",May-24,A,n\n')
    (tmp_path / "Press_release%202.csv").write_text("\ufeffManufacturer,Frequency,Month,Units,Region,PDF\nB,M,May-24,2,EU,p2\n")
    (tmp_path / "Press_release3.csv").write_text("Region,PDF\nEU,p3\nEFTA,p3\n")
    (tmp_path / "Press_release4.csv").write_text("")
    (tmp_path / "Press_release5.csv").write_text("Region,PDF\n")
    scan = files.scan_csv(spark, str(tmp_path), files.RELEASE_SCHEMA)
    assert scan.columns == [*files.RELEASE_SCHEMA.names, "file_path", "file_name"]
    assert rows(scan, *files.RELEASE_SCHEMA.names) == sorted(
        [("A", None, "May-24", "1,000", None, "p1"), ("B", "M", "May-24", "2", "EU", "p2"),
         (None, None, None, None, "EU", "p3"), (None, None, None, None, "EFTA", "p3")],
        key=repr,
    )
    assert len(files.csv_layouts(spark, str(tmp_path), "Press_release*.csv")) == 3
    with pytest.raises(Exception, match="header"):
        files.scan_csv(spark, str(tmp_path), files.RELEASE_SCHEMA, one_layout=True).collect()
    assert files.scan_csv(spark, str(tmp_path), files.RELEASE_SCHEMA, "none*.csv").collect() == []


def test_repeated_column_names_are_an_error(spark, tmp_path):
    (tmp_path / "Press_release1.csv").write_text("Region,PDF,region\nEU,p,x\n")
    with pytest.raises(ValueError, match="more than once"):
        files.scan_csv(spark, str(tmp_path), files.RELEASE_SCHEMA)
