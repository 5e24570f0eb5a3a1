from pyspark.sql import functions as F

from hitledger.operators.ingest import drop_late, ingest_rows
from hitledger.sources import lines

GOOD = "1002|10.0.0.1|203.0.113.9|1|4000|80|a.com|aHR0cA==|3|1705312922"


def test_tolerant_parser(lines_of):
    fields = GOOD.split("|")
    swap = lambda i, v: "|".join([*fields[:i], v, *fields[i + 1:]])
    cases = {
        GOOD: (1002, "10.0.0.1", "a.com", "2024-01-15 10:02:02", "240115", "10", "00"),
        swap(0, "x1"): (0, "10.0.0.1", "a.com", "2024-01-15 10:02:02", "240115", "10", "00"),
        swap(0, " 12 "): (0, "10.0.0.1", "a.com", "2024-01-15 10:02:02", "240115", "10", "00"),
        swap(0, "99999999999"): (0, "10.0.0.1", "a.com", "2024-01-15 10:02:02", "240115", "10", "00"),
        swap(6, " \ta.com "): (1002, "10.0.0.1", "a.com", "2024-01-15 10:02:02", "240115", "10", "00"),
        GOOD + "|extra": (1002, "10.0.0.1", "a.com", "0", "0", "0", "0"),
        swap(9, ""): (1002, "10.0.0.1", "a.com", "0", "0", "0", "0"),
        swap(9, "abc"): (1002, "10.0.0.1", "a.com", "0", "0", "0", "0"),
        "a|b": (-1, "a|b", "-1", "-1", "-1", "-1", "-1"),
        "": (-1, "", "-1", "-1", "-1", "-1", "-1"),
    }
    for line, want in cases.items():
        row = lines.parse_tolerant(lines_of(line), zone="UTC").first()
        assert (row.hid, row.srcip, row.domain, row.acctime, row.d, row.h, row.m5) == want, line
    parsed = lines.parse_tolerant(lines_of(*cases), zone="UTC")
    assert {r.line for r in lines.rejects(parsed).collect()} == {"a|b", ""}


def test_strict_parser(lines_of):
    fields = GOOD.split("|")
    kept = [GOOD, "|".join(["x1", *fields[1:]]), "|".join([*fields[:9], "abc"]), GOOD + "|", GOOD + "|||"]
    dropped = ["|".join(fields[:9]), GOOD + "|extra", "|".join([*fields[:9], ""]), ""]
    got = lines.parse_strict(lines_of(*kept, *dropped)).collect()
    assert sorted((r.hid, r.acctime) for r in got) == sorted(
        [("1002", "1705312922"), ("x1", "1705312922"), ("1002", "abc"), ("1002", "1705312922"), ("1002", "1705312922")]
    )
    assert lines.domains_of(lines_of(*kept, *dropped), 9).count() == 2
    assert lines.domains_of(lines_of(" a.com ".join(["|" * 6, "|1|1|1"]))).first()[0] == " a.com "


def test_lateness(spark):
    wanted = {"2021-11-05 14:00:01", "2021-11-05 15:00:00", "2021-11-05 17:30:00"}
    late = {"2021-11-05 14:00:00", "2021-11-05 13:59:59", "-1", "0"}
    df = spark.createDataFrame([(t,) for t in wanted | late], "acctime string")
    assert {r.acctime for r in drop_late(df, "202111051600").collect()} == wanted


def test_parser_computes_shared_parts_once(lines_of):
    plan = ingest_rows(lines_of(GOOD), "202401151100", "b", "UTC")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1


def test_text_paths(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.txt").write_text(GOOD + "\n")
    assert lines.read_lines(spark, f"{tmp_path}/a,{tmp_path}/[bc]/*").count() == 3
    assert lines.read_lines(spark, [f"{tmp_path}/*/f.txt"]).where(F.col("value") == GOOD).count() == 3


def _largest_method(df):
    """Bytes of the largest generated method of all stages; 0 if a stage was not compiled."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    return max(sizes) if min(sizes) > 0 else 0


def test_parsing_and_lateness_are_compiled(spark, lines_of):
    """No stage falls back to the interpreter: generated methods stay within what the JVM compiles."""
    from hitledger.streaming.intake import fit_rows

    batch = ingest_rows(lines_of(GOOD), "202401151100", "b", "UTC")
    files = lines_of(GOOD).withColumns({"file_path": F.lit("file:/in/202401151200/f"), "modified": F.current_timestamp()})
    for frame in (batch, fit_rows(files, "UTC"), fit_rows(files), fit_rows(files, "Asia/Shanghai")):
        assert 0 < _largest_method(frame) < 8000
        assert frame.count() == (1 if frame is batch else frame.count())
