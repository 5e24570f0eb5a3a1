import hashlib
import random

from pyspark.sql import functions as F

from hitledger.llm.warc import FAN_OUT, audit, laid_out, response_record


def frames(spark, rows, schema="archive long, n long, record string"):
    return laid_out(spark.createDataFrame(rows, schema), "n")


def root_of(records):
    level = [hashlib.sha256((r or "").encode()).hexdigest() if r is not None else "" for r in records]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + FAN_OUT]).encode()).hexdigest() for i in range(0, len(level), FAN_OUT)]
    return level[0]


def by_brute_force(first, second):
    """Lists of records by archive."""
    out = set()
    for archive in {*first, *second}:
        a, b = first.get(archive, []), second.get(archive, [])
        for at in range(max(len(a), len(b))):
            if at >= len(b):
                out.add((archive, at, "missing"))
            elif at >= len(a):
                out.add((archive, at, "extra"))
            elif a[at] != b[at]:
                out.add((archive, at, "changed"))
    return out


def test_finds_every_difference(spark):
    rng = random.Random(4)
    first = {a: [f"record {a} {i}" for i in range(n)] for a, n in ((1, 1), (2, 15), (3, 16), (4, 17), (5, 300), (6, 257), (7, 4), (None, 20))}
    second = {a: list(r) for a, r in first.items()}
    for a in (2, 5, 6, None):
        for _ in range(3):
            second[a][rng.randrange(len(second[a]))] = "rot"
    second[4] = second[4][:-3]
    second[3] += ["more"] * 40
    del second[7]
    second[8] = ["new"]
    sides = [frames(spark, [(a, i, r) for a, own in side.items() for i, r in enumerate(own)]) for side in (first, second)]
    got = audit(*sides).collect()
    assert {(r.archive, r.place, r.status) for r in got if r.level == "record"} == by_brute_force(first, second)
    roots = {r.archive: r for r in got if r.level == "archive"}
    assert roots.keys() == {*first, *second} and roots[1].status == "same" and roots[7].status == "missing" and roots[8].status == "extra"
    assert roots[5].first_sha256 == root_of(first[5]) and roots[5].second_sha256 == root_of(second[5])
    assert roots[5].end == sum(len(r) for r in first[5])


def test_edges(spark):
    rows = [(1, 5, None), (1, 5, None), (1, 6, ""), (None, None, "x" * 300_000), (2, 0, "é")]
    assert {r.status for r in audit(frames(spark, rows), frames(spark, rows)).collect()} == {"same"}
    other = [*rows[:3], (None, None, "x" * 299_999 + "y"), rows[4]]
    got = audit(frames(spark, rows), frames(spark, other)).collect()
    assert [(r.archive, r.place, r.start, r.end) for r in got if r.level == "record"] == [(None, 0, 0, 300_000)]
    assert audit(frames(spark, []), frames(spark, [])).collect() == []
    assert {r.status for r in audit(frames(spark, rows), frames(spark, [])).collect()} == {"missing"}


def test_extra_columns_and_record_form(spark):
    docs = spark.createDataFrame([(1, 1, "http://x", "é", "p", 7)], "archive long, n long, url string, html string, place string, start int")
    made = docs.withColumn("record", response_record(F.col("url"), F.col("html")))
    record = made.first().record
    assert record == "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x\r\nContent-Length: 2\r\n\r\né\r\n\r\n"
    place = laid_out(made, "n").first()
    assert (place.place, place.start, place.end) == (0, 0, len(record.encode()))
    assert place.sha256 == hashlib.sha256(record.encode()).hexdigest()


def test_longest_archives_on_both_sides_of_a_power(spark):
    for cut in (250, 10):
        first = {1: [f"record 1 {i}" for i in range(300)], 2: [f"record 2 {i}" for i in range(20)], 3: ["one"]}
        second = {**first, 1: first[1][:cut]}
        sides = [frames(spark, [(a, i, r) for a, own in side.items() for i, r in enumerate(own)]) for side in (first, second)]
        for pair, status in ((sides, "missing"), (sides[::-1], "extra")):
            got = audit(*pair).collect()
            assert {r.archive: r.status for r in got if r.level == "archive"} == {1: "changed", 2: "same", 3: "same"}
            assert {(r.archive, r.place, r.status) for r in got if r.level == "record"} == {(1, i, status) for i in range(cut, 300)}
