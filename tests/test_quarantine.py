"""Accepted rows plus rejected lines are the lines read."""
import csv
import datetime as dt
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from starbuild.sources import quarantine as q

KINDS = {"id": "bigint", "n_items": "int", "price": "decimal(8,2)", "day": "date:MMddyyyy", "since": "epoch_day", "name": "string"}


def check(spark, tmp_path, texts, sep=",", required=("id",)):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_bytes(text.encode())
    return q.write_checked(q.read_checked(spark, str(folder), KINDS, required, sep), str(tmp_path / "out"))


def test_split(spark, tmp_path):
    good = ["1,2,3.50,01312020,21915,ann", '2,2.0,4,02292020,21915.0,"x, y"', "3,,,,,", "4,5,6.00, 01312020 , 21915 ,é"]
    bad = {"5,x,3.5,01312020,21915,a": [("n_items", "x", "not a int")],
           "6,1,3.5,02302020,abc,a": [("day", "02302020", "not a date:MMddyyyy"), ("since", "abc", "not a epoch_day")],
           ",1,3.5,01312020,21915,a": [("id", None, "required value is missing")],
           "x9,1,3.5,01312020,21915,a": [("id", "x9", "not a bigint")],
           "7,1,99999999.5,01312020,21915,a": [("price", "99999999.5", "not a decimal(8,2)")],
           "8,1,3.5,01312020,21915": [(None, None, "not 6 fields")],
           "9,1,3.5,01312020,21915,a,b": [(None, None, "not 6 fields")], "junk": [(None, None, "not 6 fields")]}
    head = "ID,N Items,price,Day,since,NAME"
    found = check(spark, tmp_path, ["\n".join([head, *good[:2], "", *bad]), "\r\n".join([head, *good[2:], "   ", head]) + "\r\n"])
    assert (found.lines, found.rejects) == (len(good) + len(bad), len(bad))
    rows = sorted(map(tuple, found.accepted(spark).collect()))
    day, since = dt.date(2020, 1, 31), dt.date(2020, 1, 1)
    assert [(r[0], r[1], None if r[2] is None else float(r[2]), *r[3:]) for r in rows] == [
        (1, 2, 3.5, day, since, "ann"), (2, 2, 4.0, dt.date(2020, 2, 29), since, "x, y"), (3, None, None, None, None, None),
        (4, 5, 6.0, day, since, "é")]
    lines = {r.line: ([tuple(f) for f in r.failed], r.file) for r in found.rejected(spark).collect()}
    assert {k: v for k, (v, _) in lines.items()} == bad and all(f.endswith("/0.csv") for _, f in lines.values())
    reasons = {(r.column, r.reason): r.lines for r in q.failures_by_reason(found.rejected(spark)).collect()}
    assert reasons[None, "not 6 fields"] == 3 and reasons["id", "required value is missing"] == 1


def test_nothing_to_read_and_nothing_good(spark, tmp_path):
    found = check(spark, tmp_path, ["id,n_items,price,day,since,name\n", "\n\n"])
    assert (found.lines, found.rejects) == (0, 0) and found.accepted(spark).count() == found.rejected(spark).count() == 0
    (tmp_path / "b").mkdir()
    found = check(spark, tmp_path / "b", ["x\ny\n"])
    assert (found.lines, found.rejects) == (2, 2) and found.accepted(spark).count() == 0


def test_each_line_is_parsed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    lines = spark.createDataFrame([("f", f"{i},1,x,,,n") for i in range(100)], "file string, line string")
    found = q.write_checked(q.checked_lines(lines.mapInArrow(count, lines.schema), KINDS), str(tmp_path / "out"))
    assert (found.lines, found.rejects, seen.value) == (100, 100, 100)
    assert found.rejected(spark).count() == 100 and seen.value == 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["1", "2.5", "x", "", "a,b", 'say "hi"', "01312020", "-7"]), min_size=4, max_size=8), max_size=25))
def test_counts_add_up(spark, rows):
    """Any lines: the two parts are the lines, each with its own text."""
    texts = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, doublequote=False, escapechar="\\", lineterminator="").writerow(r)
        texts.append(out.getvalue())
    lines = spark.createDataFrame([("f", t) for t in texts], "file string, line string")
    checked = q.checked_lines(lines, KINDS).collect()
    assert sorted(r._line for r in checked) == sorted(texts)
    for r in checked:
        fields = next(csv.reader([r._line], doublequote=False, escapechar="\\"))
        assert (len(fields) != 6) == ([f.reason for f in r._failed] == ["not 6 fields"])
        if len(fields) == 6:
            assert ("n_items" in {f.column for f in r._failed}) == (fields[1] not in ("1", "2.5", "", "01312020", "-7"))
