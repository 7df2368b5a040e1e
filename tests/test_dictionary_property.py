"""Random dictionaries: the split-parallel Spark job against a plain
single-pass model of the documented rules."""

import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from starbuild.sources import dictionary as DI

WORD = st.text("abcdefgh", min_size=1, max_size=6)
NAME = st.text("ABCDXYZ", min_size=2, max_size=5)


def _strip(s):
    return re.sub(r"^[ \t]+|[ \t]+$", "", s)


def model(text):
    """Single pass over the lines, following the module's rules."""
    fields, codes, lost = {}, {}, []
    block = None          # (names, parts) of an open multi-line comment
    open_list = ""
    for raw in text.removesuffix("\n").split("\n"):      # the last line break begins no line
        line = _strip(raw)
        is_open = line.startswith("/*")
        is_close = line.endswith("*/") and not (is_open and len(line) < 4)
        body = _strip(re.sub(r"[ \t]*\*/$", "", re.sub(r"^/\*[ \t]*", "", line)))
        if is_open:
            if "-" in body:
                head, lead = body.split("-", 1)
            elif " " in body:
                head, lead = body.split(" ", 1)
            else:
                head, lead = body, ""
            if block is not None:
                lost += block[2]                       # another comment begins first
            block = (head, [_strip(lead)] if _strip(lead) else [], [line])
            if is_close:
                _finish(block, fields)
                block = None
            continue
        if block is not None:
            block[2].append(line)
            if body:
                block[1].append(body)
            if is_close:
                _finish(block, fields)
                block = None
            continue
        if re.match(r"^value\s+\S", line):
            open_list = re.sub(r"l+$", "", re.match(r"^value\s+(\S+)", line).group(1))
            continue
        if line == "":
            open_list = ""
            continue
        if open_list and "=" in line:
            k, v = line.split("=", 1)
            codes[(open_list, re.sub(r"^'+|'+$", "", _strip(k)))] = \
                re.sub(r"^'+|'+$", "", _strip(v))
    if block is not None:
        lost += block[2]
    return fields, codes, sorted(lost)


def _finish(block, fields):
    head, parts, _ = block
    for n in head.split("&"):
        n = _strip(n).lower()
        if n:
            fields[n] = " ".join(parts)


@st.composite
def dictionary_text(draw):
    lines = []
    for _ in range(draw(st.integers(1, 8))):
        kind = draw(st.sampled_from(["one", "multi", "codes", "trap", "open"]))
        names = draw(st.lists(NAME, min_size=1, max_size=2, unique=True))
        head = " & ".join(names)
        words = " ".join(draw(st.lists(WORD, min_size=1, max_size=3)))
        if kind == "one":
            extra = draw(st.sampled_from(["", " - more"]))
            lines.append(f"/* {head} - {words}{extra} */")
        elif kind == "multi":
            lines.append(f"/* {head} - {words}")
            for w in draw(st.lists(WORD, min_size=0, max_size=2)):
                lines.append(f"\t{w}")
            lines.append(f"   {draw(WORD)} */")
        elif kind == "trap":
            lines += [f"/* {head} - {words}", "", "value fakel", "  9 = 'no'", "", "*/"]
        elif kind == "open":
            lines += [f"/* {head} - {words}", "", "value fakel", "  8 = 'no'"]
        else:
            lines.append(f"value {names[0].lower()}l")
            for i in range(draw(st.integers(1, 4))):
                label = draw(st.sampled_from([words, f"{words} = x", f"  {words} "]))
                lines.append(f"{draw(st.sampled_from(['', '  ', chr(9)]))}{i} = '{label}'")
                if draw(st.booleans()):
                    lines += ["/* aside - b", "", "value innerl", "*/"]
            lines.append("")
    return "\n".join(lines) + "\n"


@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=dictionary_text())
def test_spark_job_matches_model(spark, tmp_path_factory, text):
    d = tmp_path_factory.mktemp("dict")
    (d / "d.txt").write_text(text)
    want_f, want_c, want_lost = model(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        lines = DI.read_dictionary_lines(spark, str(d))
        got_f = {r.field: r.description for r in DI.dictionary_fields(lines).collect()}
        got_c = {(r.list_name, r.code): r.label for r in DI.dictionary_codes(lines).collect()}
        got_lost = sorted(r.line for r in DI.unclosed_comment_lines(lines).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got_f == want_f
    assert got_c == want_c
    assert got_lost == want_lost
