"""Label-dictionary parser as a Spark text job.

A dictionary file holds field descriptions in C-style comments and code
lists::

    /* VISITYR - 4 digit year of the visit */
    /* HOMECTRY & BIRTHCTRY - Country codes, valid and invalid ones,
       for processing */
    value ctryl
       101 =  'NORTHLAND (sea and air ports only)'
       102 =  'SOUTHLAND'
    <blank line closes the list>

Meaning depends on earlier lines (which comment or list a line is in).
Files are read line by line with Spark's splittable text source, so a
large file is spread over many tasks.  A line's position is
``(file, split, mid)``: the byte offset where its input split starts and a
``monotonically_increasing_id`` taken right after the scan, which grows in
file order inside a split.  The open comment / open list at every line is a
forward fill: inside each split with a window ``partitionBy(file, split)``
(bounded by the split size), across splits by carrying the last event of
the previous splits from a table with one row per split.  No file is ever
gathered into one task.

Rules:

* ``/* A & B - text */`` gives one description per name; names are
  lower-cased; the text is everything after the first dash (later dashes
  stay in the text); with no dash the first word is the name.
* A comment without a closing ``*/`` continues on the following lines
  until a line ending in ``*/``; each line is appended once, separated by
  a space.
* ``value NAMEl`` opens a code list named ``NAME`` (all trailing ``l``
  removed); ``key = label`` lines follow, split on the first ``=`` (so a
  label may contain ``=``), quotes stripped, padding inside the quotes
  kept; an empty line closes the list.
* Inside a comment nothing else has a meaning: a ``value`` line there opens no
  list, and an empty line there closes none.
* A block is closed if the next comment mark after its opening line is a
  closing line.  Lines of a block that is never closed (the file ends, or
  another comment begins first) describe nothing; they are returned one by
  one by ``unclosed_comment_lines`` and never gathered, however many they are.
* Leading/trailing spaces and tabs are ignored.  A name described twice
  keeps its last description; a code listed twice keeps its last label.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")


def read_dictionary_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, split, mid, line)`` for every line of every dictionary file
    (``line`` without surrounding spaces and tabs)."""
    raw = spark.read.text(path)
    return raw.select(F.input_file_name().alias("file"),
                      F.input_file_block_start().alias("split"),
                      F.monotonically_increasing_id().alias("mid"),
                      _strip_ws(F.col("value")).alias("line"))


def forward_fill(lines: DataFrame, events: Mapping[str, tuple[Column, bool]],
                 backward: bool = False) -> DataFrame:
    """For each ``name -> (event, include_current)``, add column ``name``:
    the last non-null ``event`` at (or strictly before, if
    ``include_current`` is false) the line, in file order; with ``backward``
    the next one at or after it.

    Work is split by input split; the carry between splits comes from one
    row per split, so no task sees more than one split of lines.
    """
    def ordered(name: str) -> Column:
        return F.col(name).desc() if backward else F.col(name).asc()

    nearest = F.min_by if backward else F.max_by
    tagged = lines.select("*", *[ev.alias(f"_ev_{n}") for n, (ev, _) in events.items()])
    w = Window.partitionBy("file", "split").orderBy(ordered("mid"))
    local = tagged.select("*", *[
        F.last(f"_ev_{n}", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inc else -1))
        .alias(f"_loc_{n}")
        for n, (_, inc) in events.items()])
    per_split = tagged.groupBy("file", "split").agg(*[
        nearest(f"_ev_{n}", F.when(F.col(f"_ev_{n}").isNotNull(), F.col("mid")))
        .alias(f"_last_{n}") for n in events])
    ws = Window.partitionBy("file").orderBy(ordered("split")).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_split.select("file", "split", *[
        F.last(f"_last_{n}", ignorenulls=True).over(ws).alias(f"_carry_{n}") for n in events])
    joined = local.join(carry, ["file", "split"])
    return joined.select(*lines.columns, *[
        F.coalesce(F.col(f"_loc_{n}"), F.col(f"_carry_{n}")).alias(n) for n in events])


def _comments(lines: DataFrame) -> DataFrame:
    """Add comment state to each line: ``is_open`` (it begins with ``/*``),
    ``block`` (position of the opening line of the comment that the line is
    part of, null outside comments) and ``closed`` (whether that comment is
    ever closed)."""
    line = F.col("line")
    is_open = line.startswith("/*")
    is_close = line.endswith("*/") & ~(is_open & (F.length(line) < 4))
    pos = F.struct(F.col("split"), F.col("mid"))
    none = F.struct(F.lit(-1).cast("long").alias("split"), F.lit(-1).cast("long").alias("mid"))
    mark = F.when(is_open & ~is_close, pos).when(is_close, none)
    kind = F.when(is_open, F.lit(False)).when(is_close, F.lit(True))
    filled = forward_fill(lines, {"open_block": (mark, False)})
    filled = forward_fill(filled, {"next_closes": (kind, False)}, backward=True)
    inside = F.col("open_block").isNotNull() & (F.col("open_block.split") >= 0)
    return filled.select(
        *lines.columns, is_open.alias("is_open"),
        F.when(is_open, pos).when(inside, F.col("open_block")).alias("block"),
        (is_close | F.coalesce("next_closes", F.lit(False))).alias("closed"))


def unclosed_comment_lines(lines: DataFrame) -> DataFrame:
    """``(file, split, mid, line)`` of every line of a comment that is never
    closed, the opening line included."""
    return _comments(lines).where(F.col("block").isNotNull() & ~F.col("closed")).select(*lines.columns)


def dictionary_fields(lines: DataFrame) -> DataFrame:
    """Field descriptions: ``(field, description)``."""
    c = _comments(lines).where(F.col("block").isNotNull() & F.col("closed"))
    body = F.regexp_replace(F.regexp_replace(F.col("line"), r"^/\*[ \t]*", ""), r"[ \t]*\*/$", "")
    parts = c.select("file", "block", "split", "mid", _strip_ws(body).alias("text"))
    # One group per closed comment block: the lines between its two marks.
    blocks = parts.groupBy("file", "block").agg(
        F.sort_array(F.collect_list(F.struct("split", "mid", "text"))).alias("parts"))
    first = F.col("parts")[0]["text"]
    dash = F.instr(first, "-")
    space = F.instr(first, " ")
    head = F.when(dash > 0, F.substring_index(first, "-", 1)) \
            .when(space > 0, F.substring_index(first, " ", 1)).otherwise(first)
    lead = F.when(dash > 0, F.expr("substr(parts[0].text, instr(parts[0].text, '-') + 1)")) \
            .when(space > 0, F.expr("substr(parts[0].text, instr(parts[0].text, ' ') + 1)")) \
            .otherwise(F.lit(""))
    rest = F.transform(F.slice(F.col("parts"), 2, F.greatest(F.size("parts") - 1, F.lit(0))),
                       lambda x: x["text"])
    desc = F.array_join(F.filter(F.concat(F.array(_strip_ws(lead)), rest),
                                 lambda s: s != ""), " ")
    named = blocks.select("file", "block", head.alias("names"), desc.alias("description"))
    fields = named.select(
        "file", "block", "description",
        F.explode(F.split("names", "&")).alias("name")
    ).select(F.lower(_strip_ws(F.col("name"))).alias("field"), "file", "block", "description") \
     .filter(F.col("field") != "")
    return fields.groupBy("field").agg(
        F.max_by("description", F.struct("file", "block")).alias("description"))


def dictionary_codes(lines: DataFrame) -> DataFrame:
    """Code lists: ``(list_name, code, label)``."""
    line = F.col("line")
    is_start = line.rlike(r"^value\s+\S")
    list_name = F.regexp_replace(F.regexp_extract(line, r"^value\s+(\S+)", 1), "l+$", "")
    outside = F.col("block").isNull()
    # a list opens or closes outside comments only ('' marks "closed")
    event = F.when(outside & is_start, list_name).when(outside & (line == ""), F.lit(""))
    c = forward_fill(_comments(lines), {"open_list": (event, True)})
    is_code = (outside & ~is_start & line.contains("=")
               & F.col("open_list").isNotNull() & (F.col("open_list") != ""))
    codes = c.filter(is_code).select(
        F.col("open_list").alias("list_name"),
        F.regexp_replace(_strip_ws(F.substring_index("line", "=", 1)), r"^'+|'+$", "").alias("code"),
        F.regexp_replace(_strip_ws(F.expr("substr(line, instr(line, '=') + 1)")), r"^'+|'+$", "")
        .alias("label"),
        "file", "split", "mid")
    return codes.groupBy("list_name", "code").agg(
        F.max_by("label", F.struct("file", "split", "mid")).alias("label"))
