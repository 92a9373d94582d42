"""Source A: a pipe-delimited text export in which a record may be broken over several lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from idloom.session import cut

SOURCE_ID = 1
UNIT_ID = 1
MIN_FIELDS = 10
FIELDS = ["hisnumber", "lastname", "name", "surname", "birthdate", "documenttypes", "series", "number",
          "email", "telephone", "login_email"]
#: lines handled as one array; a record spans at most MIN_FIELDS of them
CHUNK = 2048
#: lines numbered as one window
_BLOCK = 1 << 18
# The characters counted as white space around lines and fields.
WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
         "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _strip(x):
    return F.btrim(x, F.lit(WHITE))


def scan_source_a_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of all files below ``path`` as (file, line_no, line), numbered from 0 in file order.

    A file split is read front to back by one task, so the running id orders its lines. The lines
    are staged once: their splits depend on the cores at hand, and the numbering reads them twice.
    """
    raw = cut(spark.read.option("lineSep", "\n").text(path)
              .filter(_strip(F.col("value")) != "")
              .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line")))
    splits = raw.groupBy("file", "split").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return raw.join(starts, ["file", "split"]).select(
        "file", (F.col("pos") - F.col("first") + F.col("skip")).alias("line_no"), "line")


def number_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and renumber the rest from 0 without gaps.

    Lines are counted in blocks of a fixed range of numbers; only the counts of the blocks are
    summed up in order, and each block numbers its own lines.
    """
    kept = lines.filter(_strip(F.col("line")) != "").select(
        "file", "line_no", "line", F.floor(F.col("line_no") / _BLOCK).alias("block"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("file", "block").agg(F.count("*").alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("file", "block").orderBy("line_no")
    return kept.withColumn("rn", F.row_number().over(inside)).join(starts, ["file", "block"]).select(
        "file", (F.col("skip") + F.col("rn") - 1).alias("line_no"), "line")


def parse_source_a(lines: DataFrame, delimiter: str = "|", min_fields: int = MIN_FIELDS,
                   numbered: bool = False) -> DataFrame:
    """Assemble records from lines (line_no, line[, file]); out: (file, line_no, fields).

    Blank lines are skipped. A line whose first field is ``<digits>/...`` starts a record. Fields of
    the following lines are appended until there are at least ``min_fields``, which completes the
    record; a record that is still shorter when the next one starts is dropped.

    All a line needs to know about its predecessors is how many fields are pending, 0 to
    ``min_fields - 1``. So the lines are cut into chunks, each with the first lines of the next one,
    and a chunk works out for every number of fields pending at its entry how many it leaves. A
    start line makes the answer independent of the entry, so nearly every chunk knows its entry
    from its neighbour alone, and no task ever holds more than one chunk of text.

    ``numbered`` tells that the line numbers are free of blank lines and gaps already.
    """
    if "file" not in lines.columns:
        lines = lines.withColumn("file", F.lit(""))
    if not numbered:
        lines = number_lines(lines)
    fields = F.split(_strip(F.col("line")), "\\Q" + delimiter + "\\E")
    starts = _strip(F.get(fields, F.lit(0))).rlike("^[0-9]+/")
    chunk = F.floor(F.col("line_no") / CHUNK)
    shared = F.col("line_no") % CHUNK < min_fields - 1
    spans = lines.select(
        "file", F.struct("line_no", starts.alias("s"), fields.alias("f")).alias("l"),
        F.explode(F.when(shared, F.array(chunk, chunk - 1)).otherwise(F.array(chunk))).alias("chunk"))
    chunks = cut(spans.groupBy("file", "chunk").agg(F.array_sort(F.collect_list("l")).alias("ls")))
    own = chunks.select("file", "chunk", F.transform(F.filter(
        "ls", lambda x: F.floor(x["line_no"] / CHUNK) == F.col("chunk")),
        lambda x: F.struct(x["s"].alias("s"), F.size(x["f"]).alias("n"))).alias("own"))
    ends = cut(own.filter(F.size("own") > 0).select("file", "chunk", _exits("own", min_fields).alias("exits")))
    entered = chunks.join(_entries(ends), ["file", "chunk"], "left")
    return entered.select(
        "file", "chunk", F.explode(_records(F.col("ls"), F.coalesce("entry", F.lit(0)), min_fields)).alias("r")
    ).select("file", F.col("r.line_no").alias("line_no"), F.col("r.fields").alias("fields"))


def _exits(own, min_fields: int):
    """Fields pending behind a chunk, by the number pending at its entry.

    Only the lines from the last one on that settles the matter (a start, or a line that completes
    any record) have to be followed.
    """
    settled = F.array_max(F.transform(own, lambda x, i: F.when(
        x["s"] | (x["n"] >= min_fields), i + 1).otherwise(F.lit(1))))

    def step(acc, x):
        return F.transform(F.transform(acc, lambda a: F.when(x["s"], x["n"]).otherwise(a + x["n"])),
                           lambda n: F.when(n >= min_fields, F.lit(0)).otherwise(n))

    tail = F.slice(own, settled, F.size(own))
    return F.aggregate(tail, F.sequence(F.lit(0), F.lit(min_fields - 1)), step)


def _entries(ends: DataFrame) -> DataFrame:
    """Fields pending at the entry of each chunk that follows another one: (file, chunk, entry).

    Chunks without any settling line are composed with what stands before them by doubling: after k rounds
    a chunk's exits tell the way through 2^k chunks. A run of n of them takes log2 n rounds and no row grows with it.
    """
    fixed = F.array_min("exits") == F.array_max("exits")
    known = ends.filter(fixed).select(
        "file", (F.col("chunk") + 1).alias("chunk"), F.element_at("exits", 1).alias("entry"))
    open_ = ends.filter(~fixed).withColumn("begin", F.col("chunk"))
    while True:
        before = open_.select("file", (F.col("chunk") + 1).alias("begin"), F.col("exits").alias("_exits"), F.col("begin").alias("_begin"))
        met = open_.join(before, ["file", "begin"], "left")
        if met.filter(F.col("_begin").isNotNull()).isEmpty():
            break
        # first the way of the earlier chunks, then one's own
        both = F.transform("_exits", lambda x: F.element_at("exits", x + 1))
        open_ = cut(met.select("file", "chunk", F.coalesce(both, "exits").alias("exits"), F.coalesce("_begin", "begin").alias("begin")))
    walked = open_.join(known.withColumnRenamed("chunk", "begin"), ["file", "begin"], "left").select(
        "file", (F.col("chunk") + 1).alias("chunk"), F.element_at("exits", F.coalesce("entry", F.lit(0)) + 1).alias("entry"))
    return known.unionByName(walked)


def _records(ls, entry, min_fields: int):
    """Records that begin in a chunk, given the fields pending at its entry.

    ``open`` is the position of the first line of the pending record, 0 if there is none, and -1
    while the pending record began in the chunk before, which has the lines to complete it.
    """
    def walk(acc, x):
        i = acc["i"] + 1
        start = F.when(x["s"] | (acc["n"] == 0), i).otherwise(acc["open"])
        n = F.when(x["s"], F.size(x["f"])).otherwise(acc["n"] + F.size(x["f"]))
        full = n >= min_fields
        found = F.array(F.struct(start.alias("b"), i.alias("e")))
        return F.struct(i.alias("i"), F.when(full, 0).otherwise(n).alias("n"),
                        F.when(full, 0).otherwise(start).alias("open"),
                        F.when(full & (start > 0), F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(
        F.lit(0).alias("i"), entry.alias("n"), F.when(entry > 0, -1).otherwise(0).alias("open"),
        F.lit([]).cast("array<struct<b:int,e:int>>").alias("out"))
    spans = F.aggregate(ls, zero, walk, lambda acc: acc["out"])
    mine = F.filter(spans, lambda s: F.floor(F.element_at(ls, s["b"])["line_no"] / CHUNK) == F.col("chunk"))
    return F.transform(mine, lambda s: F.struct(
        F.element_at(ls, s["b"])["line_no"].alias("line_no"),
        F.flatten(F.transform(F.slice(ls, s["b"], s["e"] - s["b"] + 1), lambda x: x["f"])).alias("fields")))


def build_source_a_record(fields: DataFrame) -> DataFrame:
    """Field list to named, trimmed columns; short lists and empty ids are dropped. Other columns pass."""
    def field(i: int):
        return _strip(F.coalesce(F.get("fields", F.lit(i)), F.lit("")))
    return (fields.filter(F.size("fields") >= MIN_FIELDS)
            .select(*[field(i).alias(name) for i, name in enumerate(FIELDS)],
                    F.lit(SOURCE_ID).alias("source"), F.lit(UNIT_ID).alias("businessunit"),
                    *[c for c in fields.columns if c != "fields"])
            .filter(F.col("hisnumber") != ""))


def unprocessed_a(records: DataFrame, processed: DataFrame, n: int | None = None) -> DataFrame:
    """Records whose id is not in the processed set; with ``n`` the first ones by id."""
    out = records.join(processed.select("hisnumber"), "hisnumber", "left_anti").select(*records.columns)
    return out if n is None else out.orderBy("hisnumber").limit(n)


def last_by_id(records: DataFrame) -> DataFrame:
    """The last record of each id in file order (an export may repeat an id)."""
    w = Window.partitionBy("hisnumber").orderBy(F.col("file").desc(), F.col("line_no").desc())
    return records.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def changed_a(records: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Records that are new or whose content differs from the stored (hisnumber, fingerprint)."""
    now = records.withColumn("fingerprint", F.xxhash64(*records.columns))
    old = fingerprints.select("hisnumber", F.col("fingerprint").alias("_old"))
    return now.join(old, "hisnumber", "left").filter(
        ~F.col("fingerprint").eqNullSafe(F.col("_old"))).select(*records.columns, "fingerprint")


def delta_summary_a(records: DataFrame, processed: DataFrame, n: int) -> DataFrame:
    """Size of the next batch of at most ``n`` and of all unprocessed records."""
    return unprocessed_a(records, processed).agg(F.count("*").alias("total_unprocessed")).select(
        F.least("total_unprocessed", F.lit(n).cast("long")).alias("batch"), "total_unprocessed")
