"""Raw order batch files: ``orders_<YYYYmmddTHHMMSSZ>_<seq>.csv``.

One read path for folders and streams, ``usable_records``: ``text`` source + metadata
columns; every line keeps its verbatim text as ``raw_line`` and gets its file position
from the block it was read from and its index in the task (``pos``), so no per-file sort is
needed.  Unusable files are put aside with a reason.  Files with a quoted field spanning
lines go through the exact reader: it finds each line's CSV quote state with regexes and
running sums over the split blocks of a file, then groups lines into records.  It is
still splittable and JVM-side, so a file of any size is spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import batch_key_of, batch_time_of
from ..options import FIELD_LIMIT, RAW_COLUMNS
from ..session import ensure_checkpoint_dir

HEADER = ",".join(RAW_COLUMNS)
RAW_GLOB = "orders_*.csv"
_LOW_BITS = (1 << 33) - 1


def file_position(block_start: Column) -> Column:
    """Order-preserving row key within a file: ``(block KB) << 33 | row index in the task``.

    Blocks of a file start at multiples of its split size, so the block part is distinct
    per block for splits of 1 KB or more and files up to 1 TB; within a block, rows keep
    their read order.
    """
    idx = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))
    return F.shiftleft(F.shiftright(block_start, 10), 33).bitwiseOR(idx)


def with_lineage(lines: DataFrame) -> DataFrame:
    """text rows (``value`` + ``_metadata``) -> batch, batch_time, file, pos, raw_line (not on a streaming DF)."""
    name = F.col("_metadata.file_name")
    key = batch_key_of(name)
    return lines.select(
        key.alias("batch"), batch_time_of(key).alias("batch_time"), name.alias("file"),
        file_position(F.col("_metadata.file_block_start")).alias("pos"),
        F.regexp_replace(F.col("value"), "\r$", "").alias("raw_line"))


def split_header(rows: DataFrame, expected: str = HEADER) -> tuple[DataFrame, DataFrame]:
    """SRC-02: the first line of each file is its header; a file whose header differs is skipped whole.

    Returns ``(data rows of good files, file status)``.  The per-file aggregate is
    one row per file and is joined back on the file name.
    """
    first = rows.groupBy("file", "batch", "batch_time").agg(
        F.min_by("raw_line", "pos").alias("header"), F.min("pos").alias("_hpos"))
    status = first.select("file", "batch", "batch_time",
                          F.when(F.col("batch") == "", F.lit("bad file name"))
                          .when(F.col("batch_time").isNull(), F.lit("impossible batch stamp"))
                          .when(F.col("header") != F.lit(expected), F.lit("unexpected header"))
                          .alias("skip_reason"), "_hpos")
    good = status.where(F.col("skip_reason").isNull()).select("file", "_hpos")
    data = rows.join(good, "file", "inner").where(F.col("pos") > F.col("_hpos")).drop("_hpos")
    return data, status.drop("_hpos")


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a raw folder split on ``\\n`` only (a ``\\r`` before it stays), with their file metadata."""
    return spark.read.option("pathGlobFilter", RAW_GLOB).option("lineSep", "\n").text(path).select("value", "_metadata")


def list_raw_files(spark: SparkSession, path: str) -> DataFrame:
    """path, file, batch of every raw file, from the file index that Spark makes for any scan (it alone shows empty files)."""
    paths = spark.read.option("pathGlobFilter", RAW_GLOB).text(path).inputFiles()
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.select(_same_path(F.col("path")).alias("path"), name.alias("file"), batch_key_of(name).alias("batch"))


def read_raw_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-01..06 batch read of a raw folder: (records of usable files, per-file status)."""
    return usable_records(raw_lines(spark, path), list_raw_files(spark, path))


def raw_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """ST-01 source: new raw files as they appear (hidden ``.``/``_`` files are ignored by Spark)."""
    reader = spark.readStream.format("text").option("pathGlobFilter", RAW_GLOB).option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("value", "_metadata")


def may_span(line: Column) -> Column:
    """Whether a line, read from a record's start, ends inside a quoted field."""
    return (F.instr(line, '"') > 0) & line.rlike(_ENDS_OPEN_FROM_START)


def text_faults(size: Column, n_bytes: Column, n_lines: Column, utf8: Column, nul: Column) -> tuple[Column, Column]:
    """(the file begins with a BOM, reason why its text cannot be read), from sums over its lines."""
    bom = size - n_bytes - n_lines >= 2
    return bom, F.when(~utf8, F.lit("not UTF-8 text")).when(nul, F.lit("malformed CSV (NUL byte)"))


def _same_path(path: Column) -> Column:
    """Local paths are written ``file:/x`` in metadata and ``file:///x`` in listings."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def placed_lines(lines: DataFrame) -> DataFrame:
    """path, file, size, block, pos, line.  Positions are taken before anything else moves the rows."""
    m = F.col("_metadata")
    return lines.select(_same_path(m["file_path"]).alias("path"), m["file_name"].alias("file"), m["file_size"].alias("size"),
                        m["file_block_start"].alias("block"), file_position(m["file_block_start"]).alias("pos"), F.col("value").alias("line"))


def _without_cr(line: Column) -> Column:
    return F.regexp_replace(line, "\r$", "")


def file_status(placed: DataFrame, listing: DataFrame | None = None, expected: str = HEADER) -> DataFrame:
    """SRC-02/03: path, file, batch, batch_time, skip_reason, multiline, first_pos of each file; never an error.

    One partial aggregate per file over its split lines, so no file is read by one
    task: the text source keeps invalid bytes and NULs as they are, and its first
    line (by ``pos``) is the header.  It drops a leading UTF-8 BOM, whose 3 bytes
    then show up as missing from the file length: length - line bytes - line
    count (one ``\\n`` each) is 0, or -1 without a final newline, when there is no BOM.
    ``multiline``: some record may span lines (a line ends inside quotes when read from a
    record's start, as the first line of such a record does).  Files of ``listing`` without a line are empty.
    """
    line = F.col("line")
    long_line = F.length(line) > FIELD_LIMIT
    lengths = F.transform(csv_fields(line), F.length)
    per = placed.groupBy("path", "file").agg(
        F.min_by("line", "pos").alias("_first"), F.min("pos").alias("first_pos"), F.max("size").alias("_size"),
        F.sum(F.octet_length(line)).alias("_bytes"), F.count(F.lit(1)).alias("_lines"),
        F.bool_and(F.is_valid_utf8(line)).alias("_utf8"), F.bool_or(F.instr("line", "\u0000") > 0).alias("_nul"),
        F.bool_or(may_span(line)).alias("multiline"),
        F.max(F.when(long_line, F.array_max(lengths))).alias("_longest"))
    if listing is not None:
        empty = listing.join(per.select("path"), "path", "left_anti").select("path", "file", F.lit(0).cast("long").alias("_size"))
        per = per.unionByName(empty, allowMissingColumns=True)
    key = batch_key_of(F.col("file"))
    bom, fault = text_faults(F.col("_size"), F.col("_bytes"), F.col("_lines"), F.col("_utf8"), F.col("_nul"))
    reason = (F.when(key == "", F.lit("bad file name"))
              .when(batch_time_of(key).isNull(), F.lit("impossible batch stamp"))
              .when(F.col("_size") == 0, F.lit("empty file"))
              .when(bom, F.lit("unexpected header"))
              .when(fault.isNotNull(), fault)
              .when(_without_cr(F.col("_first")) != F.lit(expected), F.lit("unexpected header"))
              .when(F.col("_longest") > FIELD_LIMIT, F.lit(TOO_LONG)))
    return per.select("path", "file", key.alias("batch"), batch_time_of(key).alias("batch_time"), reason.alias("skip_reason"),
                      F.coalesce("multiline", F.lit(False)).alias("multiline"), "first_pos")


def file_quarantine(spark: SparkSession, path: str, expected: str = HEADER) -> DataFrame:
    """SRC-03: file, batch and the reason why a file of a raw folder cannot be used (null: it can)."""
    status = usable_records(raw_lines(spark, path), list_raw_files(spark, path), expected)[1]
    return status.select("file", "batch", F.col("skip_reason").alias("reason"))


def usable_records(lines: DataFrame, listing: DataFrame | None = None, expected: str = HEADER) -> tuple[DataFrame, DataFrame]:
    """The one read path of raw files, for a folder's lines as well as a stream's micro-batch: (records, file status).

    Records: batch, batch_time, file, pos, raw_line of usable files.  Status: file, batch, batch_time, skip_reason.
    Files are judged by ``file_status``.  A usable file without a record over several lines gives its lines as they
    are, without a shuffle of data; the others go through ``record_keys``.  There the length of a quoted field that stays
    open is summed line by line (``open_field_lengths``), so a file with an endless record is refused before the
    lines of any record are put together.  ``listing`` (path, file, batch) limits the files and adds empty ones.
    """
    placed = placed_lines(lines)
    if listing is not None:
        placed = placed.join(listing.select("path"), "path", "left_semi")
    records, status = records_of(placed, file_status(placed, listing, expected), ["file", "batch", "batch_time"])
    return records.select("batch", "batch_time", "file", "pos", "raw_line"), status.select("file", "batch", "batch_time", "skip_reason")


def records_of(placed: DataFrame, status: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """The records (path, pos, raw_line and the status columns ``carry``) of files without a ``skip_reason``, and the final status."""
    ensure_checkpoint_dir(placed.sparkSession)
    status = status.checkpoint()  # one row per file, asked for by several branches
    usable = status.where(F.col("skip_reason").isNull())
    lines = placed.select("path", "block", "pos", "line")
    plain = lines.join(usable.where("NOT multiline").select("path", "first_pos", *carry), "path").where(F.col("pos") > F.col("first_pos"))
    records = plain.select("path", "pos", _without_cr(F.col("line")).alias("raw_line"), *carry)
    spanning = usable.where("multiline")
    if not spanning.isEmpty():
        k = record_keys(lines.join(spanning.select("path"), "path", "left_semi").select(F.col("path").alias("file"), "block", "pos", "line"))
        longest = open_field_lengths(k).groupBy(F.col("file").alias("path")).agg(F.max("length").alias("longest"))
        endless = longest.where(F.col("longest") > FIELD_LIMIT).select("path", F.lit(TOO_LONG).alias("_why")).checkpoint()
        status = status.join(endless, "path", "left").withColumn("skip_reason", F.coalesce("skip_reason", "_why")).drop("_why")
        fine = spanning.join(endless, "path", "left_anti").select("path", "first_pos", *carry)
        body = k.drop("block").withColumnRenamed("file", "path").join(fine, "path").where(F.col("rec") != F.col("first_pos"))
        records = records.unionByName(_joined_records(body, ["path", *carry]))
    return records, status


# Quote state of CSV lines (the ``csv`` module's reading of ``"``; strict=False, doubled quotes).
# A quote opens a quoted field only at the start of a field; inside one, ``""`` is a
# literal quote and a lone ``"`` closes it; after that, text up to the next comma is plain.
_QUOTED = '"(?:[^"]|"")*+"[^,]*'
_FIELD = f'(?:{_QUOTED}|[^",][^,]*|)'
_OPEN = '"(?:[^"]|"")*+'
# ends inside a quoted field when read from a record start / when read from inside a quoted field
_ENDS_OPEN_FROM_START = f"^(?:{_FIELD},)*{_OPEN}$"
_ENDS_OPEN_FROM_INSIDE = f'^(?:[^"]|"")*+(?:"[^,]*,(?:{_FIELD},)*{_OPEN})?$'
# the part of a line that belongs to a field left open at its end, read from a record start / from inside a quoted field
_OPENED_FROM_START = f'^(?:{_FIELD},)*"((?:[^"]|"")*+)$'
_OPENED_FROM_INSIDE = f'^(?:[^"]|"")*+"[^,]*,(?:{_FIELD},)*"((?:[^"]|"")*+)$'
_ALL_INSIDE = '^(?:[^"]|"")*+$'
_CLOSED = '^((?:[^"]|"")*+)"[^,]*'
TOO_LONG = f"malformed CSV (field larger than field limit ({FIELD_LIMIT}))"


def _unquoted_length(text: Column) -> Column:
    """Characters of the inside of quotes: a doubled quote is one."""
    return F.length(text) - F.length(F.regexp_replace(text, '[^"]', "")) / 2


def csv_fields(line: Column) -> Column:
    """The fields of a CSV record as an array, unquoted as the ``csv`` module does, for any number of fields."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_FIELD})"), F.lit(1))
    inside = lambda f: F.replace(F.regexp_extract(f, '^"((?:[^"]|"")*+)"', 1), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda f: F.when(f.startswith('"'), F.concat(inside(f), F.regexp_replace(f, '^"(?:[^"]|"")*+"', ""))).otherwise(f))


def open_field_lengths(keyed: DataFrame) -> DataFrame:
    """file, field (place of the line that opens it), length of every quoted field that spans lines.

    Each line gives the part of the open field that it continues, and of the one it leaves open.  Which line opened
    the field is a running maximum inside a split block, carried over blocks by one row each; parts
    are then added per field, which is a partial aggregate: a field over any number of lines is a number in every task.
    """
    line, continues = F.col("line"), F.col("rec") != F.col("pos")
    through = continues & line.rlike(_ALL_INSIDE)
    opens = F.when(continues, ~through & line.rlike(_ENDS_OPEN_FROM_INSIDE)).otherwise((F.instr("line", '"') > 0) & line.rlike(_ENDS_OPEN_FROM_START))
    m = keyed.select("file", "block", "pos", "line", continues.alias("_cont"), through.alias("_thru"), opens.alias("_opens"))
    m = m.where("_cont OR _opens")
    opened = F.max(F.when(F.col("_opens"), F.col("pos")))
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = m.groupBy("file", "block").agg(opened.alias("_last")).select("file", "block", F.max("_last").over(earlier).alias("_carry"))
    m = m.withColumn("_from", opened.over(inside)).join(carry, ["file", "block"])
    goes_on = F.when(F.col("_thru"), _unquoted_length(line) + 1).otherwise(_unquoted_length(F.regexp_extract(line, _CLOSED, 1)))
    left_open = _unquoted_length(F.when(F.col("_cont"), F.regexp_extract(line, _OPENED_FROM_INSIDE, 1)).otherwise(F.regexp_extract(line, _OPENED_FROM_START, 1))) + 1
    parts = F.array(F.struct(F.when(F.col("_cont"), F.coalesce("_from", "_carry")).alias("field"), goes_on.alias("part")),
                    F.struct(F.when(F.col("_opens"), F.col("pos")).alias("field"), left_open.alias("part")))
    return m.select("file", F.explode(parts).alias("p")).where(F.col("p.field").isNotNull()).groupBy("file", F.col("p.field").alias("field")).agg(
        F.sum("p.part").cast("long").alias("length"))


def _joined_records(body: DataFrame, keep: list[str]) -> DataFrame:
    """Lines with ``rec`` put together to records: ``keep``, pos, raw_line (verbatim); a blank line is no record."""
    lines = F.array_sort(F.collect_list(F.struct("pos", "line")))
    text = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    recs = body.groupBy(*keep, F.col("rec").alias("pos")).agg(
        F.regexp_replace(text, "[\r\n]+$", "").alias("raw_line"), F.count(F.lit(1)).alias("_n"))
    return recs.where((F.col("_n") > 1) | (F.col("raw_line") != "")).drop("_n")


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines split on ``\\n`` only, so a ``\\r`` before it stays on the line (exact rejoining)."""
    lines = spark.read.option("pathGlobFilter", RAW_GLOB).option("lineSep", "\n").text(path)
    # only what both branches of ``record_keys`` need, so their shuffles are one reused exchange
    return lines.select(F.col("_metadata.file_name").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        file_position(F.col("_metadata.file_block_start")).alias("pos"),
                        F.col("value").alias("line"))


def _parity(c: Column) -> Column:
    return F.pmod(c, F.lit(2)).cast("int")


def record_keys(lines: DataFrame) -> DataFrame:
    """Adds ``rec``: the ``pos`` of the first line of the CSV record each line belongs to,
    and ``first_line``: the file's first line (``pos``, ``line``, ``open`` = it ends inside quotes).

    Each line maps the quote state at its start (0 = at a record start, 1 = inside a
    quoted field) to the state at its end; a line without ``"`` keeps it, others are
    classified by two regexes.  A map on two states is the identity, a swap or a
    constant, so the state before a line is the value of the last constant line
    before it, flipped once per swap line in between.  That is a running sum and a
    running "last" -- computed per (file, split block) in parallel, then carried
    across a file's blocks through one row per block.  No file is read by one task,
    and no Python runs.
    """
    has_q = F.instr("line", '"') > 0
    e0 = has_q & F.col("line").rlike(_ENDS_OPEN_FROM_START)
    e1 = ~has_q | F.col("line").rlike(_ENDS_OPEN_FROM_INSIDE)
    m = lines.select("*", e0.cast("int").alias("_e0"), e1.cast("int").alias("_e1"))
    m = m.select("*", ((F.col("_e0") == 1) & (F.col("_e1") == 0)).cast("int").alias("_swap"),
                 (F.col("_e0") == F.col("_e1")).alias("_const"))
    w = Window.partitionBy("file", "block").orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("_sw", F.sum("_swap").over(upto))                  # swaps up to and incl. the line
    last_const = F.last(F.when(F.col("_const"), F.struct(F.col("_e0").alias("v"), F.col("_sw").alias("sw"))),
                        ignorenulls=True)
    m = m.select("*", last_const.over(before).alias("_lc"), (F.col("_sw") - F.col("_swap")).alias("_swb"))
    # state at the line's start, for block entry state 0 and 1
    from_const = F.col("_lc.v").bitwiseXOR(_parity(F.col("_swb") - F.col("_lc.sw")))
    for h in (0, 1):
        m = m.withColumn(f"_s{h}", F.when(F.col("_lc").isNotNull(), from_const)
                         .otherwise(F.lit(h).bitwiseXOR(_parity(F.col("_swb")))))
    m = m.select("*", *[F.max(F.when(F.col(f"_s{h}") == 0, F.col("pos"))).over(upto).alias(f"_rk{h}")
                        for h in (0, 1)])
    # one row per (file, block): the block's own map and its last record start per entry state
    blk = m.groupBy("file", "block").agg(
        _parity(F.sum("_swap")).alias("_p"),
        F.max_by(F.struct(F.col("_e0").alias("v"), F.col("_sw").alias("sw")),
                 F.when(F.col("_const"), F.col("pos"))).alias("_blc"),
        F.max("_sw").alias("_tsw"), F.max("_rk0").alias("_ls0"), F.max("_rk1").alias("_ls1"),
        F.min_by(F.struct("pos", "line", F.col("_e0").alias("open")), F.col("pos")).alias("_fl"))
    # the block's map: constant (value after its last constant line and the swaps after it) or a swap parity
    blk = blk.select("file", "block", "_ls0", "_ls1", "_fl", F.col("_blc").isNotNull().alias("_bconst"),
                     F.col("_blc.v").bitwiseXOR(_parity(F.col("_tsw") - F.col("_blc.sw"))).alias("_bv"),
                     F.when(F.col("_blc").isNull(), F.col("_p")).otherwise(F.lit(0)).alias("_q"))
    wb = Window.partitionBy("file").orderBy("block")
    bbefore = wb.rowsBetween(Window.unboundedPreceding, -1)
    bupto = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blk = blk.withColumn("_qc", F.sum("_q").over(bupto))
    blast = F.last(F.when(F.col("_bconst"), F.struct(F.col("_bv").alias("v"), F.col("_qc").alias("qc"))),
                   ignorenulls=True).over(bbefore)
    qb = F.col("_qc") - F.col("_q")
    blk = blk.select("*", blast.alias("_bl"))
    blk = blk.withColumn("_in", F.when(F.col("_bl").isNotNull(),
                                       F.col("_bl.v").bitwiseXOR(_parity(qb - F.col("_bl.qc"))))
                         .otherwise(_parity(qb)))
    blk = blk.withColumn("_ls", F.when(F.col("_in") == 0, F.col("_ls0")).otherwise(F.col("_ls1")))
    blk = blk.select("file", "block", "_in", F.max("_ls").over(bbefore).alias("_carry"),
                     F.first("_fl").over(bupto).alias("first_line"))
    # one row per split block of the input: bounded by input size / split size, left to AQE to place
    j = m.join(blk, ["file", "block"])
    rec = F.coalesce(F.when(F.col("_in") == 0, F.col("_rk0")).otherwise(F.col("_rk1")), F.col("_carry"))
    return j.select(*lines.columns, rec.alias("rec"), "first_line")


def needs_exact_reader(spark: SparkSession, path: str) -> DataFrame:
    """Per file: does any CSV record span lines (a quoted field holding a newline)?"""
    k = record_keys(_text_lines(spark, path))
    return k.groupBy("file").agg(F.max((F.col("rec") != F.col("pos")).cast("int")).cast("boolean").alias("multiline"))


def read_exact(spark: SparkSession, path: str, expected: str = HEADER) -> DataFrame:
    """A.2 exact reader: records with embedded newlines keep their verbatim text; blank lines skipped.

    Lines are grouped into records by ``record_keys`` (splittable: a file of any
    size is spread over the tasks of its split blocks); a record's lines are
    re-joined with the ``\\n`` they were split on, so its text is the file's bytes.
    The file's first line is its header, checked as in ``split_header`` (a header
    record spanning lines never matches); it comes with every line from the
    per-block table, so the lines are scanned once.
    """
    k = record_keys(_text_lines(spark, path))
    hdr = F.col("first_line")
    key = batch_key_of(F.col("file"))
    good_file = ((key != "") & batch_time_of(key).isNotNull() & (hdr["open"] == 0)
                 & (F.regexp_replace(hdr["line"], "\r$", "") == F.lit(expected)))
    body = k.where(good_file & (F.col("rec") != hdr["pos"])).select("*", key.alias("batch"), batch_time_of(key).alias("batch_time"))
    return _joined_records(body, ["file", "batch", "batch_time"]).select("file", "batch", "pos", "raw_line", "batch_time")
