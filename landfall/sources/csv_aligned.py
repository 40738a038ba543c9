"""CSV parts whose headers differ: each part's columns are found by its own header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MISSING, EXTRA = "missing_columns", "extra_columns"
LINE, REASON, FILE = "line", "reject_reason", "SourceFileName"
UNREADABLE, TOO_MANY, TOO_FEW, NOT_OF_TYPE = "unreadable", "too_many_values", "too_few_values", "not_of_type"
#: Files whose headers may be broadcast; beyond, lines are joined to them by a shuffle.
BROADCAST_FILES = 200_000
QUOTED = '"(?:[^"]|"")*"'
BYTE_ORDER_MARK = "^﻿"


def lines_of(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    meta = F.col("_metadata")
    text = spark.read.options(**options).schema("value string").text(path)
    return text.select(meta["file_path"].alias(FILE), meta["file_block_start"].alias("block"), F.regexp_replace("value", BYTE_ORDER_MARK, "").alias(LINE))


def values_in(line: Column, separator: str) -> Column:
    """How many values a line has: separators within quotes do not count. Null if a quote is not closed."""
    bare = F.regexp_replace(line, QUOTED, "")
    return F.when(~bare.contains('"'), F.size(F.split(bare, f"\\Q{separator}\\E", -1)))


def headers(lines: DataFrame, separator: str) -> DataFrame:
    """``(SourceFileName, header, names)``: the first line of each part and the column names in it, in lower case."""
    first = lines.filter("block = 0").withColumn("row", F.monotonically_increasing_id()).groupBy(FILE).agg(F.min_by(LINE, "row").alias("header"))
    name = lambda n: F.lower(F.trim(F.regexp_replace(F.trim(n), '^"|"$', "")))
    return first.select(FILE, "header", F.transform(F.split("header", f"\\Q{separator}\\E", -1), name).alias("names"))


def read_aligned(
    spark: SparkSession, path: str | list[str], schema: str, separator: str = ",", broadcast_files: int = BROADCAST_FILES, **options: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, rejects, parts)`` of CSV parts in which columns may stand in any order, lack, or be more.

    ``rows`` has the columns of ``schema`` (a DDL string), matched by name without regard to case, null where a part lacks one, and the
    source file. ``rejects`` has lines with more or fewer values than their part's header, with a quote that is not closed, or
    with a value that is not of its declared type: file, reason, line. ``parts`` tells per file which declared columns its header
    lacks and which others it has.

    One scan finds the headers, one reads all parts, whatever their layouts: a line is parsed by position, and each column taken
    from where its part's header has it. Values may be quoted, with doubled quotes inside, and hold separators; a line
    is a record. An empty value is null. Blank lines are passed over, and the header line, if it comes again. Files without a
    line are in none of the three. A header that repeats a name raises ``ValueError``.
    """
    declared = T._parse_datatype_string(schema)
    if not isinstance(declared, T.StructType):
        raise ValueError("the schema is a list of columns")
    wanted = {f.name.lower(): f for f in declared.fields}
    lines = lines_of(spark, path, **options)
    found = headers(lines, separator)
    twice = F.size(F.array_distinct("names")) < F.size("names")
    widest, files, repeated = found.agg(F.max(F.size("names")), F.count("*"), F.min(F.when(twice, F.col(FILE)))).first()
    if repeated:
        raise ValueError(f"the header of {repeated} repeats a column")
    known = F.array(*[F.lit(n) for n in wanted])
    spelled = F.create_map(*[F.lit(x) for n, f in wanted.items() for x in (n, f.name)])
    lacking = F.transform(F.array_except(known, "names"), lambda n: F.element_at(spelled, n))
    parts = found.select(FILE, lacking.alias(MISSING), F.array_except("names", known).alias(EXTRA))

    own = found.select(F.col(FILE).alias("_file"), "header", "names")
    read = lines.join(F.broadcast(own) if files <= broadcast_files else own, F.col(FILE) == F.col("_file"))
    read = read.filter((F.col(LINE) != F.col("header")) & (F.length(F.trim(F.col(LINE))) > 0))
    positions = ", ".join(f"c{i} string" for i in range(widest or 1))
    cells = F.from_csv(LINE, positions, {"sep": separator, "quote": '"', "escape": '"'})
    parsed = read.select(FILE, LINE, "names", values_in(F.col(LINE), separator).alias("values"), cells.alias("cells"))
    row = F.array(*[F.col(f"cells.c{i}") for i in range(widest or 1)])
    parsed = parsed.select(FILE, LINE, "names", "values", row.alias("row"))
    value = {n: F.get("row", F.nullif(F.array_position("names", n), F.lit(0)).cast("int") - 1) for n in wanted}
    cast = {n: value[n].try_cast(f.dataType) for n, f in wanted.items()}
    odd = F.lit(False)
    for n in wanted:
        odd = odd | (value[n].isNotNull() & cast[n].isNull())
    expected = F.size("names")
    reason = (
        F.when(F.col("values").isNull(), UNREADABLE)
        .when(F.col("values") > expected, TOO_MANY)
        .when(F.col("values") < expected, TOO_FEW)
        .when(odd, NOT_OF_TYPE)
    )
    judged = parsed.select(FILE, LINE, reason.alias(REASON), *[cast[n].alias(f.name) for n, f in wanted.items()])
    rows = judged.filter(F.col(REASON).isNull()).select(*[f.name for f in declared.fields], FILE)
    return rows, judged.filter(F.col(REASON).isNotNull()).select(FILE, REASON, LINE), parts
