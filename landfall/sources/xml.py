"""XML row-tag scans: one row per element with the given tag."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.session import work_folder
from landfall.sources.xml_exact import exact_elements

EXACT = "exact"
CORRUPT = "_corrupt_record"
TO_THE_END = 2**31 - 1  # a substring length; counting the characters first would cost a pass over the text


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file of every row, spelled as Spark's file metadata spells it."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("SourceFileName"),
        F.col("_metadata.file_modification_time").alias("SourceFileTime"),
    )


def listed_files(scanned: DataFrame) -> int:
    """How many files a scan found when it was made, with row elements or without."""
    return getattr(scanned, "listed_files", None) or len(scanned.inputFiles())


def read_xml(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    schema: str | None = None,
    *,
    exclude_attributes: bool = True,
    lineage: bool = True,
    splittable: bool | str = False,
    stream: bool = False,
    work: str = "",
    **options: str,
) -> DataFrame:
    """Scan every file below ``path`` for ``row_tag`` elements; child elements become columns.

    ``schema`` is a DDL string. Without one Spark infers it, which reads the data once more, so
    pass it in anything that runs regularly. Declaring ``_corrupt_record string`` in it keeps the
    text of broken elements.

    ``splittable=False`` is Spark's XML source: one task per file, and a broken document loses
    what follows the break. ``splittable=True`` cuts files at the row's end tag, so a single huge
    file is spread over the cluster and only the broken element is lost. It needs a schema, UTF-8
    files and row elements that do not nest, and it reads child names without namespace prefix.
    ``splittable="exact"`` lifts these limits at the price of a second scan and a staged copy of the elements, made
    at the call: it tells row elements from the same letters in comments or CDATA, from inner elements of the same name,
    and reads declared single-byte encodings. It is no stream. The copy is below ``work``, which the caller may remove
    once done; by default it is a new work folder.
    """
    if splittable == EXACT:
        if stream or schema is None:
            raise ValueError("an exact split scan is a batch with an explicit schema")
        elements, listed = exact_elements(spark, path, row_tag, work or work_folder(spark, "xml-elements"), **options)
        parse = {"rowTag": row_tag, "excludeAttribute": str(exclude_attributes).lower(), "ignoreNamespace": "true"}
        parsed = elements.select(F.from_xml("element", schema, parse).alias("parsed"), "SourceFileName", "SourceFileTime")
        found = parsed.select("parsed.*", *(["SourceFileName", "SourceFileTime"] if lineage else []))
        found.listed_files = listed
        return found
    if splittable:
        df = _split_scan(spark, path, row_tag, schema, exclude_attributes, lineage, stream, options)
        return df
    reader = (spark.readStream if stream else spark.read).format("xml")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("rowTag", row_tag).option("excludeAttribute", exclude_attributes).options(**options).load(path)
    return with_lineage(df) if lineage else df


def _split_scan(spark, path, row_tag, schema, exclude_attributes, lineage, stream, options) -> DataFrame:
    if schema is None:
        raise ValueError("a splittable scan needs an explicit schema")
    reader = (spark.readStream if stream else spark.read).format("text").schema("value string")
    text = reader.option("lineSep", f"</{row_tag}>").options(**options).load(path)
    if lineage:
        text = with_lineage(text)
    lineage_columns = [c for c in text.columns if c != "value"]
    parse = {"rowTag": row_tag, "excludeAttribute": str(exclude_attributes).lower(), "ignoreNamespace": "true"}
    tag, end = re.escape(row_tag), F.lit(f"</{row_tag}>")
    element, single = F.col("element"), F.col("single")

    # Text up to an end tag, from its first start tag on (less the "<", so that a search finds the next).
    rest = F.substring("value", F.instr("value", f"<{row_tag}") + 1, F.lit(TO_THE_END))
    # Nearly always that is one element, told by plain substring search. Only text with a second start
    # tag, an empty element (<tag/>) or a longer tag name pays for the regular expressions.
    first = F.substring_index("rest", ">", 1)
    is_single = (
        ~F.contains("rest", F.lit(f"<{row_tag}")) & first.rlike(rf"^{tag}(\s|$)") & ~F.endswith(first, F.lit("/"))
    )
    start = F.concat(F.lit("<"), "rest")
    elements = F.when(single, F.array(start)).otherwise(F.split(start, rf"(?=<{tag}[\s/>])"))
    empty = rf"(?s)^(<{tag}(?:\s[^>]*)?/>).*"
    is_empty = ~single & element.rlike(empty)
    whole = F.when(is_empty, F.regexp_extract(element, empty, 1)).otherwise(F.concat(element, end))
    return (
        text.where(F.contains("value", F.lit(f"<{row_tag}")))
        .select(rest.alias("rest"), *lineage_columns)
        .select("rest", is_single.alias("single"), *lineage_columns)
        .select(F.explode(elements).alias("element"), "single", *lineage_columns)
        .where(single | element.rlike(rf"^<{tag}[\s/>]"))
        .select(F.from_xml(whole, schema, parse).alias("parsed"), *lineage_columns)
        .select("parsed.*", *lineage_columns)
    )
