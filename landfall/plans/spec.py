"""What to load: one endpoint described as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from landfall.functions.payload import string_record


@dataclass(frozen=True)
class LoadSpec:
    """One endpoint's landing folder, its record layout, and where its bronze tables go.

    Bronze gets a file per scan task, so its write is as parallel as its read; ``files`` asks for that
    many instead, whatever the batch's size. ``date_format`` is the pattern of the date token in file
    names, by which the latest file of a batch is found; without it dates compare as text.
    ``fingerprints`` keeps a ledger of loaded content beside the target: a file that brings the content of another, renamed
    or sent again, loads no row, and is cleaned like a loaded one.
    ``salvage`` keeps the records before the break of a malformed payload, and sets aside only the rest.
    ``splittable`` is that of ``read_xml``: a huge file is spread over tasks by ``"exact"``.
    ``read_options`` go to the scan and the listing: ``pathGlobFilter``, ``recursiveFileLookup``, ...
    """

    landing: str
    row_tag: str
    payload: str
    fields: tuple[str, ...]
    entity: str
    source_name: str
    target: str
    keep: tuple[str, ...] = ()
    rejects: str = ""
    fmt: str = "parquet"
    mode: str = "overwrite"
    compression: str = "snappy"
    files: int | None = None
    splittable: bool | str = False
    salvage: bool = False
    fingerprints: bool = False
    date_format: str | None = None
    read_options: Mapping[str, str] = field(default_factory=dict)

    @property
    def record(self) -> T.StructType:
        """The fields to parse: the kept ones only, or all of them."""
        return string_record(self.keep or self.fields)

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keep or self.fields

    @property
    def bronze_schema(self) -> T.StructType:
        """The bronze table's columns; declared on reading back, as not every format keeps them."""
        schema = string_record([*self.columns, "SourceFileName", "NumRows", "ProcessedDate"])
        return schema.add("ProcessedTime", T.TimestampType()).add("SourceName", T.StringType())

    @property
    def rejects_path(self) -> str:
        return self.rejects or f"{self.target.rstrip('/')}_rejects"

    @property
    def ledger_path(self) -> str:
        """Names the proven files while a clean-up deletes them."""
        return f"{self.target.rstrip('/')}_cleaning"

    @property
    def fingerprints_path(self) -> str:
        """What has been loaded, by content."""
        return f"{self.target.rstrip('/')}_fingerprints"

    def but(self, **changes) -> LoadSpec:
        return replace(self, **changes)
