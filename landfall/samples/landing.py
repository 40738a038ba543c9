"""Landing folders made from the given tables, in the shape an XML endpoint delivers.

Everything is written by Spark tasks without a shuffle: each task turns its share of the records
into documents, so no group of records is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from landfall.plans.loads import FIELDS, PAYLOAD, ROW_TAG
from landfall.sinks.cleanup import open_store, path_in_store, session_store_options

HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<env:Envelope xmlns:env="http://e" xmlns:ns1="urn:x" '
    'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><env:Body>\n'
)
FOOT = "</env:Body></env:Envelope>\n"


def write_landing(
    records: DataFrame, folder: str, prefix: str = "erp", per_payload: int = 50, per_file: int = 25_000
) -> int:
    """Write ``record`` (JSON text) into files ``<prefix>_<share>_<date_token>_<hour_token>.xml``.

    Without an ``hour_token`` the name ends after the date. Returns the number of files.
    A retried task writes the same names with the same content. A task gathers the records of a pair of tokens over its
    batches, so files are few and full; it holds ``10 * per_file`` records at most, and then writes out the longest list.
    """
    s3 = session_store_options(records.sparkSession)
    tokens = [c for c in ("date_token", "hour_token") if c in records.columns]

    def document(payloads: list[list[str]]) -> str:
        rows = (
            f'<{ROW_TAG}><status xsi:type="xsd:int">1</status><{PAYLOAD} xsi:type="xsd:string">'
            f"{escape('[' + ','.join(p) + ']')}</{PAYLOAD}></{ROW_TAG}>\n"
            for p in payloads
        )
        return HEAD + "".join(rows) + FOOT

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = urlsplit(folder)
        store, root = open_store(parts.scheme, parts.netloc, s3), path_in_store(folder)
        store.create_dir(root, recursive=True)
        share, files, held = TaskContext.get().partitionId(), 0, {}

        def put(key: tuple[str, ...], texts: list[str]) -> None:
            nonlocal files
            payloads = [texts[i : i + per_payload] for i in range(0, len(texts), per_payload)]
            name = "_".join([prefix, f"{share:05d}-{files:05d}", *key])
            with store.open_output_stream(f"{root}/{name}.xml") as out:
                out.write(document(payloads).encode())
            files += 1

        for batch in batches:
            for key, group in batch.groupby(tokens):
                texts = held.setdefault(key, [])
                texts += group["record"].tolist()
                while len(texts) >= per_file:
                    put(key, texts[:per_file])
                    del texts[:per_file]
            while sum(map(len, held.values())) > 10 * per_file:
                longest = max(held, key=lambda k: len(held[k]))
                put(longest, held.pop(longest))
        for key, texts in held.items():
            if texts:
                put(key, texts)
        yield pd.DataFrame({"files": [files]})

    return records.mapInPandas(write, "files long").agg(F.sum("files")).first()[0]


def write_elements(elements: DataFrame, folder: str, name: str = "elements", per_file: int = 100_000) -> int:
    """Write ``element`` (XML text) into documents of up to ``per_file`` elements; returns the number of files."""
    s3 = session_store_options(elements.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = urlsplit(folder)
        store, root = open_store(parts.scheme, parts.netloc, s3), path_in_store(folder)
        store.create_dir(root, recursive=True)
        share, files, held = TaskContext.get().partitionId(), 0, []

        def put(texts: list[str]) -> None:
            with store.open_output_stream(f"{root}/{name}_{share:05d}_{files:05d}.xml") as out:
                out.write((HEAD + "\n".join(texts) + FOOT).encode())

        for batch in batches:
            held += batch["element"].tolist()
            while len(held) >= per_file:
                put(held[:per_file])
                held, files = held[per_file:], files + 1
        if held:
            put(held)
            files += 1
        yield pd.DataFrame({"files": [files]})

    return elements.mapInPandas(write, "files long").agg(F.sum("files")).first()[0]


def load_records(lineitem: DataFrame, all_fields: bool = False) -> DataFrame:
    """Line items in the layout of truck loads, as JSON text with (year, "10") as file tokens.

    ``all_fields`` gives the fields that have no counterpart a value too.
    """
    known = {
        "t10_id": F.col("l_orderkey"),
        "t10_data_grava": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "t10_destino": F.concat(F.lit("São & <"), "l_suppkey", F.lit(">")),
        "t06_placa": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        "t10_situacao": F.col("l_linestatus"),
        "t06_id": F.col("l_partkey"),
        "qtd_entregas": F.col("l_linenumber"),
        "peso_entregas": F.col("l_quantity"),
        "valor_entregas": F.col("l_extendedprice"),
        "clientes": F.array(F.struct(F.col("l_suppkey").alias("id"))),
    }
    filler = F.concat(F.lit("value "), "l_orderkey") if all_fields else None
    columns = [known.get(f, filler).alias(f) for f in FIELDS if f in known or all_fields]
    return lineitem.select(
        F.to_json(F.struct(*columns)).alias("record"),
        F.date_format("l_shipdate", "yyyy").alias("date_token"),
        F.lit("10").alias("hour_token"),
        "l_returnflag",
    )
