"""Ticket pages landed as JSON files, one page per file.

A schema names the fields that are read. Without one, the fields are those that the documents have: all documents are scanned once for the
merged schema of their values, nested ones too; a field whose values are of kinds that do not merge becomes a variant.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = (
    "tickets array<struct<id:bigint,status:string,subject:string,type:string,requester_id:bigint,assignee_id:bigint,"
    "tags:array<string>,custom_fields:array<struct<id:bigint,value:string>>>>, links struct<next:string>"
)


def read_ticket_pages(
    spark: SparkSession,
    folder: str,
    max_pages: int | None = None,
    page_number: str = r"(\d+)\.json$",
    schema: str = PAGE_SCHEMA,
) -> DataFrame:
    """One row per ticket, with its page number and position. All pages are read unless the caller sets a limit.

    ``page_number`` finds the number, counted from 1, in the file path; a file without one has page null, and is
    left out where a limit is set.
    """
    path = F.col("_metadata.file_path")
    pages = spark.read.schema(schema).option("multiLine", True).json(folder)
    numbered = pages.withColumn("page", F.regexp_extract(path, page_number, 1).try_cast("int"))
    if max_pages is not None:
        numbered = numbered.filter(F.col("page") <= max_pages)
    return exploded(numbered, "page")


def found_schema(documents: DataFrame, text: str) -> T.StructType | None:
    """The merged schema of all JSON objects in a text column; None if there is none. Runs a job."""
    value = F.try_parse_json(F.col(f"`{text}`"))
    whole = documents.select(value.alias("v")).filter(F.try_variant_get("v", "$", "map<string,variant>").isNotNull())
    told = whole.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not told.startswith("OBJECT<"):
        return None
    # A field that is null everywhere has no kind; text holds it.
    kinds = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bVOID\b")
    ddl = kinds.sub(lambda m: {"OBJECT<": "STRUCT<", "VOID": "STRING"}.get(m[0], m[0]), told)
    return documents.sparkSession.sql(f"select from_json('', '{_quoted(ddl)}') as d").schema["d"].dataType


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def parse_pages(documents: DataFrame, text: str, page: str, schema: str | T.StructType | None = PAGE_SCHEMA) -> DataFrame:
    """The same from page documents held as JSON text in a column; text that is not such a document has no tickets.

    ``schema`` None: all fields that the documents have, see ``found_schema``.
    """
    if schema is None:
        schema = found_schema(documents, text)
        tickets = schema["tickets"].dataType if schema is not None and "tickets" in schema.names else None
        if not (isinstance(tickets, T.ArrayType) and isinstance(tickets.elementType, T.StructType)):
            schema = PAGE_SCHEMA
    return exploded(documents.select(F.col(page).alias("page"), F.from_json(text, schema).alias("__doc")).select("page", "__doc.*"), "page")


def exploded(pages: DataFrame, page: str) -> DataFrame:
    return pages.select(page, F.posexplode("tickets").alias("position", "ticket")).select(page, "position", "ticket.*")
