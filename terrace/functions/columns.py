"""Column helpers for schema-tolerant ingestion and path attributes. All are native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: raw_documents/<department>/<classification>/<file>
DOCUMENT_PATH = r".*/raw_documents/([^/]+)/([^/]+)/[^/]+$"


def col_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column cast to `kind` where df has it, a typed null where it hasn't. Unparsable values become null."""
    has = name.lower() in {c.lower() for c in df.columns}
    return F.col(name).try_cast(kind).alias(name) if has else F.lit(None).cast(kind).alias(name)


def document_attributes(path: Column | str) -> dict[str, Column]:
    """Department, classification, file name and extension of a document's path; '' where the path has another shape."""
    path = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(path, "/"), -1)
    return {
        "department": F.regexp_extract(path, DOCUMENT_PATH, 1),
        "classification": F.regexp_extract(path, DOCUMENT_PATH, 2),
        "file_name": name,
        "file_extension": F.element_at(F.split(name, r"\."), -1),
    }


def utf8_text(content: Column | str) -> Column:
    """Binary content as text; bytes that aren't UTF-8 are replaced, so one bad file doesn't end a stream."""
    return F.make_valid_utf8(F.col(content).cast("string") if isinstance(content, str) else content.cast("string"))
