"""Content hashes and bytes, content types and data types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pattern that finds a content type in a header, kinds and subtypes in the
# order in which they are tried. Dots and plus signs act as in a regular expression.
CONTENT_TYPE_PATTERN = (
    "(application/|image/|text/)"
    "(json|jpeg|x-citrix-jpeg"
    "|vnd.openxmlformats-officedocument.wordprocessingml.document"
    "|vnd.ms-powerpoint"
    "|vnd.openxmlformats-officedocument.presentationml.presentation"
    "|msword"
    "|pdf|png|x-citrix-png|x-png|x-portable-graymap"
    "|gif|bmp|tiff|svg+xml|svg"
    "|webp|xml"
    "|xhtml+xml|xhtml|html)"
)

# Extension of each content type.
EXTENSIONS = {
    "application/json": ".json",
    "image/jpeg": ".jpeg",
    "image/x-citrix-jpeg": ".jpeg",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/docx": ".docx",
    "application/msword": ".doc",
    "application/doc": ".doc",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/pptx": ".pptx",
    "application/vnd.ms-powerpoint": ".ppt",
    "application/ppt": ".ppt",
    "application/pdf": ".pdf",
    "image/png": ".png",
    "image/x-citrix-png": ".png",
    "image/x-png": ".png",
    "image/x-portable-graymap": ".pgm",
    "image/pgm": ".pgm",
    "image/gif": ".gif",
    "image/bmp": ".bmp",
    "image/tiff": ".tiff",
    "image/svg+xml": ".svg",
    "image/svg": ".svg",
    "image/webp": ".webp",
    "application/xhtml+xml": ".xhtml",
    "application/xhtml": ".xhtml",
    "text/html": ".html",
    "text/xml": ".xml",
    "application/xml": ".xml",
}

# Extensions by their use.
DOCUMENT_EXTENSIONS = [".doc", ".docx", ".ppt", ".pptx", ".pdf"]
IMAGE_EXTENSIONS = [".png", ".pgm", ".jpeg", ".gif", ".bmp", ".tiff", ".svg", ".webp"]
MARKUP_EXTENSIONS = [".xhtml", ".xml", ".html"]

# Fixed value: status of a page whose status is not known.
DEFAULT_STATUS = 204


def mime_extension(content_type: Column) -> Column:
    """Extension named by a Content-Type header; NULL if the type is not known.

    A type the pattern finds and the table lacks gives its subtype.
    """
    found = F.regexp_extract(content_type, CONTENT_TYPE_PATTERN, 0)
    table = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return F.when(found != "", F.coalesce(F.try_element_at(table, found), F.concat(F.lit("."), F.substring_index(found, "/", -1))))


def url_extension(url: Column) -> Column:
    """Extension by the URL's last characters, with or without a dot before them."""
    out = None
    for extension in DOCUMENT_EXTENSIONS:
        ends = url.endswith(extension[1:])
        out = F.when(ends, F.lit(extension)) if out is None else out.when(ends, F.lit(extension))
    return out.otherwise(F.lit(".html"))


def fetch_extension(content_type: Column, url: Column) -> Column:
    """Extension of a fetch: by header; by URL only if there is no header at all."""
    return F.when(content_type.isNull(), url_extension(url)).otherwise(mime_extension(content_type))


def extension_datatype(extension: Column) -> Column:
    """Data type code of an extension."""
    return F.when(extension.isin(MARKUP_EXTENSIONS), F.lit("HTML")).otherwise(F.upper(F.substr(extension, F.lit(2))))


def extension_route(extension: Column) -> Column:
    """``document``, ``website`` or ``skip``."""
    return (
        F.when(extension.isin(DOCUMENT_EXTENSIONS), F.lit("document"))
        .when(extension_datatype(extension) == "HTML", F.lit("website"))
        .otherwise(F.lit("skip"))
    )


def default_status(status: Column) -> Column:
    return F.coalesce(status, F.lit(DEFAULT_STATUS))


def content_hash(text: Column) -> Column:
    """SHA-512 of the UTF-8 text in hex."""
    return F.sha2(F.encode(text, "UTF-8"), 512)


def content_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")
