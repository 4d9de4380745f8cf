"""Object keys: decoding, parts that carry ids, routing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Folder that holds OCR output, position of the ids counted from
# the end of the path, and the output prefix.
OCR_FOLDER = "textract"
TENANT_SEGMENT = -8
STORE_SEGMENT = -6
SESSION_SEGMENT = -4
OUTPUT_PREFIX = "analyze-expense-output/"
STAMP_FORMAT = "yyyy-MM-dd-HH-mm-ss"


def decode_key(key: Column) -> Column:
    """URL-decode, ``+`` is a space; an escape that is none stays as it is."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9a-fA-F]{2})", "%25"))


def decode_uri(uri: Column) -> Column:
    """The path a file URI stands for: escapes decoded, ``+`` kept, a stray ``%`` kept."""
    kept = F.regexp_replace(F.replace(uri, F.lit("+"), F.lit("%2B")), "%(?![0-9a-fA-F]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), uri)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """Last segment up to its first dot."""
    return F.substring_index(basename(path), ".", 1)


def segment(path: Column, position: int) -> Column:
    """Path segment counted from the end; NULL when the path is too short."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def path_ids(path: Column) -> dict[str, Column]:
    return {
        "tenant_id": segment(path, TENANT_SEGMENT),
        "store_id": segment(path, STORE_SEGMENT),
        "session_id": segment(path, SESSION_SEGMENT),
    }


def is_receipt_key(path: Column, folder: str = OCR_FOLDER) -> Column:
    """A ``.json`` object directly inside an OCR-output folder."""
    inside = F.coalesce(F.lower(segment(path, -2)) == folder, F.lit(False))
    return path.endswith(".json") & inside


def document_kind(key: Column) -> Column:
    return F.when(F.lower(key).endswith(".pdf"), "pdf").otherwise("image")


def extracted_key(key: Column, created: Column) -> Column:
    stamp = F.date_format(created, STAMP_FORMAT)
    return F.concat(F.lit(OUTPUT_PREFIX), file_stem(key), F.lit("-"), stamp, F.lit("-extracted.json"))


def combined_key(key: Column) -> Column:
    return F.concat(F.lit(OUTPUT_PREFIX), key, F.lit("-combined.json"))
