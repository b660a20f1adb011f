"""Expressions over object paths: provenance columns and clean file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder and file patterns of the source layout.
PARTICIPANT = r"/(Participant_[^/]+)/"
FOLDER = r"/Participant_[^/]+/([^/]+)/"
CSV_NAME = r"(?i)/([^/]+\.csv)$"
CSV_SUFFIX = r"(?i)\.csv$"
UNCLEAN = r"[^A-Za-z0-9._-]"
CLEAN_EDGES = "._ "


def scanned_file() -> Column:
    """Decoded path of the file a row was read from.

    The metadata column is a percent-encoded URI; a literal plus sign is not
    encoded there, so it is protected from the form-style decoder.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def participant_id(path: Column) -> Column:
    return F.regexp_extract(path, PARTICIPANT, 1)


def source_folder(path: Column) -> Column:
    return F.regexp_extract(path, FOLDER, 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, CSV_NAME, 1)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, CSV_SUFFIX, "")


def provenance(path: Column, folder: str | None = None) -> dict[str, Column]:
    """The provenance columns derived from `path`.

    `folder` replaces the folder found in the path by a constant.
    """
    name = file_name(path)
    raw = source_folder(path) if folder is None else F.lit(folder)
    return {
        "source_file": path,
        "participant_id": participant_id(path),
        "source_type_raw": raw,
        "source_type": F.lower(raw),
        "file_name": name,
        "file_stem": file_stem(name),
    }


def directory(key: Column) -> Column:
    """Everything before the last slash, without the slash; '' when there is none."""
    return F.regexp_extract(key, r"^(.*)/[^/]*$", 1)


def base_name(key: Column) -> Column:
    return F.regexp_extract(key, r"([^/]*)$", 1)


def stem_of(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def extension_of(name: Column) -> Column:
    """Last dot-suffix including the dot, or ''."""
    return F.regexp_extract(name, r"(\.[^.]+)$", 1)


def sanitize(text: Column) -> Column:
    """Safe characters only, single underscores, no leading or trailing `._ `."""
    safe = F.regexp_replace(text, UNCLEAN, "_")
    return F.trim(F.regexp_replace(safe, "_+", "_"), F.lit(CLEAN_EDGES))


def sanitize_file_name(name: Column) -> Column:
    """`sanitize` on the stem; the extension keeps its dot and an empty stem is named."""
    stem = sanitize(stem_of(name))
    ext = F.regexp_replace(extension_of(name), UNCLEAN, "_")
    return F.concat(F.when(stem == "", F.lit("unnamed")).otherwise(stem), ext)
