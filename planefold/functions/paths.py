"""Path arithmetic on string columns ('/' separated)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planefold.constants import ARTIFACT_FOLDER

# One trailing extension; a leading dot is part of the name, as is a final dot.
_EXTENSION = r"(?<=.)\.[^.]+$"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), _EXTENSION, "")


def parent(path: Column) -> Column:
    """Everything before the last '/'; empty for a bare name."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def plane_name(path: Column) -> Column:
    """Name before the last '_' of the stem, a second extension removed.

    A stem without '_' has no plane name: empty string.
    """
    bare = F.regexp_replace(stem(path), _EXTENSION, "")
    return F.when(F.instr(bare, "_") > 0, F.regexp_replace(bare, "_[^_]*$", "")).otherwise(F.lit(""))


def artifact_path(root: Column, folder: Column, artifact: str) -> Column:
    """Where a finished plane keeps one of its artifacts."""
    return join_path(root, folder, F.lit(ARTIFACT_FOLDER), F.lit(f"{artifact}.npy"))
