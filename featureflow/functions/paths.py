"""Path and name columns, all native (Catalyst) expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the id pattern of the original label files, ``.../<digits>.jpg``.
IMAGE_ID_PATTERN = r"/(\d+)\.jpg$"

# extension = last dot segment of the base name, unless every character
# before that dot is a dot itself (".hidden" has no extension)
_EXT_PATTERN = r"^\.*[^.].*(\.[^.]*)$"


def image_id(path: Column, pattern: str = IMAGE_ID_PATTERN, to: str = "bigint") -> Column:
    """Numeric id captured by ``pattern`` group 1; no match or a bad number -> NULL."""
    return F.regexp_extract(path, pattern, 1).try_cast(to)


def normalized_name(name: Column) -> Column:
    """Person name as a folder name: every space becomes ``_``."""
    return F.translate(name, " ", "_")


def strip_scheme(path: Column) -> Column:
    """``file:/a/b``, ``file:///a/b`` -> ``/a/b``; other paths unchanged."""
    return F.regexp_replace(path, r"^file:(//)?", "")


def parent_folder(path: Column) -> Column:
    """Second-to-last ``/`` segment; NULL when the path has no ``/``."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def base_name(path: Column) -> Column:
    """Text after the last ``/`` (the whole path when there is none)."""
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """``.ext`` of a base name, '' when there is none (``splitext`` rules)."""
    return F.regexp_extract(name, _EXT_PATTERN, 1)


def stem(name: Column) -> Column:
    """Base name without its extension."""
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(name)))


def joined_path(*parts: Column) -> Column:
    """Parts joined by ``/`` (NULL parts are skipped)."""
    return F.concat_ws("/", *parts)


def image_path(root: str, person: Column, image_id_col: Column, ext: str = ".jpg") -> Column:
    """``<root>/<person>/<id><ext>``."""
    return joined_path(F.lit(root.rstrip("/")), person, F.concat(image_id_col.cast("string"), F.lit(ext)))


def is_visible_file(name: Column, extensions: Sequence[str]) -> Column:
    """Base name does not start with a dot and ends with one of ``extensions``."""
    ok_ext = F.lit(False)
    for e in extensions:
        ok_ext = ok_ext | name.endswith(e)
    return ~name.startswith(".") & ok_ext
