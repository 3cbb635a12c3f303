"""Scalar functions on names, paths and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def episode_of_name(stem: Column) -> Column:
    """Episode number in a name such as episode_000012_7; null where it has none."""
    return F.try_element_at(F.split(stem, "_"), F.lit(2)).try_cast("bigint")


def episode_name(episode: Column) -> Column:
    """episode_000012."""
    return F.format_string("episode_%06d", episode)


def chunk_of(episode: Column, size: int = 1000) -> Column:
    """Number of the chunk folder of an episode."""
    return F.floor(episode / size).cast("bigint")


def parent(path: Column) -> Column:
    """The path without its last part; '' for a bare name."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.substring_index(path, "/", -1)


def stem_of(path: Column) -> Column:
    """The last part without its last ending."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def scene_root(path: Column) -> Column:
    """The folder that holds data, meta or videos (S18); '' where there is none."""
    return F.regexp_extract(path, r"^(.*?)/(?:data|meta|videos)/", 1)


def file_safe(name: Column) -> Column:
    """The name with all but letters, digits, '-' and '_' replaced by '_' (X04)."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def scene_prefix(name: Column) -> Column:
    """What stands before the first '-' or '_' (X05)."""
    return F.regexp_extract(name, r"^([^-_]*)", 1)


def last_number(name: Column) -> Column:
    """The last group of digits in a name; null where there is none."""
    return F.try_element_at(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1)).try_cast("bigint")


def quota(text: str) -> int | None:
    """A number of episodes from the command line: 'inf', 'all' and 'none' are no limit (None), negative numbers are 0."""
    t = text.strip().lower()
    if t in ("inf", "infinity", "all", "none", "-"):
        return None
    return max(0, int(float(t)))


def take(values: Column, places: Column) -> Column:
    """The elements at the places, from 0; null where there is none."""
    return F.transform(places, lambda i: F.get(values, i))


def masked(values: Column, mask: Column) -> Column:
    """The elements whose mask is true; the mask may be shorter."""
    return F.filter(values, lambda v, i: F.coalesce(F.get(mask, i), F.lit(False)))


def plain_json(vector: Column) -> Column:
    """JSON text of a vector of numbers; NaN and infinities, which JSON lacks, are null."""
    finite = F.transform(vector, lambda v: F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v))
    return F.to_json(finite)


def with_default(m: Column, key: Column, default: str) -> Column:
    """The value of a map's key, or a default."""
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def base64_line(data: Column) -> Column:
    """Base64 without line breaks."""
    return F.translate(F.base64(data), "\r\n", "")
