"""Names, ids, hashes and tolerant values as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _squeezed(text: Column, keep: str, strip: str = "_") -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, f"[^{keep}]", "_"), "_+", "_"), F.lit(strip))


def clean_observation_id(text: Column) -> Column:
    """Cut at the first point, other signs as single underscores, ``unknown`` where nothing is left."""
    return F.coalesce(F.nullif(_squeezed(F.split_part(F.trim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit("."), F.lit(1)), "a-zA-Z0-9_"), F.lit("")), F.lit("unknown"))


def stem(path: Column) -> Column:
    """The file's name without folders and its last extension."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def base_filename(path: Column, epoch: Column) -> Column:
    fallback = F.concat(F.lit("epoch_"), epoch.cast("string"))
    return F.coalesce(F.nullif(_squeezed(stem(F.coalesce(F.nullif(path, F.lit("")), fallback)), r"a-zA-Z0-9_\-"), F.lit("")), fallback)


def observation_id(meta_ids: list[Column], path: Column) -> Column:
    """The first id that the header has, else the word after obs, obsid or field in the file's name, else its stem."""
    name = stem(path)
    word = F.nullif(F.regexp_extract(name, r"(?i)(?:^|_)(?:obs|obsid|field)_([^_]*)", 1), F.lit(""))
    return clean_observation_id(F.coalesce(*meta_ids, word, name))


def campaign_id(own: list[Column], sibling: list[Column], path: Column, meta_ids: list[Column] | None = None) -> Column:
    """The name of an exposure's target, which holds for a whole campaign: OBJECT or TARGET (``own``), else the science
    sibling's, else the general observation id."""
    safe = lambda v: F.nullif(F.trim(F.regexp_replace(v, "[^a-zA-Z0-9_]", "_"), F.lit("_")), F.lit(""))
    return F.coalesce(safe(F.coalesce(*[F.nullif(v, F.lit("")) for v in own])), safe(F.coalesce(*[F.nullif(v, F.lit("")) for v in sibling])), observation_id(meta_ids or [], path))


def candidate_id(text: Column) -> Column:
    """Safe for file names: up to 50 characters, with a digest where that is needed."""
    safe = _squeezed(text, r"a-zA-Z0-9_\-.", "_.")
    named = F.when(safe == "", F.concat(F.lit("cand_"), F.substring(F.md5(text), 1, 5))).otherwise(safe)
    return F.when(F.char_length(named) > 50, F.concat(F.substring(named, 1, 44), F.lit("_"), F.substring(F.md5(named), 1, 5))).otherwise(named)


def position_id(ra: Column, dec: Column, prefix: str = "transient", digits: int = 3) -> Column:
    """An id from half-even rounded coordinates, written as integers of the last digit so that no engine's formatting shows."""
    scale = 10**digits
    return F.concat_ws("_", F.lit(prefix), F.bround(ra * scale).cast("long").cast("string"), F.bround(dec * scale).cast("long").cast("string"))


def exposure_from_name(name: Column) -> Column:
    """Seconds named in a file's name; the patterns in order of trust."""
    patterns = (r"(\d+)s[^ec]", r"exp(\d+)", r"(\d+)sec", r"_(\d+)_")
    return F.coalesce(*[F.nullif(F.regexp_extract(name, p, 1), F.lit("")) for p in patterns]).try_cast("double")


def date_from_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(\d{8})-", 1), F.lit(""))


def grid_key(values: list[tuple[Column, float]], *parts: Column) -> Column:
    """md5 of parts and of values snapped half-even to their grids."""
    snapped = [F.bround(v / F.lit(g)).cast("long").cast("string") for v, g in values]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], *snapped))


def json_value(text: Column) -> Column:
    """A number where the text is a finite one; null for NaN, infinities, 'nan', 'none' and empty texts."""
    number = text.try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)
