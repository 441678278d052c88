"""Column functions on names, paths, tags and dynamic metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names whose underscores are part of a drawing.
KAOMOJI = (
    "0_0", "(o)_(o)", "+_+", "+_-", "._.", "<o>_<o>", "<|>_<|>", "=_=", ">_<", "3_3", "6_9", ">_o", "@_@", "^_^", "o_o", "u_u", "x_x", "|_|", "||_||",
)
#: Tags that say nothing about the picture.
DULL_TAGS = ("no humans", "monochrome", "greyscale")


def with_default(values: Column, key: str, default: str = "") -> Column:
    """A map's value; ``default`` where the key is missing, null where it is present and null."""
    return F.when(F.map_contains_key(values, key), F.element_at(values, F.lit(key))).otherwise(F.lit(default))


def tag_name(name: Column) -> Column:
    return F.when(name.isin(*KAOMOJI), name).otherwise(F.replace(name, F.lit("_"), F.lit(" ")))


def escape_parens(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("("), F.lit("\\(")), F.lit(")"), F.lit("\\)"))


def prompt_tags(tags: Column, most: int = 5) -> Column:
    """The first tags of a comma-separated list that describe the picture."""
    parts = F.split(tags, ",")
    useful = F.filter(parts, lambda t: ~F.trim(t).isin(*DULL_TAGS) & ~t.contains("media") & ~t.contains("medium"))
    return F.slice(F.transform(useful, lambda t: F.trim(t)), 1, most)


def extended_prompt(prompt: Column, tags: Column) -> Column:
    added = F.array_join(prompt_tags(tags), ", ")
    return F.when(added != "", F.concat(prompt, F.lit(", "), added)).otherwise(prompt)


def zero_padded(number: Column, width: int = 8) -> Column:
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def strip_suffix(text: Column, suffix: str) -> Column:
    """The text without ``suffix`` at its end."""
    return F.when(text.endswith(suffix), F.left(text, F.length(text) - len(suffix))).otherwise(text)


def json_number(value: Column, place: str) -> Column:
    """A whole number at a place of a JSON text; null where the text or the place is not valid."""
    return F.try_variant_get(F.try_parse_json(value), place, "bigint")


def frame_meta(**fields: Column) -> Column:
    """A frame's metadata as JSON text, in the order given."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/]+)", 1)


def url_parts(url: Column) -> Column:
    """What follows the host, cut at slashes, queries and fragments."""
    return F.filter(F.split(F.regexp_replace(url, r"^[a-z]+://[^/]+", ""), "[/?#&]"), lambda p: p != "")


def path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def medium_key(art_media: Column, art_style: Column) -> Column:
    """Which prompts apply: the first medium, with a name of its own for pencil in the loomis style."""
    first = F.coalesce(F.try_element_at(art_media, F.lit(1)), F.lit(""))
    loomis = F.exists(F.coalesce(art_style, F.array().cast("array<string>")), lambda s: s.contains("loomis"))
    return F.when((first == "pencil") & loomis, F.lit("loomis_pencil")).otherwise(first)


def decoded_attribute(value: Column) -> Column:
    """A stored attribute: parsed if it looks like JSON and is valid, else the text itself, as canonical JSON text."""
    looks = F.trim(value).rlike(r"^[\[{]")
    return F.when(looks, F.coalesce(F.to_json(F.try_parse_json(value)), value)).otherwise(value)


def appended(items: Column, item: Column) -> Column:
    """``item`` at the end of a list that may be missing."""
    return F.concat(F.coalesce(items, F.array()), F.array(item))
