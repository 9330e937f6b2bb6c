"""Record normalisation: text, names, categories, ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a plain whitespace strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
ABS_MARK = "/abs/"
VERSION_SUFFIX = r"v[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def flatten_text(c: Column | str) -> Column:
    """Missing becomes empty, each newline becomes one space, both ends are stripped."""
    return strip(F.replace(or_empty(c), F.lit("\n"), F.lit(" ")))


def author_names(authors: Column | str, plain: str | None = None) -> Column:
    """Full names from ``array<struct<keyname,forenames>>`` in order, empty ones dropped.

    An author without name parts is known by the text in the field ``plain``, if named.
    """

    def full(a: Column) -> Column:
        name = strip(F.concat(or_empty(a["forenames"]), F.lit(" "), or_empty(a["keyname"])))
        return name if plain is None else F.coalesce(F.nullif(name, F.lit("")), strip(or_empty(a[plain])))

    names = F.transform(
        F.coalesce(_col(authors), F.array()),
        full,
    )
    return F.filter(names, lambda n: n != "")


def non_empty(names: Column | str) -> Column:
    """Array entries that are neither null nor empty, in order (feed authors and tags)."""
    values = F.coalesce(_col(names), F.array().cast("array<string>"))
    return F.filter(values, lambda n: F.coalesce(n, F.lit("")) != "")


def split_categories(c: Column | str) -> Column:
    """Whitespace-separated categories; missing or blank gives an empty array."""
    return F.filter(F.split(or_empty(c), WHITESPACE_RUN), lambda part: part != "")


def primary_date(updated: Column | str, created: Column | str) -> Column:
    return F.coalesce(F.nullif(_col(updated), F.lit("")), _col(created))


def has_abs_link(link: Column | str) -> Column:
    return F.coalesce(F.contains(_col(link), F.lit(ABS_MARK)), F.lit(False))


def id_from_link(link: Column | str, cut: str = "version") -> Column:
    """Paper id: what follows the last ``/abs/``, without its version.

    ``cut="version"`` drops a trailing ``v<digits>``. ``cut="first_v"`` cuts at the first
    ``v`` anywhere, which also shortens ids that contain one.
    """
    tail = F.substring_index(_col(link), ABS_MARK, -1)
    if cut == "first_v":
        return F.substring_index(tail, "v", 1)
    if cut == "version":
        return F.regexp_replace(tail, VERSION_SUFFIX, "")
    raise ValueError(f"unknown cut: {cut}")


def in_categories(categories: Column | str, wanted: list[str]) -> Column:
    """Whether any category is one of ``wanted`` or lies below one (``cs`` covers ``cs.AI``)."""
    if not wanted:
        return F.lit(True)

    def hit(category: Column) -> Column:
        found = category.isin(wanted)
        for prefix in wanted:
            found = found | F.startswith(category, F.lit(prefix + "."))
        return found

    return F.coalesce(F.exists(_col(categories), hit), F.lit(False))


def embed_text(title: Column | str = "title", abstract: Column | str = "abstract") -> Column:
    """Title and abstract on two lines; a missing part is empty, the line break stays."""
    return F.concat(or_empty(title), F.lit("\n"), or_empty(abstract))
