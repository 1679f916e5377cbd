"""Parts of a URL, cut by plain text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import blank_to_null, col

def _without(text: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def url_host(url) -> Column:
    """Text between the scheme and the first '/' or '?'."""
    return _before(_before(_without(col(url), "android-app://", "http://", "https://"), "/"), "?")


def url_path(url) -> Column:
    """Text after the host's '/' up to '?'; a fragment stays.

    With no '/' the cut is in front of the '?', so the path is ''. With neither the whole
    text is returned.
    """
    rest = _without(col(url), "http://", "https://")
    slash = F.position(F.lit("/"), rest)
    cut = F.when(slash > 0, slash).otherwise(F.position(F.lit("?"), rest) - 1)
    return _before(F.right(rest, F.length(rest) - cut), "?")


def url_parameter(url, name: str) -> Column:
    """Text between ``name=`` and the next '&', NULL where empty.

    ``name=`` is looked for anywhere, so a longer parameter that ends in it also matches.
    """
    after = F.split_part(col(url), F.lit(f"{name}="), F.lit(2))
    return blank_to_null(_before(after, "&"))
