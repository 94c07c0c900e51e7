"""Path and URL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_suffix(path: Column) -> Column:
    """Last suffix with its dot, empty for none; a leading or trailing dot is not a suffix."""
    name = file_name(F.regexp_replace(path, "/+$", ""))
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def file_stem(path: Column) -> Column:
    name = file_name(path)
    suffix = file_suffix(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix))


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def rel_path(path: Column, root: str) -> Column:
    """Path below ``root``: the first occurrence of the root is cut, then leading slashes."""
    at = F.instr(path, root)
    rest = F.concat(
        F.substring(path, F.lit(1), at - 1),
        F.substring(path, at + F.lit(len(root)), F.length(path)),
    )
    return F.regexp_replace(F.when(at > 0, rest).otherwise(path), "^/+", "")


def base_url(url: Column) -> Column:
    """Scheme and authority of an absolute URL."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def absolute_url(link: Column, page_url: Column) -> Column:
    """Resolve a link against its page: protocol-relative, absolute, or below the site root."""
    scheme = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    below = F.concat(base_url(page_url), F.lit("/"), F.regexp_replace(link, "^/+", ""))
    return (
        F.when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("http"), link)
        .otherwise(below)
    )


def url_allowed(url: Column, page_url: Column, allow_list: Sequence[str] | None = None) -> Column:
    """True when the URL starts with an allowed prefix; default is the page's own site."""
    if not allow_list:
        return F.startswith(url, base_url(page_url))
    allowed = F.lit(False)
    for prefix in allow_list:
        allowed = allowed | F.startswith(url, F.lit(prefix))
    return allowed
