"""File keys and glob patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


class InvalidGlob(ValueError):
    """A file pattern that cannot be read."""


def _char_class(pattern: str, start: int) -> tuple[str, int]:
    """Regex for the ``[...]`` class at ``start`` and the index after it."""
    negated = pattern[start + 1 : start + 2] == "!"
    body = start + (2 if negated else 1)
    # A closing bracket right after the opening one stands for itself.
    end = pattern.find("]", body + 1)
    if end < 0:
        raise InvalidGlob(f"unclosed character class in {pattern!r}")
    inner = re.sub(r"([\\\[\]^&~|])", r"\\\1", pattern[body:end])
    return f"[{'^' if negated else ''}{inner}]", end + 1


def glob_to_regex(pattern: str, cross_slash: bool = True) -> str:
    """Anchored regex for a glob.

    ``*`` and ``?`` also match ``/`` when ``cross_slash`` is set, which is the
    rule for routing and object listings; local listings keep them within one
    path component. ``**`` stands alone in its component and matches any depth,
    none included.
    """
    one = "." if cross_slash else "[^/]"
    out, i = [], 0
    while i < len(pattern):
        char = pattern[i]
        if pattern.startswith("**", i):
            before = i == 0 or pattern[i - 1] == "/"
            rest = pattern[i + 2 :]
            if not before or (rest and not rest.startswith("/")):
                raise InvalidGlob(f"'**' must be a path component of its own in {pattern!r}")
            out.append("(?:.*/)?" if rest else ".*")
            i += 3 if rest else 2
        elif char == "*":
            out.append(one + "*")
            i += 1
        elif char == "?":
            out.append(one)
            i += 1
        elif char == "[":
            text, i = _char_class(pattern, i)
            out.append(text)
        else:
            out.append(re.sub(r"([\\.^$+{}()|\]])", r"\\\1", char))
            i += 1
    return f"(?s)^{''.join(out)}$"


def file_key(path: Column, base: str) -> Column:
    """Path relative to the input folder, percent escapes undone.

    ``path`` is the file path of ``_metadata``, a URI; the part before the base
    folder (scheme, authority) does not matter.
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", base).rstrip("/") + "/"
    without_scheme = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    at = F.locate(root, without_scheme)
    return F.when(at > 0, F.substr(without_scheme, at + F.lit(len(root)))).otherwise(plain)


def first_component(key: Column) -> Column:
    return F.split_part(key, F.lit("/"), F.lit(1))


def file_stem(key: Column) -> Column:
    """File name without its last extension."""
    name = F.element_at(F.split(key, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
