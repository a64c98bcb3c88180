"""How two natural keys are compared."""

from __future__ import annotations

from collections.abc import Iterable

BINARY = "binary"
CASE_INSENSITIVE = "case_insensitive"


def match_key(key: str, match: str = BINARY) -> str:
    """The SQL form of `key` that is compared: as it is, or without case and trailing blanks."""
    if match == BINARY:
        return key
    if match == CASE_INSENSITIVE:
        return f"lower(rtrim({key}))"
    raise ValueError(f"unknown key comparison {match!r}")


def scoped_key(key: str, scope: Iterable[str], match: str = BINARY, side: str = "") -> str:
    """What the merge compares: the key, or a struct of the key and its scope. NULL scopes are equal."""
    named = f"{side}." if side else ""
    compared = match_key(f"{named}{key}", match)
    others = "".join(f", '{c}', {named}{c}" for c in scope)
    return f"named_struct('{key}', {compared}{others})" if others else compared
