"""Keys of JSON texts at any depth: one pass over the tokens with a worklist of open containers, no recursion."""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null))')
_BLANK = re.compile(r"[ \t\n\r]*\Z")


def keys_of(text: str) -> Iterator[tuple[list, str]]:
    """(open containers, key) of each key, as the text is read; a container is [whether it is an object, the key or index of what is being read in it]. ValueError where the text is no JSON."""
    at, opened, want = 0, [], "value"
    while want != "end":
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(at)
        at = m.end()
        sign, string, other = m.groups()
        if want in ("value", "value or ]") and (string or other):
            want = "next"
        elif want in ("value", "value or ]") and sign in ("{", "["):
            opened.append([sign == "{", None if sign == "{" else 0])
            want = "key or }" if sign == "{" else "value or ]"
        elif want == "value or ]" and sign == "]" or want == "key or }" and sign == "}" or want == "next" and opened and sign == ("}" if opened[-1][0] else "]"):
            opened.pop()
            want = "next"
        elif want in ("key", "key or }") and string:
            opened[-1][1] = json.loads(string) if "\\" in string else string[1:-1]
            yield opened, opened[-1][1]
            want = ":"
        elif want == ":" and sign == ":":
            want = "value"
        elif want == "next" and opened and sign == ",":
            if not opened[-1][0]:
                opened[-1][1] += 1
            want = "key" if opened[-1][0] else "value"
        else:
            raise ValueError(at)
        if want == "next" and not opened:
            want = "end"
    if not _BLANK.match(text, at):
        raise ValueError(at)


def forbidden_in(text: str | None, names: Collection[str]) -> list[tuple[str, str | None]]:
    """(path of the object, key) of each key whose trimmed lower case is in names; ('$', None) alone for a text that is no JSON."""
    if text is None:
        return []
    found: list[tuple[str, str | None]] = []
    try:
        for opened, key in keys_of(text):
            if key.strip(" ").lower() in names:
                found.append(("$" + "".join(f".{step}" if named else f"[{step}]" for named, step in opened[:-1]), key))
    except ValueError:
        return [("$", None)]
    return found


def forbidden_keys_of(document: Column, names: Collection[str]) -> Column:
    """forbidden_in() of a column: an array of structs (path, key)."""
    wanted = frozenset(names)

    @F.pandas_udf("array<struct<path:string,key:string>>")
    def found(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"path": p, "key": k} for p, k in forbidden_in(x, wanted)])

    return found(document)
