"""JSON of any depth: the standard parser, and where that runs out of stack one that keeps its own."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

_BLANK, _NUMBER, _NAMED = re.compile(r"[ \t\n\r]*"), re.compile(r"(-?(?:0|[1-9][0-9]*))(\.[0-9]+)?([eE][-+]?[0-9]+)?"), re.compile("null|true|false|NaN|-?Infinity")
_NAMES = {"null": None, "true": True, "false": False}


def loads(text: str, numbers_as_text: bool = False):
    """The value of a JSON text; ValueError if it is none. numbers_as_text: numbers as they are written."""
    try:
        return json.loads(text, parse_int=str, parse_float=str, parse_constant=str) if numbers_as_text else json.loads(text)
    except RecursionError:
        return deep(text, numbers_as_text)


def deep(text: str, numbers_as_text: bool = False):
    """loads() with the containers that are open on a list of its own."""
    skip = lambda at: _BLANK.match(text, at).end()
    opened: list[tuple[dict | list, str | None]] = []

    def key(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise ValueError(f"no key at {at}")
        name, at = scanstring(text, at + 1)
        at = skip(at)
        if text[at : at + 1] != ":":
            raise ValueError(f"no colon at {at}")
        return name, skip(at + 1)

    at = skip(0)
    while True:
        first = text[at : at + 1]
        if first == "{" or first == "[":
            at = skip(at + 1)
            value: dict | list | str | int | float | bool | None = {} if first == "{" else []
            if text[at : at + 1] != ("}" if first == "{" else "]"):
                name, at = key(at) if first == "{" else (None, at)
                opened.append((value, name))
                continue
            at += 1
        elif first == '"':
            value, at = scanstring(text, at + 1)
        elif named := _NAMED.match(text, at):
            value, at = _NAMES[named[0]] if named[0] in _NAMES else named[0] if numbers_as_text else float(named[0].replace("Infinity", "inf")), named.end()
        elif number := _NUMBER.match(text, at):
            value, at = number[0] if numbers_as_text else float(number[0]) if number[2] or number[3] else int(number[0]), number.end()
        else:
            raise ValueError(f"no value at {at}")
        # The value goes into what is open; that may close, and then is a value itself.
        while opened:
            container, name = opened[-1]
            if isinstance(container, dict):
                container[name] = value
            else:
                container.append(value)
            at = skip(at)
            end = text[at : at + 1]
            if end == ",":
                at = skip(at + 1)
                if isinstance(container, dict):
                    name, at = key(at)
                    opened[-1] = (container, name)
                break
            if end != ("}" if isinstance(container, dict) else "]"):
                raise ValueError(f"no end at {at}")
            value, at = container, at + 1
            opened.pop()
        else:
            if skip(at) != len(text):
                raise ValueError(f"more at {at}")
            return value
