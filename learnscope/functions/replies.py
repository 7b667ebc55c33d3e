"""Replies of a topic segmenter: text to a mapping of row numbers to topics.

One reader serves the Column form (:func:`learnscope.operators.segment.parse_mapping`)
and the hook that calls a segmenter in tasks. A reply is JSON, or JSON5 where it
is not: comments, trailing commas, single quotes and their escapes, bare keys,
hexadecimal and signed numbers, leading and trailing points.
"""

from __future__ import annotations

import json
import math
import re

_FENCE = re.compile(r"^```(?:json)?|```$", re.M)
_BLANK = re.compile(r"(?:\s|\ufeff|//[^\n\r\u2028\u2029]*|/\*.*?\*/)*", re.S)
_TOKEN = re.compile(
    r"""(?P<mark>[{}\[\]:,])
    |"(?P<double>(?:[^"\\\n\r]|\\\r\n|\\.)*)"
    |'(?P<single>(?:[^'\\\n\r]|\\\r\n|\\.)*)'
    |(?P<number>[+-]?(?:0[xX][0-9a-fA-F]+|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|Infinity|NaN))(?![\w$])
    |(?P<name>(?:[^\W\d]|\$|\\u[0-9a-fA-F]{4})(?:\w|\$|\\u[0-9a-fA-F]{4})*)""",
    re.X | re.S,
)
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(\r\n|.))", re.S)
_SHORT = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0", "\n": "", "\r": "", "\r\n": "", "\u2028": "", "\u2029": ""}
_WORDS = {"true": True, "false": False, "null": None}


def _unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[3] is None else _SHORT.get(m[3], m[3]), text)


def _number(text: str) -> int | float:
    sign, digits = (-1, text[1:]) if text[0] == "-" else (1, text.removeprefix("+"))
    if digits[:2] in ("0x", "0X"):
        return sign * int(digits, 16)
    if digits.isascii() and digits.isdigit():
        return sign * int(digits)
    return sign * {"Infinity": math.inf, "NaN": math.nan}.get(digits, 0.0) if digits[0] in "IN" else sign * float(digits)


def _tokens(text: str):
    at = _BLANK.match(text).end()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"no token at {at}")
        yield m.lastgroup, m[m.lastgroup]
        at = _BLANK.match(text, m.end()).end()
    yield "end", ""


def read_json5(text: str):
    """The value of a JSON5 text; numbers as keys are taken too. A nest of any
    depth is read, as open containers are kept in a list of our own."""
    root: list = []
    open_, keys = [root], [None]  # containers, and the key that waits for its value
    state = "value"  # what may come: value, key, colon, comma
    tokens = _tokens(text)
    for kind, s in tokens:
        top = open_[-1]
        if kind == "end":
            if len(open_) > 1 or state != "comma":
                raise ValueError("the text ends early")
            return root[0]
        if top is root and state == "comma":
            raise ValueError("text after the value")
        if state == "colon":
            if s != ":" or kind != "mark":
                raise ValueError("no colon after a key")
            state = "value"
        elif kind == "mark" and s in "]}" and state in (("comma", "key") if s == "}" else ("comma", "value")) and type(top) is (dict if s == "}" else list) and top is not root and keys[-1] is None:
            open_.pop()
            keys.pop()
            keys[-1], state = None, "comma"
        elif state == "comma":
            if kind != "mark" or s != ",":
                raise ValueError("no comma after a value")
            state = "key" if type(top) is dict else "value"
        elif state == "key":
            if kind == "mark":
                raise ValueError("no key")
            keys[-1] = s if kind == "number" else _unescape(s)
            state = "colon"
        else:
            if kind == "mark":
                if s not in "{[":
                    raise ValueError("no value")
                value = {} if s == "{" else []
            elif kind == "number":
                value = _number(s)
            elif kind == "name":
                value = _WORDS[s]  # a KeyError is a bad text too
            else:
                value = _unescape(s)
            if type(top) is dict:
                top[keys[-1]] = value
            else:
                top.append(value)
            if kind == "mark":
                open_.append(value)
                keys.append(None)
                state = "key" if s == "{" else "value"
            else:
                keys[-1], state = None, "comma"


def as_mapping(reply) -> dict[str, int]:
    """Row numbers (as texts) to topics, from an object or an array of topics in
    row order. Values become integers as ``int`` makes them; those that it refuses
    or that exceed 32 bits are left out. A reply with an infinite value, or of
    another kind, gives nothing: it is taken as a whole or not at all."""
    if isinstance(reply, list):
        reply = dict(enumerate(reply, 1))
    if not isinstance(reply, dict):
        return {}
    out = {}
    for key, value in reply.items():
        try:
            n = int(value)
        except (TypeError, ValueError):
            continue
        except OverflowError:
            return {}
        if -(1 << 31) <= n < 1 << 31:
            out[str(key)] = n
    return out


def read_reply(text: str | None) -> dict[str, int]:
    """The mapping of a reply's text; nothing where it cannot be read."""
    plain = _FENCE.sub("", (text or "").strip()).strip()
    try:
        value = json.loads(plain)
    except (ValueError, RecursionError):
        try:
            value = read_json5(plain)
        except (KeyError, ValueError):
            return {}
    return as_mapping(value)
