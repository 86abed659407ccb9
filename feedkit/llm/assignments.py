"""Name-literal pairs of source and configuration text, constants followed to where they are used, and a score for each.

Helpers for code inside Spark tasks.  One pass over a text's tokens finds the pairs of ``name = "literal"`` in its many
forms: code, JSON, YAML, INI and shell, XML elements and attributes, subscripts, keyword and setter arguments, records
of name and value, options.  A name stands for the literals it was given last before (else first after) its use.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple


class Operand(NamedTuple):
    """A part of a value: a quoted ``text`` or a bare ``word``, between code points ``first`` and ``last`` (exclusive)."""

    kind: str
    text: str
    first: int
    last: int


class Pair(NamedTuple):
    name: str
    at: int
    operands: list[Operand]


_QUOTED = r"""(?:\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)"""
_STRING = rf"(?P<string>(?<![A-Za-z0-9_'\"`])(?P<prefix>[bBrRuUfF@$]{{0,2}}){_QUOTED})"
_TOKEN = re.compile(
    _STRING + r"""|(?P<name>--[A-Za-z][\w-]*|[A-Za-z_$@][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<sign>=>|:=|[=!<>]=+|::|=~|[^\s\w"'`$@])|(?P<line>\n)|(?P<space>[^\S\n]+)|(?P<other>.)""", re.S)
_STRING_AT = re.compile(_STRING, re.S)
_WORD_AT = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
_GAP_AT = re.compile(r"""[^\S\n]*(?:\\?\n\s*(?=["'`]))?\(?[^\S\n]*""")
_JOIN_AT = re.compile(r"""\s*(?:\+|\.\.|\|\||&)\s*|\s*\.\s*(?=["'])|[^\S\n]*\\?\n?[^\S\n]*(?=["'][^"'\n]*["'][^\S\n]*(?:[)\n;+]|$))""")
_ELEMENT_AT = re.compile(r"\s*([^<>\s][^<>\n]*?)\s*</")
_INSIDE = re.compile(r"\$\{(\w[\w.]*)\}|\{(\w+)\}|\$(\w+)|%\((\w+)\)s")
_IDENTIFIER = re.compile(r"[A-Za-z_$@][\w$.]*\Z")

_SIGNS = {"=", ":", ":=", "=>"}
_NAMED, _VALUED = {"name", "key", "id"}, {"value", "val"}
# Calls whose text argument names a secret kept elsewhere.
_LOOKUPS = {"env", "environ", "getenv", "get", "read", "load", "open", "input", "prompt", "fetch", "lookup", "find", "vault"}


def _inner(match: re.Match) -> Operand:
    """What a quoted string holds."""
    start = match.start("string") + len(match.group("prefix"))
    width = 3 if match.string[start: start + 3] in ('"""', "'''") and match.end() - start >= 6 else 1
    return Operand("text", match.string[start + width: match.end() - width], start + width, match.end() - width)


def _value(text: str, at: int) -> tuple[list[Operand], int]:
    """The operands of the expression that begins at ``at``, and where it ends."""
    out: list[Operand] = []
    at = _GAP_AT.match(text, at).end()
    while True:
        if quoted := _STRING_AT.match(text, at):
            out.append(_inner(quoted))
            at = quoted.end()
        elif word := _WORD_AT.match(text, at):
            name, end = word.group(), word.end()
            if name.endswith("+") and text[end: end + 1] in "\"'`" and len(name) > 1:
                name, end = name[:-1], end - 1
            at = end
            if text[end: end + 1] == "(":
                # a call on one text stands for that text, unless it looks something up
                argument = _STRING_AT.match(text, end + 1)
                if argument and not _LOOKUPS & set(name_words(name)):
                    out.append(_inner(argument))
                    at = argument.end() + (text[argument.end(): argument.end() + 1] == ")")
                else:
                    return [], end
            elif text[end: end + 1] == "[":
                return [], end
            else:
                out.append(Operand("word", name, word.start(), end))
        else:
            return out, at
        joined = _JOIN_AT.match(text, at)
        if not joined or joined.end() == at and text[at: at + 1] not in "\"'":
            return out, at
        at = joined.end()


def _target(back: deque) -> str | None:
    """The name that is assigned to, from the tokens before the sign."""
    if not back:
        return None
    kind, token = back[-1]
    if kind not in ("name", "string"):
        subscript = token == "]" and len(back) > 2 and back[-2][0] == "string" and back[-3][1] == "["
        return back[-2][1] if subscript else None
    if len(back) > 2 and back[-2] == ("sign", ":") and back[-3][0] in ("name", "string") and kind == "name":
        return back[-3][1]  # name: type = value
    return token


def pairs(text: str) -> Iterator[Pair]:
    """Every name-literal pair of ``text``, in order."""
    at, back = 0, deque(maxlen=4)
    named: tuple[int, str] | None = None
    while at < len(text):
        token = _TOKEN.match(text, at)
        kind, value, start, at = token.lastgroup, token.group(), token.start(), token.end()
        if kind == "space":
            continue
        if kind == "string" or kind == "prefix":
            kind, value = "string", _inner(token).text
        target, operands = None, []
        if kind == "sign":
            if value in _SIGNS:
                target = _target(back)
                if target is not None:
                    operands, at = _value(text, at)
            elif value == "," and len(back) > 2 and back[-1][0] == "string" and back[-2][1] == "(" and back[-3][0] == "name":
                found, end = _value(text, at)
                if found and found[0].kind == "text":
                    target, operands, at = back[-1][1], found, end
            elif value == ">" and len(back) > 1 and back[-1][0] == "name" and back[-2][1] == "<":
                if inside := _ELEMENT_AT.match(text, at):
                    target, operands, at = back[-1][1], [Operand("word", inside.group(1), inside.start(1), inside.end(1))], inside.end(1)
        elif kind == "name" and value.startswith("--") and text[at: at + 1] == " " and text[at + 1: at + 2] not in "-":
            target, (operands, at) = value, _value(text, at)
        back.append((kind, value))
        if not operands:
            continue
        # a value that follows its name in the same record: {"name": "TOKEN", "value": "..."}
        if target.lower() in _NAMED:
            named = start, operands[0].text
        elif target.lower() in _VALUED and named and start - named[0] < 256:
            target = named[1]
        yield Pair(target, start, operands)
        back.append(("string" if operands[-1].kind == "text" else "name", operands[-1].text))


# names and literals

# Words of names that stand for secrets, with their weight; pairs of words count together.
_SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0, "secrets": 0.9, "token": 0.9, "tokens": 0.8,
    "apikey": 1.0, "api key": 1.0, "access key": 0.9, "secret key": 1.0, "private key": 1.0, "signing key": 0.9, "encryption key": 0.9,
    "auth key": 0.9, "account key": 0.9, "master key": 0.9, "credential": 0.8, "credentials": 0.8, "authorization": 0.7, "bearer": 0.8, "auth": 0.5,
}
# Last words of names that speak about a secret and do not hold it.
_ABOUT = {
    "type", "name", "field", "label", "url", "uri", "endpoint", "path", "file", "dir", "length", "size", "count", "limit", "ttl", "expiry",
    "expires", "policy", "prompt", "hint", "regex", "pattern", "env", "header", "column", "placeholder", "enabled", "required", "id",
}
_HOLLOW = re.compile(
    r"<.*>\Z|\$\{.*\}\Z|\{\{.*\}\}\Z|%\(.*\)s\Z|\$\w+\Z|.*(?:example|change.?me|placeholder|dummy|redacted|your[_ -]|insert[_ -]|xxxx|\*\*\*|\.\.\.)"
    r"|(?:none|null|true|false|undefined)\Z|[a-z+]+://[^:@]*\Z|(?:\.{0,2}/)[\w./-]*\Z", re.I | re.S)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_words(name: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(name)]


def name_weight(name: str) -> float:
    """How likely a name holds a secret, 0 to 1."""
    found = name_words(name)
    if not found or found[-1] in _ABOUT:
        return 0.0
    one = max(_SENSITIVE.get(w, 0.0) for w in found)
    two = max((_SENSITIVE.get(f"{a} {b}", 0.0) for a, b in zip(found, found[1:])), default=0.0)
    return max(one, two)


def literal_quality(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: its bits of entropy, fewer for letters of one case alone."""
    if len(value) < 8 or any(c.isspace() for c in value) or _HOLLOW.match(value):
        return 0.0
    counts = Counter(value).values()
    bits = -sum(n * math.log2(n / len(value)) for n in counts)
    kinds = sum(any(test(c) for c in value) for test in (str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum()))
    return min(1.0, bits / 40) * (0.35 if kinds == 1 and not value.isdigit() else 0.8 if kinds == 1 else 1.0)


def _short(name: str) -> str:
    return re.split(r"[.$@>-]", name.rstrip("?!"))[-1].lower()


class Constants:
    """What each name of a text was given, and where."""

    def __init__(self, found: list[Pair]):
        self.given: dict[str, list[Pair]] = {}
        for pair in found:
            self.given.setdefault(_short(pair.name), []).append(pair)

    def _of(self, name: str, at: int) -> Pair | None:
        """The last pair of ``name`` before ``at``, else the first one after it."""
        known = self.given.get(_short(name), [])
        before = bisect_left(known, at, key=lambda p: p.at)
        after = [p for p in known[before: before + 2] if p.at != at]
        return known[before - 1] if before else after[0] if after else None

    def pieces(self, pair: Pair) -> list[Operand]:
        """The literals that a pair's value is made of, each once; a name without a value of its own is a literal itself."""
        out: dict[Operand, None] = {}
        seen = {pair.at}
        stack = [(part, pair.at) for part in reversed(pair.operands)]
        while stack:
            part, at = stack.pop()
            names = []
            if part.kind == "word" and _IDENTIFIER.match(part.text):
                names = [part.text]
            elif part.kind == "text":
                names = [next(g for g in m.groups() if g) for m in _INSIDE.finditer(part.text)]
            met = [p for n in names if (p := self._of(n, at)) is not None]
            if part.kind == "text" or not met:
                out[part] = None
            for p in reversed(met):
                if p.at not in seen:
                    seen.add(p.at)
                    stack += [(q, p.at) for q in reversed(p.operands)]
        return list(out)


THRESHOLD = 0.35


def sensitive_literals(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(first, last, name, score) of literals that reach ``threshold``: name's weight times literal's quality, its best name."""
    found = list(pairs(text))
    constants, best = None, {}
    for pair in found:
        weight = name_weight(pair.name)
        if weight < threshold:
            continue
        constants = constants or Constants(found)
        parts = constants.pieces(pair)
        score = weight * literal_quality("".join(p.text for p in parts))
        if score < threshold:
            continue
        for p in parts:
            if p.last > p.first and score > best.get((p.first, p.last), ("", 0.0))[1]:
                best[p.first, p.last] = pair.name, score
    return sorted((first, last, name, round(score, 4)) for (first, last), (name, score) in best.items())
