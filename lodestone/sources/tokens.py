"""Tokens of source texts with their brackets, by a scanner whose work and memory grow with the text alone."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Possessive repeats never go back, so a literal of any length takes one step. An open comment or literal ends with the text.
_COMMENT = r"//[^\n]*|/\*.*?(?:\*/|\Z)"
_QUOTED = "|".join(rf"{q}(?:[^{q}\\]++|\\.?)*+(?:{q}|\Z)" for q in ('"', "'"))
_BACKTICK = r"`(?:[^`\\]++|\\.?)*+(?:`|\Z)"
_NO_CODE = re.compile(f"{_COMMENT}|{_QUOTED}|{_BACKTICK}", re.S)
_TOKEN = re.compile(rf"\s*+(?:(?P<comment>{_COMMENT})|(?P<text>{_QUOTED})|(?P<name>(?:[^\W\d]|\$)[\w$]*+)|(?P<number>\d[\w.]*+)|(?P<sign>.))?", re.S)
_PATTERN = re.compile(r"/(?:[^/\\\[\n]++|\\.|\[(?:[^\]\\\n]++|\\.)*+\])++/\w*")
_CHUNK = re.compile(r"(?:[^`\\$]++|\\.?|\$(?!\{))*+", re.S)
_ESCAPE = re.compile(r"\\(?:u\{([0-9a-fA-F]+)\}|u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(\r\n|.|\Z))", re.S)
_NAMED = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": "", "\r\n": "", "\r": "", "": ""}
_CLOSING = {")": "(", "]": "[", "}": "{"}
#: After these, a slash begins a pattern; after other tokens, it divides.
_BEFORE_PATTERN = frozenset("(,=:[!&|?{};+-*%<>~^")
_WORDS_BEFORE_PATTERN = frozenset(("return", "typeof", "case", "in", "of", "do", "else", "void"))

TOKENS = "path string, ord int, start int, end int, line int, depth int, parent int, close int, kind string, value string"
#: Tokens that leave a worker in one batch, or those of one source.
BATCH_TOKENS = 50_000


def strip_non_code(text: str) -> str:
    """Without comments, and with each string or template literal as one space."""
    return _NO_CODE.sub(lambda m: "" if m[0][0] == "/" else " ", text)


def code_only(text: Column) -> Column:
    """Source text without its comments and with each literal as one space, whichever begins first; escapes are known.

    Open literals and comments go on to the end. Null stays null.
    """

    @F.pandas_udf("string")
    def stripped(texts: pd.Series) -> pd.Series:
        return texts.map(strip_non_code, na_action="ignore")

    return stripped(text)


def unescaped(literal: str) -> str:
    """What a literal says, without its quotes."""
    if "\\" not in literal:
        return literal

    def said(m: re.Match) -> str:
        code = m[1] or m[2] or m[3]
        return chr(min(int(code, 16), 0x10FFFF)) if code else _NAMED.get(m[4], m[4])

    return _ESCAPE.sub(said, literal)


def scan(text: str) -> list[list]:
    """[start, end, line, depth, parent, close, kind, value] of every token but white space and comments.

    depth is the number of open brackets around a token, parent the number of the innermost one, or -1; the brackets
    themselves are outside, and a substitution in a template counts as two. close is the number of an opening bracket's counterpart, null for all else. Kinds are name,
    number, sign, pattern, text (what a quoted literal says), plain (a template literal without substitutions) and template
    (one with substitutions, whose tokens have it as their parent). Brackets that close nothing are signs.
    """
    out: list[list] = []
    stack: list[tuple[str, int]] = []
    at, line, newline, size = 0, 0, text.find("\n"), len(text)
    match, find, count = _TOKEN.match, text.find, text.count

    def add(start: int, end: int, kind: str, value: str | None) -> None:
        nonlocal line, newline
        if -1 < newline < start:
            line += count("\n", newline, start)
            newline = find("\n", start)
        out.append([start, end, line, len(stack), stack[-1][1] if stack else -1, None, kind, value])

    def template(start: int, chunk: int) -> int:
        """Goes on with a template literal at `chunk`, to its end or its next substitution."""
        stop = _CHUNK.match(text, chunk).end()
        if text.startswith("${", stop):
            if start >= 0:
                add(start, stop, "template", None)
                stack.append(("`", len(out) - 1))
            stack.append(("${", stack[-1][1]))
            return stop + 2
        if start >= 0:
            add(start, min(stop + 1, size), "plain", unescaped(text[chunk:stop]))
        else:
            _, opened = stack.pop()
            out[opened][1] = min(stop + 1, size)
        return stop + 1

    while at < size:
        m = match(text, at)
        kind, at = m.lastgroup, m.end()
        if kind == "name" or kind == "number":
            value = m[kind]
            add(at - len(value), at, kind, value)
        elif kind == "sign":
            start, value = at - 1, text[at - 1]
            if value in "([{":
                add(start, at, kind, value)
                stack.append((value, len(out) - 1))
            elif value in ")]}":
                if value == "}" and stack and stack[-1][0] == "${":
                    stack.pop()
                    at = template(-1, at)
                    continue
                if stack and stack[-1][0] == _CLOSING[value]:
                    out[stack.pop()[1]][5] = len(out)
                add(start, at, kind, value)
            elif value == "`":
                at = template(start, at)
            elif value == "/" and (not out or (out[-1][6] == "sign" and out[-1][7] in _BEFORE_PATTERN) or (out[-1][6] == "name" and out[-1][7] in _WORDS_BEFORE_PATTERN)) and (m := _PATTERN.match(text, start)):
                at = m.end()
                add(start, at, "pattern", m[0])
            else:
                add(start, at, kind, value)
        elif kind == "text":
            value = m[kind]
            closed = len(value) > 1 and value[-1] == value[0]
            add(at - len(value), at, kind, unescaped(value[1:-1] if closed else value[1:]))
    return out


def code_tokens(sources: DataFrame, deepest: int | None = None) -> DataFrame:
    """The tokens (TOKENS) of each source (path, text), or those with at most `deepest` brackets around them.

    `ord` numbers all tokens of a source, also those left out. Sources are scanned where they lie. Null texts have none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(path, k, *t) for k, t in enumerate(scan(text or "")) if deepest is None or t[3] <= deepest]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            kinds = [pa.string(), *[pa.int32()] * 7, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = [x.split()[0] for x in TOKENS.split(", ")]
    return sources.select("path", "text").mapInArrow(read, TOKENS)


def token_arrays(sources: DataFrame) -> DataFrame:
    """path, text and tokens of each source (path, text): the array of its tokens, in which `ord` is a token's place.

    A source stays one row, so what its tokens say of each other is found where it lies, without a shuffle or a join, and no
    plan takes many tokens for a small table. Null texts have none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun, rows, ends = 0, [], [0]
            for at, text in enumerate(batch.column("text"), 1):
                rows += [(k, *t) for k, t in enumerate(scan(text.as_py() or ""))]
                ends.append(len(rows))
                if len(rows) >= BATCH_TOKENS or at == batch.num_rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)]
                    tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names))
                    yield pa.RecordBatch.from_arrays([*batch.slice(begun, at - begun).columns, tokens], ["path", "text", "tokens"])
                    begun, rows, ends = at, [], [0]

    fields = [x.split() for x in TOKENS.split(", ")[1:]]
    names, kinds = [name for name, _ in fields], [pa.string() if kind == "string" else pa.int32() for _, kind in fields]
    schema = f"path string, text string, tokens array<struct<{', '.join(f'{name}: {kind}' for name, kind in fields)}>>"
    return sources.select("path", "text").mapInArrow(read, schema)


def bound(value: Column, f) -> Column:
    """f of a value that is computed once, also where f names it within the functions of arrays."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
