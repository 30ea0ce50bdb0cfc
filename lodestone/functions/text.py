"""Text functions, built from Spark's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    """Small letters; anything but a-z and 0-9 is one space; none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]", " "), r"\s+", " "))


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def prose(text: Column) -> Column:
    """Without fenced code, inline code and HTML comments, removed in that order."""
    out = F.regexp_replace(text, r"(?s)```.*?```", " ")
    return F.regexp_replace(F.regexp_replace(out, r"`[^`\n]*`", " "), r"(?s)<!--.*?-->", " ")


def line_count(text: Column) -> Column:
    """Lines, a last line end not counted as one more; 0 for an empty text."""
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.when(text.endswith("\n"), 0).otherwise(1)
    return F.when(F.length(text) == 0, 0).otherwise(lines).cast("bigint")


def significant_words(text: Column) -> Column:
    """Words longer than three characters of a normalised text."""
    return F.filter(F.split(text, " "), lambda w: F.length(w) > 3)


def mentioned_in(needle: Column, haystack: Column) -> Column:
    """Whether a normalised needle occurs as a phrase, or seven tenths of its significant words do, as substrings."""
    words = significant_words(needle)
    found = F.size(F.filter(words, lambda w: F.contains(haystack, w)))
    return F.contains(haystack, needle) | ((F.size(words) > 0) & (found >= F.ceil(F.size(words) * 0.7)))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def _folded(path: Column) -> Column:
    """The names of a path, those that `..` takes back removed; steps above the start stay, steps above the root don't."""
    step = lambda done, name: (
        F.when(name.isin("", "."), done)
        .when((name == "..") & (F.size(done) > 0) & (F.element_at(F.concat(F.array(F.lit("")), done), -1) != ".."), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when((name == "..") & F.startswith(path, F.lit("/")), done)
        .otherwise(F.concat(done, F.array(name)))
    )
    return F.aggregate(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), F.expr("cast(array() as array<string>)"), step)


def folded_path(path: Column) -> Column:
    """A path without `.`, `..` and repeated separators, `.` if nothing is left; backslashes separate too."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    out = F.array_join(_folded(slashed), "/")
    return F.when(F.startswith(slashed, F.lit("/")), F.concat(F.lit("/"), out)).when(out == "", ".").otherwise(out)


def joined_path(folder: Column, path: Column) -> Column:
    """The path as seen from the folder; an absolute one is itself. A folder may be empty."""
    return folded_path(F.when(F.startswith(path, F.lit("/")) | (folder == ""), path).otherwise(F.concat(folder, F.lit("/"), path)))


def relative_path(folder: Column, path: Column) -> Column:
    """How to get from the folder to the path, both absolute or both not; null where the way up has no known names."""
    start, goal = _folded(folder), _folded(path)
    same = F.zip_with(start, goal, lambda a, b: F.coalesce(a == b, F.lit(False)))
    shared = F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)).cast("int")
    up = F.slice(start, shared + 1, F.size(start))
    steps = F.concat(F.transform(up, lambda _: F.lit("..")), F.slice(goal, shared + 1, F.size(goal)))
    way = F.when(F.size(steps) == 0, ".").otherwise(F.array_join(steps, "/"))
    unknown = F.array_contains(up, "..") | (F.startswith(folder, F.lit("/")) != F.startswith(path, F.lit("/")))
    return F.when(~unknown, way)


def major_version(text: Column) -> Column:
    """The first number in a version or range; null without one."""
    return F.nullif(F.regexp_extract(text, "([0-9]+)", 1), F.lit("")).cast("bigint")


def id_prefix(member: Column) -> Column:
    """What stands before the first colon of a member id."""
    return F.substring_index(member, ":", 1)


def label(text: Column) -> Column:
    """The trimmed text if it has two characters or more and not digits alone; else null."""
    out = F.regexp_replace(text, r"^[ \t\n\r]+|[ \t\n\r]+$", "")
    return F.when((F.length(out) >= 2) & ~out.rlike("^[0-9]+$"), out)


def matches_any(text: Column, patterns: tuple[str, ...]) -> Column:
    """Whether any of the patterns is found, in one pass."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def escaped(literal: str) -> str:
    """A pattern that finds the literal and nothing else."""
    return "".join(c if c.isalnum() else "\\" + c for c in literal)
