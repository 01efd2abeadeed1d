"""Column functions: names, paths, versions, quantities, wrapping and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def underscored(c: Column) -> Column:
    """Every space (U+0020 only) as an underscore."""
    return F.replace(c, F.lit(" "), F.lit("_"))


def has_suffix(c: Column, suffixes: tuple[str, ...]) -> Column:
    """Ends with one of the suffixes, case-sensitively."""
    out = F.lit(False)
    for s in suffixes:
        out = out | F.endswith(c, F.lit(s))
    return out


def last_suffixes(path: Column) -> Column:
    """The last two suffixes of a path's file name; a name's leading dots aren't suffixes, and a final dot leaves none."""
    # the name without leading dots, then one or two suffixes that aren't empty at the end, whatever stands after the name's slashes
    return F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*?((?:\.[^./]*){0,1}\.[^./]+)/*\z", 1)


def last_part(c: Column, sep: str) -> Column:
    return F.split_part(c, F.lit(sep), F.lit(-1))


def first_part(c: Column, sep: str) -> Column:
    return F.split_part(c, F.lit(sep), F.lit(1))


def replace_first(c: Column, pattern: str, by: str) -> Column:
    """The first match of `pattern` (without capture groups) replaced by the plain text `by`."""
    parts = F.split(c, pattern, 2)
    return F.when(F.size(parts) == 2, F.concat(parts[0], F.lit(by), parts[1])).otherwise(c)


def pad_right(c: Column, width: Column | int) -> Column:
    """Padded to `width`; unlike rpad, a longer text stays whole."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(c, F.repeat(F.lit(" "), F.greatest(width - F.length(c), F.lit(0))))


def wrapped(c: Column, width: int, indent: int = 0) -> Column:
    """Greedy word wrap: a word joins the line while line and word fit `width`; each word keeps a space after it.

    Texts no longer than `width` stay as they are.
    """
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("line"))

    def add(state: Column, word: Column) -> Column:
        fits = F.length(state["line"]) + F.length(word) <= width
        return F.when(fits, F.struct(state["lines"].alias("lines"), F.concat(state["line"], word, F.lit(" ")).alias("line"))).otherwise(F.struct(F.array_append(state["lines"], state["line"]).alias("lines"), F.concat(word, F.lit(" ")).alias("line")))

    folded = F.aggregate(F.split(c, " "), start, add, lambda s: F.array_join(F.array_append(s["lines"], s["line"]), "\n" + " " * indent))
    return F.when(F.length(c) > width, folded).otherwise(c)


def or_default(c: Column, default: Column | str) -> Column:
    """`default` where c is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default) if isinstance(default, str) else default)


def is_unset(c: Column) -> Column:
    """What counts as not given among parameter values, as text: null, empty, false and 0."""
    return c.isNull() | c.isin("", "false", "0")


def as_bool(c: Column) -> Column:
    """true, y and 1, in any case and with outer spaces, are true; all else is false."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "y", "1"), F.lit(False))


def version_tag(version: Column, commit: Column) -> Column:
    """The version with a leading v, and -g with the commit's first seven characters; unset parts are left out."""
    v = F.when(or_default(version, F.lit(None).cast("string")).isNull(), "").when(F.startswith(version, F.lit("v")), version).otherwise(F.concat(F.lit("v"), version))
    g = F.when(or_default(commit, F.lit(None).cast("string")).isNull(), "").otherwise(F.concat(F.lit("-g"), F.substring(commit, 1, 7)))
    return F.concat(v, g)


MEMORY_UNITS = {"": 0, "K": 1, "M": 2, "G": 3, "T": 4}
SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "day": 86400}


def memory_bytes(c: Column) -> Column:
    """`128.GB`, `1.5 MB` or `12B` as bytes; null where it is no quantity."""
    shape = r"^(\d+(?:\.\d+)?)\.?\s*(K|M|G|T)?B$"
    unit = F.regexp_extract(c, shape, 2)
    power = F.lit(0)
    for name, p in MEMORY_UNITS.items():
        power = F.when(unit == name, p).otherwise(power)
    number = F.try_to_number(F.regexp_extract(c, shape, 1), F.lit("999999999999.999999"))
    return F.when(F.rlike(c, F.lit(shape)), F.floor(number.cast("double") * F.pow(F.lit(1024.0), power)).cast("long"))


def duration_seconds(c: Column) -> Column:
    """`240.h`, `1day 2h` or `30 m` as seconds, parts added up; null where it is no duration."""
    whole = r"^(\d+\.?\s*(s|m|h|day|d)\s*)+$"
    parts = F.regexp_extract_all(c, F.lit(r"(\d+\.?\s*(?:day|s|m|h|d))"), F.lit(1))

    def seconds(part: Column) -> Column:
        unit = F.regexp_extract(part, r"([a-z]+)$", 1)
        factor = F.lit(0)
        for name, s in SECONDS.items():
            factor = F.when(unit == name, s).otherwise(factor)
        return F.regexp_extract(part, r"^(\d+)", 1).cast("long") * factor

    return F.when(F.rlike(c, F.lit(whole)), F.aggregate(F.transform(parts, seconds), F.lit(0).cast("long"), lambda a, x: a + x))


def capped(c: Column, cap: Column) -> Column:
    """The lesser of both; a null (invalid) cap leaves c."""
    return F.least(c, cap)


def days_spelled(c: Column) -> Column:
    """The first `d` before white space or the end as `day`."""
    return replace_first(c, r"d(?!\S)", "day")


def without_option(command: Column, option: str) -> Column:
    """The command line without the first `option` and its value."""
    return replace_first(command, rf" +{option} +[^ ]+", "")


def escaped(c: Column) -> Column:
    """Safe in HTML text and attributes."""
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def map_lines(m: Column, sep: str = "\n") -> Column:
    """`key: value` for each entry, in the order of keys."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), sep)


def base64_lines(c: Column, width: int = 76) -> Column:
    """Base64 of the UTF-8 bytes in lines of `width`."""
    plain = F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"\s", "")
    return F.regexp_replace(plain, rf"(.{{{width}}})(?!$)", "$1\n")


def publish_folder(process: Column, outdir: str) -> Column:
    """outdir/ and, in lower case, the first `_` part of the process's last `:` part."""
    return F.concat(F.lit(outdir + "/"), F.lower(first_part(last_part(process, ":"), "_")))


# SGR codes of terminal styles.
STYLES = {"reset": 0, "bold": 1, "dim": 2, "underlined": 4, "blink": 5, "reverse": 7, "hidden": 8}
COLOURS = ["black", "red", "green", "yellow", "blue", "purple", "cyan", "white"]


def terminal_codes(plain: bool = False) -> dict[str, str]:
    """Escape codes by name; prefixes b, u, i and bi are bold, underlined, intense and bold intense. Empty if plain."""
    codes = {name: f"{n}" for name, n in STYLES.items()}
    for prefix, style, base in (("", "0", 30), ("b", "1", 30), ("u", "4", 30), ("i", "0", 90), ("bi", "1", 90)):
        codes |= {prefix + colour: f"{style};{base + n}" for n, colour in enumerate(COLOURS)}
    return {name: "" if plain else f"\033[{code}m" for name, code in codes.items()}
