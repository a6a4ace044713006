"""Names, paths, answers, timestamps and word error rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that separate words.
WORD_SPACE = r"[\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# How a local path begins, besides a drive letter.
LOCAL_ROOTS = ("/c/Users/", "/Users/")
_INSIDE = r"[^\s\"'/\\]*"
# a local path anywhere inside a string; group 1 is its last component
LOCAL_PATH = r"(?i)(?:[A-Z]:[\\/]|" + "|".join(LOCAL_ROOTS) + rf")(?:{_INSIDE}[/\\])*({_INSIDE})"
# Markers that refuse a path.
FORBIDDEN_MARKERS = ("val2017", "coco-ood", "rf-detr-keypoint-data", "nf4", "int4", "int8")
# The marker before a judge's answer.
ANSWER_MARKER = "<channel|>"


def words(text: Column) -> Column:
    spaced = F.split(F.lower(text), WORD_SPACE)
    return F.filter(spaced, lambda w: w != "")


def first_nonblank(*fields: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(f), F.lit("")) for f in fields])


def first_named(witnesses: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """Value, name of the witness used, and names of the absent ones. No usable one gives NULL."""
    value = F.coalesce(*witnesses.values())
    name = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in witnesses.items()])
    absent = F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in witnesses.items()]))
    return value, name, absent


def phrase_slug(prompt: Column, trigger: str = "") -> Column:
    """Words joined by ``-``, and phrases (each ending in view or shot) by ``_``."""
    bare = F.trim(F.replace(prompt, F.lit(trigger), F.lit("")) if trigger else prompt)
    dashed = F.regexp_replace(bare, r"[ \t\r\n]+", "-")
    return F.regexp_replace(dashed, r"(?<![^-])(view|shot)-", "$1_")


def file_stem(title: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-|-$", "")


def plain_name(name: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def scrub_paths(text: Column) -> Column:
    """Reduce every local path inside ``text`` to its last component."""
    return F.regexp_replace(text, LOCAL_PATH, "$1")


def scrub_column(c: Column, kind: T.DataType) -> Column:
    """``scrub_paths`` on every string leaf of a column of any type."""
    if isinstance(kind, T.StringType):
        return scrub_paths(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: scrub_column(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda k, v: scrub_column(v, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [scrub_column(c.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def is_absolute(path: Column) -> Column:
    """Drive letter, home folder, leading slash, or any colon."""
    return path.rlike(r"(?i)^/|^\\|:|/users/|/home/")


def has_marker(path: Column, markers: Sequence[str] = FORBIDDEN_MARKERS) -> Column:
    """The first forbidden marker contained in ``path``, else NULL."""
    low = F.lower(path)
    return F.coalesce(*[F.when(F.contains(low, F.lit(m)), F.lit(m)) for m in markers])


def clock(seconds: Column) -> Column:
    """HH:MM:SS.mmm, rounded to milliseconds before it is split into fields."""
    ms = F.round(seconds * 1000).cast("long")
    hours, rest = F.floor(ms / 3600000), F.pmod(ms, F.lit(3600000))
    return F.format_string(
        "%02d:%02d:%02d.%03d", hours, F.floor(rest / 60000),
        F.floor(F.pmod(rest, F.lit(60000)) / 1000), F.pmod(rest, F.lit(1000)),
    )


def judge_answer(reply: Column) -> Column:
    """Integer after the last marker, else the last free-standing 1-3 digit number, else NULL."""
    after = F.trim(F.element_at(F.split(reply, r"<channel\|>"), -1))
    token = F.regexp_replace(F.regexp_extract(after, r"^(\S+)", 1), r"^[.,]+|[.,]+$", "")
    numbers = F.regexp_extract_all(reply, F.lit(r"\b(\d{1,3})\b"), F.lit(1))
    last = F.when(F.size(numbers) > 0, F.element_at(numbers, -1))
    chosen = F.when(F.contains(reply, F.lit(ANSWER_MARKER)), token).otherwise(last)
    return F.when(chosen.rlike(r"^[+-]?\d+$"), chosen).try_cast("int")


def _characters(codes: Column) -> Column:
    """Numbers from 0x10000 on as one supplementary character each."""
    return F.decode(F.unhex(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 8, "0")), "")), "UTF-32")


def _placed(words_: Column, known: Column) -> Column:
    """The words by their places in ``known``; beyond a million different words in a pair the places leave Unicode and decoding fails."""
    return F.transform(words_, lambda w: F.array_position(known, w) + 0xFFFF)


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Word edits over reference words, on whole texts; an empty reference scores 0 or 1.

    Each word is written as one character, so the built-in edit distance of the two strings counts words. The character
    is a hash of the word if no two different words of the pair share one, which their numbers tell, else its place among
    the pair's words: looking up places takes a scan for each word, hashing does not."""
    both = F.array(F.struct(words(reference).alias("r"), words(hypothesis).alias("h")))
    hashed = lambda w: F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(1 << 20)) + 0x10000)

    def edits(p: Column, c: Column) -> Column:
        apart = F.size(F.array_distinct(F.concat(c["a"], c["b"]))) == F.size(c["d"])
        by_place = F.levenshtein(_characters(_placed(p["r"], c["d"])), _characters(_placed(p["h"], c["d"])))
        return F.when(apart, F.levenshtein(_characters(c["a"]), _characters(c["b"]))).otherwise(by_place)

    def rate(p: Column) -> Column:
        coded = F.array(F.struct(hashed(p["r"]).alias("a"), hashed(p["h"]).alias("b"), F.array_distinct(F.concat(p["r"], p["h"])).alias("d")))
        empty = F.when(F.size(p["h"]) == 0, F.lit(0.0)).otherwise(F.lit(1.0))
        return F.when(F.size(p["r"]) == 0, empty).otherwise(F.get(F.transform(coded, lambda c: edits(p, c)), F.lit(0)) / F.size(p["r"]))

    return F.when(reference.isNotNull() & hypothesis.isNotNull(), F.get(F.transform(both, rate), F.lit(0)))
