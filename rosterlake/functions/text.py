"""Text expressions: cleaning, classes, lists, sentiment, prompts, JSON answers.

Java regular expressions know only ASCII by default, so every ``\\w`` or ``\\s`` carries
``(?U)`` and every case-insensitive search ``(?iu)``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_with_tasks

# --- fixed values -----------------------------------------------------------------
UNKNOWN = "DESCONHECIDO"
OTHERS = "Outros"
APART = "_cand"
PRIORITY_WORDS = {
    "ALTA": ["ALTA", "HIGH", "URGENTE", "URGENCY"],
    "MEDIA": ["MEDIA", "MÉDIA", "MEDIUM", "INTERMEDIARIA", "INTERMEDIÁRIA"],
    "BAIXA": ["BAIXA", "LOW", "BAIXA PRIORIDADE"],
}
SENTIMENT_TRAINING = {
    "positive": r"proativ|interessad|bom\sperfil|responsiv|gostou|avan(ç|c)ou|performou\sbem",
    "negative": r"n(a|ã)o\sresponde|desisti|sem\sinteresse|n(a|ã)o\sretorna|n(a|ã)o\satende",
}
SENTIMENT_SCORING = {
    "positive": r"interessado|motivado|bom perfil|gostei|excelente|promissor|encaminhar|aprovado",
    "negative": r"desistiu|não tem perfil|fraco|recusou|sem experiência|confuso|ruim",
}
COMMON_RECRUITERS = ["Michelle", "Daniella", "Stefany", "Katia", "Ana", "Raquel", "Mônica", "Thaise"]
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# ----------------------------------------------------------------------------------


def strip_space(c: Column) -> Column:
    """Trim any Unicode white space; ``trim`` alone removes only the blank."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_text(c: Column) -> Column:
    """White-space runs to one blank, other characters than words and ``@ . , - : /`` removed, trimmed, upper case.

    Plain ASCII text without double blanks needs no replacement and takes the short way.
    """
    value = c.cast("string")
    plain = value.rlike(r"^[A-Za-z0-9_@.,:/ -]*+\z") & ~F.contains(value, F.lit("  "))
    squeezed = F.regexp_replace(value, r"(?U)\s+", " ")
    kept = F.regexp_replace(squeezed, r"(?U)[^\w\s@.,\-:/]+", "")
    return F.upper(F.trim(F.when(plain, value).otherwise(kept)))


def is_filled(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def filled_flag(c: Column) -> Column:
    """0/1 version of :func:`is_filled`."""
    return is_filled(c).cast("tinyint")


def any_filled(*columns: Column) -> Column:
    flags = [is_filled(c) for c in columns]
    out = flags[0]
    for flag in flags[1:]:
        out = out | flag
    return out


def begins_plain(c: Column) -> Column:
    """First character from ``0`` to ``~``: neither white space nor a dash. Two comparisons instead of trims."""
    return (c >= F.lit("0")) & (c < F.lit("\x7f"))


def is_blank_or_dashes(c: Column) -> Column:
    """Null, or nothing left after trimming white space, dashes and white space again."""
    value = c.cast("string")
    left = strip_space(F.btrim(strip_space(value), F.lit("-")))
    return F.when(begins_plain(value), F.lit(False)).otherwise(F.coalesce(left == "", F.lit(True)))


def is_missing_value(c: Column, is_string: bool = True) -> Column:
    """Null, or (strings) empty, blank or a single dash."""
    if not is_string:
        return c.isNull()
    return F.when(begins_plain(c), F.lit(False)).otherwise(F.coalesce(strip_space(c).isin("", "-", " "), F.lit(True)))


def word_class(c: Column, words: Mapping[str, Sequence[str]], default: str) -> Column:
    """First class whose word occurs in the upper-cased text."""
    text = F.upper(strip_space(F.coalesce(c, F.lit(""))))
    label = None
    for name, terms in words.items():
        hit = text.rlike("|".join(re.escape(t) for t in terms))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(default)


def priority_class(c: Column) -> Column:
    return word_class(c, PRIORITY_WORDS, UNKNOWN)


def split_clean_list(c: Column, separator: str, default: str = UNKNOWN) -> Column:
    text = strip_space(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+", " "))
    parts = F.transform(F.split(text, re.escape(separator)), lambda x: F.upper(F.trim(x)))
    kept = F.filter(parts, lambda x: x != "")
    return F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept)


def parse_money(c: Column) -> Column:
    digits = F.regexp_replace(c, "[^0-9,]", "")
    return F.regexp_replace(digits, "^([^,]*),", "$1.").try_cast("double")


def mentions(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(f"(?iu){pattern}"), F.lit(False))


def sentiment_from_flags(positive: Column, negative: Column) -> Column:
    return F.when(positive, 1).when(negative, -1).otherwise(0)


def sentiment(c: Column, words: Mapping[str, str] = SENTIMENT_TRAINING) -> Column:
    return sentiment_from_flags(mentions(c, words["positive"]), mentions(c, words["negative"]))


def keep_listed(c: Column, allowed: Sequence[str], default: str = OTHERS) -> Column:
    """Value if its upper case is listed (upper-cased too), else ``default``.

    The compare ignores case because curated text is upper-cased while the list is not.
    """
    return F.when(F.upper(c).isin([a.upper() for a in allowed]), c).otherwise(F.lit(default))


def char_count(c: Column) -> Column:
    return F.coalesce(F.char_length(c), F.lit(0))


def filled_share(columns: Sequence[Column]) -> Column:
    """Share of non-null columns; an empty string counts as filled."""
    if not columns:
        return F.lit(0.0)
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total / F.lit(len(columns))


def join_texts(*columns: Column, separator: str = " ") -> Column:
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def join_lists(*lists: Column, separator: str = " ") -> Column:
    return F.array_join(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]), separator)


def drop_empty(c: Column) -> Column:
    return F.filter(c, lambda x: x.isNotNull() & (x != ""))


def as_list(c: Column, dtype: T.DataType) -> Column:
    """A flat ``array<string>`` from a string, an array or an array of arrays."""
    empty = F.array().cast("array<string>")
    if isinstance(dtype, T.ArrayType):
        flat = F.flatten(c) if isinstance(dtype.elementType, T.ArrayType) else c
        return F.coalesce(flat, empty)
    return F.when(c.isNull(), empty).otherwise(F.array(c.cast("string")))


def first_text(c: Column, dtype: T.DataType) -> Column:
    """First list element or the value itself, as trimmed text; '' when absent."""
    value = F.get(c, F.lit(0)) if isinstance(dtype, T.ArrayType) else c
    return strip_space(F.coalesce(value.cast("string"), F.lit("")))


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Render ``{name}`` slots of a template with columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


FENCED = r"(?s)\A```json[ \t\r]*\n(.*)\n[ \t]*```"


def unfenced(answer: str) -> str:
    """:func:`json_body` of one answer outside of Spark."""
    found = re.match(FENCED + r"\Z", answer.strip())
    return found[1] if found and found[1] else answer.strip()


def json_body(answer: Column) -> Column:
    """Text between a leading ```json line and a closing ``` line, else the whole answer."""
    text = strip_space(answer)
    fenced = F.regexp_extract(text, FENCED + r"\z", 1)
    return F.when(fenced != "", fenced).otherwise(text)


def parse_answer(answer: Column, schema: T.StructType) -> Column:
    """Parsed answer; broken JSON gives a struct of nulls."""
    return F.from_json(json_body(answer), schema)


def tell_apart(candidate_id: Column, job_id: Column, suffix: str = APART) -> Column:
    return F.when(candidate_id == job_id, F.concat(candidate_id, F.lit(suffix))).otherwise(candidate_id)


def listed_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms that occur in the text (case-insensitive), in list order."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(lowered, F.lower(t)))


ship_with_tasks(sys.modules[__name__])
