"""Column expressions shared by every layer.  All JVM-side; no Python UDFs."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed domain values.
# A student is literate when the proficiency score is at least 743.0.
LITERACY_CUTOFF = 743.0
# A municipality meets the goal when its indicator is at least 50.0.
GOAL_CUTOFF = 50.0
# Placeholder for a missing municipality name.
MISSING_NAME = "NAO INFORMADO"
# Goal status labels.
STATUS_NO_GOAL = "SEM_META"
STATUS_MET = "ATINGIDA"
STATUS_NOT_MET = "NAO_ATINGIDA"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c, scale: int = 2) -> Column:
    """Half-away-from-zero rounding on the decimal value, as the SQL engines do.

    Going through decimal(38,12) makes Spark and DuckDB agree on ties such as
    50.015 (binary doubles otherwise round differently in the two engines)
    without rounding twice.  A value outside that decimal has no fraction left
    in a double, so it is rounded as a double.
    """
    col = _c(c)
    exact = F.round(col.try_cast("decimal(38,12)"), scale).cast("double")
    return F.coalesce(exact, F.round(col.cast("double"), scale))


def clean_double(c) -> Column:
    """NaN -> NULL.  Spark orders NaN above every number, so NaN >= 50 is true."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def safe_double(c) -> Column:
    """Per-value cast that yields NULL instead of failing under ANSI mode."""
    return clean_double(_c(c).try_cast("double"))


def safe_long(c) -> Column:
    return _c(c).try_cast("bigint")


# The code points with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                                0x205F, 0x3000]))


def strip_ws(c) -> Column:
    """Trim Unicode whitespace on both ends (``trim`` alone keeps tabs)."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Accent folding tables for all of Unicode, derived from NFKD.

    A code point whose compatibility decomposition keeps exactly one ASCII
    character goes into a 1:1 ``translate`` table; one that keeps several
    (ligatures, fractions, units) into a map that only texts holding such a
    character are put through; one that keeps none is removed by the final
    non-ASCII filter.
    """
    src, dst, multi = [], [], []
    for cp in [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)]:
        ch = chr(cp)
        folded = "".join(x for x in unicodedata.normalize("NFKD", ch) if ord(x) < 128)
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi.append((ch, folded))
    return "".join(src), "".join(dst), tuple(multi)


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _fold(text: Column) -> Column:
    """Accent folding of a text that holds more than ASCII."""
    src, dst, multi = _fold_tables()
    # one literal, folded to a map when the plan is optimised; the separators are private-use characters
    pairs = F.str_to_map(F.lit("\ue000".join(f"{a}\ue001{b}" for a, b in multi)), F.lit("\ue000"), F.lit("\ue001"))

    def rest(one: Column) -> Column:
        # cut between code points: an empty-pattern split would part surrogate pairs
        letters = F.regexp_extract_all(one, F.lit(r"(?s)."), F.lit(0))
        many = F.array_join(F.transform(letters, lambda x: F.coalesce(F.try_element_at(pairs, x), x)), "")
        return F.regexp_replace(many, r"[^\x00-\x7F]", "")

    # the array binds the translated text, which is then tested and used without being made again
    return F.get(F.transform(F.array(F.translate(text, src, dst)), lambda one: F.when(_is_ascii(one), one).otherwise(rest(one))), 0)


def norm_text(c) -> Column:
    """strip -> upper -> accent folding -> drop remaining non-ASCII.

    'São João d'Água' -> "SAO JOAO D'AGUA".  Folds every code point whose
    decomposition holds ASCII.  ASCII text is only stripped and put in upper case;
    what one ``translate`` makes ASCII goes no further; the map of characters
    that fold to several is for the rest.
    """
    text = F.upper(strip_ws(c))
    return F.when(_is_ascii(text), text).otherwise(_fold(text))


def literate_flag(proficiency) -> Column:
    return F.coalesce(_c(proficiency) >= F.lit(LITERACY_CUTOFF), F.lit(False))


def target_flag(indicator) -> Column:
    return F.coalesce(_c(indicator) >= F.lit(GOAL_CUTOFF), F.lit(False))


def status_meta(indicator, goal) -> Column:
    """Three-way goal status, decided on the raw (unrounded) gap."""
    gap = _c(indicator) - _c(goal)
    return (F.when(_c(goal).isNull() | gap.isNull(), F.lit(STATUS_NO_GOAL))
            .when(gap >= 0, F.lit(STATUS_MET))
            .otherwise(F.lit(STATUS_NOT_MET)))
