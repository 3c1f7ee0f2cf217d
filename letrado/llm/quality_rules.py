"""Line-first quality rules (operator 1).

Every line of a text is judged on its own by punctuation, navigation and
boilerplate rules.  Failing lines are removed, and a document whose removed
lines hold too large a share of its word characters is rejected.  Rejection
also follows from the base counts (too few words, too many words in repeated
five-word windows).  Row-wise: no shuffle, memory bounded by one batch.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, n_lines bigint, n_punctuation_lines bigint, n_navigation_lines bigint, "
          "n_boilerplate_lines bigint, removed_chars bigint, kept boolean, clean_text string")

# Marks that end a word in decoration rather than in prose, and the characters that end a sentence.
MARKS = "!?*#$%&<>|~^=_+"
SENTENCE_ENDS = ".!?…。！？"
BARS = ("|", "»", "›", "•", "·", "/")
PHRASES = ("all rights reserved", "licensed under", "creative commons", "privacy policy", "terms of use",
           "terms of service", "terms and conditions", "cookie policy", "accept cookies", "uses cookies",
           "enable javascript", "javascript is disabled", "subscribe to our newsletter", "sign up for our newsletter",
           "skip to content", "back to top", "powered by", "lorem ipsum",
           "released under the", "distributed under the", "mit license", "apache license", "no rights reserved",
           # German, French and Spanish; without their accented ends, as only A-Z is put in lower case
           "alle rechte vorbehalten", "lizenziert unter", "unter der lizenz", "nutzungsbedingungen", "verwendet cookies",
           "newsletter abonnieren", "javascript aktivieren",
           "tous droits r", "sous licence", "conditions d'utilisation", "politique de confidentialit", "utilise des cookies",
           "activer javascript", "mentions l\u00e9gales",
           "todos los derechos reservados", "bajo licencia", "bajo la licencia", "condiciones de uso", "tica de privacidad",
           "utiliza cookies", "habilitar javascript")

_MARKED = re.compile(rb"[!?*#$%&<>|~^=_+]{2,}(?![^\x20\x09-\x0D])")
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)).encode())
_ENDS = re.compile("|".join(map(re.escape, SENTENCE_ENDS)).encode())
_BARS = {b.encode() for b in BARS}


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; the defaults are the production values."""

    marked_words: int = 5        # punctuation: fails when over 1 of so many words ends in two or more marks
    bar_words: int = 8           # navigation: fails when 1 of so many words or more is a separator ...
    least_bars: int = 2          # ... and there are so many of them
    phrase_words: int = 30       # boilerplate: a line of at most so many words that has a stock phrase
    most_removed: float = 0.5    # a document that loses a larger share of its word characters is rejected


def judge_line(line: bytes, words: list[bytes], rules: LineRules) -> str | None:
    """The rule that a line with words fails, or None."""
    n = len(words)
    if not _ENDS.search(line) or rules.marked_words * len(_MARKED.findall(line)) > n:
        return "punctuation"
    bars = sum(w in _BARS for w in words)
    if bars >= rules.least_bars and rules.bar_words * bars >= n:
        return "navigation"
    if n <= rules.phrase_words and _PHRASE.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: list) -> int:
    """Words inside five-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered[i:i + 5] = b"\1\1\1\1\1"
    return sum(covered)


def judge_text(text: str | None, rules: LineRules = LineRules()) -> dict:
    """All columns of SCHEMA for one text; null counts as a text without words."""
    text = text or ""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, GAPS))
    repeat = repeated_words(words)
    seen: set[str] = set()
    duplicates = n_lines = removed = 0
    failed = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    kept_lines = []
    for line in text.split("\n"):
        raw = line.encode()
        line_words = raw.split()
        if not line_words:
            kept_lines.append(line)
            continue
        n_lines += 1
        if line in seen:
            duplicates += 1
        seen.add(line)
        rule = judge_line(raw, line_words, rules)
        if rule is None:
            kept_lines.append(line)
        else:
            failed[rule] += 1
            removed += len(line) - sum(map(line.count, GAPS))
    n = len(words)
    base_failed = n < 10 or 100 * repeat > 20 * n
    return {"n_words": n, "word_chars": word_chars, "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": duplicates, "n_repeat_words": repeat, "base_failed": base_failed, "n_lines": n_lines,
            "n_punctuation_lines": failed["punctuation"], "n_navigation_lines": failed["navigation"],
            "n_boilerplate_lines": failed["boilerplate"], "removed_chars": removed,
            "kept": not base_failed and removed <= rules.most_removed * word_chars,
            "clean_text": "\n".join(kept_lines)}


def apply_quality_rules(df: DataFrame, text_col: str = "text", out_col: str = "quality_rules",
                        rules: LineRules = LineRules()) -> DataFrame:
    """``df`` with the struct ``out_col`` (fields of SCHEMA).

    Null and empty texts have no words: base_failed, not kept, empty clean
    text.  A blank line is neither judged nor removed.  Repeated rows are
    judged alike; an existing ``out_col`` is replaced; an empty table stays
    empty.  Texts are judged whole, whatever their length.
    """

    @F.arrow_udf(SCHEMA)
    def judge(text: pa.Array) -> pa.Array:
        rows = [judge_text(t, rules) for t in text.to_pylist()]
        return pa.array(rows, type=ARROW_SCHEMA)

    return df.withColumn(out_col, judge(F.col(text_col)))


ARROW_SCHEMA = pa.struct([(name, {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[kind])
                          for name, kind in (field.split() for field in SCHEMA.split(", "))])

_GAP = r"[\x20\x09-\x0D]+"
_PHRASE_SQL = "|".join(p.replace("'", "''") for p in PHRASES)
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
five AS (SELECT rid, p, CASE WHEN lead(p, 4) OVER o IS NOT NULL THEN
           struct_pack(a := word, b := lead(word) OVER o, c := lead(word, 2) OVER o, d := lead(word, 3) OVER o,
                       e := lead(word, 4) OVER o) END AS win
         FROM pos WINDOW o AS (PARTITION BY rid ORDER BY p)),
hit AS (SELECT rid, p, win IS NOT NULL AND count(*) OVER (PARTITION BY rid, win) > 1 AS h FROM five),
cover AS (SELECT rid, max(CASE WHEN h THEN 1 ELSE 0 END)
                 OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM hit),
rep AS (SELECT rid, sum(c) AS n_repeat FROM cover GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM ln),
judged AS (SELECT rid, line, len(ws) AS n, length(regexp_replace(line, '{_GAP}', '', 'g')) AS chars,
             NOT regexp_matches(line, '[{SENTENCE_ENDS}]')
             OR 5 * len(list_filter(ws, lambda x: regexp_matches(x, '[!?*#$%&<>|~^=_+]{{2,}}$'))) > len(ws) AS bad_marks,
             len(list_filter(ws, lambda x: x IN {BARS})) AS bars,
             regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{_PHRASE_SQL}') AS phrase
           FROM lw WHERE len(ws) > 0),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup,
            sum(CASE WHEN bad_marks OR (bars >= 2 AND 8 * bars >= n) OR (n <= 30 AND phrase) THEN chars ELSE 0 END)
              AS removed
          FROM judged GROUP BY rid),
base AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '{_GAP}', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
           coalesce(removed, 0) AS removed
         FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND removed <= 0.5 * word_chars AS kept
FROM base
"""
