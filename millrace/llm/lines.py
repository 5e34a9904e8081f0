"""Line-first quality rules: judge each line, drop the failures, reject documents that lose too much text.

Words are separated by ASCII white space; a line is what stands between newlines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_slices, with_text

#: Endings of a sentence at the end of a line, words that only part items of a menu, and phrases of page furniture (lower case).
TERMINAL = ".!?:;\"')]…”»"
SEPARATORS = ("|", "»", ">", "/", "•")
BOILERPLATE = ("all rights reserved", "click here", "cookie", "javascript", "log in", "lorem ipsum", "privacy policy", "sign in", "subscribe", "terms of use")
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: A line fails on this many menu separators; on one symbol per so many characters; on upper case in more than this share
#: of its ASCII letters (of 10 at least); on more than this share of words equal to the word before.
MIN_SEPARATORS, CHARS_PER_SYMBOL, MAX_UPPER, MAX_ECHO = 2, 10, 0.5, 0.3
#: A repeated line of at least so many words fails from its second time on.
MIN_REPEATED_WORDS = 3
#: A document is rejected when failed lines hold more than this share of the characters of its words.
MAX_LOST = 0.3

_UPPER, _LETTERS = bytes(range(65, 91)), bytes((*range(65, 91), *range(97, 123)))
_BOILER = re.compile("|".join(BOILERPLATE))
_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
#: What ``str.split`` takes for white space beyond the six ASCII characters.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def split_words(text: str) -> list[str]:
    """Words between ASCII white space (other Unicode space belongs to words)."""
    return [w.decode() for w in text.encode().split()] if _ODD_SPACE.search(text) else text.split()


def has_sentence(words: list[str]) -> bool:
    """Whether the line ends like a sentence or has one that ends within it."""
    return words[-1][-1] in TERMINAL or any(w[-1] in ".!?" for w in words)


def is_menu(words: list[str]) -> bool:
    return sum(map(words.count, SEPARATORS)) >= MIN_SEPARATORS


def is_furniture(line: str) -> bool:
    return _BOILER.search(line.translate(_ASCII_LOWER)) is not None


def is_symbolic(line: str, chars: int) -> bool:
    return CHARS_PER_SYMBOL * sum(map(line.count, SYMBOLS)) > chars


def is_shouted(line: str) -> bool:
    data = line.encode()
    upper, letters = (len(data) - len(data.translate(None, drop)) for drop in (_UPPER, _LETTERS))
    return letters >= 10 and upper > MAX_UPPER * letters


def is_echo(words: list[str]) -> bool:
    return sum(map(eq, words, words[1:])) > MAX_ECHO * len(words)


#: Rules on (line, its words, characters in its words); a line fails if any holds.
RULES: dict[str, Callable[[str, list[str], int], bool]] = {
    "punctuation": lambda line, words, chars: not has_sentence(words),
    "menu": lambda line, words, chars: is_menu(words),
    "boilerplate": lambda line, words, chars: is_furniture(line),
    "symbols": lambda line, words, chars: is_symbolic(line, chars),
    "shouting": lambda line, words, chars: is_shouted(line),
    "echo": lambda line, words, chars: is_echo(words),
}


def repeated_words(words: list[str], span: int = 5) -> int:
    """Words that lie in a window of ``span`` words found at least twice."""
    if len(words) <= span:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    starts = len(ids) - span + 1
    names, size = ids[:starts], len(numbers)
    for step in range(1, span):  # number the distinct windows of step + 1 words: exact, whatever the vocabulary
        names = names * len(numbers) + ids[step:step + starts]
        size *= len(numbers)
        if size * len(numbers) >= 1 << 62:
            names = np.unique(names, return_inverse=True)[1]
            size = int(names.max()) + 1
    _, names, counts = np.unique(names, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    twice = np.flatnonzero(counts[names] > 1)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + span, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def judge(text: str) -> dict:
    """Counts and verdicts of one text, with what is left of it."""
    seen: set[str] = set()
    left, failed = [], dict.fromkeys(RULES, 0) | {"repeated": 0}
    n_words = word_chars = n_dup = lost = n_lines = 0
    words_all: list[str] = []
    split = split_words if _ODD_SPACE.search(text) else str.split
    for line in text.split("\n"):
        words = split(line)
        if not words:
            left.append(line)
            continue
        n_lines += 1
        chars = sum(map(len, words))
        words_all += words
        word_chars += chars
        again = line in seen
        n_dup += again
        seen.add(line)
        why = [name for name, rule in RULES.items() if rule(line, words, chars)]
        if again and len(words) >= MIN_REPEATED_WORDS:
            why.append("repeated")
        for name in why:
            failed[name] += 1
        if why:
            lost += chars
        else:
            left.append(line)
    n_words, n_repeat = len(words_all), repeated_words(words_all)
    base_failed = n_words < 10 or 100 * n_repeat > 20 * n_words
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
            "base_failed": base_failed, "kept": not base_failed and lost <= MAX_LOST * word_chars, "n_lines": n_lines, "lost_chars": lost,
            **{f"failed_{name}": n for name, n in failed.items()}, "clean_text": "\n".join(left)}


FAILED = [f"failed_{name}" for name in (*RULES, "repeated")]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "lost_chars", *FAILED]
FIELDS = {**dict.fromkeys(COUNTS, "long"), "base_failed": "boolean", "kept": "boolean", "clean_text": "string"}
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def line_rules(documents: DataFrame) -> DataFrame:
    """One row per row: doc_id, counts, base_failed, kept and clean_text (the text without its failed lines).

    A null text has no words, so it fails; empty texts likewise. Blank lines are never judged. Repeated rows give
    repeated results, an empty table none; other columns are not read. Lines are judged one by one; the
    repeated-window count holds one number per word of one text.
    """

    def work(batch: pa.RecordBatch) -> dict:
        rows = [judge(text) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), **{k: pa.array([r[k] for r in rows], ARROW[kind]) for k, kind in FIELDS.items()}}

    return map_slices(with_text(documents), work, "doc_id long, " + ", ".join(f"{k} {kind}" for k, kind in FIELDS.items()))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPACE = r"[\x20\x09-\x0D]+"
_LAST_CHAR = f"right(words[-1], 1) IN ({', '.join(map(_quoted, TERMINAL))})"
_SQL_RULES = {
    "punctuation": f"NOT {_LAST_CHAR} AND len(list_filter(words, lambda w: right(w, 1) IN ('.', '!', '?'))) = 0",
    "menu": f"len(list_filter(words, lambda w: w IN ({', '.join(map(_quoted, SEPARATORS))}))) >= {MIN_SEPARATORS}",
    "boilerplate": f"regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{'|'.join(BOILERPLATE)}')",
    "symbols": rf"{CHARS_PER_SYMBOL} * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > chars",
    "shouting": "letters >= 10 AND 2 * upper > letters",
    "echo": f"len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > {MAX_ECHO} * len(words)",
}
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM d),
worded AS (SELECT *, list_filter(regexp_split_to_array(line, '{_SPACE}'), lambda w: w <> '') AS words FROM cut),
lined AS (SELECT *, list_sum(list_transform(words, lambda w: length(w))) AS chars, length(line) - length(regexp_replace(line, '[A-Z]', '', 'g')) AS upper,
                 length(line) - length(regexp_replace(line, '[A-Za-z]', '', 'g')) AS letters,
                 row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) > 1 AS again
          FROM worded WHERE len(words) > 0),
judged AS (SELECT *, {', '.join(f'({rule}) AS r_{name}' for name, rule in _SQL_RULES.items())}, again AND len(words) >= {MIN_REPEATED_WORDS} AS r_repeated FROM lined),
per_doc AS (SELECT doc_id, sum(len(words)) AS n_words, sum(chars) AS word_chars, count(*) FILTER (again) AS n_dup_lines, count(*) AS n_lines,
                   coalesce(sum(chars) FILTER ({' OR '.join(f'r_{n}' for n in (*_SQL_RULES, 'repeated'))}), 0) AS lost_chars,
                   {', '.join(f'count(*) FILTER (r_{n}) AS failed_{n}' for n in (*_SQL_RULES, 'repeated'))}
            FROM judged GROUP BY doc_id),
placed AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, i) AS pos, w
           FROM (SELECT doc_id, line_no, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM lined)),
windows AS (SELECT doc_id, pos, w || ' ' || lead(w, 1) OVER s || ' ' || lead(w, 2) OVER s || ' ' || lead(w, 3) OVER s || ' ' || lead(w, 4) OVER s AS g
            FROM placed WINDOW s AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows WHERE g IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT pos + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) WHERE n > 1 GROUP BY doc_id),
joined AS (SELECT d.doc_id, text, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_dup_lines, 0) AS n_dup_lines,
                  coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(lost_chars, 0) AS lost_chars,
                  {', '.join(f'coalesce(failed_{n}, 0) AS failed_{n}' for n in (*_SQL_RULES, 'repeated'))}
           FROM d LEFT JOIN per_doc USING (doc_id) LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM joined)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
       n_dup_lines, n_repeat_words, n_lines, lost_chars::BIGINT AS lost_chars, {', '.join(f'failed_{n}' for n in (*_SQL_RULES, 'repeated'))},
       base_failed, NOT base_failed AND lost_chars <= {MAX_LOST} * word_chars AS kept
FROM based
"""
