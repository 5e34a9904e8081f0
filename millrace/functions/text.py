"""Column expressions for text and markup."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[ \\t\\r\\n]+"

# Character entities decoded by strip_markup, ampersand last.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]


def page_title(html: Column) -> Column:
    """First ``<h1>``, else ``<title>``, else empty; markup inside is stripped."""
    heading = F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1)
    return strip_markup(F.when(heading != "", heading).otherwise(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)))


def strip_markup(html: Column) -> Column:
    """Readable text: scripts, styles, comments and tags out, entities decoded, spaces collapsed."""
    text = F.regexp_replace(html, "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, "(?s)<[^>]+>", " ")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, SPACE, " "))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_chunks(text: Column, size: int, overlap: int) -> Column:
    """Array of texts of ``size`` words, each starting ``size - overlap`` words after the last.

    The last chunk is the first one that reaches the end, so no chunk lies inside another.
    """
    stride = size - overlap

    def cut(tokens: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil((F.size(tokens) - overlap) / F.lit(float(stride)))).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(tokens, i * stride + 1, size), " "))

    return bind(words(text), cut)


def section_chunks(html: Column, cap: int, least: int) -> Column:
    """Chunks that follow headings and paragraphs.

    Blocks are split at heading and paragraph tags; neighbours merge while they stay within
    ``cap`` words; longer blocks are cut by words; chunks under ``least`` words are dropped.
    """
    body = F.regexp_replace(html, "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    blocks = F.transform(F.split(body, "(?i)(?=<h[1-6][ >])|(?=<p[ >])"), strip_markup)
    pieces = F.flatten(F.transform(F.filter(blocks, lambda b: b != ""), lambda b: word_chunks(b, cap, 0)))
    counted = F.transform(pieces, lambda p: F.struct(p.alias("text"), F.size(words(p)).alias("n")))
    # fold: finished chunks, and the chunk being filled with its word count
    item = "struct<text:string,n:int>"
    start = F.struct(F.array().cast(f"array<{item}>").alias("done"), F.lit("").alias("text"), F.lit(0).alias("n"))

    def add(acc: Column, piece: Column) -> Column:
        grown = F.struct(acc["done"].alias("done"), F.trim(F.concat_ws(" ", acc["text"], piece["text"])).alias("text"), (acc["n"] + piece["n"]).alias("n"))
        closed = F.struct(F.array_append(acc["done"], F.struct(acc["text"], acc["n"])).alias("done"), piece["text"].alias("text"), piece["n"].alias("n"))
        return F.when((acc["n"] == 0) | (acc["n"] + piece["n"] <= cap), grown).otherwise(closed)

    chunks = F.aggregate(counted, start, add, lambda acc: F.array_append(acc["done"], F.struct(acc["text"], acc["n"])))
    return F.transform(F.filter(chunks, lambda c: c["n"] >= least), lambda c: c["text"])


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two token sets; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), union), F.lit(0.0))


def extract_fields(text: Column, rules: Mapping[str, str]) -> Column:
    """Struct of the first match of each named pattern (null when there is none)."""
    return F.struct(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")).alias(n) for n, p in rules.items()])


def first_rule(text: Column, rules: Mapping[str, str], default: str) -> Column:
    """Label of the first pattern found in the text."""
    label = None
    for name, pattern in rules.items():
        hit = F.rlike(text, F.lit(pattern))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(default)
