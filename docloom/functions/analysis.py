"""Tokenizers and analyzers as Column expressions: text in, array of tokens out.

Empty tokens are always dropped; a token's position is its place in the array. The word rule is
"runs of letters and digits", an approximation without Unicode word-break rules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.rows import let

Analyzer = Callable[[Column], Column]

NOT_WORD = r"[^\p{L}\p{N}]+"
NOT_LETTER = r"[^\p{L}]+"
SPACES = r"[\t\n\x0B\f\r ]+"
WORD = r"[\p{L}\p{N}]+"
URL = r"https?://[^\s<>\"']+"
EMAIL = r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+"
HOST = r"[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+"
# Fixed value: longest token before it is cut into chunks.
MAX_TOKEN_LENGTH = 255

# Names of character classes, as regular expression classes.
CHARACTER_CLASSES = {
    "letter": r"\p{L}",
    "digit": r"\p{Nd}",
    "whitespace": r"\s",
    "punctuation": r"\p{P}",
    "symbol": r"\p{S}",
}


def _kept(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def split_tokens(x: Column, regex: str) -> Column:
    return _kept(F.split(x, regex))


def standard(x: Column, max_token_length: int = MAX_TOKEN_LENGTH) -> Column:
    """Runs of letters and digits; longer runs are cut into chunks."""
    n = F.lit(max_token_length)

    def chunks(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(t), n)
        return F.transform(starts, lambda i: F.substring(t, i, n))

    def cut(tokens: Column) -> Column:
        too_long = F.exists(tokens, lambda t: F.length(t) > n)
        return F.when(too_long, F.flatten(F.transform(tokens, chunks))).otherwise(tokens)

    return let(split_tokens(x, NOT_WORD), cut)


def unicode_words(x: Column, language: str = "en") -> Column:
    """Lower-cased words between the word boundaries of Unicode, as the language's rules set them.

    Words keep inner straight apostrophes and decimal points; scripts without spaces are cut by dictionary. Signs
    alone are no words.
    """
    words = F.flatten(F.sentences(x, F.lit(language), F.lit("")))
    return F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: w.rlike(r"[\p{L}\p{N}]"))


def standard_lower(x: Column, max_token_length: int = MAX_TOKEN_LENGTH) -> Column:
    return standard(F.lower(x), max_token_length)


def simple(x: Column) -> Column:
    """Lower-cased runs of letters."""
    return split_tokens(F.lower(x), NOT_LETTER)


def whitespace(x: Column) -> Column:
    return split_tokens(x, SPACES)


def keyword(x: Column) -> Column:
    """The whole value as one token."""
    return _kept(F.array(x))


def without(tokens: Column, words: Iterable[str]) -> Column:
    """Tokens outside a word list; the list becomes a hash set in the generated code."""
    listed = list(words)
    return F.filter(tokens, lambda t: ~t.isin(listed)) if listed else tokens


def stop(x: Column, words: Iterable[str]) -> Column:
    return without(simple(x), words)


def _flagged(pattern: str, flags: str) -> str:
    """Flag names such as ``CASE_INSENSITIVE|DOTALL`` as an inline prefix."""
    letters = {
        "CASE_INSENSITIVE": "i", "MULTILINE": "m", "DOTALL": "s", "COMMENTS": "x",
        "UNICODE_CASE": "u", "UNIX_LINES": "d",
    }
    inline = "".join(letters[f.strip()] for f in flags.split("|") if f.strip())
    return f"(?{inline}){pattern}" if inline else pattern


def pattern(
    x: Column, regex: str = r"\W+", group: int = -1, flags: str = "", lowercase: bool = False
) -> Column:
    """Text between the matches, or with ``group`` >= 0 that group of every match."""
    text = F.lower(x) if lowercase else x
    regex = _flagged(regex, flags)
    if group < 0:
        return split_tokens(text, regex)
    return _kept(F.regexp_extract_all(text, F.lit(regex), F.lit(group)))


def simple_pattern(x: Column, regex: str) -> Column:
    return pattern(x, regex, 0)


def simple_pattern_split(x: Column, regex: str) -> Column:
    return pattern(x, regex)


def _runs(x: Column, token_chars: Iterable[str]) -> Column:
    classes = "".join(CHARACTER_CLASSES[c] for c in token_chars)
    return split_tokens(x, f"[^{classes}]+") if classes else keyword(x)


def grams(run: Column, min_gram: int, max_gram: int) -> Column:
    """All substrings of ``min_gram`` to ``max_gram`` characters, by start, then by length."""
    starts = F.sequence(F.lit(1), F.length(run) - min_gram + 1)

    def at(start: Column) -> Column:
        longest = F.least(F.lit(max_gram), F.length(run) - start + 1)
        return F.transform(
            F.sequence(F.lit(min_gram), longest), lambda n: F.substring(run, start, n)
        )

    found = F.flatten(F.transform(starts, at))
    return F.when(F.length(run) >= min_gram, found).otherwise(F.array().cast("array<string>"))


def prefixes(run: Column, min_gram: int, max_gram: int) -> Column:
    """Prefixes of ``min_gram`` to ``max_gram`` characters."""
    longest = F.least(F.lit(max_gram), F.length(run))
    found = F.transform(F.sequence(F.lit(min_gram), longest), lambda n: F.left(run, n))
    return F.when(F.length(run) >= min_gram, found).otherwise(F.array().cast("array<string>"))


def ngram(x: Column, min_gram: int, max_gram: int, token_chars: Iterable[str] = ()) -> Column:
    runs = _runs(x, token_chars)
    return F.flatten(F.transform(runs, lambda r: grams(r, min_gram, max_gram)))


def edge_ngram(x: Column, min_gram: int, max_gram: int, token_chars: Iterable[str] = ()) -> Column:
    runs = _runs(x, token_chars)
    return F.flatten(F.transform(runs, lambda r: prefixes(r, min_gram, max_gram)))


def char_group(x: Column, tokenize_on: Iterable[str]) -> Column:
    """Split on single characters and on named character classes."""
    parts = [
        CHARACTER_CLASSES[c] if c in CHARACTER_CLASSES else re.escape(c) for c in tokenize_on
    ]
    return split_tokens(x, "[" + "".join(parts) + "]+")


def path_hierarchy(
    x: Column, delimiter: str = "/", replacement: str | None = None, skip: int = 0,
    reverse: bool = False,
) -> Column:
    """Growing prefixes of a path (suffixes with ``reverse``), without the first ``skip`` steps."""
    joint = delimiter if replacement is None else replacement
    steps = F.split(x, re.escape(delimiter))
    kept = F.greatest(F.size(steps) - skip, F.lit(0))
    # Counted from the end with ``reverse``: the steps to skip are then the last ones.
    used = F.slice(steps, F.lit(1) if reverse else F.lit(skip + 1), kept)

    def joined(i: Column) -> Column:
        part = F.slice(used, i, F.size(used) - i + 1) if reverse else F.slice(used, F.lit(1), i)
        return F.array_join(part, joint)

    counted = F.sequence(F.lit(1), F.size(used))
    return F.when(
        F.size(used) > 0, _kept(F.transform(counted, joined))
    ).otherwise(F.array().cast("array<string>"))


def url_email(x: Column) -> Column:
    """Words, with URLs and e-mail addresses kept whole."""
    return _kept(F.regexp_extract_all(x, F.lit(f"{URL}|{EMAIL}|{WORD}"), F.lit(0)))


def classic(x: Column) -> Column:
    """Words, with e-mail addresses and host names kept whole."""
    return _kept(F.regexp_extract_all(x, F.lit(f"{EMAIL}|{HOST}|{WORD}"), F.lit(0)))


def fingerprint(x: Column, separator: str = " ", max_output_size: int = 255) -> Column:
    """Distinct lower-cased words in order, joined; empty when longer than allowed."""
    joined = F.array_join(F.sort_array(F.array_distinct(standard_lower(x))), separator)
    return let(joined, lambda j: F.when(F.length(j) <= max_output_size, j).otherwise(""))


# Our own short stop word lists by name; the plain names are those of the Spark lists.
NAMED_STOP_WORDS = {
    "english_short": ["a", "and", "by", "for", "in", "is", "of", "on", "that", "the", "to", "was", "with"],
    "french_short": ["de", "des", "du", "en", "et", "la", "le", "les", "pas", "que", "qui", "un", "une"],
    "german_short": ["das", "der", "die", "ein", "ist", "mit", "nicht", "und", "von", "zu"],
    "spanish_short": ["con", "de", "del", "el", "en", "es", "la", "los", "no", "para", "por", "que", "y"],
}


def named_stop_words(language: str) -> list[str]:
    """A stop word list by name: one of ours, or one that Spark ships."""
    if language in NAMED_STOP_WORDS:
        return NAMED_STOP_WORDS[language]
    from pyspark import SparkContext
    from pyspark.ml.feature import StopWordsRemover

    SparkContext.getOrCreate()  # the lists are read by the JVM
    return StopWordsRemover.loadDefaultStopWords(language)


def stop_words(
    listed: Iterable[str] = (), named: str | None = None, path_words: Iterable[str] | None = None
) -> list[str]:
    """Which list holds when several are given: from a path, then named, then listed."""
    if path_words is not None:
        return list(path_words)
    return named_stop_words(named) if named else list(listed)


def language(x: Column, words: Iterable[str]) -> Column:
    """Lower-cased words without the language's stop words; no stemming."""
    return without(standard_lower(x), words)


# Building blocks of custom analyzers, by name.
CHARACTER_FILTERS: dict[str, Callable[..., Analyzer]] = {
    "pattern_replace": lambda regex, to="": lambda x: F.regexp_replace(x, regex, to),
}
TOKENIZERS: dict[str, Callable[..., Analyzer]] = {
    "standard": lambda **p: lambda x: standard(x, **p),
    "letter": lambda: lambda x: split_tokens(x, NOT_LETTER),
    "whitespace": lambda: whitespace,
    "keyword": lambda: keyword,
    "pattern": lambda **p: lambda x: pattern(x, **p),
    "simple_pattern": lambda **p: lambda x: simple_pattern(x, **p),
    "simple_pattern_split": lambda **p: lambda x: simple_pattern_split(x, **p),
    "ngram": lambda **p: lambda x: ngram(x, **p),
    "edge_ngram": lambda **p: lambda x: edge_ngram(x, **p),
    "char_group": lambda **p: lambda x: char_group(x, **p),
    "path_hierarchy": lambda **p: lambda x: path_hierarchy(x, **p),
    "uax_url_email": lambda: url_email,
    "classic": lambda: classic,
}
TOKEN_FILTERS: dict[str, Callable[..., Analyzer]] = {
    "lowercase": lambda: lambda ts: F.transform(ts, F.lower),
    "uppercase": lambda: lambda ts: F.transform(ts, F.upper),
    "trim": lambda: lambda ts: _kept(F.transform(ts, F.trim)),
    "stop": lambda words: lambda ts: without(ts, words),
    "unique": lambda: F.array_distinct,
    "length": lambda least=0, most=2_147_483_647: lambda ts: F.filter(
        ts, lambda t: F.length(t).between(least, most)
    ),
    "pattern_replace": lambda regex, to="": lambda ts: _kept(
        F.transform(ts, lambda t: F.regexp_replace(t, regex, to))
    ),
}

Step = tuple[str, dict]


def custom(
    tokenizer: Step, char_filters: Iterable[Step] = (), filters: Iterable[Step] = ()
) -> Analyzer:
    """Compose character filters, a tokenizer and token filters, each ``(name, parameters)``."""
    steps = [CHARACTER_FILTERS[name](**p) for name, p in char_filters]
    steps.append(TOKENIZERS[tokenizer[0]](**tokenizer[1]))
    steps += [TOKEN_FILTERS[name](**p) for name, p in filters]

    def analyze(x: Column) -> Column:
        for step in steps:
            x = step(x)
        return x

    return analyze
