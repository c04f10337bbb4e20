"""Text cleaning and tokenising expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The English stop words of Spark's StopWordsRemover, in its order.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't "
    "wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's "
    "what's when's where's who's why's would"
).split()

PUNCTUATION = string.punctuation

# What is taken out of prose, tweets, item titles and genres.
# The first is [^a-zA-Z\s] as runs of ranges: Java tests a negated class of several parts five times
# more slowly, character by character.
NOT_PROSE = r"[\x00-\x08\x0E-\x1F!-@\[-`{-\x{10FFFF}]+"
NOT_TWEET = "[^a-zA-Z+ ]"
NOT_TITLE = "[^a-zA-Z0-9 ]"
NOT_GENRES = "[^a-zA-Z0-9- ]"


def clean_prose(c: Column) -> Column:
    """Lower-case letters and whitespace; runs of whitespace become one space."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, NOT_PROSE, ""), r"\s\s+", " "))


def squash(c: Column) -> Column:
    """Remove all whitespace, which makes the text a single token."""
    return F.regexp_replace(c, r"\s+", "")


def clean_tweet(c: Column) -> Column:
    """Lower-case letters, plus signs and spaces."""
    return F.lower(F.regexp_replace(c, NOT_TWEET, ""))


def clean_item_title(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, NOT_TITLE, ""))


def clean_genres(c: Column) -> Column:
    """Pipes and other separators become spaces; hyphens stay inside names."""
    return F.lower(F.regexp_replace(c, NOT_GENRES, " "))


def strip_markup(c: Column) -> Column:
    """Newlines to spaces, backslashes and tags out, punctuation to spaces, lower case.

    Tags go before punctuation, while their angle brackets still exist.
    """
    flat = F.regexp_replace(F.translate(c, "\n\\", " "), "<.*?>", "")
    return F.translate(F.lower(flat), PUNCTUATION, " " * len(PUNCTUATION))


def tokens(c: Column, keep_empty: bool = False) -> Column:
    """Lower-case and split on each whitespace character; NULL text has no tokens.

    ``keep_empty`` keeps empty strings at the front and inside, as ``Tokenizer`` does.
    """
    text = F.lower(F.coalesce(c, F.lit("")))
    if not keep_empty:
        return F.array_remove(F.split(text, r"\s"), "")
    stem = F.regexp_replace(text, r"\s+$", "")
    blank = (stem == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(stem, r"\s"))


def content_tokens(c: Column, keep_empty: bool = False) -> Column:
    """Tokens without stop words."""
    return F.filter(tokens(c, keep_empty), lambda t: ~t.isin(STOP_WORDS))


def drop_words(words: Column, unwanted: list[str] | None = None) -> Column:
    """Remove listed words from a token array; the default also removes '' and ' '."""
    unwanted = [*STOP_WORDS, "", " "] if unwanted is None else unwanted
    return F.filter(words, lambda t: ~t.isin(unwanted))


def western_words(c: Column) -> Column:
    """Runs of the Latin letters a-z and à-ÿ; empty strings can stand at the ends."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-zà-ÿ]+")


def english_words(c: Column) -> Column:
    """Runs of the letters a-z; empty strings can stand at the ends."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]+")
