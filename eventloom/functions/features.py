"""Content features of an event, as columns over its title and description."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .text import any_word, slug, strip, unicode_pattern
from .words import words_in, words_near


def present(*items: Column) -> Column:
    """Array of the non-NULL items."""
    return F.array_compact(F.array(*items))


def said(col: Column) -> Column:
    """NULL text counts as empty."""
    return F.coalesce(col, F.lit(""))


def starting(words: list[str]) -> str:
    """Look-ahead for the first two letters of some word: most places of a text fail here, before any word is tried."""
    firsts, seconds = ("".join(sorted({word[i] for word in words})) for i in range(2))
    return f"(?=[{firsts}][{seconds}])"


def _time_patterns() -> list[str]:
    # The only capitalised words in these patterns are the months one of them begins with.
    months = [re.findall("[A-Z][a-z]{2}", p) for p in vocab.TIME_PATTERNS]
    return [(starting(names) if names else "") + unicode_pattern(p) for p, names in zip(vocab.TIME_PATTERNS, months)]


def time_mentions(text: Column) -> Column:
    """All matches of each time pattern, pattern by pattern, joined by ', '."""
    return F.array_join(F.concat(*[F.regexp_extract_all(text, F.lit(p), 0) for p in _time_patterns()]), ", ")


def _location_pattern() -> str:
    words = vocab.LOCATION_KEYWORDS
    return unicode_pattern(f"(?iu){starting(words)}(?:{'|'.join(words)}){vocab.LOCATION_TAIL}")


def location_mentions(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(_location_pattern()), 0), ", ")


def names_time(text: Column) -> Column:
    """Whether ``time_mentions`` finds any; the text is read up to the first. A range of hours ends with an hour, so it needs no test."""
    hour, _, date, numbers = _time_patterns()
    return text.rlike(hour) | text.rlike(numbers) | text.rlike(date)


def names_place(text: Column) -> Column:
    """Whether ``location_mentions`` finds any."""
    return text.rlike(_location_pattern())


def near_mentions(text: Column) -> Column:
    """The words that mentions of times and places can be made of; the functions above find in them what they find in the text.

    A time has a word before its first number (the month) or three after it, a place two after its keyword. One pass in Python workers
    leaves so little that the patterns, each of which reads its text letter by letter, cost next to nothing.
    """
    return words_near(text, (1, 3), vocab.LOCATION_KEYWORDS, (0, 2))


_PLAIN_TAGS = [w for words in vocab.EVENT_KEYWORDS.values() for w in words] + vocab.LOCATION_KEYWORDS + vocab.WEEKDAYS
#: All words that types and tags are told by.
KEYWORDS = list(dict.fromkeys(_PLAIN_TAGS + [w for words in vocab.DAYPART_WORDS.values() for w in words]))
#: Those and the words that details are told by.
ALL_WORDS = list(dict.fromkeys(KEYWORDS + [w for words in vocab.DETAIL_WORDS for w in words]))


def full_text(title: Column, description: Column) -> Column:
    return F.lower(F.concat(said(title), F.lit(" "), said(description)))


def keywords(title: Column, description: Column, one_pass: bool = False) -> Column:
    """Those of ``KEYWORDS`` that title or description hold, in any case. Never NULL.

    By ``one_pass`` an automaton in Python workers reads each text once; else the JVM reads it once a word.
    """
    text = full_text(title, description)
    if one_pass:
        return words_in(text, KEYWORDS)
    known = F.array(*[F.lit(word) for word in KEYWORDS])
    # A text that a lambda makes its argument is computed once, not once a word.
    return F.transform(F.array(text), lambda t: F.filter(known, lambda word: F.contains(t, word)))[0]


def _any_of(found: Column, words: list[str]) -> Column:
    return F.arrays_overlap(found, F.array(*[F.lit(word) for word in words]))


def event_types(found: Column) -> Column:
    """Keyword groups with a word in ``found``, in fixed order, joined by ', '. Never NULL."""
    labels = [
        F.when(_any_of(found, words), F.lit(group.replace("_", " ").title()))
        for group, words in vocab.EVENT_KEYWORDS.items()
    ]
    joined = F.concat_ws(", ", *labels)
    default = F.lit(vocab.DEFAULT_EVENT_TYPE)
    return F.coalesce(F.when(joined != "", joined), default)


def tags(found: Column, most: int = vocab.MOST_TAGS) -> Column:
    """First ``most`` tags in alphabetical order: groups, keywords, places, dayparts and weekdays with a word in ``found``."""
    plain = F.array_intersect(F.array(*[F.lit(word) for word in _PLAIN_TAGS]), found)
    groups = present(
        *[F.when(_any_of(found, words), F.lit(name)) for name, words in (vocab.EVENT_KEYWORDS | vocab.DAYPART_WORDS).items()]
    )
    return F.slice(F.sort_array(F.array_union(plain, groups)), 1, most)


def missing_details(description: Column, found: Column | None = None) -> Column:
    """``found`` are those of ``ALL_WORDS`` that the description holds, where they are known."""
    if found is not None:
        pairs = zip(vocab.DETAIL_WORDS, vocab.DETAIL_CHECKS)
        return present(*[F.when(~_any_of(found, words), F.lit(sentence)) for words, (_, sentence) in pairs])
    # Lower-cased once as the argument of a lambda; under conditions it would be lower-cased once a word.
    checks = [(words, sentence) for words, (_, sentence) in zip(vocab.DETAIL_WORDS, vocab.DETAIL_CHECKS)]
    lacking = lambda text: present(*[F.when(~any_word(text, words), F.lit(line)) for words, line in checks])
    return F.transform(F.array(F.lower(said(description))), lacking)[0]


def title_suggestions(title: Column, no_number: str = vocab.TITLE_NO_DATE) -> Column:
    text = said(title)
    length = (
        F.when(F.length(text) < 5, F.lit(vocab.TITLE_SHORT)).when(F.length(text) > 70, F.lit(vocab.TITLE_LONG))
    )
    return present(length, F.when(~text.rlike(r"\p{Nd}"), F.lit(no_number)))


def description_suggestions(description: Column, near: Column | None = None, found: Column | None = None) -> Column:
    """Mentions are looked for up to the first, not taken out: who wants the sentences alone does not pay for all mentions.

    ``near`` are the description's ``near_mentions``, ``found`` its words, as in ``missing_details``, where they are known.
    """
    text = said(description)
    near = text if near is None else near
    basics = present(
        F.when(F.length(text) < 100, F.lit(vocab.DESCRIPTION_SHORT)),
        F.when(~names_time(near), F.lit(vocab.DESCRIPTION_NO_TIME)),
        F.when(~names_place(near), F.lit(vocab.DESCRIPTION_NO_PLACE)),
    )
    return F.concat(basics, missing_details(description, found))


def seo_score(title: Column, description: Column, n_title: Column, n_description: Column) -> Column:
    title_length, description_length = F.length(said(title)), F.length(said(description))
    for_title = (
        F.when(title_length == 0, 30).when(title_length < 5, 20).when(title_length > 70, 10).otherwise(0)
    )
    for_description = F.when(description_length == 0, 30).when(description_length < 100, 15).otherwise(0)
    score = F.lit(100) - for_title - for_description - (n_title + n_description) * 5
    return F.coalesce(F.least(F.lit(100), F.greatest(F.lit(0), score)), F.lit(0))


def enhanced_text(
    description: Column, when_text: Column, where_text: Column, types: Column, footer: str = vocab.FOOTER
) -> Column:
    """Stripped description, a details block and the footer, one per line."""
    lines = [
        strip(said(description)),
        F.lit(vocab.DETAILS_HEADING),
        F.when(when_text != "", F.concat(F.lit("When: "), when_text)),
        F.when(where_text != "", F.concat(F.lit("Where: "), where_text)),
        F.concat(F.lit("Event Type: "), types),
        F.lit(footer),
    ]
    return F.concat_ws("\n", *lines)


def key_element_suggestions(description: Column) -> Column:
    text = said(description)
    short = F.when(F.length(text) < 100, F.lit(vocab.DESCRIPTION_SHORT))

    def checks(low: Column) -> Column:
        return present(
            *[
                F.when(~any_word(low, words), F.lit(vocab.KEY_ELEMENT_MISSING.format(element=element)))
                for element, words in vocab.KEY_ELEMENTS.items()
            ]
        )

    return F.concat(present(short), F.transform(F.array(F.lower(text)), checks)[0])


def tag_slugs(tags_col: Column, limit: int = 10) -> Column:
    """Slugs of an array of tags: empty ones dropped, first ten kept in order."""
    slugs = F.array_distinct(F.transform(tags_col, slug))
    return F.slice(F.filter(slugs, lambda s: s != ""), 1, limit)
