"""Token expressions with the meaning of ``Tokenizer`` and ``StopWordsRemover``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's default English stop words (apache/spark,
# StopWordsRemover.loadDefaultStopWords("english")).
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's
    why's would
    """.split()
)

WHITESPACE = " \t\n\x0b\f\r"


def tokenize(text: Column) -> Column:
    """Lower-case words between single whitespace characters.

    Two neighbouring spaces hold an empty word; empty words at the end do not
    count, so text of nothing but whitespace has no words at all.
    """
    trimmed = F.rtrim(F.lower(text), F.lit(WHITESPACE))
    only_blank = (trimmed == "") & (text != "")
    return F.when(only_blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s"))


def without_stop_words(
    words: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, lower_case: bool = False
) -> Column:
    """Words not in the list, in whatever case. A word with punctuation is a
    different word. ``lower_case`` says that the words are lower-case already."""
    return F.filter(words, lambda word: ~(word if lower_case else F.lower(word)).isin(*stop_words))


def without_empty(words: Column) -> Column:
    """Words that hold at least one character."""
    return F.filter(words, lambda word: word != "")
