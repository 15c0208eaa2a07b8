"""Rules around review sentiment: label names, keyword override, plausibility of a score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from encore.functions.text import strip, word_count

# Model labels and their names.
LABEL_NAMES = {"POS": "positive", "NEU": "neutral", "NEG": "negative"}

# Words and phrases that turn a neutral comment into a positive one.
POSITIVE_KEYWORDS = [
    "ótimo", "excelente", "bom", "recomendo", "confiável",
    "satisfeito", "tranquilo", "correto", "tudo certo", "tudo ok",
]
# Further phrases that count in comments of at most five words.
SHORT_COMMENT_PHRASES = ["tudo certo", "tudo ok", "site confiável", "cumpriu", "conforme"]
SHORT_COMMENT_WORDS = 5

# Words of the built-in predictor, in plain text: what tells that a buyer is content or not.
# Beginnings of words, so that endings do not matter.
CONTENT_STEMS = [
    "ótim", "otim", "excelent", "perfeit", "maravilh", "adorei", "amei", "gostei", "recomend",
    "satisfeit", "rápid", "rapid", "bonit", "lind", "qualidade", "parabéns", "bom", "boa", "bem",
]
DISCONTENT_STEMS = [
    "atras", "ruim", "péssim", "pessim", "horríve", "horrive", "defeit", "quebrad", "errad",
    "falt", "reclam", "devol", "decepcion", "problem", "danific", "demor", "insatisfeit", "pior",
]
# A word before them that turns their meaning.
NEGATIONS = ["não", "nao", "nunca", "sem", "nem"]

NO_COMMENT = "No comment"


def plain_text(text: Column) -> Column:
    """The form of a comment in which keywords are looked for."""
    return F.lower(strip(text))


def _mentions(plain: Column, phrases: list[str]) -> Column:
    return plain.rlike("|".join(phrases))  # letters and spaces only: one pass for all phrases


def sentiment_name(label: Column) -> Column:
    """Name of a model label; anything unknown is neutral."""
    known = F.create_map(*[F.lit(x) for pair in LABEL_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, label), F.lit("neutral"))


def keyword_override(plain: Column, sentiment: Column) -> Column:
    """Lift a neutral sentiment to positive where the comment uses clearly positive words.

    ``plain`` is ``plain_text`` of the comment; as a column of its own it is made only once.
    """
    short = word_count(plain) <= SHORT_COMMENT_WORDS
    lifted = _mentions(plain, POSITIVE_KEYWORDS) | (
        short & _mentions(plain, SHORT_COMMENT_PHRASES)
    )
    return F.when((sentiment == "neutral") & lifted, F.lit("positive")).otherwise(sentiment)


def _counted(plain: Column, stems: list[str], negated: bool) -> Column:
    """Words that begin with a stem, with or without a negation right before them."""
    words = rf"(?<![\p{{L}}])(?:{'|'.join(stems)})"
    before = rf"(?<![\p{{L}}])(?:{'|'.join(NEGATIONS)})[ \t\r\n]+(?:{'|'.join(stems)})"
    turned = F.regexp_count(plain, F.lit(before))
    return turned if negated else F.regexp_count(plain, F.lit(words)) - turned


def lexicon_label(plain: Column) -> Column:
    """POS, NEU or NEG by the majority of content and discontent words; a negation turns a word.

    ``plain`` is ``plain_text`` of the comment. The built-in predictor, as a column expression.
    """
    content = _counted(plain, CONTENT_STEMS, False) + _counted(plain, DISCONTENT_STEMS, True)
    discontent = _counted(plain, DISCONTENT_STEMS, False) + _counted(plain, CONTENT_STEMS, True)
    return (
        F.when(content > discontent, "POS").when(content < discontent, "NEG").otherwise("NEU")
    )


def is_blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def blank_label(text: Column, sentiment: Column) -> Column:
    """Blank or missing comments get a label of their own."""
    return F.when(is_blank(text), F.lit(NO_COMMENT)).otherwise(sentiment)


def verified_rating(sentiment: Column, score: Column) -> Column:
    """Whether the score fits the sentiment; null where there was no comment."""
    fits = (
        (sentiment.isin("positive", "neutral") & score.isin(4, 5))
        | ((sentiment == "neutral") & (score == 3))
        | ((sentiment == "negative") & score.isin(1, 2))
    )
    return F.when(sentiment != NO_COMMENT, F.coalesce(fits, F.lit(False)))
