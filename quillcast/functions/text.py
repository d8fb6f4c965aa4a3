"""Text rules of dialogue curation, as Column expressions (no UDFs).

Regular expressions use Unicode classes, because the texts are mostly Cyrillic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Neutral verbs of speech and short pronouns, which alone describe no manner.
NEUTRAL_SPEECH_VERBS = (
    "сказал", "сказала", "сказали", "ответил", "ответила", "ответили",
    "спросил", "спросила", "спросили", "произнёс", "произнесла", "произнесли",
    "промолвил", "промолвила", "добавил", "добавила", "заметил", "заметила",
)
PRONOUNS = ("я", "он", "она", "они", "мы", "ты", "вы")
# Words that stand for nobody in particular.
NOBODY = ("он", "она", "оно", "я", "ты", "вы", "мы", "они", "self", "unspecified", "self/unspecified", "кто-то", "некто")
# Patterns of descriptions that describe nothing, and of quoted or dashed speech.
JUNK_PATTERN = r"(?iuU)^\s*$|^[-—–\s]*$|^null$|без\s+описани|нет\s+описани|не\s+указан|^нет\.?$"
DIALOGUE_PATTERN = r'(?U)(?:^|\n)\s*[—–-]\s+\S|«[^»]+»|"[^"\n]{2,}"'


def strip(c: Column) -> Column:
    """Trim every kind of white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_for_match(c: Column) -> Column:
    """Lower case, one kind of quotes and dashes, single spaces."""
    quotes = F.regexp_replace(F.lower(c), "[«»\"“”„]", '"')
    return strip(F.regexp_replace(F.regexp_replace(quotes, "[—–]", "-"), r"(?U)\s+", " "))


def has_dialogue(c: Column) -> Column:
    return c.rlike(DIALOGUE_PATTERN)


def neutral_only(description: Column) -> Column:
    """A neutral verb alone, or with one pronoun after it."""
    plain = strip(F.regexp_replace(F.lower(description), r"\.+$", ""))
    t = F.filter(F.split(plain, r"(?U)\s+"), lambda x: x != "")
    verb = F.get(t, F.lit(0)).isin(*NEUTRAL_SPEECH_VERBS)
    return F.coalesce(verb & ((F.size(t) == 1) | ((F.size(t) == 2) & F.get(t, F.lit(1)).isin(*PRONOUNS))), F.lit(False))


def bare(c: Column) -> Column:
    """Without a leading dash and punctuation, in lower case."""
    undashed = F.regexp_replace(strip(c), r"(?U)^[—–-]\s*", "")
    return F.lower(strip(F.regexp_replace(undashed, r"(?U)[^\w\s]", "")))


def is_junk_description(description: Column, speech: Column | None = None) -> Column:
    """Empty, a stub, a bare neutral verb, or the speech itself over again; null counts as empty."""
    d = strip(F.coalesce(description, F.lit("")))
    junk = d.rlike(JUNK_PATTERN) | neutral_only(d)
    if speech is not None:
        junk = junk | F.coalesce((speech != "") & (bare(d) == bare(speech)), F.lit(False))
    return junk


def speech_in_chunk(speech: Column, chunk: Column, exact: bool = False) -> Column:
    """The guard against invented speech: it must occur in its chunk."""
    if exact:
        return F.coalesce((speech != "") & F.contains(chunk, speech), F.lit(False))
    s = normalize_for_match(speech)
    return F.coalesce((s != "") & F.contains(normalize_for_match(chunk), s), F.lit(False))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\S+")), F.lit(0))


def blank_line_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n\n"), strip), lambda x: x != "")


def _longest(parts: Column) -> Column:
    """The longest element, the first one on ties."""
    keyed = F.transform(parts, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("p")))
    return F.array_max(keyed)["p"]


def sample_paragraph(chunk: Column, least: int = 100, most: int = 350, cut: int = 300) -> Column:
    """A whole paragraph of handy length, else the longest one cut; null if there is none."""
    parts = blank_line_parts(chunk)
    handy = F.filter(parts, lambda x: F.length(x).between(least, most))
    return F.coalesce(_longest(handy), F.substring(_longest(parts), 1, cut))


def middle_paragraph(paragraphs: Column, least: int = 120, most: int = 350, floor: int = 80, cut: int = 300) -> Column:
    """The same from the middle third of a book (all of it when short), or null when everything is too short."""
    n = F.size(paragraphs)
    third = F.floor(n / 3).cast("int")
    middle = F.slice(paragraphs, third + 1, F.greatest(n - 2 * third, F.lit(1)))
    pool = F.when(n >= 3, middle).otherwise(paragraphs)
    handy = F.filter(pool, lambda x: F.length(x).between(least, most))
    usable = F.filter(pool, lambda x: F.length(x) >= floor)
    return F.substring(F.coalesce(_longest(handy), _longest(usable)), 1, cut)


def safe_name(c: Column, tail: int = 400) -> Column:
    """A file name: other characters than digits and basic Latin or Cyrillic letters become one underscore.

    Of a longer name the last 150 characters are left. The text's end has them as a rule; where it hasn't, the whole text is rewritten.
    """

    def plain(x: Column) -> Column:
        return F.btrim(F.regexp_replace(x, "[^0-9a-zA-Zа-яА-Я]+", "_"), F.lit("_"))

    # bound by a lambda and cut by substring, because right() and repeated columns are computed more than once
    end = F.array(plain(F.substring(c, -tail, tail)))
    whole = F.transform(end, lambda x: F.when((F.length(c) <= tail) | (F.length(x) >= 150), x).otherwise(plain(c)))
    return F.substring(whole[0], -150, 150)


def tidy(c: Column) -> Column:
    """Single spaces, no punctuation left at either end by a removal."""
    t = strip(F.regexp_replace(c, r"(?U)\s+", " "))
    t = F.regexp_replace(t, r"(?U)^[,;:.\-—]+\s*", "")
    return F.regexp_replace(t, r"(?U)\s*[,;:\-—]+$", "")


def cyrillic_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("[а-яёА-ЯЁ]+"), F.lit(0))


def ratio_list(ratios: Column) -> Column:
    """0.123;NA;... from an array of doubles."""
    return F.array_join(F.transform(ratios, lambda r: F.coalesce(F.format_string("%.3f", r), F.lit("NA"))), ";")


def status_prefix(c: Column) -> Column:
    """What stands before details in a status: up to the first bracket or colon."""
    return F.regexp_extract(c, r"^[^(:]*", 0)
