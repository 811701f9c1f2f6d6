"""Clean-up of traffic sources, campaigns, promotions and pricing strategies.

Everything is a built-in expression, so it stays inside generated code.  The character
classes are spelled out because Java's ``\\s``, ``\\w`` and ``\\b`` differ from the
Unicode-aware ones the rules are defined by.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNSPECIFIED = "unspecified"
NO_PROMOTION = "NoPromotion"

# Traffic-source labels and the substrings that select them, first match wins.
SOURCE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BetterWorldBooks", ("betterworldbooks.com", "betterworldbooks.zendesk.com", "(direct)")),
    ("Facebook", ("facebook.com",)),
    ("Google", ("google", "g.doubleclick.net")),
    ("Bing", ("bing",)),
    ("Yahoo", ("yahoo",)),
    ("DuckDuckGo", ("duckduckgo",)),
    ("Affiliate", ("affiliate",)),
    ("Klaviyo", ("klaviyo",)),
    ("Attentive", ("attentive",)),
    ("Sendinblue", ("sendinblue",)),
    ("ConvertKit", ("convertkit",)),
    ("CJ", ("cj_feed",)),
    ("Substack", ("substack",)),
    ("ChatGPT", ("chatgpt",)),
    ("Trustpilot", ("trustpilot",)),
    ("Linkin.bio", ("linkin.bio", "later-linkinbio")),
    ("NPS", ("nps",)),
)

# Whole words in a campaign that all mean the same one.
CAMPAIGN_WORDS = ("gclid", "www.google.com", "wwwgooglecom")
CAMPAIGN_LABEL = "google campaign"

# Fixed value: the promotion text that stands for no promotion.
PROMOTION_NOT_APPLIED = "NoPromotionApplied"

# White space of any script, as characters and as a regular-expression class; and the class
# of letters, numbers and the underscore, which leaves out combining marks.
BLANKS = "".join(
    map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
              8232, 8233, 8239, 8287, 12288))
)
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"a-z0-9_\p{L}\p{N}"


def strip(col: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.trim(_column(col), F.lit(BLANKS))


def source_text(col: Column | str) -> Column:
    """Lower-cased source without its query string and trailing slashes; NULL where blank."""
    stripped = strip(F.lower(_column(col)))
    bare = F.rtrim(F.substring_index(stripped, "?", 1), F.lit("/"))
    return F.when(stripped != "", bare)


def label_source(
    text: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = SOURCE_RULES
) -> Column:
    """First matching label for a text made by :func:`source_text`, else the text itself.

    The result is declared free of NULLs, which spares a check of it in every grouping.
    """
    text = _column(text)
    chain = F.when(text.isNull(), F.lit(UNSPECIFIED))
    for label, needles in rules:
        hit = reduce(lambda a, b: a | b, (text.contains(needle) for needle in needles))
        chain = chain.when(hit, F.lit(label))
    return F.coalesce(chain.otherwise(text), F.lit(UNSPECIFIED))


def unify_source(
    col: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = SOURCE_RULES
) -> Column:
    """Raw traffic source to its channel label."""
    return label_source(source_text(col), rules)


def clean_campaign(col: Column | str) -> Column:
    """Campaign name in lower case, without punctuation and with single spaces."""
    text = F.lower(_column(col).cast("string"))
    words = "|".join(word.replace(".", r"\.") for word in CAMPAIGN_WORDS)
    whole_words = rf"(?<![{WORD}])(?:{words})(?![{WORD}])"
    # Most names hold none of the words, and looking for plain text is cheap.
    held = reduce(lambda a, b: a | b, (text.contains(word) for word in CAMPAIGN_WORDS))
    text = F.when(held, F.regexp_replace(text, whole_words, CAMPAIGN_LABEL)).otherwise(text)
    text = F.regexp_replace(text, rf"[^{WORD}{SPACE}]+", "")
    text = F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNSPECIFIED))


def promo_label(promotion: Column | str, promotion_id: Column | str) -> Column:
    """The promotion id, or ``NoPromotion`` where none was applied.

    A promotion without an id reads ``None``, which is a label of its own.
    """
    promotion = _column(promotion)
    none_applied = promotion.isNull() | (strip(promotion) == PROMOTION_NOT_APPLIED)
    identifier = F.coalesce(strip(_column(promotion_id).cast("string")), F.lit("None"))
    return F.when(none_applied, F.lit(NO_PROMOTION)).otherwise(identifier)


def strategy_base(col: Column | str) -> Column:
    """Pricing strategy without a final ``Test``."""
    return F.regexp_replace(_column(col), r"Test(?=\n?\z)", "")


def is_test(col: Column | str) -> Column:
    """Whether the pricing strategy ends with ``Test``; NULL stays NULL."""
    return _column(col).endswith("Test")


def contains(col: Column | str, pattern: str) -> Column:
    """Case-insensitive search for a regular expression; NULL does not match."""
    return F.coalesce(_column(col).rlike(f"(?iu){pattern}"), F.lit(False))


def joined_key(*cols: Column | str) -> Column:
    """Columns joined by underscores, a NULL written as ``None``."""
    return F.concat_ws("_", *(_text_or_none(col) for col in cols))


def _text_or_none(col: Column | str) -> Column:
    return F.coalesce(_column(col).cast("string"), F.lit("None"))


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
