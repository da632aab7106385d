"""Rule-based kind of an article. Classifying marks; it never drops a row."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions.text import as_col, let, strip


def _any_of(text: Column, signals) -> Column:
    return reduce(or_, [text.contains(s) for s in signals], F.lit(False))


def kind(
    title,
    *,
    digest_signals=C.DIGEST_SIGNALS,
    digest_suffix: str = C.DIGEST_SUFFIX,
    spam_signals=C.SPAM_SIGNALS,
    sports_signals=C.SPORTS_SIGNALS,
) -> Column:
    """digest, spam, sports or story, judged in this order and by the title alone.

    Blanks around the title let signals with boundary blanks match at its ends.
    """
    def judge(padded: Column) -> Column:
        digest = padded.endswith(f"{digest_suffix} ") | _any_of(padded, digest_signals)
        return (
            F.when(digest, C.DIGEST)
            .when(_any_of(padded, spam_signals), C.SPAM)
            .when(_any_of(padded, sports_signals), C.SPORTS)
            .otherwise(C.STORY)
        )

    # bound once: a filter on the kind would otherwise lower the title for every signal
    return let(F.concat(F.lit(" "), F.lower(strip(title)), F.lit(" ")), judge)


def keep_in_feed(kind_col="kind") -> Column:
    """Readers see stories and rows without a kind; every other kind is hidden."""
    c = as_col(kind_col)
    return c.isNull() | (c == C.STORY)
