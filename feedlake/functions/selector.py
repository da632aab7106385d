"""Article text of a page by a simple CSS selector.

HTML nesting cannot be followed by regular expressions, so this is the one place
where rows go through Python: an Arrow batch at a time, and only for the few
candidate pages that body enrichment selects.
"""

import re
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions.text import collapse, decode_entities

# Task code travels with the plan; executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_UNREAD = frozenset(("script", "style", "template"))
# Stands in for "&" while parsing, so that entities are decoded by one rule, in the JVM.
_AMP = "\uffff"


class _FirstMatch(HTMLParser):
    """Collects the text of the first element that a tag/.class/#id selector names."""

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=True)
        tag, rest = re.match(r"([\w-]*)(.*)", selector.strip()).groups()
        self.tag = tag.lower()
        self.classes = set(re.findall(r"\.([\w-]+)", rest))
        self.id = (re.findall(r"#([\w-]+)", rest) or [None])[0]
        self.inside = []  # open tags from the matched element down
        self.found = False
        self.parts = []

    def _matches(self, tag, attrs):
        attrs = dict(attrs)
        return (
            (not self.tag or tag == self.tag)
            and self.classes <= set((attrs.get("class") or "").split())
            and (self.id is None or attrs.get("id") == self.id)
        )

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        if self.inside:
            self.inside.append(tag)
        elif not self.found and self._matches(tag, attrs):
            self.found = True
            self.inside.append(tag)

    def handle_startendtag(self, tag, attrs):
        """``<br/>`` opens nothing."""

    def handle_endtag(self, tag):
        if tag in self.inside:
            while self.inside.pop() != tag:
                pass

    def handle_data(self, data):
        if self.inside and self.inside[-1] not in _UNREAD:
            self.parts.append(data)


def select_text(html: str, selector: str) -> str:
    """Text nodes below the selected element, spaced, entities as written; '' if none."""
    try:
        parser = _FirstMatch(selector)
        parser.feed(html.replace("&", _AMP))
        parser.close()
    except Exception:
        return ""
    return " ".join(parser.parts).replace(_AMP, "&")


def page_text(html, selector, *, min_chars: int = C.MIN_BODY_CHARS):
    """Text of the selected element, or '' when missing, too short or unreadable."""

    @F.pandas_udf("string")
    def extract(pages: pd.Series, selectors: pd.Series) -> pd.Series:
        return pd.Series(
            [
                select_text(page, sel) if page and sel else ""
                for page, sel in zip(pages, selectors)
            ],
            dtype="object",
        )

    body = collapse(decode_entities(extract(html, selector)))
    return F.when(F.length(body) >= min_chars, body).otherwise("")
