"""The type that a title tells: rules by priority, each a set of words that must all occur."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.plans.dictionaries import NoticeType, types


def rule_array(found: list[NoticeType]) -> Column:
    """A literal array of (code, words), the highest priority first; Catalyst folds it once."""
    rules = [(t.code, words) for t in sorted((t for t in found if t.rules), key=lambda t: -t.priority) for words in t.rules]
    return F.array(*[F.struct(F.lit(code).alias("code"), F.array(*[F.lit(w) for w in words]).alias("words")) for code, words in rules])


def classify_title(title: Column | str, found: list[NoticeType] | None = None, normal: bool = False) -> Column:
    """The code of the first rule whose words the title has; null for none or a blank title. normal: the title is normalised already."""
    text = (F.col(title) if isinstance(title, str) else title) if normal else T.normalise_title(title)
    # the text is made once for a title, not once for each word of each rule
    hits = lambda t: F.filter(rule_array(found or types()), lambda r: F.forall(r["words"], lambda w: F.contains(t, w)))
    return F.when(~T.is_blank(title), F.get(T.let(text, hits), F.lit(0))["code"])
