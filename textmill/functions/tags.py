"""Tag array functions and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import lexicon
from textmill.functions.literals import literal_list

NO_TAG_LABEL = "other-tags"


def split_tags(tags: Column, sep: str = "|") -> Column:
    """'a|b' -> ['a', 'b']."""
    return F.split(tags, "\\" + sep)


def intersect_tags(tags: Column, allowed: Sequence[str] = lexicon.ALLOWED_TAGS) -> Column:
    """Unique allowed tags in post order; null tags become an empty array."""
    return F.array_intersect(F.coalesce(tags, F.expr("cast(array() as array<string>)")), literal_list(allowed))


def build_tag(tags: Column, allowed: Sequence[str]) -> Column:
    """Allowed tags in post order, duplicates kept."""
    return F.filter(tags, lambda t: t.isin(list(allowed)))


def all_tags_in(df: DataFrame, subset: Sequence[str], tags: str = "tags") -> DataFrame:
    """Posts whose every tag is in the subset; a post without tags is kept."""
    return df.filter(F.forall(F.col(tags), lambda t: t.isin(list(subset))))


def first_label(tags: Column, default: str = NO_TAG_LABEL) -> Column:
    """First tag, or the default for a post without tags."""
    return F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit(default))


def joined_label(tags: Column, sep: str = ",") -> Column:
    """The tag list as one label, in post order."""
    return F.array_join(tags, sep)


def powerset_label(tags: Column, sep: str = "|") -> Column:
    """The tag set as one class: unique tags in alphabetical order."""
    return F.array_join(F.array_sort(F.array_distinct(tags)), sep)


def nest_tags(tags: Column) -> Column:
    """['a'] -> [{value: 'a'}], the record form of the older sink."""
    return F.transform(tags, lambda t: F.struct(t.alias("value")))


def binarise_labels(df: DataFrame, labels: Sequence[str], tags: str = "tags", prefix: str = "is_") -> DataFrame:
    """One 0/1 column per label."""
    return df.withColumns({f"{prefix}{label}": F.array_contains(tags, label).cast("int") for label in labels})
