"""Many keywords found in one pass over a text.

The keywords make one pattern, written as a trie, that is tried once at each
place where a keyword can begin and yields the longest keyword there (a
look-ahead takes no text, so keywords inside and across each other are found
too). A map then names what each found keyword stands for: its own labels and
those of all keywords that begin it and end at a place where one may end. The
map is a constant, so a text costs one pass whatever the number of labels.

Null texts give null arrays and no label.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Place(Enum):
    """What must stand on both sides of a keyword: nothing in particular, no ASCII letter or digit, no character of a word."""

    INSIDE = ("", "", lambda c: False)
    ALONE = ("(?<![a-z0-9])", "(?![a-z0-9])", lambda c: bool(re.match("[a-z0-9]", c)))
    WORD = (r"(?<!\w)", r"(?!\w)", lambda c: bool(re.match(r"\w", c)))

    @property
    def before(self) -> str:
        return self.value[0]

    @property
    def after(self) -> str:
        return self.value[1]

    def goes_on(self, c: str) -> bool:
        """Whether no keyword may end before the character."""
        return self.value[2](c)


def trie(words: Iterable[str]) -> str:
    """A pattern that matches the words, the longest that it can, each common beginning written once."""
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node: dict) -> str:
        branches = [re.escape(c) + written(below) for c, below in node.items() if c]
        if not branches:
            return ""
        if len(branches) == 1 and "" not in node:
            return branches[0]
        return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    return written(root) or "(?!)"


def pattern(words: Iterable[str], place: Place) -> str:
    """A pattern whose group 1 is the longest keyword that begins at a place; it takes no text."""
    words = [w for w in words if w]
    begins = "".join(sorted({re.escape(w[0]) for w in words}))
    return f"(?U)(?=[{begins}]){place.before}(?=({trie(words)}){place.after})" if words else "(?!)()"


def hits(text: Column, words: Iterable[str], place: Place) -> Column:
    """The distinct longest keywords of each place of the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern(words, place)), F.lit(1)))


def words_of(*lists: list[tuple[str, list[str]]]) -> list[str]:
    """All keywords of some lists of groups."""
    return list(dict.fromkeys(w for groups in lists for _, words in groups for w in words if w))


def meanings(groups: list[tuple[str, list[str]]], place: Place, searched: list[str] | None = None) -> dict[str, list[int]]:
    """For each keyword searched for (those of the groups, if not given) the numbers of the groups that it, or a keyword that begins it, belongs to."""
    own: dict[str, set[int]] = {}
    for i, (_, words) in enumerate(groups):
        for w in words:
            own.setdefault(w, set()).add(i)
    named = {w: sorted(set().union(*(own.get(w[:n], ()) for n in range(1, len(w) + 1) if n == len(w) or not place.goes_on(w[n])))) for w in searched or words_of(groups)}
    return {w: numbers for w, numbers in named.items() if numbers}


def constant(value, kind: str) -> Column:
    """A list or map as one literal: it is folded when the query is planned."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def labels_of_hits(found: Column, groups: list[tuple[str, list[str]]], place: Place, searched: list[str]) -> Column:
    """Sorted labels of all groups that the hits of a search for `searched` name: one search serves several lists of groups."""
    known = {w: sorted({groups[i][0] for i in numbers}) for w, numbers in meanings(groups, place, searched).items()}
    if not known:
        return F.when(found.isNotNull(), F.array().cast("array<string>"))
    named = F.transform(found, lambda w: F.coalesce(F.try_element_at(constant(known, "map<string, array<string>>"), w), F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.flatten(named)))


def group_of_hits(found: Column, groups: list[tuple[str, list[str]]], place: Place, searched: list[str]) -> Column:
    """The number of the first group, from 0, that the hits of a search for `searched` name; null where there is none."""
    known = {w: numbers[0] for w, numbers in meanings(groups, place, searched).items()}
    if not known:
        return F.lit(None).cast("int")
    return F.array_min(F.transform(found, lambda w: F.try_element_at(constant(known, "map<string, int>"), w)))


def all_labels(text: Column, groups: list[tuple[str, list[str]]], place: Place) -> Column:
    """Sorted labels of all groups of which a keyword is in the text."""
    return labels_of_hits(hits(text, words_of(groups), place), groups, place, words_of(groups))


def first_group(text: Column, groups: list[tuple[str, list[str]]], place: Place) -> Column:
    """The number of the first group, from 0, of which a keyword is in the text; null where there is none."""
    return group_of_hits(hits(text, words_of(groups), place), groups, place, words_of(groups))


def label_of(number: Column, groups: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """The label of a group by its number, `default` for null."""
    return F.coalesce(F.get(constant([g[0] for g in groups], "array<string>"), number), F.lit(default).cast("string"))


def first_label(text: Column, groups: list[tuple[str, list[str]]], place: Place, default: str | None = None) -> Column:
    """The label of the first group, in the given order, of which a keyword is in the text."""
    return label_of(first_group(text, groups, place), groups, default)


def named(value: Column, groups: Iterable[tuple[str, list[str]]]) -> Column:
    """The label of the first group that has the value as a word; null where none has."""
    known: dict[str, str] = {}
    for label, words in groups:
        for w in words:
            known.setdefault(w, label)
    return F.try_element_at(constant(known, "map<string, string>"), value)


def holds(text: Column, words: Iterable[str]) -> Column:
    """Whether any of the words stands in the text, also inside other words."""
    return text.rlike(trie(words))
