"""One-pass keyword search against a search keyword by keyword."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vireo.functions import dictionaries as d
from vireo.functions import keywords as k
from vireo.functions.keywords import Place

SIDES = {Place.INSIDE: ("", ""), Place.ALONE: ("(?<![a-z0-9])", "(?![a-z0-9])"), Place.WORD: (r"(?:^|\W)", r"(?:$|\W)")}
GROUPS = {
    "hard": (d.Vocabulary().hard_skills(), Place.WORD), "soft": (d.SOFT_SKILLS, Place.WORD), "majors": (d.MAJORS, Place.INSIDE), "titles": ([*d.TITLES, *d.OTHER_TITLES], Place.ALONE), "roles": (d.ROLES, Place.INSIDE),
    "domains": (d.DOMAINS, Place.INSIDE), "industries": ([(r[1], r[2]) for r in d.INDUSTRIES], Place.INSIDE), "education": (d.EDUCATION, Place.INSIDE), "work": (d.WORK_TYPES, Place.INSIDE), "modes": (d.WORK_MODES, Place.INSIDE),
    "certificates": ([(x, [x]) for x in d.CERTIFICATES], Place.INSIDE), "nested": ([("a", ["sql"]), ("b", ["sql server", "c"]), ("c", ["server", "c++"]), ("d", ["sql server 2019", "c+"])], Place.WORD), "none": ([], Place.WORD)}


def searches(groups, place):
    return [(label, [re.compile(SIDES[place][0] + re.escape(w) + SIDES[place][1]) for w in words]) for label, words in groups]


def plain(text, compiled):
    return [label for label, patterns in compiled if any(x.search(text) for x in patterns)]


@pytest.mark.parametrize("name", GROUPS)
def test_every_keyword_of_the_dictionaries(spark, name):
    groups, place = GROUPS[name]
    words = [w for _, ws in groups for w in ws] or ["x"]
    rng = random.Random(name)
    texts = [form.format(w) for w in words for form in ("{}", "x {} y", "a{}b", "({})", "{}9", "é{}", "{}\n", "_{}")]
    texts += ["".join(x for _ in range(6) for x in (rng.choice(words), rng.choice([" ", "", "/", "x", ". ", "\n", "ư"]))) for _ in range(150)] + ["", "  "]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r.t: (r.every, r.first) for r in rows.select("t", k.all_labels(F.col("t"), groups, place).alias("every"), k.first_label(F.col("t"), groups, place, "none").alias("first")).collect()}
    compiled = searches(groups, place)
    for t in texts:
        want = plain(t, compiled)
        assert got[t] == (sorted(set(want), key=str.encode), (want or ["none"])[0]), t
    assert got[None][1] == "none"


def test_longest_provinces_first_decide_as_one_by_one():
    keys = [(key, p) for p, ks in d.PROVINCES.items() for key in ks]
    assert len({key for key, _ in keys}) == len(keys)
    # Keys of one length from different provinces cannot hold each other, so a text that holds both names two places.
    by_length = {}
    for key, p in keys:
        by_length.setdefault(len(key), []).append((key, p))
    assert not any(a in b for same in by_length.values() for a, _ in same for b, _ in same if a != b)


def test_trie_is_the_words():
    words = ["sql", "sql server", "c", "c++", "c#", "(x)", "a.b"]
    assert all(re.fullmatch(k.trie(words), w) for w in words)
    assert not any(re.fullmatch(k.trie(words), w) for w in ["", "sq", "sql ", "c+", "axb", "x"])
    assert not re.search(k.trie([]), "anything")
