"""The n-gram join against all pairs, with a hot group of near copies."""

import random
import re
from collections import defaultdict

import pytest

from isobar.llm.components import components
from isobar.llm.ngram_join import choose_bands, near_duplicates
from tests.llm.conftest import odd_rows


def grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def classes_by_hand(rows):
    """Smallest id of each connected group, from every pair."""
    texts = {}
    for i, text in rows:
        texts.setdefault(text or "", []).append(i)
    names = list(texts)
    sets = [grams(text) for text in names]
    parent = list(range(len(names)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, one in enumerate(sets):
        for b in range(a):
            common = len(one & sets[b])
            if common and common >= 0.8 * (len(one) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    members = defaultdict(list)
    for a, text in enumerate(names):
        members[root(a)] += texts[text]
    return {i: min(m for m in group if m is not None) for group in members.values() for i in group if i is not None}


def links_by_hand(rows):
    """How many different texts each row's text is similar to, from every pair."""
    sets = {text: grams(text) for _, text in rows}
    found = dict.fromkeys(sets, 0)
    for a, one in sets.items():
        for b, other in sets.items():
            common = len(one & other)
            found[a] += a != b and 0 < common >= 0.8 * (len(one) + len(other) - common)
    return {i: found[text] for i, text in rows}


def near_copies(seed, copies, words, changes):
    pick = random.Random(seed)
    base = [f"{seed}w{pick.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(pick.randrange(changes + 1)):
            own[pick.randrange(words)] = f"x{pick.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def texts():
    rows = near_copies(1, 150, 200, 9) + near_copies(2, 60, 120, 2) + near_copies(3, 40, 300, 60)
    rows += [" ".join(f"u{i}_{j}" for j in range(50)) for i in range(60)]
    rows += near_copies(2, 60, 120, 2)[:30]
    random.Random(5).shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small", [24, 1])
def test_classes_equal_all_pairs(spark, texts, monkeypatch, small):
    monkeypatch.setattr("isobar.llm.ngram_join.SMALL", small)
    found = near_duplicates(spark.createDataFrame(texts, "doc_id int, text string").repartition(4)).collect()
    wanted = classes_by_hand(texts)
    assert {row.doc_id: row.class_id for row in found} == wanted
    assert sum(row.class_size == 1 for row in found) >= 60
    assert all((row.n_links > 0) == (row.class_size > row.n_copies) for row in found)


@pytest.mark.parametrize(("block", "block_bytes"), [(512, 4 << 20), (7, 4 << 20), (512, 5000)])
def test_links_equal_all_pairs(spark, texts, monkeypatch, block, block_bytes):
    monkeypatch.setattr("isobar.llm.ngram_join.BLOCK", block)
    monkeypatch.setattr("isobar.llm.ngram_join.BLOCK_BYTES", block_bytes)
    monkeypatch.setattr("isobar.llm.ngram_join._COLUMNS", 1000 if block == 7 else 4096)
    found = near_duplicates(spark.createDataFrame(texts, "doc_id int, text string").repartition(4)).collect()
    wanted = links_by_hand(texts)
    assert max(wanted.values()) > 50
    assert {row.doc_id: row.n_links for row in found} == wanted


def test_odd_rows(odd):
    found = near_duplicates(odd).collect()
    assert len(found) == len(odd_rows())
    wanted = classes_by_hand([(row[0], row[1]) for row in odd_rows()])
    assert {row.doc_id: row.class_id for row in found if row.doc_id is not None} == wanted
    # Texts without words link to their copies alone.
    assert {row.class_size for row in found if row.doc_id == 3} == {1}


def test_an_empty_table(nothing):
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize(("similarity", "recall"), [(0.8, 0.99), (0.5, 0.9), (0.9, 0.999)])
def test_bands_reach_the_recall(similarity, recall):
    bands, rows = choose_bands(similarity, recall)
    assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= 256


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 299), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a int, b int")).collect()))
    assert {found[i] for i in range(1, 61)} == {found[1]} and {found[i] for i in range(100, 150)} == {found[100]}
    assert found[299] == found[300] and len({found[1], found[100], found[300]}) == 3
