from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import decontaminate as dc


def plain_best(pattern, text):
    """Least edit distance to any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != c)))
    return min(row), row.index(min(row))


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90))
def test_bit_parallel_distance(pattern, text):
    assert dc.best_match(pattern, text) == plain_best(pattern, text)


@given(st.text("ab ", min_size=1, max_size=60), st.integers(0, 8))
def test_pieces_cover_the_item(text, edits):
    parts = list(dc.pieces(text, edits))
    assert len(parts) == edits + 1 and "".join(p for _, p in parts) == text
    assert all(text[o : o + len(p)] == p for o, p in parts)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_finds_every_copy_within_the_budget_and_nothing_else(spark, documents):  # noqa: F811
    rng = random.Random(5)
    items = [(i, sentence(rng, 12 + i)) for i in range(12)]
    texts, expected = [], {}
    for i in range(120):
        text = sentence(rng, 40)
        if i % 2:
            key, item = items[i % 12]
            budget = int(0.08 * len(item))
            passage = edited(rng, item, rng.choice([0, 1, budget]))
            at = rng.randrange(len(text))
            text = text[:at] + passage + text[at:]
            expected[i, key] = plain_best(item, text)[0]
            assert expected[i, key] <= budget
        texts.append(text)
    for i, text in enumerate(texts):
        for key, item in items:
            if (i, key) not in expected and i < 30:
                assert plain_best(item, text)[0] > int(0.08 * len(item))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_contamination(spark, documents(texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in found} == expected
    for r in found:  # the span itself has the distance
        assert plain_best(dict(items)[r["item_id"]], texts[r["doc_id"]][r["start"] : r["stop"]])[0] == r["distance"]
    blocks = dc.find_contamination(spark, documents(texts), bench, block_chars=400).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, found))


def test_odd_texts_and_items(spark, documents):  # noqa: F811
    item = "a passage that is long enough to be looked for"
    docs = documents([*ODD, f"x {item} y", f"x {item} y"]).withColumn("_matches", F.lit(1)).withColumn("item_id", F.lit(2))
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "short"), (None, item)], "item_id long, text string")
    found = sorted(tuple(r) for r in dc.find_contamination(spark, docs.drop("item_id"), items).select("doc_id", "item_id").collect())
    n = len(ODD)
    assert found == [(n, 1), (n, 2), (n + 1, 1), (n + 1, 2)]
    kept = dc.drop_contaminated(spark, docs, items)
    assert kept.columns == docs.columns and kept.count() == n
    assert dc.find_contamination(spark, docs.drop("item_id"), items.limit(0)).count() == 0
    assert dc.drop_contaminated(spark, docs.limit(0), items).count() == 0


def plain_all(pattern, text, edits):
    """The best match, then those in the text left and right of it."""
    distance, stop = plain_best(pattern, text)
    if distance > edits:
        return []
    length = plain_best(pattern[::-1], text[:stop][::-1])[1]
    start = stop - length
    right = [(a + stop, b + stop, d) for a, b, d in plain_all(pattern, text[stop:], edits)]
    return [*plain_all(pattern, text[:start], edits), (start, stop, distance), *right]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=6, max_size=20), st.lists(st.text("abc", max_size=12), max_size=5), st.integers(0, 2))
def test_all_matches_against_searching_again(pattern, between, edits):
    text = pattern.join(between) + pattern[1:] + pattern[:-1]
    assert dc.all_matches(pattern, text, edits) == plain_all(pattern, text, edits)


def test_repeated_adjacent_copies_are_each_reported(spark, documents):  # noqa: F811
    rng = random.Random(8)
    item = sentence(rng, 12)
    near = item[:20] + "#" + item[21:]
    cut = item[:30] + item[32:]
    texts = [item * 7, " ".join([near] * 5), "".join([item, near, cut, item, cut]), "x " + item + "; " + near + " y " + near]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = dc.find_contamination(spark, documents(texts), bench).orderBy("doc_id", "start").collect()
    by = {i: [r["distance"] for r in found if r["doc_id"] == i] for i in range(4)}
    assert by == {0: [0] * 7, 1: [1] * 5, 2: [0, 1, 2, 0, 2], 3: [0, 1, 1]}
    assert all(a["doc_id"] != b["doc_id"] or a["stop"] <= b["start"] for a, b in zip(found, found[1:], strict=False))


def test_items_without_id_and_short_items_are_searched(spark, documents):  # noqa: F811
    item, other = "a passage that is long enough to be looked for", "another passage that no item with an id has"
    texts = [f"x {other}y", f"so: what is 6 x 7? or 16 x 7? {item}", "what is 6 x 70?", "(what is 6 x 7?)what is 6 x 7?", "nothing"]
    bench = spark.createDataFrame([(1, item), (None, item), (None, other), (None, other), (7, "what is 6 x 7?"), (8, "6 x 7")], "item_id long, text string")
    want = [(0, None, 2), (1, 1, 30), (1, 7, 4), (1, 8, 12), (3, 7, 1), (3, 7, 16), (3, 8, 9), (3, 8, 24)]
    for blocks in ({}, {"block_chars": 40}):
        found = dc.find_contamination(spark, documents(texts), bench, **blocks).collect()
        order = lambda r: (r[0], -1 if r[1] is None else r[1], r[2])
        assert sorted(((r["doc_id"], r["item_id"], r["start"]) for r in found), key=order) == want
        assert {r["doc_id"] for r in dc.drop_contaminated(spark, documents(texts), bench, **blocks).collect()} == {2, 4}


def test_item_ids_of_any_type(spark, documents):  # noqa: F811
    items = spark.createDataFrame([("a-1", "one passage that is long enough to be searched with errors"), ("", "short item"), (None, "another of them")], "item_id string, text string")
    docs = documents(["x one passage that is long enough to be searched with errors y", "the short item and another of them", None])
    found = dc.find_contamination(spark, docs, items)
    assert found.schema["item_id"].dataType.typeName() == "string"
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(0, "a-1"), (1, ""), (1, None)}
