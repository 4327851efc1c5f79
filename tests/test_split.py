"""The split against a brute-force ranking of all rows."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from textpipe.operators.split import allocate, assign_split, find_cuts, stratified_split


def python_allocation(counts, test_size=0.2):
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    train = {c: k * n_train // n for c, k in counts.items()}
    order = sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))
    for c in order[: n_train - sum(train.values())]:
        train[c] += 1
    return train


def python_split(rows, test_size=0.2, seed=42):
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append((hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key))
    train = python_allocation({c: len(g) for c, g in groups.items()}, test_size)
    side = {}
    for label, members in groups.items():
        for place, (_, key) in enumerate(sorted(members)):
            side[key] = "train" if place < train[label] else "test"
    return side


def table(spark, rows, key_type="long"):
    return spark.createDataFrame(rows, f"doc_id {key_type}, label int")


def sides(df):
    return {r.doc_id: r.split for r in df.collect()}


def skewed(n):
    return [(i, 0 if i % 3 else i % 7) for i in range(n)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(2, 60), min_size=1, max_size=6),
    st.sampled_from([0.1, 0.2, 0.25, 0.5, 0.75]),
    st.integers(0, 99),
)
def test_equals_full_ranking(spark, class_sizes, test_size, seed):
    rows, key = [], 0
    for label, size in enumerate(class_sizes):
        for _ in range(size):
            rows.append((key, label))
            key += 1
    n_test = math.ceil(test_size * len(rows))
    if min(n_test, len(rows) - n_test) < len(class_sizes):
        return
    got = sides(stratified_split(table(spark, rows), test_size=test_size, seed=seed))
    assert got == python_split(rows, test_size, seed)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_matter(spark, parts):
    rows = skewed(1000)
    assert sides(stratified_split(table(spark, rows).repartition(parts))) == python_split(rows)


@pytest.mark.parametrize("rank_limit", [1, 3, 50])
def test_following_prefixes_gives_the_same_cuts(spark, rank_limit):
    df = table(spark, skewed(3000))
    by_label = lambda cuts: sorted(cuts, key=lambda c: c.label)
    assert by_label(find_cuts(df, rank_limit=rank_limit)) == by_label(find_cuts(df))


def test_text_keys(spark):
    rows = [(f"doc-{i}", i % 2) for i in range(101)]
    assert sides(stratified_split(table(spark, rows, "string"))) == python_split(rows)


def test_sizes_of_150_rows(spark):
    labels = [0] * 30 + [1] * 45 + [2] * 45 + [3] * 30
    df = table(spark, list(enumerate(labels)))
    counts = {c: labels.count(c) for c in range(4)}
    got = allocate(spark.createDataFrame(list(counts.items()), "label int, n_rows long")).collect()
    assert {r.label: (r.n_rows, r.n_train, r.n_test) for r in got} == {
        0: (30, 24, 6), 1: (45, 36, 9), 2: (45, 36, 9), 3: (30, 24, 6),
    }
    assert list(sides(stratified_split(df)).values()).count("test") == 30


def test_allocation_of_counts_beyond_bigint_products(spark):
    counts = {0: 60_000_000_001, 1: 30_000_000_007, 2: 10_000_000_003}
    got = allocate(spark.createDataFrame(list(counts.items()), "label int, n_rows long"))
    assert {r.label: r.n_train for r in got.collect()} == python_allocation(counts)


def test_equal_remainders_go_to_smaller_labels(spark):
    counts = {7: 3, 5: 3, 9: 3}
    got = allocate(spark.createDataFrame(list(counts.items()), "label int, n_rows long"))
    assert {r.label: r.n_train for r in got.collect()} == {5: 3, 7: 2, 9: 2} == python_allocation(counts)


def test_class_without_train_rows(spark):
    rows = [(i, 0) for i in range(40)] + [(40, 1), (41, 1)]
    got = sides(stratified_split(table(spark, rows), test_size=0.9))
    assert got == python_split(rows, 0.9)
    assert got[40] == got[41] == "test"


def test_same_seed_same_split_other_seed_other_split(spark):
    df = table(spark, skewed(500))
    first = sides(stratified_split(df, seed=1))
    assert first == sides(stratified_split(df, seed=1)) != sides(stratified_split(df, seed=2))


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([(0, 0), (1, 0), (2, 0), (3, 1)], "fewer than 2 rows"),
        ([(0, 0), (1, 0), (2, 1), (3, 1)], "test side has 1 rows for 2 classes"),
        ([(0, 0), (1, 0), (2, None), (3, None)], "Null labels"),
        ([(7, 0)] * 30, "repeats its values"),
    ],
)
def test_preconditions(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        find_cuts(table(spark, rows))


def test_many_copies_of_a_key_are_noticed_while_following(spark):
    with pytest.raises(ValueError, match="repeats its values"):
        find_cuts(table(spark, [(7, 0)] * 30), rank_limit=5)


def test_a_run_of_one_key_is_cut_alike_for_any_limit(spark):
    """Class 0 has eight rows of one key, and the cut right behind them."""
    by_hash = sorted(range(100), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    first, *later = by_hash
    rows = [(first, 0)] * 8 + [(k, 0) for k in later[:2]] + [(k, 1) for k in later[2:12]]
    cuts = [{c.label: c for c in find_cuts(table(spark, rows), rank_limit=n)} for n in (3, 100)]
    assert cuts[0] == cuts[1] and cuts[0][0].n_train == 8 and cuts[0][0].cut_key == first
    divided = [(first, 0)] * 9 + [(later[0], 0)] + rows[10:]
    for n in (3, 100):
        with pytest.raises(ValueError, match="repeats its values"):
            find_cuts(table(spark, divided), rank_limit=n)


def test_null_key_fails(spark):
    with pytest.raises(Exception, match="null key"):
        find_cuts(table(spark, [(None, 0), (1, 0), (2, 0), (3, 0)]))


def test_assignment_is_one_broadcast_without_shuffle(spark):
    df = table(spark, skewed(100))
    plan = assign_split(df, find_cuts(df))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
