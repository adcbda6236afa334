"""Merges against a row-by-row model, for every clause shape."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import rows
from feedlake.operators.merge import merge

value = st.one_of(st.none(), st.integers(0, 9))
key = st.one_of(st.none(), st.integers(0, 4))
case = st.tuples(
    st.lists(st.tuples(key, value), max_size=6),
    st.dictionaries(key, value, max_size=5),
)

CONDITIONS = {None: lambda t, s: True, "s.v > 4": lambda t, s: s is not None and s > 4,
              "t.v < 5": lambda t, s: t is not None and t < 5}
MATCHED = [
    (), (("update_all", None),), (("update", "s.v > 4"),), (("delete", None),), (("delete", "t.v < 5"),),
    (("update_all", "s.v > 4"), ("delete", None)), (("delete", "t.v < 5"), ("update", None)),
    (("delete", "s.v > 4"), ("update_all", "t.v < 5")),
]
INSERTS = [None, ("all", None), ("values", "s.v > 4")]
SHAPES = [(m, i) for m, i in itertools.product(MATCHED, INSERTS) if m or i]


def model(target, source, matched, insert):
    out, hit = [], set()
    for k, t in target:
        if k is None or k not in source:
            out.append((k, t))
            continue
        s = source[k]
        hit.add(k)
        action = next((a for a, c in matched if CONDITIONS[c](t, s)), None)
        if action == "update_all":
            out.append((k, s))
        elif action == "update":
            out.append((k, None if s is None else s + 100))
        elif action is None:
            out.append((k, t))
    if insert:
        kind, condition = insert
        for k, s in source.items():
            if k not in hit and CONDITIONS[condition](None, s):
                out.append((k, s if kind == "all" else None))
    return out


def build(builder, matched, insert):
    for action, condition in matched:
        if action == "update_all":
            builder = builder.when_matched_update_all(condition)
        elif action == "update":
            builder = builder.when_matched_update(condition, {"v": "s.v + 100"})
        else:
            builder = builder.when_matched_delete(condition)
    if insert:
        kind, condition = insert
        if kind == "all":
            builder = builder.when_not_matched_insert_all(condition)
        else:
            builder = builder.when_not_matched_insert(condition, {"c": "s.c", "k": "s.k"})
    return builder


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(case, min_size=60, max_size=60))
@pytest.mark.parametrize("shape", SHAPES, ids=str)
def test_merge_follows_the_model(spark, shape, cases):
    matched, insert = shape
    target = [(c, k, v) for c, (t, _) in enumerate(cases) for k, v in t]
    source = [(c, k, v) for c, (_, s) in enumerate(cases) for k, v in s.items()]
    expected = [(c, *r) for c, (t, s) in enumerate(cases) for r in model(t, s, matched, insert)]
    schema = "c int, k int, v int"
    t, s = spark.createDataFrame(target, schema).coalesce(2), spark.createDataFrame(source, schema).coalesce(2)
    order = lambda found: sorted(found, key=lambda r: [(v is not None, v) for v in r])
    for on in (["c", "k"], "t.c = s.c and t.k = s.k"):
        merged = build(merge(t, s.alias("s"), on), matched, insert).to_df()
        assert rows(merged) == order(expected)
