"""Random inputs against plain Python, with task sizes small enough that most keys are cut."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartloom.operators import diff, fingerprint, hierarchy, ordered, skew
from tests.test_ordered import brute
from tests.test_relations import brute_depths

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60
)


@SETTINGS
@given(rows=ROWS, task_rows=st.integers(1, 40))
def test_scan(spark, rows, task_rows):
    numbered = [(k, ts, i, v) for i, (k, ts, v) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "key string, ts int, id bigint, value int")
    result = ordered.scan(
        df, ["key"], ["ts", "id"], number="n", sums={"total": "value"}, previous={"last": "value"}, task_rows=task_rows
    )
    assert {r.id: (r.n, r.total, r["last"]) for r in result.collect()} == brute(numbered)


@SETTINGS
@given(parents=st.lists(st.one_of(st.none(), st.integers(0, 14)), min_size=1, max_size=12))
def test_depths(spark, parents):
    edges = dict(enumerate(parents))
    df = spark.createDataFrame(list(edges.items()), "id bigint, parent_id bigint")
    assert {r.id: r.depth for r in hierarchy.depths(df).collect()} == brute_depths(edges)


@SETTINGS
@given(
    left=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.sampled_from("xy"))), max_size=12),
    right=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.sampled_from("xy"))), max_size=12),
)
def test_diff_and_fingerprint(spark, left, right):
    schema = "id int, v string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    expected = {("left", *r) for r in set(left) - set(right)} | {("right", *r) for r in set(right) - set(left)}
    assert {tuple(r) for r in diff.relation_diff(a, b).collect()} == expected
    same = sorted(map(str, left)) == sorted(map(str, right))
    for method in (fingerprint.summed, fingerprint.hashed):
        assert (method(a).first() == method(b).first()) == same


def test_broadcast_is_refused_for_wide_texts(spark, monkeypatch):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert skew.fits_broadcast(df) and not skew.fits_broadcast(df, 99)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 50_000)
    assert not skew.fits_broadcast(df) and skew.fits_broadcast(df.select("id"))
