"""Property tests: tokeniser and counts on generated texts, sampling sizes."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farpoint.operators import text
from test_text import java_split, lines_of

texts = st.lists(st.text(alphabet=st.sampled_from(list("ab \n\té")), max_size=25),
                 min_size=1, max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_word_count_model_and_salting(spark, values):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = Counter()
    for _, t in rows:
        for line in lines_of(t):
            model.update(java_split(line))
    plain = {r["word"]: r["n"] for r in text.word_count(df).collect()}
    salted = {r["word"]: r["n"] for r in text.word_count_salted(df, 3).collect()}
    assert plain == salted == dict(model)
    assert text.distinct_words(df).first()["n_distinct"] == len(model)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=1, max_value=40), st.integers(min_value=0, max_value=10**6))
def test_sample_is_exactly_k_and_reproducible(spark, k, seed):
    from farpoint.operators import sampling
    pts = spark.range(50).selectExpr("id", "array(cast(id as double)) AS v")
    a = sorted(r["id"] for r in sampling.random_sample(pts, k, seed).collect())
    b = sorted(r["id"] for r in sampling.random_sample(pts.repartition(3), k, seed).collect())
    assert len(a) == min(k, 50) and a == b


@pytest.mark.parametrize("k", [1, 3, 7])
def test_class_two_round_equals_one_round(spark, k):
    from farpoint.operators import classes
    rows = [(i * 7 - 20, "c%d" % (i % 5 if i % 3 else 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "idx long, class string")
    one = [tuple(r) for r in classes.class_count(df).collect()]
    two = [tuple(r) for r in classes.class_count_two_round(df, k).collect()]
    assert one == two
    hist = classes.class_histogram_by_part(df, k).collect()
    assert sum(r["n"] for r in hist) == 60 and all(0 <= r["part"] < k for r in hist)
