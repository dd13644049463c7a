import random

import pytest

from lateship.ml.label_index import LabelIndex
from lateship.session import shared_dir


@pytest.mark.parametrize("head", [0, 3, 10 ** 6])
def test_index_by_frequency_then_value(spark, head):
    rnd = random.Random(4)
    labels = ["hot"] * 400 + [f"v{rnd.randrange(40)}" for _ in range(200)] + [None] * 50
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(labels)], "id int, c string, d int").repartition(6)
    count = {}
    for v in labels:
        if v is not None:
            count[v] = count.get(v, 0) + 1
    order = {v: float(i) for i, v in enumerate(sorted(count, key=lambda v: (-count[v], v)))}
    index = LabelIndex.fit(df, ["c", "d"], shared_dir(spark, "t-index"))
    more = df.unionByName(spark.createDataFrame([(9999, "unseen", None)], "id int, c string, d int"))
    got = {r.id: (r.c_index, r.d_index) for r in LabelIndex(spark, index.path).transform(more, head=head).collect()}
    assert len(got) == len(labels) + 1
    assert all(got[i][0] == order.get(v, float(len(order))) for i, v in enumerate(labels))
    assert got[9999] == (float(len(order)), 3.0)
    with pytest.raises(ValueError):
        index.labels("nope")
    index.delete()


def test_column_without_labels(spark):
    df = spark.createDataFrame([(1, None)], "id int, c string")
    index = LabelIndex.fit(df, ["c"], shared_dir(spark, "t-index-empty"))
    assert index.transform(df).first().c_index == 0.0
