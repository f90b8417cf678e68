"""The bitmap of ids against sets."""

import random

from docloom.llm.id_filter import marked, without_ids


def test_marked_and_without(spark):
    r = random.Random(2)
    ids = r.sample(range(-(10**12), 10**12), 3000)
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(ids[0], "again"), (None, "none")], "doc_id long, `odd name` string")
    gone = spark.createDataFrame([(i,) for i in ids[:1200]], "g long")
    hit = {x["doc_id"] for x in marked(docs, gone).where("__hit").collect()}
    assert set(ids[:1200]) <= hit and len(hit) < 1300
    left = without_ids(docs, gone)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([(i, f"t{i}") for i in ids[1200:]] + [(None, "none")], key=repr)
    assert without_ids(docs, gone.limit(0)).count() == docs.count()
    assert without_ids(docs.limit(0), gone).count() == 0
