"""The hash encoder takes a batch some words at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gleanery.operators import encoders


def test_arrays_of_cells_stay_short(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 40)) for i in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (120, None)], "doc_id LONG, text STRING").coalesce(1)
    want = {r["doc_id"]: r["embedding"] for r in encoders.embed_documents(docs, encoders.HashEncoder(16)).collect()}

    made, kept = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: made.append(f) or kept(kind)(f))
    encoders.embed_documents(docs, encoders.HashEncoder(16))
    lists, sizes, count = pa.array([(t or "").split() for t in texts + [None]]), [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a: sizes.append(len(x)) or count(x, *a))
    monkeypatch.setattr(encoders, "STEP_WORDS", 50)
    got = made[0](lists).to_pylist()
    assert got == [want[i] for i in range(121)]
    assert max(sizes) <= 50 and sum(sizes) == sum(len(t.split()) for t in texts)
