"""What the rounds of the near-copy join carry along and leave behind."""

import os

import numpy as np
from pyspark.sql import functions as F

from dispatchlens import session
from dispatchlens.llm import jaccard


def test_short_lists_pass_once_and_used_tables_are_deleted(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(300)])
    groups = [rng.choice(words, 120) for _ in range(3)]
    texts = []
    for group, size in zip(groups, (40, 40, 3), strict=True):
        for _ in range(size):
            text = group.copy()
            text[rng.choice(120, int(rng.integers(0, 5)), replace=False)] = f"x{rng.integers(10**6)}"
            texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "MANY", 8)
    calls, mixed = [], jaccard._mixed

    def seen(lists, labels):
        calls.append(lists.where(F.col("members") < 8).count())
        return mixed(lists, labels)

    monkeypatch.setattr(jaccard, "_mixed", seen)
    folder = session.run_path(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = jaccard.joined(docs).collect()
    assert len(got) == len(texts) and len(calls) > 2
    assert sum(n > 0 for n in calls) == 1
    left = [f.rsplit("-", 5)[0] for f in set(os.listdir(folder)) - before]
    assert not {"hot", "lists", "pairs", "roles", "owners"} & set(left) and left.count("rest") == 1


def test_components_of_few_edges_take_few_tasks(spark):
    rng = np.random.default_rng(4)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))} | {(k, k + 1) for k in range(500, 530)}
    frame = spark.createDataFrame(sorted(edges), "a long, b long").repartition(7)
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    while any(want[a] != want[b] for a, b in edges if a != b):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    for setting, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "50")):
        spark.conf.set(setting, value)
    try:
        labels = jaccard.components(frame)
        files = [f for f in labels.inputFiles() if f.endswith(".parquet")]
        assert {r["id"]: r["label"] for r in labels.collect()} == want
        assert len(set(files)) == 1  # one task wrote them
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
