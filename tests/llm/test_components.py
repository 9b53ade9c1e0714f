"""Components of few and of many edges, and what a round of few edges costs."""

from __future__ import annotations

import random
import uuid

import pytest

from citypulse.llm import components as module
from tests.llm import brute

#: As many partitions as a large input would have, kept also where they are empty.
DEALT = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def found(spark, links):
    rows = module.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


def graphs():
    rng = random.Random(5)
    hub = [(700, k) for k in range(600, 800)]
    chain = [(k, k + 1) for k in range(900, 960)]
    sparse, dense = ([(rng.randrange(-20, n), rng.randrange(n)) for _ in range(m)] for n, m in ((300, 250), (60, 400)))
    return {"hub": hub, "chain": chain, "sparse": [*sparse, (5, 5)], "dense": dense, "pairs": [(2 * k + 1, 2 * k) for k in range(50)], "stars": [(1, 0), (2, 0), (2, 0), (0, 3)], "none": [(4, 4)]}


@pytest.mark.parametrize("few", [0, module.FEW])
@pytest.mark.parametrize("kind", sorted(graphs()))
def test_components(spark, monkeypatch, kind, few):
    monkeypatch.setattr(module, "FEW", few)
    links = graphs()[kind]
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found(spark, links) == brute.components(sorted(linked), [p for p in links if p[0] != p[1]])


def test_few_edges_are_not_dealt_out(spark):
    """A chain takes several rounds; each was some eight stages of all partitions, now only the edges are dealt, once."""
    links = graphs()["chain"]
    before = {k: spark.conf.get(k, None) for k in DEALT}
    group = uuid.uuid4().hex
    try:
        for k, v in DEALT.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup(group, "components")
        assert set(found(spark, links).values()) == {900}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    assert 97 <= tasks < 400
