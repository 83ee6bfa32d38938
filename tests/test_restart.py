"""A run that was cut goes on from its last complete round."""

import os

import pytest

from graphloom import pagerank
from graphloom.plans import loop


def graph(spark):
    rows = [(i % 17, (i * i + 3) % 23) for i in range(200)] + [(0, d) for d in range(23)]
    return spark.createDataFrame(rows, "src bigint, dst bigint")


@pytest.mark.parametrize("bucket_size", [None, 6])
def test_ranks_after_a_cut_equal_an_uncut_run(spark, scratch, monkeypatch, bucket_size):
    e, folder = graph(spark), f"{scratch}/run"
    settings = dict(tol=None, max_iter=5, partitions=3, bucket_size=bucket_size)
    whole = pagerank(e, **settings)
    kept, seen = loop.materialize, []

    def cut(frame, metrics, name, store=None, k=0):
        seen.append(k)
        if k == 4 and seen.count(4) == 1:
            raise RuntimeError("the driver is lost")
        return kept(frame, metrics, name, store, k)

    monkeypatch.setattr(loop, "materialize", cut)
    with pytest.raises(RuntimeError, match="lost"):
        pagerank(e, run_dir=folder, **settings)
    # a manifest whose write did not end names no round
    os.makedirs(f"{folder}/manifest/round-4/_temporary")
    with pytest.raises(ValueError, match="other settings"):
        pagerank(e, run_dir=folder, damping=0.5, **settings)
    again = pagerank(e, run_dir=folder, **settings)
    assert seen == [1, 2, 3, 4, 4, 5]
    assert again.rounds == 5 and again.diffs == pytest.approx(whole.diffs)
    want, got = ({r.id: r.rank for r in x.ranks.collect()} for x in (whole, again))
    assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-14 for k in want)
    # the graph and the manifest are gone, the last state alone is there for the result
    assert os.listdir(folder) == ["state"] and len(os.listdir(f"{folder}/state")) == 1


def test_run_dir_takes_edges_as_rows(spark, scratch):
    with pytest.raises(ValueError, match="run_dir"):
        pagerank(graph(spark), run_dir=scratch, grid=True)
