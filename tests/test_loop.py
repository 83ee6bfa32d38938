"""Loop machinery: scoped settings, state stores, one action per round."""

import glob
import os

import pytest

from graphloom import pagerank
from graphloom.plans import loop


def test_loop_partitions_is_restored_even_on_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with loop.loop_partitions(spark, 3):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise RuntimeError("round failed")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_store_choice(spark):
    assert isinstance(loop.choose_store(spark, keep_all=False), loop.TableStore)
    assert isinstance(loop.choose_store(spark, keep_all=False, store="checkpoint"), loop.CheckpointStore)
    with pytest.raises(ValueError):
        loop.choose_store(spark, keep_all=False, store="memory")


def test_table_store_keeps_at_most_two_states(spark):
    edges = spark.createDataFrame([(i, (i * 3 + 1) % 50) for i in range(50)], "src bigint, dst bigint")
    store = loop.TableStore(spark)
    from graphloom.plans.layout import prepare_graph
    from graphloom.plans.pagerank import initial_state, rank_round

    layout = prepare_graph(edges, weight=None)
    state = initial_state(layout)
    for k in range(1, 7):
        state = store.write(rank_round(layout, state, 0.85, 0.0, "standard"), k)
    base = store.base.replace("file:", "")
    folders = sorted(os.path.basename(p) for p in glob.glob(os.path.join(base, "*")))
    assert folders == ["state-0", "state-1"]
    assert state.count() == layout.num_vertices


def test_one_action_per_round(spark):
    """Each round adds the same few jobs (AQE runs each stage of the round's single
    action as its own job): 6 rounds cost exactly 4 rounds' worth more than 2 rounds."""
    edges = spark.createDataFrame([(i, (i * 7 + 3) % 40) for i in range(40)], "src bigint, dst bigint")
    sc = spark.sparkContext

    def jobs_for(rounds):
        group = f"rounds-{rounds}"
        sc.setJobGroup(group, "rounds")
        r = pagerank(edges, tol=None, max_iter=rounds)
        sc.setJobGroup("rest", "")
        assert r.rounds == rounds
        return len(sc.statusTracker().getJobIdsForGroup(group))

    two, six = jobs_for(2), jobs_for(6)
    per_round = (six - two) / 4
    assert per_round == int(per_round) and 1 <= per_round <= 4
