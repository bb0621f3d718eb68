from __future__ import annotations

import pytest
from llm_helpers import clashing  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm.mix import mix_sources, mixed, one_period, phases, schedule, whole_weights


def simulated(weights, slots):
    """Earliest deadline first, slot by slot, with released blocks only."""
    total, done, order = sum(weights.values()), dict.fromkeys(weights, 0), []
    for slot in range(slots):
        ready = [
            (-(-(done[k] + 1) * total // w), k)
            for k, w in weights.items()
            if done[k] * total // w <= slot
        ]
        k = min(ready)[1]
        done[k] += 1
        order.append(k)
    return order


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 3, "b": 1}, {"a": 5, "b": 3, "c": 7, "d": 1}])
def test_period_equals_simulation_and_stays_within_a_block(weights):
    total = sum(weights.values())
    slots = one_period(weights)
    order = simulated(weights, 3 * total)
    for k, mine in slots.items():
        assert [s for s in range(3 * total) if order[s] == k] == [
            s + r * total for r in range(3) for s in mine
        ]
        for t in range(total + 1):
            assert abs(sum(s < t for s in mine) - t * weights[k] / total) < 1


def test_phases_place_every_block_once():
    blocks = {"a": 17, "b": 3, "c": 40}
    weights = {"a": 2, "b": 1, "c": 3}
    taken = []
    steps = phases(blocks, weights)
    for i, p in enumerate(steps):
        for k, first in p.first.items():
            until = steps[i + 1].first.get(k, blocks[k]) if i + 1 < len(steps) else blocks[k]
            for n in range(until - first):
                rounds, rest = divmod(n, len(p.slots[k]))
                taken.append(p.begin + rounds * p.period + p.slots[k][rest])
    assert sorted(taken) == list(range(60))


def test_whole_weights_need_positive_shares():
    assert whole_weights({"a": 0.5, "b": 0.25, "c": 0.25}, 8) == {"a": 2, "b": 1, "c": 1}
    with pytest.raises(ValueError):
        whole_weights({"a": 1, "b": 0})


def furthest(blocks, weights):
    """Largest distance from the given shares until the first source runs out, in blocks."""
    total, slots = sum(weights.values()), schedule(blocks, whole_weights(weights))
    assert sorted(s for mine in slots.values() for s in mine) == list(range(sum(blocks.values())))
    end = min(mine[-1] for mine in slots.values())
    return max(
        abs(i + after - (s + after) * weights[k] / total)
        for k, mine in slots.items()
        for i, s in enumerate(mine)
        for after in (0, 1)
        if s <= end
    )


def test_shares_hold_over_many_slots():
    weights = {f"s{i}": float((1_000 + 977 * i) ** 0.7) for i in range(20)}
    total = sum(weights.values())
    assert furthest({k: int(60_000 * w / total) for k, w in weights.items()}, weights) < 1


def test_many_small_sources_keep_their_weights():
    weights = {f"s{i}": 1.0 + i / 100 for i in range(2_000)}
    assert furthest({k: int(10 * w) for k, w in weights.items()}, weights) < 1


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "x" * (i % 50), "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(1_200)]
    rows += [(5_000, None, None), (5_001, "y" * 100_000, "s1"), (5_002, "", "hot"), (None, "z", "s1")]
    rows += [(0, "", "hot")]  # a repeated row
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_every_document_once_and_shares_hold(docs):
    weights = {"hot": 0.5, "s1": 0.2, "s2": 0.2, "s3": 0.05, None: 0.05}
    out = mix_sources(docs, weights, block_chars=100, bucket_rows=50).collect()
    assert len(out) == docs.select("doc_id", "source").distinct().count()
    sizes = {}
    for r in docs.collect():
        key = (r["source"], r["doc_id"])
        sizes[key] = sizes.get(key, 0) + len(r["text"] or "") + 1
    per = {}
    for r in out:
        per.setdefault(r["source"], []).append((r["start"], sizes[r["source"], r["id"]]))
        assert r["block"] == r["start"] // 100
    for rows in per.values():  # starts are gapless
        rows.sort()
        assert [s for s, _ in rows] == [sum(n for _, n in rows[:i]) for i in range(len(rows))]
    slots = {}
    for r in out:
        assert slots.setdefault((r["source"], r["block"]), r["slot"]) == r["slot"]
    assert len(set(slots.values())) == len(slots)


def test_mixed_rows_are_the_rows(docs):
    out = mixed(docs, block_chars=100)
    assert out.columns == docs.columns
    assert out.exceptAll(docs).count() == 0 and docs.exceptAll(out).count() == 0


def test_too_many_sources_is_an_error(docs, monkeypatch):
    monkeypatch.setattr("tickloom.llm.mix.MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        mix_sources(docs)


def test_empty_table(docs):
    assert mix_sources(docs.limit(0)).collect() == []
    assert mixed(docs.filter(F.lit(False))).collect() == []
