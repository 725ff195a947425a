import pytest

from tideline.llm.mixing import mix_sources, mixed, schedule


def edf(weights):
    """The plain schedule: at every slot the released block with the earliest deadline."""
    total, sent, out = sum(weights), [0] * len(weights), []
    for t in range(total):
        ready = [
            (-(-(sent[k] + 1) * total // w), k)
            for k, w in enumerate(weights) if sent[k] < w and sent[k] * total // w <= t
        ]
        deadline, k = min(ready)
        assert t < deadline
        out.append((t, k, sent[k]))
        sent[k] += 1
    return out


@pytest.mark.parametrize("weights", [[1], [3, 2], [5, 1, 1], [7, 11, 2, 30], [60, 58, 40, 342]])
def test_schedule(spark, weights):
    rows = schedule(spark, weights).orderBy("slot").collect()
    assert [(r["slot"], r["k"], r["nth"]) for r in rows] == edf(weights)
    total = sum(weights)
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"]
        for sent, w in zip(r["before"], weights):
            assert abs(sent - r["slot"] * w / total) < 1


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        schedule(spark, [3, 0])
    with pytest.raises(ValueError):
        schedule(spark, [10_001])


def test_whole_mixture(documents):
    rows = [(i, f"t{i}", "en", "abc"[min(i % 7, 2)]) for i in range(1000)]
    found = mix_sources(documents(*rows), {"a": 2, "b": 3}, 5, block_docs=4).toPandas()
    assert sorted(found.doc_id) == list(range(1000))
    assert sorted(found.position) == list(range(1000))
    # Positions follow slots, and no source is a block off its share while all last.
    ordered = found.sort_values("position")
    assert ordered.slot.is_monotonic_increasing
    last = ordered.groupby("source").slot.max().min()
    for source, w in (("a", 2), ("b", 3), ("c", 5)):
        slots = sorted(set(ordered[ordered.source == source].slot))
        for n, slot in enumerate(s for s in slots if s <= last):
            assert abs(n - slot * w / 10) < 1


def test_edges(documents):
    df = documents(
        (1, None, "en", None), (1, None, "en", None), (None, "", None, "a"),
        (None, "x" * 100_000, None, "a"), (2, "t", None, "zz"),
        more="row string, k string, position string",
    )
    found = mix_sources(df, {"a": 1}, 1).toPandas()
    assert len(found) == 5 and sorted(found.position) == list(range(5))
    back = mixed(df, {"a": 1}, 1)
    assert back.columns == df.columns and back.count() == 5
    assert mix_sources(documents(), {"a": 1}, 1).count() == 0
    assert mixed(documents(), {"a": 1}, 1).count() == 0


def test_order(documents):
    df = documents(*[(i, "t", None, "ab"[i % 2]) for i in range(300)])
    due = mix_sources(df, {"a": 1}, 3, block_docs=2).orderBy("position").collect()
    assert [r["doc_id"] for r in mixed(df, {"a": 1}, 3, block_docs=2).collect()] == [
        r["doc_id"] for r in due
    ]
