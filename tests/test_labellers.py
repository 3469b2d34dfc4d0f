"""Labellers of samples of very many labels."""

from collections import Counter

from lumenweb.operators import labels


def _nodes(plan, name):
    here = [plan] if plan.nodeName() == name else []
    children = plan.children()
    return here + [x for i in range(children.size()) for x in _nodes(children.apply(i), name)]


def _samples(spark):
    rows = [
        ("big", [["a", "b", "c"][i * i % 3] for i in range(20_000)] + ["once"], [f"w{i % 7}" for i in range(20_001)]),
        ("same", ["a"] * 9, [f"w{i}" for i in range(9)]),
        ("one", ["a"], ["w1"]),
        ("null", ["a", None, None], ["w1", "w2", "w2"]),
        ("none", [], []),
    ]
    return rows, spark.createDataFrame(rows, "url string, user_choices array<string>, user_name array<string>")


def test_summary_beside_a_count(spark):
    rows, samples = _samples(spark)
    full, one, several, every = Counter(), Counter(), Counter(), Counter()
    for _, found, who in rows:
        often = Counter(found)
        for label, w in zip(found, who, strict=True):
            every[w] += 1
            several[w] += len(found) > 1
            full[w] += len(found) > 1 and len(often) == 1
            one[w] += len(found) > 1 and label is not None and often[label] > 1
    got = {r.labeller: r[1:5] for r in labels.labeller_summary(samples).collect()}
    assert got == {w: (full[w], one[w], several[w], every[w]) for w in every}


def test_no_label_carries_its_sample(spark):
    """Rows that hold all labels of their sample would be the square of a sample in size."""
    _, samples = _samples(spark)
    plan = labels.labeller_summary(samples)._jdf.queryExecution().optimizedPlan()
    taken_apart = _nodes(plan, "Generate")
    assert taken_apart
    for g in taken_apart:
        assert [g.output().apply(i).name() for i in range(g.output().size())] == ["x"]
