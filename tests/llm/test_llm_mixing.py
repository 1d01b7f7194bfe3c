import math
from collections import defaultdict

import pytest

from panelspark.llm.mixing import mix


def corpus():
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "big") for i in range(900)]
    rows += [(1000 + i, "a b c d", "en", "mid") for i in range(120)]
    rows += [(2000 + i, "a b", "en", "small") for i in range(50)]
    rows += [(3000 + i, "x y z", "en", None) for i in range(40)]
    return rows + [(4000, None, "en", "mid"), (4001, "", "en", "silent"), (None, "n u l l", "en", "mid"), (2000, "a b", "en", "small")]


def words(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len((r[1] or "").split())
    return out


def test_repetition_limit_without_loss(documents):
    rows = corpus()
    got = mix(documents(rows), repetition_limit=2.0).collect()
    total = words(rows)
    least = min(v for v in total.values() if v)
    exponent = 1 - math.log(2.0) / math.log(max(total.values()) / least)
    power = sum(v**exponent for v in total.values() if v)
    drawn, seen = defaultdict(int), defaultdict(int)
    for r in got:
        drawn[r.source] += r.mix_words
        seen[r.doc_id] += 1
        if total[r.source]:
            assert r.mix_weight == pytest.approx(total[r.source] ** exponent / power, rel=1e-6)
        assert 0 <= r.mix_position <= 1 + 1e-9
    budget = max(total.values()) / (max(total.values()) ** exponent / power)
    for s, v in total.items():
        want = v**exponent / power * budget if v else 0
        assert want - 8 <= drawn[s] <= want + 1e-6 * max(want, 1)
    assert set(seen) == {r[0] for r in rows}
    assert max(n for i, n in seen.items() if i != 2000) <= 2


def test_target_entropy_and_budget(documents):
    rows = [r for r in corpus() if r[3] != "silent"]
    total = words(rows)
    entropy = lambda a: -sum(p * math.log(p) for p in [v**a / sum(x**a for x in total.values()) for v in total.values()])
    target = (entropy(0) + entropy(1)) / 2
    got = mix(documents(rows), repetition_limit=100.0, target_entropy=target, budget=500.0).collect()
    weights = {r.source: r.mix_weight for r in got}
    assert -sum(p * math.log(p) for p in weights.values()) == pytest.approx(target, abs=1e-4)
    assert 500 - 8 * len(total) <= sum(r.mix_words for r in got) <= 500


def test_repeatable_and_empty(documents):
    rows = corpus()
    a = sorted((str(r.doc_id), r.mix_epoch) for r in mix(documents(rows)).collect())
    b = sorted((str(r.doc_id), r.mix_epoch) for r in mix(documents(rows[::-1]).repartition(5)).collect())
    assert a == b
    assert mix(documents([])).count() == 0
    only = mix(documents([(1, None, "en", "s"), (2, "", "en", None)])).collect()
    assert sorted(r.doc_id for r in only) == [1, 2]


def test_rows_without_ids_are_spread(documents):
    rows = [(None, f"word{i} a b c d", "en", "s") for i in range(160)]
    got = mix(documents(rows), budget=400.0).collect()
    assert 400 - 5 * 2 <= sum(r.mix_words for r in got) <= 400  # one source: its share is the budget


def test_unreachable_entropy_raises(documents):
    with pytest.raises(ValueError, match="target_entropy"):
        mix(documents(corpus()), repetition_limit=100.0, target_entropy=0.01)
